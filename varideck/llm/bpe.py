"""BPE encoding and decoding by batched numpy merge rounds.

All distinct words of a batch lie in one flat symbol array. A round finds, for each word, its pair of lowest rank (ranks come
from a binary search over the sorted pair keys) and merges every occurrence of it; words without a known pair leave.

Defined cases: a null text counts as empty and gives no ids; an empty text gives no ids; a row with a null id is kept; repeated
rows give repeated results; columns besides the named ones are dropped, whatever their names. A word of any length is merged
whole. Texts that hold the string of a special token give that token, as the file's own library does.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import map_batches

#: Fixed value: the split pattern of the byte-level scheme.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NONE = np.int64(1) << 40


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 for itself, others from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class _Words(dict):
    """A number for each word, in the order of first sight; new words wait to be merged."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.fresh.append(word)
        return at


class BpeCodec:
    """Encodes and decodes lists of texts with a byte-level vocabulary file. At most `most_words` distinct words are
    remembered between calls; that bounds memory and changes no result."""

    def __init__(self, path: str, most_words: int = 400_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        letters = byte_letters()
        self.first = np.array([vocab[x] for x in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.width = np.int64(max(vocab.values()) + 1)
        keys = np.array([vocab[a] * int(self.width) + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        of = {x: b for b, x in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.pieces = [b""] * size
        for token, i in vocab.items():
            self.pieces[i] = bytes(of[x] for x in token)
        for token, i in self.special.items():
            self.pieces[i] = token.encode()
        self.split = regex.compile(PATTERN)
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.most_words = most_words
        self._forget()

    def _forget(self) -> None:
        self.words = _Words()
        self.flat, self.starts, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.width + right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge_rounds(self, symbols: np.ndarray, word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of n words after all merges, word after word, and their number for each. word: the non-decreasing word
        number of each symbol."""
        out_symbols, out_word = [], []
        rank = np.full(len(symbols), NONE, np.int64)
        if len(symbols) > 1:
            inside = np.flatnonzero(word[1:] == word[:-1])
            rank[inside] = self._ranks(symbols[inside], symbols[inside + 1])
        while len(symbols):
            heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            low = np.minimum.reduceat(rank, heads)
            sizes = np.diff(np.r_[heads, len(symbols)])
            live = np.repeat(low < NONE, sizes)
            if not live.all():
                out_symbols.append(symbols[~live])
                out_word.append(word[~live])
                low = np.repeat(low, sizes)[live]
                symbols, word, rank = symbols[live], word[live], rank[live]
                if not len(symbols):
                    break
            else:
                low = np.repeat(low, sizes)
            hit = rank == low
            at = np.flatnonzero(hit)
            # In a run of overlapping hits (aaa) every second one merges, from the left.
            run = np.flatnonzero(np.r_[True, (np.diff(at) > 1) | (word[at[1:]] != word[at[:-1]])])
            offset = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
            at = at[offset % 2 == 0]
            symbols[at] = self.merged[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            new = np.cumsum(keep) - 1
            symbols, word, rank = symbols[keep], word[keep], rank[keep]
            touched = new[at]
            mark = np.zeros(len(symbols), bool)
            mark[touched] = mark[touched[touched > 0] - 1] = True
            touched = np.flatnonzero(mark)
            rank[touched] = NONE
            touched = touched[touched < len(symbols) - 1]
            touched = touched[word[touched] == word[touched + 1]]
            rank[touched] = self._ranks(symbols[touched], symbols[touched + 1])
        if not out_symbols:
            return np.zeros(0, np.int64), np.zeros(n, np.int64)
        symbols, word = np.concatenate(out_symbols), np.concatenate(out_word)
        return symbols[np.argsort(word, kind="stable")], np.bincount(word, minlength=n)

    def _learn(self) -> None:
        fresh, self.words.fresh = self.words.fresh, []
        raw = [w.encode() for w in fresh]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols = self.first[np.frombuffer(b"".join(raw), np.uint8)]
        ids, counts = self.merge_rounds(symbols, np.repeat(np.arange(len(raw)), sizes), len(raw))
        self.starts = np.r_[self.starts, len(self.flat) + np.cumsum(counts) - counts]
        self.lengths = np.r_[self.lengths, counts]
        self.flat = np.r_[self.flat, ids.astype(np.int32)]

    def _gather(self, word: np.ndarray) -> np.ndarray:
        size = self.lengths[word]
        shift = np.repeat(self.starts[word] - (np.cumsum(size) - size), size)
        return self.flat[shift + np.arange(len(shift))]

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """The ids of each text, as int32 arrays."""
        if len(self.words) > self.most_words:
            self._forget()
        number = self.words.__getitem__
        found: list[list] = []
        for text in texts:
            parts: list = []
            at = 0
            for cut in self.cut.finditer(text) if self.cut and text else ():
                parts += [text[at : cut.start()], self.special[cut.group()]]
                at = cut.end()
            parts.append((text or "")[at:])
            doc = []
            for part in parts:
                if isinstance(part, int):
                    doc.append(part)
                elif part:
                    split = self.split.findall(part)
                    doc.append(np.fromiter(map(number, split), np.int64, len(split)))
            found.append(doc)
        if self.words.fresh:
            self._learn()
        empty = np.zeros(0, np.int32)
        out = []
        for doc in found:
            ids = [np.array([x], np.int32) if isinstance(x, int) else self._gather(x) for x in doc]
            out.append(ids[0] if len(ids) == 1 else np.concatenate(ids) if ids else empty)
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, special tokens included; bytes that aren't UTF-8 give U+FFFD."""
        return b"".join(map(self.pieces.__getitem__, ids.tolist())).decode("utf-8", "replace")


@lru_cache(2)
def codec(path: str) -> BpeCodec:
    """One codec for each worker process."""
    return BpeCodec(path)


def text_groups(texts: list[str | None], most: int = 2_000_000):
    """Slices of a batch with at most `most` characters each, or one text."""
    at = size = 0
    for i, text in enumerate(texts):
        if i > at and size + len(text or "") > most:
            yield at, i
            at, size = i, 0
        size += len(text or "")
    yield at, len(texts)


def bpe_encode(df: DataFrame, path: str, text: str = "text", key: str = "doc_id", out: str = "ids") -> DataFrame:
    """key, and out array<int>: the ids of each text."""

    def make():
        coder = codec(path)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, ids = batch.column(1).to_pylist(), []
            for a, b in text_groups(texts):
                ids += coder.encode(texts[a:b])
            at = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32), pa.int32()))
            return pa.RecordBatch.from_arrays([batch.column(0), column], [key, out])

        return work

    return map_batches(df.select(key, text), make, f"`{key}` {df.schema[key].dataType.simpleString()}, `{out}` array<int>")


def bpe_decode(df: DataFrame, path: str, ids: str = "ids", key: str = "doc_id", out: str = "text") -> DataFrame:
    """key, and out string: the text of each list of ids (null: empty)."""

    def make():
        coder = codec(path)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [coder.decode(np.array(x or [], np.int64)) for x in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], [key, out])

        return work

    return map_batches(df.select(key, ids), make, f"`{key}` {df.schema[key].dataType.simpleString()}, `{out}` string")
