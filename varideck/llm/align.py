"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text, and which pairs of ids hold together.

Both tokenizers' tokens are laid over the bytes of a space and the text. pandas' merge_asof, keyed by document, finds for each token's
start the other side's covering token; both directions together are the overlaps, and a token that starts where its covering token starts
opens a group, as the tokens before it ended together. All pairs within a group are linked.

Texts go through in blocks of about BLOCK characters. A block writes, beside its documents' figures, each pair of ids once with its number
of documents; these are added up over the corpus, and the sums go back to the blocks that hold the pair, so a frequent pair is a row a
block and not a row a document.

Defined cases: texts that are null or empty, or whose joined token bytes differ from space and text on either side, have no tokens, and
figures of zero; strings of special tokens are plain text; rows with null ids are kept; repeated rows count as documents of their own;
columns besides the named ones are dropped, whatever their names; an empty table gives no rows. A long text is one row of a block: what is
held for it whole are its token ids and starts, all else goes in pieces cut where both sides end.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import stored

#: Characters of a block, and tokens of a piece of it.
BLOCK, PIECE = 1_000_000, 1 << 18
#: Groups with more links than this are linked by their distinct ids and how often they occur.
MANY = 256


class Side:
    """The tokens of one tokenizer: their bytes and lengths."""

    def __init__(self, pieces: list[bytes]):
        self.pieces, self.lengths = pieces, np.array([len(x) for x in pieces], np.int64)

    def spells(self, ids: list[int], raw: bytes) -> bool:
        return b"".join(map(self.pieces.__getitem__, ids)) == raw


class ByteSide(Side):
    """A byte-level vocabulary file, over space and text; special tokens' strings are plain text. Where the ids rise with the ranks of
    their merges, as in the known files, tiktoken encodes with them; else the codec of merge rounds does."""

    def __init__(self, path: str):
        codec = bpe.BpeCodec(path)
        codec.cut = None
        super().__init__(codec.pieces)
        if (np.diff(codec.merged) > 0).all() and codec.first.max() < codec.merged.min():
            ranks = {piece: i for i, piece in enumerate(codec.pieces) if piece and i not in codec.special.values()}
            one = tiktoken.Encoding("ranks", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.encode = lambda texts: [one.encode_ordinary(" " + x) for x in texts]
        else:
            self.encode = lambda texts: [x.tolist() for x in codec.encode([" " + x for x in texts])]

    def spells(self, ids: list[int], raw: bytes) -> bool:
        """Its tokens are cut from the bytes themselves, so their lengths tell."""
        return int(self.lengths[ids].sum()) == len(raw)


class PieceSide(Side):
    """A sentencepiece model, which puts the space before the text itself."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = range(self.model.get_piece_size())
        names = [self.model.id_to_piece(i) for i in n]
        super().__init__([bytes([int(x[3:5], 16)]) if self.model.is_byte(i) else x.replace("▁", " ").encode() for i, x in zip(n, names, strict=True)])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@lru_cache(2)
def sides(byte_path: str, piece_path: str) -> tuple[ByteSide, PieceSide]:
    """One pair for each worker process."""
    return ByteSide(byte_path), PieceSide(piece_path)


def covering(starts: np.ndarray, docs: np.ndarray, other_starts: np.ndarray, other_docs: np.ndarray) -> np.ndarray:
    """For each token's start, the number of the other side's token that covers it, in the same document."""
    left = pd.DataFrame({"at": starts, "doc": docs})
    right = pd.DataFrame({"at": other_starts, "doc": other_docs, "other": np.arange(len(other_starts))})
    return pd.merge_asof(left, right, on="at", by="doc")["other"].to_numpy(np.int64)


def overlaps(a_starts: np.ndarray, a_docs: np.ndarray, b_starts: np.ndarray, b_docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The overlapping pairs of tokens of both sides (their numbers on each side, in order), and which tokens of each side open a group.
    Starts rise over all documents, which lie one after another on both sides."""
    b_of_a, a_of_b = covering(a_starts, a_docs, b_starts, b_docs), covering(b_starts, b_docs, a_starts, a_docs)
    a_opens, b_opens = b_starts[b_of_a] == a_starts, a_starts[a_of_b] == b_starts
    # A pair with equal starts is found from both sides; it is taken from the first.
    a = np.r_[np.arange(len(a_starts)), a_of_b[~b_opens]]
    b = np.r_[b_of_a, np.flatnonzero(~b_opens)]
    order = np.lexsort((b, a))
    return a[order], b[order], a_opens, b_opens


def pieces_of(a_starts: np.ndarray, b_starts: np.ndarray, most: int = PIECE) -> Iterator[tuple[slice, slice]]:
    """Slices of both sides of about `most` tokens, cut where tokens of both sides start."""
    i = j = 0
    while i < len(a_starts):
        end, k = len(a_starts), i + most
        while k < len(a_starts):
            window = a_starts[k : k + 4096]
            at = np.searchsorted(b_starts, window)
            both = np.flatnonzero((at < len(b_starts)) & (b_starts[np.minimum(at, len(b_starts) - 1)] == window))
            if len(both):
                end = k + int(both[0])
                break
            k += 4096
        stop = int(np.searchsorted(b_starts, a_starts[end])) if end < len(a_starts) else len(b_starts)
        yield slice(i, end), slice(j, stop)
        i, j = end, stop


def _ramp(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each size in turn."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def linked_pairs(a: np.ndarray, b: np.ndarray, a_first: np.ndarray, a_size: np.ndarray, b_first: np.ndarray, b_size: np.ndarray, doc: np.ndarray, width: int, many: int = MANY) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, pair of ids) of all links as numbers document << 32 | a * width + b, ascending, and how many links each has."""
    few = np.flatnonzero(a_size * b_size <= many)
    # Each token of a takes all tokens of b in its group.
    at = np.repeat(a_first[few], a_size[few]) + _ramp(a_size[few])
    wide = np.repeat(b_size[few], a_size[few])
    left = np.repeat(np.repeat(doc[few], a_size[few]) << 32 | a[at].astype(np.int64) * width, wide)
    codes, counts = np.unique(left + b[np.repeat(np.repeat(b_first[few], a_size[few]), wide) + _ramp(wide)], return_counts=True)
    found = [(codes, counts)]
    for g in np.flatnonzero(a_size * b_size > many).tolist():
        x, nx = np.unique(a[a_first[g] : a_first[g] + a_size[g]], return_counts=True)
        y, ny = np.unique(b[b_first[g] : b_first[g] + b_size[g]], return_counts=True)
        found.append(((doc[g] << 32 | x.astype(np.int64)[:, None] * width + y).ravel(), (nx[:, None] * ny).ravel()))
    return summed(found)


def summed(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Codes, ascending and each once, with their counts added up."""
    if len(found) == 1:
        return found[0]
    codes, counts = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    heads = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, np.int64)
    return codes[heads], np.add.reduceat(counts, heads) if len(heads) else counts


class _Writer:
    """Groups as text, a1,a2|b1;a3|b2,b3: ids have a table of their digits, so a piece's text is one selection of bytes."""

    def __init__(self, size: int):
        digits = np.char.zfill(np.arange(size).astype("S6"), 6).view(np.uint8).reshape(size, 6)
        width = np.char.str_len(np.arange(size).astype("S6"))
        self.digits = np.c_[digits, np.zeros(size, np.uint8)]
        self.used = np.c_[np.arange(6) >= 6 - width[:, None], np.ones(size, bool)]
        self.width = width + 1

    def write(self, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, a_first: np.ndarray, b_first: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The text, and where each group's part of it ends."""
        a_end, b_end = np.r_[a_first[1:], len(a)], np.r_[b_first[1:], len(b)]
        pa_, pb = np.arange(len(a)) + b_first[a_group], np.arange(len(b)) + a_end[b_group]
        ids, sep = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[pa_], ids[pb] = a, b
        sep[pa_[a_end - 1]], sep[pb[b_end - 1]] = ord("|"), ord(";")
        text = self.digits[ids]
        text[:, 6] = sep
        return text[self.used[ids]].tobytes(), np.cumsum(self.width[ids])[pb[b_end - 1]]


@lru_cache(1)
def writer(size: int) -> _Writer:
    return _Writer(size)


def align_block(texts: list[str | None], one: Side, two: Side, piece: int = PIECE) -> dict[str, np.ndarray | list]:
    """For a block of texts: n_a, n_b, n_groups, n_links, n_overlaps and groups_sha256 of each; keys (the block's pairs of ids as a * width +
    b, ascending) and holders (their numbers of documents); and as rows of a sparse table sizes, slot and links: each document's pairs, by
    their place in keys, and its links of each."""
    n = len(texts)
    some = [i for i, x in enumerate(texts) if x]
    raw = [texts[i] for i in some]
    kept, a_ids, b_ids = [], [], []
    for i, x, y, text in zip(some, one.encode(raw), two.encode(raw), raw, strict=True):
        whole = b" " + text.encode()
        if one.spells(x, whole) and two.spells(y, whole):
            kept.append(i)
            a_ids.append(np.asarray(x, np.int64))
            b_ids.append(np.asarray(y, np.int64))
    out = {x: np.zeros(n, np.int64) for x in ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")}
    hashes: list = [None] * n
    width, found = len(two.pieces), []
    if kept:
        kept = np.array(kept)
        out["n_a"][kept], out["n_b"][kept] = [len(x) for x in a_ids], [len(x) for x in b_ids]
        a_doc, b_doc = np.repeat(kept, out["n_a"][kept]), np.repeat(kept, out["n_b"][kept])
        a, b = np.concatenate(a_ids), np.concatenate(b_ids)
        a_starts, b_starts = (np.cumsum(side.lengths[ids]) - side.lengths[ids] for side, ids in ((one, a), (two, b)))
        for s, t in pieces_of(a_starts, b_starts, piece):
            over, _, a_opens, b_opens = overlaps(a_starts[s], a_doc[s], b_starts[t], b_doc[t])
            a_first, b_first = np.flatnonzero(a_opens), np.flatnonzero(b_opens)
            a_size, b_size = np.diff(np.r_[a_first, len(a_opens)]), np.diff(np.r_[b_first, len(b_opens)])
            doc = a_doc[s][a_first]
            out["n_groups"] += np.bincount(doc, minlength=n)
            out["n_overlaps"] += np.bincount(a_doc[s][over], minlength=n)
            np.add.at(out["n_links"], doc, a_size * b_size)
            found.append(linked_pairs(a[s], b[t], a_first, a_size, b_first, b_size, doc, width))
            text, ends = writer(max(len(one.pieces), width)).write(a[s], b[t], np.cumsum(a_opens) - 1, np.cumsum(b_opens) - 1, a_first, b_first)
            last = np.flatnonzero(np.r_[doc[1:] != doc[:-1], True])
            at = 0
            for d, end in zip(doc[last].tolist(), ends[last].tolist(), strict=True):
                if hashes[d] is None:
                    hashes[d] = sha256()
                else:
                    hashes[d].update(b";")
                hashes[d].update(text[at : end - 1])
                at = end
    codes, links = summed(found) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    keys, slot = np.unique(codes & 0xFFFFFFFF, return_inverse=True)
    sizes = np.bincount(codes >> 32, minlength=n) if len(codes) else np.zeros(n, np.int64)
    return out | {"groups_sha256": ["" if h is None else h.hexdigest() for h in hashes], "keys": keys, "holders": np.bincount(slot, minlength=len(keys)), "sizes": sizes, "slot": slot, "links": links}


FIGURES = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")


#: What a block keeps for its documents' last figures: an Arrow stream of these, each a list.
LISTS = (*FIGURES, "sizes", "slot", "links")


def sealed(ids: pa.Array, made: dict[str, np.ndarray | list]) -> bytes:
    """ids, LISTS and the hashes of a block as one compressed stream; slots as steps, which are small."""
    whole = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
    arrays = {x: made[x] for x in LISTS} | {"slot": np.diff(made["slot"], prepend=0)}
    columns = [whole(ids), *[whole(pa.array(arrays[x], pa.int64() if x in FIGURES else pa.int32())) for x in LISTS], whole(pa.array(made["groups_sha256"], pa.string()))]
    rows = pa.RecordBatch.from_arrays(columns, ["ids", *LISTS, "groups_sha256"])
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(rows)
    return out.getvalue().to_pybytes()


def opened(payload: bytes) -> tuple[pa.Array, dict[str, np.ndarray], pa.Array]:
    """What sealed() put together."""
    ids, *lists, hashes = (c.flatten() for c in pa.ipc.open_stream(payload).read_next_batch().columns)
    arrays = {x: y.to_numpy() for x, y in zip(LISTS, lists, strict=True)}
    return ids, arrays | {"slot": np.cumsum(arrays["slot"], dtype=np.int64)}, hashes


def aligned_blocks(docs: DataFrame, byte_path: str, piece_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """A row a block: block, keys and holders of align_block, and payload, the rest of it as sealed()."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = sides(byte_path, piece_path)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, j in bpe.text_groups(texts, BLOCK):
                made = align_block(texts[i:j], one, two)
                lists = [pa.ListArray.from_arrays(pa.array([0, len(made[x])], pa.int32()), pa.array(made[x], pa.int32())) for x in ("keys", "holders")]
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *lists, pa.array([sealed(batch.column(0).slice(i, j - i), made)], pa.binary())], ["block", "keys", "holders", "payload"])
                number += 1

    return docs.select(key, text).mapInArrow(run, "block bigint, keys array<int>, holders array<int>, payload binary")


def pair_counts(blocks: DataFrame, width: int) -> DataFrame:
    """key, count, best: how many documents hold each pair of ids linked, and whether no other pair of its first id has more."""
    pairs = blocks.select(F.explode(F.arrays_zip("keys", "holders")).alias("p")).select("p.*")
    counts = pairs.groupBy(F.col("keys").alias("key")).agg(F.sum("holders").alias("count"))
    first = F.floor(F.col("key") / width).cast("int")
    counts = counts.withColumn("_a", first)
    most = counts.groupBy("_a").agg(F.max("count").alias("_most"))
    return counts.join(most, "_a").select("key", "count", (F.col("count") == F.col("_most")).alias("best"))


def align(docs: DataFrame, byte_path: str, piece_path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_overlaps, n_best (links whose pair is the commonest of its first id), count_sum (the pairs' numbers
    of documents, over links), groups_sha256."""
    width = sentencepiece.SentencePieceProcessor(model_file=piece_path).get_piece_size()
    blocks = stored(aligned_blocks(docs, byte_path, piece_path, text, key), "aligned-blocks")
    counts = stored(pair_counts(blocks, width), "pair-counts")
    # A block's payload and the counts of its pairs come as rows side by side and are put together one block at a time: gathered as lists
    # in the executors, the blocks of a task would be held at once.
    held = blocks.select("block", F.posexplode("keys").alias("place", "key")).join(counts, "key")
    held = held.select("block", "place", (F.col("count") * 2 + F.col("best").cast("bigint")).alias("count"), F.lit(None).cast("binary").alias("payload"))
    rows = held.unionByName(blocks.select("block", F.lit(-1).alias("place"), F.lit(0).cast("bigint").alias("count"), "payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, found, payload = None, [], None

        def block() -> pa.RecordBatch:
            ids, arrays, hashes = opened(payload)
            place, count = (np.concatenate(x) for x in zip(*found, strict=True))
            # The payload's own row has the place -1, which is the last.
            table = np.zeros(place.max() + 2, np.int64)
            table[place] = count
            at = np.r_[0, np.cumsum(arrays["sizes"])]
            sums = [np.diff(np.r_[0, np.cumsum(x[arrays["slot"]] * arrays["links"])][at]) for x in (table & 1, table >> 1)]
            return pa.RecordBatch.from_arrays([ids, *[pa.array(arrays[x]) for x in FIGURES], *map(pa.array, sums), hashes], [key, *FIGURES, "n_best", "count_sum", "groups_sha256"])

        for batch in batches:
            numbers, places, values = (batch.column(i).to_numpy() for i in range(3))
            cuts = np.r_[0, np.flatnonzero(np.diff(numbers)) + 1, len(numbers)]
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if i == j:
                    continue
                if numbers[i] != now:
                    if now is not None:
                        yield block()
                    now, found = numbers[i], []
                found.append((places[i:j].copy(), values[i:j].copy()))
                if len(own := i + np.flatnonzero(places[i:j] < 0)):
                    payload = batch.column(3)[int(own[0])].as_py()
        if now is not None:
            yield block()

    schema = f"`{key}` {docs.schema[key].dataType.simpleString()}, " + ", ".join(f"{x} bigint" for x in (*FIGURES, "n_best", "count_sum")) + ", groups_sha256 string"
    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(run, schema)
