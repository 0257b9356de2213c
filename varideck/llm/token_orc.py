"""Token ids in ORC: one row for each document in ascending key order, ids as integers (ORC's integer run-length encoding),
row indexes, and a Bloom filter on the key.

The texts are range-partitioned and sorted by key before they are encoded, so that ids themselves are never shuffled; each task
writes one file whose stripes can be read apart. The start of a document among all ids comes from sums of the files, not from a
pass over all rows in one task.

Defined cases: a null or empty text gives the end id alone; rows with a null key come first; repeated keys stand together, in
the order of their texts; an empty table gives an empty one; other columns are dropped, whatever their names.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_batches

END_ID = 1


#: Fixed value: the split pattern of the tokenizer file, for lower-case text; then what it comes to where all is ASCII.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
ASCII_PATTERN = r"'(?:[stmd]|re|ve|ll)|[a-z]+|[0-9]|[^\sa-z0-9]+"
WORD_END = "</w>"


class _Runs(dict):
    """A number for each run, in the order of first sight; new runs wait to be encoded."""

    def __init__(self):
        super().__init__()
        self.fresh: list[bytes] = []

    def __missing__(self, run: bytes) -> int:
        self[run] = at = len(self)
        self.fresh.append(run)
        return at


class WordEncoder:
    """Encodes texts with a tokenizers file whose words never cross white space and end in ids of their own. Each distinct word goes
    through the library once (and again after `most_runs` other runs), many words in one call; what a run between white space
    comes to is remembered too. A text whose words depend on more than themselves (special tokens' strings, letters that
    normalising or lower-casing would split or join) goes through the library whole."""

    def __init__(self, path: str, most_runs: int = 800_000):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        # For words, which are lower-case and normal already: the same model, split at white space alone.
        parts = [{"type": "WhitespaceSplit"}, spec["pre_tokenizer"]["pretokenizers"][-1]]
        self.by_word = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": parts}}))
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if token.endswith(WORD_END)]] = True
        self.plain, self.wide = re.compile(ASCII_PATTERN, re.ASCII), regex.compile(PATTERN)
        self.most_runs = most_runs
        self._forget()

    def _forget(self) -> None:
        self.runs, self.words = _Runs(), {}
        self.flat, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.run_flat, self.run_starts, self.run_sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    @staticmethod
    def _ids(tokenizer, text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)

    @staticmethod
    def _simple(text: str) -> bool:
        """Whether the ids of the text are those of its runs, each lower-cased and split by itself."""
        if "<|" in text:
            return False
        if text.isascii():
            return True
        low = text.lower()
        return len(low) == len(text) and "\u03a3" not in text and "\u212a" not in text and unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low)

    @staticmethod
    def _gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
        size = sizes[at]
        return flat[np.repeat(starts[at] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]

    def _learn_words(self, fresh: list[str]) -> None:
        for at in range(0, len(fresh), 20_000):
            part = fresh[at : at + 20_000]
            ids = self._ids(self.by_word, " ".join(part))
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part) or stops[-1] != len(ids):
                each = [self._ids(self.tokenizer, w) for w in part]
                ids, stops = np.concatenate(each), np.cumsum([len(x) for x in each])
            sizes = np.diff(np.r_[0, stops])
            self.words.update(zip(part, range(len(self.words), len(self.words) + len(part)), strict=True))
            self.starts = np.r_[self.starts, len(self.flat) + stops - sizes]
            self.sizes = np.r_[self.sizes, sizes]
            self.flat = np.r_[self.flat, ids]

    def _learn_runs(self) -> None:
        fresh, self.runs.fresh = self.runs.fresh, []
        split = [self.plain.findall(x) if x.isascii() else self.wide.findall(x) for x in (run.decode().lower() for run in fresh)]
        if new := list(dict.fromkeys(w for words in split for w in words if w not in self.words)):
            self._learn_words(new)
        counts = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter((self.words[w] for words in split for w in words), np.int64, int(counts.sum()))
        before = np.r_[0, np.cumsum(self.sizes[at])]
        bounds = before[np.r_[0, np.cumsum(counts)]]
        self.run_starts = np.r_[self.run_starts, len(self.run_flat) + bounds[:-1]]
        self.run_sizes = np.r_[self.run_sizes, np.diff(bounds)]
        self.run_flat = np.r_[self.run_flat, self._gather(self.flat, self.starts, self.sizes, at)]

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        if len(self.runs) > self.most_runs:
            self._forget()
        number, split = self.runs.__getitem__, []
        for text in texts:
            runs = (text or "").encode().split() if self._simple(text or "") else None  # bytes split at ASCII white space alone
            split.append(None if runs is None else np.fromiter(map(number, runs), np.int64, len(runs)))
        if self.runs.fresh:
            self._learn_runs()
        return [self._ids(self.tokenizer, text) if at is None else self._gather(self.run_flat, self.run_starts, self.run_sizes, at) for text, at in zip(texts, split, strict=True)]


@lru_cache(1)
def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process."""
    return WordEncoder(path)


def write_token_orc(df: DataFrame, out_path: str, tokenizer_path: str, key: str = "doc_id", text: str = "text", files: int | None = None, end_id: int = END_ID) -> None:
    """Writes (key, n_tokens long, ids array<int>) as ORC files in ascending key order."""
    spark = df.sparkSession
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(key, text).repartitionByRange(n, F.col(key).asc_nulls_first()).sortWithinPartitions(F.col(key).asc_nulls_first(), F.col(text).asc_nulls_first())
    kind = df.schema[key].dataType.simpleString()

    def make():
        words = encoder(tokenizer_path)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            end = np.array([end_id], np.int32)
            texts, parts, sizes = batch.column(1).to_pylist(), [], []
            for at in range(0, len(texts), 256):
                for ids in words.encode(texts[at : at + 256]):
                    parts += [ids, end]
                    sizes.append(len(ids) + 1)
            offsets = np.cumsum([0, *sizes])
            ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.concatenate(parts), pa.int32()))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), ids], [key, "n_tokens", "ids"])

        return work

    encoded = map_batches(rows, make, f"`{key}` {kind}, n_tokens bigint, ids array<int>")
    (
        encoded.write.option("orc.bloom.filter.columns", key)
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", "1000")
        .option("orc.stripe.size", str(16 << 20))
        .option("compression", "zstd")
        .orc(out_path)
    )


def read_token_orc(spark: SparkSession, path: str, key: str = "doc_id", key_type: str = "bigint") -> DataFrame:
    """The written rows; filters on key reach the files' statistics, row indexes and Bloom filters."""
    return spark.read.schema(f"`{key}` {key_type}, n_tokens bigint, ids array<int>").orc(path)


def lookup(spark: SparkSession, path: str, keys: Sequence[int], key: str = "doc_id") -> DataFrame:
    """The rows of a short list of keys; stripes and row groups that can't hold them aren't read."""
    return read_token_orc(spark, path, key).filter(F.col(key).isin(list(keys)))


def token_starts(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """For what read_token_orc gives: key, start long (ids of all rows before it), n_tokens long, ids_crc32 long (of the ids as
    little-endian unsigned 32-bit integers)."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            lists = batch.column(batch.schema.get_field_index("ids"))
            at = np.asarray(lists.offsets).astype(np.int64)
            flat = np.asarray(lists.values).astype("<u4")
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
            names = [key, "_file", "_block", "_at", "n_tokens"]
            columns = [batch.column(batch.schema.get_field_index(x)) for x in names]
            return pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(at), pa.int64()), pa.array(crc, pa.int64())], [*names, "_read", "ids_crc32"])

        return work

    kind = tokens.schema[key].dataType.simpleString()
    placed = tokens.select(key, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"), "n_tokens", "ids")
    rows = map_batches(placed, make, f"`{key}` {kind}, _file string, _block bigint, _at bigint, n_tokens bigint, _read bigint, ids_crc32 bigint")
    wrong = F.raise_error(F.concat(F.lit("token count differs from the ids read in "), F.col("_file"))).cast("bigint")
    rows = rows.withColumn("n_tokens", F.when(F.col("n_tokens") == F.col("_read"), F.col("n_tokens")).otherwise(wrong))
    files = tokens.groupBy(F.col("_metadata.file_name").alias("_file")).agg(F.sum("n_tokens").alias("_sum"))  # one row a file
    number = F.regexp_extract("_file", r"^part-(\d+)", 1).cast("bigint")  # ascends with the keys
    files = files.withColumn("_before", F.sum("_sum").over(Window.orderBy(number, "_file")) - F.col("_sum")).select("_file", "_before")
    inside = Window.partitionBy("_file").orderBy(F.col(key).asc_nulls_first(), "_block", "_at")  # blocks of a file may be read in any order
    start = F.sum("n_tokens").over(inside) - F.col("n_tokens")
    return rows.withColumn("_start", start).join(files, "_file").select(key, (F.col("_before") + F.col("_start")).alias("start"), "n_tokens", "ids_crc32")
