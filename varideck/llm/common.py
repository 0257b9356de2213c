"""Helpers that the training-data operators share: the cluster's shared folder, tables that cut lineage, byte arrays."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only on a single machine (tests), where that is unset, is a
    temporary folder made and set; elsewhere executors would write to disks of their own, so that raises ValueError."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        made = spark.sparkContext._jsc.sc().getCheckpointDir()
        if made.isDefined():
            return made.get()
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """df as a Parquet table in the shared folder, read again: it cuts the lineage and outlives lost executors. With release=True the
    shuffle files behind it, which nothing needs any more, go too: Spark removes them when the driver collects its garbage."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    if release:
        df.sparkSession.sparkContext._jvm.System.gc()
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._stored_at = path
    return found


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables that nothing reads any more: all that was made of them is stored itself."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession, rows: int = 2000, size: str = "8m") -> None:
    """Bounds the Arrow batches that whole texts go through, in rows and, where Spark can, in bytes. It holds for the session: results
    are read after a query has returned, and the batches are cut then."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(int(size.rstrip("m")) << 20))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a test table."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores after it as make it no column of df."""
    while name.lower() in map(str.lower, df.columns):
        name += "_"
    return name


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]], schema: str) -> DataFrame:
    """df.mapInArrow with a worker that is made once for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            if batch.num_rows and (out := work(batch)) is not None:
                yield out

    return df.mapInArrow(run, schema)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text or binary column without gaps, as uint8, and its offsets. Null counts as empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return raw, at - at[0] if len(at) else np.zeros(1, np.int64)


def slices(column: pa.Array, rows: int = 256) -> Iterator[pa.Array]:
    """A column in parts of so many rows, which bounds what is worked on at once."""
    for i in range(0, len(column), rows):
        yield column.slice(i, rows)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(31))
        x = x * np.uint64(0x9E3779B97F4A7C15)
        x = x ^ (x >> np.uint64(29))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def byte_codes(seed: int) -> np.ndarray:
    """256 odd 64-bit numbers, one for each byte."""
    return mixed(np.arange(1, 257, dtype=np.uint64) + np.uint64(seed * 1000003)) | np.uint64(1)


class RollingHash:
    """Prefix polynomials modulo 2**64 over a byte array: the hash of any slice by one subtraction and one product. Fast, but texts
    such as the Thue-Morse sequence make it collide, so it may choose and group, and never decide that slices are equal."""

    BASE, INVERSE = 0x5851F42D4C957F2D, pow(0x5851F42D4C957F2D, -1, 1 << 64)

    def __init__(self, seed: int = 1):
        self.codes, self._powers, self._inverses = byte_codes(seed), np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._powers) < n:
            size = max(n, 1 << 16)
            with np.errstate(over="ignore"):
                for name, base in (("_powers", self.BASE), ("_inverses", self.INVERSE)):
                    x = np.full(size, base, np.uint64)
                    x[0] = 1
                    setattr(self, name, np.multiply.accumulate(x))

    def prefixes(self, raw: np.ndarray) -> np.ndarray:
        self._grow(len(raw) + 1)
        out = np.zeros(len(raw) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(self.codes[raw] * self._powers[: len(raw)], out=out[1:])
        return out

    def slices(self, prefixes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Equal slices have equal hashes wherever they stand."""
        self._grow(len(prefixes))
        with np.errstate(over="ignore"):
            return (prefixes[ends] - prefixes[starts]) * self._inverses[starts]


class PrimeHash:
    """Prefix polynomials modulo the prime 2**31 - 1 for two bases at once, packed into one number of 62 bits: no text makes them
    collide for reasons of arithmetic, as repeated doubling does modulo a power of two."""

    PRIME = np.uint64((1 << 31) - 1)
    BASES = (1103515245, 1566083941)

    def __init__(self, seed: int = 1):
        self.codes = byte_codes(seed) >> np.uint64(34)
        self._powers = [(np.ones(1, np.uint64), np.ones(1, np.uint64)) for _ in self.BASES]

    def _reduced(self, x: np.ndarray) -> np.ndarray:
        x = (x & self.PRIME) + (x >> np.uint64(31))
        x = (x & self.PRIME) + (x >> np.uint64(31))
        return np.where(x >= self.PRIME, x - self.PRIME, x)

    def _grow(self, n: int) -> None:
        if len(self._powers[0][0]) < n:
            made = []
            for base in self.BASES:
                pair = []
                for b in (base, pow(base, -1, int(self.PRIME))):
                    x = np.ones(1, np.uint64)
                    while len(x) < max(n, 1 << 16):
                        x = np.r_[x, self._reduced(x * np.uint64(pow(b, len(x), int(self.PRIME))))]
                    pair.append(x)
                made.append(tuple(pair))
            self._powers = made

    def prefixes(self, raw: np.ndarray) -> list[np.ndarray]:
        """Sums below 2**63 for up to 2**32 bytes."""
        self._grow(len(raw) + 1)
        codes = self.codes[raw]
        return [np.r_[np.uint64(0), np.cumsum(self._reduced(codes * powers[: len(raw)]))] for powers, _ in self._powers]

    def slices(self, prefixes: list[np.ndarray], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Equal slices have equal hashes wherever they stand."""
        one, two = (self._reduced(self._reduced(p[ends] - p[starts]) * inverses[starts]) for p, (_, inverses) in zip(prefixes, self._powers, strict=True))
        return one << np.uint64(31) | two


def hash_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """A keyed 64-bit hash of each slice: eight bytes at a time go through the finaliser; slices over 64 bytes are hashed by BLAKE2."""
    padded = np.zeros(len(raw) + 8, np.uint8)
    padded[: len(raw)] = raw
    eight = np.ndarray((len(raw) + 1,), "<u8", padded, 0, (1,))
    sizes = ends - starts
    with np.errstate(over="ignore"):
        out = mixed((sizes + 1).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed))
    rows = np.flatnonzero((sizes > 0) & (sizes <= 64))
    for at in range(0, 64, 8):
        rows = rows[sizes[rows] > at]
        if not len(rows):
            break
        left = np.minimum(sizes[rows] - at, 8).astype(np.uint64)
        block = eight[starts[rows] + at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - left * np.uint64(8)))
        out[rows] = mixed(out[rows] ^ block)
    for i in np.flatnonzero(sizes > 64).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(raw[starts[i] : ends[i]], digest_size=8, key=b"%d" % seed).digest(), "little")
    return out


SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


#: White space and ASCII punctuation.
MARKS = SPACES.copy()
MARKS[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


def words_of(raw: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of bytes outside `gaps` (ASCII white space), and the number of such words before each
    document's start (one more entry than documents). Words don't cross documents."""
    solid = np.zeros(len(raw) + 2, bool)
    solid[1:-1] = ~gaps[raw]
    first = solid[1:-1] & ~solid[:-2]
    last = solid[1:-1] & ~solid[2:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(raw))]
    first[inner] |= solid[1:-1][inner]
    last[inner - 1] |= solid[1:-1][inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)
