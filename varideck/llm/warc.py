"""WARC archives of one Zstandard frame for each record, with the dictionary in a leading skippable frame.

Writing: each task trains a dictionary on the records of an archive, writes it as the leading skippable frame, then a frame a
record, and moves the finished file to its place; a manifest that Spark commits names the archives that count, so what lost or
repeated tasks leave behind is ignored. Archives close at `archive_bytes`, which bounds a task's memory.

Reading: the leading skippable frame gives the dictionary; each further frame is one record, whose version line, required
headers, lengths and digest are checked. A damaged archive raises ValueError with its name and offset.

Defined cases: a null payload counts as empty; payloads below `least` bytes are all responses; of equal longer ones the smallest
key is the response and the others (rows without a key too) are revisits of it, rows that repeat the smallest key are responses;
an empty table writes no archive and reads as no records; other columns are dropped, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

#: Fixed values of the format.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
REQUIRED = ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

RECORDS = "archive string, position bigint, record_id string, key bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:") or "://" not in path:
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path)


def format_record(key: int | None, url: str | None, kind: str, refers_to: int | None, digest: str, payload: bytes) -> bytes:
    """One uncompressed record."""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key} {digest}')}>", f"WARC-Date: {DATE}"]
    if url:
        head.append("WARC-Target-URI: " + " ".join(url.split()))
    if key is not None:
        head.append(f"X-Row-Key: {key}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    body = payload
    if kind == "revisit":
        head += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Row-Key: {refers_to}"]
        body = b""
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def pack_archive(records: list[bytes], level: int = 6, dictionary_bytes: int = 32 << 10) -> bytes:
    """An archive of these records; without a dictionary where they are too few to train one."""
    dictionary = None
    if len(records) >= 16:
        try:
            dictionary = zstandard.train_dictionary(dictionary_bytes, records[:: max(1, len(records) // 512)], k=200, d=8)
        except zstandard.ZstdError:
            dictionary = None
    parts = []
    if dictionary:
        raw = dictionary.as_bytes()
        parts += [struct.pack("<II", DICTIONARY_MAGIC, len(raw)), raw]
    packer = zstandard.ZstdCompressor(level=level, dict_data=dictionary, write_content_size=True, write_checksum=True)
    return b"".join(parts + [packer.compress(r) for r in records])


def frames(raw: bytes, name: str = "") -> Iterator[tuple[int, bytes]]:
    """Position and content of each record's frame."""
    view, at, dictionary = memoryview(raw), 0, None
    first = True
    unpack = zstandard.ZstdDecompressor()
    while at < len(raw):
        if at + 4 > len(raw):
            raise ValueError(f"{name}: cut off at {at}")
        (magic,) = struct.unpack_from("<I", raw, at)
        if magic in SKIPPABLE:
            if at + 8 > len(raw) or at + 8 + (size := struct.unpack_from("<I", raw, at + 4)[0]) > len(raw):
                raise ValueError(f"{name}: a skippable frame at {at} is cut off")
            if first and magic == DICTIONARY_MAGIC:
                body = raw[at + 8 : at + 8 + size]
                if body[:4] == struct.pack("<I", FRAME_MAGIC):
                    body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
                dictionary = zstandard.ZstdCompressionDict(body)
                unpack = zstandard.ZstdDecompressor(dict_data=dictionary)
            at, first = at + 8 + size, False
            continue
        if magic != FRAME_MAGIC:
            raise ValueError(f"{name}: no frame at {at}")
        first = False
        one, parts, fed, step = unpack.decompressobj(), [], at, 4096
        try:
            while not one.eof and fed < len(raw):
                parts.append(one.decompress(view[fed : fed + step]))
                fed, step = min(fed + step, len(raw)), min(2 * step, 1 << 20)
        except zstandard.ZstdError as e:
            raise ValueError(f"{name}: bad frame at {at}: {e}") from e
        if not one.eof:
            raise ValueError(f"{name}: the frame at {at} is cut off")
        yield at, b"".join(parts)
        at = fed - len(one.unused_data)


def parse_record(raw: bytes, name: str = "", at: int = 0) -> tuple[dict[str, str], bytes]:
    """Headers and body of one record, after checks."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not gap or not lines[0].startswith("WARC/1."):
        raise ValueError(f"{name}: no WARC header at {at}")
    headers = {}
    for line in lines[1:]:
        field, colon, value = line.partition(":")
        if not colon or not field or field != field.strip():
            raise ValueError(f"{name}: bad header line at {at}: {line[:80]}")
        headers[field] = value.strip()
    if missing := [x for x in REQUIRED if x not in headers]:
        raise ValueError(f"{name}: the record at {at} lacks {', '.join(missing)}")
    if not headers["Content-Length"].isdigit() or len(rest) != int(headers["Content-Length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError(f"{name}: the record at {at} isn't as long as it says")
    body = rest[:-4]
    digest = headers.get("WARC-Payload-Digest", "")
    if headers["WARC-Type"] == "response" and digest.startswith("sha256:") and hashlib.sha256(body).hexdigest() != digest[7:]:
        raise ValueError(f"{name}: the record at {at} has another payload than its digest says")
    return headers, body


def with_record_types(df: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", least: int = 100) -> DataFrame:
    """key, url, payload, payload_digest, record_type, refers_to for each row."""
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = df.select(F.col(key).cast("bigint").alias("key"), F.col(url).alias("url"), body.alias("payload"), F.sha2(body.cast("binary"), 256).alias("payload_digest"))
    long = F.octet_length("payload") >= least
    groups = rows.filter(long).groupBy("payload_digest").agg(F.min("key").alias("_first"), F.count(F.lit(1)).alias("_n")).filter((F.col("_n") > 1) & F.col("_first").isNotNull()).drop("_n")
    again = long & F.col("_first").isNotNull() & (F.col("key").isNull() | (F.col("key") > F.col("_first")))
    return rows.join(groups, "payload_digest", "left").select(
        "key", "url", "payload", "payload_digest", F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("_first")).alias("refers_to")
    )


def write_warc(records: DataFrame, out_path: str, archive_bytes: int = 8 << 20) -> DataFrame:
    """Writes what with_record_types gives; returns the committed manifest (archive, n_records)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = file_system(out_path)
        files.create_dir(folder, recursive=True)
        waiting, size = [], 0

        def close() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.warc.zst"
            with files.open_output_stream(f"{folder}/.{name}.part") as f:
                f.write(pack_archive(waiting))
            files.move(f"{folder}/.{name}.part", f"{folder}/{name}")
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(waiting)], pa.int64())], ["archive", "n_records"])

        for batch in batches:
            for key, url, payload, digest, kind, to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                waiting.append(format_record(key, url, kind, to, digest, payload.encode()))
                size += len(waiting[-1])
                if size >= archive_bytes:
                    yield close()
                    waiting, size = [], 0
        if waiting:
            yield close()

    return stored(records.select("key", "url", "payload", "payload_digest", "record_type", "refers_to").mapInArrow(run, "archive string, n_records bigint"), "warc-manifest")


def read_warc(spark: SparkSession, path: str, manifest: DataFrame | None = None, payloads: bool = False) -> DataFrame:
    """One row a record: archive, position, record_id, key, url, record_type, refers_to, payload_digest and payload_bytes (of the
    stored body; null for revisits), with payloads=True the payload too. manifest: only its archives count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows: list[tuple] = []
                for at, record in frames(raw.as_buffer().to_pybytes(), name):
                    head, body = parse_record(record, name, at)
                    whole = head["WARC-Type"] == "response"
                    digest = hashlib.sha256(body).hexdigest() if whole else head.get("WARC-Payload-Digest", "").removeprefix("sha256:")
                    number = lambda x, head=head: int(head[x]) if x in head else None
                    rows.append((name, at, head["WARC-Record-ID"], number("X-Row-Key"), head.get("WARC-Target-URI"), head["WARC-Type"], number("X-Refers-To-Row-Key"), digest, len(body) if whole else None) + ((body if whole else None,) if payloads else ()))
                    if len(rows) >= 1000:
                        yield pack(rows)
                        rows = []
                if rows:
                    yield pack(rows)

    kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    names = [x.split()[0] for x in RECORDS.split(", ")] + ["payload"]

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        columns = [*zip(*rows, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=False)], names[: len(columns)])

    schema = RECORDS + (", payload binary" if payloads else "")
    if manifest is not None and manifest.isEmpty():
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path)
    found = files.select(F.element_at(F.split("path", "/"), -1).alias("archive"), "content").mapInArrow(run, schema)
    return found if manifest is None else found.join(manifest.select("archive"), "archive", "left_semi")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """key, payload_bytes, payload_digest, record_type, refers_to; a revisit takes the length of the response that it names, whose
    digest must be its own."""
    responses = records.filter("record_type = 'response'").groupBy(F.col("key").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("_bytes"))
    joined = records.filter("record_type = 'revisit'").join(responses, ["refers_to", "payload_digest"], "left")
    wrong = F.raise_error(F.concat(F.lit("no response with the same payload for the revisit "), F.col("record_id"))).cast("bigint")
    found = joined.withColumn("payload_bytes", F.coalesce("_bytes", wrong)).drop("_bytes")
    columns = ["key", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return records.filter("record_type = 'response'").select(columns).unionByName(found.select(columns))
