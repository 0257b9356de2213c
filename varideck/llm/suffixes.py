"""Removal of repeated 400-byte strings by a hash-compared suffix sort.

Every window of `length` bytes picks the gram of least hash in it (the leftmost of equals) as its anchor, so equal windows pick equal
grams at equal places, and only suffixes behind the same gram at the same distance have to be compared.

1. Anchors of all texts (gram hash, text, place, the run of windows that picked it, the 128-bit BLAKE2 digest of the bytes those
   windows cover) are counted by gram; grams with one occurrence leave.
2. Occurrences whose covered bytes are equal as a whole repeat entirely. A cryptographic digest names those bytes, so equal names mean
   equal bytes, and none have to be moved to compare them.
3. What differs near its ends goes, as bytes and one representative a class, to the task of its gram. There the suffixes that begin
   at the same distance before the gram are sorted by mergesort; a comparison finds the common extension by binary search on prefix
   polynomial hashes, O(log length) steps. Neighbours in that order that agree on `length` bytes are repeated windows; their bytes
   are compared once more, as hashes may collide.
4. A gram with more than HOT such contexts would outgrow a task. Its windows are dealt out one by one instead, by the digest of their
   bytes, and counted, as in step 2.
5. The covered runs of each text are joined and cut out.

Texts are named by their SHA-256, so copies are worked on once and repeated or null ids do no harm: a text that occurs twice repeats
as a whole if it has `length` bytes.

Defined cases: a null text counts as empty; a text shorter than `length` loses nothing; texts of any length are worked on whole;
repeated rows count as separate documents; empty tables give empty ones; other columns are dropped, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import PrimeHash, RollingHash, discard, map_batches, mixed, small_batches, stored, text_bytes

LENGTH = 400
GRAM = 128
PLACE = np.uint64((1 << 24) - 1)
PIECE = 4 << 20
HOT = 1 << 12


def sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours, in three passes."""
    n = len(v) - width + 1
    rows = -(-len(v) // width)
    full = np.full(rows * width, np.iinfo(v.dtype).max, v.dtype)
    full[: len(v)] = v
    full = full.reshape(rows, width)
    ahead = np.minimum.accumulate(full, 1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def digests(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The halves of the 128-bit digest of each slice."""
    view = memoryview(raw)
    both = b"".join(hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist(), strict=True))
    return tuple(np.frombuffer(both, np.int64).reshape(-1, 2).T.copy())


def window_anchors(raw: np.ndarray, offsets: np.ndarray, length: int, gram: int, rolling: RollingHash) -> tuple[np.ndarray, ...]:
    """gram hash, place, first and last window start, and the halves of the digest of the bytes covered, for each run of windows of one
    document with the same anchor. len(raw) is below 2**24. The gram hash only chooses anchors and groups them."""
    if len(raw) < length:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    p = rolling.prefixes(raw)
    at = np.arange(len(raw) - gram + 1)
    grams = mixed(rolling.slices(p, at, at + gram))
    least = sliding_least((grams & ~PLACE) | at.astype(np.uint64), length - gram + 1)
    inside = np.zeros(len(raw) + 1, np.int32)  # windows that lie in one document
    sizes = np.diff(offsets)
    fits = sizes >= length
    np.add.at(inside, offsets[:-1][fits], 1)
    np.add.at(inside, offsets[1:][fits] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside[: len(least)]) > 0)
    if not len(starts):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    place = (least[starts] & PLACE).astype(np.int64)
    head = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (np.diff(starts) > 1)])
    lo, hi, place = starts[head], starts[np.r_[head[1:], len(starts)] - 1], place[head]
    return grams[place].view(np.int64), place, lo, hi, *digests(raw, lo, hi + length)


COLUMNS = ["gram", "doc", "place", "lo", "hi", "c1", "c2"]


def within_documents(which: np.ndarray, g: np.ndarray, c1: np.ndarray, c2: np.ndarray, lo: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Of contexts that a document has several times, two are enough for the others to meet. Which rows to keep; and (row, start, end)
    of the joined stretches that all of them cover. Rows come by document and place."""
    order = np.lexsort((c2, c1, g, which))
    same = np.ones(len(order) - 1, bool)
    for x in (which, g, c1, c2):
        same &= x[order][1:] == x[order][:-1]
    head = np.flatnonzero(np.r_[True, ~same])
    sizes = np.diff(np.r_[head, len(order)])
    rank = np.arange(len(order)) - np.repeat(head, sizes)
    keep, several = np.ones(len(order), bool), np.zeros(len(order), bool)
    keep[order] = rank < 2
    several[order] = np.repeat(sizes > 1, sizes)
    at = np.flatnonzero(several)
    cut = np.flatnonzero(np.r_[True, (which[at][1:] != which[at][:-1]) | (lo[at][1:] > end[at][:-1])]) if len(at) else at
    last = np.r_[cut[1:], len(at)] - 1 if len(at) else at
    return keep, (at[cut], lo[at[cut]], end[at[last]])


def anchors(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """gram, doc (16 bytes of the text's SHA-256), place, lo, hi, c1, c2 of a table with the column text. A stretch of contexts that
    repeat in their document is one row with a null gram, its start as lo and its end as hi."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rolling = RollingHash(21)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                raw, offsets = text_bytes(batch.column(0).slice(i, 256))
                docs = [hashlib.sha256(raw[a:b]).digest()[:16] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                group = 0
                while group < len(docs):  # documents up to PIECE bytes at a time; a longer one in pieces that overlap
                    last = max(group + 1, int(np.searchsorted(offsets, offsets[group] + PIECE, "right")) - 1)
                    a, b = int(offsets[group]), int(offsets[last])
                    for cut in range(a, b, PIECE):
                        stop = min(b, cut + PIECE + length - 1)
                        if cut > a and stop - cut < length:
                            break
                        bounds = offsets[group : last + 1] - a if last > group + 1 else np.array([0, stop - cut])
                        found = window_anchors(raw[cut:stop], bounds, length, gram, rolling)
                        if len(found[0]):
                            which = np.searchsorted(bounds, found[2], "right") - 1
                            shift = bounds[which] - (cut - a if last == group + 1 else 0)
                            names = pa.array(docs[group:last], pa.binary()).take(pa.array(which))
                            g, place, lo, hi, c1, c2 = found
                            keep, runs = within_documents(which, g, c1, c2, lo, hi + length)
                            columns = [pa.array(g), names, *(pa.array(x - shift) for x in (place, lo, hi)), pa.array(c1), pa.array(c2)]
                            yield pa.RecordBatch.from_arrays(columns, COLUMNS).filter(pa.array(keep))
                            if len(runs[0]):
                                at, start, end = runs
                                move, none = shift[at], pa.nulls(len(at), pa.int64())
                                yield pa.RecordBatch.from_arrays([none, names.take(pa.array(at)), none, pa.array(start - move), pa.array(end - move), none, none], COLUMNS)
                    group = last

    return texts.mapInArrow(run, "gram bigint, doc binary, place bigint, lo bigint, hi bigint, c1 bigint, c2 bigint")


class SuffixOrder:
    """Mergesort of suffixes in groups; comparisons by common extension."""

    def __init__(self, raw: np.ndarray, length: int):
        self.raw, self.length, self.rolling = raw, length, PrimeHash(23)
        self.prefixes = self.rolling.prefixes(raw)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common extension of the suffixes at a and b, at most length."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.length, np.int64)
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            x, y = a[open_], b[open_]
            mid = (low[open_] + high[open_] + 1) >> 1
            same = self.rolling.slices(self.prefixes, x, x + mid) == self.rolling.slices(self.prefixes, y, y + mid)
            low[open_[same]] = mid[same]
            high[open_[~same]] = mid[~same] - 1

    def after(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 as the suffix at a stands before, with or after that at b."""
        e = self.extension(a, b)
        whole = e == self.length
        e = np.where(whole, 0, e)
        return np.where(whole, 0, np.sign(self.raw[a + e].astype(np.int16) - self.raw[b + e].astype(np.int16)))

    def sort(self, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Indexes that sort starts by (group, suffix). group: non-decreasing."""
        n = len(starts)
        # Runs of one group are presorted by their first eight bytes; suffixes that still tie are merged by comparisons.
        lead = np.zeros(n, np.uint64)
        for i in range(8):
            lead = (lead << np.uint64(8)) | self.raw[starts + i].astype(np.uint64)
        order = np.lexsort((lead, group))
        tie = np.cumsum(np.r_[False, (lead[order][1:] != lead[order][:-1]) | (group[order][1:] != group[order][:-1])])
        head = np.flatnonzero(np.r_[True, tie[1:] != tie[:-1]])
        sizes = np.diff(np.r_[head, n])
        base, size = np.repeat(head, sizes), np.repeat(sizes, sizes)
        local = np.arange(n) - base
        width = 1
        while width < (sizes.max() if n else 0):
            left = local // (2 * width) * 2 * width
            middle, end = np.minimum(left + width, size), np.minimum(left + 2 * width, size)
            move = np.flatnonzero(middle < end)  # elements of pairs of runs
            l, m, e = (base[move] + x[move] for x in (left, middle, end))
            in_left = move < m
            lo, hi = np.where(in_left, m, l), np.where(in_left, e, m)
            own = starts[order[move]]
            while True:  # the rank of each element in the other run, left ones before equal right ones
                open_ = np.flatnonzero(lo < hi)
                if not len(open_):
                    break
                mid = (lo[open_] + hi[open_]) >> 1
                c = self.after(starts[order[mid]], own[open_])
                smaller = np.where(in_left[open_], c < 0, c <= 0)
                lo[open_[smaller]] = mid[smaller] + 1
                hi[open_[~smaller]] = mid[~smaller]
            target = np.where(in_left, move + (lo - m), move - (m - lo))
            new = order.copy()
            new[target] = order[move]
            order = new
            width *= 2
        return order


def repeated_windows(raw: np.ndarray, bounds: np.ndarray, group: np.ndarray, lo: np.ndarray, hi: np.ndarray, place: np.ndarray, length: int) -> np.ndarray:
    """For contexts (bytes raw[bounds[i]:bounds[i+1]], window starts lo..hi of an anchor at place, in groups of one gram): whether
    each window, context after context, equals one of another context of its group."""
    counts = hi - lo + 1
    context = np.repeat(np.arange(len(lo)), counts)
    step = np.arange(len(context)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = bounds[context] + step
    before = place[context] - lo[context] - step  # distance to the anchor
    key = group[context] * np.int64(length + 1) + before + length  # one group for each gram and distance
    by_key = np.argsort(key, kind="stable")
    starts, key, context = starts[by_key], key[by_key], context[by_key]
    sorter = SuffixOrder(raw, length)
    lone = np.r_[True, key[1:] != key[:-1]] & np.r_[key[1:] != key[:-1], True]
    rest = np.flatnonzero(~lone)
    out = np.zeros(len(by_key), bool)
    if len(rest):
        order = rest[sorter.sort(starts[rest], key[rest])]
        a, b = order[:-1], order[1:]
        near = np.flatnonzero(key[a] == key[b])
        a, b = a[near], b[near]
        equal = sorter.extension(starts[a], starts[b]) == length
        a, b = a[equal], b[equal]
        # Collision check: the equal windows of two contexts at one alignment are neighbours; each such stretch is compared once.
        shift = starts[a] - starts[b]
        o = np.lexsort((starts[a], shift))
        a, b, shift = a[o], b[o], shift[o]
        cut = np.flatnonzero(np.r_[True, (shift[1:] != shift[:-1]) | (np.diff(starts[a]) != 1)]) if len(a) else np.zeros(0, np.int64)
        for i, j in zip(cut, [*cut[1:], len(a)], strict=False):
            x, y, size = starts[a[i]], starts[b[i]], j - i + length - 1
            if np.array_equal(raw[x : x + size], raw[y : y + size]):
                out[a[i:j]] = out[b[i:j]] = True
            else:
                for q in range(i, j):
                    if np.array_equal(raw[starts[a[q]] : starts[a[q]] + length], raw[starts[b[q]] : starts[b[q]] + length]):
                        out[a[q]] = out[b[q]] = True
    back = np.zeros(len(out), bool)
    back[by_key] = out
    return back


def contexts(places: DataFrame, texts: DataFrame) -> DataFrame:
    """gram, doc, place, lo, hi, lone, hot, bytes from places (row, doc, list of (gram, place, lo, hi, end, lone, hot)) and texts (row,
    doc, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text, found in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                raw, cut = (text or "").encode(), [*zip(*((x["gram"], doc, x["place"], x["lo"], x["hi"], x["lone"], x["hot"], (x["lo"], x["end"])) for x in found), strict=True)]
                pieces = [raw[a:b] for a, b in cut[7]]
                kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(cut[:7], kinds, strict=True)), pa.array(pieces, pa.binary())], ["gram", "doc", "place", "lo", "hi", "lone", "hot", "bytes"])

    joined = texts.join(places, ["row", "doc"]).select("doc", "text", "places")
    return joined.mapInArrow(run, "gram bigint, doc binary, place bigint, lo bigint, hi bigint, lone boolean, hot boolean, bytes binary")


def sorted_runs(rows: DataFrame, length: int, most: int = 2 << 20) -> DataFrame:
    """doc, start, end: the covered runs of lone contexts. Rows come sorted by gram; whole grams are worked on together, about `most`
    bytes at a time."""

    def work(held: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        t = pa.Table.from_batches(held).combine_chunks()
        gram, place, lo, hi = (t[c].to_numpy() for c in ("gram", "place", "lo", "hi"))
        raw, bounds = text_bytes(t["bytes"].combine_chunks() if isinstance(t["bytes"], pa.ChunkedArray) and t["bytes"].num_chunks != 1 else t["bytes"].chunk(0))
        group = np.cumsum(np.r_[0, gram[1:] != gram[:-1]]).astype(np.int64)
        hit = repeated_windows(raw, bounds, group, lo, hi, place, length)
        counts = hi - lo + 1
        context = np.repeat(np.arange(len(lo)), counts)
        hit &= t["lone"].to_numpy(zero_copy_only=False)[context]
        at = np.flatnonzero(hit)
        if not len(at):
            return None
        start = lo[context[at]] + at - (np.cumsum(counts) - counts)[context[at]]
        head = np.flatnonzero(np.r_[True, (np.diff(at) > 1) | (context[at][1:] != context[at][:-1])])
        tail = np.r_[head[1:], len(at)] - 1
        docs = t["doc"].take(pa.array(context[at[head]])).combine_chunks()
        return pa.RecordBatch.from_arrays([docs.chunk(0) if isinstance(docs, pa.ChunkedArray) else docs, pa.array(start[head]), pa.array(start[tail] + length)], ["doc", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size < most:
                continue
            gram = batch.column(0).to_numpy()
            cut = int(np.searchsorted(gram, gram[-1]))  # the last gram may go on in the next batch
            if cut:
                held[-1] = batch.slice(0, cut)
                if (out := work(held)) is not None:
                    yield out
                held, size = [batch.slice(cut)], batch.nbytes * (batch.num_rows - cut) // batch.num_rows
        if held and sum(b.num_rows for b in held) and (out := work(held)) is not None:
            yield out

    return rows.mapInArrow(run, "doc binary, start bigint, end bigint")


def hashed_windows(rows: DataFrame, length: int) -> DataFrame:
    """doc, place, start, lone, h1, h2: each window of the contexts with the digest of its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                doc, place, lo, hi, lone, pieces = batch.slice(i, 256).columns
                raw, bounds = text_bytes(pieces)
                lo = lo.to_numpy()
                counts = hi.to_numpy() - lo + 1
                context = np.repeat(np.arange(len(lo)), counts)
                step = np.arange(len(context)) - np.repeat(np.cumsum(counts) - counts, counts)
                at = bounds[context] + step
                take = pa.array(context)
                yield pa.RecordBatch.from_arrays([doc.take(take), place.take(take), pa.array(lo[context] + step), lone.take(take), *map(pa.array, digests(raw, at, at + length))], ["doc", "place", "start", "lone", "h1", "h2"])

    return rows.select("doc", "place", "lo", "hi", "lone", "bytes").mapInArrow(run, "doc binary, place bigint, start bigint, lone boolean, h1 bigint, h2 bigint")


def counted_runs(rows: DataFrame, length: int) -> DataFrame:
    """doc, start, end: the covered runs of lone contexts, as sorted_runs gives them, for grams of any number of contexts."""
    windows = hashed_windows(rows, length)
    repeated = windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h1", "h2")
    hit = windows.filter("lone").join(repeated, ["h1", "h2"], "left_semi")
    run = F.col("start") - F.row_number().over(Window.partitionBy("doc", "place").orderBy("start"))
    return hit.withColumn("run", run).groupBy("doc", "place", "run").agg(F.min("start").alias("start"), (F.max("start") + length).alias("end")).select("doc", "start", "end")


def repeated_runs(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> tuple[DataFrame, list[DataFrame]]:
    """doc, start, end of covered runs (not joined yet) of a table (row, text, doc) of texts, each distinct text counting once; and the
    stored tables that they are read from."""
    rows = stored(anchors(texts.select("text"), length, gram), "anchors")
    inside = rows.filter("gram is null").select("doc", F.col("lo").alias("start"), F.col("hi").alias("end"))
    found = rows.filter("gram is not null")
    spot = F.struct("doc", "place")
    repeated = found.groupBy("gram").agg(F.min(spot).alias("lo_"), F.max(spot).alias("hi_")).filter("lo_ < hi_").select("gram")
    classes = found.join(repeated, "gram", "left_semi").groupBy("gram", "c1", "c2").agg(F.min(F.struct("doc", "place", "lo", "hi")).alias("x"), F.max(spot).alias("last"))
    classes = stored(classes.withColumn("lone", (F.col("x.doc") == F.col("last.doc")) & (F.col("x.place") == F.col("last.place"))), "context-classes", release=True)
    whole = found.join(classes.filter("not lone").select("gram", "c1", "c2"), ["gram", "c1", "c2"], "left_semi").select("doc", F.col("lo").alias("start"), (F.col("hi") + length).alias("end"))
    unsure = classes.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.max("lone").alias("any_lone")).filter("n > 1 and any_lone").select("gram", (F.col("n") > HOT).alias("hot"))
    asked = classes.join(unsure, "gram").select(F.col("x.doc").alias("doc"), F.struct("gram", "x.place", "x.lo", "x.hi", (F.col("x.hi") + length).alias("end"), "lone", "hot").alias("p"))
    places = asked.groupBy("doc").agg(F.collect_list("p").alias("places")).join(texts.groupBy("doc").agg(F.min("row").alias("row")), "doc")
    # A place beside the border of two pieces of a text has two rows, with windows of its own each: lo and hi tell them apart.
    # Stored, so that the texts' shuffle can go before the contexts are dealt out.
    cut = stored(contexts(places, texts.select("row", "doc", "text")).dropDuplicates(["gram", "doc", "place", "lo", "hi"]), "context-bytes", release=True)
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = sorted_runs(cut.filter("not hot").repartition(n, "gram").sortWithinPartitions("gram"), length)
    return whole.unionByName(edges).unionByName(counted_runs(cut.filter("hot"), length)).unionByName(inside), [rows, classes, cut]


def cut_out(rows: DataFrame) -> DataFrame:
    """doc, n_removed, n_spans, kept (binary) from (doc, text, runs list of (start, end))."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for text, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw = (text or "").encode()
                kept, at, removed, spans, end = [], 0, 0, 0, -1
                for a, b in sorted((x["start"], x["end"]) for x in runs):
                    if a > end:
                        if end >= 0:
                            removed += end - at
                        kept.append(raw[max(end, 0) : a])
                        spans, at = spans + 1, a
                    end = max(end, b)
                if end >= 0:
                    removed += end - at
                kept.append(raw[max(end, 0) :])
                out.append((removed, spans, b"".join(kept)))
            n, spans, kept = zip(*out, strict=True)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], ["doc", "n_removed", "n_spans", "kept"])

        return work

    return map_batches(rows.select("doc", "text", "runs"), make, "doc binary, n_removed bigint, n_spans bigint, kept binary")


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, digests: bool = False) -> DataFrame:
    """key, n_bytes, n_removed, n_spans (longs) for each row, and what is left of it: kept (binary), or with digests=True its
    SHA-256 alone, kept_sha256."""
    small_batches(df.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    sha = F.sha2(body.cast("binary"), 256)
    row = F.coalesce(F.col(key).cast("bigint"), F.lit(-(1 << 63)))
    texts = df.select(row.alias("row"), body.alias("text"), F.unhex(F.substring(sha, 1, 32)).alias("doc"))
    small = stored(df.select(F.col(key).alias("_key"), row.alias("row"), sha.alias("sha"), F.unhex(F.substring(sha, 1, 32)).alias("doc"), F.octet_length(body).cast("bigint").alias("n_bytes")), "digests")
    counts = small.groupBy("doc").agg(F.count(F.lit(1)).alias("copies"), F.min("row").alias("row"))
    found, used = repeated_runs(texts.filter(F.octet_length("text") >= length), length, gram)
    covered = stored(found, "covered-runs", release=True)
    discard(*used)
    runs = covered.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    single = runs.join(counts.filter("copies = 1").select("doc", "row"), "doc")
    cut = cut_out(texts.join(single, ["row", "doc"]))
    cut = cut.select("doc", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")) if digests else cut
    last = "kept_sha256" if digests else "kept"
    found = stored(cut, "cut-texts", release=True)
    discard(covered)
    copied = counts.filter("copies > 1").select("doc", F.lit(True).alias("copied"))
    whole = F.coalesce("copied", F.lit(False)) & (F.col("n_bytes") >= length)
    joined = small.join(copied, "doc", "left").join(found, "doc", "left")
    head = [F.col("_key").alias(key), "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"), F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans")]
    if digests:
        return joined.select(*head, F.when(whole, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce(last, "sha")).alias(last))
    original = texts.groupBy("doc").agg(F.first(F.col("text").cast("binary")).alias("original"))
    return joined.join(original, "doc", "left").select(*head, F.when(whole, F.lit(b"")).otherwise(F.coalesce(last, "original")).alias(last))
