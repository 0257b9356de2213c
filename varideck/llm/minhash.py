"""Near-duplicates by bottom-k sketches from one hash function.

A document's set holds the 64-bit hashes of its distinct shingles; its sketch is the k least of them. Documents with equal sets form
one class at once. Classes meet through inverted lists of retained values: two sets with the asked similarity share at least t of
their retained values (exactly so while the sketch is the whole set, else but for one case in 10^6 at the very bound), so each class enters only the
lists of its |sketch| - t + 1 rarest values; frequent values are never expanded. Pairs pass the size bound, then the estimate from
the sketch of the union, then the exact similarity on the full sets.

Long lists aren't expanded into all pairs at once: first every class meets the class of its list with the fewest values of its own
(of a group of copies, the one that the others were made from or the nearest to it); after the verified links are merged into
components, only pairs of a list whose components still differ, and whose sizes and own values allow a link, are compared; within
a large group that is done in blocks of sketches, the few classes outside its component against all. So no link between components
is lost, and large groups of near copies cost rows about in proportion to their size.

Defined cases: a document without words (null, empty) has an empty set and links with nothing; one with fewer words than a shingle
has one shingle, its whole sequence; rows that share an id count as linked; a row with a null id takes part through its set but is
always kept; empty tables give empty ones; other columns are dropped, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, discard, hash_words, map_batches, mixed, slices, stored, text_bytes, words_of
from .components import connected_components

#: Estimates below the asked similarity by this many deviations are dropped before the exact check.
DEVIATIONS = 4.8
#: At most so many lists can each hold more than this part of all entries.
HOT_LISTS = 1024
HOT_LEAST = 1 << 12


def shingle_sets(column: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct 63-bit shingle hashes of each text. A-Z counts as a-z; words are runs without ASCII white space."""
    raw, offsets = text_bytes(column)
    raw = LOWER[raw]
    starts, ends, first = words_of(raw, offsets)
    one = hash_words(raw, starts, ends, 7)
    with np.errstate(over="ignore"):
        grams = np.full(max(0, len(one) - words + 1), words, np.uint64)
        for j in range(words):
            grams = mixed(grams * np.uint64(0xD6E8FEB86659FD93) + one[j : j + len(grams)])
        grams >>= np.uint64(1)
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= words:
                got = np.sort(grams[a : b - words + 1])
                out.append(got[np.r_[True, got[1:] != got[:-1]]])
            elif b > a:
                whole = np.full(1, words * 1000 + b - a, np.uint64)
                for x in one[a:b]:
                    whole = mixed(whole * np.uint64(0xD6E8FEB86659FD93) + x)
                out.append(whole >> np.uint64(1))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def least_shared(k: int, similarity: float, error: float = 1e-6) -> int:
    """The largest t such that at least t of k retained values are shared, but for a chance of `error`, at this similarity."""
    tail, t = 0.0, 0
    while t < k:
        tail += comb(k, t) * similarity**t * (1 - similarity) ** (k - t)
        if tail > error:
            break
        t += 1
    return max(1, t)


def sketches(df: DataFrame, key: str, text: str, words: int, k: int, most: int) -> DataFrame:
    """key, n (size of the set), d1, d2 (digest of the set), sketch (its k least hashes, sorted; a set up to `most` is kept whole)."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [x for part in slices(batch.column(1)) for x in shingle_sets(part, words)]
            n = np.fromiter(map(len, sets), np.int64, len(sets))
            with np.errstate(over="ignore"):
                digests = [np.array([mixed(x + np.uint64(salt)).sum(dtype=np.uint64) for x in sets], np.uint64).view(np.int64) for salt in (11, 1 << 40)]
            low = [x if len(x) <= most else x[:k] for x in sets]
            at = np.cumsum([0, *map(len, low)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(low).view(np.int64)))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), *map(pa.array, digests), lists], ["key", "n", "d1", "d2", "sketch"])

        return work

    return map_batches(df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")), make, "key bigint, n bigint, d1 bigint, d2 bigint, sketch array<bigint>")


def full_sets(df: DataFrame, words: int) -> DataFrame:
    """key, shingles array<bigint> of (key, text)."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [x for part in slices(batch.column(1)) for x in shingle_sets(part, words)]
            at = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(sets).view(np.int64)))], ["key", "shingles"])

        return work

    return map_batches(df.select("key", "text"), make, "key bigint, shingles array<bigint>")


def whole_below(k: int, similarity: float) -> int:
    """Sets up to this size are retained whole: partners of sets up to k / similarity are never sketched on one side alone."""
    return int(3.2 * k)


LIST = ["value", "whole"]


def by_list(rows: DataFrame, lists: DataFrame, how: str = "inner") -> DataFrame:
    """rows (value, whole, hot, ...) joined with a table of one row a list (value, whole, hot, ...). There are at most HOT_LISTS hot lists,
    so their rows are broadcast; the others are short of what one task can hold, and shuffled."""
    keys = [*LIST, "hot"]
    return rows.filter("hot").join(F.broadcast(lists.filter("hot")), keys, how).unionByName(rows.filter("not hot").join(lists.filter("not hot"), keys, how))


def rare_entries(classes: DataFrame, k: int, percent: int) -> DataFrame:
    """value, key, n, own, whole, hot: each class (key, n, sketch) in the inverted lists of its rarest retained values that others retain
    too; own: how many of its values no other class retains; hot: whether the list holds more than a HOT_LISTS-th of all entries.

    Sets of at most whole_below values meet by all their values (whole), larger ones and those that can match larger ones by their
    k least values; each kind has lists of its own, so every pair that can reach the similarity meets in one kind."""
    p, most = percent / 100, whole_below(k, percent / 100)
    kinds = [
        (F.col("n") <= most, F.lit(True), F.col("sketch")),
        (F.col("n") >= int(p * most), F.lit(False), F.slice("sketch", 1, k)),
    ]
    entries = None
    for where, whole, values in kinds:
        some = classes.filter(where).select("key", "n", whole.alias("whole"), F.explode(values).alias("value"))
        entries = some if entries is None else entries.union(some)
    held = F.sum(F.when(F.col("n") <= most, F.col("n")).otherwise(0) + F.when(F.col("n") >= int(p * most), F.least("n", F.lit(k))).otherwise(0))
    bound = max(HOT_LEAST, -(-(classes.agg(held.alias("c")).first().c or 0) // HOT_LISTS))
    lists = entries.groupBy(*LIST).agg(F.count(F.lit(1)).alias("_lists")).filter("_lists > 1").withColumn("hot", F.col("_lists") > bound)
    hot = F.broadcast(lists.filter("hot"))
    listed = entries.join(hot, LIST).unionByName(entries.join(hot.select(*LIST), LIST, "left_anti").join(lists.filter("not hot"), LIST))
    held = F.when(F.col("whole"), F.col("n")).otherwise(F.lit(k))
    t = F.when(F.col("whole"), F.ceil(F.col("n") * percent / 100)).otherwise(least_shared(k, p))
    own = held - F.size("_all")
    # Values that no other class retains are the rarest; they use up places of the prefix without needing a list.
    places = held - t + 1 - own
    chosen = listed.groupBy("key", "n", "whole").agg(F.array_sort(F.collect_list(F.struct("_lists", "value", "hot"))).alias("_all"))
    chosen = chosen.withColumn("own", own.cast("bigint")).withColumn("_places", places.cast("int")).filter("_places > 0")
    return chosen.select("key", "n", "own", "whole", F.explode(F.slice("_all", F.lit(1), F.col("_places"))).alias("_e")).select(F.col("_e.value").alias("value"), "key", "n", "own", "whole", F.col("_e.hot").alias("hot"))


def verified(pairs: DataFrame, classes: DataFrame, texts: DataFrame, words: int, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 |A and B| >= percent |A or B|."""
    side = lambda x: classes.select(F.col("key").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    seen = pairs.join(side("a"), "a").join(side("b"), "b")
    p = percent / 100
    both_whole = F.greatest("na", "nb") <= whole_below(k, p)
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, k)
    shared = F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
    slack = DEVIATIONS * (p * (1 - p)) ** 0.5 / F.sqrt(F.size(union))
    inter = F.size(F.array_intersect("sa", "sb"))
    exact = 100 * inter >= percent * (F.col("na") + F.col("nb") - inter)
    likely = stored(seen.filter(F.when(both_whole, exact).otherwise(shared / F.size(union) >= p - slack)).select("a", "b", both_whole.alias("sure")), "likely-pairs", release=True)
    open_ = likely.filter("not sure").select("a", "b")
    needed = open_.select(F.col("a").alias("key")).union(open_.select(F.col("b").alias("key"))).distinct()
    sets = full_sets(texts.join(needed, "key", "left_semi"), words)
    sets = stored(sets.dropDuplicates(["key"]), "full-sets", release=True)
    joined = open_.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("xa")), "a").join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("xb")), "b")
    inter = F.size(F.array_intersect("xa", "xb"))
    found = joined.filter(100 * inter >= percent * (F.size("xa") + F.size("xb") - inter)).select("a", "b")
    links = stored(likely.filter("sure").select("a", "b").union(found), "verified-pairs", release=True)
    discard(likely, sets)
    return links


def with_homes(placed: DataFrame) -> DataFrame:
    """placed and home: the component that most often prevails in the lists of a class (its own, where it is of a large group)."""
    in_list = placed.groupBy(*LIST, "hot", "c").agg(F.count(F.lit(1)).alias("_n"))
    prevails = in_list.groupBy(*LIST, "hot").agg(F.max(F.struct("_n", "c")).alias("_m")).select(*LIST, "hot", F.col("_m.c").alias("_c"))
    votes = by_list(placed, prevails).groupBy("key", "whole", "_c").agg(F.count(F.lit(1)).alias("_n"))
    homes = votes.groupBy("key", "whole").agg(F.max(F.struct("_n", "_c")).alias("_m")).select("key", "whole", F.col("_m._c").alias("home"))
    return stored(placed.join(homes, ["key", "whole"]), "homes", release=True)


BLOCK = 128
PACK = "array<struct<key:bigint,c:bigint,n:bigint,sketch:array<bigint>>>"


def pairs_at_home(placed: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b) of one home and different components that may reach the similarity. Those outside the home's component are compared
    with all of the home, in blocks of about BLOCK sketches, so that only likely pairs become rows."""
    some = placed.select("key", "whole", "c", "home").distinct()
    size = some.groupBy("home", "whole").agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("c") != F.col("home")).alias("_out")).filter("_out > 0 and _n > 1")
    some = some.join(size, ["home", "whole"]).join(classes.select("key", "n", "sketch"), "key")
    some = some.withColumn("sketch", F.when(F.col("whole"), F.col("sketch")).otherwise(F.slice("sketch", 1, k)))

    def packs(rows: DataFrame, count: str, name: str) -> DataFrame:
        block = F.pmod(F.xxhash64("key"), F.ceil(F.col(count) / BLOCK))
        return rows.groupBy("home", "whole", block.alias("_b")).agg(F.collect_list(F.struct("key", "c", "n", "sketch")).alias(name)).drop("_b")

    met = packs(some.filter("c <> home"), "_out", "outside").join(packs(some, "_n", "members"), ["home", "whole"]).select("whole", "outside", "members")
    least = least_shared(k, percent / 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                whole = batch.column(0)[i].as_py()
                sides = []
                for column in batch.columns[1:]:
                    part = column[i].values
                    lists = part.field("sketch")
                    at = np.asarray(lists.offsets).astype(np.int64)
                    sides.append((*(np.asarray(part.field(x)) for x in ("key", "c", "n")), at - at[0], np.asarray(lists.values)[at[0] : at[-1]]))
                a, b = likely_of_blocks(*sides, whole, least, percent)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return met.mapInArrow(run, "a bigint, b bigint")


def likely_of_blocks(outside: tuple, members: tuple, whole: bool, least: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of pairs of different components that share enough retained values (of whole sets: that have the similarity)."""
    (ka, ca, na, ata, va), (kb, cb, nb, atb, vb) = outside, members
    values = np.unique(va)
    left = np.zeros((len(ka), len(values)), np.float32)
    left[np.repeat(np.arange(len(ka)), np.diff(ata)), np.searchsorted(values, va)] = 1
    at = np.minimum(np.searchsorted(values, vb), max(0, len(values) - 1))
    known = values[at] == vb if len(values) else np.zeros(len(vb), bool)
    right = np.zeros((len(kb), len(values)), np.float32)
    right[np.repeat(np.arange(len(kb)), np.diff(atb))[known], at[known]] = 1
    shared = np.rint(left @ right.T).astype(np.int64)
    enough = 100 * shared >= percent * (na[:, None] + nb[None, :] - shared) if whole else shared >= least
    i, j = np.nonzero(enough & (ca[:, None] != cb[None, :]))
    return ka[i], kb[j]


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80, k: int = 64) -> DataFrame:
    """key, n_shingles long, component_id long (the least key reachable over links), kept boolean."""
    rows = stored(sketches(df, key, text, words, k, whole_below(k, percent / 100)), "sketches")
    sets = ["n", "d1", "d2"]
    members = rows.filter("n > 0").groupBy(*sets).agg(F.min("key").alias("rep"))
    first = rows.filter("key is not null and n > 0").join(members.select(*sets, F.col("rep").alias("key")), [*sets, "key"], "left_semi")
    classes = stored(first.dropDuplicates(["key", *sets]).select("key", "n", "d1", "d2", "sketch"), "classes", release=True)
    lists = stored(rare_entries(classes, k, percent), "inverted-lists", release=True)
    keys = df.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"))
    texts = keys.join(classes.select("key"), "key", "left_semi")

    def fits(x: str, y: str) -> Column:
        """What sizes and lone values allow: |A and B| has to reach percent / (100 + percent) of |A| + |B|."""
        n, m = F.col(f"{x}n"), F.col(f"{y}n")
        most = F.least(n - F.col(f"{x}own"), m - F.col(f"{y}own"))
        return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (~F.col(f"{x}whole") | ((100 + percent) * most >= percent * (n + m)))

    heads = lists.groupBy(*LIST, "hot").agg(F.min(F.struct("own", "key", "n")).alias("h"))  # the class with the fewest values of its own
    heads = heads.select(*LIST, "hot", F.col("h.own").alias("hown"), F.col("h.key").alias("hkey"), F.col("h.n").alias("hn"), F.col("whole").alias("hwhole"))
    star = by_list(lists, heads).filter((F.col("key") != F.col("hkey")) & fits("", "h"))
    tried = stored(star.select(F.least("key", "hkey").alias("a"), F.greatest("key", "hkey").alias("b")).distinct(), "star-pairs", release=True)
    links = verified(tried, classes, texts, words, k, percent)
    parts = stored(connected_components(links), "components")

    placed = lists.join(parts, lists.key == parts.node, "left").select(*LIST, "hot", "key", "n", "own", F.coalesce("component", "key").alias("c"))
    open_lists = placed.groupBy(*LIST, "hot").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select(*LIST, "hot")
    opened = stored(by_list(placed, open_lists, "left_semi"), "open-lists", release=True)
    placed = with_homes(opened)
    l, r = (placed.select(*(F.col(x).alias(s + x) for x in ("value", "key", "n", "own", "whole", "c", "home"))) for s in "lr")
    met = l.join(r, (F.col("lvalue") == F.col("rvalue")) & (F.col("lwhole") == F.col("rwhole")) & (F.col("lkey") < F.col("rkey")) & (F.col("lc") != F.col("rc")) & (F.col("lhome") != F.col("rhome")) & fits("l", "r"))
    met = met.select(F.col("lkey").alias("a"), F.col("rkey").alias("b")).union(pairs_at_home(placed, classes, k, percent))
    rest = met.distinct().join(tried, ["a", "b"], "left_anti")
    rest = stored(rest, "cross-pairs", release=True)
    discard(opened, placed, lists, tried)
    more = verified(rest, classes, texts, words, k, percent)
    parts = connected_components(links.union(more))
    discard(classes, links, rest, more)

    of_class = members.join(parts, members.rep == parts.node, "left").select(*sets, F.coalesce("component", "rep").alias("component_id"))
    placed_rows = rows.join(of_class, sets, "left").select("key", F.col("n").alias("n_shingles"), F.coalesce("component_id", "key").alias("component_id"))
    return placed_rows.select(F.col("key").alias(key), "n_shingles", "component_id", (F.col("key").isNull() | F.col("component_id").isNull() | (F.col("key") == F.col("component_id"))).alias("kept"))
