"""Merkle manifest of a dataset: digests of rows as leaves of a tree of three, one tree a group and one over the groups.

Where a leaf stands comes from bitmaps, not from sorting the leaves: every group has a bitmap of its ids, kept as its non-empty 64-bit
words (partial words of many tasks are merged by `or`), with a directory of popcounts above the words. A leaf's place is what the
directory counts before its word and the set bits before its own. The tree is then reduced by blocks of 3**LEVELS slots: a block is a
keyed array of slots, a task brings it to one node, and the blocks' nodes are the next round's slots. Paths go down the same way, a row
a block, so nothing ever holds a whole group.

Defined cases: null fields are written as "-"; a null group is a group of its own, before all others; null ids stand first in their
group and aren't tampered with; rows with the same id stand side by side, ordered by their leaf digest, so equal rows are
interchangeable; a group of one row has its leaf as subroot, a dataset of one group its subroot as root; the proof of a lone leaf is the
digest of nothing; an empty table gives no rows; columns besides the named ones are dropped, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbering import with_row_number
from .common import stored

#: Children of a node.
ARITY = 3
#: Levels that a block of slots is reduced by at once.
LEVELS = 6
BLOCK = ARITY**LEVELS
#: Bits of a word's number that each level of the popcount directory counts: words are 59 bits, so the last level has 17.
DIGITS = (10, 16, 16, 17)
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "g string, pos bigint, digest binary"
PATH = "g string, pos bigint, path string, subroot string, root string"


def leaf_text(fields: dict[str, Column]) -> Column:
    """What a leaf is the digest of: each field as its length in bytes, a colon and its value, or "-"."""
    parts = [F.coalesce(F.concat(F.octet_length(x.cast("string")).cast("string"), F.lit(":"), x.cast("string")), F.lit("-")) for x in fields.values()]
    return F.concat(*parts)


def group_key(group: str) -> Column:
    """A text that is never null and sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))


def tampered_with(key: str) -> Column:
    """The rows whose text loses its line ends: the CRC-32 of the id in decimals is even."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 2 == 0, F.lit(False))


def leaves(docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "source", text: str = "text") -> DataFrame:
    """g, id, leaf, tampered (the leaf after tampering, null where that changes nothing), and where the id stands in its group's bitmap:
    the word w (0 for null ids) and the bit. Whole texts are read here and never again."""
    whole = {x: F.col(x) for x in fields}
    digest = lambda f: F.unhex(F.sha2(leaf_text(f).cast("binary"), 256))
    changed = F.when(tampered_with(key) & F.col(text).contains("\n"), digest(whole | {text: F.replace(F.col(text), F.lit("\n"), F.lit(""))}))
    x = F.col(key).cast("bigint").bitwiseXOR(F.lit(-(1 << 63)))
    rows = docs.select(group_key(group).alias("g"), F.col(key).cast("bigint").alias("id"), digest(whole).alias("leaf"), changed.alias("tampered"), x.alias("_x"))
    w = F.coalesce(F.shiftrightunsigned("_x", 6) + 1, F.lit(0)).cast("bigint")
    return rows.withColumns({"w": w, "bit": F.coalesce(F.col("_x").bitwiseAND(63), F.lit(0)).cast("int")}).drop("_x")


def bitmap_words(rows: DataFrame) -> DataFrame:
    """g, w, bits, n: the non-empty words of each group's bitmap, and how many rows have ids in them. Tasks make partial words first."""
    return rows.groupBy("g", "w").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"), F.count(F.lit(1)).alias("n"))


def counted_before(entries: DataFrame, bits: int) -> DataFrame:
    """entries (g, k, n, ...) with before bigint: what the entries of smaller k that share k's higher digits hold. Each such set of
    entries, at most 2**bits, becomes an array of slots and is added up."""
    other = [f for f in entries.schema.fields if f.name not in ("g", "k", "n")]
    slots = 1 << bits
    lists = entries.groupBy("g", F.shiftrightunsigned("k", bits).alias("p")).agg(F.collect_list(F.struct("k", "n", *[f.name for f in other])).alias("e"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, (1 << 21) // slots)
        for whole in batches:
            for i in range(0, whole.num_rows, step):
                batch = whole.slice(i, step)
                e = batch.column(1)
                row = np.repeat(np.arange(len(e)), e.value_lengths().to_numpy(zero_copy_only=False))
                flat = e.flatten()
                columns = flat.flatten()
                k, n = columns[0].to_numpy(), columns[1].to_numpy()
                at = row * slots + (k & (slots - 1))
                table = np.zeros((len(e), slots), np.int64)
                table.ravel()[at] = n
                before = (np.cumsum(table, 1) - table).ravel()[at]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), *columns, pa.array(before)], ["g", "k", "n", *[f.name for f in other], "before"])

    more = "".join(f", {f.name} {f.dataType.simpleString()}" for f in other)
    return lists.select("g", "e").mapInArrow(run, f"g string, k bigint, n bigint{more}, before bigint")


def popcount_directory(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The words with before bigint, the rows of the group in smaller words; and each group's number of rows (g, n)."""
    totals, level = [], words.withColumnRenamed("w", "k")
    for bits in DIGITS:
        totals.append((bits, level))
        level = level.groupBy("g", F.shiftrightunsigned("k", bits).alias("k")).agg(F.sum("n").alias("n"))
    sizes = level.groupBy("g").agg(F.sum("n").alias("n"))
    above = None
    for bits, entries in reversed(totals):
        counted = counted_before(entries, bits)
        if above is not None:
            up = above.select(F.col("g").alias("_g"), F.col("k").alias("_p"), F.col("before").alias("_up"))
            counted = counted.join(up, (F.col("g") == F.col("_g")) & (F.shiftrightunsigned("k", bits) == F.col("_p"))).withColumn("before", F.col("before") + F.col("_up")).drop("_g", "_p", "_up")
        above = counted
    return above.withColumnRenamed("k", "w"), sizes


def placed_leaves(rows: DataFrame, words: DataFrame) -> DataFrame:
    """g, pos, id, leaf, tampered: rank queries. Only rows that share an id with others need an order of their own."""
    single = F.col("n") == F.bit_count("bits")
    rank = F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not(F.expr("shiftleft(-1L, bit)"))))
    columns = ["g", "pos", "id", "leaf", "tampered"]
    placed = rows.join(words.filter(single), ["g", "w"]).withColumn("pos", F.col("before") + rank).select(columns)
    repeated = words.filter(~single)
    if repeated.isEmpty():
        return placed
    shared = rows.join(repeated.select("g", "w", "before"), ["g", "w"])
    # Equal rows differ in this number alone, which spreads a hot id over ranges.
    spread = F.monotonically_increasing_id()
    numbered = with_row_number(shared.withColumn("_s", spread), [F.col(x) for x in ("g", "w", "bit", "leaf", "_s")], "_all")
    first = numbered.groupBy("g", "w").agg(F.min("_all").alias("_first"))
    return placed.unionByName(numbered.join(first, ["g", "w"]).withColumn("pos", F.col("before") + F.col("_all") - F.col("_first")).select(columns))


def hashed(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def climb(nodes: list[str], whole: bool) -> list[list[str]]:
    """The levels of a block from its slots to its one node: all that its group has left (whole), or exactly LEVELS."""
    levels = [nodes]
    while len(levels[-1]) > 1 if whole else len(levels) <= LEVELS:
        below = levels[-1]
        levels.append([hashed(*below[i : i + ARITY]) for i in range(0, len(below), ARITY)])
    return levels


def siblings(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    """What stands left and right of slot i's ancestors in their runs, level by level."""
    out = []
    for level in levels[:-1]:
        run = i - i % ARITY
        out.append(("".join(level[run:i]), "".join(level[i + 1 : run + ARITY])))
        i //= ARITY
    return out


def write_path(path: list[tuple[str, str]]) -> str:
    return ";".join(f"{a},{b}" for a, b in path)


def read_path(path: str) -> list[tuple[str, str]]:
    return [tuple(x.split(",")) for x in path.split(";")] if path else []


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for left, right in path:
        leaf = hashed(left, leaf, right)
    return leaf


def proof(path: list[tuple[str, str]]) -> str:
    """The digest of all siblings, level by level, left to right."""
    return hashed(*(x for pair in path for x in pair))


def _slots(column: pa.Array) -> Iterator[list[list]]:
    """The fields of each row's slots, in the slots' order: a list<struct<slot, ...>> whose slots are 0, 1, 2 and so on."""
    fields = [x.to_pylist() for x in column.flatten().flatten()]
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)).tolist()
    for a, b in zip([0, *ends], ends, strict=False):
        made = [[None] * (b - a) for _ in fields[1:]]
        for at, slot in enumerate(fields[0][a:b], a):
            for x, values in zip(made, fields[1:], strict=True):
                x[slot] = values[at]
        yield made


def blocks(nodes: DataFrame, sizes: DataFrame, *more: str) -> DataFrame:
    """g, b, whole, slots: arrays of up to BLOCK nodes. nodes: g, pos, digest and more; sizes: g, n, the group's number of nodes."""
    sized = sizes.select("g", (F.col("n") <= BLOCK).alias("whole"))
    slot = F.struct((F.col("pos") % BLOCK).cast("int").alias("slot"), "digest", *more)
    return nodes.groupBy("g", F.floor(F.col("pos") / BLOCK).cast("bigint").alias("b")).agg(F.collect_list(slot).alias("slots")).join(sized, "g")


def reduced(made: DataFrame) -> DataFrame:
    """The node of each block: the next round's slots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tops = [bytes.fromhex(climb([d.hex() for d in x[0]], whole)[-1][0]) for whole, x in zip(batch.column(2).to_pylist(), _slots(batch.column(3)), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tops, pa.binary())], ["g", "pos", "digest"])

    return made.select("g", "b", "whole", "slots").mapInArrow(run, NODE)


def descended(made: DataFrame, above: DataFrame) -> DataFrame:
    """The path of each slot of the blocks, from the paths of the blocks (PATH columns, by g and pos)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            g, b, whole, _, path, subroot, root = (None if i == 3 else c.to_pylist() for i, c in enumerate(batch.columns))
            for k, x in enumerate(_slots(batch.column(3))):
                levels = climb([d.hex() for d in x[0]], whole[k])
                for i in range(len(x[0])):
                    rows.append((g[k], b[k] * BLOCK + i, ";".join(filter(None, (write_path(siblings(levels, i)), path[k]))), subroot[k], root[k]))
            names = ["g", "pos", "path", "subroot", "root"]
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    up = above.withColumnRenamed("pos", "b")
    return made.select("g", "b", "whole", "slots").join(up, ["g", "b"]).select("g", "b", "whole", "slots", "path", "subroot", "root").mapInArrow(run, PATH)


def rounds(made: DataFrame, sizes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each round from the given ones up, and the groups' last nodes (g, digest). As many rounds as the largest group needs:
    a smaller one passes its node on."""
    kept, most = [made], sizes.agg(F.max("n")).first()[0] or 0
    while True:
        tops = reduced(kept[-1])
        if most <= BLOCK:
            return kept, stored(tops.select("g", "digest"), "merkle-tops")
        most = -(-most // BLOCK)
        sizes = sizes.select("g", F.ceil(F.col("n") / BLOCK).cast("bigint").alias("n"))
        kept.append(stored(blocks(tops, sizes), "merkle-blocks"))


def path_down(kept: list[DataFrame], above: DataFrame) -> DataFrame:
    """The paths of the first round's blocks, from those of the groups' last nodes (pos 0)."""
    for made in reversed(kept[1:]):
        above = descended(made, above)
    return above


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, key: str = "doc_id", group: str = "source", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """blocks (g, b, whole, slots with each leaf's digest, id and tampered digest) and their paths to the root (PATH columns)."""
    rows = stored(leaves(docs, fields, key, group, text), "merkle-leaves")
    words, sizes = popcount_directory(stored(bitmap_words(rows), "merkle-words"))
    sizes = stored(sizes, "merkle-sizes")
    placed = placed_leaves(rows, stored(words, "merkle-directory"))
    first = stored(blocks(placed.withColumnRenamed("leaf", "digest"), sizes, "id", "tampered"), "merkle-blocks")
    kept, subroots = rounds(first, sizes)
    # The tree over the groups: their order is a number over ranges, and they are the slots of one group.
    ranked = stored(with_row_number(subroots, [F.col("g")], "pos"), "merkle-subroots")
    one = ranked.select(F.lit("").alias("g"), "pos", "digest")
    count = one.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    top_kept, root = rounds(stored(blocks(one, count), "merkle-blocks"), count)
    start = root.select("g", F.lit(0).cast("bigint").alias("pos"), F.lit("").alias("path"), F.lit("").alias("subroot"), F.lower(F.hex("digest")).alias("root"))
    paths = descended(top_kept[0], path_down(top_kept, start)).select("pos", "path", "root")
    above = ranked.withColumnRenamed("digest", "_d").join(paths, "pos").select("g", F.lit(0).cast("bigint").alias("pos"), "path", F.lower(F.hex("_d")).alias("subroot"), "root")
    return first, path_down(kept, stored(above, "merkle-groups"))


def audit(docs: DataFrame, key: str = "doc_id", **names) -> DataFrame:
    """key, leaf, subroot, root, proof_sha256, folded_root, verified: each row's leaf and proof, and whether the leaf of its tampered text
    (its own where nothing was changed) still leads to the root."""
    made, paths = manifest(docs, key=key, **names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            path, subroot, root = (c.to_pylist() for c in batch.columns[4:])
            whole = batch.column(2).to_pylist()
            for k, (digests, ids, tampered) in enumerate(_slots(batch.column(3))):
                nodes = [d.hex() for d in digests]
                levels, rest = climb(nodes, whole[k]), read_path(path[k])
                for i, leaf in enumerate(nodes):
                    way = siblings(levels, i) + rest
                    folded = fold(leaf if tampered[i] is None else tampered[i].hex(), way)
                    rows.append((ids[i], leaf, subroot[k], root[k], proof(way), folded, folded == root[k]))
            kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
            names = [key, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    joined = made.join(paths.withColumnRenamed("pos", "b"), ["g", "b"]).select("g", "b", "whole", "slots", "path", "subroot", "root")
    return joined.mapInArrow(run, f"`{key}` bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
