"""The Merkle manifest against a plain version."""

import zlib
from hashlib import sha256

import pytest

from varideck.llm import merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    return digest(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (*row[:4], text)))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        run = i // 3 * 3
        out.append((level[run:i], level[i + 1 : run + 3]))
        i //= 3
    return out


def plain(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf_of(r, r[4]), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for at, s in enumerate(names):
        for i, (_, _, leaf, r) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            way = path(trees[s], i) + path(top, at)
            even = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            folded = leaf_of(r, r[4].replace("\n", "")) if even and r[4] is not None else leaf
            for left, right in way:
                folded = digest(*left, folded, *right)
            out.append((r[0], leaf, trees[s][-1][0], top[-1][0], digest(*(x for a, b in way for x in a + b)), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def audited(spark, rows):
    return sorted(map(tuple, merkle.audit(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)


def test_equals_plain_version(spark):
    rows = [(i * i % 9973 * (-1) ** i, f"s{i % 3}", "en", i, f"text {i}\nline") for i in range(2500)]
    rows = list({r[0]: r for r in rows}.values())
    rows += [(5 << 40, None, None, None, None), (6, None, "ä", 1, ""), (-(1 << 63), "é", "de", 2, "a\n"), ((1 << 63) - 1, "é", "de", 2, "b\n"), (1, "", "x", 3, "\n")]
    assert audited(spark, rows) == plain(rows)


def test_large_groups_take_several_rounds(spark):
    rows = [(i, "hot", "en", i, f"{i}\n") for i in range(4 * merkle.BLOCK + 2)] + [(i, "one", "en", i, "x") for i in (3,)]
    assert audited(spark, rows) == plain(rows)


def test_repeated_and_null_ids(spark):
    rows = [(7, "a", "en", 1, "same\n")] * 5 + [(7, "a", "en", 1, "other\n"), (None, "a", "en", 1, "p\n"), (None, "a", "en", 1, "q\n"), (8, "a", None, None, None), (71, "a", "en", 1, "r")]
    assert audited(spark, rows) == plain(rows)


@pytest.mark.parametrize("rows", [[(4, "a", "en", 1, "x\ny")], [(4, "a", "en", 1, "x"), (4, None, "en", 1, "x")]])
def test_lone_leaves(spark, rows):
    assert audited(spark, rows) == plain(rows)


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.audit(empty).collect() == []
    rows = [(1, "a", "en", 1, "x\n"), (2, "a", "en", 1, "y")]
    more = spark.createDataFrame([(*r, "g", b"z", 5) for r in rows], SCHEMA + ", g string, leaf binary, pos int")
    assert sorted(map(tuple, merkle.audit(more).collect()), key=repr) == plain(rows)
