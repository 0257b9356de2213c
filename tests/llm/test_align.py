"""Cross-tokenizer alignment against a plain version over token pairs."""

import hashlib
from collections import Counter

import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from varideck.llm import align
from varideck.llm.bpe import byte_letters
from varideck.llm.common import small_batches

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ROWS = [
    (1, "Hello world, naïve façade! 日本語 \U0001f600 tokens"), (2, None), (3, ""), (4, " "), (5, "a  b   c\n\n d\te"), (6, "<|endoftext|><s> </s> plain"), (7, "Hello world"),
    (7, "Hello world"), (None, "Hello again, world"), (8, "x" * 3000), (9, " 　é ▁under"), (10, "0123456789" * 300), (11, "ab" * 2000 + " the end"), (12, "\r\n\x00\x7f"),
]


def plain(rows):
    """Byte by byte: the owner of each byte on both sides, groups by joint ends, links by loops."""
    t = Tokenizer.from_file(A)
    t.encode_special_tokens = True
    m = sentencepiece.SentencePieceProcessor(model_file=B)
    of = {x: b for b, x in enumerate(byte_letters())}
    out, docs = [], []
    for key, text in rows:
        a = b = groups = []
        if text:
            whole = b" " + text.encode()
            a = [(i, bytes(of[c] for c in t.id_to_token(i))) for i in t.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, bytes([int(m.id_to_piece(i)[3:5], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode()) for i in m.encode(text)]
            if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
                a = b = []
            ends = [set(), set()]
            for side, tokens in zip(ends, (a, b), strict=True):
                at = 0
                for _, x in tokens:
                    at += len(x)
                    side.add(at)
            groups, cuts = [], sorted(ends[0] & ends[1])
            ia = ib = pa = pb = 0
            for cut in cuts:
                g = ([], [])
                while pa < cut:
                    g[0].append(a[ia][0])
                    pa += len(a[ia][1])
                    ia += 1
                while pb < cut:
                    g[1].append(b[ib][0])
                    pb += len(b[ib][1])
                    ib += 1
                groups.append(g)
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        docs.append((key, len(a), len(b), groups, links))
    counts = Counter(p for d in docs for p in d[4])
    best = {}
    for (x, _), c in counts.items():
        best[x] = max(best.get(x, 0), c)
    for key, na, nb, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        n_best = sum(k for p, k in links.items() if counts[p] == best[p[0]])
        out.append((key, na, nb, len(groups), sum(links.values()), n_best, sum(counts[p] * k for p, k in links.items()), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


def aligned(spark, df):
    found = align.align(df, A, B).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted(map(tuple, found.collect()), key=repr)


def test_equals_plain_version(spark):
    small_batches(spark)
    df = spark.createDataFrame([(*r, [1], "z") for r in ROWS], "doc_id bigint, text string, keys array<int>, block string")
    want = plain(ROWS)
    assert {w[1] > 0 for w in want} == {True, False}
    assert aligned(spark, df.repartition(3)) == want
    assert aligned(spark, df.limit(0)) == []


def test_blocks_of_a_task_are_not_held_at_once(spark, monkeypatch):
    monkeypatch.setattr(align, "BLOCK", 40)
    df = spark.createDataFrame(ROWS, "doc_id bigint, text string").coalesce(1)
    found = align.align(df, A, B)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "collect_list" not in plan and "ObjectHashAggregate" not in plan
    assert sorted(map(tuple, found.drop("n_overlaps").collect()), key=repr) == plain(ROWS)


def test_given_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    assert aligned(spark, spark.createDataFrame(rows, "doc_id bigint, text string")) == plain(rows)


@pytest.mark.parametrize("many", [0, 1, 10**9])
def test_pieces_and_large_groups_change_nothing(monkeypatch, many):
    one, two = align.sides(A, B)
    texts = [t for _, t in ROWS]
    want = align.align_block(texts, one, two)
    monkeypatch.setattr(align.linked_pairs, "__defaults__", (many,))
    for piece in (1, 7, 1000):
        got = align.align_block(texts, one, two, piece)
        assert all(list(got[x]) == list(want[x]) for x in want)


def test_overlaps_are_those_of_bytes():
    one, two = align.sides(A, B)
    text = "Überraschung naïve 日本語 tokens"
    a, b = one.encode([text])[0], two.encode([text])[0]
    import numpy as np

    starts = [np.cumsum(s.lengths[i]) - s.lengths[i] for s, i in ((one, a), (two, np.array(b)))]
    x, y, _, _ = align.overlaps(starts[0], np.zeros(len(a), int), starts[1], np.zeros(len(b), int))
    owner = [np.repeat(np.arange(len(i)), s.lengths[i]) for s, i in ((one, a), (two, np.array(b)))]
    assert list(zip(x.tolist(), y.tolist(), strict=True)) == sorted(set(zip(*(o.tolist() for o in owner), strict=True)))


def test_both_ways_to_encode_agree():
    from varideck.llm.bpe import BpeCodec

    codec = BpeCodec(A)
    codec.cut = None
    texts = [r["text"] for r in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).to_pylist()] + [t for _, t in ROWS if t]
    assert align.sides(A, B)[0].encode(texts) == [x.tolist() for x in codec.encode([" " + t for t in texts])]
