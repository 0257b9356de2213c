"""Near-duplicates, decontamination, top-k, suffixes, tool calls, and the pipeline: against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from varideck.llm import lsa, minhash, pii, queries, suffixes, toolcalls, topk
from varideck.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def words_of(text, n):
    w = (text or "").translate({i: i + 32 for i in range(65, 91)}).encode().split()
    return {tuple(w)} if 0 < len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def brute_components(rows, n, percent):
    sets = [(k, words_of(t, n)) for k, t in rows]
    parent = {k: k for k, _ in rows if k is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    return {k: find(k) for k in parent}


def near_copies(seed, groups=6, size=12, length=(3, 400)):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    rows, k = [], 0
    for _ in range(groups):
        base = [rnd.choice(vocab) for _ in range(rnd.randint(*length))]
        for _ in range(size):
            w = list(base)
            for _ in range(int(len(w) * rnd.choice((0, 0.01, 0.03, 0.05, 0.08, 0.15)))):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            rows.append((k, " ".join(w)))
            k += 1
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "n"), [(1, 2), (2, 5)])
def test_near_duplicates_equal_brute_force(spark, seed, n):
    rows = near_copies(seed) + [(900, None), (901, ""), (902, " \n"), (903, "One"), (904, "one"), (905, "one two"), (906, "Ä b c"), (907, "ä b c"), (None, "one"), (908, "x " * 9000), (909, "X " * 8000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("key", F.lit(1)).withColumn("n", F.lit("n"))
    got = minhash.near_duplicates(df, words=n).collect()
    want = brute_components(rows, n, 80)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert len(got) == len(rows) and all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)
    sizes = {k: len(words_of(t, n)) for k, t in rows}
    assert all(r.n_shingles == sizes[r.doc_id] for r in got if r.doc_id is not None)


def test_a_large_group_of_graded_copies(spark):
    rows = near_copies(7, groups=1, size=260, length=(150, 150)) + near_copies(8, groups=1, size=40, length=(420, 420))
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), words=2).collect()}
    assert got == brute_components(rows, 2, 80)


def test_near_duplicates_of_nothing(spark):
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def thue_morse(n):
    """Two words of 2**n letters whose polynomial hashes modulo a power of two are equal."""
    word = "a"
    for _ in range(n):
        word += "".join("ab"[c == "a"] for c in word)
    return word, "".join("ab"[c == "a"] for c in word)


def test_words_that_make_polynomials_collide(spark):
    one, two = thue_morse(10)
    rows = [(1, one), (2, two), (3, one + " x"), (4, two + " x"), (5, one)]
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), words=2).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}
    rows = [(1, "c" * 30 + one), (2, "c" * 30 + two), (3, two[:700] + "d" * 9), (4, one[100:900])]
    got = sorted(tuple(r) for r in suffixes.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), digests=True).collect())
    assert got == brute_repeats(rows, 400)


def test_hot_lists_are_broadcast_and_no_link_is_lost(spark, monkeypatch):
    monkeypatch.setattr(minhash, "HOT_LISTS", 1 << 20)
    monkeypatch.setattr(minhash, "HOT_LEAST", 3)
    rnd = random.Random(8)
    base = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rnd.choice(base) if rnd.random() < 0.03 else x for x in base)) for i in range(80)]
    plain = brute_components(rows, 2, 80)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), words=2).collect()}
    assert got == plain


def test_components_that_need_more_rounds_raise(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(200)], "a bigint, b bigint")
    with pytest.raises(RuntimeError):
        connected_components(chain, most_rounds=1)


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 9), (5, 5)] + [(i, i + 1) for i in range(20, 60)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 9, 10: 9} | {i: 20 for i in range(20, 61)}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    x = np.repeat(rng.normal(size=(60, 17)).astype(np.float32), 5, axis=0)
    rows = [(i, [float(y) for y in v], 1) for i, v in enumerate(x)] + [(400, None, 1), (401, [1.0, None], 1), (402, [float("nan")] * 17, 1), (None, [0.0] * 17, 1), (403, [0.5, 0.5], 1), (404, [0.5, -0.5], 1), (405, [], 1), (17, [1.0] * 17, 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, score int")
    got = sorted(map(tuple, topk.top_k(df, F.col("id") % 20 == 0, k=7, query_rows=8, candidate_rows=64).collect()))
    fine = [(i, np.floor(64 * np.array(v, np.float64))) for i, v, _ in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    want = []
    for a, u in fine:
        if a % 20 == 0:
            best = sorted((-int(u @ w), b) for b, w in fine if b != a and len(w) == len(u))[:7]
            want += [(a, i + 1, b, -s) for i, (s, b) in enumerate(best)]
    assert got == sorted(want)
    large = spark.createDataFrame([(0, [2.0**60, 1.0]), (1, [2.0**60, 3.0]), (2, [1.0, 2.0]), (20, [1.0, 1.0])], "vec_id bigint, embedding array<double>")
    best = sorted(map(tuple, topk.top_k(large, F.col("id") % 20 == 0, k=1).collect()))
    assert best == [(0, 1, 1, (1 << 63) - 1), (20, 1, 0, (1 << 63) - 1)]
    assert topk.top_k(df.limit(0), F.col("id") % 20 == 0).count() == 0


def test_top_k_sends_no_blocks_through_the_driver(spark, monkeypatch):
    plans, plain = {}, topk.stored
    monkeypatch.setattr(topk, "stored", lambda df, name: plans.update({name: df._jdf.queryExecution().executedPlan().toString()}) or plain(df, name))
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(40)], "vec_id bigint, embedding array<double>")
    assert topk.top_k(df, F.col("id") % 20 == 0, k=3).count() == 6
    assert "SortMergeJoin" in plans["best-of-blocks"] and "Broadcast" not in plans["best-of-blocks"]


def brute_repeats(docs, length):
    raw = [(t or "").encode() for _, t in docs]
    seen = {}
    for i, r in enumerate(raw):
        for p in range(len(r) - length + 1):
            seen.setdefault(r[p : p + length], []).append((i, p))
    gone = [bytearray(len(r)) for r in raw]
    for v in seen.values():
        for i, p in v if len(v) > 1 else ():
            gone[i][p : p + length] = b"\1" * length
    out = []
    for (k, _), r, g in zip(docs, raw, gone, strict=True):
        spans = sum(1 for x in range(len(g)) if g[x] and (x == 0 or not g[x - 1]))
        out.append((k, len(r), sum(g), spans, hashlib.sha256(bytes(b for b, x in zip(r, g, strict=True) if not x)).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("seed", "length", "gram"), [(0, 400, 128), (1, 60, 20)])
def test_repeats_equal_brute_force(spark, seed, length, gram):
    rnd = random.Random(seed)
    w = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6))) for _ in range(60)]
    passages = [" ".join(rnd.choice(w) for _ in range(rnd.randint(5, 120))) for _ in range(6)]
    docs = [(i, " ".join(rnd.choice(passages) if rnd.random() < 0.4 else " ".join(rnd.choice(w) for _ in range(rnd.randint(1, 40))) for _ in range(rnd.randint(0, 8)))) for i in range(50)]
    docs += [(100, "ab " * 300), (101, None), (102, ""), (103, docs[3][1]), (3, docs[3][1]), (None, docs[4][1]), (104, "x" * 700), (105, passages[0] + docs[7][1] + passages[1])]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("doc", F.lit(1)).withColumn("row", F.lit(2))
    got = sorted((tuple(r) for r in suffixes.without_repeats(df, length=length, gram=gram, digests=True).collect()), key=repr)
    assert got == brute_repeats(docs, length)
    kept = suffixes.without_repeats(df, length=length, gram=gram).collect()
    assert sorted((r.doc_id, hashlib.sha256(r.kept).hexdigest()) for r in kept if r.doc_id is not None) == sorted((g[0], g[4]) for g in got if g[0] is not None)
    assert suffixes.without_repeats(df.limit(0), length=length, gram=gram, digests=True).count() == 0


def test_repeats_beside_the_borders_of_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 300)
    rnd = random.Random(4)
    letters = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    docs = []
    for i in range(60):  # passages that begin or end beside the border, once in a long text and once in a short one
        passage, at = letters(rnd.randint(60, 110)), 300 * rnd.randint(1, 3) + rnd.choice((-1, 1)) * rnd.randint(0, 70)
        docs += [(2 * i, letters(at) + passage + letters(400)), (2 * i + 1, letters(5) + passage + letters(9))]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = sorted((tuple(r) for r in suffixes.without_repeats(df, length=60, gram=20, digests=True).collect()), key=repr)
    assert got == brute_repeats(docs, 60)


def test_a_passage_of_many_documents(spark, monkeypatch):
    """No gram with more than HOT contexts goes to one task."""
    monkeypatch.setattr(suffixes, "HOT", 20, raising=False)
    seen, whole = [], suffixes.sorted_runs
    monkeypatch.setattr(suffixes, "sorted_runs", lambda rows, length: seen.append([r["count"] for r in rows.groupBy("gram").count().collect()]) or whole(rows, length))
    rnd = random.Random(6)
    letters = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    license_, other = letters(130), letters(90)
    docs = [(i, letters(rnd.randint(0, 90)) + license_[rnd.randint(0, 9) :] + letters(rnd.randint(0, 90))) for i in range(90)]
    docs += [(100 + i, letters(50) + other + letters(50)) for i in range(5)] + [(200, docs[7][1][20:] + docs[8][1]), (201, docs[7][1])]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = sorted((tuple(r) for r in suffixes.without_repeats(df, length=60, gram=20, digests=True).collect()), key=repr)
    assert got == brute_repeats(docs, 60)
    assert seen[0] and max(seen[0]) <= 20


def test_suffix_order():
    rnd = random.Random(2)
    raw = np.frombuffer("".join(rnd.choice("ab") for _ in range(3000)).encode() * 2, np.uint8)
    starts = np.array(rnd.sample(range(5000), 400))
    group = np.sort(np.array([rnd.randrange(3) for _ in starts]))
    order = suffixes.SuffixOrder(raw, 100).sort(starts, group)
    text = raw.tobytes()
    keys = [(group[i], text[starts[i] : starts[i] + 100]) for i in order]
    assert keys == sorted(keys) and sorted(order.tolist()) == list(range(400))


def test_decontamination(spark):
    rnd = random.Random(5)
    w = [f"{rnd.choice('bcdfg')}{rnd.choice('aeiou')}{rnd.choice('lmnrst')}{i}" for i in range(3000)]
    text = lambda n: " ".join(rnd.choice(w) for _ in range(n))
    items = [(i, f"{text(rnd.randint(18, 40))}. {text(8)}.") for i in range(12)]
    docs = [(i, text(rnd.randint(1, 300))) for i in range(40)]
    planted = [(100 + i, f"{text(70)} {t.upper() if i % 2 else t} {text(30)}") for i, t in items]
    loose = items[3][1].split()
    loose = [x for j, x in enumerate(loose) if j % 4 or j > len(loose) - 10]  # a paraphrase that keeps the answer
    cut = items[4][1].split()[:9]  # too little of an item
    docs += planted + [(200, " ".join(loose)), (201, text(50) + " " + " ".join(cut)), (202, None), (203, ""), (None, items[0][1]), (204, "the " * 30_000), (100, planted[0][1])]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("words", F.lit(1)).withColumn("items", F.lit(1))
    bench = spark.createDataFrame([*items, (50, None), (51, ""), (None, "x y z")], "item_id bigint, text string")
    for group in (256, 5):  # one group of items, and several
        got = {r.doc_id: (r.contaminated, r["items"]) for r in lsa.contaminated(df, bench, group=group).collect()}
        assert all(got[100 + i] == (True, [i]) for i, _ in items) and got[200] == (True, [3]) and got[None] == (True, [0])
        assert not any(x for k, (x, _) in got.items() if k is not None and (k < 100 or k > 200))
    assert lsa.contaminated(df.limit(0), bench).count() == 0
    assert lsa.contaminated(df, bench.limit(0)).filter("contaminated").count() == 0


def test_loose_paraphrases_short_and_long_items_in_long_texts(spark):
    rnd = random.Random(11)
    w = [f"{rnd.choice('bcdfg')}{rnd.choice('aeiou')}{rnd.choice('lmnrst')}{i}" for i in range(3000)]
    text = lambda n: " ".join(rnd.choice(w) for _ in range(n))
    items = {i: f"{text(n - 4)}. {text(4)}." for i, n in enumerate((15, 20, 25, 30, 59, 400))} | {6: "Short one of eight words. It is here.", 7: text(8)}

    def loose(item, share):
        """`share` of the item's words in order, the answer's among them; the others are replaced."""
        body = item.split()
        gone = rnd.sample(range(len(body) - 4), int((1 - share) * len(body)))
        return " ".join(rnd.choice(w) if i in gone else x for i, x in enumerate(body))

    docs, want = [], {}
    for i, item in items.items():
        for share in (0.52, 0.6, 0.7, 1.0) if i < 6 else (1.0,):
            want[len(docs)] = [i]
            docs.append((len(docs), f"{text(rnd.randint(300, 900))} {loose(item, share) if share < 1 else item} {text(300)}"))
    for i in range(6):  # half of the item without its answer, or too little with it
        body = items[i].split()
        want[len(docs)] = []
        docs.append((len(docs), f"{text(300)} {' '.join(body[: len(body) * 6 // 10])} {text(300 + 2 * len(body))}"))
        want[len(docs)] = []
        docs.append((len(docs), f"{text(300)} {' '.join(body[-len(body) * 4 // 10 :])} {text(300 + 2 * len(body))}"))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: r["items"] for r in lsa.contaminated(df, spark.createDataFrame(list(items.items()), "item_id bigint, text string")).collect()}
    assert got == want


def test_benchmark_rows_that_share_an_id_or_have_none(spark, tmp_path):
    rnd = random.Random(12)
    w = [f"{rnd.choice('bcdfg')}{rnd.choice('aeiou')}{rnd.choice('lmnrst')}{i}" for i in range(3000)]
    text = lambda n: " ".join(rnd.choice(w) for _ in range(n))
    ids = [0, 1, *[2] * 9, 3, 4, *[5] * 6, None, None, 6]  # in groups of 5: an id over several groups, and one that begins a group
    items = [(i, text(20)) for i in ids]
    docs = [(None if n % 7 == 0 else n // 2, f"{text(40)} {t} {text(40)}") for n, (_, t) in enumerate(items)] + [(1, text(90)), (None, text(90)), (0, items[1][1])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = [(k, [i]) for (k, _), i in zip(docs, ids, strict=False)] + [(1, []), (None, []), (0, [1])]
    for group in (256, 5):
        got = [(r.doc_id, r["items"], r.contaminated) for r in lsa.contaminated(df, bench, group=group).collect()]
        assert sorted(got, key=repr) == sorted([(k, x, bool(x)) for k, x in want], key=repr)
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = corpus_pipeline.decontamination_stage(spark, df, str(tmp_path)).collect()
    assert sorted(map(tuple, clean), key=repr) == sorted(docs[-3:-1], key=repr)


def test_latent_space_is_the_leading_one(spark):
    """The basis spans the leading right singular vectors of passages and items, and words of the same passages come together in it."""
    rnd = random.Random(21)
    topics = [[f"t{i}w{j}" for j in range(30)] for i in range(6)]
    docs = [(i, " ".join(rnd.choice(topics[i % 6]) for _ in range(48))) for i in range(600)]
    items = [(i, " ".join(topics[i][:12]) + ". " + " ".join(topics[i][12:15])) for i in range(6)]
    words = lsa.stored_words(spark.createDataFrame(docs, "doc_id bigint, text string"), "doc_id", "text")
    counts, total = lsa.document_frequencies(words)
    idf = np.log((1 + total) / (1 + counts))
    space = lsa.with_bases(words, [lsa.empty_space(items, idf, 0.1)], 12)[0]  # twice as many columns as topics: a random start needs some spare
    rows = [np.frombuffer(r.words, np.uint32) for r in words.collect()] + space.items
    matrix = np.zeros((len(rows), len(space.terms)))
    for i, row in enumerate(rows):
        known = row[np.isin(row, space.terms)]
        np.add.at(matrix[i], np.searchsorted(space.terms, known), 1)
    exact = np.linalg.svd(matrix * space.weights)[2][:6]
    assert np.linalg.svd(exact @ space.basis)[1].min() > 0.99
    other = lsa.word_hashes(pa.array([" ".join(topics[2][5:15])]))[0]  # shares few words with the first words of its item
    vector = np.zeros(len(space.terms))
    np.add.at(vector, np.searchsorted(space.terms, other), 1)
    y = (vector * space.weights) @ space.basis
    cosines = space.latent @ (y / np.linalg.norm(y))
    assert cosines.argmax() == 2 and cosines[2] > 0.95 and np.delete(cosines, 2).max() < 0.3


def test_paraphrases_with_words_put_in_between(spark):
    """Their words stand too far from those that the lookup starts from, so the latent space alone brings them up."""
    rnd = random.Random(22)
    topics = [[f"t{i}w{j}" for j in range(60)] for i in range(8)]
    filler = [f"f{j}" for j in range(2000)]
    docs = [(i, " ".join(topics[i % 8][:44] * 4)) for i in range(160)]
    items = [(i, " ".join(topics[i][:44]) + ". " + " ".join(topics[i][50:56])) for i in range(8)]

    def wide(body):
        """The second half of the item with three words after each of its words, and the answer. The lookup begins with the rarest words,
        the answer's, and the first of the others."""
        return " ".join(" ".join([x, *rnd.sample(filler, 3)]) for x in body[20:44]) + " " + " ".join(body[44:])

    planted = [(1000 + i, " ".join(rnd.choices(filler, k=90)) + " " + wide(t.replace(".", "").split()) + " " + " ".join(rnd.choices(filler, k=90))) for i, t in items]
    df, bench = spark.createDataFrame(docs + planted, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    found, alone = ({r.doc_id: r["items"] for r in lsa.contaminated(df, bench, rank=16, cosine=0.2, similar=x).collect()} for x in (0.5, 2.0))
    assert sum(found[1000 + i] == [i] for i in range(8)) >= 7
    assert sum(alone[1000 + i] == [i] for i in range(8)) == 0


def test_copies_of_items_of_any_length(spark):
    rnd = random.Random(23)
    w = [f"{rnd.choice('bcdfg')}{rnd.choice('aeiou')}{rnd.choice('lmnrst')}{i}" for i in range(3000)]
    text = lambda n: " ".join(rnd.choice(w) for _ in range(n))
    items = [(n * 100 + i, text(n)) for n in (4, 6, 8, 10, 14, 48, 200, 300, 400, 1000) for i in range(4)]
    docs = [(i, f"{text(400)} {t} {text(10)}") for i, t in items] + [(-1, text(900))]
    got = {r.doc_id: r["items"] for r in lsa.contaminated(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    assert got == {i: [i] for i, _ in items} | {-1: []}


def test_document_frequencies(spark):
    df = spark.createDataFrame([(1, "a b a " * 20), (2, "b"), (3, None)], "doc_id bigint, text string")
    counts, total = lsa.document_frequencies(lsa.stored_words(df, "doc_id", "text"))
    assert total == 3 and sorted(counts[counts > 0]) == [2, 3]


def test_longest_common_subsequence():
    rnd = random.Random(1)
    for _ in range(200):
        a, b = ([rnd.randrange(4) for _ in range(rnd.randint(1, 12))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert lsa.subsequence(np.array(a), np.array(b)) == t[-1][-1]


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [
            (1, 4, "c", "search", '{"limit":2,"query":"é\\n"}', ["b", "gone"]), (1, 2, "b", "search", '{"query": 5, "more": {"z":1,"a":[true,null]}}', ["a"]), (1, 0, "a", "search", None, None), (1, 6, "a", "other", "{}", None),
            (2, 0, "x", "none", "{}", ["y"]), (2, 1, "y", "search", "[1]", ["x"]), (3, 0, "t", None, '{"query":"q"}', []), (None, 0, "n", "search", "{}", []),
        ],
        "conv_id bigint, turn bigint, call_id string, name string, arguments string, depends_on array<string>",
    )
    results = spark.createDataFrame([(1, "c", 5, "r\"1"), (1, "b", 9, "late"), (1, "b", 3, "early"), (1, "zz", 3, "lost"), (3, "t", 1, None)], "conv_id bigint, call_id string, turn bigint, content string")
    tools = spark.createDataFrame([("search", "query", "string", True), ("search", "limit", "integer", False)], "name string, field string, type string, required boolean")
    got = {(r.conv_id, r.call_id): r for r in toolcalls.link_tool_calls(calls.withColumn("level", F.lit(9)), results, tools).collect()}
    assert len(got) == 6
    a, b, c = (got[1, x] for x in "abc")
    assert [(r.position, r.level) for r in (a, b, c)] == [(0, 0), (1, 1), (2, 2)]
    assert (a.status, a.errors) == ("missing_result", "not an object") and (b.status, b.errors) == ("ambiguous", "unexpected more; wrong type query") and (c.status, c.errors) == ("invalid", "no call gone")
    assert b.json == '{"arguments":{"more":{"a":[true,null],"z":1},"query":5},"call_id":"b","name":"search","result":"early"}'
    assert c.json == '{"arguments":{"limit":2,"query":"é\\n"},"call_id":"c","name":"search","result":"r\\"1"}'
    assert got[2, "x"].status == got[2, "y"].status == "cycle" and got[2, "x"].level is None
    assert got[3, "t"].errors == "unknown tool" and got[3, "t"].json == '{"arguments":{"query":"q"},"call_id":"t"}'
    assert toolcalls.link_tool_calls(calls.limit(0), results, tools).count() == 0
    assert toolcalls.link_tool_calls(calls, results.limit(0), tools.limit(0)).filter("status = 'ok'").count() == 0


def test_numbers_keys_and_large_conversations(spark, monkeypatch):
    forms = {
        "1": "1", "1e2": "100", "1.50": "1.5", "-0.0": "0", "1e-1": "0.1", "1e24": "1" + "0" * 24, "1" + "0" * 24: "1" + "0" * 24, "1e-7": "0.0000001", "0.0000001": "0.0000001", "1e40": "1e40", "1.5E-30": "1.5e-30",
        "0." + "0" * 29 + "15": "1.5e-30", "1.2345678925e8": "123456789.25", '{"b":1.0,"a":["1.0\\"2.50\\\\",1e2,-3.10]}': '{"a":["1.0\\"2.50\\\\",100,-3.1],"b":1}', '"' + "\\n" * 20000 + '1.0"': '"' + "\\n" * 20000 + '1.0"',
    }
    df = spark.createDataFrame([(x,) for x in forms], "j string").select("j", toolcalls.canonical_json(F.to_json(F.try_parse_json("j"))).alias("c"))
    assert {r.j: r.c for r in df.collect()} == forms
    kind = "conv_id bigint, turn bigint, call_id string, name string, arguments string, depends_on array<string>"
    calls = spark.createDataFrame([(1, 0, "a", "t", '{"n":1.0}', None), (1, 1, "b", "t", '{"n":1e2,"n":2}', None), (1, 2, "c", "t", '{"n":1.5}', None), (1, 3, "d", "t", '{"n": x', None)], kind)
    results = spark.createDataFrame([(1, x, 9, "r") for x in "abcd"], "conv_id bigint, call_id string, turn bigint, content string")
    tools = spark.createDataFrame([("t", "n", "integer", True)], "name string, field string, type string, required boolean")
    got = {r.call_id: (r.errors, r.json) for r in toolcalls.link_tool_calls(calls, results, tools).collect()}
    assert got["a"] == ("", '{"arguments":{"n":1},"call_id":"a","name":"t","result":"r"}') and got["b"][0] == "duplicate keys" and got["c"][0] == "wrong type n"
    assert got["b"][1] == '{"arguments":"{\\"n\\":1e2,\\"n\\":2}","call_id":"b","name":"t","result":"r"}' and got["d"][0] == "not an object"
    rnd = random.Random(4)
    many = [(c, i, f"c{i}", "t", "{}", [f"c{rnd.randrange(max(1, i))}" for _ in range(rnd.randrange(3))] if i else None) for c in range(3) for i in range((4, 9, 30)[c])]
    many += [(7, 0, "x", "t", "{}", ["y"]), (7, 1, "y", "t", "{}", ["x", None]), (7, 2, "z", "t", "{}", ["y"]), (7, 3, "s", "t", "{}", ["s"]), (7, 4, "o", "t", "{}", ["gone"])]
    frame = spark.createDataFrame(many, kind)
    rounds = sorted(map(tuple, toolcalls.levels_by_rounds(frame).collect()), key=repr)
    assert sorted(map(tuple, toolcalls.levels_in_rows(frame).collect()), key=repr) == rounds
    monkeypatch.setattr(toolcalls, "MOST", 8)
    assert sorted(map(tuple, toolcalls.levels(frame).collect()), key=repr) == rounds


def test_pipeline_stages_equal_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near-dedup", "decontamination", "pii", "bpe"]
    good = stages["quality"](spark, docs, SF)
    assert good.columns == docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in good.collect()}
    assert all(k in kept for k, x in labels.items() if x == 1)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    apart = stages["near-dedup"](spark, docs, SF)
    want = brute_components(rows, 5, 80)
    assert apart.columns == docs.columns and {r.doc_id for r in apart.collect()} == {k for k, c in want.items() if k == c}
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = stages["decontamination"](spark, docs, SF)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {k for k, t in rows if not any(x in t for x in items)}
    hidden = {r.doc_id: r for r in stages["pii"](spark, docs, SF).collect()}
    for k, t in rows:
        assert not pii.base_spans(hidden[k].text) and hidden[k].n_chars == len(hidden[k].text)
        assert pii.base_spans(t) or hidden[k].text == t
    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for r in stages["bpe"](spark, docs.limit(30), SF).collect():
        assert r.ids == theirs.encode(dict(rows)[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids)


def test_stages_on_odd_rows(spark):
    """Null and repeated ids, null, empty and long texts, columns with the stages' own names, empty tables."""
    long = " ".join(f"word{i % 977}x{i % 13}" for i in range(40_000))
    prose = " ".join(f"w{i}" for i in range(60))
    texts = [(1, prose), (1, prose), (None, prose), (None, prose + " z"), (2, long), (3, long + " end"), (None, ""), (4, None), (None, None), (5, "mail a.b@c.org"), (0, prose + " y z")]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t or ""), 7, 8) for k, t in texts], "doc_id bigint, text string, lang string, source string, n_chars bigint, _score int, _row int")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["near-dedup"](spark, docs, SF)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(0, prose + " y z"), (2, long), (None, ""), (4, None), (None, None), (5, "mail a.b@c.org")], key=repr)
    scored = stages["quality"](spark, docs, SF)
    assert scored.columns == docs.columns and {tuple(r) for r in scored.collect()} <= {tuple(r) for r in docs.collect()}
    assert sorted(map(tuple, stages["decontamination"](spark, docs, SF).collect()), key=repr) == sorted(map(tuple, docs.collect()), key=repr)
    clean = stages["pii"](spark, docs, SF)
    assert clean.columns == docs.columns and sorted((r.text for r in clean.collect() if r.doc_id == 5)) == ["mail <EMAIL>"] and clean.filter("text is null").count() == 2
    coded = stages["bpe"](spark, docs, SF)
    assert coded.count() == len(texts) and coded.filter("n_tokens = 0").count() == 3
    for name, stage in stages.items():
        assert stage(spark, docs.limit(0), SF).count() == 0, name


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SF)
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert 0 < out.count() < n


def test_the_query_equals_all_windows_of_the_given_documents(spark):
    """op9 as registered, against every window of 400 bytes."""
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in queries.op9_suffixes(spark, SF).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=repr)
    raw = [(text or "").encode() for _, text in rows]
    seen = Counter(hashlib.blake2b(x[i : i + 400], digest_size=16).digest() for x in raw for i in range(len(x) - 399))
    want = []
    for (doc, _), x in zip(rows, raw, strict=True):
        gone = bytearray(len(x))
        for i in range(len(x) - 399):
            if seen[hashlib.blake2b(x[i : i + 400], digest_size=16).digest()] > 1:
                gone[i : i + 400] = b"\x01" * 400
        spans = sum(1 for i in range(len(x)) if gone[i] and not (i and gone[i - 1]))
        want.append((doc, len(x), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(x, gone, strict=True) if not g)).hexdigest()))
    assert sum(w[2] > 0 for w in want) > 10
    assert got == sorted(want, key=repr)


def test_planted_passages_go_by_their_bytes(spark, tmp_path):
    """op9 as registered, on passages of over 50 words in two documents each: from 400 bytes on both lose them whole, below neither
    loses a byte, nor do documents without one; n_bytes is the input's length in all of them."""
    rnd = random.Random(12)
    prose = lambda n: " ".join("".join(rnd.choice("abcdefghijklmnopqrsé") for _ in range(rnd.randint(2, 9))) for _ in range(n))
    docs, least = [], {}
    for i in range(0, 120, 3):
        passage = f" {prose(rnd.randint(51, 75))} "
        docs += [(i, prose(30) + passage + prose(20)), (i + 1, prose(9) + passage + prose(40)), (i + 2, prose(120))]
        if (size := len(passage.encode())) >= 400:
            least |= {i: size, i + 1: size}
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.op9_suffixes(spark, str(tmp_path)).collect()}
    assert 20 < len(least) < 70
    assert {k for k, r in got.items() if r.n_removed} == set(least)
    assert all(got[k].n_removed >= size and got[k].n_spans == 1 for k, size in least.items())
    assert {k: r.n_bytes for k, r in got.items()} == {k: len(t.encode()) for k, t in docs}
