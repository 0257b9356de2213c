"""Edge rules on micro frames, invariants of the operators that SQL can't express, readers and writers."""

import gzip
import json
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from varideck.functions import cigar
from varideck.functions import columns as c
from varideck.functions import numbering
from varideck.operators import calls as k
from varideck.operators import coverage, gvcf, kinship, ld, lines, pca, planes, plots, reads
from varideck.operators import variants as v
from varideck.plans.phasing import prepare_for_phasing
from varideck.sources import inventory, sinks, vcf
from varideck.sources.projections import Projections
from varideck.streaming.refresh import refresh_site_metrics

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def p(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return Projections(spark, SF)


def test_genotype_rules(spark):
    rows = [("./.", True, False), (".", True, False), ("", True, False), ("0/.", False, False), ("0", False, False), ("0|1", False, True), ("1/1", False, True)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, gt string, missing boolean, called boolean")
    assert df.filter((c.gt_missing(F.col("gt")) != F.col("missing")) | (c.gt_called(F.col("gt")) != F.col("called"))).count() == 0
    assert [r[0] for r in df.orderBy("i").select(c.gt_dosage(F.col("gt"))).collect()] == [None, None, None, None, None, 1, 2]


def test_two_conventions_of_called(spark):
    calls = spark.createDataFrame([("Chr01", 1, g, None) for g in ("0/.", "0/1", "./.", "0")], "chrom string, pos bigint, gt string, dp bigint")
    a = k.genotype_metrics(calls).first()
    assert (a.total_genotypes, a.missing_genotypes, a.called_genotypes, a.mean_depth, a.heterozygous_rate) == (4, 1, 1, 0.0, 1.0)
    b = k.site_metrics_imputed(spark.createDataFrame([("Chr01", 1, 1.0, 0.5, 1)], "chrom string, pos bigint, qual double, dr2 double, imp int"), calls).first()
    assert (b.called_genotypes, b.heterozygous_count) == (3, 2)


def test_missing_annotations_go_opposite_ways(spark):
    row = [("Chr01", 1, 50.0, 10.0, 1.0, 10.0, 50.0, None, 1.0)]
    df = spark.createDataFrame(row, "chrom string, pos bigint, qual double, qd double, sor double, fs double, mq double, mq_rank_sum double, read_pos_rank_sum double")
    assert v.hard_filter(df).count() == 0
    assert v.hard_filter_rejects(df).count() == 1
    assert v.soft_filter(df).first().soft_filter == "PASS"


def test_recode_after_split(spark):
    df = spark.createDataFrame([("1/2", 1), ("1/2", 2), ("0|2", 2), ("./1", 1)], "gt string, allele_index int")
    assert [r.gt for r in v.recode_split(df).collect()] == ["1/0", "0/1", "0|1", "./1"]


def test_right_closed_bins(spark):
    m = spark.createDataFrame([("Chr01", x, 1.0) for x in (0, 1, 10, 99, 100)], "chrom string, pos bigint, call_rate double")
    assert {r.bin: r.n_sites for r in plots.call_rate_bins(m, 10).collect()} == {1: 3, 10: 2}
    assert plots.call_rate_bins(m.limit(4)).count() == 0


def test_contig_names(spark):
    df = spark.createDataFrame([(x,) for x in ("1", "chr1", "Chr1", "CHR01", "scaffold_7")], "chrom string")
    assert [r.chrom for r in v.standardise_contigs(df).collect()] == ["Chr01"] * 4 + ["scaffold_7"]
    with pytest.raises(ValueError):
        v.target_chroms(df, ["Chr99"])


def test_pruning_leaves_no_linked_pair(spark, p):
    calls = p.calls.filter("chrom = 'Chr01' or chrom = 'Chr02'")
    kept = ld.ld_prune(calls, 200, 50, 0.2)
    linked = ld.ld_r2(calls, 10**9).filter("r2 > 0.2")
    left = linked.join(kept.filter("kept").select("chrom", F.col("pos").alias("pos_a")), ["chrom", "pos_a"]).join(kept.filter("kept").select("chrom", F.col("pos").alias("pos_b")), ["chrom", "pos_b"])
    assert linked.count() > 0 and left.count() == 0


def linked_throughout(seed, sites, samples):
    """Calls in which neighbours look alike over the whole chromosome, with unknown ones and repeated places."""
    rng = np.random.default_rng(seed)
    now, rows = rng.integers(0, 3, samples), []
    for k in range(sites):
        now = np.where(rng.random(samples) < 0.25, rng.integers(0, 3, samples), now)
        rows += [("Chr01" if k % 5 else "Chr02", 10 * (k // 2), k, f"s{i:03d}", None if rng.random() < 0.05 else int(g)) for i, g in enumerate(now)]
    return rows


CALLS = "chrom string, pos bigint, site_key bigint, sample string, dosage int"


def plain_prune(rows, window, step, least):
    """Windows one after another over each chromosome."""
    sites = {}
    for chrom, pos, key, sample, g in rows:
        sites.setdefault(chrom, {}).setdefault((pos, key), {})[sample] = g
    out = {}
    for chrom, of in sites.items():
        order = sorted(of)
        g = [{s: x for s, x in of[k].items() if x is not None} for k in order]
        af = [sum(x.values()) / (2 * len(x)) if x else None for x in g]
        maf = [0.0 if f is None else min(f, 1 - f) for f in af]

        def r2(a, b):
            u = [(a[s], b[s]) for s in a.keys() & b.keys()]
            n, sx, sy = len(u), sum(i for i, _ in u), sum(j for _, j in u)
            vx, vy = n * sum(i * i for i, _ in u) - sx * sx, n * sum(j * j for _, j in u) - sy * sy
            return (n * sum(i * j for i, j in u) - sx * sy) ** 2 / (vx * vy) if vx > 0 and vy > 0 else 0.0

        known, gone = {}, set()
        for start in range(0, len(order), step):
            for i in range(start, min(start + window, len(order))):
                for j in range(i + 1, min(start + window, len(order))):
                    if i not in gone and j not in gone:
                        if (i, j) not in known:
                            known[i, j] = r2(g[i], g[j])
                        if known[i, j] > least:
                            gone.add(i if maf[i] < maf[j] else j)
        out |= {(chrom, *k): v not in gone for v, k in enumerate(order)}
    return out


@pytest.mark.parametrize(("seed", "window", "step", "block"), [(1, 8, 3, 3), (2, 12, 5, 3), (3, 6, 1, 6), (4, 200, 50, 40)])
def test_pruning_by_blocks_equals_windows_in_turn(spark, seed, window, step, block):
    rows = linked_throughout(seed, 160, 70)
    want = plain_prune(rows, window, step, 0.2)
    kept = ld.ld_prune(spark.createDataFrame(rows, CALLS), window, step, 0.2, block)
    assert sorted((r.chrom, r.pos, r.kept) for r in kept.collect()) == sorted((c_, pos, x) for (c_, pos, _), x in want.items())
    assert 0 < sum(want.values()) < len(want)


def test_planes_where_calls_lack(spark):
    rows = [("Chr01", 1, 1, f"s{i:03d}", i % 3) for i in range(150)] + [("Chr01", 2, 2, "s149", 2), ("Chr01", 2, 2, "s000", None)]
    got = {r.pos: r for r in planes.site_planes(spark.createDataFrame(rows, CALLS)).collect()}
    assert [len(got[p].het) for p in (1, 2)] == [3, 3] and (got[2].n, got[2].ac, got[1].n) == (1, 2, 150)
    bits = [i for i in range(150) if got[1].hom[i // 64] >> (i % 64) & 1]
    assert bits == list(range(2, 150, 3)) and got[2].hom == [0, 0, 1 << 21] and got[2].known == [0, 0, 1 << 21]
    assert planes.site_planes(spark.createDataFrame([], CALLS)).count() == 0


def test_numbers_are_spread_and_in_order(spark):
    """One chromosome's rows are numbered by several tasks, none of which has most of them."""
    df = spark.range(0, 4000, 1, 8).select(F.lit("Chr01").alias("chrom"), (F.col("id") * 7919 % 4001).alias("pos"))
    got = numbering.with_number_in(df, "chrom", [F.col("pos")], "n", 8)
    rows = sorted(got.collect(), key=lambda r: r.pos)
    assert [r.n for r in rows] == list(range(1, 4001))
    where = numbering.with_row_number(df, [F.col("pos")], "n", 8).groupBy(F.spark_partition_id()).count().collect()
    assert len(where) >= 4 and max(r["count"] for r in where) < 2000
    mixed = spark.createDataFrame([("b", 1), (None, 2), ("a", 3), (None, 1), ("b", 0)], "g string, x int")
    assert sorted(((r.g or "", r.x, r.n) for r in numbering.with_number_in(mixed, "g", [F.col("x")], "n").collect())) == [("", 1, 1), ("", 2, 2), ("a", 3, 1), ("b", 0, 1), ("b", 1, 2)]
    assert numbering.with_row_number(mixed.limit(0), [F.col("x")]).count() == 0


def plain_pca(rows, samples):
    """Eigenvalues and vectors of the whole matrix, and the standardised dosages by site."""
    sites = {}
    for chrom, pos, key, sample, g in rows:
        sites.setdefault((chrom, pos, key), {})[sample] = g
    z = {}
    for site, of in sites.items():
        x = np.array([np.nan if of.get(s) is None else of[s] for s in samples], float)
        q = np.nanmean(x) / 2 if not np.isnan(x).all() else 0.0
        z[site] = np.where(np.isnan(x), 0, x - 2 * q) / np.sqrt(2 * q * (1 - q)) if 0 < q < 1 else np.zeros(len(samples))
    m = np.array(list(z.values()))
    values, vectors = np.linalg.eigh(m.T @ m / max(1, (m != 0).any(1).sum()))
    return values[::-1], vectors[:, ::-1], z


@pytest.mark.parametrize(("sites", "samples", "k", "steps", "words"), [(90, 30, 30, 5, 64), (700, 150, 5, 6, 1), (300, 70, 3, 5, 64)])
def test_components_equal_those_of_the_whole_matrix(spark, monkeypatch, sites, samples, k, steps, words):
    monkeypatch.setattr(pca, "TILE_WORDS", words)  # parts of so many samples
    rng = np.random.default_rng(sites)
    group = rng.integers(0, 4, samples)
    rows = [("Chr01", i, i, f"s{j:03d}", None if rng.random() < 0.05 else int(rng.binomial(2, p[group[j]]))) for i in range(sites) for p in [rng.random(4)] for j in range(samples)]
    rows += [("Chr02", 1, 10**6, "s000", 1)]
    names = [f"s{j:03d}" for j in range(samples)]
    values, vectors, z = plain_pca(rows, names)
    found = pca.genotype_pca(spark.createDataFrame(rows, CALLS), k, steps)
    got = sorted(found.scores.collect(), key=lambda r: r["sample"])
    u = np.array([[r[f"pc{i + 1}"] for i in range(k)] for r in got])
    assert [r["sample"] for r in got] == names
    few, e = min(k, 3), np.array([r.eigenvalue for r in found.eigenvalues.orderBy("component").collect()])
    # Exact where the blocks span all samples; else the leading ones, and those in the noise nearly.
    assert np.allclose(e[:few], values[:few], atol=1e-7) and np.allclose(e, values[:k], atol=1e-7 if (k + 10) * steps >= samples else 0.01 * values[k])
    assert np.allclose(np.abs((u * vectors[:, :k]).sum(0))[:few], 1, atol=1e-6) and np.allclose(u.T @ u, np.eye(k), atol=1e-8)
    weights = {(r.chrom, r.pos, r.component): r.weight for r in pca.pca_variant_weights(found).collect()}
    assert len(weights) == k * len(z)
    assert all(abs(weights[c_, pos, i + 1] - z[c_, pos, key] @ u[:, i] / np.sqrt(values[i])) < 1e-5 for c_, pos, key in list(z)[:40] for i in range(few))


@pytest.mark.parametrize(("sites", "samples"), [(90, 130), (60, 200), (40, 20)])
def test_all_components_of_several_blocks(spark, sites, samples):
    """Blocks of 64 columns: an even and an odd count of them, one alone, and fewer sites than samples."""
    rng = np.random.default_rng(sites)
    group = rng.integers(0, 4, samples)
    rows = [("Chr01", i, i, f"s{j:03d}", None if rng.random() < 0.05 else int(rng.binomial(2, p[group[j]]))) for i in range(sites) for p in [rng.random(4)] for j in range(samples)]
    values, _, z = plain_pca(rows, [f"s{j:03d}" for j in range(samples)])
    m = np.array(list(z.values()))
    m = m.T @ m / max(1, (m != 0).any(1).sum())
    found = pca.all_components(spark.createDataFrame(rows, CALLS), numbers=64 * samples)
    blocks = found.blocks.orderBy("j").collect()
    assert len(blocks) == -(-samples // 64)
    v = np.concatenate([np.frombuffer(r.v).reshape(-1, r.cols) for r in blocks], 1)
    e = np.concatenate([r.e for r in blocks])
    assert np.allclose(np.sort(e)[::-1], values, atol=1e-9) and np.allclose(m @ v, v * e, atol=1e-7) and np.allclose(v.T @ v, np.eye(samples), atol=1e-12)
    sums = pca.inner_products(found).agg(F.sum("lengths"), F.sum("products")).first()
    assert abs(sums[0] - samples) < 1e-9 and sums[1] < 1e-8


def test_blocks_equal_pairs(spark, p):
    want = sorted(kinship.king_table(p.calls).collect())
    assert sorted(kinship.king_blocked(p.calls, block=3, sites=20).collect()) == want
    assert sorted(kinship.king_blocked(p.calls).collect()) == want
    assert kinship.king_blocked(p.calls.limit(0)).count() == 0


def test_relatives_go_until_none_is_left(spark, p):
    king = spark.createDataFrame([("a", "b", 0.3), ("b", "c", 0.3), ("c", "d", 0.3), ("e", "f", 0.01)], "iid1 string, iid2 string, kinship double")
    gone = {r.sample for r in kinship.remove_relatives(king).collect()}
    assert not [r for r in king.filter("kinship >= 0.125").collect() if r.iid1 not in gone and r.iid2 not in gone]
    assert gone <= {"a", "b", "c", "d"} and len(gone) == 2


def test_downsampling_keeps_mates_together(spark, p):
    a, b = coverage.downsample(p.reads, 0.3)
    assert a.count() + b.count() == p.reads.count()
    assert a.select("qname").intersect(b.select("qname")).count() == 0
    with pytest.raises(ValueError):
        coverage.keep_fraction(1.0, 2.0)


def test_trimming():
    t = reads.Trimming(leading=20, trailing=20, window=3, window_quality=15, average=20, least=3)
    assert reads.trim_bounds("ACGTACGT", "#IIIIII#", t) == (1, 7)
    assert reads.trim_bounds("ACGTACGT", "IIII##II", t)[0] == 0
    assert reads.trim_bounds("ACGT", "####", t) == (0, 0)
    assert reads.trim_bounds("ACGTAGATCGGAAG", "I" * 14, reads.Trimming(least=3, adapters=("AGATCGGAAGAGC",))) == (0, 4)


def plain_bounds(q, t):
    """One read's cut points, base by base."""
    start = next((i for i, x in enumerate(q) if x >= t.leading), len(q))
    end = next((i + 1 for i in range(len(q) - 1, start - 1, -1) if q[i] >= t.trailing), start)
    for i in range(start, end - t.window + 1):
        if sum(q[i : i + t.window]) < t.window_quality * t.window:
            end = i
            while q[end] >= t.window_quality:
                end += 1
            break
    ok = end > start and end - start >= t.least and sum(q[start:end]) >= t.average * (end - start)
    return (start, end) if ok else (0, 0)


def plain_adapter(seq, qual, t):
    for i in range(len(seq)):
        for a in t.adapters:
            pairs = list(zip(a, seq[i:], qual[i:], strict=False))
            if sum(x != y for x, y, _ in pairs[: t.seed]) <= t.mismatches and sum(602 if x == y else -100 * (ord(q) - 33) for x, y, q in pairs) >= 1000 * t.score:
                return i
    return len(seq)


def some_reads(n, seed):
    rng = np.random.default_rng(seed)
    letters = lambda k, of: "".join(rng.choice(list(of), k))
    out = []
    for i in range(n):
        seq = letters(int(rng.integers(0, 90)), "ACGTN")
        if i % 3 == 0:
            seq += "AGATCGGAAGAGCACACG"[: int(rng.integers(1, 18))]
        if i % 9 == 0 and len(seq) > 4:
            seq = seq[:-3] + "T" + seq[-2:]
        out.append((i, seq, letters(len(seq), "#(2:DI")))
    return out


def test_trimming_and_clipping_of_batches_equal_one_by_one(spark):
    rows = some_reads(600, 5) + [(600, None, None), (601, "", "")]
    df = spark.createDataFrame([(i, 10, len(s or ""), s, q) for i, s, q in rows], "read_id int, start0 bigint, read_len bigint, seq string, qual string")
    for t in (reads.Trimming(least=5), reads.Trimming(leading=3, trailing=25, window=4, window_quality=20, average=10, least=1)):
        got = {r.read_id: r for r in reads.trim_reads(df, t).collect()}
        for i, s, q in rows:
            a, b = plain_bounds([ord(x) - 33 for x in q or ""], t)
            assert (got[i].seq, got[i].qual) == ((s or "")[a:b] if s is not None else None, (q or "")[a:b] if q is not None else None) and (got[i].start0, got[i].read_len, got[i].kept) == (10 + a, b - a, b > a)
    t = reads.Trimming(adapters=("AGATCGGAAGAGCACACG", "TTTTTTTTTT"), score=3.0)
    got = {r.read_id: r for r in reads.clip_adapters(df, t).collect()}
    ends = {i: plain_adapter(s or "", q or "", t) for i, s, q in rows}
    assert all((got[i].seq or "") == (s or "")[: ends[i]] and got[i].clipped == len(s or "") - ends[i] for i, s, _ in rows)
    assert sum(e < len(s or "") for (_, s, _), e in zip(rows, ends.values(), strict=True)) > 60


def test_mates_show_where_their_fragment_ends(spark):
    rng = np.random.default_rng(3)
    turn = lambda s: s.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    rows = []
    for i, size in enumerate((40, 60, 75, 99, 100, 140)):
        f = "".join(rng.choice(list("ACGT"), size))
        for mate, strand, adapter in ((1, f, reads.PAIRED_ADAPTERS[0]), (2, turn(f), reads.PAIRED_ADAPTERS[1])):
            seq = (strand + adapter * 3)[:100]
            seq = seq[:20] + ("A" if seq[20] != "A" else "C") + seq[21:] if mate == 1 and i == 1 else seq
            rows.append((10 * i + mate, f"f{i}", mate, "s", seq, "I" * 100, 100))
    rows.append((99, "alone", 1, "s", "ACGT" * 25, "I" * 100, 100))
    df = spark.createDataFrame(rows, "read_id bigint, qname string, mate bigint, sample string, seq string, qual string, read_len bigint")
    got = {(r.qname, r.mate): (len(r.seq), len(r.qual), r.clipped) for r in reads.clip_pairs(df, reads.Trimming()).collect()}
    for i, size in enumerate((0, 60, 75, 99, 100, 140)):  # an overlap of 40 bases can't reach the score
        end = min(size or 100, 100)
        assert got[f"f{i}", 1] == got[f"f{i}", 2] == (end, end, 100 - end)
    assert got["alone", 1] == (100, 100, 0)
    both = reads.clip_pairs(df, reads.Trimming(adapters=reads.PAIRED_ADAPTERS)).filter("qname = 'f0'").collect()
    assert [(len(r.seq), r.clipped) for r in both] == [(40, 60)] * 2


def test_alignment_arithmetic(spark):
    df = spark.createDataFrame([("5S10M2D3I4M6S3H", 100), ("*", 7), (None, 7), ("4H8=1X5=", 0), ("10M100N5M", 50)], "cigar string, start0 bigint")
    c_ = F.col("cigar")
    got = df.select(
        cigar.reference_length(c_).alias("ref"), cigar.length_on(c_, cigar.ON_READ).alias("read"), cigar.clips(c_, False).alias("a"), cigar.clips(c_, True).alias("b"), cigar.clips(c_, True, "S").alias("s"), cigar.aligned_pieces(c_).alias("p"),
        cigar.unclipped_end5(F.col("start0"), c_, F.lit(False)).alias("fwd"), cigar.unclipped_end5(F.col("start0"), c_, F.lit(True)).alias("rev"),
    ).collect()
    assert [(r.ref, r.read, r.a, r.b, r.s, r.fwd, r.rev) for r in got] == [(16, 28, 5, 9, 6, 95, 125), (0, 0, 0, 0, 0, 7, 7), (0, 0, 0, 0, 0, 7, 7), (14, 14, 4, 0, 0, -4, 14), (115, 15, 0, 0, 0, 50, 165)]
    assert [[tuple(x) for x in r.p] for r in got] == [[(5, 0, 10), (18, 12, 4)], [], [], [(0, 0, 8), (8, 8, 1), (9, 9, 5)], [(0, 0, 10), (10, 110, 5)]]


def test_depth_runs_equal_a_base_by_base_count(spark):
    rng = np.random.default_rng(8)
    rows = [("s", f"Chr0{i % 2}", int(rng.integers(0, 300)), str(rng.choice(["20M", "5S30M", "10M20N10M", "*", "8M3D8M"])), int(rng.choice([0, 0, 0, 4, 1024, 256]))) for i in range(200)]
    df = spark.createDataFrame(rows, "sample string, chrom string, start0 bigint, cigar string, flag bigint")
    for fast in (True, False):
        depth = {}
        for _, chrom, start, text, flag in rows:
            at = start
            for n, op in re.findall("([0-9]+)([MIDNSHP=X])", text) if not flag & 1796 else []:
                for k in range(int(n) if op in "MDN" else 0):
                    depth[chrom, at + k] = depth.get((chrom, at + k), 0) + (fast or op == "M")
                at += int(n) if op in "MDN" else 0
        got = coverage.depth_runs(df, fast, bucket=32).orderBy("chrom", "start0").collect()
        assert {(r.chrom, x): r.depth for r in got for x in range(r.start0, r.end0)} == {k: v for k, v in depth.items() if v}
        assert not [1 for a, b in zip(got, got[1:], strict=False) if a.chrom == b.chrom and a.end0 == b.start0 and a.depth == b.depth]
        bins = lambda d: sorted(map(tuple, d.collect()))
        assert bins(coverage.binned(coverage.depth_runs(df, fast, 32), 50)) == bins(coverage.coverage_bins(df, 50, fast))


def test_joint_genotypes(spark):
    rows = [("s1", "Chr01", 5, "G", 1, 9, 30), ("s2", "Chr01", 5, "<NON_REF>", 0, 9, 30), ("s3", "Chr01", 5, "G", 2, 9, 30)]
    df = spark.createDataFrame(rows, "sample string, chrom string, pos bigint, alt string, dosage int, dp int, gq int")
    out = {r["sample"]: r for r in gvcf.joint_genotypes(gvcf.with_likelihoods(df)).collect()}
    assert [out[s].dosage for s in ("s1", "s2", "s3")] == [1, 0, 2]
    assert out["s1"].ac == 3 and out["s1"].an == 6 and abs(out["s1"].af - 0.5) < 0.01 and out["s1"].qual > 20


def test_lines_after_repair_are_valid(spark, p):
    fixed = lines.repair_lines(p.vcf_lines, 11)
    whole, short = lines.drop_short(fixed.select("line_no", "line"), 11)
    assert lines.validate_lines(whole, 11).filter("severity = 'error'").count() == 0
    assert whole.count() + short.count() == p.vcf_lines.count()


def test_next_step_and_choice_of_files(spark):
    st = spark.createDataFrame([("d", "1a", True), ("d", "1b", False), ("e", "1a", True), ("e", "1b", True), ("e", "1c", True), ("e", "1d", True)], "dataset string, step string, complete boolean")
    assert {r.dataset: r.next_step for r in inventory.next_step(st).collect()} == {"d": "1b", "e": None}
    files = spark.createDataFrame([("/x/merged.vcf.gz",), ("/x/a_Chr00.vcf.gz",), ("/x/a_Chr01.vcf.gz",)], "path string")
    assert [r.path for r in inventory.pick_merged_or_list(files).collect()] == ["/x/merged.vcf.gz"]
    assert [r.path for r in inventory.pick_merged_or_list(files, force_concat=True).collect()] == ["/x/a_Chr01.vcf.gz"]
    with pytest.raises(ValueError):
        inventory.sample_map(files)


VCF = """##fileformat=VCFv4.2
#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS1\tS2
Chr01\t10\t.\tA\tG\t50\tPASS\tQD=2.5;IMP;MQ=60\tGT:DP\t0/1:7\t./.:.
Chr01\t20\t.\tA\tG,T\t.\t.\tQD=.\tGT\t1|2\t0/0
"""


def test_read_vcf(spark, tmp_path):
    with gzip.open(tmp_path / "a.vcf.gz", "wt") as f:
        f.write(VCF)
    variants, calls = vcf.read_vcf(spark, str(tmp_path / "a.vcf.gz"))
    rows = {r.pos: r for r in variants.collect()}
    assert rows[10].qd == 2.5 and rows[10].imp == 1 and rows[10].mq == 60 and rows[20].qual is None and rows[20].alt == ["G", "T"] and rows[20].qd is None
    assert sorted((r.pos, r["sample"], r.gt, r.dp, r.dosage) for r in calls.collect()) == [(10, "S1", "0/1", 7, 1), (10, "S2", "./.", None, None), (20, "S1", "1|2", None, 2), (20, "S2", "0/0", None, 0)]
    lengths = spark.createDataFrame([("1", 1000)], "contig string, length bigint")
    assert prepare_for_phasing(variants, lengths, "impute").count() == 3


def test_text_readers(spark, tmp_path):
    (tmp_path / "s_1.fastq").write_text("@r1/1\nACGT\n+\nIIII\n@r2/1\nGGGG\n+\n@III\n")
    got = {r.qname: r for r in vcf.read_fastq(spark, str(tmp_path / "s_1.fastq")).collect()}
    assert set(got) == {"r1", "r2"} and got["r2"].qual == "@III" and got["r1"].seq == "ACGT" and got["r1"].mate == 1 and got["r1"]["sample"] == "s"
    (tmp_path / "x.sam").write_text("@HD\tVN:1.6\tSO:coordinate\n@RG\tID:x\tSM:x\nr1\t16\tChr01\t5\t60\t4M\t*\t0\t0\tACGT\tIIII\n")
    header, rows = vcf.read_sam(spark, str(tmp_path / "x.sam"))
    assert header.count() == 2 and rows.first().start0 == 4 and rows.first().strand == "-"
    assert reads.check_sample_tag(header).first().status == "ok" and reads.sort_order(header).first().sorted
    (tmp_path / "l.txt").write_text(" S1\r\n\nS2 \n")
    assert [r["sample"] for r in vcf.read_list(spark, str(tmp_path / "l.txt")).collect()] == ["S1", "S2"]
    (tmp_path / "m.tsv").write_text("CHROM\tPOS\tQUAL\nChr01\t5\tNA\n")
    assert vcf.read_metrics(spark, str(tmp_path / "m.tsv"), ["POS"]).first().QUAL is None
    with pytest.raises(ValueError):
        vcf.read_metrics(spark, str(tmp_path / "m.tsv"), ["DP"])
    (tmp_path / "k.tsv").write_text("#FID\tIID\n1\ta\n")
    assert vcf.read_plink_table(spark, str(tmp_path / "k.tsv")).columns == ["fid", "iid"]
    (tmp_path / "r.fai").write_text("Chr02\t9\t100\t60\t61\nChr01\t5\t10\t60\t61\n")
    assert [(r.contig, r.ord) for r in vcf.read_fai(spark, str(tmp_path / "r.fai")).orderBy("ord").collect()] == [("Chr01", 1), ("Chr02", 2)]
    (tmp_path / "b.bed").write_text("Chr01\t0\t250\t3.5\n")
    assert vcf.read_bed(spark, str(tmp_path / "b.bed")).first().coverage == 3.5
    (tmp_path / "p.txt").write_text("geno=0.05\nname=x\n")
    assert {r.key: r.number for r in vcf.read_params(spark, str(tmp_path / "p.txt")).collect()} == {"geno": 0.05, "name": None}
    assert vcf.schema_mode_ok(["MEAN_DEPTH", "QD", "MQ"], "standard") and not vcf.schema_mode_ok(["AF", "DR2", "IMP", "QD"], "standard")


def test_writers_and_package(spark, p, tmp_path):
    m = k.site_metrics(p.sites, p.calls)
    sinks.write_metrics(m, str(tmp_path / "m"))
    assert spark.read.csv(str(tmp_path / "m"), sep="\t", header=True).count() == m.count()
    sinks.write_callset(p.sites, str(tmp_path / "c"), 3)
    assert spark.read.parquet(str(tmp_path / "c")).count() == p.sites.count()
    sinks.write_bed(coverage.merge_coverage(p.coverage_bins), str(tmp_path / "b"))
    sinks.write_depth(k.depth_per_position(p.variants, p.calls), k.depth_per_sample(p.calls), str(tmp_path / "d"))
    sinks.write_counts(k.snp_counts_with_total(k.snp_counts(p.variants, p.calls)), str(tmp_path / "n"))
    samples = sinks.annotate_samples(p.samples, p.samples, p.samples.limit(0))
    there = sinks.export_report_package(str(tmp_path / "pkg"), "d", m, samples=samples, kinship=kinship.king_table(p.calls), pca=None)
    assert there == ["site_metrics", "samples", "kinship"]
    manifest = json.loads(spark.read.text(str(tmp_path / "pkg/manifest")).first()[0])
    assert manifest["counts"]["n_sites"] == m.count() and manifest["sections"] == there
    assert spark.read.parquet(str(tmp_path / "pkg/site_metrics")).count() == m.count()


def test_refresh_touches_stale_chromosomes_alone(spark, p, tmp_path):
    out = str(tmp_path / "metrics")
    sinks.write_site_metrics(k.site_metrics(p.sites, p.calls).withColumn("call_rate", F.lit(-1.0)), out)
    sources = spark.createDataFrame([("Chr01", 5), ("Chr02", 5)], "partition string, mtime bigint")
    ledger = spark.createDataFrame([("Chr01", 9, "x"), ("Chr02", 1, "x")], "partition string, made_at bigint, params string")
    assert [r.partition for r in refresh_site_metrics(p.sites, p.calls, sources, ledger, "x", out).collect()] == ["Chr02"]
    rates = {r.chrom: r.r for r in spark.read.parquet(out).groupBy("chrom").agg(F.max("call_rate").alias("r")).collect()}
    assert rates["Chr01"] == -1.0 and rates["Chr02"] >= 0


def test_standard_table_and_its_combined_file(spark, tmp_path):
    sites = spark.createDataFrame([("Chr02", 5, 1, 3.0, 2.0, 50.0), ("Chr01", 7, 2, None, None, None), ("Chr01", 7, 3, 9.0, 1.0, 1.0)], "chrom string, pos bigint, site_key bigint, qual double, qd double, mq double")
    calls = spark.createDataFrame([("Chr02", 5, 1, "a", "0/1", 4), ("Chr02", 5, 1, "b", "./.", None), ("Chr01", 7, 3, "a", "1|1", 2)], "chrom string, pos bigint, site_key bigint, sample string, gt string, dp bigint")
    m = k.site_metrics(sites, calls)
    assert len(m.columns) == 18 and vcf.schema_mode_ok(m.columns, "standard") and not vcf.schema_mode_ok(m.columns, "imputed")
    rows = {(r.chrom, r.pos, r.qual): r for r in m.collect()}
    assert rows["Chr02", 5, 3.0].mean_depth == 4.0 and rows["Chr02", 5, 3.0].call_rate == 0.5 and rows["Chr02", 5, 3.0].heterozygous_rate == 1.0
    assert rows["Chr01", 7, None].total_genotypes == 0 and rows["Chr01", 7, None].mq is None and rows["Chr01", 7, 9.0].called_genotypes == 1
    path = str(tmp_path / "combined")
    sinks.write_combined_metrics(m, path)
    lines = [x for f in sorted((tmp_path / "combined").glob("part-*.txt")) for x in f.read_text().splitlines()]
    assert lines[0] == "\t".join(m.columns).upper() and [x.split("\t")[:2] for x in lines[1:]] == [["Chr01", "7"], ["Chr01", "7"], ["Chr02", "5"]]
    assert "NA" in lines[1].split("\t") and sum(x.startswith("CHROM") for x in lines) == 1
    with pytest.raises(ValueError, match="header"):
        vcf.read_combined_metrics(spark, path, ["chrom", "pos"])


def test_fastq_of_several_splits(spark, tmp_path):
    """Records lie across the borders of splits, qualities begin with @, a short record is left out."""
    rng = np.random.default_rng(2)
    want = []
    for name in ("a_1", "a_2", "b_1"):
        rows = [(f"{name}r{i}", "".join(rng.choice(list("ACGT"), k)), "@" * k) for i in range(40) for k in [int(rng.integers(1, 30))]]
        (tmp_path / f"{name}.fastq").write_text("".join(f"@{n}/1 x\n{s}\n+\n{q}\n" for n, s, q in rows) + ("@cut\nAC\n" if name == "b_1" else ""))
        want += [(name[0], n, int(name[2]), s, q, len(s)) for n, s, q in rows]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        found = vcf.read_fastq(spark, str(tmp_path / "*.fastq"))
        assert spark.read.text(str(tmp_path / "*.fastq")).rdd.getNumPartitions() > 10
        assert sorted(map(tuple, found.collect())) == sorted(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_named_text_in_pieces(spark, tmp_path):
    """A name of many lines is several files, each a piece of its order; what is read back is what was written, in its order."""
    from varideck.sources import sinks

    rows = [("a_1.fastq", i * i, f"@a{i}\nACGT\n+\n@II{i % 10}") for i in range(100)] + [("b_1.fastq", 5, "@b\nAC\n+\nII"), ("b_1.fastq", 5, "@c\nAC\n+\nII")]
    sinks.write_named_text(spark.createDataFrame(rows, "name string, ord bigint, line string"), str(tmp_path / "w"), most=20)
    files = sorted(f for f in (tmp_path / "w").iterdir() if "fastq" in f.name and not f.name.startswith("."))
    assert [f.name for f in files if f.name[0] == "a"] == [f"a_1.fastq.{k:05d}" for k in range(5)] and files[-1].name == "b_1.fastq"
    assert "".join(f.read_text() for f in files[:-1]) == "".join(x + "\n" for _, _, x in rows[:100])
    for size in ("300", "128m"):
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            found = sorted(tuple(r)[:5] for r in vcf.read_fastq(spark, str(tmp_path / "w")).collect())
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert found == sorted([("a", f"a{i}", 1, "ACGT", f"@II{i % 10}") for i in range(100)] + [("b", x, 1, "AC", "II") for x in "bc"])


def test_depth_runs_meet_over_borders(spark):
    """Runs go on over the borders of buckets, also over whole ones, and nothing is joined to know a bucket's depth."""
    rows = [("a", "c", s, f"{n}M", 0) for s, n in ((0, 100), (0, 32), (32, 32), (64, 1), (100, 28), (130, 0), (200, 5))] + [(None, "c", 5, "3M", 0)]
    found = coverage.depth_runs(spark.createDataFrame(rows, "sample string, chrom string, start0 bigint, cigar string, flag int"), False, bucket=32)
    assert sorted(map(tuple, found.filter("sample = 'a'").collect())) == [("a", "c", 0, 65, 2), ("a", "c", 65, 128, 1), ("a", "c", 200, 205, 1)]
    assert [tuple(r) for r in found.filter("sample is null").collect()] == [(None, "c", 5, 8, 1)]
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_known_sites_are_holes_of_packed_stretches(spark, p):
    packed = spark.createDataFrame([("a", 0, "ACGTACGTAC" * 7), ("a", 3, "ACGTACGTAC" * 7), ("b", 0, "AC")], "chrom string, block bigint, bases string")
    known = spark.createDataFrame([("a", 1), ("a", 1), ("a", 66), ("a", 70), ("a", 214), ("b", 3), ("c", 1)], "chrom string, pos bigint")
    got = {(r.chrom, r.block): r.bases for r in reads.masked(packed, known, 70).collect()}
    whole = "ACGTACGTAC" * 7
    assert got == {("a", 0): "." + whole[1:65] + "." + whole[66:69] + ".", ("a", 3): whole[:3] + "." + whole[4:], ("b", 0): "AC"}
    from varideck.plans import registry

    # The queries' reference is a row a stretch, not a row a base.
    assert registry.reference_of(p).columns == ["chrom", "block", "bases"]


def test_adapters_by_the_plain_rule(spark):
    """Reads of several lengths, adapters longer than the seed, qualities below the least letter: as a loop over places and bases finds them."""
    rng = np.random.default_rng(8)
    t = reads.Trimming(adapters=(reads.PAIRED_ADAPTERS[0], "AGATC"), score=2.0)
    for low in (33, 20):
        n = rng.integers(0, 50, 200)
        seq, qual = rng.choice(np.frombuffer(b"ACGTN", np.uint8), (200, 50)), rng.integers(low, 75, (200, 50)).astype(np.uint8)
        for i in range(0, 200, 2):
            a = np.frombuffer(t.adapters[0].encode(), np.uint8)[: 50 - i // 4]
            seq[i, i // 4 : i // 4 + len(a)] = a
        want = []
        for s, q, size in zip(seq, qual, n, strict=True):
            starts = [size]
            for adapter in map(str.encode, t.adapters):
                for i in range(size):
                    both = [(s[i + k] == x, int(q[i + k]) - 33) for k, x in enumerate(adapter) if i + k < size]
                    if sum(not f for f, _ in both[: t.seed]) <= t.mismatches and sum(602 if f else -100 * c for f, c in both) >= 2000:
                        starts.append(i)
            want.append(min(starts))
        inside = np.arange(50) < n[:, None]
        assert reads.adapter_starts(np.where(inside, seq, 0).astype(np.uint8), np.where(inside, qual, 33).astype(np.uint8), n, t).tolist() == want
    uneven = spark.createDataFrame([("ACGT", "III", 4), ("ACGT", "IIII", 4)], "seq string, qual string, read_len bigint")
    with pytest.raises(Exception, match="another number of qualities"):
        reads.clip_adapters(uneven, t).collect()


def test_schema_of_partitions(spark, tmp_path):
    path = str(tmp_path / "m")
    assert inventory.partition_schemas(spark, path).count() == 0
    df = spark.createDataFrame([("a", ["CHROM", "MEAN_DEPTH", "QD", "MQ"]), ("b", ["AF", "DR2", "IMP"]), ("c", ["mean_depth", "qd", "mq", "dr2"]), ("d", []), ("e", None)], "partition string, columns array<string>")
    fits = {m: {r.partition: r.x for r in df.select("partition", inventory.fits_mode(F.col("columns"), m).alias("x")).collect()} for m in ("standard", "imputed")}
    assert fits["standard"] == {"a": True, "b": False, "c": False, "d": False, "e": None} and fits["imputed"] == {"a": False, "b": True, "c": False, "d": False, "e": None}
    sources = df.select("partition", F.lit(1).alias("mtime"))
    stale = inventory.stale_partitions(sources, df.select("partition", F.lit(1).alias("made_at"), F.lit("x").alias("params")), "x", df)
    assert {(r.partition, r.reason) for r in stale.collect()} == {("b", "other schema"), ("c", "other schema"), ("d", "other schema"), ("e", "missing")}


def test_fractions_are_checked(spark):
    depths = spark.createDataFrame([("a", 2.0), ("b", 0.5), ("c", None)], "sample string, depth double")
    assert sorted(map(tuple, coverage.checked_fractions(depths, 0.5).collect())) == [("a", 0.25, True), ("b", None, False), ("c", None, False)]
    with pytest.raises(ValueError, match="positive"):
        coverage.checked_fractions(depths, 0.0)
