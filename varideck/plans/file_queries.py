"""Registered queries of readers and writers: whole tables go to files in the shared folder and come back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calls as k
from ..operators import coverage
from ..operators import variants as v
from ..sources import sinks, vcf
from ..streaming.refresh import refresh_site_metrics
from .phasing import prepare_for_phasing
from .registry import ORACLES, SNP, STANDARD, query, records, standard_metrics

RATES = ["mean_depth", "call_rate", "missing_rate", "heterozygous_rate"]
COUNTS = ["dp_non_missing", "called_genotypes", "missing_genotypes", "total_genotypes", "heterozygous_count"]


def typed(raw):
    """Metrics as they were before they were text."""
    return raw.select("chrom", F.col("pos").cast("bigint").alias("pos"), *[F.col(x).cast("double").alias(x) for x in (*k.RECORD_COLUMNS, *RATES)], *[F.col(x).cast("bigint").alias(x) for x in COUNTS])


@query("K01_write_metrics", STANDARD, "sites", "calls")
def _(p):
    path = sinks.scratch(p.spark, "metrics")
    sinks.write_metrics(standard_metrics(p), path)
    return typed(p.spark.read.csv(path, sep="\t", header=True, nullValue="NA"))


@query("K01b_write_combined_metrics", STANDARD, "sites", "calls")
def _(p):
    path, m = sinks.scratch(p.spark, "combined-metrics"), standard_metrics(p)
    sinks.write_combined_metrics(m, path)
    return typed(vcf.read_combined_metrics(p.spark, path, m.columns))


@query("K02_write_site_metrics", STANDARD, "sites", "calls")
def _(p):
    """The second write replaces one chromosome alone."""
    path, m = sinks.scratch(p.spark, "site-metrics"), standard_metrics(p)
    sinks.write_site_metrics(m.withColumn("call_rate", F.when(F.col("chrom") == "Chr01", -1.0).otherwise(F.col("call_rate"))), path)
    sinks.write_site_metrics(m.filter("chrom = 'Chr01'"), path)
    return typed(p.spark.read.parquet(path))


@query("K03_write_parquet", "SELECT site_key, chrom, pos, qual, filter FROM sites", "sites")
def _(p):
    path = sinks.scratch(p.spark, "sites")
    sinks.write_parquet(p.sites.select("site_key", "chrom", "pos", "qual", "filter"), path, "zstd")
    return p.spark.read.parquet(path)


@query("K04_write_counts")
def _(p):
    path = sinks.scratch(p.spark, "counts")
    sinks.write_counts(k.snp_counts_with_total(k.snp_counts(p.variants, p.calls)), path)
    raw = p.spark.read.csv(path, header=True)
    return raw.select("scope", "chr_label", "sample", *[F.col(x).cast("bigint").alias(x) for x in raw.columns if x.startswith("n_")])


ORACLES["K04_write_counts"] = ORACLES["A04_snp_counts_with_total"]


@query("K06_export_report_package", "SELECT 'site_metrics' AS section, (SELECT count(*) FROM (SELECT DISTINCT chrom, pos FROM calls)) AS n UNION ALL SELECT 'samples', count(*) FROM samples UNION ALL SELECT 'counts', (SELECT count(*) FROM (SELECT DISTINCT chrom, sample FROM sites, samples)) UNION ALL SELECT 'manifest', 1", "sites", "samples", "calls")
def _(p):
    path = sinks.scratch(p.spark, "package")
    samples = sinks.annotate_samples(p.samples, p.samples.filter("k % 5 <> 0"), p.samples.filter("k % 7 = 0"))
    there = sinks.export_report_package(path, "cohort", standard_metrics(p), samples=samples, counts=p.calls.select("chrom", "sample").distinct(), kinship=None)
    sizes = [p.spark.read.parquet(f"{path}/{x}").select(F.lit(x).alias("section")) for x in there] + [p.spark.read.text(f"{path}/manifest").select(F.lit("manifest").alias("section"))]
    return v.concatenate(sizes).groupBy("section").agg(F.count(F.lit(1)).alias("n"))


@query("K07_write_callset", "SELECT site_key, chrom, pos, alt FROM sites", "sites")
def _(p):
    path = sinks.scratch(p.spark, "callset")
    sinks.write_callset(p.variants.select("site_key", "chrom", "pos", "alt"), path)
    return p.spark.read.parquet(path).withColumn("alt", F.array_join("alt", ","))


@query("K08_write_bed", "SELECT chrom, start0, max(end0) AS end0, round(CAST(sum(coverage) AS DOUBLE) / count(coverage), 6) AS coverage FROM coverage_bins GROUP BY 1, 2", "coverage_bins")
def _(p):
    path = sinks.scratch(p.spark, "bed")
    sinks.write_bed(coverage.merge_coverage(p.coverage_bins), path)
    return vcf.read_bed(p.spark, path, " ")


@query(
    "K09_write_depth",
    """SELECT 'site' AS kind, chrom || ':' || pos AS name, CAST(sum(dp) AS DOUBLE) AS depth FROM calls GROUP BY chrom, pos UNION ALL
    SELECT 'sample', sample, round(CAST(sum(dp) AS DOUBLE) / count(dp), 6) FROM calls GROUP BY sample HAVING count(dp) > 0""",
    "calls",
)
def _(p):
    path = sinks.scratch(p.spark, "depth")
    sinks.write_depth(k.site_depth(p.calls), k.depth_per_sample(p.calls), path)
    sites = p.spark.read.csv(f"{path}/sites", sep="\t", header=True, nullValue="NA").select(F.lit("site").alias("kind"), F.concat_ws(":", "chrom", "pos").alias("name"), F.col("sum_depth").cast("double").alias("depth"))
    return sites.union(p.spark.read.parquet(f"{path}/samples").select(F.lit("sample"), "sample", "mean_depth"))


@query("S10_read_metrics", "SELECT chrom, CAST(pos AS DOUBLE) AS pos, qual, qd FROM sites", "sites")
def _(p):
    """Missing values are written in all their spellings."""
    path = sinks.scratch(p.spark, "table")
    spelt = lambda x: F.coalesce(F.col(x).cast("string"), F.get(F.array(*map(F.lit, (".", "NA", "NaN", ""))), (F.col("site_key") % 4).cast("int"))).alias(x)
    p.sites.select("chrom", "pos", spelt("qual"), spelt("qd")).write.csv(path, sep="\t", header=True)
    return vcf.read_metrics(p.spark, path, ["chrom", "pos", "qual"])


@query("S11_read_plink_table", "SELECT CAST(k AS VARCHAR) AS fid, sample AS iid, CAST(k * 3 AS VARCHAR) AS pc1 FROM samples", "samples")
def _(p):
    path = sinks.scratch(p.spark, "eigenvec")
    p.samples.select(F.col("k").alias("#FID"), F.col("sample").alias("IID"), (F.col("k") * 3).alias("PC1")).write.csv(path, sep="\t", header=True)
    return vcf.read_plink_table(p.spark, path)


@query("S12_read_bed", "SELECT chrom, start0, end0, CAST(coverage AS DOUBLE) AS coverage FROM coverage_bins", "coverage_bins")
def _(p):
    path = sinks.scratch(p.spark, "bins")
    p.coverage_bins.select("chrom", "start0", "end0", "coverage").write.csv(path, sep="\t")
    return vcf.read_bed(p.spark, path)


@query("S13_read_fai", "SELECT chrom AS contig, count(*) * 1000 AS length, CAST(row_number() OVER (ORDER BY chrom) AS BIGINT) AS ord FROM sites GROUP BY 1", "sites")
def _(p):
    path = sinks.scratch(p.spark, "fai")
    contigs = p.sites.groupBy("chrom", "chrom_num").agg((F.count(F.lit(1)) * 1000).alias("length"))
    contigs.select(F.concat_ws("\t", "chrom", "length", F.col("chrom_num") * 10**7 + 8, F.lit(60), F.lit(61))).write.text(path)
    return vcf.read_fai(p.spark, path).withColumn("ord", F.col("ord").cast("bigint"))


@query("S14_read_list", "SELECT sample FROM samples", "samples")
def _(p):
    path = sinks.scratch(p.spark, "list")
    line = F.when(F.col("k") % 3 == 0, F.concat(F.lit("  "), "sample", F.lit(" \r"))).when(F.col("k") % 3 == 1, F.concat("sample", F.lit("\n \n"))).otherwise(F.col("sample"))
    p.samples.select(line).write.text(path)
    return vcf.read_list(p.spark, path)


@query("S16_read_fastq", "SELECT sample, qname, mate, seq, qual, read_len FROM reads", "reads")
def _(p):
    path = sinks.scratch(p.spark, "fastq")
    record = F.concat(F.lit("@"), "qname", F.lit("\n"), "seq", F.lit("\n+\n"), "qual")
    sinks.write_named_text(p.reads.select(F.concat("sample", F.lit("_"), "mate", F.lit(".fastq")).alias("name"), F.col("read_id").alias("ord"), record.alias("line")), path)
    return vcf.read_fastq(p.spark, path)


@query("S17_read_sam", "SELECT sample, qname, mate, chrom, start0, read_len, strand, mapq, cigar, flag, seq, qual FROM reads", "reads")
def _(p):
    path = sinks.scratch(p.spark, "sam")
    name = F.concat("sample", F.lit(".sorted.sam")).alias("name")
    body = p.reads.select(name, F.col("read_id").alias("ord"), F.concat_ws("\t", "qname", "flag", "chrom", F.col("start0") + 1, "mapq", "cigar", F.lit("*"), F.lit(0), F.lit(0), "seq", "qual").alias("line"))
    head = p.reads.select(name, F.lit(-1).cast("bigint").alias("ord"), F.lit("@HD\tVN:1.6\tSO:coordinate").alias("line")).distinct()
    sinks.write_named_text(body.union(head), path)
    return vcf.read_sam(p.spark, path)[1]


@query("F08_prepare_for_imputing", f"SELECT site_key, CAST(chrom_num AS VARCHAR) AS chrom FROM sites WHERE {SNP} UNION ALL SELECT site_key, CAST(chrom_num AS VARCHAR) FROM sites, (SELECT unnest([1, 2]) AS i) WHERE alt = 'G,T' AND length(ref) = 1", "sites")
def _(p):
    fai = p.sites.select(F.col("chrom_num").cast("string").alias("contig"), (F.lit(1000000) + F.col("chrom_num")).alias("length")).distinct()
    return prepare_for_phasing(p.variants, fai, "impute").select("site_key", "chrom")


@query("U02_concatenate_metrics", STANDARD, "sites", "calls")
def _(p):
    """One table of each half of the chromosomes, read back and put together under one header."""
    m, parts = standard_metrics(p), []
    for even in (True, False):
        parts.append(sinks.scratch(p.spark, "half"))
        sinks.write_metrics(m.filter((F.substring("chrom", 4, 2).cast("int") % 2 == 0) == even), parts[-1])
    return typed(v.concatenate([vcf.read_metrics(p.spark, x, ["pos", "mean_depth"]) for x in parts]))


@query("I02_refresh_site_metrics", STANDARD, "sites", "calls")
def _(p):
    """The chromosomes whose sources are newer are made again, the others stay."""
    path, m = sinks.scratch(p.spark, "refreshed"), standard_metrics(p)
    odd = F.substring("chrom", 4, 2).cast("int") % 2 == 1
    sinks.write_site_metrics(m.withColumn("call_rate", F.when(odd, -1.0).otherwise(F.col("call_rate"))), path)
    chroms = m.select("chrom").distinct().select(F.col("chrom").alias("partition"), F.when(odd, F.lit("2024-01-02")).otherwise(F.lit("2024-01-01")).alias("mtime"))
    refresh_site_metrics(records(p), p.calls, chroms, chroms.select("partition", F.lit("2024-01-01").alias("made_at"), F.lit("geno=1").alias("params")), "geno=1", path)
    return typed(p.spark.read.parquet(path))


@query("I03_schema_mode", STANDARD, "sites", "calls")
def _(p):
    """Two chromosomes' tables are of the imputed mode: they alone are made again, though nothing is newer."""
    path, m = sinks.scratch(p.spark, "moded"), standard_metrics(p)
    of_two = F.col("chrom").isin("Chr03", "Chr05")
    sinks.write_site_metrics(m.filter(~of_two), path)
    imputed = k.site_metrics_imputed(p.sites.withColumn("af", F.lit(0.5)), p.calls)
    sinks.write_site_metrics(imputed.filter(of_two), path)
    chroms = p.sites.select(F.col("chrom").alias("partition")).distinct()
    ledger = chroms.select("partition", F.lit("2024-01-01").alias("made_at"), F.lit("geno=1").alias("params"))
    stale = refresh_site_metrics(records(p), p.calls, chroms.withColumn("mtime", F.lit("2024-01-01")), ledger, "geno=1", path)
    found = {(r.partition, r.reason) for r in stale.collect()}  # a row a chromosome
    if not found <= {("Chr03", "other schema"), ("Chr05", "other schema")}:
        raise ValueError(f"made again: {found}")
    return typed(p.spark.read.parquet(path))


@query("Q08_keep_fractions", """WITH d AS (SELECT sample, CAST(sum(read_len) AS DOUBLE) / 100000 AS depth FROM reads GROUP BY 1) SELECT sample, CASE WHEN depth > 0.5 THEN round(0.5 / depth, 6) END AS fraction, depth > 0.5 AS ok FROM d""", "reads")
def _(p):
    """The share to keep of each sample, and whether its depth passes the check that keep_fraction makes of one."""
    depth = p.reads.groupBy("sample").agg((F.sum("read_len").cast("double") / 100000).alias("depth"))
    return coverage.checked_fractions(depth, 0.5)
