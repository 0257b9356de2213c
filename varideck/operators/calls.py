"""Operators over calls (chrom, pos, sample, gt, dp, dosage): metrics of sites and samples, counts, QC filters."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as c
from . import variants as v

SITE = ["chrom", "pos"]
#: Stands for no known depth while depths are gathered.
NO_DEPTH = np.iinfo(np.int64).min
#: Up to so many samples are columns of one aggregation.
FEW = 16


def n(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def rate(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0, to six places."""
    return F.round(F.coalesce(c.ratio(a, b), F.lit(0.0)), 6)


def class_of(calls: DataFrame) -> Column:
    """What each genotype is, as columns.gt_class says: calls may come with gt_class in the place of gt."""
    return F.col("gt_class") if "gt_class" in calls.columns else c.gt_class(F.col("gt"))


def missing_of(calls: DataFrame) -> Column:
    return F.col("gt_class") == 0 if "gt_class" in calls.columns else c.gt_missing(F.col("gt"))


def by_sample(calls: DataFrame, by: list[str], names: DataFrame | None, *sums: Column) -> DataFrame:
    """Sums or counts of each group. names: where calls have numbers for samples, sample (the number) and name, once each; the sums of the
    numbers that share a name are added up."""
    out = calls.groupBy(*by).agg(*sums)
    if names is None:
        return out
    values = [x for x in out.columns if x not in by]
    return out.join(names, "sample", "left").withColumn("sample", F.col("name")).groupBy(*by).agg(*[F.sum(x).alias(x) for x in values])


def genotypes(calls: DataFrame) -> DataFrame:
    """calls with allele1, allele2, phased and dosage from gt."""
    a = c.alleles(F.col("gt"))
    part = lambda i: F.get(a, F.lit(i)).try_cast("int")
    return calls.withColumns({"allele1": part(0), "allele2": part(1), "phased": c.gt_phased(F.col("gt")), "dosage": c.gt_dosage(F.col("gt"))})


#: The columns that a site's metrics take over from its record.
RECORD_COLUMNS = ("qual", "qd", "ac", "af", "inbreeding_coeff", "excess_het", "mq")
GENOTYPE_COLUMNS = (
    "mean_depth", "call_rate", "missing_rate", "heterozygous_rate", "dp_non_missing", "called_genotypes", "missing_genotypes", "total_genotypes", "heterozygous_count",
)


def genotype_metrics(calls: DataFrame, *more: str) -> DataFrame:
    """Depth, call rates and counts of each site from its calls alone, in one aggregation: half-missing and haploid genotypes are neither
    missing nor called. more: further keys that a site has, which are kept."""
    classed = calls.select(*SITE, *more, "dp", class_of(calls).alias("_k"))
    k = F.col("_k")
    out = classed.groupBy(*SITE, *more).agg(
        F.count(F.lit(1)).alias("total_genotypes"), n(k == 0, "missing_genotypes"), n(k.between(1, 3), "called_genotypes"), n(k == 2, "heterozygous_count"), F.count("dp").alias("dp_non_missing"), F.sum("dp").alias("_dp")
    )
    total, missing = F.col("total_genotypes"), F.col("missing_genotypes")
    return out.select(
        *SITE, *more, rate(F.col("_dp"), F.col("dp_non_missing")).alias("mean_depth"), rate(total - missing, total).alias("call_rate"), rate(missing, total).alias("missing_rate"),
        rate(F.col("heterozygous_count"), F.col("called_genotypes")).alias("heterozygous_rate"), "dp_non_missing", "called_genotypes", "missing_genotypes", "total_genotypes", "heterozygous_count",
    )


def site_metrics(variants: DataFrame, calls: DataFrame, named: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The standard table of a call set, a row a record and 18 columns: what the record says (NULL where it doesn't, or the table lacks the
    column) and what its genotypes say (0 for a record without calls). Records of one place are told apart where both sides have site_key. named: puts the names of chromosomes
    where calls have numbers."""
    more = ["site_key"] if "site_key" in variants.columns and "site_key" in calls.columns else []
    said = [F.col(x).cast("double").alias(x) if x in variants.columns else F.lit(None).cast("double").alias(x) for x in RECORD_COLUMNS]
    counted = genotype_metrics(calls, *more) if named is None else named(genotype_metrics(calls, *more))
    joined = variants.select(*SITE, *more, *said).join(counted, [*SITE, *more], "left")
    return joined.select(*SITE, *RECORD_COLUMNS, *[F.coalesce(x, F.lit(0)).alias(x) for x in GENOTYPE_COLUMNS])


def site_metrics_imputed(variants: DataFrame, calls: DataFrame, named: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Metrics of imputed sites, with their qual, af (NULL where the table has none), dr2 and imp: everything that isn't wholly missing counts
    as called. named: as in site_metrics."""
    k = F.col("_k")
    classed = calls.select(*SITE, class_of(calls).alias("_k"))
    out = classed.groupBy(*SITE).agg(F.count(F.lit(1)).alias("total_genotypes"), n(k == 0, "missing_genotypes"), n(k > 0, "called_genotypes"), n(k.isin(2, 4), "heterozygous_count"))
    total, missing, called = F.col("total_genotypes"), F.col("missing_genotypes"), F.col("called_genotypes")
    rates = out.select(
        *SITE, rate(called, total).alias("call_rate"), rate(missing, total).alias("missing_rate"), rate(F.col("heterozygous_count"), called).alias("heterozygous_rate"),
        "called_genotypes", "missing_genotypes", "total_genotypes", "heterozygous_count",
    )
    af = F.col("af") if "af" in variants.columns else F.lit(None).cast("double").alias("af")
    return variants.select(*SITE, "qual", af, "dr2", "imp").join(rates if named is None else named(rates), SITE)


def snp_counts(variants: DataFrame, calls: DataFrame, allowed: tuple[str, ...] = ("PASS", "."), names: DataFrame | None = None) -> DataFrame:
    """Counts of each sample on each chromosome, on biallelic SNPs with an allowed filter. names: as in by_sample."""
    sites = v.filter_status(v.biallelic_snps(variants), allowed).select("site_key")
    k = F.col("_k")
    classed = calls.join(sites, "site_key", "left_semi").select(F.col("chrom").alias("chr_label"), "sample", class_of(calls).alias("_k"))
    return with_totals(by_sample(classed, ["chr_label", "sample"], names, n(k == 1, "n_refhom"), n(k == 3, "n_homalt"), n(k == 2, "n_het"), n(~k.between(1, 3), "n_missing")))


def with_totals(counts: DataFrame) -> DataFrame:
    called = F.col("n_refhom") + F.col("n_homalt") + F.col("n_het")
    return counts.withColumn("n_called", called).withColumn("n_total", F.col("n_called") + F.col("n_missing"))


def snp_counts_with_total(counts: DataFrame) -> DataFrame:
    """The counts of snp_counts and a TOTAL row for each sample, in one pass of grouping sets."""
    sums = [F.sum(x).alias(x) for x in ("n_called", "n_missing", "n_total", "n_refhom", "n_homalt", "n_het")]
    sets = counts.groupingSets([[F.col("sample"), F.col("chr_label")], [F.col("sample")]], F.col("sample"), F.col("chr_label")).agg(F.grouping("chr_label").alias("_t"), *sums)
    total = F.col("_t") == 1
    return sets.withColumns({"scope": F.when(total, "TOTAL").otherwise("CHR"), "chr_label": F.when(total, "TOTAL").otherwise(F.col("chr_label"))}).drop("_t")


def counts_order(counts: DataFrame) -> DataFrame:
    """CHR rows by label and sample, then TOTAL rows by sample."""
    return counts.orderBy("scope", "chr_label", "sample")


def depth_per_position(variants: DataFrame, calls: DataFrame) -> DataFrame:
    """Mean depth (NULL without any) and missingness in percent, two places, of SNP sites on Chr01 to Chr17."""
    sites = v.chrom_range(v.snps(variants)).select("site_key")
    out = calls.join(sites, "site_key", "left_semi").groupBy(*SITE).agg(F.sum("dp").alias("_s"), F.count("dp").alias("_n"), n(missing_of(calls), "_m"), F.count(F.lit(1)).alias("_t"))
    return out.select(*SITE, F.round(c.ratio(F.col("_s"), F.col("_n")), 2).alias("mean_dp"), F.round(c.ratio(F.col("_m") * 100, F.col("_t")), 2).alias("missingness"))


def depth_per_sample(calls: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Mean depth of each sample that has any. names: as in by_sample."""
    out = by_sample(calls, ["sample"], names, F.sum("dp").alias("_s"), F.count("dp").alias("_n")).filter("_n > 0")
    return out.select("sample", F.round(c.ratio(F.col("_s"), F.col("_n")), 6).alias("mean_depth"))


def missingness(calls: DataFrame, *by: str, names: DataFrame | None = None) -> DataFrame:
    """The share of missing genotypes of each group. names: as in by_sample."""
    out = by_sample(calls, list(by), names, n(missing_of(calls), "n_missing"), F.count(F.lit(1)).alias("n_total"))
    return out.withColumn("missing_fraction", F.round(c.ratio(F.col("n_missing"), F.col("n_total")), 6))


def site_depth(calls: DataFrame) -> DataFrame:
    """Summed and mean depth of each site."""
    return calls.groupBy(*SITE).agg(F.sum("dp").alias("sum_depth"), F.count("dp").alias("_n")).select(*SITE, "sum_depth", F.round(c.ratio(F.col("sum_depth"), F.col("_n")), 6).alias("mean_depth"))


def snp_count(variants: DataFrame) -> DataFrame:
    return v.snps(variants).agg(F.count(F.lit(1)).alias("n_snps"))


def callset_summary(variants: DataFrame, n_samples: DataFrame) -> DataFrame:
    """key, value rows: records, samples, SNPs, MNPs (all alleles of one length above 1), indels (an allele of another length), other sites
    (symbolic alleles, *, breakends, no allele), multiallelic sites, transitions and transversions. n_samples: a one-row table."""
    plain = F.coalesce((F.size("alt") > 0) & F.forall("alt", lambda a: a.rlike("^[A-Za-z]+$")), F.lit(False))
    alike = plain & F.forall("alt", lambda a: F.length(a) == F.length("ref"))
    one_base = alike & (F.length("ref") == 1)
    first = F.concat(F.col("ref"), F.get("alt", F.lit(0)))
    ts = first.isin("AG", "GA", "CT", "TC")
    bi = v.is_biallelic_snp()
    out = variants.agg(F.count(F.lit(1)).alias("records"), n(one_base, "snps"), n(alike & ~one_base, "mnps"), n(plain & ~alike, "indels"), n(~plain, "others"), n(F.size("alt") > 1, "multiallelic"), n(bi & ts, "transitions"), n(bi & ~ts, "transversions"))
    out = out.join(n_samples.select(F.col(n_samples.columns[0]).cast("bigint").alias("samples")), how="cross")  # one row and one row
    return out.unpivot([], ["records", "samples", "snps", "mnps", "indels", "others", "multiallelic", "transitions", "transversions"], "key", "value")


def variant_count_gate(variants: DataFrame, least: int = 10) -> DataFrame:
    """Each chromosome's count, and whether it has enough to be phased."""
    return variants.groupBy("chrom").agg(F.count(F.lit(1)).alias("n_variants")).withColumn("enough", F.col("n_variants") >= least)


def allele_stats(calls: DataFrame) -> DataFrame:
    """ac, an and af of each site from known genotypes."""
    out = calls.groupBy(*SITE).agg(F.coalesce(F.sum("dosage"), F.lit(0)).cast("bigint").alias("ac"), (2 * F.count("dosage")).alias("an"))
    return out.withColumn("af", F.round(c.ratio(F.col("ac"), F.col("an")), 6))


def filter_geno(calls: DataFrame, most: float) -> DataFrame:
    """Calls at sites whose share of unknown genotypes is at most this."""
    keep = calls.groupBy("site_key").agg(F.count_if(F.col("dosage").isNull()).alias("_m"), F.count(F.lit(1)).alias("_t")).filter(c.ratio(F.col("_m"), F.col("_t")) <= most).select("site_key")
    return calls.join(keep, "site_key", "left_semi")


def unknown_of_samples(calls: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """sample, unknown: its share of unknown genotypes. names: as in by_sample."""
    counted = by_sample(calls, ["sample"], names, F.count_if(F.col("dosage").isNull()).alias("_m"), F.count(F.lit(1)).alias("_t"))
    return counted.select("sample", c.ratio(F.col("_m"), F.col("_t")).alias("unknown"))


def complete_samples(calls: DataFrame, most: float, names: DataFrame | None = None) -> DataFrame:
    """Samples whose share of unknown genotypes is at most this. names: as in by_sample."""
    return unknown_of_samples(calls, names).filter(F.col("unknown") <= most).select("sample")


def filter_mind(calls: DataFrame, most: float) -> DataFrame:
    """Calls of samples whose share of unknown genotypes is at most this."""
    return calls.join(complete_samples(calls, most), "sample", "left_semi")


def filter_maf(calls: DataFrame, least: float = 0.01) -> DataFrame:
    """Calls at sites whose rarer allele has at least this share."""
    af = c.ratio(F.col("_ac"), 2 * F.col("_n"))
    keep = calls.groupBy("site_key").agg(F.sum("dosage").alias("_ac"), F.count("dosage").alias("_n")).filter(F.least(af, 1 - af) >= least).select("site_key")
    return calls.join(keep, "site_key", "left_semi")


def sample_variant_qc(calls: DataFrame, geno: float = 1.0, mind: float = 1.0, maf: float = 0.01) -> DataFrame:
    """Calls after the sample filter, the site filter and the allele-frequency filter, in this order."""
    return filter_maf(filter_geno(filter_mind(calls, mind), geno), maf)


def judged_sites(calls: DataFrame, geno: float, maf: float) -> DataFrame:
    """site_key, reason (geno or maf; NULL where it stays). A site without a known genotype goes by geno, or by maf where geno lets it pass."""
    missing, af = c.ratio(F.count_if(F.col("dosage").isNull()), F.count(F.lit(1))), c.ratio(F.col("_ac"), 2 * F.col("_n"))
    sites = calls.groupBy("site_key").agg((missing > geno).alias("_gone"), F.sum("dosage").alias("_ac"), F.count("dosage").alias("_n"))
    return sites.select("site_key", F.when(F.col("_gone"), "geno").when(~F.coalesce(F.least(af, 1 - af) >= maf, F.lit(False)), "maf").alias("reason"))


def qc_report(calls: DataFrame, geno: float = 1.0, mind: float = 1.0, maf: float = 0.01, names: DataFrame | None = None, left: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """kind (sample or variant), name, kept, reason (mind, geno or maf; NULL where kept) of sample_variant_qc: samples are judged on all
    sites, variants on the samples that are left. names: as in by_sample. left: the calls of a table of samples, where they can be made."""
    shares = unknown_of_samples(calls, names)
    samples = shares.select(F.lit("sample").alias("kind"), F.col("sample").alias("name"), F.when(F.col("unknown") > mind, "mind").alias("reason"))
    stay = shares.filter(F.col("unknown") <= mind).select("sample")
    sites = judged_sites(calls.join(stay, "sample", "left_semi") if left is None else left(stay), geno, maf)
    sites = sites.select(F.lit("variant").alias("kind"), F.col("site_key").cast("string").alias("name"), "reason")
    return samples.unionByName(sites).select("kind", "name", F.col("reason").isNull().alias("kept"), "reason")


def subset_samples(calls: DataFrame, wanted: DataFrame) -> DataFrame:
    """Calls of the listed samples."""
    return calls.join(wanted.select("sample"), "sample", "left_semi")


def depths_by_sample(calls: DataFrame) -> DataFrame:
    """The known cells of depth_matrix as rows, for calls that carry info_dp: a sample's own depth, without a column for it."""
    return calls.filter(F.col("dp").isNotNull()).select(*SITE, "info_dp", "sample", "dp")


def depth_matrix(variants: DataFrame, calls: DataFrame, samples: list[str]) -> DataFrame:
    """One row a site that has calls: info_dp, the depth that the site's INFO states, and one column a sample, its own depth (of several
    calls of a site the greatest). A few columns are aggregates; else a call goes to its sample's slot in an array of its site, so that a
    column costs one slot."""
    if 0 < len(samples) <= FEW:
        few = calls.groupBy(*SITE).agg(*[F.max(F.when(F.col("sample") == x, F.col("dp"))).cast("bigint").alias(x) for x in samples])
        return variants.select(*SITE, "info_dp").join(few, SITE)
    spark = calls.sparkSession
    slots = spark.createDataFrame([(x, i) for i, x in enumerate(samples)], "sample string, _i int")
    numbered = calls.select(*SITE, "sample", "dp").join(F.broadcast(slots), "sample", "left").select(*SITE, "_i", F.col("dp").cast("bigint").alias("dp"))
    size = len(samples)
    kinds = {x: calls.schema[x].dataType.simpleString() for x in SITE}

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of calls of one site as one row each: the slots and depths that are known."""
        for batch in batches:
            chrom, pos = batch.column(0), batch.column(1)
            if not batch.num_rows:
                continue
            codes, at = chrom.dictionary_encode().indices.fill_null(-1).to_numpy(), pos.fill_null(-1).to_numpy()
            first = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (at[1:] != at[:-1])])
            known = batch.column(2).is_valid().to_numpy(zero_copy_only=False) & batch.column(3).is_valid().to_numpy(zero_copy_only=False)
            ends = np.r_[0, np.cumsum(known)][np.r_[first, batch.num_rows]].astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), batch.column(i).filter(pa.array(known))) for i in (2, 3)]
            rows = pa.array(first)
            yield pa.RecordBatch.from_arrays([chrom.take(rows), pos.take(rows), *lists], [*SITE, "i", "d"])

    some = numbered.mapInArrow(packed, ", ".join(f"{x} {t}" for x, t in kinds.items()) + ", i array<int>, d array<bigint>")
    site = some.groupBy(*SITE).agg(F.flatten(F.collect_list("i")).alias("i"), F.flatten(F.collect_list("d")).alias("d"))
    joined = variants.select(*SITE, "info_dp").join(site, SITE)
    head = [f for f in joined.schema.fields if f.name not in ("i", "d")]
    names = [f.name for f in head]
    taken = set(names)
    if clash := [x for x in samples if x in taken]:
        raise ValueError(f"samples named like columns: {clash[:5]}")

    def wide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = dict(zip(batch.schema.names, batch.columns, strict=True))
            grid = np.full((size, batch.num_rows), NO_DEPTH)
            row = np.repeat(np.arange(batch.num_rows), of["i"].value_lengths().to_numpy(zero_copy_only=False))
            np.maximum.at(grid, (of["i"].flatten().to_numpy(), row), of["d"].flatten().to_numpy())
            cells = [pa.array(x, mask=x == NO_DEPTH) for x in grid]
            yield pa.RecordBatch.from_arrays([*(of[x] for x in names), *cells], [*names, *samples])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in head] + [f"`{x}` bigint" for x in samples])
    return joined.mapInArrow(wide, schema)


def check_sample_lists(by_file: DataFrame) -> DataFrame:
    """file, same: whether the file's samples, in order, are those of the first file. by_file: file, ord, sample."""
    lists = by_file.groupBy("file").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "sample"))), lambda x: x.sample).alias("samples"))
    first = lists.agg(F.min(F.struct("file", "samples")).alias("_f")).select(F.col("_f.samples").alias("_first"))
    return lists.join(F.broadcast(first), how="cross").select("file", F.size("samples").cast("bigint").alias("n_samples"), (F.col("samples") == F.col("_first")).alias("same"))
