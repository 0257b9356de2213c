"""The file inventory: which inputs there are, what is complete, what is next.

files: dataset, path, suffix ... ; artifacts: sample, suffix, has_index, mtime.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as c

#: The stages of a sample, by the suffix of what they leave.
STAGES = ["_1.fastq.gz", "_2.fastq.gz", "_recal.bam", "_raw.g.vcf.gz", "_genotyped.vcf.gz"]
FINAL = "_genotyped.vcf.gz"
#: What the stages 1 to 7 leave: quality reports before and after trimming, sorted, marked and recalibrated reads, calls.
COMPLETED = ["_pre_fastqc.html", "_post_fastqc.html", "_sorted.bam", "_dedup.bam", "_recal.bam", "_raw.g.vcf.gz", "_genotyped.vcf.gz"]


def vcf_files(files: DataFrame) -> DataFrame:
    return files.filter(F.col("path").rlike(r"\.vcf(\.gz)?$")).withColumn("name", c.base_name(F.col("path")))


def select_vcfs(files: DataFrame, include: list[str] | None = None, pattern: str = r"^.*Chr[0-9]{2}.*$") -> DataFrame:
    """The named files; else those whose names match; else all: the first of these that finds any."""
    v = vcf_files(files)
    tier = F.when(F.col("name").isin(*(include or [""])), 0).when(F.col("name").rlike(pattern), 1).otherwise(2)
    ranked = v.withColumn("_t", tier)
    best = ranked.agg(F.min("_t").alias("_t"))
    return ranked.join(F.broadcast(best), "_t", "left_semi").drop("_t")


def resolve_requested(files: DataFrame, names: DataFrame) -> DataFrame:
    """name, path (NULL: not there), whatever the case; repeated names count once."""
    asked = names.select(F.lower("name").alias("_n"), "name").groupBy("_n").agg(F.min("name").alias("name"))
    have = vcf_files(files).groupBy(F.lower("name").alias("_n")).agg(F.min("path").alias("path"))
    return asked.join(have, "_n", "left").select("name", "path")


def one_per_chromosome(files: DataFrame, first: int = 1, last: int = 17) -> DataFrame:
    """chrom_num, n_files, path, status (ok, missing or several) of each chromosome; range-named merges are left out."""
    v = vcf_files(files).filter(~F.col("name").rlike("(?i)chr[0-9]+[-_](chr)?[0-9]+"))
    v = v.withColumn("chrom_num", F.regexp_extract("name", "(?i)chr0*([0-9]+)", 1).try_cast("int"))
    wanted = files.sparkSession.range(first, last + 1).select(F.col("id").cast("int").alias("chrom_num"))
    got = v.groupBy("chrom_num").agg(F.count(F.lit(1)).alias("n_files"), F.min("path").alias("path"))
    out = wanted.join(got, "chrom_num", "left").withColumn("n_files", F.coalesce("n_files", F.lit(0)))
    return out.withColumn("status", F.when(F.col("n_files") == 1, "ok").when(F.col("n_files") == 0, "missing").otherwise("several"))


def vcf_manifest(files: DataFrame) -> DataFrame:
    """Files of Chr01 to Chr17 in order."""
    n = F.regexp_extract("name", "Chr([0-9]{2})", 1).try_cast("int")
    return vcf_files(files).withColumn("chrom_num", n).filter(F.col("chrom_num").between(1, 17)).orderBy("chrom_num", "path")


def pick_merged_or_list(files: DataFrame, force_concat: bool = False) -> DataFrame:
    """path, merged: the first merged file (no chr in its name) in byte order; without one, or when forced, the chromosome files but Chr00."""
    v = vcf_files(files)
    by_chrom = F.col("name").rlike("(?i)chr")
    merged = v.filter(~by_chrom).agg(F.min("path").alias("path")).filter("path is not null").select("path", F.lit(True).alias("merged"))
    listed = v.filter(by_chrom & ~F.col("name").rlike("(?i)chr0*0([^0-9]|$)")).select("path", F.lit(False).alias("merged"))
    return listed if force_concat else merged.union(listed.join(F.broadcast(merged.select(F.lit(1).alias("_"))), how="left_anti", on=F.lit(True)))


def infer_pattern(files: DataFrame) -> DataFrame:
    """One row: the names' common pattern with %02d for the chromosome, NULL if they disagree."""
    p = F.regexp_replace("name", "(?i)(chr)[0-9]{2}", "$1%02d")
    out = vcf_files(files).filter(F.col("name").rlike("(?i)chr[0-9]{2}")).agg(F.min(p).alias("lo"), F.max(p).alias("hi"))
    return out.select(F.when(F.col("lo") == F.col("hi"), F.col("lo")).alias("pattern"))


def sample_map(files: DataFrame, suffix: str = "_raw.g.vcf.gz") -> DataFrame:
    """sample, path of the gVCFs; ValueError without any."""
    out = files.filter(F.col("path").endswith(suffix)).select(F.expr(f"regexp_replace(element_at(split(path, '/'), -1), '{suffix.replace('.', '[.]')}$', '')").alias("sample"), "path")
    if out.isEmpty():
        raise ValueError(f"no file ends in {suffix}")
    return out


def incomplete_samples(artifacts: DataFrame) -> DataFrame:
    """Samples without a genotyped file with its index, of those that have reads; where no sample has any, of those with a VCF."""
    done = artifacts.filter((F.col("suffix") == FINAL) & (F.col("has_index") == 1)).select("sample")
    tier = F.when(F.col("suffix").endswith(".fastq.gz"), 0).when(F.col("suffix").endswith(".vcf.gz"), 1)
    ranked = artifacts.select("sample", tier.alias("_t")).filter("_t is not null").distinct()
    best = ranked.agg(F.min("_t").alias("_t"))  # one row
    return ranked.join(F.broadcast(best), "_t", "left_semi").select("sample").join(done, "sample", "left_anti")


def paired_samples(artifacts: DataFrame) -> DataFrame:
    """Samples with both mates."""
    mates = artifacts.filter(F.col("suffix").isin(*STAGES[:2])).groupBy("sample").agg(F.count_distinct("suffix").alias("n"))
    return mates.filter("n = 2").select("sample")


def resolve_unique(artifacts: DataFrame, suffix: str) -> DataFrame:
    """sample, n_files, status: ok, missing or several."""
    n = F.count_if(F.col("suffix") == suffix)
    out = artifacts.groupBy("sample").agg(n.alias("n_files"))
    return out.withColumn("status", F.when(F.col("n_files") == 1, "ok").when(F.col("n_files") == 0, "missing").otherwise("several"))


def _sample_state(artifacts: DataFrame) -> DataFrame:
    return artifacts.groupBy("sample").agg(F.max(F.when((F.col("suffix") == FINAL) & (F.col("has_index") == 1), 1).otherwise(0)).alias("done"), F.max(F.when(F.col("suffix").isin(*STAGES[2:]), 1).otherwise(0)).alias("begun"))


def cohort_status(artifacts: DataFrame) -> DataFrame:
    """Samples, completed and begun ones, and all_complete, partial or none_complete."""
    out = _sample_state(artifacts).agg(F.count(F.lit(1)).alias("n_samples"), F.count_if(F.expr("done = 1")).alias("n_complete"), F.count_if(F.expr("done = 0 and begun = 1")).alias("n_partial"))
    return out.withColumn("status", F.when(F.col("n_complete") == F.col("n_samples"), "all_complete").when(F.col("n_complete") > 0, "partial").otherwise("none_complete"))


def step_status(artifacts: DataFrame) -> DataFrame:
    """Each step's files and indexes, and Complete, Partial, Incomplete or Not Started."""
    total = artifacts.agg(F.count_distinct("sample").alias("n_samples"))
    by = artifacts.groupBy("suffix").agg(F.count(F.lit(1)).alias("n_files"), F.sum("has_index").cast("bigint").alias("n_indexes"))
    out = by.join(F.broadcast(total), how="cross")  # total: one row
    status = F.when(F.col("n_files") == 0, "Not Started").when((F.col("n_files") >= F.col("n_samples")) & (F.col("n_indexes") >= F.col("n_files")), "Complete").when(F.col("n_indexes") > 0, "Partial").otherwise("Incomplete")
    return out.withColumn("status", status)


def completed_stage(artifacts: DataFrame) -> DataFrame:
    """The highest stage, 1 to 7, that left a file, for each sample; 0 where none did."""
    rank = F.coalesce(*[F.when(F.col("suffix").endswith(s), i + 1) for i, s in enumerate(COMPLETED)], F.lit(0))
    return artifacts.groupBy("sample").agg(F.max(rank).cast("bigint").alias("stage"))


#: The steps in their order.
STEPS = {"1a": "_genotyped.vcf.gz", "1b": "_consolidated.vcf.gz", "1c": "_phased.vcf.gz", "1d": "_site_metrics.tsv"}


def next_step(status: DataFrame) -> DataFrame:
    """dataset, next_step of (dataset, step, complete): the first step that isn't complete, NULL when all are."""
    of = lambda s: F.coalesce(F.max(F.when(F.col("step") == s, F.col("complete").cast("int"))), F.lit(0))
    ladder = None
    for s in STEPS:
        ladder = F.when(of(s) == 0, s) if ladder is None else ladder.when(of(s) == 0, s)
    return status.groupBy("dataset").agg(ladder.alias("next_step"))


def missing_stages(artifacts: DataFrame, required: list[str] | None = None) -> DataFrame:
    """sample, suffix of required stages that a sample lacks."""
    wanted = artifacts.select("sample").distinct().select("sample", F.explode(F.array(*map(F.lit, required or STAGES))).alias("suffix"))
    return wanted.join(artifacts.select("sample", "suffix"), ["sample", "suffix"], "left_anti")


#: The columns that a metrics table of each mode has, and those that only the other one has.
MODE_MARKS = {"standard": ({"mean_depth", "qd", "mq"}, {"dr2"}), "imputed": ({"af", "dr2", "imp"}, {"mean_depth"})}


def fits_mode(columns: Column, mode: str) -> Column:
    """Whether a partition's columns (array<string>, in any case) are those of a metrics table of this mode."""
    has, lacks = ([F.lit(x) for x in sorted(marks)] for marks in MODE_MARKS[mode])
    low = F.transform(columns, F.lower)
    return (F.size(F.array_except(F.array(*has), low)) == 0) & ~F.arrays_overlap(low, F.array(*lacks))


def partition_schemas(spark: SparkSession, path: str, key: str = "chrom") -> DataFrame:
    """partition, columns of a Parquet table that is partitioned by key, from the footers: one look a partition (a chromosome), so on the
    driver. No rows where there is no table."""
    sc = spark.sparkContext
    root = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
    found = [x.getPath() for x in fs.listStatus(root)] if fs.exists(root) else []
    rows = [(x.getName().split("=", 1)[1], spark.read.parquet(x.toString()).columns) for x in found if x.getName().startswith(f"{key}=")]
    return spark.createDataFrame(rows, "partition string, columns array<string>")


def stale_partitions(sources: DataFrame, ledger: DataFrame, params: str, schemas: DataFrame | None = None, mode: str = "standard") -> DataFrame:
    """partition, reason of what has to be made again: missing, newer source, other parameters, or other schema. sources: partition, mtime;
    ledger: partition, made_at, params; schemas: partition, columns of what there is, which have to fit the mode."""
    joined = sources.join(ledger, "partition", "left")
    reason = F.when(F.col("made_at").isNull(), "missing").when(F.col("mtime") > F.col("made_at"), "newer source").when(F.col("params") != params, "other parameters")
    if schemas is not None:
        joined = joined.join(schemas, "partition", "left")
        reason = reason.when(F.col("columns").isNull(), "missing").when(~fits_mode(F.col("columns"), mode), "other schema")
    return joined.select("partition", reason.alias("reason")).filter("reason is not null")
