"""Writers, and the report package. Every writer goes through Spark's own commit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.shared import scratch  # noqa: F401  (sinks.scratch)
from ..operators import variants as v


#: Lines of a piece of a named text.
PIECE_LINES = 1 << 18


def write_named_text(df: DataFrame, path: str, name: str = "name", order: str = "ord", line: str = "line", most: int = PIECE_LINES) -> None:
    """A text file for each name, its lines in order, in pieces where it has over about `most` lines, as its order is dealt out evenly between
    its least and its greatest: <name>, or <name>.00000, <name>.00001 and so on. Pieces end between rows, a task writes whole pieces, and
    one after another by name they are the text. order: whole numbers."""
    ends = df.groupBy(F.col(name).alias("_n")).agg(F.min(order).alias("_lo"), F.max(order).alias("_hi"), F.ceil(F.count(F.lit(1)) / most).alias("_k"))  # a row a file
    share = (F.col(order) - F.col("_lo")).cast("double") / (F.col("_hi") - F.col("_lo") + 1)
    piece = F.least(F.floor(share * F.col("_k")), F.col("_k") - 1).cast("int")
    file = F.when(F.col("_k") > 1, F.concat(F.col(name), F.format_string(".%05d", piece))).otherwise(F.col(name))
    cut = df.join(F.broadcast(ends), F.col(name).eqNullSafe(F.col("_n"))).select(file.alias("_file"), F.col(order).alias("_at"), F.col(line).alias("value"))
    cut.repartition("_file").sortWithinPartitions("_file", "_at").select("_file", "value").write.partitionBy("_file").text(f"{path}/_parts")
    sc = df.sparkSession.sparkContext
    root = sc._jvm.org.apache.hadoop.fs.Path(f"{path}/_parts")
    fs = root.getFileSystem(sc._jsc.hadoopConfiguration())
    for folder in fs.listStatus(root):  # a rename a file
        if folder.isDirectory():
            for part in fs.listStatus(folder.getPath()):
                if part.getPath().getName().startswith("part-"):
                    fs.rename(part.getPath(), sc._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder.getPath().getName().split('=', 1)[1]}"))
    fs.delete(root, True)


def write_metrics(m: DataFrame, path: str) -> None:
    """Tab-separated tables with a header, one folder a chromosome; a large chromosome has a file for each 5 Mbp."""
    m.repartition("chrom", F.floor(F.col("pos") / 5_000_000)).write.mode("overwrite").partitionBy("chrom").csv(path, sep="\t", header=True, nullValue="NA")


def write_combined_metrics(m: DataFrame, path: str) -> None:
    """One table of all chromosomes as text in coordinate order, under a single header: its files, one after another by name, are that
    table. Each task writes a range of it; the header is the least row of the order. Rates have six places."""
    from ..functions.columns import contig_number

    def text(name: str):
        kind = m.schema[name].dataType.simpleString()
        return F.coalesce(F.format_string("%.6f", F.col(name)) if name.endswith(("_rate", "mean_depth")) else F.col(name).cast("bigint").cast("string") if kind == "int" else F.col(name).cast("string"), F.lit("NA"))

    rows = m.select(F.lit(1).alias("_part"), contig_number(F.col("chrom")).alias("_n"), F.col("chrom").alias("_c"), F.col("pos").alias("_p"), F.concat_ws("\t", *map(text, m.columns)).alias("value"))
    header = m.sparkSession.createDataFrame([(0, None, None, None, "\t".join(x.upper() for x in m.columns))], rows.schema)
    order = [F.col("_part"), F.col("_n").asc_nulls_last(), F.col("_c"), F.col("_p")]
    parts = int(m.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows.unionByName(header).repartitionByRange(parts, *order).sortWithinPartitions(*order).select("value").write.mode("overwrite").text(path)


def write_site_metrics(m: DataFrame, path: str, codec: str = "snappy") -> None:
    """Parquet partitioned by chromosome; only the chromosomes in m are replaced."""
    m.repartition("chrom", F.floor(F.col("pos") / 5_000_000)).sortWithinPartitions("pos").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", codec).partitionBy("chrom").parquet(path)


def write_parquet(df: DataFrame, path: str, codec: str = "snappy") -> None:
    df.write.mode("overwrite").option("compression", codec).parquet(path)


def write_counts(counts: DataFrame, path: str) -> None:
    """One compressed table in the fixed order: a row a sample and chromosome, so one task is enough."""
    counts.coalesce(1).sortWithinPartitions("scope", "chr_label", "sample").write.mode("overwrite").option("compression", "gzip").csv(path, header=True)


def write_callset(variants: DataFrame, path: str, partitions: int | None = None) -> None:
    """Parquet in coordinate order over all files."""
    from ..functions.columns import contig_number

    n = partitions or int(variants.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [contig_number(F.col("chrom")).asc_nulls_last(), F.col("chrom"), F.col("pos")]
    variants.repartitionByRange(n, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def write_bed(df: DataFrame, path: str) -> None:
    df.orderBy("chrom", "start0").select("chrom", "start0", "end0", "coverage").write.mode("overwrite").option("compression", "gzip").csv(path, sep=" ", header=False)


def write_depth(sites: DataFrame, samples: DataFrame, path: str) -> None:
    sites.orderBy("chrom", "pos").write.mode("overwrite").csv(f"{path}/sites", sep="\t", header=True, nullValue="NA")
    write_parquet(samples, f"{path}/samples")


def package_counts(metrics: DataFrame, samples: DataFrame, passed: DataFrame, pairs: DataFrame | None = None, **more: DataFrame | None) -> DataFrame:
    """One row: sites, chromosomes, samples imported and passed, pairs, and a count n_<name> of each other table that is given, such as
    samples_pca, components, variants_imported, variants_qc and variants_pruned."""
    out = metrics.agg(F.count(F.lit(1)).alias("n_sites"), F.count_distinct("chrom").alias("n_chromosomes"))
    out = out.join(samples.agg(F.count(F.lit(1)).alias("n_samples_imported")), how="cross").join(passed.agg(F.count(F.lit(1)).alias("n_samples_qc")), how="cross")  # one row each
    for name, df in ({"pairs": pairs} | more).items():
        out = out if df is None else out.join(df.agg(F.count(F.lit(1)).alias(f"n_{name}")), how="cross")
    return out


def package_manifest(dataset: str, mode: str, sections: list[str], params: dict[str, float], counts: DataFrame, metrics: DataFrame, version: str = "1") -> DataFrame:
    """One row of JSON: version, dataset, mode, chromosomes, parameters, sections, counts."""
    chroms = metrics.agg(F.array_sort(F.collect_set("chrom")).alias("chromosomes"))
    body = F.struct(
        F.lit(version).alias("version"), F.lit(dataset).alias("dataset"), F.lit(mode).alias("mode"), "chromosomes", F.array(*map(F.lit, sections)).alias("sections"),
        F.struct(*[F.lit(x).alias(k) for k, x in params.items()]).alias("params"), F.struct(*counts.columns).alias("counts"),
    )
    return counts.join(chroms, how="cross").select(F.to_json(body).alias("manifest"))


def annotate_samples(samples: DataFrame, passed: DataFrame, mind_removed: DataFrame, key: str = "sample") -> DataFrame:
    """sample, passed_qc, qc_removal_reason: mind_filter for those the sample filter took, else qc_filter for those that didn't pass.
    key: what tells samples apart, where their names may be the same."""
    ok, mind = (x.select(key, F.lit(True).alias(name)).distinct() for x, name in ((passed, "_ok"), (mind_removed, "_mind")))
    out = samples.select(*dict.fromkeys((key, "sample"))).join(ok, key, "left").join(mind, key, "left")
    reason = F.when(F.col("_mind").isNotNull(), "mind_filter").when(F.col("_ok").isNull(), "qc_filter")
    return out.select("sample", reason.isNull().alias("passed_qc"), reason.alias("qc_removal_reason"))


def export_report_package(path: str, dataset: str, metrics: DataFrame, mode: str = "standard", params: dict[str, float] | None = None, codec: str = "snappy", **sections: DataFrame | None) -> list[str]:
    """Writes site metrics, each other section that is given, and the manifest; returns the names of the sections."""
    write_site_metrics(metrics, f"{path}/site_metrics", codec)
    there = ["site_metrics"]
    for name, df in sections.items():
        if df is not None:
            write_parquet(df, f"{path}/{name}", codec)
            there.append(name)
    samples = sections.get("samples")
    none = metrics.select(F.lit("").alias("sample")).limit(0)
    counts = package_counts(metrics, none if samples is None else samples, none if samples is None else samples.filter("passed_qc"), sections.get("kinship"))
    package_manifest(dataset, mode, there, params or {"geno": 1.0, "mind": 1.0, "maf": 0.01}, counts, metrics).coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return there


def combined_callset(parts: list[DataFrame]) -> DataFrame:
    """Chromosome tables as one call set: standard names, without Chr00, in order."""
    return v.callset_order(v.exclude_contigs(v.standardise_contigs(v.concatenate(parts))))
