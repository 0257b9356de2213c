"""Operators over variants (chrom, pos, ref, alt array, filter, annotations). Missing annotations are NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as c
from ..functions.numbering import with_number_in

#: The hard-filter thresholds (name of the tag, condition that passes).
HARD_RULES = {
    "QD2": "qd >= 2.0D",
    "QUAL30": "qual >= 30.0D",
    "SOR3": "sor <= 3.0D",
    "FS60": "fs <= 60.0D",
    "MQ40": "mq >= 40.0D",
    "MQRankSum-12.5": "mq_rank_sum >= -12.5D",
    "ReadPosRankSum-8": "read_pos_rank_sum >= -8.0D",
}
KNOWN_CONTIGS = [f"Chr{i:02d}" for i in range(18)]


def is_biallelic_snp() -> Column:
    return (F.size("alt") == 1) & (F.length("ref") == 1) & (F.length(F.get("alt", F.lit(0))) == 1)


def biallelic_snps(v: DataFrame) -> DataFrame:
    """Sites with one alternative, both alleles one base."""
    return v.filter(is_biallelic_snp())


def just_acgt(v: DataFrame) -> DataFrame:
    """At most two alleles, each one of A, C, G, T."""
    return v.filter((F.size("alt") <= 1) & F.col("ref").rlike("^[ACGT]$") & F.forall("alt", lambda a: a.rlike("^[ACGT]$")))


def snps(v: DataFrame) -> DataFrame:
    """SNP sites, several alternatives allowed."""
    return v.filter((F.length("ref") == 1) & F.forall("alt", lambda a: F.length(a) == 1))


def filter_status(v: DataFrame, allowed: tuple[str, ...] = ("PASS", ".")) -> DataFrame:
    return v.filter(F.col("filter").isin(*allowed))


def passes_hard(rules: dict[str, str] | None = None) -> Column:
    """True only if every annotation is there and passes."""
    out = F.lit(True)
    for rule in (rules or HARD_RULES).values():
        out = out & F.expr(rule)
    return F.coalesce(out, F.lit(False))


def hard_filter(v: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """Records that pass every rule; a missing annotation drops the record."""
    return v.filter(passes_hard(rules))


def hard_filter_rejects(v: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """The complement of hard_filter."""
    return v.filter(~passes_hard(rules))


def soft_filter(v: DataFrame, rules: dict[str, str] | None = None) -> DataFrame:
    """v with soft_filter: the failed tags joined by ';', or PASS; a missing annotation doesn't fail."""
    tags = [F.when(~F.expr(rule), F.lit(tag)) for tag, rule in (rules or HARD_RULES).items()]
    joined = F.concat_ws(";", *tags)
    return v.withColumn("soft_filter", F.when(joined == "", "PASS").otherwise(joined))


def exclude_contigs(v: DataFrame, names: tuple[str, ...] = ("Chr00",)) -> DataFrame:
    return v.filter(~F.col("chrom").isin(*names))


def chrom_range(v: DataFrame, first: int = 1, last: int = 17) -> DataFrame:
    return v.filter(c.contig_number(F.col("chrom")).between(first, last))


def known_contigs(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    return df.filter(F.col("chrom").isin(*(names or KNOWN_CONTIGS)))


def target_chroms(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """The named chromosomes (all if none are named); ValueError if none of the names is there."""
    if not names:
        return df
    out = df.filter(F.col("chrom").isin(*names))
    if out.isEmpty():
        raise ValueError(f"no rows on {', '.join(names)}")
    return out


def standardise_contigs(df: DataFrame) -> DataFrame:
    return df.withColumn("chrom", c.standard_contig(F.col("chrom")))


def numeric_contigs(df: DataFrame) -> DataFrame:
    return df.withColumn("chrom", c.numeric_contig(F.col("chrom")))


def with_variant_id(v: DataFrame) -> DataFrame:
    return v.withColumn("variant_id", c.variant_id(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt")))


def with_variant_index(v: DataFrame) -> DataFrame:
    """v with variant_index: the place on the chromosome, from 1, counted over ranges of it."""
    return with_number_in(v, "chrom", [F.col("pos"), F.col("site_key")], "variant_index")


def dedup_sites(m: DataFrame) -> DataFrame:
    """One row for each chrom and pos: the first in the order of all columns."""
    order = [x for x in m.columns if x not in ("chrom", "pos")]
    return m.withColumn("_n", F.row_number().over(Window.partitionBy("chrom", "pos").orderBy(*order))).filter("_n = 1").drop("_n")


def split_multiallelics(v: DataFrame) -> DataFrame:
    """A row for each alternative, with allele_index from 1."""
    return v.select(*[x for x in v.columns if x != "alt"], F.posexplode("alt").alias("_i", "_a")).withColumns({"alt": F.array("_a"), "allele_index": (F.col("_i") + 1).cast("bigint")}).drop("_i", "_a")


def recode_split(calls: DataFrame) -> DataFrame:
    """calls (gt, allele_index) after a split: the row's own alternative becomes 1, other alternatives 0, '.' stays."""
    one = F.transform(c.alleles(F.col("gt")), lambda a: F.when(a == ".", a).otherwise((a == F.col("allele_index").cast("string")).cast("int").cast("string")))
    return calls.withColumn("gt", F.when(F.col("gt").contains("|"), F.array_join(one, "|")).otherwise(F.array_join(one, "/")))


def thin(v: DataFrame, fraction: float = 0.2, key: str = "variant_id") -> DataFrame:
    """A share of the variants, by the hash of their id; every chosen row is chosen on every run."""
    return v.filter(c.hash_share(F.col(key), fraction))


def looks_biallelic(v: DataFrame, n: int = 1000) -> DataFrame:
    """checked, biallelic and whether all are, over the first n rows by chrom and pos."""
    some = v.orderBy("chrom", "pos", "ref").limit(n)
    return some.agg(F.count(F.lit(1)).alias("checked"), F.count_if(is_biallelic_snp()).alias("biallelic")).withColumn("all_biallelic", F.col("checked") == F.col("biallelic"))


def concatenate(parts: list[DataFrame]) -> DataFrame:
    """Tables one after the other; columns that one lacks are NULL there."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def unify_site_metrics(m: DataFrame, columns: list[str]) -> DataFrame:
    """Lower-case names and all the asked columns, NULL where m lacks one."""
    low = m.toDF(*[x.lower() for x in m.columns])
    return low.select(*[F.col(x) if x in low.columns else F.lit(None).cast("double").alias(x) for x in columns])


def callset_order(df: DataFrame) -> DataFrame:
    """Coordinate order: chromosome number, position."""
    return df.orderBy(c.contig_number(F.col("chrom")).asc_nulls_last(), "chrom", "pos")


def contig_lengths(names: DataFrame, fai: DataFrame) -> DataFrame:
    """names (chrom) with length and ord from fai (contig, length, ord); the contig table is one row a contig."""
    return names.join(F.broadcast(fai), names.chrom == fai.contig, "left").drop("contig")
