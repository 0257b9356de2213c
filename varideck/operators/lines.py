"""Quality checks on raw variant lines (line_no, line)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FIXED = 9


def fields() -> F.Column:
    return F.split("line", "\t")


def check_header(lines: DataFrame) -> DataFrame:
    """One row: whether there is a #CHROM line, its columns, the tabs that rows should have, and whether it has 9 columns at least."""
    head = lines.filter(F.col("line").startswith("#CHROM"))
    out = head.agg(F.count(F.lit(1)).alias("n_headers"), F.min(F.size(fields())).cast("bigint").alias("n_columns"))
    return out.select("n_headers", "n_columns", (F.col("n_columns") - 1).alias("expected_tabs"), F.coalesce(F.col("n_columns") >= FIXED, F.lit(False)).alias("ok"))


def data_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(~F.col("line").startswith("#"))


def validate_lines(lines: DataFrame, columns: int) -> DataFrame:
    """line_no, severity, code for each fault of each data line that should have so many columns."""
    f = fields()
    at = lambda i: F.get(f, F.lit(i))
    blank = lambda x: F.coalesce(F.trim(x) == "", F.lit(True))
    samples = F.slice(f, FIXED + 1, F.greatest(F.size(f) - FIXED, F.lit(0)))
    rules = [
        ("error", "column_count", F.size(f) != columns),
        *[("error", f"empty_{name}", (F.size(f) > i) & blank(at(i))) for i, name in ((0, "chrom"), (1, "pos"), (3, "ref"), (4, "alt"))],
        ("error", "empty_format", (F.size(f) >= FIXED) & blank(at(8))),
        ("error", "bad_format", (F.size(f) >= FIXED) & ~blank(at(8)) & ~at(8).rlike("^[A-Za-z_][0-9A-Za-z_.]*(:[A-Za-z_][0-9A-Za-z_.]*)*$")),
        ("error", "empty_sample", F.exists(samples, lambda x: F.trim(x) == "")),
        ("warning", "carriage_return", F.col("line").contains("\r")),
        ("warning", "mixed_delimiter", F.col("line").contains(" ")),
        ("warning", "odd_genotype", F.exists(samples, lambda x: (F.trim(x) != "") & ~F.regexp_extract(x, "^([^:]*)", 1).rlike(r"^(\.|[0-9]+)([/|](\.|[0-9]+))?$"))),
    ]
    found = F.array_compact(F.array(*[F.when(hit, F.struct(F.lit(s).alias("severity"), F.lit(code).alias("code"))) for s, code, hit in rules]))
    return data_lines(lines).select("line_no", F.explode(found).alias("x")).select("line_no", "x.severity", "x.code")


def first_errors(found: DataFrame, n: int = 20) -> DataFrame:
    """The first n faults by line and code."""
    return found.filter("severity = 'error'").orderBy("line_no", "code").limit(n)


def validate_head(lines: DataFrame, columns: int, n: int = 100) -> DataFrame:
    """line_no, tabs, has_ninth_tab and exact of the first n data lines."""
    tabs = F.size(fields()) - 1
    return data_lines(lines).orderBy("line_no").limit(n).select("line_no", tabs.cast("bigint").alias("tabs"), (tabs >= FIXED).alias("has_ninth_tab"), (tabs == columns - 1).alias("exact"))


def repair_lines(lines: DataFrame, columns: int) -> DataFrame:
    """line_no, line, patched: other white space becomes tabs, an empty format GT, and missing or empty genotypes ./. ; lines without
    the fixed columns stay."""
    f = F.split(F.regexp_replace(F.regexp_replace("line", "\r", ""), " +", "\t"), "\t")
    fixed = F.transform(F.slice(f, 1, FIXED), lambda x, i: F.when((i == 8) & (F.trim(x) == ""), "GT").otherwise(x))
    samples = F.transform(F.slice(f, FIXED + 1, F.greatest(F.size(f) - FIXED, F.lit(0))), lambda x: F.when(F.trim(x) == "", "./.").otherwise(x))
    pad = F.array_repeat(F.lit("./."), F.greatest(F.lit(columns) - F.greatest(F.size(f), F.lit(FIXED)), F.lit(0)))
    whole = F.array_join(F.concat(fixed, samples, pad), "\t")
    new = F.when(F.size(f) >= FIXED, whole).otherwise(F.array_join(f, "\t"))
    return data_lines(lines).select("line_no", new.alias("line"), (new != F.col("line")).alias("patched"))


def repair_gate(repaired: DataFrame, most_percent: float = 5.0) -> DataFrame:
    """Lines, patched ones, their share in percent, and whether it is within the limit."""
    out = repaired.agg(F.count(F.lit(1)).alias("n_lines"), F.count_if("patched").alias("n_patched"))
    share = F.round(F.try_divide((F.col("n_patched") * 100).cast("double"), F.col("n_lines").cast("double")), 6)
    return out.withColumn("percent", share).withColumn("ok", F.coalesce(F.col("percent") <= most_percent, F.lit(True)))


def drop_short(lines: DataFrame, columns: int) -> tuple[DataFrame, DataFrame]:
    """Data lines with all columns, and the others."""
    whole = F.size(fields()) >= columns
    return data_lines(lines).filter(whole), data_lines(lines).filter(~whole)


def sample_names(lines: DataFrame) -> DataFrame:
    """file, ord, sample from the #CHROM lines of (file, line)."""
    head = lines.filter(F.col("line").startswith("#CHROM"))
    return head.select("file", F.posexplode(F.slice(fields(), FIXED + 1, F.greatest(F.size(fields()) - FIXED, F.lit(0)))).alias("ord", "sample")).filter("sample <> ''")


def first_rows(lines: DataFrame, n: int, by: str = "file") -> DataFrame:
    """The first n lines of each file."""
    return lines.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy("line_no"))).filter(F.col("_n") <= n).drop("_n")
