"""Column functions: null tokens, genotypes, contig names, file names, ranges, flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spellings of a missing value and of a missing genotype.
NULL_TOKENS = ("", ".", "NA", "NaN")
MISSING_GENOTYPES = ("", ".", "./.", ".|.")


def nullify(c: Column) -> Column:
    """NULL for the spellings of a missing value."""
    return F.when(~c.isin(*NULL_TOKENS), c)


def number(c: Column) -> Column:
    """The number a text holds; NULL for null tokens and what isn't a number."""
    return nullify(c).try_cast("double")


def gt_missing(gt: Column) -> Column:
    """Whether a genotype is wholly missing."""
    return F.coalesce(gt.isin(*MISSING_GENOTYPES), F.lit(True))


def alleles(gt: Column) -> Column:
    return F.split(gt, r"[/|]")


def gt_called(gt: Column) -> Column:
    """Whether a genotype has two alleles and both are known."""
    a = alleles(gt)
    return F.coalesce((F.size(a) == 2) & (F.get(a, F.lit(0)) != ".") & (F.get(a, F.lit(1)) != "."), F.lit(False))


def gt_het(gt: Column) -> Column:
    a = alleles(gt)
    return gt_called(gt) & (F.get(a, F.lit(0)) != F.get(a, F.lit(1)))


def gt_class(gt: Column) -> Column:
    """What a genotype is, in plain text operations that cost little: 0 missing, 1 both alleles known and none alternative, 2 known and
    different, 3 known, equal and alternative, 4 two different alleles one of which is unknown, 5 anything else."""
    t = F.translate(gt, "|", "/")
    one, two = F.substring_index(t, "/", 1), F.substring_index(t, "/", -1)
    pair = F.length(t) - F.length(F.replace(t, F.lit("/"), F.lit(""))) == 1
    known = pair & (one != ".") & (two != ".")
    kind = F.when(gt_missing(gt), 0).when(known & (one != two), 2).when(known & (one == "0"), 1).when(known, 3).when(pair & (one != two), 4)
    # The genotypes that nearly all calls have are told by their text alone.
    return F.when(gt.isin("0/0", "0|0"), 1).when(gt.isin("0/1", "0|1", "1|0", "1/0"), 2).when(gt.isin("1/1", "1|1"), 3).otherwise(kind.otherwise(5))


def gt_phased(gt: Column) -> Column:
    return F.coalesce(gt.contains("|"), F.lit(False))


def gt_dosage(gt: Column) -> Column:
    """The number of alternative alleles; NULL unless both alleles are known."""
    return F.when(gt_called(gt), F.size(F.filter(alleles(gt), lambda x: x != "0")))


def ratio(a: Column, b: Column) -> Column:
    """a / b in doubles, NULL where b is 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def contig_number(c: Column) -> Column:
    """1 for 1, chr1, Chr01 and CHR1; NULL for other names."""
    return F.regexp_extract(c, "^(?i:chr)?0*([0-9]+)$", 1).try_cast("int")


def standard_contig(c: Column) -> Column:
    """Chr01 for 1, chr1, Chr1 and CHR1; other names stay."""
    n = contig_number(c)
    return F.when(n.isNull(), c).otherwise(F.concat(F.lit("Chr"), F.lpad(n.cast("string"), 2, "0")))


def numeric_contig(c: Column) -> Column:
    """1 for Chr01; other names stay."""
    return F.coalesce(contig_number(c).cast("string"), c)


def contig_of_name(c: Column) -> Column:
    """ChrNN from the first chr and digits of a file name, else ChrNA."""
    digits = F.regexp_extract(c, "(?i)chr0*([0-9]+)", 1)
    return F.when(digits == "", "ChrNA").otherwise(F.concat(F.lit("Chr"), F.lpad(digits, 2, "0")))


def base_name(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def glob_match(c: Column, pattern: str) -> Column:
    """Case-insensitive file-name pattern; one without wildcards may stand anywhere in the name."""
    import re

    if not any(x in pattern for x in "*?["):
        pattern = f"*{pattern}*"
    rule = "".join(".*" if x == "*" else "." if x == "?" else x if x in "[]" else re.escape(x) for x in pattern)
    return c.rlike(f"(?is)^{rule}$")


def truthy(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c)).isin("true", "1", "yes", "y"), F.lit(False))


def variant_id(chrom: Column, pos: Column, ref: Column, alt: Column) -> Column:
    return F.concat_ws(":", chrom, pos.cast("string"), ref, F.concat_ws(",", alt))


def pos_mbp(pos: Column) -> Column:
    return pos.cast("double") / F.lit(1e6)


def imputed_flag(info: Column) -> Column:
    """1 if an INFO map has the key IMP, else 0."""
    return F.coalesce(F.map_contains_key(info, "IMP"), F.lit(False)).cast("int")


def hash_share(c: Column, fraction: float) -> Column:
    """Whether the first 28 bits of the MD5 fall in the share: the same rows on every run and engine."""
    return F.conv(F.substring(F.md5(c), 1, 7), 16, 10).cast("bigint") < F.lit(int(fraction * (1 << 28)))


def valid_af(c: Column) -> Column:
    return c.between(0.0, 1.0)


def valid_qual(c: Column) -> Column:
    return ~F.isnan(c) & c.between(0.0, 100.0)


def valid_qd(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
