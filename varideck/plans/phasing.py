"""Preparation of call sets for phasing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import variants as v


def prepare_for_phasing(variants: DataFrame, contigs: DataFrame, mode: str = "phase") -> DataFrame:
    """Split, biallelic SNPs, hard-filtered when phasing only (not when imputing), numeric contigs with their lengths, in order."""
    if mode not in ("phase", "impute"):
        raise ValueError(f"unknown mode {mode}")
    out = v.biallelic_snps(v.split_multiallelics(variants))
    if mode == "phase":
        out = v.hard_filter(out)
    out = v.contig_lengths(v.numeric_contigs(out), contigs)
    return out.orderBy(F.col("chrom").try_cast("int").asc_nulls_last(), "chrom", "pos")
