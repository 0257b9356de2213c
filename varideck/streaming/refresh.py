"""Rebuilds the partitions of the site metrics whose sources changed; the others stay as they are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.calls import site_metrics
from ..sources.inventory import partition_schemas, stale_partitions
from ..sources.sinks import write_site_metrics


def refresh_site_metrics(variants: DataFrame, calls: DataFrame, sources: DataFrame, ledger: DataFrame, params: str, path: str) -> DataFrame:
    """Writes the metrics of stale chromosomes over theirs (dynamic partition overwrite) and returns the stale list. A chromosome whose
    table lacks or has other columns than the standard mode asks for is stale, whatever its age."""
    # A row a partition: told once, as the sources' times may move on while the metrics are written.
    stale = stale_partitions(sources, ledger, params, partition_schemas(calls.sparkSession, path)).checkpoint()
    of_stale = lambda df: df.join(F.broadcast(stale.select(F.col("partition").alias("chrom"))), "chrom", "left_semi")
    write_site_metrics(site_metrics(of_stale(variants), of_stale(calls)), path)
    return stale
