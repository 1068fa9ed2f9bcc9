"""Sinks: full refresh, append, replace one day's partition.

Writes are distributed (one file set per task); all-or-nothing publication of a whole
warehouse build is done by writing to a new root (``plans.warehouse.run_pipeline``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def sink_overwrite(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Full refresh of a table (staging TRUNCATE + INSERT, dimension and fact reloads)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


sink_staging_overwrite = sink_overwrite
sink_reload_table = sink_overwrite


def sink_append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Append rows (audit trail, run summaries, job log)."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


sink_append_audit = sink_append


def sink_replace_day(df: DataFrame, path: str, day_col: str = "check_date") -> None:
    """Replace only the partitions (days, or other values of ``day_col``) present in ``df``.

    Other partitions stay untouched: dynamic partition overwrite makes a re-run of the same
    day idempotent.
    """
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(day_col).parquet(path))
