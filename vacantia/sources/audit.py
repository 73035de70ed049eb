"""One audit row per source of an ingestion run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def ingestion_audit(df: DataFrame, valid: Column, source: str = "source", at: str | None = None) -> DataFrame:
    """Status, valid and rejected rows, first and last time, message per source.

    A source all of whose rows were rejected has the status "error"; the message tells of rejected rows.
    """
    ok = F.coalesce(valid, F.lit(False))
    when = F.col(at) if at else F.lit(None).cast("timestamp")
    return df.groupBy(F.col(source).alias("source_name")).agg(
        F.count_if(ok).alias("jobs_count"), F.count_if(~ok).alias("errors_count"),
        F.min(when).alias("started_at"), F.max(when).alias("ended_at"),
    ).select(
        "source_name", F.when((F.col("jobs_count") == 0) & (F.col("errors_count") > 0), "error").otherwise("success").alias("status"),
        "jobs_count", "errors_count", "started_at", "ended_at",
        F.when(F.col("errors_count") > 0, F.format_string(
            "%d of %d rows were rejected", "errors_count", F.col("jobs_count") + F.col("errors_count"))).alias("error_message"),
    )


def failed_source(df: DataFrame, source_name: str, message: str, at: Column) -> DataFrame:
    """Audit with one more row for a source that could not be read at all."""
    row = df.sparkSession.range(1).select(
        F.lit(source_name).alias("source_name"), F.lit("error").alias("status"),
        F.lit(0).cast("bigint").alias("jobs_count"), F.lit(1).cast("bigint").alias("errors_count"),
        at.alias("started_at"), at.alias("ended_at"), F.lit(message).alias("error_message"),
    )
    return df.unionByName(row)
