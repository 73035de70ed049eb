"""Counters of a run, taken while its rows are written: no pass over the data of their own."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from vacantia import schemas
from vacantia.operators import clean as cl
from vacantia.operators import normalize as nz


def _counted(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, *[c.alias(name) for name, c in counts.items()]), seen


def write_clean_jobs(frames: list[DataFrame], path: str) -> tuple[DataFrame, DataFrame]:
    """:func:`clean.clean_jobs` written to ``path``, and what each step left of the rows."""
    spark = frames[0].sparkSession
    stacked, before = _counted(cl.union_sources([cl.harmonize_columns(f) for f in frames]), n=F.count("*"))
    by_url, between = _counted(stacked.transform(cl.tidy_columns).transform(cl.dedupe_by_url), n=F.count("*"))
    done, after = _counted(by_url.transform(cl.dedupe_by_title_company).select(*schemas.CLEAN_COLUMNS), n=F.count("*"))
    done.write.mode("overwrite").parquet(path)
    n = [o.get["n"] for o in (before, between, after)]
    report = spark.createDataFrame([(n[0], n[1], n[2], n[0] - n[2])], "rows_in long, rows_after_url long, rows_out long, rows_removed long")
    return spark.read.schema(schemas.JOBS_CLEANED).parquet(path), report


def write_normalized(records: DataFrame, order: list[str], path: str) -> tuple[DataFrame, DataFrame]:
    """:func:`normalize.normalize_records` written to ``path``, and the counts of :func:`normalize.normalize_report`."""
    spark = records.sparkSession
    arrived, before = _counted(records, input_rows=F.count("*"))
    unique, first = _counted(nz.dedupe_by_key(arrived, order), unique_rows=F.count("*"))
    normal, second = _counted(unique.transform(nz.drop_failed_rows).transform(nz.normalize_record), cleaned_rows=F.count("*"))
    valid, third = _counted(normal.transform(nz.validate_records), valid_rows=F.count("*"))
    valid.write.mode("overwrite").parquet(path)
    counts = {k: v for o in (before, first, second, third) for k, v in o.get.items()}
    report = spark.createDataFrame([tuple(counts.values())], ", ".join(f"{k} long" for k in counts))
    return spark.read.schema(valid.schema).parquet(path), report


def verdict(jobs: int, errors: int) -> tuple[str, str | None]:
    """Status and message of a source whose rows were read."""
    if not errors:
        return "success", None
    return ("success" if jobs else "error"), f"{errors} of {jobs + errors} rows were rejected"


def ingest(
    spark: SparkSession, sources: dict[str, Callable[[], DataFrame]], valid: Column, path: str,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Write the valid rows of every source to its folder under ``path``; rows per source, and one audit row each.

    A source that cannot be read or written fails alone: it has the status "error", one error and the message,
    and the others go on.  Rows are counted while they are written.
    """
    ok = F.coalesce(valid, F.lit(False))
    written, log = {}, []
    for name, make in sources.items():
        started = datetime.datetime.now(datetime.timezone.utc)
        try:
            rows, seen = _counted(make(), jobs=F.count_if(ok), errors=F.count_if(~ok))
            rows.filter(ok).write.mode("overwrite").parquet(f"{path}/{name}")
            written[name] = spark.read.schema(rows.schema).parquet(f"{path}/{name}")
            jobs, errors = seen.get["jobs"], seen.get["errors"]
            status, message = verdict(jobs, errors)
        except PySparkException as problem:
            status, jobs, errors = "error", 0, 1
            message = problem.getCondition() or str(problem).strip().split("\n")[0]
        log.append((name, status, jobs, errors, started, datetime.datetime.now(datetime.timezone.utc), message))
    return written, spark.createDataFrame(log, schemas.INGESTION_LOG)
