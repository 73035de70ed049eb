"""Warehouse tables: creation, append, SQL access, load."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession

from vacantia import schemas
from vacantia.operators.rows import table_counts
from vacantia.sources.mart import Mart, aligned, load_star

COUNTED = ["dim_companies", "dim_locations", "dim_skills", "fact_jobs", "fact_job_skills"]


def create_star_schema(
    spark: SparkSession, database: str, location: str, buckets: int | None = None
) -> list[str]:
    """Create the six tables as Parquet under ``location`` where they do not exist yet.

    With ``buckets`` both facts are bucketed by ``job_id``: the join of jobs and links, on
    which most views rest, and the group-by per job then need no shuffle.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    names = []
    for table, schema in schemas.STAR.items():
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        clustered = (
            f"CLUSTERED BY (job_id) INTO {buckets} BUCKETS" if buckets and table.startswith("fact_") else ""
        )
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} ({columns}) "
            f"USING parquet {clustered} LOCATION '{location}/{table}'"
        )
        names.append(f"{database}.{table}")
    return names


def _bucket_count(spark: SparkSession, table: str) -> int:
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Num Buckets'").collect()
    return int(rows[0]["data_type"]) if rows else 0


def append_table(df: DataFrame, table: str, if_exists: str = "append") -> None:
    """Append by column name; missing columns are null, ``*_at`` columns the load time.

    ``if_exists`` is accepted and has no effect: rows are always appended.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.write.mode("append").saveAsTable(table)
        return

    rows = aligned(df, spark.table(table).schema)
    buckets = _bucket_count(spark, table)
    if buckets:  # one writing task, and so one file, per bucket
        rows = rows.repartition(buckets, "job_id")
    rows.write.mode("append").insertInto(table)


def run_sql(spark: SparkSession, query: str, **params) -> DataFrame | bool:
    """Rows of a query; ``True`` for any other statement."""
    result = spark.sql(query, args=params or None)
    bare = re.sub(r"\A(\s|--[^\n]*(\n|\Z)|/\*.*?\*/|\()*", "", query, flags=re.DOTALL)  # leading comments and brackets
    first = bare.split(None, 1)[0].upper() if bare.strip() else ""
    return result if first in ("SELECT", "WITH", "VALUES", "TABLE", "FROM") else True


def read_row_store(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """Rows of a query run by an outside database."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def verify_row_counts(spark: SparkSession, database: str) -> DataFrame:
    return table_counts({n: spark.table(f"{database}.{n}") for n in COUNTED})


def load_warehouse(
    spark: SparkSession, jobs: DataFrame, job_skills: DataFrame, database: str, location: str,
    as_of: Column, dry_run: bool = False, buckets: int | None = None, batch: str | None = None,
) -> DataFrame | None:
    """Dimensions, then facts, then checks, then one step that makes them visible, then row counts.

    A load that stops leaves the mart as it was (see :mod:`vacantia.sources.mart`); a rerun adds no
    member and no job twice, and a ``batch`` that was published does nothing.  ``dry_run`` only checks the inputs.
    """
    wanted = {"jobs": schemas.CLEAN_COLUMNS, "job_skills": schemas.JOB_SKILLS.fieldNames()}
    for name, df in (("jobs", jobs), ("job_skills", job_skills)):
        missing = set(wanted[name]) - set(df.columns)
        if missing:
            raise ValueError(f"{name} lacks {sorted(missing)}")
    if dry_run:
        return None
    mart = Mart(spark, database, location, buckets=buckets, months={"fact_jobs": "publish_date"})
    load_star(mart, jobs, job_skills, as_of, batch or f"load-{len(mart.history()) + 1}")
    return mart.row_counts(COUNTED)


def load_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each loaded set."""
    return table_counts(tables)
