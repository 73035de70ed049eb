"""A mart whose loads become visible in one step.

The rows of a load go to partitions of their own (``load=...``) of every table, are checked there together with
what is published, and become visible by one row in the table ``loads``.  A load that stops leaves
partitions that nobody reads; running it again writes new ones.  A batch id that is published already
is not loaded again.  Every table has a view of its published rows under its own name, and :meth:`Mart.read` gives
one state of all tables: the published loads are listed once and become a partition filter.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from vacantia import schemas
from vacantia.operators import versions as vs
from vacantia.operators import warehouse as wh
from vacantia.operators.rows import keep_first, number_rows, table_counts
from vacantia.session import stage

MONTH = "publish_month"


class LoadRejected(ValueError):
    """The rows of a load break declared keys or references; nothing was published."""


def aligned(df: DataFrame, schema: T.StructType, at: Column | None = None) -> DataFrame:
    """The columns of ``schema`` by name: missing ones are null, ``*_at`` columns the load time."""
    def fill(field: T.StructField) -> Column:
        if field.name in df.columns:
            value = F.col(field.name)
        elif field.name in ("created_at", "updated_at"):
            value = F.current_timestamp() if at is None else at
        else:
            value = F.lit(None)
        return value.cast(field.dataType).alias(field.name)

    return df.select(*[fill(f) for f in schema.fields])


def month_of(date: Column) -> Column:
    """The partition of a date; null dates have the partition of nulls."""
    return F.date_format(date, "yyyy-MM")


class Mart:
    """Tables of one database under one location; one load runs at a time.

    ``buckets`` buckets all tables with a ``job_id`` by it, so that joins on it need no shuffle; tables with a date in ``months`` are
    partitioned by its month below the load, and readers get the month as a column to prune by.
    """

    def __init__(
        self, spark: SparkSession, database: str, location: str, tables: dict[str, T.StructType] = schemas.STAR,
        buckets: int | None = None, months: dict[str, str] | None = None,
    ):
        self.spark, self.database, self.location = spark, database, location
        self.tables, self.buckets, self.months = tables, buckets, months or {}
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.loads (batch STRING, load STRING, load_no BIGINT, whole BOOLEAN, "
            f"loaded_at TIMESTAMP) USING parquet LOCATION '{location}/loads'")
        for name, schema in tables.items():
            columns = [f"{f.name} {f.dataType.simpleString()}" for f in schema.fields] + ["load STRING"]
            parts = ["load"] + ([MONTH] if name in self.months else [])
            columns += [f"{MONTH} STRING"] * (name in self.months)
            clustered = f"CLUSTERED BY (job_id) INTO {buckets} BUCKETS" if self._bucketed(name) else ""
            spark.sql(
                f"CREATE TABLE IF NOT EXISTS {database}.rows_{name} ({', '.join(columns)}) USING parquet "
                f"PARTITIONED BY ({', '.join(parts)}) {clustered} LOCATION '{location}/{name}'")
            spark.sql(
                f"CREATE VIEW IF NOT EXISTS {database}.{name} AS SELECT {', '.join([f.name for f in schema.fields] + parts[1:])} "
                f"FROM {database}.rows_{name} WHERE load IN (SELECT l.load FROM {database}.loads l WHERE l.load_no >= "
                f"(SELECT coalesce(max(load_no), 0) FROM {database}.loads WHERE whole))")

    def _bucketed(self, name: str) -> bool:
        return bool(self.buckets) and "job_id" in self.tables[name].fieldNames()

    # --- Published loads

    def history(self) -> list:
        """Published loads in order; of a batch that was published twice only the first counts."""
        self.spark.catalog.refreshTable(f"{self.database}.loads")
        rows = self.spark.table(f"{self.database}.loads").orderBy("load_no", "load").collect()  # one row a load
        first: dict = {}
        for r in rows:
            first.setdefault(r["batch"], r)
        return list(first.values())

    def published(self) -> list[str]:
        """The loads whose rows are visible: the last whole one and those after it."""
        rows = self.history()
        start = max((i for i, r in enumerate(rows) if r["whole"]), default=0)
        return [r["load"] for r in rows[start:]]

    # --- Rows

    def read(self, table: str, *loads: str) -> DataFrame:
        """Rows of ``loads``, or the published ones."""
        self.spark.catalog.refreshTable(f"{self.database}.rows_{table}")
        wanted = loads or self.published()
        rows = self.spark.table(f"{self.database}.rows_{table}")
        return rows.filter(F.col("load").isin(*wanted) if wanted else F.lit(False)).drop("load")

    def tables_at(self, *loads: str) -> dict[str, DataFrame]:
        """All tables at one state."""
        loads = loads or tuple(self.published()) or ("",)
        return {name: self.read(name, *loads) for name in self.tables}

    def write(self, table: str, rows: DataFrame, load: str, at: Column | None = None) -> None:
        """Add rows to the partition of an unpublished load."""
        out = aligned(rows, self.tables[table], at).withColumn("load", F.lit(load))
        if table in self.months:
            out = out.withColumn(MONTH, month_of(F.col(self.months[table])))
        if self._bucketed(table):  # one writing task, and so one file a month, per bucket
            out = out.repartition(self.buckets, "job_id")
        out.write.mode("append").insertInto(f"{self.database}.rows_{table}")

    # --- Loads

    def begin(self, batch: str) -> str | None:
        """A fresh load for ``batch``, or None if it is published already."""
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"a batch id holds letters, digits, '_', '.' and '-' only, not {batch!r}")
        if any(r["batch"] == batch for r in self.history()):
            return None
        return f"{batch}.{uuid.uuid4().hex[:12]}"

    def check(self, load: str) -> None:
        """Declared keys and references of what is published with the rows of ``load``."""
        known = {n: df for n, df in self.tables_at(*self.published(), load).items() if n in schemas.PRIMARY_KEYS}
        if known:
            bad = wh.check_constraints(known).filter("violations > 0").collect()
            if bad:
                raise LoadRejected("; ".join(f"{r['violations']} x {r['check_name']} {r['table_name']}({r['columns']})" for r in bad))

    def publish(self, batch: str, load: str, whole: bool = False) -> None:
        """The one step that makes a load visible: a file with one row."""
        number = max((r["load_no"] for r in self.history()), default=0) + 1
        row = self.spark.range(1).select(
            F.lit(batch).alias("batch"), F.lit(load).alias("load"), F.lit(number).cast("long").alias("load_no"),
            F.lit(whole).alias("whole"), F.current_timestamp().alias("loaded_at"))
        row.coalesce(1).write.mode("append").insertInto(f"{self.database}.loads")

    def append(self, table: str, rows: DataFrame, batch: str) -> bool:
        """Rows of one table as a batch: all or nothing, and once however often it is called."""
        load = self.begin(batch)
        if load is None:
            return False
        self.write(table, rows, load)
        self.check(load)
        self.publish(batch, load)
        return True

    def compact(self, batch: str) -> None:
        """Rewrite all published rows as one load; those before it are no longer read."""
        load = self.begin(batch)
        if load is not None:
            for name, rows in self.tables_at().items():
                self.write(name, rows, load)
            self.publish(batch, load, whole=True)

    def vacuum(self) -> list[str]:
        """Remove the partitions of loads that are not visible; not while a load or an old reader runs."""
        keep, gone = set(self.published()), []
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in self.tables:
            folder = jvm.org.apache.hadoop.fs.Path(f"{self.location}/{name}")
            store = folder.getFileSystem(conf)
            for status in store.listStatus(folder) if store.exists(folder) else []:
                path = status.getPath()
                if path.getName().startswith("load=") and path.getName()[5:] not in keep:
                    store.delete(path, True)
                    gone.append(f"{name}/{path.getName()}")
            self.spark.catalog.refreshTable(f"{self.database}.rows_{name}")
        return sorted(gone)

    def row_counts(self, names: Iterable[str] | None = None) -> DataFrame:
        at = self.tables_at()
        return table_counts({n: at[n] for n in names or at})


def load_star(mart: Mart, jobs: DataFrame, job_skills: DataFrame, as_of: Column, batch: str) -> bool:
    """Dimensions, facts and links of one batch, checked and then published at once.

    Members and jobs that are published are not added again; of repeats inside the batch the first by its other
    values is stored.  False if the batch was published before.
    """
    load = mart.begin(batch)
    if load is None:
        return False
    before = mart.tables_at()
    dims = [
        ("dim_companies", wh.dim_companies(jobs, keep_unknown=True), "company_id", "company_name"),
        ("dim_locations", wh.dim_locations(jobs, keep_unknown=True), "location_id", "location_name"),
        ("dim_skills", wh.dim_skills(job_skills), "skill_id", "skill_name"),
    ]
    for table, members, key, name in dims:
        mart.write(table, wh.surrogate_key(members, key, name, before[table]), load)
    now = mart.tables_at(*mart.published(), load)

    facts = wh.fact_jobs(jobs, now["dim_companies"], now["dim_locations"], as_of)
    fresh = facts.join(before["fact_jobs"].select("job_id"), "job_id", "left_anti")
    others = [c for c in fresh.columns if c not in ("job_id", "description")]
    mart.write("fact_jobs", keep_first(fresh, ["job_id"], [*others, "description"]), load)

    links = wh.fact_job_skills(job_skills, now["dim_skills"])
    fresh = links.join(before["fact_job_skills"].select("job_id", "skill_id"), ["job_id", "skill_id"], "left_anti")
    fresh = keep_first(fresh, ["job_id", "skill_id"], [F.desc("confidence_score"), "position_in_description", "extracted_method"])
    top = before["fact_job_skills"].agg(F.coalesce(F.max("job_skill_id"), F.lit(0))).first()[0]
    keyed = number_rows(stage(fresh, "links"), ["job_id", "skill_id"], name="job_skill_id")
    mart.write("fact_job_skills", keyed.withColumn("job_skill_id", F.col("job_skill_id") + top), load)
    mart.check(load)
    mart.publish(batch, load)
    return True


# The dimensions of the wider model: name, key, and the columns of a record that describe a member.
_DESCRIBED = {
    "companies": ("company_name", "company_id", ["company_url", "company_size", "industry"]),
    "locations": ("location", "location_id", ["city", "country", "region", "latitude", "longitude"]),
    "sources": ("source", "source_id", ["source_type", "base_url"]),
}


def load_extended(mart: Mart, records: DataFrame, at: Column, batch: str) -> bool:
    """One state of all postings into a mart of ``schemas.EXTENDED``: only what changed is written.

    A posting is known by its external id, without one by its address, without both by its values.  A posting that is
    no longer among ``records`` is closed (``is_active`` false) and reopened when it is back; companies,
    places and sources stay.  ``updated_at`` moves only with a value.  Columns that describe companies, places and
    sources may be absent; a member takes each from its latest posting that has one.  False if the batch was published before.
    """
    load = mart.begin(batch)
    if load is None:
        return False
    number = F.lit(len(mart.history()) + 1)
    kinds = {f.name: f.dataType for schema in schemas.EXTENDED.values() for f in schema.fields}
    made = {"job_key", *[key for _, key, _ in _DESCRIBED.values()], *schemas.VERSION}
    wanted = {"source", *[c for _, _, columns in _DESCRIBED.values() for c in columns], *schemas.EXTENDED["jobs"].fieldNames()}
    absent = {c: F.lit(None).cast(kinds.get(c, T.StringType())) for c in wanted - made - set(records.columns)}
    filled = stage(records.withColumns(absent).select(*(wanted - made), "company_name", "location"), "records")
    before = mart.tables_at()
    newest = filled.withColumn("_age", -F.coalesce(F.unix_date("published_at"), F.lit(-(1 << 30))))
    keyed = filled
    for table, (name, key, columns) in _DESCRIBED.items():
        stored_name = {"location": "location_name", "source": "source_name"}.get(name, name)
        members = vs.described(newest, name, {c: c for c in columns}, ["_age", "job_url", "external_job_id"])
        members = stage(members.withColumnRenamed(name, stored_name), "described")
        changes = vs.changed_rows(before[table], members, [stored_name], columns, at, number, close_missing=False)
        mart.write(table, vs.with_keys(changes, before[table], stored_name, key), load, at)
        now = mart.read(table, *mart.published(), load)
        keyed = wh.lookup_keys(keyed, now, stored_name, key, name)
    values = [c for c in schemas.EXTENDED["jobs"].fieldNames() if c not in ("job_key", *schemas.VERSION)]
    known_by = F.coalesce(
        F.concat(F.lit("id:"), F.nullif("external_job_id", F.lit(""))), F.concat(F.lit("url:"), F.nullif("job_url", F.lit(""))),
        F.concat(F.lit("row:"), vs.row_digest(values)))
    keyed = stage(keyed.withColumn("job_key", known_by).select("job_key", *values), "keyed")
    mart.write("jobs", vs.changed_rows(before["jobs"], keyed, ["job_key"], values, at, number), load, at)
    mart.publish(batch, load)
    return True
