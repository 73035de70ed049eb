"""Star schema: dimensions, keys, facts, checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from vacantia import schemas
from vacantia.functions import text as tx
from vacantia.functions.dates import age_in_days, parse_lenient
from vacantia.operators.rows import number_rows
from vacantia.session import stage

UNKNOWN = "Unknown"


def dim_companies(jobs: DataFrame, keep_unknown: bool = False) -> DataFrame:
    """Distinct trimmed names without "Unknown".

    ``keep_unknown`` adds an "Unknown" member, so that the fill value of the fact finds a key.
    """
    names = jobs.select(tx.strip(F.col("company")).alias("company_name"))
    if keep_unknown:
        return names.select(F.coalesce("company_name", F.lit(UNKNOWN)).alias("company_name")).distinct()
    return names.distinct().filter(F.col("company_name").isNotNull() & (F.col("company_name") != UNKNOWN))


def dim_locations(jobs: DataFrame, keep_unknown: bool = False) -> DataFrame:
    names = jobs.select(tx.strip(F.col("location")).alias("location_name"))
    if keep_unknown:
        names = names.select(F.coalesce("location_name", F.lit(UNKNOWN)).alias("location_name"))
    return names.distinct()


def dim_skills(job_skills: DataFrame) -> DataFrame:
    """Distinct (skill, category), sorted by skill."""
    return job_skills.select("skill_name", "skill_category").distinct().orderBy("skill_name", "skill_category")


def surrogate_key(members: DataFrame, key: str, name: str, existing: DataFrame | None = None) -> DataFrame:
    """Members that are not stored yet, numbered on from the largest stored key."""
    if existing is None:
        return number_rows(stage(members, "members"), [name], name=key)
    fresh = stage(members.join(existing, name, "left_anti"), "members")
    top = existing.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
    return number_rows(fresh, [name], name=key).withColumn(key, F.col(key) + top)


def lookup_keys(fact: DataFrame, dim: DataFrame, name: str, key: str, on: str) -> DataFrame:
    """Adds ``key`` by name; the largest key wins among repeated names, a miss gives null."""
    unique = dim.groupBy(F.col(name).alias("_name")).agg(F.max(key).alias(key))
    return fact.join(unique, F.col(on) == F.col("_name"), "left").drop("_name")


def dim_time(first: Column, last: Column, df: DataFrame) -> DataFrame:
    """One row per day between two dates taken from one-row frame ``df``."""
    day = F.col("date")
    days = df.select(F.explode(F.sequence(first, last)).alias("date"))
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_id"), "date",
        F.year(day).alias("year"), F.month(day).alias("month"), F.dayofmonth(day).alias("day"),
        F.quarter(day).alias("quarter"), F.weekofyear(day).alias("week"),
        F.dayofweek(day).alias("day_of_week"),
    )


def time_span(jobs: DataFrame, column: str = "publish_date") -> DataFrame:
    """``dim_time`` over the dates that occur."""
    span = jobs.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).filter(F.col("lo").isNotNull())
    return dim_time(F.col("lo"), F.col("hi"), span)


def fact_jobs(
    jobs: DataFrame, companies: DataFrame, locations: DataFrame, as_of: Column,
    exact_names: bool = False,
) -> DataFrame:
    """The job fact in its twelve loaded columns.

    Names are trimmed before the lookup, as they are in the dimensions; ``exact_names``
    looks up the untrimmed names instead, so that a padded name gets no key.
    """
    clean = (lambda c: c) if exact_names else tx.strip
    filled = jobs.withColumns({
        "description": F.coalesce("description", F.lit("")),
        "_company": clean(F.coalesce("company", F.lit(UNKNOWN))),
        "_location": clean(F.coalesce("location", F.lit(UNKNOWN))),
        "_published": parse_lenient(F.col("publish_date")),
        "_scraped": parse_lenient(F.col("scrape_date")),
    })
    keyed = lookup_keys(filled, companies, "company_name", "company_id", "_company")
    keyed = lookup_keys(keyed, locations, "location_name", "location_id", "_location")
    return keyed.select(
        "job_id", "company_id", "location_id",
        F.col("title").alias("job_title"),
        tx.strip(F.lower("title")).alias("job_title_normalized"),
        "description",
        F.length("description").alias("description_length"),
        F.date_format("_published", "yyyy-MM-dd").alias("publish_date"),
        F.date_format("_scraped", "yyyy-MM-dd HH:mm:ss").alias("scrape_date"),
        "source", "url",
        age_in_days(as_of, F.col("_published")).alias("job_posting_days_old"),
    )


def fact_job_skills(job_skills: DataFrame, skills: DataFrame) -> DataFrame:
    """The job-skill fact; a score that is no number becomes 0.5, a position -1."""
    keyed = lookup_keys(job_skills, skills, "skill_name", "skill_id", "skill_name")
    score = F.col("confidence_score").cast("string").try_cast("double")
    place = F.col("position_in_description").cast("string").try_cast("double")
    return keyed.select(
        "job_id", "skill_id", F.lit(1).alias("mentioned_count"),
        F.col("extraction_method").alias("extracted_method"),
        F.coalesce(F.nanvl(score, F.lit(None).cast("double")), F.lit(0.5)).alias("confidence_score"),
        F.coalesce(F.nanvl(place, F.lit(None).cast("double")).try_cast("int"), F.lit(-1)).alias(
            "position_in_description"
        ),
    )


def dim_sources(jobs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Declared source dimension: distinct names, with type and address where known."""
    names = jobs.select(F.col("source").alias("source_name")).distinct().filter(
        F.col("source_name").isNotNull()
    )
    if known is None:
        return names.withColumns({
            "source_type": F.lit(None).cast("string"), "base_url": F.lit(None).cast("string"),
        })
    return names.join(known.select("source_name", "source_type", "base_url"), "source_name", "left")


def extended_fact(
    records: DataFrame, companies: DataFrame, locations: DataFrame, sources: DataFrame, loaded_at: Column
) -> DataFrame:
    """Declared wider fact over normalized records: contract, salary, activity, change time."""
    keyed = lookup_keys(records, companies, "company_name", "company_id", "company_name")
    keyed = lookup_keys(keyed, locations, "location_name", "location_id", "location")
    keyed = lookup_keys(keyed, sources, "source_name", "source_id", "source")
    return keyed.select(
        "external_job_id", "job_title", "job_description", "company_id", "location_id", "source_id",
        "experience_level", "contract_type", "salary_min", "salary_max", "salary_currency",
        "job_url", "published_at", F.lit(True).alias("is_active"),
        loaded_at.alias("created_at"), loaded_at.alias("updated_at"),
    )


def check_constraints(tables: dict[str, DataFrame]) -> DataFrame:
    """``(check_name, table_name, columns, violations)`` for every declared key and reference."""
    found = []

    def add(kind: str, table: str, columns: list[str], bad: DataFrame) -> None:
        found.append(bad.select(
            F.lit(kind).alias("check_name"), F.lit(table).alias("table_name"),
            F.lit(", ".join(columns)).alias("columns"),
            F.col("violations").cast("bigint").alias("violations"),
        ))

    def repeats(table: str, columns: list[str]) -> DataFrame:
        grouped = tables[table].dropna(subset=columns).groupBy(*columns).agg(F.count("*").alias("n"))
        return grouped.agg(F.count_if(F.col("n") > 1).alias("violations"))

    def has(table: str, columns: list[str]) -> bool:
        return table in tables and set(columns) <= set(tables[table].columns)

    for table, columns in [*schemas.PRIMARY_KEYS.items(), *schemas.UNIQUE_KEYS]:
        if has(table, columns):
            kind = "primary key" if schemas.PRIMARY_KEYS[table] == columns else "unique"
            add(kind, table, columns, repeats(table, columns))
    for table, names in schemas.NOT_NULL.items():
        needed = [c for c in [*schemas.PRIMARY_KEYS[table], *names] if has(table, [c])]
        if needed:
            # All columns of a table in one scan.
            counts = tables[table].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in needed])
            cells = F.array(*[F.struct(F.lit(c).alias("columns"), F.col(c).alias("violations")) for c in needed])
            found.append(counts.select(F.inline(cells)).select(
                F.lit("not null").alias("check_name"), F.lit(table).alias("table_name"), "columns",
                F.col("violations").cast("bigint").alias("violations"),
            ))
    for table, column, parent, parent_key in schemas.FOREIGN_KEYS:
        if has(table, [column]) and has(parent, [parent_key]):
            # Count per key first: a key shared by most rows is then one row of the join.
            used = tables[table].groupBy(column).agg(F.count("*").alias("n")).dropna(subset=[column])
            keys = tables[parent].select(F.col(parent_key).alias(column))
            orphans = used.join(keys, column, "left_anti")
            add("foreign key", table, [column],
                orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")))
    return reduce(DataFrame.unionByName, found)
