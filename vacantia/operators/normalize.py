"""Normalization of canonical records (the second cleaner, with its own rules)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vacantia.functions import text as tx
from vacantia.operators.rows import keep_first

# ---------------------------------------------------------------- fixed values
TITLE_MAP = [
    (r"data.*scientist", "Data Scientist"),
    (r"data.*engineer", "Data Engineer"),
    (r"ml.*engineer|machine.*learning", "ML Engineer"),
    (r"analytics.*engineer", "Analytics Engineer"),
    (r"data.*analyst", "Data Analyst"),
    (r"bi.*developer|business.*intelligence", "BI Developer"),
    (r"python.*developer", "Python Developer"),
]
SKILL_NAMES = {
    "python": "Python", "sql": "SQL", "spark": "Apache Spark", "scala": "Scala", "java": "Java",
    "r": "R", "pandas": "Pandas", "numpy": "NumPy", "sklearn": "Scikit-Learn",
    "tensorflow": "TensorFlow", "pytorch": "PyTorch", "machine learning": "Machine Learning",
    "deep learning": "Deep Learning", "nlp": "NLP", "computer vision": "Computer Vision",
    "power bi": "Power BI", "tableau": "Tableau", "looker": "Looker", "aws": "AWS",
    "azure": "Azure", "gcp": "Google Cloud", "docker": "Docker", "kubernetes": "Kubernetes",
    "git": "Git", "linux": "Linux",
}
UNSPECIFIED = "Non spécifié"
DEFAULT_CURRENCY = "EUR"
# ------------------------------------------------------------------------------


def map_title(c: Column) -> Column:
    """The first rule found names the title; otherwise the scrubbed title."""

    def named(title: Column) -> Column:
        mapped = F.when(F.lit(False), title)
        for pattern, name in TITLE_MAP:
            mapped = mapped.when(title.rlike(f"(?iud){pattern}"), name)
        return mapped.otherwise(title)

    return tx.let(tx.scrub_text(c), named)


def standardize_skills(text: Column, given: Column, names: dict[str, str] | None = None) -> Column:
    """Given skills by their standard names, plus every key found inside the text; sorted."""
    names = SKILL_NAMES if names is None else names
    lookup = F.create_map(*[F.lit(v) for pair in names.items() for v in pair])
    low = F.lower(F.coalesce(text, F.lit("")))
    told = F.transform(
        F.coalesce(given, F.array().cast("array<string>")),
        lambda s: F.coalesce(F.try_element_at(lookup, F.lower(s)), s),
    )
    found = F.array_compact(
        F.array(*[F.when(low.contains(key), F.lit(name)) for key, name in names.items()])
    )
    return F.array_sort(F.array_union(told, found))


def dedupe_by_key(df: DataFrame, order: list[str]) -> DataFrame:
    """First row per key; the url is the key only where the external id is absent (null).

    Rows with an empty key are dropped.
    """
    keyed = df.withColumn("_key", F.coalesce("external_job_id", "job_url", F.lit("")))
    return keep_first(keyed.filter(F.col("_key") != ""), ["_key"], order).drop("_key")


def _choice(c: Column) -> Column:
    return F.coalesce(F.nullif(tx.strip(c), F.lit("")), F.lit(UNSPECIFIED))


def normalize_record(df: DataFrame) -> DataFrame:
    """The 13 normalized fields.

    ``salary_currency`` takes its default only where the column is absent; a null value
    that was given is kept.
    """
    have = set(df.columns)

    def get(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in have else F.lit(None).cast(kind)

    currency = F.col("salary_currency") if "salary_currency" in have else F.lit(DEFAULT_CURRENCY)
    return df.select(
        map_title(F.col("job_title")).alias("job_title"),
        tx.scrub_text(F.col("job_description")).alias("job_description"),
        tx.scrub_text(get("company_name", "string")).alias("company_name"),
        tx.scrub_text(get("location", "string")).alias("location"),
        _choice(get("experience_level", "string")).alias("experience_level"),
        _choice(get("contract_type", "string")).alias("contract_type"),
        F.coalesce(get("job_url", "string"), F.lit("")).alias("job_url"),
        F.coalesce(get("external_job_id", "string"), F.lit("")).alias("external_job_id"),
        get("published_at", "date").alias("published_at"),
        standardize_skills(F.col("job_description"), get("skills", "array<string>")).alias("skills"),
        get("salary_min", "double").alias("salary_min"),
        get("salary_max", "double").alias("salary_max"),
        currency.alias("salary_currency"),
    )


def failed_rows(df: DataFrame) -> DataFrame:
    """Records that cannot be normalized: a null list entry among the given skills."""
    return df.filter(_fails(df))


def drop_failed_rows(df: DataFrame) -> DataFrame:
    return df.filter(~_fails(df))


def _fails(df: DataFrame) -> Column:
    if "skills" not in df.columns:
        return F.lit(False)
    return F.coalesce(F.exists("skills", lambda s: s.isNull()), F.lit(False))


def validate_records(df: DataFrame) -> DataFrame:
    return df.filter((F.length("job_title") > 0) & (F.length("job_description") > 0))


def normalize_records(df: DataFrame, order: list[str]) -> DataFrame:
    """De-duplicate, drop failures, normalize, keep the valid."""
    return (
        dedupe_by_key(df, order)
        .transform(drop_failed_rows)
        .transform(normalize_record)
        .transform(validate_records)
    )


def normalize_report(df: DataFrame, order: list[str]) -> DataFrame:
    """Row counts after each step, in one pass over the de-duplicated records."""
    unique = dedupe_by_key(df, order)
    counted = unique.select(
        _fails(unique).alias("failed"),
        ((F.length(map_title(F.col("job_title"))) > 0)
         & (F.length(tx.scrub_text(F.col("job_description"))) > 0)).alias("valid"),
    ).agg(
        F.count("*").alias("unique_rows"),
        F.count_if(~F.col("failed")).alias("cleaned_rows"),
        F.count_if(~F.col("failed") & F.col("valid")).alias("valid_rows"),
    )
    return counted.withColumn("input_rows", df.agg(F.count("*")).scalar())
