"""Cleaning of scraped postings: align, stack, tidy, de-duplicate, summarise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vacantia.functions import text as tx
from vacantia.operators.rows import keep_first, value_counts
from vacantia.schemas import CLEAN_COLUMNS

# ---------------------------------------------------------------- fixed values
TITLE_RULES = [
    (r"data scientist", "Data Scientist"),
    (r"data analyst", "Data Analyst"),
    (r"data engineer", "Data Engineer"),
    (r"machine learning\s+engineer", "Machine Learning Engineer"),
    (r"ml engineer", "Machine Learning Engineer"),
    (r"ai engineer", "AI Engineer"),
    (r"artificial intelligence\s+engineer", "AI Engineer"),
]
UNSPECIFIED = ["Non spécifié", "non spécifié", "N/A", "nan"]
NOT_SPECIFIED = "Not specified"
# ------------------------------------------------------------------------------


def harmonize_columns(df: DataFrame) -> DataFrame:
    """Add ``publish_date`` from ``scrape_date`` if missing; keep the nine columns in order."""
    if "publish_date" not in df.columns:
        filler = F.col("scrape_date") if "scrape_date" in df.columns else F.lit(None).cast("string")
        df = df.withColumn("publish_date", filler)
    return df.select(*[c for c in CLEAN_COLUMNS if c in df.columns])


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Sources under each other, tagged with their position as ``source_order``."""
    out = None
    for position, frame in enumerate(frames):
        part = frame.withColumn("source_order", F.lit(position))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def clean_description(c: Column) -> Column:
    return tx.truncate_text(tx.clean_text(c))


def normalize_title(c: Column) -> Column:
    """All seven replacements in order; if none changed the title, capitalize each word."""

    def ruled(title: Column) -> Column:
        changed = title
        for pattern, name in TITLE_RULES:
            changed = F.regexp_replace(changed, f"(?iu){tx.word_bounded(pattern)}", name)
        return tx.let(
            changed, lambda new: F.when(new == title, tx.capitalize_words(title)).otherwise(new)
        )

    return F.coalesce(tx.let(tx.strip(c), ruled), F.lit(""))


def standardize_company(c: Column) -> Column:
    """Cleaned name; null stays null; placeholders become one value."""
    name = F.when(c.isNotNull(), tx.clean_text(c))
    return F.when(name.isin(UNSPECIFIED), F.lit(NOT_SPECIFIED)).otherwise(name)


def arrival_order(df: DataFrame) -> list[Column]:
    """Source position, then the running number in ``job_id``, then the values themselves."""
    first = [F.col("source_order")] if "source_order" in df.columns else []
    number = F.expr(r"try_cast(regexp_extract(job_id, '(\\d+)$', 1) AS decimal(38,0))")
    return [*first, number, F.col("job_id"), F.col("url"), F.col("title"), F.col("company"),
            F.col("description")]


def dedupe_by_url(df: DataFrame) -> DataFrame:
    """First row per url; one row without a url survives."""
    return keep_first(df, ["url"], arrival_order(df))


def dedupe_by_title_company(df: DataFrame) -> DataFrame:
    return keep_first(df, ["title", "company"], arrival_order(df))


def tidy_columns(df: DataFrame) -> DataFrame:
    """The row-wise steps; also valid on a stream."""
    return df.withColumns({
        "description": clean_description(F.col("description")),
        "title": normalize_title(F.col("title")),
        "company": standardize_company(F.col("company")),
    })


def clean_jobs(frames: list[DataFrame]) -> DataFrame:
    """Align, stack, tidy, then drop repeats by url and by (title, company)."""
    stacked = union_sources([harmonize_columns(f) for f in frames])
    unique = stacked.transform(tidy_columns).transform(dedupe_by_url).transform(dedupe_by_title_company)
    return unique.select(*CLEAN_COLUMNS)


def dedupe_report(frames: list[DataFrame], cleaned: DataFrame) -> DataFrame:
    """Rows before, rows after, rows removed."""
    stacked = union_sources([harmonize_columns(f) for f in frames])
    before = stacked.agg(F.count("*").alias("n"))
    return cleaned.agg(F.count("*").alias("rows_out")).withColumn(
        "rows_in", before.scalar()
    ).select("rows_in", "rows_out", (F.col("rows_in") - F.col("rows_out")).alias("rows_removed"))


def summary_total(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_jobs"))


def summary_by_source(df: DataFrame) -> DataFrame:
    return value_counts(df, "source")


def summary_top_companies(df: DataFrame) -> DataFrame:
    return value_counts(df, "company", 10)


def summary_top_titles(df: DataFrame) -> DataFrame:
    return value_counts(df, "title", 10)


def summary_by_location(df: DataFrame) -> DataFrame:
    return value_counts(df, "location")
