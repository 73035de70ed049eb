"""Explicit schemas of every file and table (nothing is inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
_DATE, _TS = T.DateType(), T.TimestampType()
_VEC = T.ArrayType(T.FloatType())


def _struct(*cols: tuple) -> T.StructType:
    return T.StructType([T.StructField(c[0], c[1], c[2] if len(c) > 2 else True) for c in cols])


# The nine ordered columns of a cleaned posting (fixed values).
CLEAN_COLUMNS = [
    "job_id", "title", "company", "location", "url",
    "description", "publish_date", "source", "scrape_date",
]

JOBS_CLEANED = _struct(*[(c, _S) for c in CLEAN_COLUMNS])
RAW_JOBS = JOBS_CLEANED
RAW_JOBS_WITHOUT_DATE = _struct(*[(c, _S) for c in CLEAN_COLUMNS if c != "publish_date"])

JOB_SKILLS = _struct(
    ("job_id", _S), ("skill_name", _S), ("skill_category", _S),
    ("confidence_score", _D), ("position_in_description", _I), ("extraction_method", _S),
)

API_ITEM = _struct(
    ("position", _S), ("company", _S), ("location", _S), ("url", _S),
    ("description", _S), ("tags", T.ArrayType(_S)),
)

RECORD = _struct(
    ("job_title", _S), ("job_description", _S), ("company_name", _S), ("location", _S),
    ("experience_level", _S), ("contract_type", _S), ("job_url", _S), ("external_job_id", _S),
    ("published_at", _DATE), ("skills", T.ArrayType(_S)), ("salary_min", _D),
    ("salary_max", _D), ("salary_currency", _S),
)

DIM_COMPANIES = _struct(
    ("company_id", _L, False), ("company_name", _S, False), ("industry", _S), ("country", _S),
    ("created_at", _TS), ("updated_at", _TS),
)
DIM_LOCATIONS = _struct(
    ("location_id", _L, False), ("location_name", _S, False), ("country", _S), ("region", _S),
    ("created_at", _TS),
)
DIM_SKILLS = _struct(
    ("skill_id", _L, False), ("skill_name", _S, False), ("skill_category", _S),
    ("skill_level", _S), ("created_at", _TS),
)
DIM_TIME = _struct(
    ("date_id", _I, False), ("date", _DATE, False), ("year", _I), ("month", _I), ("day", _I),
    ("quarter", _I), ("week", _I), ("day_of_week", _I),
)
FACT_JOBS = _struct(
    ("job_id", _S, False), ("company_id", _L), ("location_id", _L), ("job_title", _S),
    ("job_title_normalized", _S), ("description", _S), ("description_length", _I),
    ("publish_date", _DATE), ("publish_date_id", _I), ("scrape_date", _TS), ("source", _S),
    ("url", _S), ("job_posting_days_old", _I), ("created_at", _TS),
)
FACT_JOB_SKILLS = _struct(
    ("job_skill_id", _L), ("job_id", _S, False), ("skill_id", _L), ("mentioned_count", _I),
    ("extracted_method", _S), ("confidence_score", _D), ("position_in_description", _I),
    ("created_at", _TS),
)

STAR = {
    "dim_companies": DIM_COMPANIES,
    "dim_locations": DIM_LOCATIONS,
    "dim_skills": DIM_SKILLS,
    "dim_time": DIM_TIME,
    "fact_jobs": FACT_JOBS,
    "fact_job_skills": FACT_JOB_SKILLS,
}

# The wider, declared model: every table is a log of versions.
_VERSION = (
    ("row_digest", _S), ("change", _S), ("is_active", T.BooleanType()), ("created_at", _TS), ("updated_at", _TS), ("load_no", _L),
)
VERSION = [c for c, _ in _VERSION]
EXTENDED = {
    "companies": _struct(("company_id", _L), ("company_name", _S), ("company_url", _S), ("company_size", _S), ("industry", _S), *_VERSION),
    "locations": _struct(
        ("location_id", _L), ("location_name", _S), ("city", _S), ("country", _S), ("region", _S), ("latitude", _D), ("longitude", _D), *_VERSION),
    "sources": _struct(("source_id", _L), ("source_name", _S), ("source_type", _S), ("base_url", _S), *_VERSION),
    "jobs": _struct(
        ("job_key", _S), ("external_job_id", _S), ("job_title", _S), ("job_description", _S), ("company_id", _L), ("location_id", _L),
        ("source_id", _L), ("experience_level", _S), ("contract_type", _S), ("salary_min", _D), ("salary_max", _D),
        ("salary_currency", _S), ("job_url", _S), ("published_at", _DATE), *_VERSION),
}

# Declared keys of the star: (table, columns) and (table, column, parent, parent column).
PRIMARY_KEYS = {
    "dim_companies": ["company_id"], "dim_locations": ["location_id"], "dim_skills": ["skill_id"],
    "dim_time": ["date_id"], "fact_jobs": ["job_id"], "fact_job_skills": ["job_skill_id"],
}
UNIQUE_KEYS = [
    ("dim_companies", ["company_name"]), ("dim_locations", ["location_name"]),
    ("dim_skills", ["skill_name"]), ("dim_time", ["date"]),
    ("fact_job_skills", ["job_id", "skill_id"]),
]
NOT_NULL = {
    "dim_companies": ["company_name"], "dim_locations": ["location_name"],
    "dim_skills": ["skill_name"], "dim_time": ["date"],
    "fact_jobs": ["company_id", "location_id", "job_title"],
    "fact_job_skills": ["job_id", "skill_id"],
}
FOREIGN_KEYS = [
    ("fact_jobs", "company_id", "dim_companies", "company_id"),
    ("fact_jobs", "location_id", "dim_locations", "location_id"),
    ("fact_jobs", "publish_date_id", "dim_time", "date_id"),
    ("fact_job_skills", "job_id", "fact_jobs", "job_id"),
    ("fact_job_skills", "skill_id", "dim_skills", "skill_id"),
]

INGESTION_LOG = _struct(
    ("source_name", _S), ("status", _S), ("jobs_count", _L), ("errors_count", _L),
    ("started_at", _TS), ("ended_at", _TS), ("error_message", _S),
)
CANDIDATES = _struct(
    ("name", _S), ("skills", T.ArrayType(_S)), ("experience", _S), ("interests", _S),
    ("embedding", _VEC),
)
JOB_EMBEDDINGS = _struct(
    ("job_id", _S), ("description_embedding", _VEC), ("title_embedding", _VEC),
)
