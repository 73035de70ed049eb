"""Files, tables, dimensions, facts and checks over the documents."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F, types as T

from vacantia.catalogue import sqltext as sq
from vacantia.catalogue.text_queries import ORACLES as TEXT_ORACLES
from vacantia.catalogue.text_queries import GROUPS, WORDS, _CATEGORY, _CLEAN_SQL, _cleaned, _lexicon_sql
from vacantia.operators import clean as cl
from vacantia.operators import skills as sk
from vacantia.operators import warehouse as wh
from vacantia.plans.standin import (
    RAW_SQL, RECORDS_SQL, boards, raw_jobs, records, star, table, vectors,
)
from vacantia.session import scratch_path, stage
from vacantia.sources import files, runs, tables
from vacantia.sources.audit import failed_source, ingestion_audit

NOW = "2024-02-01 12:00:00"


def _now():
    return F.lit(NOW).cast("timestamp")


def _stored_jobs(spark, sf_dir):
    """Cleaned postings as a stored table, as they are between two stages of the flow."""
    return stage(_cleaned(spark, sf_dir), "cleaned")


def _skills_of(jobs):
    return sk.explode_job_skills(sk.merge_methods(sk.match_lexicon(jobs, WORDS), None), GROUPS)


def _job_skills(spark, sf_dir):
    """Lexicon matches of the cleaned postings."""
    return _skills_of(_cleaned(spark, sf_dir))


def _read_raw(spark, sf_dir):
    with_date, without = boards(spark, sf_dir)
    paths = [files.write_csv(df, scratch_path(spark, "raw")) for df in (with_date, without)]
    return cl.union_sources([cl.harmonize_columns(f) for f in files.read_raw_jobs(spark, *paths)])


def _read_clean(spark, sf_dir):
    return files.read_clean_jobs(spark, files.write_csv(_cleaned(spark, sf_dir), scratch_path(spark, "clean")))


def _read_skills(spark, sf_dir):
    path = scratch_path(spark, "skills")
    _job_skills(spark, sf_dir).write.parquet(path)
    return files.read_job_skills(spark, path, "parquet")


def _write_csv(spark, sf_dir):
    return files.read_job_skills(spark, files.write_csv(_job_skills(spark, sf_dir), scratch_path(spark, "skills")))


def _api(spark, sf_dir):
    """One payload per document: a notice, the posting, a number, and a posting without tags."""
    posting = F.to_json(F.struct(
        F.col("title").alias("position"), "company", "location", "url", "description",
        F.array("source", "location").alias("tags"), F.col("doc_id").alias("ignored"),
    ))
    bare = F.to_json(F.struct(F.col("url").alias("url")))
    payload = F.concat(F.lit('["legal notice", '), posting, F.lit(", 42, "), bare, F.lit("]"))
    return files.read_api_json(raw_jobs(spark, sf_dir).select(payload.alias("payload")))


def _rejected(spark, sf_dir):
    """A cut-off array, an object, nothing, and a whole array in turn."""
    kind = F.pmod(F.col("doc_id"), F.lit(4))
    payload = F.when(kind == 0, '[{"url": "x"}, {"ur').when(kind == 1, '{"url": "x"}').when(kind == 2, '[{"url": "x"}]')
    rows = table(spark, sf_dir, "documents").select("doc_id", payload.alias("payload"))
    return files.rejected_payloads(rows).select("doc_id", "payload")


def _append(spark, sf_dir):
    name = f"appended_{uuid.uuid4().hex}"
    path = scratch_path(spark, name)
    for part in (cl.harmonize_columns(b) for b in boards(spark, sf_dir)):
        if not spark.catalog.tableExists(name):
            part.limit(0).write.option("path", path).saveAsTable(name)
        tables.append_table(part, name)
    return spark.table(name)


def _run_sql(spark, sf_dir):
    table(spark, sf_dir, "documents").createOrReplaceTempView("stored_documents")
    return tables.run_sql(
        spark, "-- per source\nSELECT source, count(*) AS n, count_if(lang = :lang) AS n_lang FROM stored_documents GROUP BY source",
        lang="en",
    )


def _fresh(spark):
    database = f"mart_{uuid.uuid4().hex}"
    return database, scratch_path(spark, database)


def _stored_star(spark, sf_dir):
    """The stand-in star in freshly made tables, all six filled."""
    database, path = _fresh(spark)
    tables.create_star_schema(spark, database, path)
    s = star(spark, sf_dir)
    for name, rows in {**s.tables(), "dim_time": wh.time_span(s.jobs)}.items():
        tables.append_table(rows, f"{database}.{name}")
    return database


def _create(spark, sf_dir):
    """Jobs per source and industry, read back from the stored star."""
    database = _stored_star(spark, sf_dir)
    stored = spark.table(f"{database}.fact_jobs").join(spark.table(f"{database}.dim_companies"), "company_id")
    return stored.groupBy("source", "industry").agg(F.count("*").alias("jobs"))


def _loaded(spark, sf_dir):
    database, path = _fresh(spark)
    jobs = _stored_jobs(spark, sf_dir)
    return tables.load_warehouse(spark, jobs, stage(_skills_of(jobs), "skills"), database, path, _now(), buckets=8)


def _reloaded(spark, sf_dir):
    """Loading twice adds nothing."""
    database, path = _fresh(spark)
    jobs = _stored_jobs(spark, sf_dir)
    links = stage(_skills_of(jobs), "skills")
    for _ in range(2):
        counts = tables.load_warehouse(spark, jobs, links, database, path, _now())
    return counts


def _summary(spark, sf_dir):
    jobs = _stored_jobs(spark, sf_dir)
    links = stage(_skills_of(jobs), "skills")
    return tables.load_summary({
        "companies": wh.dim_companies(jobs), "locations": wh.dim_locations(jobs),
        "skills": wh.dim_skills(links), "jobs": jobs, "job_skill_links": links,
    })


def _verify(spark, sf_dir):
    return tables.verify_row_counts(spark, _stored_star(spark, sf_dir))


def _audit(spark, sf_dir):
    seen = table(spark, sf_dir, "events")
    return ingestion_audit(
        seen, F.col("value") > 5, "event_type", "ts"
    ).select(
        "source_name", "status", "jobs_count", "errors_count",
        F.date_format("started_at", "yyyy-MM-dd HH:mm:ss").alias("started_at"),
        F.date_format("ended_at", "yyyy-MM-dd HH:mm:ss").alias("ended_at"), "error_message",
    )


def _embeddings(spark, sf_dir):
    rows = vectors(spark, sf_dir).select(
        F.col("vec_id").cast("string").alias("job_id"), F.col("embedding").alias("description_embedding"),
        F.lit(None).cast("array<float>").alias("title_embedding"),
    )
    stored = files.persist_embeddings(rows, scratch_path(spark, "vectors"))
    return stored.select(
        "job_id", F.size("description_embedding").alias("width"), F.round("description_norm", 6).alias("norm")
    )


def _companies(jobs):
    return wh.surrogate_key(wh.dim_companies(jobs, True), "company_id", "company_name")


def _locations(jobs):
    return wh.surrogate_key(wh.dim_locations(jobs, True), "location_id", "location_name")


def _fact_jobs(spark, sf_dir):
    jobs = _stored_jobs(spark, sf_dir)
    return wh.fact_jobs(jobs, _companies(jobs), _locations(jobs), _now())


def _lookup(spark, sf_dir):
    return wh.lookup_keys(
        raw_jobs(spark, sf_dir).select("doc_id", "company"),
        _companies(_cleaned(spark, sf_dir)), "company_name", "company_id", "company",
    )


def _fact_links(spark, sf_dir):
    rows = stage(_job_skills(spark, sf_dir), "skills")
    dim = wh.surrogate_key(wh.dim_skills(rows), "skill_id", "skill_name")
    score = F.when(F.col("skill_name") == "the", F.lit("high")).otherwise(F.col("confidence_score").cast("string"))
    place = F.when(F.col("skill_name") == "with", F.lit(None)).otherwise(F.col("position_in_description"))
    return wh.fact_job_skills(
        rows.withColumns({"confidence_score": score, "position_in_description": place}), dim
    )


def _checked(spark, sf_dir):
    """A star loaded by untrimmed names and without an "Unknown" member."""
    raw = raw_jobs(spark, sf_dir)
    companies = wh.surrogate_key(wh.dim_companies(raw), "company_id", "company_name")
    locations = wh.surrogate_key(wh.dim_locations(raw), "location_id", "location_name")
    jobs = wh.fact_jobs(raw, companies, locations, _now(), exact_names=True)
    return wh.check_constraints({
        "dim_companies": companies, "dim_locations": locations, "fact_jobs": jobs,
    })


def _sources(spark, sf_dir):
    return wh.surrogate_key(
        wh.dim_sources(raw_jobs(spark, sf_dir)), "source_id", "source_name"
    ).select("source_id", "source_name", "source_type", "base_url")


def _extended(spark, sf_dir):
    from vacantia.operators.normalize import normalize_record

    raw = records(spark, sf_dir)
    normal = normalize_record(raw).withColumn("source", F.regexp_extract("external_job_id", r"^(src\d+)", 1))
    sources = wh.surrogate_key(wh.dim_sources(raw_jobs(spark, sf_dir)), "source_id", "source_name")
    jobs = _stored_jobs(spark, sf_dir)
    return wh.extended_fact(normal, _companies(jobs), _locations(jobs), sources, _now()).select(
        "external_job_id", "job_title", "company_id", "location_id", "source_id", "experience_level",
        "contract_type", "salary_min", "salary_currency", "is_active",
        F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"),
    )


def _checked_rows(spark, sf_dir):
    """Lines of three fields: English ones fit, others lack a field, have one too many, or text for a number."""
    line = F.concat_ws(",", "doc_id", "source")
    rows = table(spark, sf_dir, "documents").select(
        F.when(F.col("lang") == "en", F.concat_ws(",", line, "n_chars")).when(F.col("lang") == "fr", line)
        .when(F.col("lang") == "de", F.concat_ws(",", line, "n_chars", F.lit("more"))).otherwise(F.concat_ws(",", line, F.lit("many"))))
    path = scratch_path(spark, "lines")
    rows.write.text(path)
    kinds = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
    return files.read_csv_checked(spark, path, kinds, header=False)


def _failed_source(spark, sf_dir):
    seen = table(spark, sf_dir, "events")
    log = failed_source(ingestion_audit(seen, F.col("value") > 5, "event_type", "ts"), "unreachable", "timeout", _now())
    return log.select("source_name", "status", "jobs_count", "errors_count")


def _ingestion(spark, sf_dir):
    """Every kind of event as a source of its own, and one that cannot be read."""
    seen = table(spark, sf_dir, "events")
    kinds = sorted(r[0] for r in seen.select("event_type").distinct().collect())  # a handful of sources
    sources = {k: (lambda k=k: seen.filter(F.col("event_type") == k)) for k in kinds}
    sources["unreachable"] = lambda: spark.read.parquet(f"{sf_dir}/no_such_table.parquet")
    stored, log = runs.ingest(spark, sources, F.col("value") > 5, scratch_path(spark, "ingested"))
    counts = tables.load_summary(stored).select(F.col("table_name").alias("source_name"), F.col("row_count").alias("stored"))
    return log.join(counts, "source_name", "left").select(
        "source_name", "status", "jobs_count", "errors_count", "error_message", F.coalesce("stored", F.lit(0)).alias("stored"))


def _counted_clean(spark, sf_dir):
    return runs.write_clean_jobs(boards(spark, sf_dir), scratch_path(spark, "clean"))[1].drop("rows_after_url")


QUERIES = {
    "rejected_rows": lambda s, d: _checked_rows(s, d)[1].drop("file"),
    "accepted_rows": lambda s, d: _checked_rows(s, d)[0],
    "failed_source": _failed_source,
    "ingestion_run": _ingestion,
    "clean_jobs_counted": _counted_clean,
    "normalize_counted": lambda s, d: runs.write_normalized(records(s, d), ["doc_id"], scratch_path(s, "normal"))[1],
    "read_raw_jobs": _read_raw,
    "read_clean_jobs": _read_clean,
    "read_job_skills": _read_skills,
    "write_csv": _write_csv,
    "read_api_json": _api,
    "append_table": _append,
    "rejected_payloads": _rejected,
    "run_sql": _run_sql,
    "create_star_schema": _create,
    "load_warehouse": _loaded,
    "load_warehouse_twice": _reloaded,
    "verify_row_counts": _verify,
    "load_summary": _summary,
    "ingestion_audit": _audit,
    "persist_embeddings": _embeddings,
    "dim_companies": lambda s, d: wh.dim_companies(_cleaned(s, d)),
    "dim_locations": lambda s, d: wh.dim_locations(_cleaned(s, d)),
    "dim_skills": lambda s, d: wh.dim_skills(_job_skills(s, d)),
    "surrogate_key": lambda s, d: wh.surrogate_key(
        raw_jobs(s, d).select("title").distinct().filter(F.col("title").isNotNull()), "title_id", "title"),
    "lookup_keys": _lookup,
    "fact_jobs": _fact_jobs,
    "fact_job_skills": _fact_links,
    "dim_time": lambda s, d: wh.time_span(star(s, d).jobs),
    "check_constraints": _checked,
    "dim_sources": _sources,
    "extended_fact": _extended,
}


# ------------------------------------------------------------------- SQL twins

_RAW = f"WITH {RAW_SQL.strip()}"
_CLEAN = f"WITH {_CLEAN_SQL.strip()}"
_NINE = "job_id, title, company, location, url, description, publish_date, source, scrape_date"
_READ = "job_id, nullif(title, '') AS title, company, location, url, nullif(description, '') AS description, publish_date, source, scrape_date"
_LEX = _lexicon_sql().replace("FROM raw)", "FROM cleaned WHERE description <> '')", 1)
_ROWS = f"""{_CLEAN}, {_LEX},
rows AS (SELECT job_id, skill AS skill_name, {_CATEGORY} AS skill_category, CAST(1.0 AS DOUBLE) AS confidence_score,
  position AS position_in_description, 'regex' AS extraction_method FROM lexical)"""
_DIMS = f"""companies AS (
  SELECT row_number() OVER (ORDER BY company_name) AS company_id, company_name FROM (
    SELECT DISTINCT coalesce({sq.strip('company')}, 'Unknown') AS company_name FROM cleaned)),
locations AS (
  SELECT row_number() OVER (ORDER BY location_name) AS location_id, location_name FROM (
    SELECT DISTINCT coalesce({sq.strip('location')}, 'Unknown') AS location_name FROM cleaned))"""
_AGE = f"CAST(floor((epoch_us(TIMESTAMP '{NOW}') - epoch_us(CAST({{}} AS TIMESTAMP))) / 86400000000.0) AS INTEGER)"


def _counts(**bodies: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, ({b}) AS row_count" for n, b in bodies.items())


_LOADED = f"{_ROWS}, {_DIMS} " + _counts(
    dim_companies="SELECT count(*) FROM companies", dim_locations="SELECT count(*) FROM locations",
    dim_skills="SELECT count(DISTINCT skill_name) FROM rows", fact_jobs="SELECT count(*) FROM cleaned",
    fact_job_skills="SELECT count(*) FROM rows",
)


def _star_counts() -> str:
    from vacantia.catalogue.star_queries import on_star

    names = ["dim_companies", "dim_locations", "dim_skills", "fact_jobs", "fact_job_skills"]
    return on_star(_counts(**{n: f"SELECT count(*) FROM {n}" for n in names}))


def _created() -> str:
    from vacantia.catalogue.star_queries import on_star

    return on_star("""SELECT source, industry, count(*) AS jobs FROM fact_jobs j
JOIN dim_companies c ON j.company_id = c.company_id GROUP BY 1, 2""")


def _time() -> str:
    from vacantia.catalogue.star_queries import on_star

    return on_star("""+ days AS (SELECT unnest(generate_series(min(publish_date), max(publish_date), INTERVAL 1 DAY)) AS d
FROM fact_jobs)
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year,
  CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day, CAST(quarter(d) AS INTEGER) AS quarter,
  CAST(week(d) AS INTEGER) AS week, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week FROM days""")


def _normalized_sql() -> str:
    from vacantia.catalogue.text_queries import _NORMALIZED

    return f"""WITH {RECORDS_SQL.strip()}, {_CLEAN_SQL.strip()[len(RAW_SQL.strip()) + 1:]}, {_DIMS},
n AS ({_NORMALIZED} FROM records),
sources AS (SELECT row_number() OVER (ORDER BY source) AS source_id, source FROM (SELECT DISTINCT source FROM documents))
SELECT external_job_id, job_title, company_id, location_id, source_id, experience_level, contract_type, salary_min,
  salary_currency, true AS is_active, '{NOW}' AS updated_at
FROM n LEFT JOIN companies c ON n.company_name = c.company_name LEFT JOIN locations l ON n.location = l.location_name
LEFT JOIN sources s ON regexp_extract(external_job_id, '^(src\\d+)', 1) = s.source"""


def _checks() -> str:
    base = f"""{_RAW},
dim_companies AS (SELECT row_number() OVER (ORDER BY company_name) AS company_id, company_name FROM (
  SELECT DISTINCT {sq.strip('company')} AS company_name FROM raw) WHERE company_name IS NOT NULL AND company_name <> 'Unknown'),
dim_locations AS (SELECT row_number() OVER (ORDER BY location_name) AS location_id, location_name FROM (
  SELECT DISTINCT {sq.strip('location')} AS location_name FROM raw)),
fact_jobs AS (SELECT job_id, company_id, location_id, title AS job_title FROM raw
  LEFT JOIN dim_companies ON coalesce(company, 'Unknown') = company_name
  LEFT JOIN dim_locations ON coalesce(location, 'Unknown') = location_name)"""
    rows = []

    def add(kind, t, k, body):
        rows.append(f"SELECT '{kind}' AS check_name, '{t}' AS table_name, '{k}' AS columns, CAST(({body}) AS BIGINT) AS violations")

    def repeats(t, k):
        return f"SELECT count(*) FROM (SELECT {k} FROM {t} WHERE {k} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)"

    def nulls(t, k):
        return f"SELECT count(*) FROM {t} WHERE {k} IS NULL"

    for t, k in (("dim_companies", "company_id"), ("dim_locations", "location_id"), ("fact_jobs", "job_id")):
        add("primary key", t, k, repeats(t, k))
        add("not null", t, k, nulls(t, k))
    for t, k in (("dim_companies", "company_name"), ("dim_locations", "location_name")):
        add("unique", t, k, repeats(t, k))
        add("not null", t, k, nulls(t, k))
    for k in ("company_id", "location_id", "job_title"):
        add("not null", "fact_jobs", k, nulls("fact_jobs", k))
    for k, p in (("company_id", "dim_companies"), ("location_id", "dim_locations")):
        add("foreign key", "fact_jobs", k, f"""SELECT count(*) FROM fact_jobs x WHERE x.{k} IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{k} = x.{k})""")
    return f"{base} {' UNION ALL '.join(rows)}"


ORACLES = {
    "read_raw_jobs": f"{_RAW} SELECT {_READ}, board AS source_order FROM raw",
    "read_clean_jobs": f"{_CLEAN} SELECT {_READ} FROM cleaned",
    "read_job_skills": f"{_ROWS} SELECT * FROM rows",
    "write_csv": f"{_ROWS} SELECT * FROM rows",
    "read_api_json": f"""{_RAW} SELECT title, company, location, url, description, source || ', ' || location AS skills FROM raw
UNION ALL SELECT NULL, NULL, NULL, url, NULL, '' FROM raw""",
    "append_table": f"{_RAW} SELECT {_NINE} FROM raw",
    "rejected_payloads": """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '[{"url": "x"}, {"ur' WHEN 1 THEN '{"url": "x"}' END AS payload
FROM documents WHERE doc_id % 4 <> 2""",
    "run_sql": "SELECT source, count(*) AS n, count(*) FILTER (WHERE lang = 'en') AS n_lang FROM documents GROUP BY source",
    "create_star_schema": _created(),
    "load_warehouse": _LOADED,
    "load_warehouse_twice": _LOADED,
    "verify_row_counts": _star_counts(),
    "load_summary": f"{_ROWS} " + _counts(
        companies=f"SELECT count(DISTINCT {sq.strip('company')}) FROM cleaned WHERE company IS NOT NULL",
        locations=f"SELECT count(DISTINCT {sq.strip('location')}) FROM cleaned",
        skills="SELECT count(DISTINCT skill_name) FROM rows", jobs="SELECT count(*) FROM cleaned",
        job_skill_links="SELECT count(*) FROM rows",
    ),
    "ingestion_audit": """SELECT event_type AS source_name,
  CASE WHEN count(*) FILTER (WHERE value > 5) = 0 THEN 'error' ELSE 'success' END AS status, count(*) FILTER (WHERE value > 5) AS jobs_count,
  count(*) FILTER (WHERE NOT coalesce(value > 5, false)) AS errors_count,
  strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started_at, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ended_at,
  CASE WHEN count(*) FILTER (WHERE NOT coalesce(value > 5, false)) > 0 THEN
    count(*) FILTER (WHERE NOT coalesce(value > 5, false)) || ' of ' || count(*) || ' rows were rejected' END AS error_message
FROM events GROUP BY 1""",
    "failed_source": """SELECT event_type AS source_name, CASE WHEN count(*) FILTER (WHERE value > 5) = 0 THEN 'error' ELSE 'success' END AS status,
  count(*) FILTER (WHERE value > 5) AS jobs_count, count(*) FILTER (WHERE NOT coalesce(value > 5, false)) AS errors_count FROM events GROUP BY 1
UNION ALL SELECT 'unreachable', 'error', 0, 1""",
    "ingestion_run": """SELECT event_type AS source_name, count(*) FILTER (WHERE value > 5) AS jobs_count,
  count(*) FILTER (WHERE NOT coalesce(value > 5, false)) AS errors_count, CASE WHEN count(*) FILTER (WHERE value > 5) = 0 THEN 'error' ELSE 'success' END AS status,
  CASE WHEN count(*) FILTER (WHERE NOT coalesce(value > 5, false)) > 0 THEN
    count(*) FILTER (WHERE NOT coalesce(value > 5, false)) || ' of ' || count(*) || ' rows were rejected' END AS error_message,
  count(*) FILTER (WHERE value > 5) AS stored FROM events GROUP BY 1
UNION ALL SELECT 'unreachable', 0, 1, 'error', 'PATH_NOT_FOUND', 0""",
    "clean_jobs_counted": f"""{_CLEAN} SELECT (SELECT count(*) FROM raw) AS rows_in, count(*) AS rows_out,
(SELECT count(*) FROM raw) - count(*) AS rows_removed FROM cleaned""",
    "normalize_counted": TEXT_ORACLES["normalize_report"],
    "rejected_rows": """SELECT CASE lang WHEN 'fr' THEN 'short' WHEN 'de' THEN 'long' ELSE 'type' END AS reason, CAST(1 AS INTEGER) AS n_lines,
  CASE lang WHEN 'fr' THEN doc_id || ',' || source WHEN 'de' THEN doc_id || ',' || source || ',' || n_chars || ',more' ELSE doc_id || ',' || source || ',many' END AS record
FROM documents WHERE lang <> 'en'""",
    "accepted_rows": "SELECT doc_id, source, n_chars FROM documents WHERE lang = 'en'",
    "persist_embeddings": """SELECT CAST(vec_id AS VARCHAR) AS job_id, CAST(len(embedding) AS INTEGER) AS width,
  round(sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))), 6) AS norm FROM embeddings""",
    "dim_companies": f"""{_CLEAN} SELECT DISTINCT {sq.strip('company')} AS company_name FROM cleaned
WHERE company IS NOT NULL AND {sq.strip('company')} <> 'Unknown'""",
    "dim_locations": f"{_CLEAN} SELECT DISTINCT {sq.strip('location')} AS location_name FROM cleaned",
    "dim_skills": f"{_ROWS} SELECT DISTINCT skill_name, skill_category FROM rows",
    "surrogate_key": f"""{_RAW} SELECT title, row_number() OVER (ORDER BY title) AS title_id
FROM (SELECT DISTINCT title FROM raw WHERE title IS NOT NULL)""",
    "lookup_keys": f"{_CLEAN}, {_DIMS} SELECT doc_id, company, company_id FROM raw LEFT JOIN companies ON company = company_name",
    "fact_jobs": f"""{_CLEAN}, {_DIMS} SELECT job_id, company_id, location_id, title AS job_title,
  {sq.strip('lower(title)')} AS job_title_normalized, coalesce(description, '') AS description,
  CAST(length(coalesce(description, '')) AS INTEGER) AS description_length,
  strftime(CAST(publish_date AS TIMESTAMP), '%Y-%m-%d') AS publish_date,
  strftime(CAST(scrape_date AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS scrape_date, source, url,
  {_AGE.format('publish_date')} AS job_posting_days_old
FROM cleaned LEFT JOIN companies ON coalesce({sq.strip('company')}, 'Unknown') = company_name
LEFT JOIN locations ON coalesce({sq.strip('location')}, 'Unknown') = location_name""",
    "fact_job_skills": f"""{_ROWS}, dim AS (SELECT row_number() OVER (ORDER BY skill_name) AS skill_id, skill_name
  FROM (SELECT DISTINCT skill_name FROM rows))
SELECT job_id, skill_id, 1 AS mentioned_count, extraction_method AS extracted_method,
  CASE WHEN rows.skill_name = 'the' THEN CAST(0.5 AS DOUBLE) ELSE confidence_score END AS confidence_score,
  CASE WHEN rows.skill_name = 'with' THEN -1 ELSE position_in_description END AS position_in_description
FROM rows JOIN dim ON rows.skill_name = dim.skill_name""",
    "dim_time": _time(),
    "check_constraints": _checks(),
    "dim_sources": """SELECT row_number() OVER (ORDER BY source) AS source_id, source AS source_name,
  CAST(NULL AS VARCHAR) AS source_type, CAST(NULL AS VARCHAR) AS base_url FROM (SELECT DISTINCT source FROM documents)""",
    "extended_fact": _normalized_sql(),
}
