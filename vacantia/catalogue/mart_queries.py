"""Staged loads and versions of rows over states of the market on different days."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from vacantia import schemas
from vacantia.catalogue.star_queries import ORACLES as STAR_ORACLES
from vacantia.catalogue.star_queries import on_star
from vacantia.operators import clean as cl
from vacantia.operators import versions as vs
from vacantia.plans import dashboards as db
from vacantia.plans import partials as pt
from vacantia.plans import views as vw
from vacantia.plans.standin import AS_OF, RAW_SQL, as_of, boards, open_postings, open_postings_sql, star
from vacantia.session import scratch_path
from vacantia.sources.mart import Mart, load_extended

# Four loads: a first state, a later one, the later one again, and back to the first.
DAYS = ["1998-01-01", "2000-01-01", "2000-01-01", "1998-01-01"]
TIMES = ["2024-01-01 06:00:00", "2024-01-02 06:00:00", "2024-01-03 06:00:00", "2024-01-04 06:00:00"]


def _mart(spark, tables, **options):
    name = f"mart_{uuid.uuid4().hex}"
    return Mart(spark, name, scratch_path(spark, name), tables, **options)


def _extended(spark, sf_dir):
    """The wider model after all loads, every batch offered twice."""
    mart = _mart(spark, schemas.EXTENDED)
    states = {day: open_postings(spark, sf_dir, day) for day in dict.fromkeys(DAYS)}
    for i, (day, time) in enumerate(zip(DAYS, TIMES)):
        for _ in range(2):
            load_extended(mart, states[day], F.lit(time).cast("timestamp"), f"day-{i}")
    return mart


def _time(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


def _jobs(spark, sf_dir):
    at = _extended(spark, sf_dir).tables_at()
    now = vs.latest(at["jobs"], ["job_key"])
    for table, name, key in (("companies", "company_name", "company_id"), ("locations", "location_name", "location_id"),
                             ("sources", "source_name", "source_id")):
        now = now.join(vs.latest(at[table], [name]).select(key, name), key, "left")
    return now.select(
        "external_job_id", "job_title", "company_id", "company_name", "location_name", "source_name", "salary_min", "salary_max",
        "change", "is_active", _time("created_at"), _time("updated_at"))


def _companies(spark, sf_dir):
    log = _extended(spark, sf_dir).read("companies")
    return vs.latest(log, ["company_name"]).select(
        "company_id", "company_name", "company_url", "company_size", _time("created_at"), _time("updated_at"))


def _changes(spark, sf_dir):
    at = _extended(spark, sf_dir).tables_at()
    return vs.change_counts({n: at[n] for n in ("jobs", "companies", "locations", "sources")})


def _append_batches(spark, sf_dir):
    """Two boards as batches, each offered twice, after a load of the first that was never published."""
    mart = _mart(spark, {"postings": schemas.JOBS_CLEANED})
    for i, board in enumerate(cl.harmonize_columns(b) for b in boards(spark, sf_dir)):
        mart.write("postings", board, mart.begin(f"board-{i}"))
        for _ in range(2):
            mart.append("postings", board, f"board-{i}")
    return mart.read("postings")


def _stored_star(spark, sf_dir):
    """The stand-in star in a mart whose jobs are stored by month of publication."""
    mart = _mart(spark, schemas.STAR, months={"fact_jobs": "publish_date"})
    load = mart.begin("all")
    whole = star(spark, sf_dir)
    for name, rows in whole.tables().items():
        mart.write(name, rows, load)
    mart.publish("all", load)
    at = mart.tables_at()
    return vw.Star(
        at["dim_companies"], at["dim_locations"], at["dim_skills"], at["fact_jobs"], at["fact_job_skills"], whole.parts)


def _recent_listing(spark, sf_dir):
    return db.job_listing(_stored_star(spark, sf_dir), since=F.date_sub(as_of(), 60))


# Jobs published before this day are the first of two loads.
SECOND_LOAD = "1998-06-01"


def _partials(spark, sf_dir):
    """Partials of two loads, published one after the other."""
    whole = star(spark, sf_dir)
    mart = _mart(spark, {"partials": pt.PARTIALS})
    early = F.coalesce(F.col("publish_date") < F.lit(SECOND_LOAD).cast("date"), F.lit(False))
    for batch, part in (("early", early), ("late", ~early)):
        jobs = whole.jobs.filter(part)
        links = whole.links.join(jobs.select("job_id"), "job_id", "left_semi")
        mart.append("partials", pt.partials_of(replace(whole, jobs=jobs, links=links)), batch)
    return mart.read("partials"), whole


def _demand(spark, sf_dir):
    partials, s = _partials(spark, sf_dir)
    return pt.skills_demand(partials, s.skills)


def _opportunities(spark, sf_dir):
    partials, s = _partials(spark, sf_dir)
    return pt.company_opportunities(partials, s.companies)


def _regional(spark, sf_dir):
    partials, s = _partials(spark, sf_dir)
    return pt.regional_analysis(partials, s.locations)


def _overview_v1(spark, sf_dir):
    partials, s = _partials(spark, sf_dir)
    return pt.market_overview_v1(partials, s.skills).withColumn("last_scrape_date", F.col("last_scrape_date").cast("date"))


QUERIES = {
    "trending_skills_by_month": lambda s, d: vw.vw_trending_skills(_stored_star(s, d), as_of()),
    "m_jobs_this_month_by_month": lambda s, d: db.m_jobs_this_month(_stored_star(s, d), as_of()),
    "job_listing_recent": _recent_listing,
    "skills_demand_merged": _demand,
    "company_opportunities_merged": _opportunities,
    "regional_analysis_merged": _regional,
    "market_overview_v1_merged": _overview_v1,
    "append_batches": _append_batches,
    "extended_fact_versions": _jobs,
    "extended_companies": _companies,
    "extended_changes": _changes,
}


# ------------------------------------------------------------------- SQL twins

# The last load brings back the first state, so a value that differs between the two days moved twice.
_STATES = f"""WITH {open_postings_sql(DAYS[0], "one")}, {open_postings_sql(DAYS[1], "two")},
sized AS (SELECT company_name, max(company_url) AS company_url, max(s1) AS s1, max(s2) AS s2 FROM (
  SELECT company_name, company_url, company_size AS s1, NULL AS s2 FROM one UNION ALL
  SELECT company_name, company_url, NULL, company_size FROM two) GROUP BY company_name),
companies AS (
  SELECT *, row_number() OVER (ORDER BY s1 IS NULL, company_name) AS company_id,
    CASE WHEN s1 IS NULL OR s2 IS NULL OR s1 = s2 THEN false ELSE true END AS moved FROM sized),
keys AS (SELECT external_job_id, max(a) = 1 AS in_one, max(b) = 1 AS in_two FROM (
  SELECT external_job_id, 1 AS a, 0 AS b FROM one UNION ALL SELECT external_job_id, 0, 1 FROM two) GROUP BY 1),
jobs AS (
  SELECT k.*, coalesce(a.job_title, b.job_title) AS job_title, coalesce(a.company_name, b.company_name) AS company_name,
    coalesce(a.location, b.location) AS location_name, coalesce(a.source, b.source) AS source_name,
    CASE WHEN in_one THEN a.salary_min ELSE b.salary_min END AS salary_min,
    CASE WHEN in_one THEN a.salary_max ELSE b.salary_max END AS salary_max,
    in_one AND in_two AND (a.salary_min IS DISTINCT FROM b.salary_min OR a.salary_max IS DISTINCT FROM b.salary_max) AS moved
  FROM keys k LEFT JOIN one a USING (external_job_id) LEFT JOIN two b USING (external_job_id)),
places AS (SELECT location AS name, min(t) AS t FROM (SELECT location, 1 AS t FROM one UNION ALL SELECT location, 2 FROM two) GROUP BY 1),
boards AS (SELECT source AS name, min(t) AS t FROM (SELECT source, 1 AS t FROM one UNION ALL SELECT source, 2 FROM two) GROUP BY 1)"""


def _counted(table: str, load_no: int, change: str, source: str, where: str = "true") -> str:
    return f"""SELECT '{table}' AS table_name, CAST({load_no} AS BIGINT) AS load_no, '{change}' AS change, count(*) AS n
FROM {source} WHERE {where} HAVING count(*) > 0"""


ORACLES = {
    "trending_skills_by_month": STAR_ORACLES["vw_trending_skills"],
    "m_jobs_this_month_by_month": STAR_ORACLES["m_jobs_this_month"],
    "job_listing_recent": on_star(f"""SELECT job_title, company_name, location_name,
  (SELECT count(*) FROM fact_job_skills s WHERE s.job_id = j.job_id) AS required_skills_count, source, publish_date
FROM fact_jobs j LEFT JOIN dim_companies USING (company_id) LEFT JOIN dim_locations USING (location_id)
WHERE publish_date >= DATE '{AS_OF}' - INTERVAL 60 DAY"""),
    "skills_demand_merged": STAR_ORACLES["vw_skills_demand"],
    "company_opportunities_merged": STAR_ORACLES["vw_company_opportunities"],
    "regional_analysis_merged": STAR_ORACLES["vw_regional_analysis"],
    "market_overview_v1_merged": STAR_ORACLES["vw_market_overview_v1"],
    "append_batches": f"""WITH {RAW_SQL.strip()}
SELECT job_id, title, company, location, url, description, publish_date, source, scrape_date FROM raw""",
    "extended_fact_versions": f"""{_STATES}
SELECT external_job_id, job_title, company_id, company_name, location_name, source_name, salary_min, salary_max,
  CASE WHEN NOT in_one THEN 'closed' WHEN NOT in_two THEN 'reopened' WHEN jobs.moved THEN 'changed' ELSE 'new' END AS change,
  in_one AS is_active, CASE WHEN in_one THEN '{TIMES[0]}' ELSE '{TIMES[1]}' END AS created_at,
  CASE WHEN in_one AND in_two AND NOT jobs.moved THEN '{TIMES[0]}' ELSE '{TIMES[3]}' END AS updated_at
FROM jobs JOIN companies USING (company_name)""",
    "extended_companies": f"""{_STATES}
SELECT company_id, company_name, company_url, coalesce(s1, s2) AS company_size,
  CASE WHEN s1 IS NOT NULL THEN '{TIMES[0]}' ELSE '{TIMES[1]}' END AS created_at,
  CASE WHEN moved THEN '{TIMES[3]}' WHEN s1 IS NOT NULL THEN '{TIMES[0]}' ELSE '{TIMES[1]}' END AS updated_at FROM companies""",
    "extended_changes": f"{_STATES} " + " UNION ALL ".join([
        _counted("jobs", 1, "new", "jobs", "in_one"), _counted("jobs", 2, "new", "jobs", "NOT in_one"),
        _counted("jobs", 2, "closed", "jobs", "NOT in_two"), _counted("jobs", 2, "changed", "jobs", "moved"),
        _counted("jobs", 4, "closed", "jobs", "NOT in_one"), _counted("jobs", 4, "reopened", "jobs", "NOT in_two"),
        _counted("jobs", 4, "changed", "jobs", "moved"),
        _counted("companies", 1, "new", "companies", "s1 IS NOT NULL"), _counted("companies", 2, "new", "companies", "s1 IS NULL"),
        _counted("companies", 2, "changed", "companies", "moved"), _counted("companies", 4, "changed", "companies", "moved"),
        _counted("locations", 1, "new", "places", "t = 1"), _counted("locations", 2, "new", "places", "t = 2"),
        _counted("sources", 1, "new", "boards", "t = 1"), _counted("sources", 2, "new", "boards", "t = 2"),
    ]),
}
