import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from vacantia import schemas
from vacantia.operators import warehouse as wh
from vacantia.sources import files, tables
from vacantia.sources.audit import failed_source, ingestion_audit

NOW = F.lit


def jobs(spark, rows):
    full = [(i, t, c, l, f"u{i}", "text", p, "src", "2024-01-31T10:00:00") for i, t, c, l, p in rows]
    return spark.createDataFrame(full, schemas.JOBS_CLEANED)


def test_trim_before_distinct(spark):
    df = jobs(spark, [("1", "T", "Acme", "x", None), ("2", "T", "Acme ", "x", None), ("3", "T", "Unknown", None, None)])
    assert [r[0] for r in wh.dim_companies(df).collect()] == ["Acme"]
    assert sorted(r[0] for r in wh.dim_companies(df, keep_unknown=True).collect()) == ["Acme", "Unknown"]


def test_keys_continue_after_stored_ones(spark):
    stored = spark.createDataFrame([(5, "b")], "id long, name string")
    new = spark.createDataFrame([("c",), ("a",), ("b",)], "name string")
    got = {r["name"]: r["id"] for r in wh.surrogate_key(new, "id", "name", stored).collect()}
    assert got == {"a": 6, "c": 7}


def test_lookup_takes_the_largest_key(spark):
    dim = spark.createDataFrame([(1, "a"), (4, "a"), (2, "b")], "id long, name string")
    fact = spark.createDataFrame([("a",), ("z",)], "k string")
    assert {r["k"]: r["id"] for r in wh.lookup_keys(fact, dim, "name", "id", "k").collect()} == {"a": 4, "z": None}


def test_fact_fields(spark):
    df = jobs(spark, [("1", " Data Lead ", None, "Rabat", "3 days ago"), ("2", "T", "Acme ", None, "2024-01-30")])
    companies = spark.createDataFrame([(1, "Acme"), (2, "Unknown")], "company_id long, company_name string")
    places = spark.createDataFrame([(1, "Rabat"), (2, "Unknown")], "location_id long, location_name string")
    now = F.lit("2024-02-01 12:00:00").cast("timestamp")
    rows = {r["job_id"]: r for r in wh.fact_jobs(df, companies, places, now).collect()}
    assert rows["1"]["job_title_normalized"] == "data lead" and rows["1"]["company_id"] == 2
    assert rows["1"]["publish_date"] is None and rows["1"]["job_posting_days_old"] is None
    assert rows["2"]["company_id"] == 1 and rows["2"]["location_id"] == 2 and rows["2"]["job_posting_days_old"] == 2
    assert rows["2"]["scrape_date"] == "2024-01-31 10:00:00" and len(rows["2"]) == 12


def test_violations_are_counted(spark):
    t = {
        "dim_companies": spark.createDataFrame([(1, "a"), (1, "a")], "company_id long, company_name string"),
        "fact_jobs": spark.createDataFrame([("j", 1), ("j", 9), (None, None)], "job_id string, company_id long"),
    }
    got = {(r["check_name"], r["table_name"], r["columns"]): r["violations"] for r in wh.check_constraints(t).collect()}
    assert got[("primary key", "dim_companies", "company_id")] == 1
    assert got[("unique", "dim_companies", "company_name")] == 1
    assert got[("primary key", "fact_jobs", "job_id")] == 1
    assert got[("not null", "fact_jobs", "job_id")] == 1 and got[("not null", "fact_jobs", "company_id")] == 1
    assert got[("foreign key", "fact_jobs", "company_id")] == 1


def test_load_twice_then_more(spark, tmp_path):
    skills = spark.createDataFrame([("1", "spark", "DE", 1.0, 3, "regex"), ("2", "sql", "PL", 1.0, 0, "regex")], schemas.JOB_SKILLS)
    first = jobs(spark, [("1", "T", "Acme", "x", "2024-01-01"), ("2", "T", None, "y", "2024-01-01")])
    more = jobs(spark, [("1", "T", "Acme", "x", "2024-01-01"), ("3", "T", "Beta", "x", "2024-01-01")])
    database, now = f"t_{uuid.uuid4().hex}", F.lit("2024-02-01").cast("timestamp")

    def load(df):
        rows = tables.load_warehouse(spark, df, skills, database, str(tmp_path), now).collect()
        return {r["table_name"]: r["row_count"] for r in rows}

    want = {"dim_companies": 2, "dim_locations": 2, "dim_skills": 2, "fact_jobs": 2, "fact_job_skills": 2}
    assert load(first) == want and load(first) == want
    assert load(more) == {**want, "dim_companies": 3, "fact_jobs": 3}
    stored = {n: spark.table(f"{database}.{n}") for n in schemas.STAR if n not in ("dim_time",)}
    bad = wh.check_constraints(stored).filter("violations > 0").collect()
    assert bad == []
    assert tables.run_sql(spark, f"SELECT count(*) AS n FROM {database}.fact_jobs").first()["n"] == 3
    assert tables.run_sql(spark, f"CREATE DATABASE IF NOT EXISTS {database}") is True


def test_dry_run_checks_columns(spark, tmp_path):
    df = jobs(spark, [("1", "T", "A", "x", None)])
    skills = spark.createDataFrame([], schemas.JOB_SKILLS)
    now = F.lit("2024-02-01").cast("timestamp")
    assert tables.load_warehouse(spark, df, skills, "none", str(tmp_path), now, dry_run=True) is None
    with pytest.raises(ValueError):
        tables.load_warehouse(spark, df.drop("url"), skills, "none", str(tmp_path), now, dry_run=True)


def test_csv_round_trip(spark, tmp_path):
    rows = [("1", 'He said "hi", ok', None, " pad ", "u", "line one\nline two\r\nline\\three", "NA", "s", "é😀")]
    df = spark.createDataFrame(rows, schemas.JOBS_CLEANED)
    path = files.write_csv(df, str(tmp_path / "x"))
    got = tuple(files.read_clean_jobs(spark, path).first())
    assert got == rows[0][:6] + (None,) + rows[0][7:]
    absent = str(tmp_path / "absent")
    assert [df.count() for df in files.read_raw_jobs(spark, absent, absent)] == [0, 0]
    for read in (files.read_clean_jobs, files.read_job_skills):  # a mistyped path must not load nothing
        with pytest.raises(AnalysisException):
            read(spark, absent)


def test_api_payload(spark):
    payload = '["legal", {"position": "A", "tags": ["x", "y"], "company": "c"}, 3, {"url": "u", "tags": null}, [1]]'
    df = spark.createDataFrame([(payload,), ("[]",)], "payload string")
    rows = [tuple(r) for r in files.read_api_json(df).collect()]
    assert rows == [("A", "c", None, None, None, "x, y"), (None, None, None, "u", None, "")]


def test_audit(spark):
    df = spark.createDataFrame([("a", True), ("a", None), ("b", False)], "source string, ok boolean")
    log = failed_source(ingestion_audit(df, F.col("ok")), "c", "timeout", F.lit("2024-01-01").cast("timestamp"))
    got = {r["source_name"]: (r["status"], r["jobs_count"], r["errors_count"]) for r in log.collect()}
    assert got == {"a": ("success", 1, 1), "b": ("error", 0, 1), "c": ("error", 0, 1)}
    assert {r["source_name"]: r["error_message"] for r in log.collect()} == {
        "a": "1 of 2 rows were rejected", "b": "1 of 1 rows were rejected", "c": "timeout"}


def test_bucketed_facts_join_without_a_shuffle(spark, tmp_path):
    database = f"t_{uuid.uuid4().hex}"
    tables.create_star_schema(spark, database, str(tmp_path), buckets=4)
    rows = [(str(i), "T", "A", "x", "2024-01-01") for i in range(40)]
    df = jobs(spark, rows).select("job_id", F.col("title").alias("job_title"))
    for _ in range(2):
        tables.append_table(df, f"{database}.fact_jobs")
        tables.append_table(df.select("job_id", F.lit(1).alias("skill_id")), f"{database}.fact_job_skills")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table(f"{database}.fact_jobs").join(spark.table(f"{database}.fact_job_skills"), "job_id")
        assert joined.count() == 160
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
