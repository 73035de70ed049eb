"""Repeated and missing keys, tables loaded with repeats, page numbers shared by sources."""

from __future__ import annotations

import pytest

from vacantia.operators import extract as ex
from vacantia.operators import normalize as nz
from vacantia.operators import skills as sk
from vacantia.plans import views
from vacantia.sources import files, tables


def test_lexicon_size_does_not_change_the_answer(spark):
    jobs = spark.createDataFrame(
        [("x", "sql and python"), ("x", "sql"), (None, "python"), (None, "sql")], "job_id string, description string")
    few = {"sql": ["sql"], "python": ["python"]}
    many = few | {f"unused{i}": [f"unused{i}"] for i in range(sk.INLINE_SKILLS + 1)}
    one, two = (sorted(map(tuple, sk.match_lexicon(jobs, x).collect()), key=repr) for x in (few, many))
    assert one == two and len(one) == 5


def test_page_numbers_repeat_over_sources(spark):
    rows = [("a", 1), ("b", 1), ("a", 2), ("b", None)]
    out = ex.assign_job_id(spark.createDataFrame(rows, "source string, page_id long")).collect()
    assert sorted(r["job_id"] for r in out) == ["a_00001", "a_00002", "b_00001", "b_00002"]


def test_widths_of_vectors_must_agree(spark):
    one = spark.createDataFrame([("j", [1.0, 0.0])], "job_id string, embedding array<float>")
    two = spark.createDataFrame([("s", [1.0, 0.0]), ("t", [1.0])], "skill string, embedding array<float>")
    with pytest.raises(ValueError):
        sk.match_semantic(one, two)


def test_views_count_distinct_keys(spark):
    star = views.Star(
        spark.createDataFrame([(1, "C", "i", "k")], "company_id long, company_name string, industry string, country string"),
        spark.createDataFrame([(1, "Rabat", "r", "m"), (2, "Rabat", "r", "m")], "location_id long, location_name string, region string, country string"),
        spark.createDataFrame([(1, "sql", "db"), (2, "sql", "db")], "skill_id long, skill_name string, skill_category string"),
        spark.createDataFrame(
            [("j", 1, 1, "T", "t", "d", 1, "s", None, None, 4, "u"), ("k", 1, 2, "T", "t", "d", 1, "s", None, None, 6, "u")],
            "job_id string, company_id long, location_id long, job_title string, job_title_normalized string, description string, "
            "description_length int, source string, publish_date date, scrape_date string, job_posting_days_old int, url string"),
        spark.createDataFrame([("j", 1, 0.5), ("j", 1, 1.0), ("j", None, 0.3), ("k", 2, 1.0)], "job_id string, skill_id long, confidence_score double"),
    )
    context = {r["job_id"]: r for r in views.vw_jobs_full_context(star).collect()}
    assert context["j"]["required_skills_count"] == 1 and context["j"]["required_skills"] == "sql"
    assert [r["jobs_requiring_skill"] for r in views.vw_skills_demand(star).collect()] == [1, 1]
    region = views.vw_regional_analysis(star).collect()
    assert len(region) == 1 and region[0]["job_count"] == 2 and region[0]["unique_skills"] == 2
    special = views.vw_skill_specialization(star).collect()
    assert len(special) == 1 and special[0]["jobs_mentioning_skill"] == 2
    assert views.vw_job_skills_aggregated(star).filter("job_id = 'j'").first()["total_skills_required"] == 1


def test_records_without_skills_and_rejects(spark):
    rows = spark.createDataFrame([("t", "d" * 30, "e", "u")], "job_title string, job_description string, external_job_id string, job_url string")
    assert nz.drop_failed_rows(rows).count() == 1
    payloads = spark.createDataFrame([('[{"url": "x"}]',), ('[{"url"',), (None,)], "payload string")
    assert files.rejected_payloads(payloads).count() == 2


def test_query_behind_a_comment_gives_rows(spark):
    assert tables.run_sql(spark, "-- note\n/* more */ SELECT 1 AS n").first()["n"] == 1
    assert tables.run_sql(spark, "CREATE DATABASE IF NOT EXISTS behind_a_comment") is True
