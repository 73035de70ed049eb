import datetime
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from vacantia import session
from vacantia.plans import dashboards as db, standin, views as vw
from vacantia.plans.views import Star

AS_OF = datetime.date(2024, 3, 31)


def make(spark, jobs, links, skills=((1, "sql", "L"), (2, "spark", "E"), (3, "git", None))):
    rows = [(j, c, p, t, age, AS_OF - datetime.timedelta(days=age) if age is not None else None, s, n)
            for j, c, p, t, age, s, n in jobs]
    facts = spark.createDataFrame(rows, "job_id string, company_id long, location_id long, job_title_normalized string, "
                                  "job_posting_days_old int, publish_date date, source string, description_length int")
    facts = facts.withColumns({
        "job_title": F.col("job_title_normalized"), "description": F.lit("d"), "url": F.lit("u"),
        "scrape_date": F.col("publish_date"),
    })
    return Star(
        spark.createDataFrame([(1, "Acme", "IT", None), (2, "Beta", "IT", "MA")],
                              "company_id long, company_name string, industry string, country string"),
        spark.createDataFrame([(1, "Rabat", "MA", None), (2, "Paris", None, "IdF")],
                              "location_id long, location_name string, country string, region string"),
        spark.createDataFrame(list(skills), "skill_id long, skill_name string, skill_category string"),
        facts,
        spark.createDataFrame(list(links), "job_id string, skill_id long, confidence_score double"),
    )


@pytest.fixture(scope="module")
def small(spark):
    jobs = [("A", 1, 1, "dev", 10, "x", 100), ("B", 1, 2, "dev", 20, "y", 200), ("C", 2, 1, None, 31, "x", 50), ("D", 9, 9, "ops", None, "x", 10)]
    links = [("A", 1, 0.5), ("A", 2, 1.0), ("A", 3, 1.0), ("B", 1, 1.0), ("C", 2, 0.25)]
    return make(spark, jobs, links)


def rows(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_company_age_is_weighted_by_links(small):
    acme = rows(vw.vw_company_opportunities(small), "company_name")["Acme"]
    assert acme["avg_posting_age_days"] == 13.0  # (10 * 3 + 20) / 4
    assert acme["open_positions"] == 2 and acme["top_skills"] == "git, spark, sql" and acme["job_sources"] == "x, y"
    assert rows(vw.company_age_per_job(small), "company_name")["Acme"]["avg_posting_age_days"] == 15.0


def test_complexity_counts_joined_rows(small):
    got = rows(vw.vw_job_complexity(small), "job_title_normalized")
    assert got["dev"]["job_count"] == 4 and got["dev"]["avg_description_length"] == 125.0
    assert got["dev"]["complexity_score"] == 155.0 and got[None]["job_count"] == 1
    assert got["ops"]["total_unique_skills"] == 0 and got["ops"]["complexity_score"] == 10.0


def test_null_title_has_no_share(small):
    got = {(r["job_title_normalized"], r["skill_name"]): r["skill_relevance_pct"] for r in vw.vw_skill_specialization(small).collect()}
    assert got[(None, "spark")] is None and got[("dev", "sql")] == 100.0 and got[("dev", "git")] == 50.0


def test_window_edges(spark):
    star = make(spark, [("A", 1, 1, "t", 30, "x", 1), ("B", 1, 1, "t", 31, "x", 1), ("C", 1, 1, "t", 7, "x", 1)],
                [("A", 1, 1.0), ("B", 2, 1.0), ("C", 1, 0.0)])
    got = [r.asDict() for r in vw.vw_trending_skills(star, F.lit(AS_OF)).collect()]
    assert [(r["skill_name"], r["recent_jobs_30d"], r["recent_jobs_7d"], r["recent_avg_confidence"]) for r in got] == [("sql", 2, 1, 0.5)]


def test_empty_side_of_overview(spark, small):
    none = Star(small.companies, small.locations, small.skills.limit(0), small.jobs, small.links)
    row = vw.vw_market_overview_v1(none).first()
    assert (row["total_jobs"], row["unique_skills"], row["avg_posting_age_days"]) == (0, 0, None)
    row = vw.vw_market_overview_v1(small).first()
    assert (row["total_jobs"], row["unique_companies"], row["unique_skills"]) == (4, 3, 3)


def test_full_context_lists(small):
    got = rows(vw.vw_jobs_full_context(small), "job_id")
    assert got["D"]["required_skills"] == "" and got["D"]["required_skills_count"] == 0 and got["D"]["company_name"] is None
    assert got["A"]["required_skills"] == "git, spark, sql" and got["A"]["skill_categories"] == "E, L"


def test_regions_fill_names_after_grouping(small):
    got = rows(vw.vw_regional_analysis(small), "location_name")
    assert (got["Rabat"]["region"], got["Paris"]["country"]) == ("Unknown", "International")
    assert got["Rabat"]["job_count"] == 2 and got["Rabat"]["company_count"] == 2 and got["Rabat"]["unique_skills"] == 3


def test_demand_of_unused_skill(spark, small):
    star = Star(small.companies, small.locations, small.skills.union(spark.createDataFrame([(9, "cobol", "L")], small.skills.schema)),
                small.jobs, small.links)
    row = rows(vw.vw_skills_demand(star), "skill_name")["cobol"]
    assert (row["jobs_requiring_skill"], row["demand_percentage"], row["avg_confidence"], row["job_sources"]) == (0, 0.0, None, "")


def test_ties_are_kept(small):
    assert {r["skill_name"] for r in db.m_top_skill(small).collect()} == {"sql", "spark"}
    assert [r["job_title_normalized"] for r in db.m_most_common_title(small).collect()] == ["dev"]


def test_month_to_date(spark):
    star = make(spark, [("A", 1, 1, "t", 0, "x", 1), ("B", 1, 1, "t", 30, "x", 1), ("C", 1, 1, "t", 31, "x", 1)], [])
    assert db.m_jobs_this_month(star, F.lit(AS_OF)).first()["value"] == 2


def test_search_is_and_across_or_within(small):
    got = db.job_search(small, titles=["dev"], skills=["spark", "git"], companies=["Acme", "Beta"])
    assert [r["job_id"] for r in got.collect()] == ["A"]
    assert db.job_search(small).count() == 4


def test_hot_filters_reach_the_scan(spark, tmp_path, small):
    path = str(tmp_path / "jobs")
    small.jobs.write.parquet(path)
    star = Star(small.companies, small.locations, small.skills, spark.read.parquet(path), small.links)
    plan = vw.vw_trending_skills(star, F.lit(AS_OF))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(publish_date" in plan


def test_many_links_meet_by_job_in_parts_of_their_own(spark, small):
    many = [(f"J{i % 50}", i % 7, 0.5) for i in range(400)]
    jobs = [(f"J{i}", 1 + i % 2, 1, "dev", i, "x", 100) for i in range(50)]
    plain = make(spark, jobs, many)
    dealt = replace(plain, parts=lambda: 11)
    assert vw._pairs(dealt).rdd.getNumPartitions() == 11  # adaptive execution would merge what it made itself
    joined = vw._pairs(dealt).join(dealt.jobs.hint("merge").select("job_id", "source"), "job_id")
    assert joined.rdd.getNumPartitions() == 11
    for view in (vw.vw_skills_demand, vw.vw_skill_specialization, vw.vw_job_skills_aggregated,
                 lambda s: vw.vw_trending_skills(s, F.lit(AS_OF)), lambda s: db.role_top_skills(s, "dev")):
        assert sorted(map(str, view(dealt).collect())) == sorted(map(str, view(plain).collect()))


def test_parts_follow_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 10)
    assert [session.parts_of(spark, n) for n in (0, 40, 41, 1000)] == [None, None, 5, 100]
    for name in ("region", "nation", "customer", "part", "orders"):
        spark.createDataFrame([], standin.TABLES[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    lines = spark.range(130).selectExpr("id AS l_orderkey", "id AS l_partkey", "0.5D AS l_discount", "1 AS l_linenumber")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    assert standin.star(spark, str(tmp_path)).parts() == 13
