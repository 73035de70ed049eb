"""Loads that break, repeat and clash; versions of rows against a plain model."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from vacantia import schemas
from vacantia.operators import versions as vs
from vacantia.operators import warehouse as wh
from vacantia.plans import views
from vacantia.sources.mart import LoadRejected, Mart, load_extended, load_star, month_of



def as_of():
    return F.lit("2024-02-01").cast("timestamp")


def jobs(spark, *rows):
    full = [(i, "T", c, p, f"u{i}", "text", d, "src", "2024-01-31T10:00:00") for i, c, p, d in rows]
    return spark.createDataFrame(full, schemas.JOBS_CLEANED)


def links(spark, *rows):
    return spark.createDataFrame([(j, s, "DE", 1.0, 3, "regex") for j, s in rows], schemas.JOB_SKILLS)


def mart(spark, path, tables=schemas.STAR, **options):
    return Mart(spark, f"t_{uuid.uuid4().hex}", str(path), tables, **options)


def state(m):
    """All published rows without load times."""
    return {n: sorted((tuple(r) for r in df.drop("created_at", "updated_at").collect()), key=repr) for n, df in m.tables_at().items()}


FIRST = [("1", "Acme", "x", "2024-01-01"), ("2", None, "y", "2024-01-20")]
MORE = [*FIRST, ("3", "Beta", "x", "2023-12-05"), ("4", "Beta", "z", None)]


def test_a_broken_load_shows_nothing_and_its_rerun_equals_a_clean_one(spark, tmp_path, monkeypatch):
    one, two = jobs(spark, *FIRST), jobs(spark, *MORE)
    skills, all_skills = links(spark, ("1", "sql")), links(spark, ("1", "sql"), ("3", "spark"), ("4", "sql"))
    clean = mart(spark, tmp_path / "clean", months={"fact_jobs": "publish_date"})
    assert load_star(clean, one, skills, as_of(), "a") and load_star(clean, two, all_skills, as_of(), "b")
    m = mart(spark, tmp_path / "broken", months={"fact_jobs": "publish_date"})
    load_star(m, one, skills, as_of(), "a")
    old = state(m)
    write = Mart.write
    for broken in ("dim_companies", "dim_locations", "dim_skills", "fact_jobs", "fact_job_skills"):
        def stop(self, table, rows, load, at=None):
            write(self, table, rows, load, at)
            if table == broken:
                raise RuntimeError("lost")

        monkeypatch.setattr(Mart, "write", stop)
        with pytest.raises(RuntimeError):
            load_star(m, two, all_skills, as_of(), "b")
        assert state(m) == old and spark.table(f"{m.database}.fact_jobs").count() == 2, broken
    monkeypatch.setattr(Mart, "write", write)
    monkeypatch.setattr(Mart, "publish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        load_star(m, two, all_skills, as_of(), "b")
    monkeypatch.undo()
    assert state(m) == old
    assert load_star(m, two, all_skills, as_of(), "b") and state(m) == state(clean)
    for n in schemas.STAR:  # the views show what the reader shows
        assert spark.table(f"{m.database}.{n}").count() == m.read(n).count()
    assert load_star(m, two, all_skills, as_of(), "b") is False and state(m) == state(clean)
    gone = m.vacuum()
    assert len([g for g in gone if g.startswith("dim_companies")]) == 6 and state(m) == state(clean)
    m.compact("whole")
    assert state(m) == state(clean) and len(m.published()) == 1 and m.begin("a") is None
    m.vacuum()
    assert state(m) == state(clean) and spark.table(f"{m.database}.fact_jobs").count() == 4


def test_rows_that_break_keys_are_not_published(spark, tmp_path):
    m = mart(spark, tmp_path)
    members = spark.createDataFrame([(1, "a"), (1, "b")], "company_id long, company_name string")
    with pytest.raises(LoadRejected, match="primary key dim_companies"):
        m.append("dim_companies", members, "x")
    assert m.read("dim_companies").count() == 0
    assert m.append("dim_companies", members.filter("company_name = 'a'"), "x")
    with pytest.raises(LoadRejected):  # clashes with what is published
        m.append("dim_companies", members.filter("company_name = 'b'"), "y")
    assert m.append("dim_companies", members, "x") is False and m.read("dim_companies").count() == 1
    with pytest.raises(ValueError):
        m.begin("no/slash")


def test_months_are_partitions_and_prune(spark, tmp_path):
    m = mart(spark, tmp_path, months={"fact_jobs": "publish_date"}, buckets=2)
    load_star(m, jobs(spark, *MORE), links(spark, ("1", "sql")), as_of(), "a")
    stored = m.read("fact_jobs")
    assert sorted(r[0] or "" for r in stored.select("publish_month").distinct().collect()) == ["", "2023-12", "2024-01"]
    assert len(stored.filter("publish_month = '2024-01'").inputFiles()) < len(stored.inputFiles())
    star = views.Star(m.read("dim_companies"), m.read("dim_locations"), m.read("dim_skills"), stored, m.read("fact_job_skills"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = views.vw_trending_skills(star, F.lit("2024-02-01").cast("date"))._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert any("publish_month" in part.split("]")[0] and ">= 2024-01" in part for part in plan.split("PartitionFilters: [")[1:])
    assert [r["skill_name"] for r in views.vw_trending_skills(star, F.lit("2024-01-05").cast("date")).collect()] == ["sql"]


# --- Versions --------------------------------------------------------------------------------

def test_versions_against_a_plain_model(spark):
    kinds = "k string, a int, b string"
    states = [
        [("x", 1, None), ("y", 2, ""), ("z", 3, "c")], [("x", 1, ""), ("z", 3, "c"), ("n", None, None)],
        [("x", 1, ""), ("z", 3, "c"), ("n", None, None)], [], [("y", 2, ""), ("x", 7, "q"), ("x", 7, "q")],
    ]
    log = spark.createDataFrame([], kinds + ", row_digest string, change string, is_active boolean, created_at int, updated_at int, load_no long")
    model: dict = {}
    for t, rows in enumerate(states):
        new = vs.changed_rows(log, spark.createDataFrame(rows, kinds), ["k"], ["a", "b"], F.lit(t), F.lit(t))
        seen, want = {r[0]: r[1:] for r in rows}, []
        for k in sorted(seen.keys() | model.keys()):
            old = model.get(k)
            if old is None:
                entry = (seen[k], "new", True, t)
            elif k not in seen:
                entry = (old[0], "closed", False, old[3]) if old[2] else None
            elif not old[2]:
                entry = (seen[k], "reopened", True, old[3])
            else:
                entry = (seen[k], "changed", True, old[3]) if old[0] != seen[k] else None
            if entry:
                model[k] = entry
                want.append((k, *entry[0], *entry[1:], t, t))
        got = [(r["k"], r["a"], r["b"], r["change"], r["is_active"], r["created_at"], r["updated_at"], r["load_no"]) for r in new.collect()]
        assert sorted(got) == sorted(want), t
        log = log.unionByName(spark.createDataFrame(new.collect(), log.schema)) if got else log
    assert len(vs.latest(log, ["k"]).collect()) == len(model)


def test_members_take_the_first_value_they_have(spark):
    rows = [("a", None, 2, 1), ("a", "u", None, 2), ("a", "v", 5, 3), (None, "w", 1, 0), ("b", None, None, 1)]
    got = vs.described(spark.createDataFrame(rows, "n string, url string, size int, at int"), "n", {"url": "url", "size": "size"}, ["at"])
    assert sorted(map(tuple, got.collect())) == [("a", "u", 2), ("b", None, None)]


def test_extended_model_over_changing_records(spark, tmp_path):
    def records(*rows):
        return spark.createDataFrame(
            [(i, t, "d", c, "Rabat", u, s, 10.0, "2024-01-01", u2) for i, t, c, u, s, u2 in rows],
            "external_job_id string, job_title string, job_description string, company_name string, location string, job_url string, "
            "source string, salary_min double, published_at string, company_url string",
        ).withColumn("published_at", F.to_date("published_at"))

    m = mart(spark, tmp_path, schemas.EXTENDED)
    at = lambda d: F.lit(f"2024-03-0{d}").cast("timestamp")
    one = records(("1", "T", "Acme", "u1", "s", "http://a"), (None, "T", None, "u2", "s", None), (None, "T", "Beta", None, None, None))
    two = records(("1", "T2", "Acme", "u1", "s", "http://b"), (None, "T", "Beta", None, None, None), ("", "N", "Acme", "u9", "q", None))
    assert load_extended(m, one, at(1), "a") and load_extended(m, one, at(2), "b")
    assert m.read("jobs").count() == 3 and m.read("companies").count() == 2  # the same again adds nothing
    load_extended(m, two, at(3), "c")
    now = {r["job_key"][:4]: (r["job_title"], r["change"], r["is_active"], str(r["updated_at"])[:10])
           for r in vs.latest(m.read("jobs"), ["job_key"]).collect()}
    assert now == {"id:1": ("T2", "changed", True, "2024-03-03"), "url:": now["url:"], "row:": ("T", "new", True, "2024-03-01")}
    by_url = {r["job_key"]: (r["change"], r["is_active"]) for r in vs.latest(m.read("jobs"), ["job_key"]).collect() if r["job_key"][:3] == "url"}
    assert by_url == {"url:u2": ("closed", False), "url:u9": ("new", True)}
    companies = {r["company_name"]: (r["company_id"], r["company_url"], str(r["created_at"])[:10]) for r in vs.latest(m.read("companies"), ["company_name"]).collect()}
    assert companies == {"Acme": (1, "http://b", "2024-03-01"), "Beta": (2, None, "2024-03-01")}
    assert {r["source_name"]: r["source_id"] for r in m.read("sources").collect()} == {"s": 1, "q": 2}
    assert load_extended(m, one, at(4), "c") is False
    counts = {(r["table_name"], r["load_no"], r["change"]): r["n"] for r in vs.change_counts({"jobs": m.read("jobs")}).collect()}
    assert counts == {("jobs", 1, "new"): 3, ("jobs", 3, "changed"): 1, ("jobs", 3, "closed"): 1, ("jobs", 3, "new"): 1}


def test_check_of_the_whole_star_after_a_load(spark, tmp_path):
    m = mart(spark, tmp_path)
    load_star(m, jobs(spark, *MORE), links(spark, ("1", "sql")), as_of(), "a")
    assert wh.check_constraints({n: df for n, df in m.tables_at().items() if n != "dim_time"}).filter("violations > 0").count() == 0
    assert spark.range(1).select(month_of(F.lit(None).cast("date")).alias("m")).first()["m"] is None


def test_views_from_partials_of_two_loads(spark, tmp_path):
    """Equal to the views over all rows, without reading a fact; keys far apart and negative, nulls in every column."""
    from dataclasses import replace

    from vacantia.plans import partials as pt

    companies = spark.createDataFrame([(i, f"c{i}", "i", "k") for i in (1, 2, 40000)], "company_id long, company_name string, industry string, country string")
    places = spark.createDataFrame(
        [(1, "x", "m", None), (2, "x", "m", None), (3, "y", None, "k")], "location_id long, location_name string, country string, region string")
    skills = spark.createDataFrame([(1, "sql", "a"), (2, "spark", "b"), (70000, "java", "b"), (9, None, None)], "skill_id long, skill_name string, skill_category string")
    rows = [
        (1, 1, 1, "s", "2024-01-01", 5), (-3, 1, 2, None, None, None), (32768, 2, 3, "t", "2023-01-01", 7), (32769, 77, None, "s", "2024-02-01", 9),
        (10**9, None, 1, "t", "2024-03-01", 11), (5, 40000, 2, "u", "2022-03-01", 100),
    ]
    jobs = spark.createDataFrame([(*r, r[4] and r[4] + " 01:00:00") for r in rows],
                                 "job_id long, company_id long, location_id long, source string, publish_date string, job_posting_days_old int, scrape_date string")
    jobs = jobs.withColumn("publish_date", F.to_date("publish_date"))
    links = spark.createDataFrame(
        [(1, 1, 50), (1, 2, 70), (-3, 1, None), (32768, 70000, 10), (32768, 1, 20), (32769, None, 5), (10**9, 2, 1), (1, 1, 60)],
        "job_id long, skill_id long, confidence_score int")
    whole = views.Star(companies, places, skills, jobs, links)
    m = mart(spark, tmp_path, {"partials": pt.PARTIALS})
    for batch, part in (("a", F.col("job_id") < 6), ("b", F.col("job_id") >= 6)):
        of = jobs.filter(part)
        load = replace(whole, jobs=of, links=links.join(of.select("job_id"), "job_id", "left_semi"))
        assert m.append("partials", pt.partials_of(load), batch) and not m.append("partials", pt.partials_of(load), batch)
    p = m.read("partials")
    pairs = [
        (pt.skills_demand(p, skills), views.vw_skills_demand(whole)), (pt.company_opportunities(p, companies), views.vw_company_opportunities(whole)),
        (pt.regional_analysis(p, places), views.vw_regional_analysis(whole)), (pt.market_overview_v1(p, skills), views.vw_market_overview_v1(whole)),
    ]
    for got, want in pairs:
        assert got.columns == want.columns
        plain = lambda df: sorted((tuple(str(v) for v in r) for r in df.collect()))
        assert plain(got) == plain(want)
    none = replace(whole, jobs=jobs.limit(0), links=links.limit(0))
    assert pt.market_overview_v1(pt.partials_of(none), skills).first()["total_jobs"] == 0
    with pytest.raises(ValueError):
        pt.partials_of(replace(whole, jobs=jobs.filter("job_id > 5")))


def test_partials_read_links_once(spark):
    """What a load adds is computed from rows that were written once, not from the links again for every grouping."""
    from vacantia.plans import partials as pt

    jobs = spark.createDataFrame(
        [(1, 1, 1, "a", None, None, 3)],
        "job_id long, company_id long, location_id long, source string, publish_date date, scrape_date date, job_posting_days_old int")
    read = spark.sparkContext.accumulator(0)

    def counted(row):
        read.add(1)
        return row

    links = spark.createDataFrame(
        spark.sparkContext.parallelize([(1, 7, 0.5), (1, 8, None)], 1).map(counted), "job_id long, skill_id long, confidence_score double")
    companies = spark.createDataFrame([(1,)], "company_id long")
    skills = spark.createDataFrame([(7, "x"), (8, "y")], "skill_id long, skill_name string")
    rows = pt.partials_of(views.Star(companies, None, skills, jobs, links)).collect()
    assert read.value == 2
    assert {(r["key"], r["score_sum"], r["score_n"]) for r in rows if r["grouped"] == "skill" and r["kind"] == ""} == {(7, 0.5, 1), (8, None, 0)}
    assert [(r["age_sum"], r["age_n"]) for r in rows if r["grouped"] == "company" and r["kind"] == ""] == [(6, 2)]


def test_open_postings_read_items_once(spark, tmp_path):
    from vacantia.plans.standin import TABLES, open_postings

    rows = {
        "region": [(0, "r")], "nation": [(1, "n", 0)], "customer": [(5, "c", 1, 0.0, "m")],
        "orders": "SELECT CAST(o AS BIGINT), CAST(c AS BIGINT), 'F', 1.0D, timestamp_ntz'1997-01-01 00:00:00', 'p' FROM VALUES (1, 5), (2, 5), (3, NULL), (4, 9) t(o, c)",
        "lineitem": "SELECT CAST(o AS BIGINT), 1L, 1L, 1, 1.0D, CAST(x AS DOUBLE), 0.0D, 0.0D, 'r', 's', timestamp_ntz'1999-01-01 00:00:00' "
                    "FROM VALUES (1, 3), (1, 2), (2, 4), (3, 1), (4, 1) t(o, x)",
    }
    for name, made in rows.items():
        df = spark.sql(made) if isinstance(made, str) else spark.createDataFrame(made, TABLES[name])
        names = [c.split()[0] for c in TABLES[name].split(", ")]
        df.toDF(*names).write.parquet(f"{tmp_path}/{name}.parquet")
    found = open_postings(spark, str(tmp_path), "1998-01-01")
    assert "l_extendedprice" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r["external_job_id"], r["company_size"], r["salary_min"], r["salary_max"]) for r in found.collect())
    assert got == [("1", "small", 2.0, 3.0), ("2", "small", 4.0, 4.0)]
