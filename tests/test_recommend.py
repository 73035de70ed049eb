import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vacantia.operators import recommend as rc
from vacantia.operators import vectors as vc
from vacantia.session import stage

JOBS = "job_id string, title string, company string, location string, source string, description string, embedding array<float>"
CANDS = "name string, skills array<string>, experience string, interests string, embedding array<float>, location string"


def fixture(spark, n_jobs=300, n_candidates=9, seed=3):
    rng = random.Random(seed)
    words = ["python", "sql", "spark", "go", "r", "data", "ml", "etl", "aws"]
    vec = lambda: [rng.uniform(-1, 1) for _ in range(6)]
    jobs = [(f"j{i:04d}", "t", "c", rng.choice(["x", "y", None]), "s",
             None if i % 50 == 0 else " ".join(rng.choices(words, k=rng.randint(0, 6))).upper(),
             None if i % 17 == 0 else vec()) for i in range(n_jobs)]
    cands = [(f"c{i}", rng.sample(["Python", "SQL", "Spark", "Go", "R", "cobol"], rng.randint(0, 5)), "", None, vec(), "x")
             for i in range(n_candidates)]
    return jobs, cands


def cos(a, b):
    if a is None or b is None:
        return 0.0
    a, b = np.float32(a).astype(float), np.float32(b).astype(float)
    return float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))


def brute(jobs, cands, k):
    out = {}
    for name, skills, _, _, v, _ in cands:
        rows = []
        for job in jobs:
            text = (job[5] or "").lower()
            ratio = sum(s.lower() in text for s in skills) / len(skills) if skills else 0.0
            rows.append((job[0], ratio if ratio >= 0.3 else 0.0, (cos(v, job[6]) + 1) / 2))
        best = max(r[1] for r in rows)
        scored = [(0.6 * (s / best if best else s) + 0.4 * m, j) for j, s, m in rows]
        out[name] = [j for score, j in sorted(scored, key=lambda x: (-x[0], x[1])) if score > 0.1][:k]
    return out


def ranked(df):
    out = {}
    for r in df.orderBy("candidate_name", F.desc("combined_score"), "job_id").collect():
        assert 0 <= r["skill_match_score"] <= 1 and 0 <= r["semantic_similarity_score"] <= 1
        out.setdefault(r["candidate_name"], []).append(r["job_id"])
    return out


def test_match_candidates_equals_brute_force(spark):
    jobs, cands = fixture(spark)
    df = spark.createDataFrame(jobs, JOBS).repartition(7)
    got = ranked(rc.match_candidates(df, spark.createDataFrame(cands, CANDS)))
    assert got == brute(jobs, cands, 5)


@pytest.mark.parametrize("size,tile", [(1, 90), (4, 1000), (7, 40), (2000, 50)])
def test_blocks_and_batches_do_not_change_the_result(spark, monkeypatch, size, tile):
    jobs, cands = fixture(spark, seed=5)
    monkeypatch.setattr(vc.over_blocks, "__defaults__", (size, tile))
    monkeypatch.setattr(rc, "CELLS", 60)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        got = ranked(rc.match_candidates(spark.createDataFrame(jobs, JOBS), spark.createDataFrame(cands, CANDS)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute(jobs, cands, 5)


def test_one_profile(spark):
    jobs, cands = fixture(spark, seed=8)
    name, skills, _, _, v, _ = cands[0]
    got = rc.recommend_by_profile(spark.createDataFrame(jobs, JOBS), skills, v)
    assert [r["job_id"] for r in got.orderBy(F.desc("combined_score"), "job_id").collect()] == brute(jobs, cands[:1], 10)[name]
    assert got.columns == rc.JOB_FIELDS + ["skill_match_score", "semantic_similarity_score", "combined_score"]


def test_below_minimum_is_zero(spark):
    df = spark.createDataFrame([("only a here",)], "d string")
    skills = F.array(*[F.lit(s) for s in ("a", "bb", "cc", "dd")])
    assert df.select(rc.skill_score(F.col("d"), skills)).first()[0] == 0.0
    assert df.select(rc.skill_score(F.col("d"), skills, 0.25)).first()[0] == 0.25


def test_no_skill_anywhere_leaves_the_semantic_part(spark):
    jobs = [("j1", "t", "c", "x", "s", "nothing", [1.0, 0.0])]
    cands = [("c", ["zz"], "", "", [1.0, 0.0], "x")]
    row = rc.match_candidates(spark.createDataFrame(jobs, JOBS), spark.createDataFrame(cands, CANDS)).first()
    assert row["skill_match_score"] == 0.0 and abs(row["combined_score"] - 0.4) < 1e-9


def test_no_candidates_gives_no_rows(spark):
    jobs, cands = fixture(spark, 5)
    empty = spark.createDataFrame(cands, CANDS).limit(0)
    assert rc.match_candidates(spark.createDataFrame(jobs, JOBS), empty).count() == 0


def test_multi_factor(spark):
    jobs, cands = fixture(spark, seed=9)
    got = {}
    for r in rc.multi_factor_score(spark.createDataFrame(jobs, JOBS), spark.createDataFrame(cands, CANDS)).orderBy(
            "candidate_name", F.desc("match_score"), "job_id").collect():
        got.setdefault(r["candidate_name"], []).append(r["job_id"])
    for name, skills, _, _, v, place in cands:
        rows = []
        for job in jobs:
            text = (job[5] or "").lower()
            ratio = sum(s.lower() in text for s in skills) / len(skills) if skills else 0.0
            rows.append((0.5 * (cos(v, job[6]) + 1) / 2 + 0.3 * ratio + 0.2 * (job[3] == place), job[0]))
        assert got.get(name, []) == [j for s, j in sorted(rows, key=lambda x: (-x[0], x[1])) if s >= 0.5][:10]


def test_job_details(spark):
    row = ("j1", "t", "c", "l", "u", "d", "p", "s", "z")
    df = spark.createDataFrame([row], "job_id string, title string, company string, location string, url string, "
                               "description string, publish_date string, source string, scrape_date string")
    assert rc.job_details(df, "j1").count() == 1 and rc.job_details(df, "no").count() == 0


def test_weights_of_zero_and_repeated_names(spark):
    jobs = [("a", "t", "c", "x", "s", "", [0.0, 1.0]), ("b", "t", "c", "x", "s", "python", [0.0, 1.0])]
    cands = [("n", ["python"], "", None, [0.0, 1.0], "x"), ("n", ["sql"], "", None, [0.0, -1.0], "x")]
    frames = spark.createDataFrame(jobs, JOBS), spark.createDataFrame(cands, CANDS)
    only = {"semantic": 1.0, "skills": 0.0, "location": 0.0}
    rows = rc.multi_factor_score(*frames, weights=only, threshold=0.0, top_n=1).collect()
    assert [(r["job_id"], r["match_score"]) for r in sorted(rows, key=lambda r: -r["match_score"])] == [("a", 1.0), ("a", 0.0)]
    assert rc.match_candidates(*frames, top_k=2, min_skill_match=0.0).filter("semantic_similarity_score = 1").count() == 2


def test_both_sides_are_scanned_once(spark, monkeypatch, tmp_path):
    """More candidates than a block: one plan over written tables, no driver loop."""
    jobs, cands = fixture(spark, 60, 9)
    monkeypatch.setattr(vc.over_blocks, "__defaults__", (2, 25))
    seen = []
    monkeypatch.setattr(vc, "stage", lambda df, name="stage": seen.append(name) or stage(df, name))
    kernel = lambda block: (lambda batches: (b[["job_id"]].assign(n=len(block)) for b in batches))
    out = vc.over_blocks(spark.createDataFrame(jobs, JOBS), spark.createDataFrame(cands, CANDS), "name", kernel, "job_id string, n int")
    assert seen == ["rows"] and out._jdf.queryExecution().executedPlan().toString().count("FlatMapCoGroupsInPandas") == 1
    assert out.groupBy("job_id").agg(F.count("*").alias("c"), F.sum("n").alias("n")).select("c", "n").distinct().collect() == [(5, 9)]
