"""Rejects of files, counters of runs, anchors of a large lexicon, vectors of texts, levels of candidates."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F, types as T

from vacantia import schemas
from vacantia.functions import lexicon as lx
from vacantia.operators import clean as cl
from vacantia.operators import normalize as nz
from vacantia.operators import recommend as rc
from vacantia.operators import skills as sk
from vacantia.operators import textvectors as tv
from vacantia.sources import files, runs

KINDS = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("b", T.StringType())])


def test_every_line_is_a_row_or_a_reject(spark, tmp_path):
    (tmp_path / "one.csv").write_text('a,n,b\n1,2,x\n2,3\n3,4,y,5\n"4",5,"two\nlines ""q"""\n5,many,z\n,,\n6,"7,un\n8,9,closed\n')
    (tmp_path / "two.csv").write_text('a,n,b\n1,2,x\n9,1,"open\n8,2,w\n')
    good, bad = files.read_csv_checked(spark, str(tmp_path), KINDS)
    rows = sorted((tuple(r) for r in good.collect()), key=repr)
    assert rows == sorted([("1", 2, "x"), ("1", 2, "x"), ("4", 5, 'two\nlines "q"'), (None, None, None)], key=repr)
    rejects = {(r["file"], r["reason"], r["n_lines"]) for r in bad.collect()}
    assert rejects == {("one.csv", "short", 1), ("one.csv", "long", 1), ("one.csv", "type", 1), ("one.csv", "unclosed", 2), ("two.csv", "unclosed", 2)}
    lines = 1 + 2 + 1 + 1  # of the good rows
    assert lines + sum(n for _, _, n in rejects) == 8 + 4 - 2 + 2  # all lines but the headers


def test_checked_raw_jobs(spark, tmp_path):
    head = ",".join(schemas.CLEAN_COLUMNS)
    (tmp_path / "a.csv").write_text(f"{head}\n1,t,c,l,u,d,p,s,z\nshort,row\n")
    (tmp_path / "b.csv").write_text(",".join(c for c in schemas.CLEAN_COLUMNS if c != "publish_date") + "\n1,t,c,l,u,d,s,z\n1,t,c,l,u,d,s,z,more\n")
    one, two, bad = files.read_raw_jobs_checked(spark, str(tmp_path / "a.csv"), str(tmp_path / "b.csv"))
    assert one.count() == two.count() == 1 and sorted(r["reason"] for r in bad.collect()) == ["long", "short"]


def frames(spark):
    rows = [("1", "T", "A", "x", "u1", "d", "2024", "s", "z"), ("2", "T", "A", "x", "u2", "d", "2024", "s", "z"), ("3", "V", "A", "x", "u1", "d", None, "s", "z")]
    df = spark.createDataFrame(rows, schemas.JOBS_CLEANED)
    return [df, df.drop("publish_date").limit(1)]


def test_counts_of_a_run_equal_counts_of_passes(spark, tmp_path):
    parts = frames(spark)
    stored, report = runs.write_clean_jobs(parts, str(tmp_path / "clean"))
    want = cl.dedupe_report(parts, cl.clean_jobs(parts)).first()
    got = report.first()
    assert (got["rows_in"], got["rows_out"], got["rows_removed"]) == tuple(want) and got["rows_after_url"] == 2
    assert sorted(map(tuple, stored.collect()), key=repr) == sorted(map(tuple, cl.clean_jobs(parts).collect()), key=repr)
    records = spark.createDataFrame(
        [(1, "Data Engineer", "d" * 9, "k1", ["sql"]), (2, "x", "", "k2", ["a"]), (3, "y", "e", "k3", ["a", None]), (4, "y", "e", "k1", None)],
        "at int, job_title string, job_description string, external_job_id string, skills array<string>").withColumn("job_url", F.lit("u"))
    stored, report = runs.write_normalized(records, ["at"], str(tmp_path / "normal"))
    assert report.first().asDict() == nz.normalize_report(records, ["at"]).first().asDict()
    assert stored.count() == report.first()["valid_rows"]


def test_one_bad_source_does_not_stop_the_others(spark, tmp_path):
    df = spark.createDataFrame([(1, True), (2, None), (3, False)], "n int, ok boolean")
    sources = {
        "a": lambda: df, "gone": lambda: spark.read.parquet(str(tmp_path / "nothing")), "none": lambda: df.filter("NOT ok"),
        "late": lambda: df.withColumn("n", F.raise_error(F.lit("broken page"))), "empty": lambda: df.limit(0),
    }
    stored, log = runs.ingest(spark, sources, F.col("ok"), str(tmp_path / "out"))
    got = {r["source_name"]: (r["status"], r["jobs_count"], r["errors_count"], r["error_message"]) for r in log.collect()}
    late = got.pop("late")
    assert got == {
        "a": ("success", 1, 2, "2 of 3 rows were rejected"), "gone": ("error", 0, 1, "PATH_NOT_FOUND"),
        "none": ("error", 0, 1, "1 of 1 rows were rejected"), "empty": ("success", 0, 0, None)}
    assert late[:3] == ("error", 0, 1) and late[3]
    assert {k: v.count() for k, v in stored.items()} == {"a": 1, "none": 0, "empty": 0}
    assert all(r["started_at"] <= r["ended_at"] for r in log.collect())


# --- A large lexicon -------------------------------------------------------------------------

@pytest.mark.parametrize("alias,right,want", [
    ("data engineer", True, ["data", "engineer"]), ("data engineer", False, ["data"]), (r"machine\s+learning\b", False, ["machine", "learning"]),
    (r"c\+\+", True, ["c"]), ("python", False, ["python"]), (r"(?:x|y)", True, []), ("ci/cd", True, ["ci", "cd"]),
])
def test_words_that_an_alias_needs(alias, right, want):
    assert lx.whole_tokens(alias, right) == want


def test_rarest_anchors_do_not_change_the_answer(spark, monkeypatch):
    aliases = {f"s{i}": [f"data w{i}", f"v{i}"] for i in range(400)} | {f"t{i}": [f"u{i % 50} of{i}"] for i in range(200)} | {"bare": ["data"]}
    texts = [("%d" % i, f"data w{i % 7} and data w{i}, v{i * 3} of u{i % 50} of{i}.") for i in range(120)] + [(None, "data"), ("x", None), ("y", "data\nw3")]
    jobs = spark.createDataFrame(texts, "job_id string, description string")
    assert len(aliases) > sk.INLINE_SKILLS
    joined = sk.match_lexicon(jobs, aliases)
    rows = sorted(map(tuple, joined.collect()), key=repr)
    monkeypatch.setattr(sk, "INLINE_SKILLS", 10_000)
    literal = sorted(map(tuple, sk.match_lexicon(jobs, aliases).collect()), key=repr)
    assert rows == literal and len(literal) > 300
    low = jobs.filter("description IS NOT NULL").select("job_id", F.lower("description").alias("low"))
    anchors = {r["skill"]: r["anchor"] for r in sk.rarest_anchors(low, sk.lexicon_rows(aliases), sk.lexicon_words(aliases)).filter("alias_no = 0").collect()}
    assert anchors["bare"] == "data" and sum(a == "data" for a in anchors.values()) == 1  # the common first word is nobody else's anchor


# --- Vectors of texts ------------------------------------------------------------------------

def test_text_vectors_against_plain_python(spark):
    import hashlib
    import re

    texts = ["Data data engineer", "engineer of DATA", "", None, "été 2024_x", "data " * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, description string")
    bucket = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % tv.DIMENSIONS
    counts = []
    for t in texts:
        own: dict = {}
        for w in re.findall(r"\w+", (t or "").lower()):
            own[bucket(w)] = own.get(bucket(w), 0) + 1
        counts.append(own)
    idf = {b: math.log((len(texts) + 1) / (sum(b in c for c in counts) + 1)) for c in counts for b in c}
    rows = {r["i"]: r["embedding"] for r in tv.text_vectors(df).collect()}
    for i, own in enumerate(counts):
        raw = {b: n * idf[b] for b, n in own.items()}
        length = math.sqrt(sum(v * v for v in raw.values()))
        got = {b: v for b, v in enumerate(rows[i]) if v}
        assert got.keys() == {b for b, v in raw.items() if v} and len(rows[i]) == tv.DIMENSIONS
        assert all(abs(v - raw[b] / length) < 1e-6 for b, v in got.items())
    assert tv.text_vectors(df.limit(0)).count() == 0


def test_levels_follow_the_most_years(spark):
    skills = spark.createDataFrame(
        [(1, 1, "junior", 2), (1, 1, "expert", 5), (1, 2, None, None), (1, 3, "regular", None), (2, 9, "x", 1)],
        "candidate_id int, skill_id int, proficiency_level string, years_of_experience int")
    dim = spark.createDataFrame([(1, "sql"), (2, "go"), (3, "sql")], "skill_id int, skill_name string")
    profiles = spark.createDataFrame([(1, "n", "t", 3), (2, "m", "t", None)], "id int, candidate_name string, target_job_title string, years_experience int")
    got = {r["candidate_id"]: r for r in rc.candidates_from_model(profiles, skills, dim).collect()}
    assert [tuple(e) for e in got[1]["skill_levels"]] == [("go", None, None), ("sql", "expert", 5)] and got[1]["skills"] == ["go", "sql"]
    assert got[2]["skills"] == [] and got[2]["skill_levels"] == []
    bare = rc.candidates_from_model(profiles, skills.select("candidate_id", "skill_id"), dim)
    assert {r["candidate_id"]: r["skills"] for r in bare.collect()} == {1: ["go", "sql"], 2: []}
