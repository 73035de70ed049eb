import random
import re

from vacantia.functions import lexicon as lx
from vacantia.operators import skills as sk

TEXT = "job_id string, description string"


def by_loop(text):
    """Plain regex loop over the lexicon."""
    found = {}
    low = text.lower()
    for skill, aliases in lx.SKILLS.items():
        for alias in aliases:
            hit = re.search(r"\b" + alias + r"\b", low, re.IGNORECASE)
            if hit:
                found[skill] = hit.start()
                break
    return found


def matched(spark, texts, fn=sk.match_lexicon, **kwargs):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], TEXT)
    out = [{} for _ in texts]
    for r in fn(df, **kwargs).collect():
        out[int(r["job_id"])][r["skill"]] = r["position"]
    return out


CASES = [
    "c++ dev", "c++11", "c# dev", "pyspark then spark", "javascript", "java", "github only", "git and github",
    "nodexjs here", "node.js", "", None, "😀 python", "Ünïcode-sql é r é", "power-bi / power   bi / powerbi",
    "machine \n learning", "ml", "html", "ci/cd", "scikit-learn", "go to excel", "écpython python3 py3",
    "K8S & S3; EC2", "SQL Server and mysql", "c#a", "ſql ſpark", "natural language processing",
]


def test_lexicon_has_the_declared_size():
    assert len(lx.SKILLS) == 78 and sum(len(v) for v in lx.TAXONOMY.values()) == 73 and len(lx.TAXONOMY) == 9
    no_head = [a for aliases in lx.SKILLS.values() for a in aliases if lx.head_token(a) is None]
    assert no_head == ["node.js"]


def test_match_equals_plain_loop(spark):
    assert matched(spark, CASES) == [by_loop(t or "") for t in CASES]


def test_match_equals_plain_loop_on_random_text(spark):
    rng = random.Random(7)
    words = [a.replace("\\", "") for aliases in lx.SKILLS.values() for a in aliases]
    filler = ["é", "dév", "x", "++", ".", "/", "-", "\n", "script", "hub", "11", "_", "😀", "ça"]
    texts = ["".join(rng.choice(words + filler) + rng.choice([" ", "", "  ", "."]) for _ in range(40)) for _ in range(150)]
    want = [by_loop(t) for t in texts]
    assert matched(spark, texts) == want
    rows = sk.lexicon_rows(lx.SKILLS)

    def joined(df):
        from pyspark.sql import functions as F
        return sk._match_by_join(df.select("job_id", sk._lowered(F.col("description")).alias("low")), rows)

    assert matched(spark, texts, joined) == want


def test_right_boundary_can_be_left_out(spark):
    assert "cpp" in matched(spark, ["c++ dev"], right_boundary=False)[0]


def test_sentences(spark):
    df = spark.createDataFrame([("1", "Short. This one is long enough!  twenty characters xx ?"), ("2", None)], TEXT)
    rows = sk.split_sentences(df).collect()
    assert [(r["sentence_no"], r["sentence"]) for r in rows] == [(1, " This one is long enough"), (2, "  twenty characters xx ")]


def test_semantic_and_merge(spark):
    sentences = spark.createDataFrame([("1", [1.0, 0.0]), ("1", [1.0, 1.0]), ("2", [0.0, -1.0]), ("3", None)],
                                      "job_id string, embedding array<float>")
    vectors = spark.createDataFrame([("spark", [1.0, 0.1]), ("sql", [0.0, 1.0])], "skill string, embedding array<float>")
    got = {(r["job_id"], r["skill"]): round(r["confidence"], 4) for r in sk.match_semantic(sentences, vectors).collect()}
    assert got == {("1", "spark"): 0.995, ("1", "sql"): 0.7071}
    jobs = spark.createDataFrame([("1", "We use Spark"), ("2", "x")], TEXT)
    semantic = sk.locate_skill(jobs, sk.match_semantic(sentences, vectors), vectors)
    lexical = sk.match_lexicon(jobs)
    merged = {r["skill"]: (round(r["confidence"], 4), r["position"]) for r in sk.merge_methods(lexical, semantic).collect()}
    assert merged == {"spark": (1.0, 7), "sql": (0.7071, -1)}
    rows = {r["skill_name"]: (r["extraction_method"], r["skill_category"])
            for r in sk.explode_job_skills(sk.merge_methods(lexical, semantic)).collect()}
    assert rows == {"spark": ("regex", "Data Engineering"), "sql": ("bert", "Programming Languages")}
    assert sk.merge_methods(lexical, semantic, "regex").count() == 1


def test_category_of_unlisted_skill(spark, values):
    assert values(sk.skill_category, ["teradata", "spark", "docker"]) == ["Other", "Data Engineering", "Cloud Platforms"]


def test_summary_of_nothing(spark):
    jobs = spark.createDataFrame([], TEXT)
    row = sk.extraction_summary(jobs, sk.explode_job_skills(sk.merge_methods(sk.match_lexicon(jobs), None))).first()
    assert row["total_rows"] == 0 and row["avg_skills_per_job"] is None
