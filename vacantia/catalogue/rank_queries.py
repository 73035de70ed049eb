"""Recommendation queries: documents as jobs, benchmark items as candidates."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia.operators import recommend as rc
from vacantia.operators import textvectors as tv
from vacantia.operators.vectors import cosine, norm
from vacantia.plans.standin import RANK_SQL, candidates, ranked_jobs, raw_jobs, star, table, vectors
from vacantia.session import stage

PROFILE = ["The", "of", "que", "Data"]
MIN_MATCH = 0.5
JOB_ID = "src1_00001"


def _mean_vector(spark, sf_dir):
    """The mean of all stored vectors, as a one-row frame."""
    cells = vectors(spark, sf_dir).select(F.posexplode("embedding").alias("pos", "x"))
    means = cells.groupBy("pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return means.agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("cells")).select(
        F.transform("cells", lambda c: c["x"]).alias("v")
    )


def _parts(spark, sf_dir):
    """Skill and semantic score of every job for one profile."""
    skills = F.array(*[F.lit(s) for s in PROFILE])
    mean = _mean_vector(spark, sf_dir).scalar()
    return ranked_jobs(spark, sf_dir).withColumn("mean", mean).select(
        "job_id",
        rc.skill_score(F.col("description"), skills, MIN_MATCH).alias("skill"),
        rc.semantic_score(cosine(F.col("embedding"), F.col("mean"))).alias("semantic"),
    )


def _combined(spark, sf_dir):
    parts = _parts(spark, sf_dir)
    best = parts.agg(F.max("skill").alias("m")).scalar()
    return parts.select(
        "job_id", F.round(rc.combined_score(F.col("skill"), best, F.col("semantic")), 6).alias("combined_score")
    )


def _one_profile(spark, sf_dir):
    vector = _mean_vector(spark, sf_dir).first()["v"]  # one vector, of fixed width
    top = rc.recommend_by_profile(ranked_jobs(spark, sf_dir), PROFILE, vector, min_skill_match=MIN_MATCH)
    return _rounded(top)


def _rounded(df):
    scores = [c for c in df.columns if c.endswith("_score") or c.endswith("percentage") or c == "semantic_similarity"]
    return df.withColumns({c: F.round(c, 6) for c in scores})


def _matched(spark, sf_dir):
    return _rounded(rc.match_candidates(ranked_jobs(spark, sf_dir), candidates(spark, sf_dir)))


def _multi(spark, sf_dir):
    return _rounded(rc.multi_factor_score(ranked_jobs(spark, sf_dir), candidates(spark, sf_dir)))


def _profiles(spark, sf_dir):
    return candidates(spark, sf_dir).select(
        "name", rc.profile_text(F.col("skills"), F.col("experience"), F.col("interests")).alias("profile_text")
    )


def _job_vectors(spark, sf_dir):
    jobs = ranked_jobs(spark, sf_dir).drop("embedding")
    named = vectors(spark, sf_dir).join(jobs.select("job_id", "doc_id"), F.col("vec_id") == F.col("doc_id"))
    return rc.job_vectors(jobs.select("job_id"), named).select(
        "job_id", F.size("embedding").alias("width"), F.round(norm(F.col("embedding")), 6).alias("norm")
    )


def _model(spark, sf_dir):
    """Customers as candidates, the skills of what they ordered as their skills."""
    s = star(spark, sf_dir)
    profiles = s.companies.select(
        F.col("company_id").alias("id"), F.col("company_name").alias("candidate_name"),
        F.lower("industry").alias("target_job_title"), F.length("company_name").alias("years_experience"),
    )
    owned = s.links.join(s.jobs.select("job_id", "company_id"), "job_id").select(
        F.col("company_id").alias("candidate_id"), "skill_id", F.col("position_in_description").alias("years_of_experience"),
        F.when(F.col("confidence_score") >= 7, "expert").when(F.col("confidence_score") >= 3, "regular").alias("proficiency_level"),
    )
    told = F.transform("skill_levels", lambda e: F.format_string("%s: %s, %d years", e["skill_name"], F.coalesce(e["level"], F.lit("none")), e["years"]))
    return rc.candidates_from_model(profiles, owned, s.skills).withColumns({
        "skills": F.array_join("skills", ", "), "skill_levels": F.array_join(told, "; ")})


def _text_vectors(spark, sf_dir):
    """All non-zero weights; a posting without words has one row of nulls."""
    jobs = raw_jobs(spark, sf_dir).select("job_id", "description")
    weighed = tv.term_weights(jobs, tv.document_frequency(jobs))
    return weighed.select("job_id", F.explode_outer("terms").alias("t")).select("job_id", "t.bucket", F.round("t.weight", 9).alias("weight"))


def _text_ranking(spark, sf_dir):
    """Ranking without stored vectors: descriptions and profiles get vectors of their words."""
    jobs = ranked_jobs(spark, sf_dir).drop("embedding")
    frequency = stage(tv.document_frequency(jobs), "frequency")
    asked = candidates(spark, sf_dir).drop("embedding").withColumn(
        "profile", rc.profile_text(F.col("skills"), F.col("experience"), F.col("interests")))
    vector = lambda df, c: tv.term_weights(df, frequency, c).withColumn("embedding", tv.dense(F.col("terms"))).drop("terms")
    return _rounded(rc.match_candidates(vector(jobs, "description"), vector(asked, "profile").drop("profile")))


QUERIES = {
    "skill_score": lambda s, d: _parts(s, d).select("job_id", F.round("skill", 6).alias("skill_score")),
    "semantic_score": lambda s, d: _parts(s, d).select("job_id", F.round("semantic", 6).alias("semantic_score")),
    "combined_score": _combined,
    "recommend_by_profile": _one_profile,
    "match_candidates": _matched,
    "job_details": lambda s, d: rc.job_details(ranked_jobs(s, d), JOB_ID),
    "profile_text": _profiles,
    "job_vectors": _job_vectors,
    "multi_factor_score": _multi,
    "candidate_skill_model": _model,
    "text_vectors": _text_vectors,
    "match_candidates_text": _text_ranking,
}


# ------------------------------------------------------------------- SQL twins

_RANK = f"WITH {RANK_SQL.strip()}"
_SKILLS = "[" + ", ".join(f"'{s.lower()}'" for s in PROFILE) + "]"
_RATIO = f"""CAST(len(list_filter({_SKILLS}, lambda s: contains(lower(coalesce(description, '')), s))) AS DOUBLE) / {len(PROFILE)}"""
_PARTS = f"""mean AS (
  SELECT list(x ORDER BY pos) AS v FROM (
    SELECT pos, avg(CAST(x AS DOUBLE)) AS x FROM (
      SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY pos)),
parts AS (
  SELECT jobs.*, CASE WHEN {_RATIO} >= {MIN_MATCH} THEN {_RATIO} ELSE 0.0 END AS skill,
         (coalesce(list_cosine_similarity(jobs.embedding, mean.v), 0) + 1) / 2 AS semantic FROM jobs, mean),
best AS (SELECT max(skill) AS m FROM parts),
combined AS (
  SELECT parts.*, 0.6 * CASE WHEN m > 0 THEN skill / m ELSE skill END + 0.4 * semantic AS score FROM parts, best)"""
_PAIRS = """pairs AS (
  SELECT c.name AS candidate_name, c.location AS candidate_location, j.job_id, j.title, j.company, j.location, j.source,
         list_filter(c.skills, lambda s: contains(lower(coalesce(j.description, '')), s)) AS matched,
         len(c.skills) AS n_skills,
         (coalesce(list_cosine_similarity(c.embedding, j.embedding), 0) + 1) / 2 AS semantic
  FROM candidates c CROSS JOIN jobs j),
rated AS (SELECT *, CAST(len(matched) AS DOUBLE) / n_skills AS ratio FROM pairs)"""
_CAND = f"""{_RANK}, {_PAIRS},
kept AS (SELECT *, CASE WHEN ratio >= 0.3 THEN ratio ELSE 0.0 END AS skill FROM rated),
scored AS (
  SELECT *, 0.6 * CASE WHEN max(skill) OVER (PARTITION BY candidate_name) > 0
                       THEN skill / max(skill) OVER (PARTITION BY candidate_name) ELSE skill END
            + 0.4 * semantic AS score FROM kept)
SELECT job_id, title, company, location, source, round(skill, 6) AS skill_match_score,
  round(semantic, 6) AS semantic_similarity_score, round(score, 6) AS combined_score, candidate_name
FROM scored WHERE score > 0.1
QUALIFY row_number() OVER (PARTITION BY candidate_name ORDER BY score DESC, job_id) <= 5"""


def _terms(name: str, source: str, key: str, text: str) -> str:
    """Hashed term counts of a text column, weighed by the frequencies over all descriptions, at unit length."""
    return f"""{name}_terms AS (
  SELECT {key}, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % {tv.DIMENSIONS} AS bucket, count(*) AS n
  FROM (SELECT {key}, unnest(regexp_extract_all(lower(coalesce({text}, '')), '[\\p{{L}}\\p{{N}}_]+')) AS w FROM {source}) GROUP BY ALL)"""


_UNIT = """{name} AS (
  SELECT {key}, bucket, raw / sqrt(sum(raw * raw) OVER (PARTITION BY {key})) AS weight
  FROM (SELECT {key}, bucket, n * idf AS raw FROM {terms} JOIN frequency USING (bucket) WHERE idf > 0))"""
_TERMS = f"""{_terms("job", "jobs", "job_id", "description")},
frequency AS (SELECT bucket, ln(((SELECT count(*) FROM jobs) + 1.0::DOUBLE) / (count(*) + 1)) AS idf FROM job_terms GROUP BY bucket),
{_UNIT.format(name="weighed", key="job_id", terms="job_terms")}"""
_TEXT_PAIRS = f"""{_terms("asked", "candidates", "name", "array_to_string(skills, ' ') || ' ' || experience || ' ' || coalesce(interests, '')")},
{_UNIT.format(name="asked", key="name", terms="asked_terms")},
cosines AS (SELECT name, job_id, sum(a.weight * w.weight) AS cosine FROM asked a JOIN weighed w USING (bucket) GROUP BY 1, 2),
pairs AS (
  SELECT c.name AS candidate_name, c.location AS candidate_location, j.job_id, j.title, j.company, j.location, j.source,
         list_filter(c.skills, lambda s: contains(lower(coalesce(j.description, '')), s)) AS matched, len(c.skills) AS n_skills,
         (coalesce(cosine, 0) + 1) / 2 AS semantic
  FROM candidates c CROSS JOIN jobs j LEFT JOIN cosines ON cosines.name = c.name AND cosines.job_id = j.job_id),
rated AS (SELECT *, CAST(len(matched) AS DOUBLE) / n_skills AS ratio FROM pairs)"""


def _model_sql() -> str:
    from vacantia.catalogue.star_queries import on_star

    return on_star("""+ owned AS (SELECT company_id, skill_name, max(years) AS years, max(level) FILTER (WHERE years = most) AS level FROM (
  SELECT company_id, skill_name, position_in_description AS years, max(position_in_description) OVER (PARTITION BY company_id, skill_name) AS most,
    CASE WHEN confidence_score >= 7 THEN 'expert' WHEN confidence_score >= 3 THEN 'regular' END AS level FROM fact_job_skills js
  JOIN fact_jobs j ON js.job_id = j.job_id JOIN dim_skills s ON js.skill_id = s.skill_id) GROUP BY 1, 2)
SELECT c.company_id AS candidate_id, c.company_name AS name,
  coalesce(string_agg(skill_name, ', ' ORDER BY skill_name), '') AS skills,
  coalesce(string_agg(skill_name || ': ' || coalesce(level, 'none') || ', ' || years || ' years', '; ' ORDER BY skill_name), '') AS skill_levels,
  lower(c.industry) || ' ' || length(c.company_name) || ' years' AS experience
FROM dim_companies c LEFT JOIN owned o ON c.company_id = o.company_id GROUP BY ALL""")


ORACLES = {
    "skill_score": f"{_RANK}, {_PARTS} SELECT job_id, round(skill, 6) AS skill_score FROM parts",
    "semantic_score": f"{_RANK}, {_PARTS} SELECT job_id, round(semantic, 6) AS semantic_score FROM parts",
    "combined_score": f"{_RANK}, {_PARTS} SELECT job_id, round(score, 6) AS combined_score FROM combined",
    "recommend_by_profile": f"""{_RANK}, {_PARTS} SELECT job_id, title, company, location, source,
  round(skill, 6) AS skill_match_score, round(semantic, 6) AS semantic_similarity_score, round(score, 6) AS combined_score
FROM combined WHERE score > 0.1 ORDER BY score DESC, job_id LIMIT 10""",
    "match_candidates": _CAND,
    "job_details": f"""{_RANK} SELECT job_id, title, company, location, description, url, source,
  CASE WHEN location = 'en' THEN publish_date END AS publish_date, scrape_date FROM jobs WHERE job_id = '{JOB_ID}'""",
    "profile_text": f"""{_RANK} SELECT name, array_to_string(skills, ' ') || ' ' || experience || ' ' || coalesce(interests, '')
  AS profile_text FROM candidates""",
    "job_vectors": f"""{_RANK} SELECT job_id, CAST(len(embedding) AS INTEGER) AS width,
  round(sqrt(list_sum(list_transform(embedding, lambda x: x * x))), 6) AS norm FROM jobs""",
    "multi_factor_score": f"""{_RANK}, {_PAIRS}, scored AS (
  SELECT *, coalesce(candidate_location = location, false) AS same_place,
         0.5 * semantic + 0.3 * ratio
           + 0.2 * CASE WHEN coalesce(candidate_location = location, false) THEN 1.0 ELSE 0.0 END AS score FROM rated)
SELECT candidate_name, job_id, round(score, 6) AS match_score, round(semantic, 6) AS semantic_similarity,
  round(100 * ratio, 6) AS skills_match_percentage, same_place AS location_match,
  array_to_string(list_sort(matched), ', ') AS matched_skills
FROM scored WHERE score >= 0.5
QUALIFY row_number() OVER (PARTITION BY candidate_name ORDER BY score DESC, job_id) <= 10""",
    "candidate_skill_model": _model_sql(),
    "text_vectors": f"""{_RANK}, {_TERMS} SELECT job_id, bucket, round(weight, 9) AS weight FROM jobs LEFT JOIN weighed USING (job_id)""",
    "match_candidates_text": _CAND.replace(_PAIRS, f"""{_TERMS}, {_TEXT_PAIRS}"""),
}
