"""Ranked jobs for candidate profiles: skill overlap plus vector similarity.

``jobs(job_id, title, company, location, source, description, embedding)`` stays
partitioned; candidates meet it in bounded blocks.  Inside a task an Arrow batch of jobs
is scored against the block with matrix products, and only rows that can still reach a
candidate's top list leave the task - never all pairs.

The final score needs the best skill score over *all* jobs.  Jobs with the same number
of matched skills have the same skill part, so within such a level the similarity alone
decides.  Keeping the top k of each level per batch is therefore exact, and one pass over
the jobs is enough: the maximum is read off the kept rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from vacantia.operators.rows import top_per_key
from vacantia.operators.vectors import over_blocks, unit_rows
from vacantia.session import stage

# ---------------------------------------------------------------- fixed values
SKILL_WEIGHT = 0.6
SEMANTIC_WEIGHT = 0.4
MIN_SKILL_MATCH = 0.3
MIN_SCORE = 0.1
TOP_K = 10
TOP_K_BATCH = 5
MULTI_WEIGHTS = {"semantic": 0.5, "skills": 0.3, "location": 0.2}
MULTI_THRESHOLD = 0.5
MULTI_TOP_N = 10
# ------------------------------------------------------------------------------

# Largest number of cells of one matrix inside a task; longer batches are cut into pieces.
CELLS = 4_000_000
# Rows that a task keeps before it prunes them over all its batches.
HELD = 100_000

JOB_FIELDS = ["job_id", "title", "company", "location", "source"]
_KEPT = (
    "candidate long, candidate_name string, job_id string, title string, company string, location string, "
    "source string, matched int, n_skills int, location_match boolean, matched_skills string, "
    "similarity double"
)


def skill_score(description: Column, skills: Column, min_match: float = MIN_SKILL_MATCH) -> Column:
    """Share of the candidate's skills found in the description; 0 below ``min_match``."""
    low = F.lower(F.coalesce(description, F.lit("")))
    hits = F.size(F.filter(skills, lambda s: low.contains(F.lower(s))))
    ratio = F.coalesce(F.try_divide(hits.cast("double"), F.size(skills).cast("double")), F.lit(0.0))
    return F.when(ratio >= min_match, ratio).otherwise(F.lit(0.0))


def semantic_score(cosine: Column) -> Column:
    """Cosine moved from [-1, 1] to [0, 1]."""
    return (cosine + 1) / 2


def combined_score(skill: Column, best_skill: Column, semantic: Column) -> Column:
    """Weighted sum, the skill part being scaled by the candidate's best skill score."""
    scaled = F.when(best_skill > 0, skill / best_skill).otherwise(skill)
    return SKILL_WEIGHT * scaled + SEMANTIC_WEIGHT * semantic


def profile_text(skills: Column, experience: Column, interests: Column) -> Column:
    none = F.lit("")
    return F.concat(
        F.array_join(skills, " "), F.lit(" "), F.coalesce(experience, none), F.lit(" "),
        F.coalesce(interests, none),
    )


def job_vectors(jobs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Jobs with the stored vector of their description (null where none is stored)."""
    return jobs.join(vectors.select("job_id", "embedding"), "job_id", "left")


def _substring_hits(texts: list[str], terms: list[str]) -> np.ndarray:
    """``hits[i, j]``: term j occurs in text i."""
    import ahocorasick

    hits = np.zeros((len(texts), len(terms)), dtype=bool)
    machine = ahocorasick.Automaton()
    for j, term in enumerate(terms):
        if term:
            machine.add_word(term, j)
        else:
            hits[:, j] = 1
    if len(machine):
        machine.make_automaton()
        for i, text in enumerate(texts):
            found = {j for _, j in machine.iter(text)}
            hits[i, list(found)] = 1
    return hits


def _same_place(where: pd.Series, places: np.ndarray | None) -> np.ndarray | None:
    """``near[i, c]``: job i is in candidate c's place; None where places do not count."""
    if places is None:
        return None
    codes, known = pd.factorize(pd.concat([where, pd.Series(places)], ignore_index=True))
    jobs, wanted = codes[:len(where)], codes[len(where):]
    return (jobs[:, None] == wanted[None, :]) & (jobs[:, None] >= 0)


def _best_per_level(level: np.ndarray, score: np.ndarray, rank: np.ndarray, k: int) -> np.ndarray:
    """Row numbers that can still be in the top k; ``rank`` orders equal scores.

    Levels are visited from high to low; a row must beat the k-th best similarity seen at
    the levels above it, because a row there with no smaller similarity ranks before it.
    """
    order = np.lexsort((rank, -score, -level))
    kept: list[np.ndarray] = []
    above = np.empty(0)
    for rows in np.split(order, np.flatnonzero(np.diff(level[order])) + 1):
        if len(above) >= k:
            rows = rows[score[rows] > above[k - 1]]
        rows = rows[:k]
        kept.append(rows)
        above = -np.sort(-np.concatenate([above, score[rows]]))[:k]
    return np.concatenate(kept)


def _shortlist(
    jobs: DataFrame, candidates: DataFrame, k: int, min_match: float,
    skills_count: bool = True, similarity_counts: bool = True,
) -> DataFrame:
    """Per candidate the jobs that can be in its top k, with the parts of the score.

    The two flags say whether skills and similarity have a positive weight: a part without weight must
    not decide which rows are left out.  Candidates are told apart by ``candidate``, not by name.
    """
    candidates = stage(candidates.withColumn("candidate", F.monotonically_increasing_id()), "candidates")

    def kernel(block: pd.DataFrame):
        skills = [[s.lower() for s in (xs if xs is not None else [])] for xs in block["skills"]]
        terms = sorted({s for xs in skills for s in xs})
        at = {term: j for j, term in enumerate(terms)}
        wanted = [[at[s] for s in xs] for xs in skills]
        step = max(1, CELLS // max(len(terms), len(block), 1))
        sizes = np.array([len(xs) for xs in skills])
        matrix = unit_rows(block["embedding"])
        names, numbers = block["name"].to_numpy(), block["candidate"].to_numpy()
        places = block["location"].to_numpy() if "location" in block else None

        def prune(rows: pd.DataFrame) -> pd.DataFrame:
            """What can still be in a top list, over all that the task has kept so far."""
            kept = []
            for _, own in rows.groupby(["candidate", "location_match"], sort=False):
                rank = np.empty(len(own), dtype=int)
                rank[np.argsort(own["job_id"].to_numpy(dtype=str), kind="stable")] = np.arange(len(own))
                best = _best_per_level(
                    own["matched"].to_numpy() * skills_count, own["similarity"].to_numpy() * similarity_counts, rank, k)
                kept.append(own.iloc[best])
            return pd.concat(kept, ignore_index=True) if kept else rows

        def score(batches):
            held, number = [], 0
            pieces = (b.iloc[i:i + step] for b in batches for i in range(0, len(b), step))
            for batch in pieces:
                texts = [d.lower() if d is not None else "" for d in batch["description"]]
                hits = _substring_hits(texts, terms)
                count = np.column_stack([hits[:, js].sum(axis=1, dtype=int) for js in wanted])
                ratio = np.divide(count, sizes, out=np.zeros(count.shape), where=sizes > 0)
                matched = np.where(ratio >= min_match, count, 0)
                cosine = (
                    unit_rows(batch["embedding"], matrix.shape[1]) @ matrix.T
                    if matrix.shape[1] else np.zeros(count.shape)
                )
                rank = np.empty(len(batch), dtype=int)
                rank[np.argsort(batch["job_id"].to_numpy(dtype=str), kind="stable")] = np.arange(len(batch))
                near = _same_place(batch["location"], places)
                picked = [
                    (rows[_best_per_level(
                        matched[rows, c] * skills_count, cosine[rows, c] * similarity_counts, rank[rows], k)], c)
                    for c in range(len(names))
                    for rows in ([np.flatnonzero(near[:, c]), np.flatnonzero(~near[:, c])] if near is not None
                                 else [np.arange(len(batch))])
                    if len(rows)
                ]
                row = np.concatenate([r for r, _ in picked])
                col = np.repeat([c for _, c in picked], [len(r) for r, _ in picked])
                kept = batch.iloc[row]
                held.append(pd.DataFrame({
                    "candidate": numbers[col], "candidate_name": names[col],
                    **{f: kept[f].to_numpy() for f in JOB_FIELDS},
                    "matched": matched[row, col], "n_skills": sizes[col],
                    "location_match": near[row, col] if near is not None else False,
                    "matched_skills": [
                        ", ".join(sorted(s for s in set(skills[c]) if hits[r, at[s]]))
                        for r, c in zip(row, col)
                    ],
                    "similarity": cosine[row, col],
                }))
                number += len(held[-1])
                if number > HELD:
                    held = [prune(pd.concat(held, ignore_index=True))]
                    number = len(held[0]) // 2  # so that pruning stays rare where much has to be kept
            if held:
                yield prune(pd.concat(held, ignore_index=True))

        return score

    columns = ["candidate", "name", "skills", "embedding"] + (["location"] if "location" in candidates.columns else [])
    found = over_blocks(
        jobs.select(*JOB_FIELDS, "description", "embedding"), candidates.select(*columns),
        "candidate", kernel, _KEPT,
    )
    # Read twice below: staged, so that the jobs are scored once.
    return stage(found, "shortlist")


def _scored(kept: DataFrame) -> DataFrame:
    ratio = F.coalesce(
        F.try_divide(F.col("matched").cast("double"), F.col("n_skills").cast("double")), F.lit(0.0)
    )
    return kept.withColumn("skill_match_score", ratio).withColumn(
        "semantic_similarity_score", semantic_score(F.col("similarity"))
    )


def match_candidates(
    jobs: DataFrame, candidates: DataFrame, top_k: int = TOP_K_BATCH,
    min_skill_match: float = MIN_SKILL_MATCH,
) -> DataFrame:
    """Top jobs of every candidate, tagged with the candidate's name; candidates of one name are ranked each."""
    rows = _scored(_shortlist(jobs, candidates.drop("location"), top_k, min_skill_match))
    best = rows.groupBy("candidate").agg(F.max("skill_match_score").alias("_best"))
    scored = rows.join(best, "candidate").withColumn(
        "combined_score",
        combined_score(F.col("skill_match_score"), F.col("_best"), F.col("semantic_similarity_score")),
    )
    passed = scored.filter(F.col("combined_score") > MIN_SCORE)
    ranked = top_per_key(passed, ["candidate"], [F.desc("combined_score"), F.col("job_id")], top_k)
    return ranked.select(
        *JOB_FIELDS, "skill_match_score", "semantic_similarity_score", "combined_score",
        "candidate_name",
    )


def recommend_by_profile(
    jobs: DataFrame, skills: list[str], embedding: list[float], experience: str = "",
    interests: str = "", top_k: int = TOP_K, min_skill_match: float = MIN_SKILL_MATCH,
) -> DataFrame:
    """Top jobs of one profile; ``embedding`` is the vector of its :func:`profile_text`."""
    one = jobs.sparkSession.createDataFrame(
        [("profile", skills, experience, interests, [float(x) for x in embedding])],
        "name string, skills array<string>, experience string, interests string, embedding array<float>",
    )
    return match_candidates(jobs, one, top_k, min_skill_match).drop("candidate_name")


def job_details(jobs: DataFrame, job_id: str) -> DataFrame:
    """Nine fields of the posting with this id, or no row."""
    return jobs.filter(F.col("job_id") == job_id).select(
        "job_id", "title", "company", "location", "description", "url", "source",
        "publish_date", "scrape_date",
    ).limit(1)


def multi_factor_score(
    jobs: DataFrame, candidates: DataFrame, weights: dict[str, float] | None = None,
    threshold: float = MULTI_THRESHOLD, top_n: int = MULTI_TOP_N,
) -> DataFrame:
    """Declared scoring: similarity, share of skills and same location, each with a weight."""
    w = weights or MULTI_WEIGHTS
    if min(w.values()) < 0:
        raise ValueError("weights must not be negative")
    scored = _scored(_shortlist(jobs, candidates, top_n, 0.0, w["skills"] > 0, w["semantic"] > 0))
    total = (
        w["semantic"] * F.col("semantic_similarity_score")
        + w["skills"] * F.col("skill_match_score")
        + w["location"] * F.col("location_match").cast("double")
    )
    passed = scored.withColumn("match_score", total).filter(F.col("match_score") >= threshold)
    ranked = top_per_key(passed, ["candidate"], [F.desc("match_score"), F.col("job_id")], top_n)
    return ranked.select(
        "candidate_name", "job_id", "match_score",
        F.col("semantic_similarity_score").alias("semantic_similarity"),
        (100 * F.col("skill_match_score")).alias("skills_match_percentage"),
        "location_match", "matched_skills",
    )


def candidate_levels(skills: DataFrame, dim_skills: DataFrame) -> DataFrame:
    """One row per candidate and skill name: the most years, and the level held with them."""
    names = skills.join(dim_skills.select("skill_id", "skill_name"), "skill_id")
    most = F.max(F.struct(F.coalesce("years_of_experience", F.lit(-1)).alias("years"), F.col("proficiency_level").alias("level")))
    return names.groupBy("candidate_id", "skill_name").agg(most.alias("_most")).select(
        "candidate_id", "skill_name", F.col("_most.level").alias("proficiency_level"),
        F.when(F.col("_most.years") >= 0, F.col("_most.years")).alias("years_of_experience"))


def candidates_from_model(profiles: DataFrame, skills: DataFrame, dim_skills: DataFrame) -> DataFrame:
    """Candidate and candidate-skill tables folded to one row per candidate.

    ``skills`` are the names, ``skill_levels`` the same with level and years (null where the table has none).
    """
    for column, kind in (("proficiency_level", "string"), ("years_of_experience", "int")):
        if column not in skills.columns:
            skills = skills.withColumn(column, F.lit(None).cast(kind))
    entry = F.struct("skill_name", F.col("proficiency_level").alias("level"), F.col("years_of_experience").alias("years"))
    listed = candidate_levels(skills, dim_skills).groupBy("candidate_id").agg(F.array_sort(F.collect_list(entry)).alias("skill_levels"))
    return profiles.join(
        listed, profiles["id"] == listed["candidate_id"], "left"
    ).select(
        profiles["id"].alias("candidate_id"), F.col("candidate_name").alias("name"),
        F.coalesce(F.col("skill_levels.skill_name"), F.array().cast("array<string>")).alias("skills"),
        F.concat_ws(" ", F.col("target_job_title"), F.format_string("%d years", "years_experience")).alias("experience"),
        F.coalesce("skill_levels", F.array().cast(listed.schema["skill_levels"].dataType)).alias("skill_levels"),
    )
