"""Skills out of descriptions: by lexicon, by vector similarity, and both together."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from vacantia.functions import lexicon as lx
from vacantia.functions import text as tx
from vacantia.operators.rows import value_counts
from vacantia.operators.vectors import over_blocks, unit_rows
from vacantia.session import stage

# Up to this many skills the lexicon is a literal inside the row expression; the answer is the same on both ways.
INLINE_SKILLS = 500


def _pattern(alias: str, right_boundary: bool) -> str:
    # Texts are lowered beforehand, so case matters only to an alias with capitals.
    flags = "(?iud)" if alias != alias.lower() else "(?d)"
    return flags + tx.word_bounded(alias, right_boundary)


def lexicon_rows(
    skills: dict[str, list[str]], right_boundary: bool = True
) -> list[tuple[str, int, str, str]]:
    """``(skill, alias_no, head, pattern)``; an empty head means "always try"."""
    return [
        (skill, number, lx.head_token(alias) or "", _pattern(alias, right_boundary))
        for skill, aliases in skills.items()
        for number, alias in enumerate(aliases)
    ]


def lexicon_words(skills: dict[str, list[str]], right_boundary: bool = True) -> list[list[str]]:
    """The whole words of every alias, in the order of :func:`lexicon_rows`."""
    return [lx.whole_tokens(alias, right_boundary) for aliases in skills.values() for alias in aliases]


def _lowered(c: Column) -> Column:
    # The two letters are equal to "s" and "i" when case is ignored.
    return F.translate(F.lower(c), "ſı", "si")


def _tokens(low: Column) -> Column:
    return F.regexp_extract_all(low, F.lit(f"([{tx.WORD}]+)"), 1)


def _found_at(low: Column, pattern: Column) -> Column:
    """Code points before the first match; null if there is none."""
    return tx.let(F.split(low, pattern, 2), lambda parts: F.when(F.size(parts) > 1, F.length(parts[0])))


def match_lexicon(
    jobs: DataFrame,
    skills: dict[str, list[str]] | None = None,
    right_boundary: bool = True,
) -> DataFrame:
    """``(job_id, skill, position)``: per skill the first alias found and its first position.

    Every alias begins with a known token, so a text's tokens are intersected with those
    heads first and patterns are tried only for the few skills that remain.  All of it
    happens inside the row: no join and no shuffle.  A lexicon too large for a literal is
    joined on the rarest word of each alias instead.
    """
    skills = lx.SKILLS if skills is None else skills
    rows = lexicon_rows(skills, right_boundary)
    texts = jobs.filter(~tx.blank(F.col("description"))).select(
        "job_id", _lowered(F.col("description")).alias("low")
    )
    heads = sorted({head for _, _, head, _ in rows if head})
    if len(skills) > INLINE_SKILLS:
        return _match_by_join(texts, rows, lexicon_words(skills, right_boundary))

    by_skill: dict[str, list[tuple[str, str]]] = {}
    for skill, _, head, pattern in rows:
        by_skill.setdefault(skill, []).append((head, pattern))
    literal = F.array(*[
        F.struct(
            F.lit(skill).alias("skill"),
            F.array(*[
                F.struct(F.lit(h).alias("head"), F.lit(p).alias("pattern")) for h, p in aliases
            ]).alias("aliases"),
        )
        for skill, aliases in by_skill.items()
    ])
    seen = texts.withColumn(
        "heads",
        F.array_append(
            F.array_intersect(F.array(*[F.lit(h) for h in heads]), _tokens(F.col("low"))), F.lit("")
        ),
    )

    def first_position(entry: Column) -> Column:
        tried = F.filter(entry["aliases"], lambda a: F.array_contains(F.col("heads"), a["head"]))
        places = F.transform(tried, lambda a: _found_at(F.col("low"), a["pattern"]))
        return F.try_element_at(F.array_compact(places), F.lit(1))

    likely = F.filter(
        literal,
        lambda e: F.exists(e["aliases"], lambda a: F.array_contains(F.col("heads"), a["head"])),
    )
    placed = F.transform(
        likely, lambda e: F.struct(e["skill"].alias("skill"), first_position(e).alias("position"))
    )
    return seen.select("job_id", F.explode(placed).alias("hit")).select(
        "job_id", "hit.skill", "hit.position"
    ).filter(F.col("position").isNotNull())


def rarest_anchors(texts: DataFrame, rows: list[tuple[str, int, str, str]], words: list[list[str]]) -> DataFrame:
    """``(skill, alias_no, anchor, pattern)``: of the whole words of an alias the one in the fewest texts."""
    spark = texts.sparkSession
    lexicon = spark.createDataFrame(
        [(*row, own or [""]) for row, own in zip(rows, words)], "skill string, alias_no int, head string, pattern string, words array<string>")
    spread = lexicon.select("skill", "alias_no", "pattern", F.explode("words").alias("word"))
    known = lexicon.agg(F.array_distinct(F.flatten(F.collect_list("words"))).alias("words")).scalar()
    seen = texts.select(F.explode(F.array_intersect(known, _tokens(F.col("low")))).alias("word"))
    counts = seen.groupBy("word").agg(F.count("*").alias("n"))
    rank = F.struct(F.coalesce("n", F.lit(0).cast("long")).alias("n"), "word")
    return spread.join(counts, "word", "left").groupBy("skill", "alias_no", "pattern").agg(F.min(rank)["word"].alias("anchor"))


def _match_by_join(
    texts: DataFrame, rows: list[tuple[str, int, str, str]], words: list[list[str]] | None = None,
) -> DataFrame:
    """The same for a large lexicon: aliases are joined on a word that a text must have.

    That is the rarest of their ``words`` over all texts (their heads where none are given), so aliases that share a
    common first word do not meet every text with it.
    """
    lexicon = stage(rarest_anchors(texts, rows, words or [[head] for _, _, head, _ in rows]), "anchors")
    anchors = lexicon.agg(F.collect_set("anchor").alias("anchors")).scalar()
    found = F.array_intersect(anchors, F.array_append(_tokens(F.col("low")), F.lit("")))
    # Per posting, not per id: ids may be repeated or missing.
    numbered = texts.withColumn("posting", F.monotonically_increasing_id())
    tried = numbered.withColumn("anchor", F.explode(found)).join(lexicon, "anchor")
    placed = tried.select(
        "posting", "job_id", "skill", "alias_no", _found_at(F.col("low"), F.col("pattern")).alias("position")
    )
    # The first alias that is found; the filter comes last so that no pattern runs twice.
    return placed.groupBy("posting", "job_id", "skill").agg(
        F.min_by("position", F.when(F.col("position").isNotNull(), F.col("alias_no"))).alias("position")
    ).drop("posting").filter(F.col("position").isNotNull())


def split_sentences(jobs: DataFrame) -> DataFrame:
    """``(job_id, sentence_no, sentence)`` of at least 20 characters after trimming."""
    parts = jobs.filter(~tx.blank(F.col("description"))).select(
        "job_id", F.posexplode(F.split("description", "[.!?]+")).alias("sentence_no", "sentence")
    )
    return parts.filter(F.length(tx.strip(F.col("sentence"))) >= 20)


def match_semantic(
    sentences: DataFrame, skill_vectors: DataFrame, threshold: float = 0.5
) -> DataFrame:
    """``(job_id, skill, confidence)``: best cosine above the threshold per job and skill.

    ``sentences(job_id, embedding)`` stays partitioned; each Arrow batch is multiplied
    with a block of skill vectors and only the pairs above the threshold leave the task.
    """

    def kernel(block: pd.DataFrame):
        names, matrix = block["skill"].to_numpy(), unit_rows(block["embedding"])

        def score(batches):
            for batch in batches:
                cosine = unit_rows(batch["embedding"], matrix.shape[1]) @ matrix.T
                row, col = np.nonzero(cosine > threshold)
                yield pd.DataFrame({
                    "job_id": batch["job_id"].to_numpy()[row], "skill": names[col],
                    "confidence": cosine[row, col],
                })

        return score

    pairs = over_blocks(
        sentences.select("job_id", "embedding"), skill_vectors.select("skill", "embedding"),
        "skill", kernel, "job_id string, skill string, confidence double",
    )
    return pairs.groupBy("job_id", "skill").agg(F.max("confidence").alias("confidence"))


def locate_skill(jobs: DataFrame, matches: DataFrame, skill_names: DataFrame) -> DataFrame:
    """Adds ``position``: where the skill's key stands in the lowered text, -1 if nowhere.

    Only the skills that matched a job are looked for in its text; of repeated ids the first place counts.
    ``skill_names`` limits nothing and is kept for callers that pass it.
    """
    per_job = matches.groupBy("job_id").agg(F.collect_set("skill").alias("names"))
    texts = jobs.select("job_id", F.lower("description").alias("low")).join(per_job, "job_id")
    places = F.transform(
        "names", lambda n: F.struct(n.alias("skill"), (F.instr(F.col("low"), n) - 1).alias("position"))
    )
    found = texts.select("job_id", F.explode(places).alias("hit")).filter("hit.position >= 0").groupBy(
        "job_id", F.col("hit.skill").alias("skill")).agg(F.min("hit.position").alias("position"))
    return matches.join(found, ["job_id", "skill"], "left").withColumn(
        "position", F.coalesce("position", F.lit(-1))
    )


def merge_methods(lexical: DataFrame, semantic: DataFrame | None, method: str = "hybrid") -> DataFrame:
    """``(job_id, skill, confidence, position)``; a lexicon entry wins over a semantic one.

    Both sides go through one hash aggregate, so neither is computed twice.
    """
    by_rule = lexical.select("job_id", "skill", F.lit(1.0).alias("confidence"), "position")
    if semantic is None or method == "regex":
        return by_rule
    by_vector = semantic.select("job_id", "skill", "confidence", "position")
    if method == "bert":
        return by_vector
    none = F.lit(None)
    both = by_rule.select(
        "job_id", "skill", F.col("position").alias("rule_position"),
        none.cast("double").alias("confidence"), none.cast("int").alias("vector_position"),
    ).unionByName(by_vector.select(
        "job_id", "skill", none.cast("int").alias("rule_position"), "confidence",
        F.col("position").alias("vector_position"),
    ))
    merged = both.groupBy("job_id", "skill").agg(*[
        F.max(c).alias(c) for c in ("rule_position", "confidence", "vector_position")
    ])
    return merged.select(
        "job_id", "skill",
        F.when(F.col("rule_position").isNotNull(), F.lit(1.0)).otherwise(F.col("confidence")).alias("confidence"),
        F.coalesce("rule_position", "vector_position").alias("position"),
    )


def skill_category(skill: Column, taxonomy: dict[str, list[str]] | None = None) -> Column:
    """First group that lists the skill, else "Other"."""
    taxonomy = lx.TAXONOMY if taxonomy is None else taxonomy
    group: dict[str, str] = {}
    for category, members in taxonomy.items():
        for member in members:
            group.setdefault(member, category)
    if not group:
        return F.lit("Other")
    lookup = F.create_map(*[F.lit(v) for pair in group.items() for v in pair])
    return F.coalesce(F.try_element_at(lookup, skill), F.lit("Other"))


def explode_job_skills(
    merged: DataFrame, taxonomy: dict[str, list[str]] | None = None
) -> DataFrame:
    """The job-skill table in its file layout."""
    return merged.select(
        "job_id",
        F.col("skill").alias("skill_name"),
        skill_category(F.col("skill"), taxonomy).alias("skill_category"),
        F.col("confidence").cast(T.DoubleType()).alias("confidence_score"),
        F.greatest(F.col("position"), F.lit(-1)).cast("int").alias("position_in_description"),
        F.when(F.col("confidence") < 1.0, "bert").otherwise("regex").alias("extraction_method"),
    )


def with_job_id(jobs: DataFrame, row_no: str = "row_no") -> DataFrame:
    """A missing id becomes ``job_<row>``, counted from 0."""
    return jobs.withColumn(
        "job_id", F.coalesce("job_id", F.concat(F.lit("job_"), F.col(row_no).cast("string")))
    )


def extract_job_skills(
    jobs: DataFrame,
    skills: dict[str, list[str]] | None = None,
    taxonomy: dict[str, list[str]] | None = None,
    sentences: DataFrame | None = None,
    skill_vectors: DataFrame | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """Lexicon matches, plus semantic matches where vectors are given, as job-skill rows."""
    lexical = match_lexicon(jobs, skills)
    semantic = None
    if sentences is not None and skill_vectors is not None:
        semantic = locate_skill(
            jobs, match_semantic(sentences, skill_vectors, threshold), skill_vectors
        )
    return explode_job_skills(merge_methods(lexical, semantic), taxonomy)


def extraction_summary(jobs: DataFrame, job_skills: DataFrame) -> DataFrame:
    """Jobs, rows, distinct skills, rows per job."""
    n_jobs = jobs.agg(F.count("*").alias("n"))
    return job_skills.agg(
        F.count("*").alias("total_rows"), F.countDistinct("skill_name").alias("unique_skills")
    ).withColumn("total_jobs", n_jobs.scalar()).withColumn(
        "avg_skills_per_job", F.try_divide(F.col("total_rows"), F.col("total_jobs"))
    )


def top_skills(job_skills: DataFrame, n: int = 20) -> DataFrame:
    return value_counts(job_skills, "skill_name", n)


def skills_by_category(job_skills: DataFrame) -> DataFrame:
    return (
        job_skills.groupBy("skill_category")
        .agg(F.countDistinct("skill_name").alias("unique_skills"))
        .orderBy(F.desc("unique_skills"), "skill_category")
    )
