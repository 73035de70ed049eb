"""Cleaning, normalization and skill extraction over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia.catalogue import sqltext as sq
from vacantia.functions import text as tx
from vacantia.functions.dates import resolve_relative_date
from vacantia.operators import clean as cl
from vacantia.operators import normalize as nz
from vacantia.operators import skills as sk
from vacantia.operators.rows import table_counts
from vacantia.plans.standin import (
    RAW_SQL, RECORDS_SQL, boards, raw_jobs, records, table, vectors,
)

# A lexicon of words that occur in the documents, with the alias forms of the real one.
WORDS = {
    "the": ["the", "thee"],
    "of_the": ["of the", r"of\s+the"],
    "french": ["les", "la", "le"],
    "german": ["der", "die", r"\bund\b"],
    "spanish": ["que", "para"],
    "then": ["th.n", "than"],
    "plus": [r"a\+\+", "a plus"],
    "with": ["with"],
    "that": ["that the", "that"],
    "on": ["on"],
}
GROUPS = {"English": ["the", "of_the", "with", "the"], "Romance": ["french", "spanish"], "German": ["german"]}
# The mean vector of one label stands for a word's own vector.
WORD_LABELS = {name: number for number, name in enumerate(WORDS)}
THRESHOLD = 0.2


def _cleaned(spark, sf_dir):
    return cl.clean_jobs(boards(spark, sf_dir))


def _stacked(spark, sf_dir):
    return cl.union_sources([cl.harmonize_columns(b) for b in boards(spark, sf_dir)])


def _harmonized(spark, sf_dir):
    one, two = (cl.harmonize_columns(b) for b in boards(spark, sf_dir))
    return one.unionByName(two)


def _text_column(fn, column):
    def run(spark, sf_dir):
        return raw_jobs(spark, sf_dir).select("job_id", fn(F.col(column)).alias(column))
    return run


def _normalized(spark, sf_dir):
    return nz.normalize_records(records(spark, sf_dir), ["doc_id"]).withColumn(
        "skills", F.array_join("skills", ", ")
    )


def _lexical(spark, sf_dir):
    return sk.match_lexicon(raw_jobs(spark, sf_dir), WORDS)


def _lexical_joined(spark, sf_dir):
    texts = raw_jobs(spark, sf_dir).filter(~tx.blank(F.col("description"))).select(
        "job_id", F.lower("description").alias("low")
    )
    return sk._match_by_join(texts, sk.lexicon_rows(WORDS), sk.lexicon_words(WORDS))


def _sentences(spark, sf_dir):
    v = vectors(spark, sf_dir)
    raw = raw_jobs(spark, sf_dir).select("job_id", "doc_id")
    return raw.join(v, raw["doc_id"] == v["vec_id"]).select("job_id", "embedding")


def _word_vectors(spark, sf_dir):
    cells = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = cells.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    packed = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("cells"))
    word = F.try_element_at(F.array(*[F.lit(w) for w in WORD_LABELS]), F.col("label") + 1)
    return packed.select(
        word.alias("skill"), F.transform("cells", lambda c: c["x"]).alias("embedding")
    ).filter(F.col("skill").isNotNull())


def _semantic(spark, sf_dir):
    return sk.match_semantic(_sentences(spark, sf_dir), _word_vectors(spark, sf_dir), THRESHOLD)


def _semantic_sentences(spark, sf_dir):
    """Sentences of all postings, each with one of the stored vectors; the best sentence counts."""
    v = vectors(spark, sf_dir)
    number = F.length("sentence") * 7 + F.col("sentence_no") * 13
    told = sk.split_sentences(raw_jobs(spark, sf_dir)).select(
        "job_id", F.pmod(number.cast("long"), v.agg(F.count("*")).scalar()).alias("vec_id"))
    return sk.match_semantic(told.join(v, "vec_id").select("job_id", "embedding"), _word_vectors(spark, sf_dir), THRESHOLD)


def _merged(spark, sf_dir):
    semantic = sk.locate_skill(raw_jobs(spark, sf_dir), _semantic(spark, sf_dir), _word_vectors(spark, sf_dir))
    return sk.merge_methods(_lexical(spark, sf_dir), semantic)


def _job_skills(spark, sf_dir):
    return sk.extract_job_skills(
        raw_jobs(spark, sf_dir), WORDS, GROUPS, _sentences(spark, sf_dir), _word_vectors(spark, sf_dir), THRESHOLD
    )


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _categories(spark, sf_dir):
    return _lexical(spark, sf_dir).select(
        "job_id", "skill", sk.skill_category(F.col("skill"), GROUPS).alias("skill_category")
    )


def _numbered(spark, sf_dir):
    raw = raw_jobs(spark, sf_dir).withColumn("job_id", F.when(F.col("location") != "de", F.col("job_id")))
    return sk.with_job_id(raw, "doc_id").select("doc_id", "job_id")


def _lexicon_only(spark, sf_dir):
    return sk.explode_job_skills(sk.merge_methods(_lexical(spark, sf_dir), None), GROUPS)


def _tech(spark, sf_dir):
    return sk.match_lexicon(raw_jobs(spark, sf_dir))


def _relative(spark, sf_dir):
    phrase = (
        F.when(F.col("event_type") == "click", F.concat(F.col("user_id").cast("string"), F.lit(" days ago")))
        .when(F.col("event_type") == "view", F.lit("recently"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
    )
    at = F.lit("2024-01-30").cast("date")
    return table(spark, sf_dir, "events").select(
        "event_id", resolve_relative_date(phrase, at).alias("publish_date")
    )


QUERIES = {
    "harmonize_columns": _harmonized,
    "union_sources": _stacked,
    "clean_text": _text_column(tx.clean_text, "description"),
    "truncate_text": _text_column(tx.truncate_text, "description"),
    "normalize_title": _text_column(cl.normalize_title, "title"),
    "standardize_company": _text_column(cl.standardize_company, "company"),
    "dedupe_by_url": lambda s, d: cl.dedupe_by_url(_stacked(s, d)).select("job_id", "url"),
    "dedupe_by_title_company": lambda s, d: cl.dedupe_by_title_company(_stacked(s, d)).select(
        "job_id", "title", "company"),
    "dedupe_report": lambda s, d: cl.dedupe_report(boards(s, d), _cleaned(s, d)),
    "clean_jobs": _cleaned,
    "summary_total": lambda s, d: cl.summary_total(_cleaned(s, d)),
    "summary_by_source": lambda s, d: cl.summary_by_source(_cleaned(s, d)),
    "summary_top_companies": lambda s, d: cl.summary_top_companies(_cleaned(s, d)),
    "summary_top_titles": lambda s, d: cl.summary_top_titles(_cleaned(s, d)),
    "summary_by_location": lambda s, d: cl.summary_by_location(_cleaned(s, d)),
    "resolve_relative_date": _relative,
    "scrub_text": lambda s, d: records(s, d).select(
        "doc_id", tx.scrub_text(F.col("job_description")).alias("job_description")),
    "map_title": lambda s, d: records(s, d).select(
        "doc_id", nz.map_title(F.col("job_title")).alias("job_title")),
    "standardize_skills": lambda s, d: records(s, d).select("doc_id", F.array_join(
        nz.standardize_skills(F.col("job_description"), F.col("skills")), ", ").alias("skills")),
    "normalize_record": lambda s, d: nz.normalize_record(records(s, d)).withColumn(
        "skills", F.array_join("skills", ", ")),
    "dedupe_by_key": lambda s, d: nz.dedupe_by_key(records(s, d), ["doc_id"]).select("doc_id"),
    "drop_failed_rows": lambda s, d: nz.drop_failed_rows(records(s, d).withColumn(
        "skills", F.when(F.col("location") == "es", F.array(F.lit(None).cast("string"))).otherwise(F.col("skills"))
    )).select("doc_id"),
    "validate_records": lambda s, d: nz.validate_records(nz.normalize_record(records(s, d))).select(
        "job_url", "external_job_id"),
    "normalize_records": _normalized,
    "normalize_report": lambda s, d: nz.normalize_report(records(s, d), ["doc_id"]),
    "match_lexicon": _lexical,
    "match_lexicon_by_join": _lexical_joined,
    "match_lexicon_tech": _tech,
    "split_sentences": lambda s, d: sk.split_sentences(raw_jobs(s, d)),
    "match_semantic": lambda s, d: _rounded(_semantic(s, d), "confidence"),
    "match_semantic_sentences": lambda s, d: _rounded(_semantic_sentences(s, d), "confidence"),
    "merge_methods": lambda s, d: _rounded(_merged(s, d), "confidence"),
    "skill_category": _categories,
    "explode_job_skills": _lexicon_only,
    "job_id_fallback": _numbered,
    "extraction_summary": lambda s, d: sk.extraction_summary(raw_jobs(s, d), _lexicon_only(s, d)),
    "top_skills": lambda s, d: sk.top_skills(_lexicon_only(s, d)),
    "skills_by_category": lambda s, d: sk.skills_by_category(_lexicon_only(s, d)),
    "extract_job_skills": lambda s, d: _rounded(_job_skills(s, d), "confidence_score"),
}


# ------------------------------------------------------------------- SQL twins

def _title_sql(x: str) -> str:
    title = sq.strip(x)
    changed = title
    for pattern, name in cl.TITLE_RULES:
        changed = sq.replace_word(changed, pattern, name)
    return f"coalesce(CASE WHEN {changed} = {title} THEN {sq.capitalized(title)} ELSE {changed} END, '')"


def _company_sql(x: str) -> str:
    name = f"CASE WHEN {x} IS NOT NULL THEN {sq.clean_text(x)} END"
    return f"CASE WHEN {name} IN ('Non spécifié', 'non spécifié', 'N/A', 'nan') THEN 'Not specified' ELSE {name} END"


_ORDER = "board, doc_id"
_CLEAN_SQL = f"""{RAW_SQL.strip()},
tidy AS (
  SELECT job_id, {_title_sql('title')} AS title, {_company_sql('company')} AS company, location, url,
         substr({sq.clean_text('description')}, 1, 5000) AS description, publish_date, source, scrape_date,
         board, doc_id FROM raw),
by_url AS (SELECT * FROM tidy QUALIFY row_number() OVER (PARTITION BY url ORDER BY {_ORDER}) = 1),
cleaned AS (
  SELECT * EXCLUDE (board, doc_id) FROM by_url
  QUALIFY row_number() OVER (PARTITION BY title, company ORDER BY {_ORDER}) = 1)
"""


def _skills_sql(text: str, given: str) -> str:
    pairs = ", ".join(f"'{k}': '{v}'" for k, v in nz.SKILL_NAMES.items())
    keys = ", ".join(f"'{k}'" for k in nz.SKILL_NAMES)
    lookup = f"MAP {{{pairs}}}"
    told = f"list_transform({given}, lambda s: coalesce({lookup}[lower(s)], s))"
    found = f"list_transform(list_filter([{keys}], lambda k: contains(lower({text}), k)), lambda k: {lookup}[k])"
    return f"array_to_string(list_sort(list_distinct(list_concat({told}, {found}))), ', ')"


def _map_title_sql(x: str) -> str:
    title = sq.scrub(x)
    whens = " ".join(
        f"WHEN regexp_matches({title}, '(?i){pattern}') THEN '{name}'" for pattern, name in nz.TITLE_MAP
    )
    return f"CASE {whens} ELSE {title} END"


def _choice_sql(x: str) -> str:
    return f"coalesce(nullif({sq.strip(x)}, ''), 'Non spécifié')"


_NORMALIZED = f"""SELECT {_map_title_sql('job_title')} AS job_title, {sq.scrub('job_description')} AS job_description,
  {sq.scrub('company_name')} AS company_name, {sq.scrub('location')} AS location,
  {_choice_sql('experience_level')} AS experience_level, {_choice_sql('contract_type')} AS contract_type,
  coalesce(job_url, '') AS job_url, coalesce(external_job_id, '') AS external_job_id, published_at,
  {_skills_sql('job_description', 'skills')} AS skills, salary_min, salary_max, salary_currency"""
_BY_KEY = """by_key AS (
  SELECT * FROM (SELECT *, coalesce(external_job_id, job_url, '') AS k FROM records) WHERE k <> ''
  QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id) = 1)"""


def _lexicon_sql() -> str:
    parts = []
    for skill, aliases in WORDS.items():
        whens = " ".join(
            f"WHEN {sq.has_word('low', a.replace(chr(92) + 'b', ''))} "
            f"THEN {sq.word_position('low', a.replace(chr(92) + 'b', ''))}" for a in aliases
        )
        parts.append(f"SELECT job_id, '{skill}' AS skill, CASE {whens} END AS position FROM lowered")
    return (
        f"lowered AS (SELECT job_id, lower(description) AS low FROM raw), "
        f"lexical AS (SELECT job_id, skill, CAST(position AS INTEGER) AS position FROM "
        f"({' UNION ALL '.join(parts)}) WHERE position IS NOT NULL)"
    )


_CATEGORY = """CASE WHEN skill IN ('the', 'of_the', 'with') THEN 'English'
  WHEN skill IN ('french', 'spanish') THEN 'Romance' WHEN skill = 'german' THEN 'German' ELSE 'Other' END"""
_WORD_ROWS = ", ".join(f"('{w}', {n})" for w, n in WORD_LABELS.items())
_SEMANTIC = f"""means AS (
  SELECT label, list(x ORDER BY pos) AS embedding FROM (
    SELECT label, pos, avg(CAST(x AS DOUBLE)) AS x FROM (
      SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings)
    GROUP BY label, pos) GROUP BY label),
semantic AS (
  SELECT raw.job_id, w.skill, max(list_cosine_similarity(CAST(s.embedding AS DOUBLE[]), m.embedding)) AS confidence
  FROM raw JOIN embeddings s ON raw.doc_id = s.vec_id
  CROSS JOIN (VALUES {_WORD_ROWS}) w(skill, n) JOIN means m ON m.label = w.n
  WHERE list_cosine_similarity(CAST(s.embedding AS DOUBLE[]), m.embedding) > {THRESHOLD}
  GROUP BY 1, 2)"""
_MERGED = """merged AS (
  SELECT job_id, skill, CAST(1.0 AS DOUBLE) AS confidence, position FROM lexical
  UNION ALL
  SELECT s.job_id, s.skill, s.confidence, CAST(instr(l.low, s.skill) - 1 AS INTEGER)
  FROM semantic s JOIN lowered l ON s.job_id = l.job_id
  WHERE NOT EXISTS (SELECT 1 FROM lexical x WHERE x.job_id = s.job_id AND x.skill = s.skill))"""
_EXPLODED = f"""SELECT job_id, skill AS skill_name, {_CATEGORY} AS skill_category,
  round(confidence, 6) AS confidence_score, greatest(position, -1) AS position_in_description,
  CASE WHEN confidence < 1 THEN 'bert' ELSE 'regex' END AS extraction_method"""

_LEX = f"WITH {RAW_SQL.strip()}, {_lexicon_sql()}"
_ALL = f"{_LEX}, {_SEMANTIC}, {_MERGED}"
_LEX_ROWS = f"{_LEX}, merged AS (SELECT *, CAST(1.0 AS DOUBLE) AS confidence FROM lexical), rows AS ({_EXPLODED} FROM merged)"
_RAW = f"WITH {RAW_SQL.strip()}"
_REC = f"WITH {RECORDS_SQL.strip()}"
_CLEAN = f"WITH {_CLEAN_SQL.strip()}"
_NINE = "job_id, title, company, location, url, description, publish_date, source, scrape_date"

ORACLES = {
    "harmonize_columns": f"{_RAW} SELECT {_NINE} FROM raw",
    "union_sources": f"{_RAW} SELECT {_NINE}, board AS source_order FROM raw",
    "clean_text": f"{_RAW} SELECT job_id, {sq.clean_text('description')} AS description FROM raw",
    "truncate_text": f"{_RAW} SELECT job_id, substr(description, 1, 5000) AS description FROM raw",
    "normalize_title": f"{_RAW} SELECT job_id, {_title_sql('title')} AS title FROM raw",
    "standardize_company": f"{_RAW} SELECT job_id, {_company_sql('company')} AS company FROM raw",
    "dedupe_by_url": f"""{_RAW} SELECT job_id, url FROM raw
QUALIFY row_number() OVER (PARTITION BY url ORDER BY {_ORDER}) = 1""",
    "dedupe_by_title_company": f"""{_RAW} SELECT job_id, title, company FROM raw
QUALIFY row_number() OVER (PARTITION BY title, company ORDER BY {_ORDER}) = 1""",
    "dedupe_report": f"""{_CLEAN} SELECT (SELECT count(*) FROM raw) AS rows_in, count(*) AS rows_out,
(SELECT count(*) FROM raw) - count(*) AS rows_removed FROM cleaned""",
    "clean_jobs": f"{_CLEAN} SELECT * FROM cleaned",
    "summary_total": f"{_CLEAN} SELECT count(*) AS total_jobs FROM cleaned",
    "summary_by_source": f"{_CLEAN} SELECT source, count(*) AS n FROM cleaned WHERE source IS NOT NULL GROUP BY 1",
    "summary_top_companies": f"""{_CLEAN} SELECT company, count(*) AS n FROM cleaned WHERE company IS NOT NULL
GROUP BY 1 ORDER BY n DESC, company LIMIT 10""",
    "summary_top_titles": f"""{_CLEAN} SELECT title, count(*) AS n FROM cleaned WHERE title IS NOT NULL
GROUP BY 1 ORDER BY n DESC, title LIMIT 10""",
    "summary_by_location": f"{_CLEAN} SELECT location, count(*) AS n FROM cleaned WHERE location IS NOT NULL GROUP BY 1",
    "resolve_relative_date": """SELECT event_id, CASE event_type
  WHEN 'click' THEN CAST(DATE '2024-01-30' - CAST(user_id AS INTEGER) AS DATE)
  WHEN 'view' THEN DATE '2024-01-30' ELSE CAST(ts AS DATE) END AS publish_date FROM events""",
    "scrub_text": f"{_REC} SELECT doc_id, {sq.scrub('job_description')} AS job_description FROM records",
    "map_title": f"{_REC} SELECT doc_id, {_map_title_sql('job_title')} AS job_title FROM records",
    "standardize_skills": f"{_REC} SELECT doc_id, {_skills_sql('job_description', 'skills')} AS skills FROM records",
    "normalize_record": f"{_REC} {_NORMALIZED} FROM records",
    "dedupe_by_key": f"{_REC}, {_BY_KEY} SELECT doc_id FROM by_key",
    "drop_failed_rows": f"{_REC} SELECT doc_id FROM records WHERE location <> 'es'",
    "validate_records": f"""{_REC}, n AS ({_NORMALIZED} FROM records)
SELECT job_url, external_job_id FROM n WHERE job_title <> '' AND job_description <> ''""",
    "normalize_records": f"""{_REC}, {_BY_KEY}, n AS ({_NORMALIZED} FROM by_key)
SELECT * FROM n WHERE job_title <> '' AND job_description <> ''""",
    "normalize_report": f"""{_REC}, {_BY_KEY}, n AS ({_NORMALIZED} FROM by_key)
SELECT (SELECT count(*) FROM records) AS input_rows, count(*) AS unique_rows, count(*) AS cleaned_rows,
       count(*) FILTER (WHERE job_title <> '' AND job_description <> '') AS valid_rows FROM n""",
    "match_lexicon": f"{_LEX} SELECT job_id, skill, position FROM lexical",
    "match_lexicon_by_join": f"{_LEX} SELECT job_id, skill, position FROM lexical",
    "split_sentences": f"""{_RAW}, s AS (SELECT job_id,
  unnest(regexp_split_to_array(description, '[.!?]+')) AS sentence,
  CAST(generate_subscripts(regexp_split_to_array(description, '[.!?]+'), 1) - 1 AS INTEGER) AS sentence_no FROM raw
  WHERE description <> '')
SELECT job_id, sentence_no, sentence FROM s WHERE length({sq.strip('sentence')}) >= 20""",
    "match_semantic": f"{_RAW}, {_SEMANTIC} SELECT job_id, skill, round(confidence, 6) AS confidence FROM semantic",
    "match_semantic_sentences": f"""{_RAW}, cut AS (SELECT job_id, unnest(regexp_split_to_array(description, '[.!?]+')) AS sentence,
  CAST(generate_subscripts(regexp_split_to_array(description, '[.!?]+'), 1) - 1 AS INTEGER) AS sentence_no
  FROM raw WHERE description <> ''),
told AS (SELECT job_id, (length(sentence) * 7 + sentence_no * 13) % (SELECT count(*) FROM embeddings) AS vec_id
  FROM cut WHERE length({sq.strip('sentence')}) >= 20),
means AS (SELECT label, list(x ORDER BY pos) AS middle FROM (
  SELECT label, pos, avg(CAST(x AS DOUBLE)) AS x FROM (
    SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY label, pos)
  GROUP BY label),
near AS (SELECT e.vec_id, w.skill, list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), m.middle) AS c
  FROM embeddings e, means m JOIN (VALUES {_WORD_ROWS}) w(skill, n) ON m.label = w.n)
SELECT job_id, skill, round(max(c), 6) AS confidence FROM told JOIN near USING (vec_id) WHERE c > {THRESHOLD} GROUP BY 1, 2""",
    "merge_methods": f"{_ALL} SELECT job_id, skill, round(confidence, 6) AS confidence, position FROM merged",
    "skill_category": f"{_LEX} SELECT job_id, skill, {_CATEGORY} AS skill_category FROM lexical",
    "explode_job_skills": f"{_LEX_ROWS} SELECT * FROM rows",
    "job_id_fallback": f"""{_RAW} SELECT doc_id,
CASE WHEN location <> 'de' THEN job_id ELSE 'job_' || doc_id END AS job_id FROM raw""",
    "extraction_summary": f"""{_LEX_ROWS} SELECT (SELECT count(*) FROM raw) AS total_jobs, count(*) AS total_rows,
count(DISTINCT skill_name) AS unique_skills, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM raw) AS avg_skills_per_job
FROM rows""",
    "top_skills": f"{_LEX_ROWS} SELECT skill_name, count(*) AS n FROM rows GROUP BY 1 ORDER BY n DESC, skill_name LIMIT 20",
    "skills_by_category": f"{_LEX_ROWS} SELECT skill_category, count(DISTINCT skill_name) AS unique_skills FROM rows GROUP BY 1",
    "extract_job_skills": f"{_ALL} {_EXPLODED} FROM merged",
}


def _tech_sql() -> str:
    from vacantia.functions.lexicon import SKILLS

    parts = []
    for skill, aliases in SKILLS.items():
        whens = []
        for alias in aliases:
            body = alias.replace("\\b", "")
            if "(?!" in body:
                # A whole word cannot be continued by the forbidden suffix.
                body = body.split("(?!")[0]
            if body in ("c\\+\\+", "c#"):
                # A boundary after a sign needs a word character behind it.
                whens.append(
                    f"WHEN regexp_matches(low, '(?:^|[^{sq.WORD}]){body}[{sq.WORD}]') "
                    f"THEN length(regexp_extract(low, '(?s)^((?:.*?[^{sq.WORD}])??){body}[{sq.WORD}]', 1))"
                )
            else:
                whens.append(f"WHEN {sq.has_word('low', body)} THEN {sq.word_position('low', body)}")
        parts.append(f"SELECT job_id, '{skill}' AS skill, CASE {' '.join(whens)} END AS position FROM lowered")
    return (
        f"{_RAW}, lowered AS (SELECT job_id, lower(description) AS low FROM raw) "
        f"SELECT job_id, skill, CAST(position AS INTEGER) AS position FROM ({' UNION ALL '.join(parts)}) "
        f"WHERE position IS NOT NULL"
    )


ORACLES["match_lexicon_tech"] = _tech_sql()
