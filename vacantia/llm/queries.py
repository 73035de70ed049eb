"""Registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vacantia.llm import codes, containment, dart, hosts, nnpu, packing, phrases, pieces, pivots, revisits, suffixes, tokens, whitening
from vacantia.session import scratch_path

QUERIES: dict = {}
ORACLES: dict = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query
def op4_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return phrases.remove_repeated_phrases(docs, with_text=False)


@query
def op1_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart.near_duplicates(read(spark, sf_dir, "documents"))


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op2_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "planes")
    tokens.write_planes(read(spark, sf_dir, "documents"), path, tokenizer())
    return tokens.read_documents(spark, path).withColumnRenamed("id", "doc_id")


@query
def op6_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nnpu.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.judge_hosts(read(spark, sf_dir, "documents")).withColumn("host_rules", F.array_join("host_rules", ","))


@query
def op10_cutting_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), tokenizer())


@query
def op5_pivot_permutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_vectors(read(spark, sf_dir, "embeddings"))


@query
def op9_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeated_bytes(read(spark, sf_dir, "documents"))


@query
def op3_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = revisits.resolve_revisits(revisits.captures_of_pages(read(spark, sf_dir, "pages")))
    header = lambda name: F.col("headers")[name]
    return out.select(
        "record_id", "canonical_url", "captured", "status", "response_id", "response_captured",
        header("content-type").alias("content_type"), header("content-length").alias("content_length"),
        header("date").alias("date"), header("cache-control").alias("cache_control"), header("etag").alias("etag"),
    )


ORACLES["op3_revisits"] = r"""
WITH cut AS (
  SELECT page_id, octet_length(encode(html)) AS size,
         regexp_replace(url, '^([a-z]+://[^/]+/[A-Za-z]+)/[0-9]+[^?#]*', '\1') AS url
  FROM pages
), bare AS (
  SELECT page_id, size, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM cut
), split AS (
  SELECT page_id, size, regexp_replace(bare, '\?.*$', '') AS path, regexp_extract(bare, '\?(.*)$', 1) AS asked FROM bare
), named AS (
  SELECT page_id, size,
         regexp_replace(regexp_replace(lower(regexp_extract(path, '^([^/]*)', 1)), ':(80|443)$', ''), '^www\.', '')
         || regexp_replace(regexp_replace(path, '^[^/]*', ''), '/+$', '') AS place,
         list_sort(list_filter(string_split(asked, '&'),
           lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[a-z]+|ref|gclid|fbclid|sessionid)(=|$)'))) AS parts
  FROM split
), captures AS (
  SELECT page_id AS record_id, page_id * 60 AS captured, page_id % 3 = 0 AS full_response, CAST(size AS VARCHAR) AS size,
         place || CASE WHEN len(parts) > 0 THEN '?' || array_to_string(parts, '&') ELSE '' END AS canonical_url
  FROM named
), marked AS (
  SELECT *, md5(canonical_url || ' ' || CAST(record_id // 200 AS VARCHAR)) AS digest,
         CASE WHEN record_id % 5 <> 0 THEN md5(canonical_url || ' ' || CAST(record_id // 200 AS VARCHAR)) END AS etag,
         CASE WHEN record_id % 7 <> 0 THEN 'day ' || CAST(record_id // 200 AS VARCHAR) END AS modified
  FROM captures
), matched AS (
  SELECT v.*, r.record_id AS response_id, r.captured AS response_captured, r.size AS stored_size, r.etag AS stored_etag,
         CASE WHEN r.record_id IS NULL THEN 'missing'
              WHEN CASE WHEN v.etag IS NOT NULL AND r.etag IS NOT NULL THEN v.etag = r.etag
                        WHEN v.modified IS NOT NULL AND r.modified IS NOT NULL THEN v.modified = r.modified
                        ELSE v.digest = r.digest END THEN 'resolved' ELSE 'mismatch' END AS status
  FROM (SELECT * FROM marked WHERE NOT full_response) v
  ASOF LEFT JOIN (SELECT * FROM marked WHERE full_response) r
    ON v.canonical_url = r.canonical_url AND v.captured > r.captured
)
SELECT record_id, canonical_url, captured, status, response_id, response_captured,
       CASE WHEN status = 'resolved' THEN 'text/html' END AS content_type,
       CASE WHEN status = 'resolved' THEN stored_size END AS content_length,
       CASE WHEN status = 'resolved' THEN CAST(record_id AS VARCHAR) END AS date,
       CASE WHEN status = 'resolved' THEN 'max-age=' || CAST(record_id % 600 AS VARCHAR) END AS cache_control,
       CASE WHEN status = 'resolved' THEN coalesce(stored_etag, '') END AS etag
FROM matched
"""


@query
def op7_suffix_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pieces.encode_pieces(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op11_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(read(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").cast("long"))


@query
def op12_adaptive_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.encode_vectors(read(spark, sf_dir, "embeddings"))


@query
def op13_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = containment.contaminated_words(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        containment.digest_of_items(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLES["op13_prefix_join"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS uid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item, size, array_to_string(words[s:s + size - 1], ' ') AS win
  FROM (SELECT item, words, least(10, len(words)) AS size FROM items WHERE len(words) > 0), unnest(range(1, len(words) - size + 2)) AS t(s)
), doc_windows AS (
  SELECT uid, s, size, array_to_string(words[s:s + size - 1], ' ') AS win
  FROM docs, (SELECT DISTINCT size FROM item_windows), unnest(range(1, len(words) - size + 2)) AS t(s)
), found AS (
  SELECT uid, s, w.size, item FROM doc_windows w JOIN item_windows i ON w.win = i.win AND w.size = i.size
), hits AS (
  SELECT uid, count(DISTINCT word) AS n_hit FROM (SELECT DISTINCT uid, s, size FROM found), unnest(range(s, s + size)) AS t(word) GROUP BY uid
), owners AS (
  SELECT uid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT uid, item FROM found) GROUP BY uid
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (uid) LEFT JOIN owners USING (uid)
"""


def _codes_sql(rounds: int = codes.ROUNDS, entries: int = codes.ENTRIES) -> str:
    """Every round of the codebooks by comparing all parts with all entries."""
    nearest = """
SELECT uid, p, min({{'d': square - 2 * list_inner_product(x, e) + list_inner_product(e, e), 'entry': entry}}) AS best
FROM parts JOIN book{r} USING (p) GROUP BY uid, p"""
    means = """
SELECT p, entry, list(mean ORDER BY i) AS e FROM (
  SELECT p, best.entry AS entry, i, floor(sum(x[i]) / count(*)) AS mean
  FROM near{r} JOIN parts USING (uid, p), unnest(range(1, len(x) + 1)) AS t(i) GROUP BY ALL) GROUP BY p, entry"""
    steps = []
    for r in range(rounds):
        steps += [
            f"near{r} AS MATERIALIZED ({nearest.format(r=r)})", f"mean{r} AS MATERIALIZED ({means.format(r=r)})",
            f"book{r + 1} AS MATERIALIZED (SELECT b.p, b.entry, coalesce(m.e, b.e) AS e FROM book{r} b LEFT JOIN mean{r} m USING (p, entry))",
        ]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS uid, vec_id, label,
         list_transform(embedding, lambda c: floor(1024 * CAST(c AS DOUBLE))) AS v
  FROM embeddings WHERE len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(embedding) > 0
), parts AS MATERIALIZED (
  SELECT uid, p, x, list_inner_product(x, x) AS square
  FROM (SELECT uid, p, v[p * len(v) // 4 + 1:(p + 1) * len(v) // 4] AS x FROM kept, unnest(range(4)) AS t(p))
), book0 AS MATERIALIZED (SELECT p, uid - 1 AS entry, x AS e FROM parts WHERE uid <= {entries}),
{', '.join(steps)},
near{rounds} AS MATERIALIZED ({nearest.format(r=rounds)}),
coded AS (SELECT uid, string_agg(printf('%02x', best.entry), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM near{rounds} GROUP BY uid),
sealed AS (
  SELECT sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY p, entry, i)) AS codebooks_sha256
  FROM (SELECT p, entry, unnest(e) AS c, unnest(range(len(e))) AS i FROM book{rounds}))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded USING (uid), sealed
"""


ORACLES["op12_adaptive_codes"] = _codes_sql()


def _hosts_sql() -> str:
    rule = {
        "words": "n_words < 50", "repeats": "100 * n_repeat_words > 50 * n_words", "symbols": "10 * n_symbols > n_words",
        "lines": "20 * n_dup_lines > n_words"}
    failed = ", ".join(f"count(*) FILTER (WHERE {r}) AS f_{n}" for n, r in rule.items())
    mean = ", ".join(f"sum(f_{n}) / sum(docs) AS m_{n}, coalesce(var_samp(f_{n} / docs), 0) AS v_{n}" for n in rule)
    weight = ", ".join(
        f"CASE WHEN m_{n} * (1 - m_{n}) > v_{n} - m_{n} * (1 - m_{n}) * inverse AND v_{n} - m_{n} * (1 - m_{n}) * inverse > 0 "
        f"THEN m_{n} * (1 - m_{n}) / (v_{n} - m_{n} * (1 - m_{n}) * inverse) - 1 ELSE total END AS w_{n}" for n in rule)
    over = ", ".join(
        f"CASE WHEN (f_{n} + m_{n} * w_{n}) / (docs + w_{n}) - {hosts.CERTAIN} * sqrt((f_{n} + m_{n} * w_{n}) / (docs + w_{n}) "
        f"* (1 - (f_{n} + m_{n} * w_{n}) / (docs + w_{n})) / (docs + w_{n} + 1)) > m_{n} + {hosts.MARGIN} THEN '{n}' END" for n in rule)
    return rf"""
WITH texts AS (
  SELECT row_number() OVER () AS uid, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT uid, i, count(*) OVER (PARTITION BY uid, w[i], w[i + 1], w[i + 2]) AS n FROM texts, unnest(range(1, len(w) - 1)) AS t(i)
), repeated AS (
  SELECT uid, count(DISTINCT place) AS n FROM (SELECT uid, unnest([i, i + 1, i + 2]) AS place FROM windows WHERE n > 1) GROUP BY uid
), lines AS (
  SELECT uid, count(*) - count(DISTINCT line) AS n FROM (SELECT uid, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY uid
), base AS (
  SELECT uid, doc_id, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words
  FROM texts LEFT JOIN lines USING (uid) LEFT JOIN repeated USING (uid)
), by_host AS (
  SELECT source, CAST(count(*) AS DOUBLE) AS docs, {failed} FROM base WHERE source IS NOT NULL GROUP BY source
), moments AS (SELECT sum(docs) AS total, avg(1 / docs) AS inverse, {mean} FROM by_host
), priors AS (SELECT *, {weight} FROM moments
), verdicts AS (SELECT source, array_to_string(list_filter([{over}], lambda r: r IS NOT NULL), ',') AS host_rules FROM by_host, priors)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, coalesce(host_rules, '') AS host_rules,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND coalesce(host_rules, '') = '' AS kept
FROM base LEFT JOIN verdicts USING (source)
"""


ORACLES["op8_host_rules"] = _hosts_sql()
