"""The test tables seen as job-market tables.

``orders`` are jobs, ``lineitem`` x ``part`` their skills, ``customer`` the companies and
``nation`` the places; ``documents`` are raw postings; ``benchmark`` items are candidate
profiles; ``embeddings`` are description vectors.  Nothing is left out of any table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vacantia.functions import text as tx
from vacantia.plans.views import Star
from vacantia.session import parts_of, spread, stage

AS_OF = "2001-08-01"
SCRAPED_AT = "2024-01-31T00:00:00"


def as_of() -> Column:
    return F.lit(AS_OF).cast("date")


# Columns of the test tables; a given schema saves the job that would infer it.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    scan = spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")
    return spread(scan) if name in ("documents", "pages") else scan


def star(spark: SparkSession, sf_dir: str) -> Star:
    def t(name: str) -> DataFrame:
        return table(spark, sf_dir, name)

    companies = t("customer").join(
        t("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    ).select(
        F.col("c_custkey").alias("company_id"), F.col("c_name").alias("company_name"),
        F.col("c_mktsegment").alias("industry"), F.col("n_name").alias("country"),
    )
    locations = t("nation").join(
        t("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    ).select(
        F.col("n_nationkey").alias("location_id"), F.col("n_name").alias("location_name"),
        F.col("n_name").alias("country"),
        F.when(F.col("r_regionkey") != 0, F.col("r_name")).alias("region"),
    )
    skills = t("part").groupBy(F.col("p_name").alias("skill_name")).agg(
        F.min("p_partkey").alias("skill_id"), F.min("p_type").alias("skill_category")
    )
    published = F.col("o_orderdate").cast("date")
    jobs = t("orders").join(
        t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"), "left"
    ).select(
        F.col("o_orderkey").alias("job_id"), F.col("o_custkey").alias("company_id"),
        F.col("c_nationkey").alias("location_id"), F.col("o_orderpriority").alias("job_title"),
        F.lower("o_orderpriority").alias("job_title_normalized"),
        F.concat("o_orderstatus", F.lit(" "), "o_orderpriority").alias("description"),
        F.floor("o_totalprice").cast("int").alias("description_length"),
        published.alias("publish_date"), published.alias("scrape_date"),
        F.col("o_orderstatus").alias("source"),
        F.concat(F.lit("https://jobs.example/"), F.col("o_orderkey").cast("string")).alias("url"),
        F.datediff(as_of(), published).alias("job_posting_days_old"),
    )
    named = t("lineitem").select("l_orderkey", "l_partkey", "l_discount", "l_linenumber").join(
        t("part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey")
    )
    links = named.join(
        skills.select("skill_id", "skill_name"), F.col("p_name") == F.col("skill_name")
    ).groupBy(F.col("l_orderkey").alias("job_id"), "skill_id").agg(
        F.max(F.round(F.col("l_discount") * 100).cast("int")).alias("confidence_score"),
        F.min("l_linenumber").alias("position_in_description"),
    )
    return Star(companies, locations, skills, jobs, links, lambda: parts_of(spark, t("lineitem").count()))


STAR_SQL = f"""
dim_companies AS (
  SELECT c_custkey AS company_id, c_name AS company_name, c_mktsegment AS industry, n_name AS country
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
dim_locations AS (
  SELECT n_nationkey AS location_id, n_name AS location_name, n_name AS country,
         CASE WHEN r_regionkey <> 0 THEN r_name END AS region
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey),
dim_skills AS (
  SELECT min(p_partkey) AS skill_id, p_name AS skill_name, min(p_type) AS skill_category
  FROM part GROUP BY p_name),
fact_jobs AS (
  SELECT o_orderkey AS job_id, o_custkey AS company_id, c_nationkey AS location_id,
         o_orderpriority AS job_title, lower(o_orderpriority) AS job_title_normalized,
         o_orderstatus || ' ' || o_orderpriority AS description,
         CAST(floor(o_totalprice) AS INTEGER) AS description_length,
         CAST(o_orderdate AS DATE) AS publish_date, CAST(o_orderdate AS DATE) AS scrape_date,
         o_orderstatus AS source, 'https://jobs.example/' || o_orderkey AS url,
         CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}') AS INTEGER) AS job_posting_days_old
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
fact_job_skills AS (
  SELECT l_orderkey AS job_id, skill_id,
         max(CAST(round(l_discount * 100) AS INTEGER)) AS confidence_score,
         min(l_linenumber) AS position_in_description
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN dim_skills ON p_name = skill_name
  GROUP BY l_orderkey, skill_id)
"""


# ------------------------------------------------------------------ raw postings

def raw_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a raw posting of one of two boards (``board`` 0 or 1)."""
    first = F.split("text", "\n", 2)[0]
    title = (
        F.when(F.col("lang") == "de", F.concat(first, F.lit(" ml engineer")))
        .when(F.col("lang") == "es", F.concat(F.lit("DATA   ANALYST "), first))
        .otherwise(first)
    )
    company = (
        F.when(F.col("source") == "src0", F.lit("Non spécifié"))
        .when(F.col("source") == "src1", F.lit("  spaced  name "))
        .when(F.col("source") == "src2", F.lit(None).cast("string"))
        .otherwise(F.col("source"))
    )
    return table(spark, sf_dir, "documents").select(
        F.format_string("%s_%05d", "source", "doc_id").alias("job_id"),
        title.alias("title"), company.alias("company"), F.col("lang").alias("location"),
        F.concat(F.lit("https://jobs.example/"), F.md5(F.encode("text", "UTF-8"))).alias("url"),
        F.col("text").alias("description"),
        F.when(F.col("lang") == "en", F.lit("2024-01-02")).alias("publish_date"),
        "source", F.lit(SCRAPED_AT).alias("scrape_date"),
        F.when(F.col("lang") == "en", 0).otherwise(1).alias("board"), "doc_id",
    )


def boards(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The two boards; only the first has a publish date."""
    raw = raw_jobs(spark, sf_dir).drop("doc_id")
    return [
        raw.filter("board = 0").drop("board"),
        raw.filter("board = 1").drop("board", "publish_date"),
    ]


RAW_SQL = f"""
raw AS (
  SELECT format('{{}}_{{:05d}}', source, doc_id) AS job_id,
         CASE lang WHEN 'de' THEN string_split(text, chr(10))[1] || ' ml engineer'
                   WHEN 'es' THEN 'DATA   ANALYST ' || string_split(text, chr(10))[1]
                   ELSE string_split(text, chr(10))[1] END AS title,
         CASE source WHEN 'src0' THEN 'Non spécifié' WHEN 'src1' THEN '  spaced  name '
                     WHEN 'src2' THEN NULL ELSE source END AS company,
         lang AS location, 'https://jobs.example/' || md5(text) AS url, text AS description,
         CASE WHEN lang = 'en' THEN '2024-01-02' ELSE '{SCRAPED_AT}' END AS publish_date,
         source, '{SCRAPED_AT}' AS scrape_date,
         CASE WHEN lang = 'en' THEN 0 ELSE 1 END AS board, doc_id
  FROM documents)
"""


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a canonical record with its ``doc_id`` as arrival order."""
    raw = raw_jobs(spark, sf_dir)
    lang = F.col("location")
    return raw.select(
        "doc_id",
        F.when(lang == "es", F.concat(F.lit("Data science & "), F.col("title"))).otherwise(
            F.col("title")
        ).alias("job_title"),
        F.col("description").alias("job_description"),
        F.col("company").alias("company_name"), F.col("location"),
        F.when(lang == "en", F.lit(" Senior ")).when(lang == "fr", F.lit("  ")).alias("experience_level"),
        F.when(lang == "de", F.lit("CDI")).alias("contract_type"),
        F.col("url").alias("job_url"),
        F.when(lang == "fr", F.lit(None)).when(F.col("source") == "src3", F.lit("")).otherwise(
            F.concat("source", F.lit("_"), F.length("description").cast("string"))
        ).alias("external_job_id"),
        F.lit("2024-01-02").cast("date").alias("published_at"),
        F.array(lang, F.lit("SPARK"), F.lit("sql")).alias("skills"),
        F.length("description").cast("double").alias("salary_min"),
        F.lit(None).cast("double").alias("salary_max"),
        F.when(lang != "en", F.lit("USD")).alias("salary_currency"),
    )


RECORDS_SQL = f"""{RAW_SQL.strip()},
records AS (
  SELECT doc_id,
         CASE WHEN location = 'es' THEN 'Data science & ' || title ELSE title END AS job_title,
         description AS job_description, company AS company_name, location,
         CASE location WHEN 'en' THEN ' Senior ' WHEN 'fr' THEN '  ' END AS experience_level,
         CASE WHEN location = 'de' THEN 'CDI' END AS contract_type, url AS job_url,
         CASE WHEN location = 'fr' THEN NULL WHEN source = 'src3' THEN ''
              ELSE source || '_' || length(description) END AS external_job_id,
         DATE '2024-01-02' AS published_at, [location, 'SPARK', 'sql'] AS skills,
         CAST(length(description) AS DOUBLE) AS salary_min, CAST(NULL AS DOUBLE) AS salary_max,
         CASE WHEN location <> 'en' THEN 'USD' END AS salary_currency
  FROM raw)
"""


# ------------------------------------------------------- states of the market over time

def open_postings(spark: SparkSession, sf_dir: str, day: str) -> DataFrame:
    """The postings that are open on a day as records: ordered by then, and not yet shipped in full.

    What is paid is the range of prices of the items still to ship, and the size of a company follows
    its open postings, so both change from day to day.
    """
    at = F.lit(day).cast("date")
    left = table(spark, sf_dir, "lineitem").filter(F.col("l_shipdate").cast("date") > at).groupBy("l_orderkey").agg(
        F.min("l_extendedprice").alias("salary_min"), F.max("l_extendedprice").alias("salary_max"))
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderdate").cast("date") <= at)
    # Written once: the sizes and the postings both read it.
    live = stage(orders.join(left, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey", "o_totalprice"), "live")
    sizes = live.groupBy(F.col("o_custkey").alias("_c")).agg(F.count("*").alias("_n"))
    place = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    full = live.join(sizes, F.col("o_custkey") == F.col("_c")).join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(
        place, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return full.select(
        F.col("o_orderkey").cast("string").alias("external_job_id"), F.col("o_orderpriority").alias("job_title"),
        F.concat("o_orderstatus", F.lit(" "), "o_orderpriority").alias("job_description"), F.col("c_name").alias("company_name"),
        F.concat(F.lit("https://jobs.example/c"), F.col("c_custkey").cast("string")).alias("company_url"),
        F.when(F.col("_n") >= 8, "large").when(F.col("_n") >= 4, "medium").otherwise("small").alias("company_size"),
        F.col("c_mktsegment").alias("industry"), F.col("n_name").alias("location"),
        F.concat("n_name", F.lit(" city")).alias("city"), F.col("n_name").alias("country"), F.col("r_name").alias("region"),
        (F.col("n_nationkey") * 3.0 - 36).alias("latitude"), (F.col("n_nationkey") * 12.5 - 150).alias("longitude"),
        F.col("o_orderstatus").alias("source"), F.lit("board").alias("source_type"),
        F.concat(F.lit("https://"), "o_orderstatus", F.lit(".example")).alias("base_url"),
        F.lit(None).cast("string").alias("experience_level"), F.col("o_orderstatus").alias("contract_type"),
        "salary_min", "salary_max", F.lit("USD").alias("salary_currency"),
        F.concat(F.lit("https://jobs.example/"), F.col("o_orderkey").cast("string")).alias("job_url"),
        F.col("o_orderdate").cast("date").alias("published_at"),
    )


def open_postings_sql(day: str, name: str) -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT CAST(o_orderkey AS VARCHAR) AS external_job_id, o_orderpriority AS job_title, c_name AS company_name,
         CASE WHEN n >= 8 THEN 'large' WHEN n >= 4 THEN 'medium' ELSE 'small' END AS company_size,
         'https://jobs.example/c' || c_custkey AS company_url, n_name AS location, o_orderstatus AS source, salary_min, salary_max
  FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders JOIN (
          SELECT l_orderkey, min(l_extendedprice) AS salary_min, max(l_extendedprice) AS salary_max
          FROM lineitem WHERE CAST(l_shipdate AS DATE) > DATE '{day}' GROUP BY l_orderkey) ON o_orderkey = l_orderkey
        WHERE CAST(o_orderdate AS DATE) <= DATE '{day}')
  JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey)"""


# ----------------------------------------------------------------- stored pages

def _escaped(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def regional_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a page of the regional layout; French ones without ``og:title``."""
    doc = raw_jobs(spark, sf_dir)
    lang = F.col("location")
    title = F.concat(F.lit("Data job "), _escaped(F.regexp_replace("title", "[\"\\n]", "")))
    meta = F.when(
        lang != "fr",
        F.concat(F.lit('<meta property="og:title" content="['), F.col("source"), F.lit('] Data job">')),
    ).otherwise(F.lit(""))
    place = F.when(
        lang != "es", F.concat(F.lit("<li>3 poste(s) sur "), lang, F.lit(" ville et région - Maroc</li>"))
    ).otherwise(F.lit(""))
    level = F.when(lang == "de", F.lit("<li>Confirmé (3 à 5 ans)</li>")).otherwise(F.lit(""))
    return doc.select(
        F.col("doc_id").alias("page_id"), "url",
        F.concat(
            F.lit("<!DOCTYPE html><html><head><title>Offre</title>"), meta,
            F.lit("<style>p{margin:0}</style></head><body><h1>"), title,
            F.lit('</h1><ul class="nav"><li>x</li></ul><ul class="featureInfo">'), place, level,
            F.lit('</ul><span class="tagContrat">CDI - plein temps</span>\n<p>Entreprise :\nof\n'),
            F.col("source"), F.lit(" holding</p>\n<h2>Poste :</h2>\n<p>"), _escaped(F.col("description")),
            F.lit("</p>\n<h2>Profil recherché :</h2>\n<p>Profile of "), F.col("source"),
            F.lit("</p>\n<h2>Avantages</h2>\n<p>not kept</p></body></html>"),
        ).alias("html"),
    )


def international_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a page of the international layout."""
    doc = raw_jobs(spark, sf_dir)
    lang = F.col("location")
    footer = (
        F.when(lang == "en", F.concat(
            F.lit('<div class="x jobMetadataFooter-y">Posted '), F.length("description").cast("string"),
            F.lit(" Days ago</div>")))
        .when(lang == "fr", F.lit('<div class="jobMetadataFooter">Just posted</div>'))
        .otherwise(F.lit(""))
    )
    body = F.when(lang == "de", F.lit('<div class="big jobsearch-jobDescriptionText">')).otherwise(
        F.lit('<div id="jobDescriptionText">')
    )
    company = F.when(lang != "es", F.concat(
        F.lit('<div data-company-name="true"><a href="/c">'), F.col("source"), F.lit("</a></div>")
    )).otherwise(F.lit(""))
    title = F.concat(F.lit("AI role "), _escaped(F.regexp_replace("title", "\\n", "")))
    return doc.select(
        F.col("doc_id").alias("page_id"), "url",
        F.concat(
            F.lit("<html><head><title>"),
            F.when(F.col("source") == "src4", F.lit("Security Verification")).otherwise(F.lit("Job")),
            F.lit('</title></head><body><h1>Board</h1><h1 class="a JobInfoHeader-title b">'), title,
            F.lit("</h1>"), company,
            F.when(lang != "fr", F.concat(
                F.lit('<div data-testid="job-location">'), lang, F.lit("</div>")
            )).otherwise(F.lit("")),
            body, F.lit("<div><p>"), _escaped(F.col("description")),
            F.lit("</p></div><div>End of text.</div></div><div>Other part</div>"), footer,
            F.lit("</body></html>"),
        ).alias("html"),
    )


# ------------------------------------------------------------------- candidates

def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding")


def ranked_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its vector, where one is stored."""
    v = vectors(spark, sf_dir)
    raw = raw_jobs(spark, sf_dir)
    return raw.join(v, raw["doc_id"] == v["vec_id"], "left").select(
        "job_id", "title", "company", "location", "url", "source", "description", "publish_date",
        "scrape_date", "embedding", "doc_id",
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item as a profile: its words are the skills, its vector the text's."""
    item = table(spark, sf_dir, "benchmark")
    v = vectors(spark, sf_dir)
    place = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("_d"), F.col("lang").alias("location"))
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(f"([{tx.WORD}]+)"), 1))
    return (
        item.join(v, item["item_id"] == v["vec_id"], "left")
        .join(place, item["item_id"] == place["_d"], "left")
        .select(
            F.concat(F.lit("cand_"), F.col("item_id").cast("string")).alias("name"),
            F.array_sort(words).alias("skills"), F.lit("5 years").alias("experience"),
            F.lit(None).cast("string").alias("interests"), "embedding", "location",
        )
    )


RANK_SQL = f"""{RAW_SQL.strip()},
jobs AS (
  SELECT raw.*, CAST(embedding AS DOUBLE[]) AS embedding
  FROM raw LEFT JOIN embeddings ON doc_id = vec_id),
candidates AS (
  SELECT 'cand_' || item_id AS name,
         list_sort(list_distinct(regexp_extract_all(lower(b.text), '[\\p{{L}}\\p{{N}}_]+'))) AS skills,
         '5 years' AS experience, CAST(NULL AS VARCHAR) AS interests,
         CAST(embedding AS DOUBLE[]) AS embedding, lang AS location
  FROM benchmark b LEFT JOIN embeddings ON item_id = vec_id
                   LEFT JOIN documents d ON item_id = d.doc_id)
"""
