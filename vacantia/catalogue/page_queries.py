"""Extraction from stored pages: the page table itself, and pages built from documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia.catalogue import sqltext as sq
from vacantia.functions import markup as mk
from vacantia.functions import text as tx
from vacantia.operators import extract as ex
from vacantia.plans.standin import (
    RAW_SQL, SCRAPED_AT, international_pages, raw_jobs, records, regional_pages, table,
)

MARKS = ["/"]
BASE = "https://board.example/jobs/list?p=2"


def _pages(spark, sf_dir):
    return table(spark, sf_dir, "pages")


def _links(spark, sf_dir):
    return ex.extract_links(_pages(spark, sf_dir), MARKS)


def _attr_pages(spark, sf_dir):
    """English pages carry the data attribute, German ones the class, the others neither."""
    html = F.col("html")
    marked = (
        F.when(html.contains('<html lang="en"'), F.replace(html, F.lit('<a href'), F.lit('<a data-jk="1" href')))
        .when(html.contains('<html lang="de"'),
              F.replace(html, F.lit('<a href'), F.lit('<a class="x turnstileLink jobtitle" href')))
        .otherwise(html)
    )
    return _pages(spark, sf_dir).withColumn("html", marked)


def _regions(spark, sf_dir):
    english = F.col("html").contains('<html lang="en"')
    pages = _pages(spark, sf_dir)
    return ex.union_links([
        ex.extract_links(pages.filter(~english), MARKS), ex.extract_links(pages.filter(english), MARKS),
    ])


def _resolved(spark, sf_dir):
    links = _links(spark, sf_dir)
    href = (
        F.when(F.col("page_id").cast("string").endswith("1"), F.concat(F.lit(".."), F.col("href")))
        .when(F.col("page_id").cast("string").endswith("2"), F.expr("substring(href, 2)"))
        .when(F.col("page_id").cast("string").endswith("3"), F.concat(F.lit("https://other.example"), F.col("href")))
        .when(F.col("page_id").cast("string").endswith("4"), F.concat(F.lit("?q="), F.expr("substring(href, 2)")))
        .when(F.col("page_id").cast("string").endswith("5"), F.concat(F.lit("/"), F.col("href")))
        .otherwise(F.col("href"))
    )
    return links.select("page_id", "pos", ex.resolve_url(href, BASE).alias("url"))


def _on_regional(make):
    def run(spark, sf_dir):
        pages = regional_pages(spark, sf_dir).select("page_id", mk.without_hidden(F.col("html")).alias("page"))
        return pages.withColumn("text", mk.page_text(F.col("page"))).select("page_id", *make())
    return run


def _on_international(make):
    def run(spark, sf_dir):
        pages = international_pages(spark, sf_dir).select("page_id", mk.without_hidden(F.col("html")).alias("page"))
        return pages.select("page_id", ex.intl_elements(F.col("page")).alias("found")).select("page_id", *make())
    return run


def _fallback(spark, sf_dir):
    raw = raw_jobs(spark, sf_dir)
    text = F.when(F.col("location") == "en", F.col("description")).otherwise(F.lit(""))
    level = F.when(F.col("location") == "de", F.lit("Senior")).otherwise(F.lit(""))
    return raw.select("doc_id", ex.fallback_description(text, F.col("title"), F.col("location"), level).alias("description"))


def _filters(spark, sf_dir):
    return raw_jobs(spark, sf_dir).select(
        "doc_id",
        ex.is_data_job(F.col("title"), F.col("description")).alias("broad"),
        ex.is_strict_data_job(F.col("title"), F.col("description")).alias("strict"),
    )


def _strict(spark, sf_dir):
    """Pages of the regional layout that pass the strict filter, by their own text."""
    pages = regional_pages(spark, sf_dir).select("page_id", mk.without_hidden(F.col("html")).alias("page"))
    read = pages.select("page_id", ex.heading(F.col("page")).alias("title"), mk.page_text(F.col("page")).alias("text"))
    return read.filter(ex.is_strict_data_job(F.col("title"), F.col("text"))).select("page_id", "title")


def _ids(spark, sf_dir):
    return ex.assign_job_id(
        raw_jobs(spark, sf_dir).select("source", "doc_id"), order="doc_id"
    ).select("doc_id", "source", "job_id")


def _routed(spark, sf_dir):
    valid = (F.length("job_title") >= 20) & F.col("experience_level").isNotNull()
    return ex.route_valid_rows(records(spark, sf_dir), valid).select("doc_id", "route")


def _canonical(spark, sf_dir):
    raw = records(spark, sf_dir).withColumnRenamed("doc_id", "id").drop("salary_max", "published_at")
    return ex.canonicalize_record(raw, "board", F.lit("2024-01-31").cast("date")).withColumn(
        "skills", F.array_join("skills", ", ")
    )


QUERIES = {
    "extract_links": _links,
    "extract_links_attr": lambda s, d: ex.extract_links_attr(_attr_pages(s, d)),
    "dedupe_links": lambda s, d: ex.dedupe_links(_links(s, d)),
    "resolve_url": _resolved,
    "union_links": _regions,
    "limit_offers": lambda s, d: ex.limit_offers(_regions(s, d), 100),
    "strip_html": lambda s, d: _pages(s, d).select("page_id", tx.strip_markup(F.col("html")).alias("text")),
    "page_text": lambda s, d: _pages(s, d).select("page_id", tx.collapse(mk.page_text(mk.without_hidden(F.col("html")))).alias("text")),
    "extract_title": lambda s, d: _pages(s, d).select("page_id", ex.heading(mk.without_hidden(F.col("html"))).alias("title")).filter(
        F.col("title").isNotNull()),
    "reject_challenge_pages": lambda s, d: international_pages(s, d).select(
        "page_id", ex.intl_title(mk.without_hidden(F.col("html"))).alias("title"),
        ex.page_title(F.col("html")).alias("head"),
    ).filter(~ex.is_challenge(F.col("head"), F.col("title"))).select("page_id", "title"),
    "extract_location": _on_regional(lambda: [
        ex.location_of(ex.feature_items(F.col("page"))).alias("location"),
        ex.location_of(ex.feature_items(F.col("page")), strict=True).alias("location_strict"),
    ]),
    "extract_location_intl": _on_international(lambda: [ex.intl_location(F.col("found")).alias("location")]),
    "extract_experience": _on_regional(lambda: [ex.experience_of(ex.feature_items(F.col("page"))).alias("experience")]),
    "extract_company": _on_regional(lambda: [ex.company_of(F.col("page"), F.col("text")).alias("company")]),
    "extract_company_intl": _on_international(lambda: [ex.intl_company(F.col("found")).alias("company")]),
    "extract_contract": _on_regional(lambda: [ex.contract_of(F.col("page")).alias("contract")]),
    "extract_sections": _on_regional(lambda: [ex.sections_of(F.col("text")).alias("description")]),
    "fallback_description": _fallback,
    "extract_description_by_id": _on_international(lambda: [
        ex.cut_description(ex.intl_description(F.col("found"))).alias("description")]),
    "relative_age": _on_international(lambda: [ex.relative_age(F.col("found")).alias("publish_date")]),
    "is_data_job": _filters,
    "is_strict_data_job": _strict,
    "assign_job_id": _ids,
    "route_valid_rows": _routed,
    "canonicalize_record": _canonical,
    "parse_regional": lambda s, d: ex.parse_regional(regional_pages(s, d), "regional", F.lit(SCRAPED_AT)),
    "parse_international": lambda s, d: ex.parse_international(
        international_pages(s, d), "international", F.lit(SCRAPED_AT)),
}


# ------------------------------------------------------------------- SQL twins

_RAW = f"WITH {RAW_SQL.strip()}"
_SHOWN = "regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '(?is)<!doctype[^>]*>', '', 'g')"
_VISIBLE = (
    f"regexp_replace({_SHOWN}, '(?is)<script(\\s[^>]*)?>.*?</script\\s*>|<style(\\s[^>]*)?>.*?</style\\s*>', '', 'g')"
)


def _bare(x: str) -> str:
    return sq.unescape(f"regexp_replace({x}, '<[^>]+>', '', 'g')")


_LINKS = f"""anchors AS (
  SELECT page_id, html, unnest(regexp_extract_all({_VISIBLE}, '(?is)<a\\s[^>]*>.*?</a\\s*>')) AS a,
         generate_subscripts(regexp_extract_all({_VISIBLE}, '(?is)<a\\s[^>]*>.*?</a\\s*>'), 1) - 1 AS pos FROM pages),
links AS (
  SELECT page_id, CAST(pos AS INTEGER) AS pos, html LIKE '%<html lang="en"%' AS english,
         html LIKE '%<html lang="de"%' AS german,
         {sq.strip(sq.unescape("regexp_extract(a, 'href=\"([^\"]*)\"', 1)"))} AS href,
         {sq.strip_markup(_bare('a'))} AS title FROM anchors),
offers AS (SELECT * FROM links WHERE href <> '' AND length(title) >= 3 AND contains(href, '/'))"""
_ON_LINKS = f"WITH {_LINKS}"
_REGION = "CASE WHEN english THEN 1 ELSE 0 END AS region_no"

# Lines of a regional page after the heading, with the section rules applied in SQL.
_SECTIONS = f"""lines AS (
  SELECT doc_id, unnest(string_split(description, chr(10))) AS line,
         generate_subscripts(string_split(description, chr(10)), 1) AS pos FROM raw
  UNION ALL SELECT doc_id, 'Poste :', -1 FROM raw
  UNION ALL SELECT doc_id, 'Profil recherché :', 1000000 FROM raw
  UNION ALL SELECT doc_id, 'Profile of ' || source, 1000001 FROM raw
  UNION ALL SELECT doc_id, 'Avantages', 1000002 FROM raw),
cleaned_lines AS (SELECT doc_id, pos, {sq.strip_markup('line')} AS line FROM lines),
flagged AS (
  SELECT *, CASE WHEN contains(lower(line), 'poste :') OR contains(lower(line), 'poste:') THEN 1
                 WHEN contains(lower(line), 'profil') AND contains(lower(line), 'recherch') THEN 1
                 WHEN contains(lower(line), 'entreprise :') OR contains(lower(line), 'avantage')
                   OR contains(lower(line), 'culture') OR contains(lower(line), 'candidature')
                   OR contains(lower(line), 'processus') OR contains(lower(line), 'contact')
                   OR contains(lower(line), 'nos offres') OR contains(lower(line), 'emplois') THEN 0 END AS mark
  FROM cleaned_lines),
carried AS (SELECT *, last_value(mark IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY pos) AS state FROM flagged),
sections AS (
  SELECT doc_id AS page_id,
         substr(coalesce(string_agg(line, ' ' ORDER BY pos)
           FILTER (WHERE mark IS NULL AND state = 1 AND length(line) > 3), ''), 1, 3000) AS description
  FROM carried GROUP BY doc_id)"""

_REGIONAL_TITLE = sq.strip_markup("'Data job ' || regexp_replace(title, '[\"\\n]', '', 'g')")
_REGIONAL_PLACE = "CASE WHEN location <> 'es' THEN location || ' ville' ELSE 'International' END"
_REGIONAL_COMPANY = "CASE WHEN location <> 'fr' THEN source ELSE source || ' holding' END"
_INTL_TITLE = sq.strip("'AI role ' || regexp_replace(title, '\\n', '', 'g')")
_INTL_TEXT = sq.strip("description || 'End of text.'")
_INTL_COMPANY = "CASE WHEN location <> 'es' THEN source ELSE 'Not specified' END"
_INTL_PLACE = "CASE WHEN location <> 'fr' THEN location ELSE 'International' END"
_INTL_DATE = """CASE location WHEN 'en' THEN length(description) || ' days ago' WHEN 'fr' THEN 'today/recently'
  ELSE 'recently' END"""


def _filter(patterns_in, patterns_out, text):
    return (
        f"(NOT {sq.has_word(text, '|'.join(patterns_out))} AND {sq.has_word(text, '|'.join(patterns_in))})"
    )


_BROAD = _filter(ex.BROAD_INCLUDE, ex.BROAD_EXCLUDE, "lower(title || ' ' || description)")
_STRICT = _filter(ex.STRICT_INCLUDE, ex.STRICT_EXCLUDE, "lower(title || ' ' || substr(description, 1, 3000))")

# What the text of a regional page starts with, up to its description.
_PAGE_TEXT = """'Offre' || 'Data job ' || regexp_replace(title, '["\\n]', '', 'g') || 'x'
 || CASE WHEN location <> 'es' THEN '3 poste(s) sur ' || location || ' ville et région - Maroc' ELSE '' END
 || CASE WHEN location = 'de' THEN 'Confirmé (3 à 5 ans)' ELSE '' END
 || 'CDI - plein temps' || chr(10) || 'Entreprise :' || chr(10) || 'of' || chr(10) || source || ' holding' || chr(10)
 || 'Poste :' || chr(10) || description || chr(10) || 'Profil recherché :' || chr(10) || 'Profile of ' || source
 || chr(10) || 'Avantages' || chr(10) || 'not kept'"""

ORACLES = {
    "extract_links": f"{_ON_LINKS} SELECT page_id, pos, href, title FROM offers",
    "extract_links_attr": f"{_ON_LINKS} SELECT page_id, pos, href FROM links WHERE (english OR german) AND href <> ''",
    "dedupe_links": f"""{_ON_LINKS} SELECT page_id, pos, href, title FROM offers
QUALIFY row_number() OVER (PARTITION BY title ORDER BY page_id, pos) = 1""",
    "resolve_url": f"""{_ON_LINKS} SELECT page_id, pos, CASE CAST(page_id AS VARCHAR)[-1]
  WHEN '1' THEN 'https://board.example' || href
  WHEN '2' THEN 'https://board.example/jobs/' || substr(href, 2)
  WHEN '3' THEN 'https://other.example' || href
  WHEN '4' THEN 'https://board.example/jobs/list?q=' || substr(href, 2)
  WHEN '5' THEN 'https:/' || href
  ELSE 'https://board.example' || href END AS url FROM offers""",
    "union_links": f"{_ON_LINKS} SELECT page_id, pos, href, title, {_REGION} FROM offers",
    "limit_offers": f"""{_ON_LINKS} SELECT page_id, pos, href, title, {_REGION} FROM offers
ORDER BY region_no, page_id, pos LIMIT 100""",
    "strip_html": f"SELECT page_id, {sq.strip_markup('html')} AS text FROM pages",
    "page_text": f"SELECT page_id, {sq.collapse(_bare(_VISIBLE))} AS text FROM pages",
    "extract_title": f"""SELECT page_id, title FROM (SELECT page_id,
  {sq.strip_markup(_bare(f"regexp_extract({_VISIBLE}, '(?is)<h1[^>]*>(.*?)</h1', 1)"))} AS title FROM pages)
WHERE length(title) >= 5""",
    "reject_challenge_pages": f"""{_RAW} SELECT doc_id AS page_id, {_INTL_TITLE} AS title FROM raw
WHERE source <> 'src4' AND NOT contains(lower(title), 'verification')""",
    "extract_location": f"""{_RAW} SELECT doc_id AS page_id, {_REGIONAL_PLACE} AS location,
  'International' AS location_strict FROM raw""",
    "extract_location_intl": f"{_RAW} SELECT doc_id AS page_id, {_INTL_PLACE} AS location FROM raw",
    "extract_experience": f"""{_RAW} SELECT doc_id AS page_id,
CASE WHEN location = 'de' THEN 'Confirmé (3 à 5 ans)' ELSE '' END AS experience FROM raw""",
    "extract_company": f"{_RAW} SELECT doc_id AS page_id, {_REGIONAL_COMPANY} AS company FROM raw",
    "extract_company_intl": f"{_RAW} SELECT doc_id AS page_id, {_INTL_COMPANY} AS company FROM raw",
    "extract_contract": f"{_RAW} SELECT doc_id AS page_id, 'CDI - plein temps' AS contract FROM raw",
    "extract_sections": f"{_RAW}, {_SECTIONS} SELECT page_id, description FROM sections",
    "fallback_description": f"""{_RAW} SELECT doc_id, CASE WHEN location = 'en' AND description <> '' THEN description
ELSE 'Titre: ' || title || ' | Localisation: ' || location || ' | Expérience: '
  || CASE WHEN location = 'de' THEN 'Senior' ELSE '' END END AS description FROM raw""",
    "extract_description_by_id": f"{_RAW} SELECT doc_id AS page_id, substr({_INTL_TEXT}, 1, 5000) AS description FROM raw",
    "relative_age": f"{_RAW} SELECT doc_id AS page_id, {_INTL_DATE} AS publish_date FROM raw",
    "is_data_job": f"{_RAW} SELECT doc_id, {_BROAD} AS broad, {_STRICT} AS strict FROM raw",
    "is_strict_data_job": f"""{_RAW}, p AS (SELECT doc_id, {_REGIONAL_TITLE} AS title, {_PAGE_TEXT} AS text FROM raw)
SELECT doc_id AS page_id, title FROM p
WHERE {_filter(ex.STRICT_INCLUDE, ex.STRICT_EXCLUDE, "lower(title || ' ' || substr(text, 1, 3000))")}""",
    "assign_job_id": """SELECT doc_id, source, format('{}_{:05d}', source,
row_number() OVER (PARTITION BY source ORDER BY doc_id)) AS job_id FROM documents""",
    "parse_regional": f"""{_RAW}, {_SECTIONS}, p AS (
  SELECT doc_id, url, {_REGIONAL_TITLE} AS title, {_REGIONAL_COMPANY} AS company, {_REGIONAL_PLACE} AS location,
         {_PAGE_TEXT} AS text FROM raw),
kept AS (
  SELECT * FROM p WHERE length(title) >= 5
    AND {_filter(ex.STRICT_INCLUDE, ex.STRICT_EXCLUDE, "lower(title || ' ' || substr(text, 1, 3000))")})
SELECT format('regional_{{:05d}}', row_number() OVER (ORDER BY doc_id)) AS job_id, title, company, location, url,
  description, 'regional' AS source, '{SCRAPED_AT}' AS scrape_date
FROM kept JOIN sections ON doc_id = page_id""",
    "parse_international": f"""{_RAW}, p AS (
  SELECT doc_id, url, {_INTL_TITLE} AS title, {_INTL_COMPANY} AS company, {_INTL_PLACE} AS location,
         {_INTL_TEXT} AS description, {_INTL_DATE} AS publish_date, source FROM raw),
kept AS (
  SELECT * FROM p WHERE source <> 'src4' AND NOT contains(lower(title), 'verification')
    AND {_filter(ex.BROAD_INCLUDE, ex.BROAD_EXCLUDE, "lower(title || ' ' || description)")})
SELECT format('international_{{:05d}}', row_number() OVER (ORDER BY doc_id)) AS job_id, title, company, location, url,
  substr(description, 1, 5000) AS description, publish_date, 'international' AS source, '{SCRAPED_AT}' AS scrape_date
FROM kept""",
}


def _record_oracles() -> dict[str, str]:
    from vacantia.plans.standin import RECORDS_SQL

    head = f"WITH {RECORDS_SQL.strip()}"

    def trimmed(c: str) -> str:
        return f"{sq.strip(f'coalesce({c}, {chr(39) * 2})')} AS {c}"

    texts = ("job_title", "job_description", "company_name", "location", "experience_level", "contract_type")
    return {
        "route_valid_rows": f"""{head} SELECT doc_id, CASE WHEN length(job_title) >= 20 AND experience_level IS NOT NULL
THEN 'data' ELSE 'error' END AS route FROM records""",
        "canonicalize_record": f"""{head} SELECT {', '.join(trimmed(c) for c in texts)}, job_url,
  coalesce(external_job_id, 'board_' || doc_id) AS external_job_id, DATE '2024-01-31' AS published_at,
  array_to_string(skills, ', ') AS skills, salary_min, CAST(NULL AS DOUBLE) AS salary_max, salary_currency FROM records""",
    }


ORACLES.update(_record_oracles())
