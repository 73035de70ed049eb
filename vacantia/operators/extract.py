"""Postings out of stored pages.

Input is a table of pages; each function adds columns or explodes links.  Two page
layouts are known: the ``regional`` board (feature list, section headings) and the
``international`` board (elements found by id, class or data attribute).

Functions of a page take its visible markup (``markup.without_hidden``), which callers
compute once per page.
"""

from __future__ import annotations

from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, functions as F

from vacantia.functions import markup as mk
from vacantia.functions import text as tx
from vacantia.operators.rows import keep_first, number_rows
from vacantia.session import stage

# ---------------------------------------------------------------- fixed values
LINK_MARKS = ["offre-emploi", "offre_emploi"]
LINK_ATTRIBUTE = "data-jk"
LINK_CLASSES = ["jobtitle", "turnstileLink"]

BROAD_INCLUDE = [
    r"data", r"machine\s+learning", r"ml", r"ai", r"artificial\s+intelligence",
    r"data\s+science", r"data\s+engineer", r"data\s+analyst", r"scientist",
]
BROAD_EXCLUDE = [
    r"software\s+engineer", r"developer", r"développeur", r"frontend", r"backend",
    r"fullstack", r"devops", r"qa", r"test",
]
STRICT_INCLUDE = [
    r"data", r"machine\s+learning", r"ml", r"ai", r"artificial\s+intelligence",
    r"data\s+science", r"data\s+engineer", r"data\s+analyst", r"analyste", r"scientist",
]
STRICT_EXCLUDE = [
    r"software\s+engineer", r"developer", r"développeur", r"frontend", r"backend",
    r"fullstack", r"devops", r"sysadmin", r"infrastructure", r"security", r"cybersecurity",
    r"qa", r"test", r"qa\s+automation", r"react", r"vue", r"angular", r"node", r"caissier",
    r"vend[e]?ur", r"commercial", r"vente",
]

DEFAULT_LOCATION = "International"
NO_COMPANY_REGIONAL = "Non spécifié"
NO_COMPANY_INTERNATIONAL = "Not specified"
PLACE_PATTERN = r"(?:poste\(s\)|postes?)\s+sur\s+(.+?)\s+et\s+région"
PLACE_PATTERN_STRICT = r"(?:poste\(s\)|postes?)\s+sur\s+([^e]+)\s+et\s+région"
LEVEL_WORDS = ["confirmé", "junior", "senior", "expert", "ans"]
LEVEL_PATTERN = r"(?:Confirmé|Junior|Senior|Expert|Débutant)(?:\s+\([^)]+\))?"
COMPANY_HEADING = "Entreprise :"
COMPANY_SKIP = ["candidature", "contacter", "appliquer", "postuler", "emploi", "offre"]
CONTRACT_WORDS = ["CDI", "CDD", "Freelance", "Stage", "Télétravail"]
SECTION_STOPS = [
    "entreprise :", "avantage", "culture", "candidature", "processus", "contact",
    "nos offres", "emplois",
]
AGE_PATTERN = r"(\d+).*?(day|week|month|hour)"
# ------------------------------------------------------------------------------


def _space(pattern: str) -> str:
    return pattern.replace(r"\s", f"[{tx.SPACE}]")


# --------------------------------------------------------------------- links

def extract_links(pages: DataFrame, marks: list[str] | None = None) -> DataFrame:
    """``(page_id, pos, href, title)`` of every offer link, in page order."""
    anchors = pages.select(
        "page_id", F.posexplode(mk.elements(mk.without_hidden(F.col("html")), "a")).alias("pos", "a")
    )
    links = anchors.select(
        "page_id", "pos",
        tx.strip(mk.decode_entities(mk.attribute(mk.opening(F.col("a")), "href"))).alias("href"),
        mk.element_text(F.col("a")).alias("title"),
    )
    return links.filter(
        (F.length("href") > 0) & (F.length("title") >= 3)
        & tx.contains_any(F.col("href"), marks or LINK_MARKS)
    )


def extract_links_attr(
    pages: DataFrame, name: str = LINK_ATTRIBUTE, classes: list[str] | None = None
) -> DataFrame:
    """Links whose anchor carries attribute ``name``; without any, links of a class."""
    anchors = mk.elements(mk.without_hidden(F.col("html")), "a")
    marked = pages.select("page_id", anchors.alias("anchors")).select(
        "page_id",
        F.filter("anchors", lambda a: mk.attribute(mk.opening(a), name).isNotNull()).alias("first"),
        F.filter(
            "anchors", lambda a: mk.has_class(a, *(classes or LINK_CLASSES))
        ).alias("second"),
    )
    chosen = F.when(F.size("first") > 0, F.col("first")).otherwise(F.col("second"))
    hrefs = marked.select("page_id", F.posexplode(chosen).alias("pos", "a")).select(
        "page_id", "pos", mk.decode_entities(mk.attribute(mk.opening(F.col("a")), "href")).alias("href")
    )
    return hrefs.filter(F.length("href") > 0)


def dedupe_links(links: DataFrame) -> DataFrame:
    """First link per anchor text over the whole run."""
    return keep_first(links, ["title"], ["page_id", "pos"])


def resolve_url(href: Column, base: str) -> Column:
    """Relative links joined to ``base``; links starting with ``http`` are kept."""
    parts = urlsplit(base)
    origin = f"{parts.scheme}://{parts.netloc}"
    folder = parts.path.rsplit("/", 1)[0] + "/"
    path = F.regexp_extract(href, r"^([^?#]*)", 1)
    tail = F.regexp_extract(href, r"(?s)^[^?#]*(.*)$", 1)
    full = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(folder), path))
    last = F.element_at(F.split(full, "/"), -1)
    walked = F.aggregate(
        F.split(full, "/"),
        F.array().cast("array<string>"),
        lambda acc, seg: F.when(seg == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1))))
        .when(seg == ".", acc)
        .otherwise(F.concat(acc, F.array(seg))),
    )
    walked = F.when(last.isin(".", ".."), F.concat(walked, F.array(F.lit("")))).otherwise(walked)
    joined = F.concat(F.lit(origin), F.array_join(walked, "/"), tail)
    return (
        F.when(href.startswith("http"), href)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(F.lit(parts.scheme + ":"), href))
        .when(href == "", F.lit(base))
        .when(href.startswith("?"), F.concat(F.lit(origin + parts.path), href))
        .when(href.startswith("#"), F.concat(F.lit(base.split("#")[0]), href))
        .otherwise(joined)
    )


def union_links(regions: list[DataFrame]) -> DataFrame:
    """Link lists of several regions under each other, in the order given."""
    out = None
    for number, links in enumerate(regions):
        part = links.withColumn("region_no", F.lit(number))
        out = part if out is None else out.unionByName(part)
    return out


def limit_offers(links: DataFrame, max_offers: int = 100) -> DataFrame:
    """The first ``max_offers`` links in region, page and page order."""
    return links.orderBy("region_no", "page_id", "pos").limit(max_offers)


# -------------------------------------------------------------------- filters

def is_data_job(title: Column, description: Column) -> Column:
    """Broad filter; an exclusion always wins."""
    both = F.lower(F.concat(title, F.lit(" "), F.coalesce(description, F.lit(""))))
    return ~both.rlike(tx.any_word(BROAD_EXCLUDE)) & both.rlike(tx.any_word(BROAD_INCLUDE))


def is_strict_data_job(title: Column, page: Column) -> Column:
    """Strict filter over the title and the first 3000 characters of the page text."""
    head = F.substring(F.coalesce(page, F.lit("")), 1, 3000)
    both = F.lower(F.concat(title, F.lit(" "), head))
    return ~both.rlike(tx.any_word(STRICT_EXCLUDE)) & both.rlike(tx.any_word(STRICT_INCLUDE))


def page_title(page: Column) -> Column:
    return F.coalesce(mk.first_match(page, r"(?is)<title[^>]*>(.*?)</title"), F.lit(""))


def is_challenge(head: Column, title: Column) -> Column:
    """The page title or the heading asks for a verification."""
    return F.lower(head).contains("verification") | F.lower(
        F.coalesce(title, F.lit(""))
    ).contains("verification")


# --------------------------------------------------------- regional board fields

def _first_heading(page: Column) -> Column:
    return F.try_element_at(mk.elements(page, "h1"), F.lit(1))


def heading(page: Column) -> Column:
    """Text of the first ``h1``; null if it has fewer than five characters."""
    text = mk.element_text(_first_heading(page))
    return F.when(F.length(text) >= 5, text)


def feature_items(page: Column) -> Column:
    """Cleaned ``li`` texts of the first ``ul.featureInfo``."""
    lists = F.filter(mk.elements(page, "ul"), lambda u: mk.has_class(u, "featureInfo"))
    items = F.transform(
        mk.elements(F.try_element_at(lists, F.lit(1)), "li"),
        lambda li: F.regexp_replace(mk.inner(li), "<[^>]+>", ""),
    )
    return F.transform(mk.decode_each(items), tx.strip_markup)


def location_of(items: Column, strict: bool = False) -> Column:
    """Place named in the first matching list item, else ``International``.

    ``strict`` keeps a pattern that cannot match names containing an "e".
    """
    pattern = "(?iu)" + _space(PLACE_PATTERN_STRICT if strict else PLACE_PATTERN)
    hit = F.try_element_at(F.filter(items, lambda s: s.rlike(pattern)), F.lit(1))
    place = tx.strip_markup(F.regexp_extract(hit, pattern, 1))
    return F.when(hit.isNotNull(), place).otherwise(F.lit(DEFAULT_LOCATION))


def experience_of(items: Column) -> Column:
    pattern = _space(LEVEL_PATTERN)
    hit = F.filter(
        items, lambda s: tx.contains_any(F.lower(s), LEVEL_WORDS) & s.rlike(pattern)
    )
    first = F.try_element_at(hit, F.lit(1))
    return F.coalesce(tx.collapse(F.regexp_extract(first, pattern, 0)), F.lit(""))


def company_of(page: Column, text: Column) -> Column:
    """Bracketed name of the ``og:title`` tag, else the line below the company heading."""
    metas = F.regexp_extract_all(page, F.lit(r"(?is)(<meta\s[^>]*>)"), 1)
    og = F.try_element_at(
        F.filter(metas, lambda m: mk.attribute(m, "property") == "og:title"), F.lit(1)
    )
    content = mk.decode_entities(mk.attribute(og, "content"))
    bracketed = _space(r"^\[([^\]]+)\]\s+.")
    named = tx.strip_markup(F.regexp_extract(content, bracketed, 1))
    start = F.instr(text, COMPANY_HEADING)
    window = F.substring(text, start + len(COMPANY_HEADING), F.lit(300))
    lines = F.transform(F.split(window, "\n"), tx.strip_markup)
    fitting = F.filter(
        lines,
        lambda s: (F.length(s) > 5) & (F.length(s) < 150)
        & ~tx.contains_any(F.lower(s), COMPANY_SKIP),
    )
    below = F.when(start > 0, F.try_element_at(fitting, F.lit(1)))
    chosen = F.when(content.rlike(bracketed) & (named != NO_COMPANY_REGIONAL), named)
    return F.coalesce(chosen, below, F.lit(NO_COMPANY_REGIONAL))


def contract_of(page: Column) -> Column:
    """Text of the first contract tag that names a known contract."""
    tags = F.filter(mk.elements(page, "span"), lambda s: mk.has_class(s, "tagContrat"))
    texts = F.transform(
        mk.decode_each(F.transform(tags, lambda s: F.regexp_replace(mk.inner(s), "<[^>]+>", ""))),
        tx.strip_markup,
    )
    hit = F.filter(texts, lambda s: tx.contains_any(s, CONTRACT_WORDS))
    return F.coalesce(F.try_element_at(hit, F.lit(1)), F.lit(NO_COMPANY_REGIONAL))


def sections_of(text: Column) -> Column:
    """Lines below the job and profile headings, joined by spaces, first 3000 characters.

    The carry-forward is done inside the row: heading lines are turned into paragraph
    breaks flagged ``+`` (wanted) or ``-`` (not wanted), the page is cut at those breaks
    and the wanted parts are kept.  No shuffle and no window over a page's lines.
    """
    lines = F.filter(F.transform(F.split(text, "\n"), tx.strip_markup), lambda s: F.length(s) > 0)

    def flag(line: Column) -> Column:
        low = F.lower(line)
        return (
            F.when(low.rlike("poste ?:|profil.*recherch|recherch.*profil"), F.lit("\n+"))
            .when(tx.contains_any(low, SECTION_STOPS), F.lit("\n-"))
            .otherwise(line)
        )

    flagged = F.concat(F.array(F.lit("-")), F.transform(lines, flag))
    parts = F.filter(F.split(F.array_join(flagged, "\n"), "\n\n"), lambda p: p.startswith("+"))
    kept = F.filter(
        F.flatten(F.transform(parts, lambda p: F.split(F.substring(p, 3, 1 << 30), "\n"))),
        lambda s: F.length(s) > 3,
    )
    return F.substring(F.array_join(kept, " "), 1, 3000)


def fallback_description(description: Column, title: Column, location: Column, level: Column) -> Column:
    return F.when(
        F.length(description) == 0,
        F.format_string("Titre: %s | Localisation: %s | Expérience: %s", title, location, level),
    ).otherwise(description)


# ---------------------------------------------------- international board fields

# Marks of the elements in an opening tag (fixed values).
COMPANY_MARK = r"data-company-name"
LOCATION_MARK = r"""data-testid\s*=\s*["']job-location["']"""
DESCRIPTION_MARK = r"""id\s*=\s*["']jobDescriptionText["']"""
DESCRIPTION_CLASS_MARK = r"""class\s*=\s*["'](?:[^"']*\s)?jobsearch-jobDescriptionText(?:\s[^"']*)?["']"""
FOOTER_MARK = r"""class\s*=\s*["'][^"']*jobMetadataFooter[^"']*["']"""
TITLE_MARK = r"""class\s*=\s*["'][^"']*JobInfoHeader-title[^"']*["']"""
MARKS = [
    COMPANY_MARK, LOCATION_MARK, DESCRIPTION_MARK, DESCRIPTION_CLASS_MARK, FOOTER_MARK,
]


def intl_elements(page: Column) -> Column:
    """Texts of the marked elements of a page, in the order of ``MARKS``."""
    return mk.marked_texts(page, MARKS)


def intl_title(page: Column) -> Column:
    """The titled header, else any ``h1``; null if empty."""
    header = mk.first_match(page, rf"(?is)<h1\s(?:[^>]*\s)?{TITLE_MARK}[^>]*>(.*?)</h1")
    plain = mk.first_match(page, r"(?is)<h1(?:\s[^>]*)?>(.*?)</h1")
    text = tx.strip(mk.bare_text(F.coalesce(header, plain)))
    return F.when(F.length(text) > 0, text)


def intl_company(elements: Column) -> Column:
    return F.coalesce(elements[0], F.lit(NO_COMPANY_INTERNATIONAL))


def intl_location(elements: Column) -> Column:
    return F.coalesce(elements[1], F.lit(DEFAULT_LOCATION))


def intl_description(elements: Column) -> Column:
    """Element by id, else by class, else ""; whole text (cut with :func:`cut_description`)."""
    return F.coalesce(elements[2], elements[3], F.lit(""))


def cut_description(description: Column) -> Column:
    return F.substring(description, 1, 5000)


def relative_age(elements: Column) -> Column:
    """``N units ago`` from the footer, else ``today/recently``; no footer: ``recently``."""
    footer = F.lower(elements[4])
    phrase = F.concat(
        F.regexp_extract(footer, AGE_PATTERN, 1), F.lit(" "),
        F.regexp_extract(footer, AGE_PATTERN, 2), F.lit("s ago"),
    )
    return (
        F.when(footer.isNull(), F.lit("recently"))
        .when(footer.rlike(AGE_PATTERN), phrase)
        .otherwise(F.lit("today/recently"))
    )


# ----------------------------------------------------------------- whole boards

def assign_job_id(df: DataFrame, source: str = "source", order: str = "page_id") -> DataFrame:
    """``<source>_<5 digits>`` per source in arrival order; page numbers may repeat or be missing.

    Parsed rows are staged once, ranged and numbered; nothing is joined back on the page number.
    """
    return number_rows(stage(df, "parsed"), [order], [source], "_no").withColumn(
        "job_id", F.format_string("%s_%05d", F.col(source), F.col("_no"))
    ).drop("_no")


def _visible(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", "html", mk.without_hidden(F.col("html")).alias("page"))


def parse_regional(pages: DataFrame, source: str, scraped_at: Column) -> DataFrame:
    """Accepted postings of the regional layout, without ``publish_date``."""
    page = F.col("page")
    read = _visible(pages).select(
        "page_id", "url", "page", heading(page).alias("title"), mk.page_text(page).alias("text"),
    )
    wanted = read.filter(
        F.col("title").isNotNull() & is_strict_data_job(F.col("title"), F.col("text"))
    )
    fields = wanted.select(
        "page_id", "url", "title", company_of(page, F.col("text")).alias("company"),
        feature_items(page).alias("items"), sections_of(F.col("text")).alias("description"),
    ).withColumn("location", location_of(F.col("items")))
    described = fields.withColumn(
        "description",
        fallback_description(
            F.col("description"), F.col("title"), F.col("location"), experience_of(F.col("items"))
        ),
    )
    named = assign_job_id(described.drop("items").withColumn("source", F.lit(source)))
    return named.select(
        "job_id", "title", "company", "location", "url", "description", "source",
        scraped_at.cast("string").alias("scrape_date"),
    )


def parse_international(pages: DataFrame, source: str, scraped_at: Column) -> DataFrame:
    """Accepted postings of the international layout."""
    page, found = F.col("page"), F.col("found")
    read = _visible(pages).select(
        "page_id", "url", intl_title(page).alias("title"), page_title(F.col("html")).alias("head"),
        intl_elements(page).alias("found"),
    ).withColumn("description", intl_description(found))
    wanted = read.filter(
        F.col("title").isNotNull() & ~is_challenge(F.col("head"), F.col("title"))
        & is_data_job(F.col("title"), F.col("description"))
    ).withColumns({
        "company": intl_company(found), "location": intl_location(found),
        "publish_date": relative_age(found),
    })
    fields = wanted.select(
        "page_id", "url", "title", "company", "location",
        cut_description(F.col("description")).alias("description"), "publish_date",
        F.lit(source).alias("source"),
    )
    return assign_job_id(fields).select(
        "job_id", "title", "company", "location", "url", "description", "publish_date", "source",
        scraped_at.cast("string").alias("scrape_date"),
    )


# -------------------------------------------------------------- arriving records

def route_valid_rows(df: DataFrame, valid: Column) -> DataFrame:
    """Tag each row ``data`` or ``error`` (null counts as an error)."""
    return df.withColumn("route", F.when(valid, F.lit("data")).otherwise(F.lit("error")))


def canonicalize_record(df: DataFrame, source_name: str, today: Column) -> DataFrame:
    """The 13-field canonical record; absent columns take their defaults."""
    have = set(df.columns)

    def get(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in have else F.lit(None).cast(kind)

    def trimmed(name: str) -> Column:
        return tx.strip(F.coalesce(get(name, "string"), F.lit(""))).alias(name)

    own_id = F.concat(F.lit(source_name + "_"), F.coalesce(get("id", "string"), F.lit("")))
    return df.select(
        *[trimmed(c) for c in (
            "job_title", "job_description", "company_name", "location",
            "experience_level", "contract_type",
        )],
        F.coalesce(get("job_url", "string"), F.lit("")).alias("job_url"),
        F.coalesce(get("external_job_id", "string"), own_id).alias("external_job_id"),
        F.coalesce(get("published_at", "date"), today).alias("published_at"),
        F.coalesce(get("skills", "array<string>"), F.array().cast("array<string>")).alias("skills"),
        get("salary_min", "double").alias("salary_min"),
        get("salary_max", "double").alias("salary_max"),
        get("salary_currency", "string").alias("salary_currency"),
    )
