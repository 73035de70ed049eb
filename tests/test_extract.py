from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from vacantia.functions import markup as mk
from vacantia.operators import extract as ex

PAGES = "page_id long, url string, html string"


def field(values, fn, page):
    return values(lambda c: fn(mk.without_hidden(c)), [page])[0]


def test_links(spark):
    html = ('<a href="/offre-emploi-1.html">Data <b>job</b></a><a href="/offre-emploi-2.html">ab</a>'
            '<a href="">long text</a><a href="/other">long text</a><a href="/offre_emploi-3">Data job</a>'
            "<a class=x href='/offre_emploi-4'>Third &amp; last</a><!-- <a href='/offre-emploi-9'>hidden</a> -->")
    links = ex.extract_links(spark.createDataFrame([(1, "u", html)], PAGES))
    assert [(r["href"], r["title"]) for r in links.orderBy("pos").collect()] == [
        ("/offre-emploi-1.html", "Data job"), ("/offre_emploi-3", "Data job"), ("/offre_emploi-4", "Third & last")]
    assert [r["href"] for r in ex.dedupe_links(links).orderBy("pos").collect()] == ["/offre-emploi-1.html", "/offre_emploi-4"]


def test_links_by_attribute_or_class(spark):
    pages = spark.createDataFrame([
        (1, "u", '<a data-jk="1" href="/a">x</a><a class="jobtitle turnstileLink" href="/b">y</a>'),
        (2, "u", '<a class="turnstileLink big jobtitle" href="/c">x</a><a class="jobtitle" href="/d">y</a>'),
    ], PAGES)
    rows = ex.extract_links_attr(pages).orderBy("page_id").collect()
    assert [(r["page_id"], r["href"]) for r in rows] == [(1, "/a"), (2, "/c")]


@pytest.mark.parametrize("base", ["https://board.example", "https://board.example/jobs/list.html?p=2"])
def test_resolve_url_like_the_standard_library(values, base):
    hrefs = ["/a/b", "a", "../x", "./y", "//cdn.example/z", "?q=1", "a/../b/./c?x=1#f", "/a/../../b", "http://o.example/x",
             "#top", "a/", "..", "mailto:x@y.example"]
    assert values(lambda c: ex.resolve_url(c, base), hrefs) == [urljoin(base, h) for h in hrefs]


def test_limit_follows_region_order(spark):
    one = spark.createDataFrame([(2, 0, "b"), (1, 0, "a")], "page_id long, pos int, href string")
    two = spark.createDataFrame([(1, 0, "c")], "page_id long, pos int, href string")
    rows = ex.limit_offers(ex.union_links([one, two]), 2).collect()
    assert sorted(r["href"] for r in rows) == ["a", "b"]


def test_heading(values):
    assert field(values, ex.heading, "<h1 class=a>Data &amp; <i>AI</i>\n lead</h1><h1>second one</h1>") == "Data & AI lead"
    assert field(values, ex.heading, "<h1>abcd</h1>") is None
    assert field(values, ex.heading, "<p>none</p>") is None


FEATURES = '<ul class="nav"><li>1 poste(s) sur Rabat et région</li></ul><ul class="x featureInfo">{}</ul>'


def test_location(values):
    def place(text, strict=False):
        page = FEATURES.format(f"<li>x</li><li>{text}</li>")
        return field(values, lambda p: ex.location_of(ex.feature_items(p), strict), page)

    assert place("1 poste(s) sur Casablanca et région - Maroc") == "Casablanca"
    assert place("2 postes sur <b>Kenitra</b> et région") == "Kenitra"
    assert place("2 postes sur Kenitra et région", strict=True) == "International"
    assert place("1 POSTE sur Oujda ET RÉGION", strict=True) == "Oujda"
    assert place("nothing") == "International"


def test_experience_and_contract(values):
    page = FEATURES.format("<li>3 ans</li><li>Confirmé (3 à 5 ans)</li><li>Junior</li>")
    assert field(values, lambda p: ex.experience_of(ex.feature_items(p)), page) == "Confirmé (3 à 5 ans)"
    assert field(values, lambda p: ex.experience_of(ex.feature_items(p)), "<p></p>") == ""
    tags = '<span class="tagContrat">Autre</span><span class="big tagContrat">CDI <b>x</b></span>'
    assert field(values, ex.contract_of, tags) == "CDI x"
    assert field(values, ex.contract_of, "<span>CDI</span>") == "Non spécifié"


def test_company(values):
    def company(page):
        return field(values, lambda p: ex.company_of(p, mk.page_text(p)), page)

    assert company('<meta property="og:title" content="[Acme &amp; Co] Data lead">') == "Acme & Co"
    assert company("<p>Entreprise :\nshort\nOffre longue\nReal Name Ltd\n</p>") == "Real Name Ltd"
    assert company('<meta property="og:title" content="no brackets">') == "Non spécifié"
    assert company('<meta property="og:title" content="[ ] Lead"><p>Entreprise :\nReal Name Ltd</p>') == ""


def test_sections(values):
    text = ("Intro line\nPoste :\nBuild pipelines\nab\n\nEntreprise : x\nSkipped\nPROFIL RECHERCHÉ\nPython\nContactez\nlost\n"
            "poste: again\nLast line")
    assert values(ex.sections_of, [text, "", "Poste :\n" + "x" * 4000]) == ["Build pipelines Python Last line", "", "x" * 3000]


def test_filters(spark):
    rows = spark.createDataFrame([
        ("Data Engineer", ""), ("Data Engineer", "software engineer"), ("Cook", "nothing"), ("AI lead", "testing"),
        ("Analyste", ""), ("Data", "x" * 3000 + " vente"), ("Database", ""), ("Développeur data", ""),
        ("Vendeur data", ""), ("data dévendeur", ""),
    ], "t string, d string")
    got = [(r[0], r[1]) for r in rows.select(
        ex.is_data_job(F.col("t"), F.col("d")), ex.is_strict_data_job(F.col("t"), F.col("d"))).collect()]
    assert got == [(True, True), (False, False), (False, False), (True, True), (False, True), (True, True),
                   (False, False), (False, False), (True, False), (True, True)]


INTL = ('<html><head><title>{head}</title></head><body><h1>Other</h1><h1 class="x JobInfoHeader-title-y">Data lead</h1>'
        '<div data-company-name="1"><a>Acme</a></div><div data-testid="job-location">Paris</div>'
        '<div id="jobDescriptionText"><div>One <div>two</div></div> three</div><div>outside</div>{foot}</body></html>')


def test_international_page(spark):
    pages = spark.createDataFrame([
        (3, "u3", INTL.format(head="Job", foot='<div class="a jobMetadataFooter">Posted\n30+ Days ago</div>')),
        (1, "u1", INTL.format(head="Security Verification", foot="")),
        (2, "u2", INTL.format(head="Job", foot='<div class="jobMetadataFooter">Just now</div>')),
        (4, "u4", "<h1>Data cook</h1>"),
    ], PAGES)
    rows = ex.parse_international(pages, "intl", F.lit("2024-01-01")).orderBy("job_id").collect()
    assert [(r["job_id"], r["url"], r["company"], r["location"], r["publish_date"]) for r in rows] == [
        ("intl_00001", "u2", "Acme", "Paris", "today/recently"),
        ("intl_00002", "u3", "Acme", "Paris", "30 days ago"),
        ("intl_00003", "u4", "Not specified", "International", "recently"),
    ]
    assert rows[0]["description"] == "One two three" and rows[2]["description"] == ""


def test_regional_page_falls_back(spark):
    pages = spark.createDataFrame([(1, "u", "<h1>Data analyst</h1>"), (2, "u", "<h1>Data developer</h1>")], PAGES)
    rows = ex.parse_regional(pages, "reg", F.lit("2024-01-01")).collect()
    assert len(rows) == 1 and rows[0]["job_id"] == "reg_00001"
    assert rows[0]["description"] == "Titre: Data analyst | Localisation: International | Expérience: "


def test_canonical_defaults(spark):
    df = spark.createDataFrame([(" A ", "7")], "job_title string, id string")
    row = ex.canonicalize_record(df, "src", F.lit("2024-01-01").cast("date")).first().asDict()
    assert row["job_title"] == "A" and row["external_job_id"] == "src_7" and str(row["published_at"]) == "2024-01-01"
    assert row["skills"] == [] and row["salary_currency"] is None and len(row) == 13


def test_pages_stay_out_of_python(spark):
    """Only the references of a text are decoded in Python, and as the standard library does."""
    import html

    from vacantia.functions import markup as mk

    texts = ["a &amp; b", "&lt;p&gt;&amp;amp;", "&notit; &eacute &#233;&#xE9 &#0; &#x110000; &;& &nosuch; x&", "", None, "plain", "&copy&copy;"]
    rows = spark.createDataFrame([(i, t, [t or "", "&lt;"]) for i, t in enumerate(texts)], "i int, t string, xs array<string>")
    got = rows.select("i", mk.decode_entities(F.col("t")).alias("t"), mk.decode_each(F.col("xs")).alias("xs")).orderBy("i").collect()
    assert [r["t"] for r in got] == [None if t is None else html.unescape(t) for t in texts]
    assert [r["xs"] for r in got] == [[html.unescape(t or ""), "<"] for t in texts]
    pages = rows.select(F.col("t").alias("page"))
    for found in (mk.decode_entities(F.col("page")), mk.marked_texts(F.col("page"), ex.MARKS)):
        plan = pages.select(found.alias("found"))._jdf.queryExecution().optimizedPlan().toString()
        sent = plan.split("ArrowEvalPython [")[1:]
        assert sent and all(s.startswith("_characters(array_distinct(") for s in sent)


def test_marked_elements(spark):
    from vacantia.functions import markup as mk

    pages = [
        '<div id="m"><div>a</div>b<DIV/>c</div>d</div>e', '<p ID="m"></p>x', '<b x="1" id="m">open &amp; <i>on</i> ', "none", None,
        '<div id="m"> t <divan>u</divan>&nbsp;</div>v', '<i id="m"><i><i></i></i></i>z', '<i id="k"></i><s id="m">y</s >q',
    ]
    rows = spark.createDataFrame(list(enumerate(pages)), "i int, p string")
    got = rows.select("i", mk.marked_texts(F.col("p"), [r'id\s*=\s*"m"', r'id\s*=\s*"k"']).alias("m")).orderBy("i").collect()
    assert [r["m"] for r in got] == [
        ["abcd", None], ["", None], ["open & on", None], [None, None], None, ["t u", None], ["", None], ["y", ""]]
