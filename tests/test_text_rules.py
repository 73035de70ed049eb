import datetime

from pyspark.sql import functions as F

from vacantia.functions import dates, markup as mk, text as tx
from vacantia.operators import clean as cl, normalize as nz


def test_clean_text_keeps_order_of_steps(values):
    got = values(tx.clean_text, ["  a \t\n b c ", "\x01 abc\x07", None, "", "a\x1fb", "x y"])
    assert got == ["a b c", " abc", "", "", "a b", "x y"]


def test_scrub_keeps_accents(values):
    assert values(tx.scrub_text, ["café crème!", "a-b.c (d) & e", "%%%", None]) == ["café crème", "a-b.c d  e", "", ""]


def test_strip_markup_deletes_references(values):
    got = values(tx.strip_markup, ["<b>a</b>&nbsp;b &amp; c", "1 < 2", None, "x&#233;y"])
    assert got == ["ab c", "1 < 2", "", "x&#233;y"]


def test_title_rules(values):
    got = values(cl.normalize_title, [
        "ml engineer", "AI Engineer", "chef de projet", "senior DATA scientist", "Data Scientist", None,
        "data scientist / data analyst", "machine learning   engineer", "html engineer", "  ßtraße  ÉCOLE ",
    ])
    assert got == [
        "Machine Learning Engineer", "Ai Engineer", "Chef De Projet", "senior Data Scientist", "Data Scientist", "",
        "Data Scientist / Data Analyst", "Machine Learning Engineer", "Html Engineer", "Sstraße École",
    ]


def test_company_rules(values):
    got = values(cl.standardize_company, ["Non spécifié", " N/A ", None, "Acme  Corp", "nan"])
    assert got == ["Not specified", "Not specified", None, "Acme Corp", "Not specified"]


def test_map_title_first_rule_wins(values):
    got = values(nz.map_title, [
        "Senior Data Scientist / Data Engineer", "machine learning lead", "BI developer", "Data Analytics Engineer",
        "Cook!", "python web developer",
    ])
    assert got == ["Data Scientist", "ML Engineer", "BI Developer", "Data Engineer", "Cook", "Python Developer"]


def test_standardize_skills_finds_substrings(spark):
    rows = spark.createDataFrame([("JavaScript and AWS", ["SPARK", "Cobol"]), (None, None)], "t string, s array<string>")
    got = [r[0] for r in rows.select(nz.standardize_skills(F.col("t"), F.col("s"))).collect()]
    assert got[0] == ["AWS", "Apache Spark", "Cobol", "Java", "R"]
    assert got[1] == []


def test_dates(spark, values):
    got = values(lambda c: dates.parse_lenient(c).cast("string"), [
        "3 days ago", "recently", "2024-01-02", "2024-01-02T03:04:05.123456", "2024-13-45", None])
    assert got == [None, None, "2024-01-02 00:00:00", "2024-01-02 03:04:05.123456", None, None]
    as_of = F.lit("2024-01-10").cast("timestamp")
    ages = values(lambda c: dates.age_in_days(as_of, dates.parse_lenient(c)),
                  ["2024-01-10 12:00:00", "2024-01-09", "2024-01-08 00:00:01", "soon"])
    assert ages == [-1, 1, 1, None]
    meant = values(lambda c: dates.resolve_relative_date(c, as_of),
                   ["3 days ago", "2 weeks ago", "today/recently", "2023-12-31", "5 Hours ago"])
    assert meant == [datetime.date(2024, 1, 7), datetime.date(2023, 12, 27), datetime.date(2024, 1, 10),
                     datetime.date(2023, 12, 31), datetime.date(2024, 1, 9)]


def test_page_text_drops_hidden_parts(values):
    page = ("<!DOCTYPE html><html><head><style>p{}</style><script>var t='</p>';</script></head>"
            "<body><!-- note --><p>A &eacute; &#66;</p>\n<p>C</p></body></html>")
    assert values(lambda c: mk.page_text(mk.without_hidden(c)), [page]) == ["A é B\nC"]
