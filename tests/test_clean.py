from vacantia.operators import clean as cl, normalize as nz
from vacantia.schemas import CLEAN_COLUMNS

NINE = ", ".join(f"{c} string" for c in CLEAN_COLUMNS)
EIGHT = ", ".join(f"{c} string" for c in CLEAN_COLUMNS if c != "publish_date")


def posting(job_id, title="t", company="c", url="u", text="d"):
    return (job_id, title, company, "x", url, text, "2024-01-01", job_id.split("_")[0], "2024-01-31")


def without_date(row):
    return row[:6] + row[7:]


def ids(df):
    return sorted(r["job_id"] for r in df.collect())


def test_harmonize_fills_publish_date(spark):
    df = spark.createDataFrame([without_date(posting("b_00001"))], EIGHT)
    row = cl.harmonize_columns(df).first()
    assert row.asDict()["publish_date"] == "2024-01-31" and list(row.asDict()) == CLEAN_COLUMNS


def test_first_source_wins_and_numbers_count(spark):
    a = spark.createDataFrame([posting("a_00010", "A1", url="same"), posting("a_00009", "A2", url="same")], NINE)
    b = spark.createDataFrame([without_date(posting("b_00001", "B", url="same"))], EIGHT)
    assert ids(cl.clean_jobs([a, b])) == ["a_00009"]


def test_null_urls_are_equal(spark):
    a = spark.createDataFrame([posting("a_00001", "A", url=None), posting("a_00002", "B", url=None)], NINE)
    assert ids(cl.clean_jobs([a])) == ["a_00001"]


def test_title_company_repeats_after_normalization(spark):
    a = spark.createDataFrame([
        posting("a_00001", "ml engineer", "Acme", "u1"), posting("a_00002", "Machine  Learning engineer", "Acme ", "u2"),
        posting("a_00003", "MACHINE LEARNING engineer", " Acme", "u3"), posting("a_00004", "ml engineer", None, "u4"),
    ], NINE)
    # The second title meets no rule, but capitalizing its words gives the same name.
    assert ids(cl.clean_jobs([a])) == ["a_00001", "a_00004"]


def test_dedupe_is_idempotent_and_reported(spark):
    rows = [posting(f"a_{i:05d}", f"T{i % 7}", f"C{i % 3}", f"u{i % 11}") for i in range(60)]
    a = spark.createDataFrame(rows, NINE)
    once = cl.clean_jobs([a])
    assert ids(cl.clean_jobs([once])) == ids(once)
    report = cl.dedupe_report([a], once).first()
    assert report["rows_in"] == 60 and report["rows_out"] == once.count() == 60 - report["rows_removed"]


def test_duplicate_ids_keep_one_row_per_url(spark):
    a = spark.createDataFrame([posting("a_00001", "A", url="u"), posting("a_00001", "A", url="u"), posting("a_00001", "B", url="v")], NINE)
    assert ids(cl.clean_jobs([a])) == ["a_00001", "a_00001"]


def test_hot_url_is_reduced_before_the_shuffle(spark):
    a = spark.createDataFrame([posting("a_00001")], NINE)
    plan = cl.dedupe_by_url(cl.union_sources([a]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


RECORD = "doc_id int, job_title string, job_description string, external_job_id string, job_url string, skills array<string>"


def test_record_keys(spark):
    df = spark.createDataFrame([
        (1, "t", "d", "", "u1", []), (2, "t", "d", None, "u", []), (3, "t", "d", None, "u", []),
        (4, "t", "d", "k", None, []), (5, "t", "d", "k", None, []), (6, "t", "d", None, None, []),
    ], RECORD)
    assert [r["doc_id"] for r in nz.dedupe_by_key(df, ["doc_id"]).orderBy("doc_id").collect()] == [2, 4]


def test_normalize_records_drops_failed_and_empty(spark):
    df = spark.createDataFrame([
        (1, "Data engineer", "python", "a", "u", ["x"]), (2, "t", "d", "b", "u", [None]), (3, "!!!", "d", "c", "u", []),
        (4, "t", None, "d", "u", None),
    ], RECORD)
    rows = nz.normalize_records(df, ["doc_id"]).collect()
    assert [(r["external_job_id"], r["job_title"], r["salary_currency"]) for r in rows] == [("a", "Data Engineer", "EUR")]
    assert rows[0]["experience_level"] == "Non spécifié" and rows[0]["skills"] == ["Python", "x"]
    report = nz.normalize_report(df, ["doc_id"]).first()
    assert (report["input_rows"], report["unique_rows"], report["cleaned_rows"], report["valid_rows"]) == (4, 4, 3, 1)


def test_currency_default_only_for_absent_column(spark):
    df = spark.createDataFrame([(1, "t", "d", "a", "u", [], None)], RECORD + ", salary_currency string")
    assert nz.normalize_record(df).first()["salary_currency"] is None
