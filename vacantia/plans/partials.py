"""Views from what each load adds: sums, lists and bitmaps that merge, instead of the facts.

A load leaves a few rows per skill, company and place: sums and extremes, the texts of its lists, and for every
distinct count bitmaps of the whole-number keys (32,768 keys a bitmap, so counts are exact).  A view
merges these rows over all loads and reads no fact.  Loads bring a job together with its links; dense job
numbers keep the bitmaps of a load few.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from vacantia.plans import views as vw
from vacantia.plans.views import Star
from vacantia.session import stage

# One table for all groupings; ``kind`` tells what a row carries ("" for sums and extremes).
PARTIALS = T.StructType([
    T.StructField("grouped", T.StringType()), T.StructField("key", T.LongType()), T.StructField("kind", T.StringType()),
    T.StructField("bucket", T.LongType()), T.StructField("bits", T.BinaryType()), T.StructField("value", T.StringType()),
    T.StructField("score_sum", T.DoubleType()), T.StructField("score_n", T.LongType()),
    T.StructField("age_sum", T.LongType()), T.StructField("age_n", T.LongType()),
    T.StructField("lo", T.DateType()), T.StructField("hi", T.DateType()), T.StructField("scraped", T.TimestampType()),
])
_SUMS, _LOWS, _HIGHS = ["score_sum", "score_n", "age_sum", "age_n"], ["lo"], ["hi", "scraped"]


def _aligned(df: DataFrame) -> DataFrame:
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in PARTIALS.fields])


def partial_rows(
    df: DataFrame, grouped: str, key: Column, counted: dict[str, str], listed: dict[str, str], totals: list[str],
) -> list[DataFrame]:
    """What ``df`` adds to a grouping: bitmaps of ``counted``, texts of ``listed``, and ``totals``."""
    rows = df.withColumn("key", key.cast("long"))
    out = []
    if totals:
        make = {**dict.fromkeys(_SUMS, F.sum), **dict.fromkeys(_LOWS, F.min), **dict.fromkeys(_HIGHS, F.max)}
        out.append(rows.groupBy("key").agg(*[make[c](c).alias(c) for c in totals]).withColumn("kind", F.lit("")))
    if counted:
        tags = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("long").alias("number")) for k, c in counted.items()])
        numbers = rows.select("key", F.inline(tags)).filter("number IS NOT NULL")
        out.append(numbers.groupBy("key", "kind", F.bitmap_bucket_number("number").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")))
    if listed:
        tags = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("value")) for k, c in listed.items()])
        out.append(rows.select("key", F.inline(tags)).filter("value IS NOT NULL").distinct())
    return [_aligned(p.withColumn("grouped", F.lit(grouped))) for p in out]


def merged(
    partials: DataFrame, grouped: str, keys: DataFrame, by: str, counted: list[str], listed: list[str], totals: list[str],
) -> DataFrame:
    """Distinct counts, lists and totals per ``by``; ``keys`` maps the stored ``key`` to it (several may map to one)."""
    rows = partials.filter(F.col("grouped") == grouped).join(keys, "key").withColumn(by, F.col(by))
    bits = rows.filter(F.col("kind").isin(counted)).groupBy(by, "kind", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    tagged = bits.groupBy(by, "kind").agg(F.sum(F.bitmap_count("bits")).alias("n"))
    parts = [tagged.select(by, *[F.when(F.col("kind") == c, F.col("n")).alias(c) for c in counted])]
    texts = rows.filter(F.col("kind").isin(listed)).select(by, "kind", "value").distinct()
    parts.append(texts.select(by, *[F.when(F.col("kind") == c, F.col("value")).alias(f"{c}_text") for c in listed]))
    parts.append(rows.filter("kind = ''").select(by, *totals))
    everything = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    make = {**dict.fromkeys(_SUMS, F.sum), **dict.fromkeys(_LOWS, F.min), **dict.fromkeys(_HIGHS, F.max)}
    return everything.groupBy(by).agg(
        *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in counted],
        *[F.array_join(F.array_sort(F.collect_list(f"{c}_text")), ", ").alias(c) for c in listed],
        *[make[c](c).alias(c) for c in totals])


def partials_of(load: Star) -> DataFrame:
    """What one load adds: ``load`` has its new jobs and links, and all dimensions; keys are whole numbers."""
    # Links and jobs are computed once and written narrow; every grouping below reads what was written.
    pairs = stage(load.links.groupBy("job_id", "skill_id").agg(
        F.sum("confidence_score").alias("score_sum"), F.count("confidence_score").alias("score_n"),
        F.count("*").alias("rows")), "pairs")
    jobs = stage(load.jobs.select(
        "job_id", "company_id", "location_id", "source", "publish_date", "scrape_date", "job_posting_days_old"), "jobs")
    strangers = pairs.select("job_id").join(jobs.select("job_id"), "job_id", "left_anti")
    if not strangers.isEmpty():
        raise ValueError("a load must bring the jobs of its links")
    per_job = pairs.groupBy("job_id").agg(F.sum("rows").alias("w"), F.collect_set("skill_id").alias("skill_ids"))
    with_skills = jobs.join(per_job, "job_id", "left").withColumn("w", F.coalesce("w", F.lit(1)))
    age = F.col("job_posting_days_old").cast("long")
    weighted = with_skills.withColumns({
        "age_sum": age * F.col("w"), "age_n": F.when(age.isNotNull(), F.col("w")), "lo": F.col("publish_date"), "hi": F.col("publish_date")})
    known = load.companies.select("company_id", F.col("company_id").alias("known_company"))
    weighted = stage(weighted.join(known, "company_id", "left").select(
        "job_id", "company_id", "location_id", "known_company", "source", "age_sum", "age_n", "lo", "hi", "skill_ids"), "weighted")
    skilled = weighted.select("company_id", "location_id", F.explode("skill_ids").alias("skill_id")).distinct()
    named = skilled.join(load.skills.select("skill_id", "skill_name"), "skill_id", "left")
    demanded = stage(pairs.join(jobs.select("job_id", "company_id", "location_id", "source"), "job_id"), "demanded")
    plain = jobs.withColumns({
        "age_sum": age, "age_n": F.when(age.isNotNull(), F.lit(1).cast("long")), "scraped": F.col("scrape_date").cast("timestamp")})
    skill, company, place = F.col("skill_id"), F.col("company_id"), F.col("location_id")
    parts = [
        *partial_rows(demanded, "skill", skill, {"jobs": "job_id", "companies": "company_id", "locations": "location_id"},
                      {"sources": "source"}, ["score_sum", "score_n"]),
        *partial_rows(weighted, "company", company, {"positions": "job_id", "locations": "location_id"}, {"sources": "source"},
                      ["age_sum", "age_n", "lo", "hi"]),
        *partial_rows(named, "company", company, {"skills": "skill_id"}, {"skill_names": "skill_name"}, []),
        *partial_rows(weighted, "place", place, {"jobs": "job_id", "companies": "known_company"}, {}, ["age_sum", "age_n"]),
        *partial_rows(skilled, "place", place, {"skills": "skill_id"}, {}, []),
        *partial_rows(plain, "all", F.lit(0), {"jobs": "job_id", "companies": "company_id", "locations": "location_id"}, {},
                      ["age_sum", "age_n", "scraped"]),
    ]
    return reduce(DataFrame.unionByName, parts)


# --- The views ---------------------------------------------------------------------------------

def _overall(partials: DataFrame) -> DataFrame:
    return merged(partials, "all", partials.sparkSession.range(1).select(F.col("id").alias("key"), F.col("id").alias("one")), "one",
                  ["jobs", "companies", "locations"], [], ["age_sum", "age_n", "scraped"])


def skills_demand(partials: DataFrame, skills: DataFrame) -> DataFrame:
    """:func:`views.vw_skills_demand` from partials."""
    keys = skills.select(F.col("skill_id").alias("key"), F.col("skill_id")).distinct()
    found = merged(partials, "skill", keys, "skill_id", ["jobs", "companies", "locations"], ["sources"], ["score_sum", "score_n"])
    total = _overall(partials).select("jobs").scalar()
    jobs = F.coalesce("jobs", F.lit(0))
    return skills.select("skill_id", "skill_name", "skill_category").join(found, "skill_id", "left").select(
        "skill_id", "skill_name", "skill_category", jobs.alias("jobs_requiring_skill"),
        F.round(F.try_divide(jobs * 100.0, total), 2).alias("demand_percentage"),
        F.round(vw._mean("score_sum", "score_n"), 3).alias("avg_confidence"),
        F.coalesce("companies", F.lit(0)).alias("companies_seeking"), F.coalesce("locations", F.lit(0)).alias("locations_seeking"),
        F.coalesce("sources", F.lit("")).alias("job_sources"),
    ).orderBy(F.desc("jobs_requiring_skill"), "skill_id")


def company_opportunities(partials: DataFrame, companies: DataFrame) -> DataFrame:
    """:func:`views.vw_company_opportunities` from partials."""
    keys = companies.select(F.col("company_id").alias("key"), F.col("company_id")).distinct()
    found = merged(partials, "company", keys, "company_id", ["positions", "locations", "skills"], ["sources", "skill_names"],
                   ["age_sum", "age_n", "lo", "hi"])
    return companies.select("company_id", "company_name", "industry", "country").join(found, "company_id", "left").select(
        "company_id", "company_name", "industry", "country", F.coalesce("positions", F.lit(0)).alias("open_positions"),
        F.coalesce("locations", F.lit(0)).alias("locations_hiring"), F.round(vw._mean("age_sum", "age_n"), 0).alias("avg_posting_age_days"),
        F.coalesce("skills", F.lit(0)).alias("unique_skills_required"), F.coalesce("skill_names", F.lit("")).alias("top_skills"),
        F.col("lo").alias("oldest_posting"), F.col("hi").alias("newest_posting"), F.coalesce("sources", F.lit("")).alias("job_sources"),
    ).orderBy(F.desc("open_positions"), "company_id")


def regional_analysis(partials: DataFrame, locations: DataFrame) -> DataFrame:
    """:func:`views.vw_regional_analysis` from partials; places of one name, region and country are merged."""
    place = F.struct("location_name", "region", "country").alias("place")
    keys = locations.select(F.col("location_id").alias("key"), place).distinct()
    found = merged(partials, "place", keys, "place", ["jobs", "companies", "skills"], [], ["age_sum", "age_n"]).withColumnRenamed("place", "at")
    return keys.select("place").distinct().join(found, F.col("place").eqNullSafe(F.col("at")), "left").select(
        "place.location_name", F.coalesce("place.region", F.lit("Unknown")).alias("region"),
        F.coalesce("place.country", F.lit("International")).alias("country"), F.coalesce("jobs", F.lit(0)).alias("job_count"),
        F.coalesce("companies", F.lit(0)).alias("company_count"), F.coalesce("skills", F.lit(0)).alias("unique_skills"),
        F.round(vw._mean("age_sum", "age_n"), 1).alias("avg_job_age"),
    ).orderBy(F.desc("job_count"), "location_name")


def market_overview_v1(partials: DataFrame, skills: DataFrame) -> DataFrame:
    """:func:`views.vw_market_overview_v1` from partials."""
    known = skills.agg(F.countDistinct("skill_id").alias("skills"))
    row = known.join(_overall(partials).withColumn("on", F.lit(1)), F.col("on") == 1, "left")
    both = (F.coalesce("jobs", F.lit(0)) > 0) & (F.col("skills") > 0)
    kept = lambda c, name: F.when(both, F.col(c)).otherwise(F.lit(0)).alias(name)
    return row.select(
        kept("jobs", "total_jobs"), kept("companies", "unique_companies"), kept("locations", "unique_locations"),
        kept("skills", "unique_skills"), F.when(both, vw._mean("age_sum", "age_n")).alias("avg_posting_age_days"),
        F.when(both, F.col("scraped")).alias("last_scrape_date"))
