"""Analytic views over the star.

Conventions:

* Jobs and skills are counted as distinct keys, null keys never, so repeated members or links of
  a table loaded more than once count once.  Links are first grouped per (job, skill), which is a
  partial aggregate on the job key and carries the number of rows and the score sums.
* Where the view's text averages over the job x skill rows, that fan-out is part of the
  result.  It is carried as a weight (links per job, at least 1), so the wide join is
  never built and a hot title, company or place is summed before its shuffle.
* ``as_of`` stands for the current date.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from vacantia.operators.rows import profile


@dataclass(frozen=True)
class Star:
    companies: DataFrame
    locations: DataFrame
    skills: DataFrame
    jobs: DataFrame
    links: DataFrame
    parts: Callable[[], int | None] | None = None  # partitions for links that meet by job; asked for when they do

    def tables(self) -> dict[str, DataFrame]:
        return {
            "dim_companies": self.companies, "dim_locations": self.locations,
            "dim_skills": self.skills, "fact_jobs": self.jobs, "fact_job_skills": self.links,
        }


def _listed(c: str) -> Column:
    """Ordered distinct values joined by ", "; no values give ""."""
    return F.array_join(F.array_sort(F.collect_set(c)), ", ")


def _mean(total: str, rows: str) -> Column:
    return F.try_divide(F.col(total).cast("double"), F.col(rows).cast("double"))


def _weighted_jobs(star: Star, *columns: str) -> DataFrame:
    """Jobs with ``w``: the number of rows the job has after joining its links."""
    per_job = star.links.groupBy("job_id").agg(F.count("*").alias("w"))
    return star.jobs.select("job_id", *columns).join(per_job, "job_id", "left").withColumn(
        "w", F.coalesce("w", F.lit(1))
    )


def _weighted(value: str, name: str) -> list[Column]:
    """Numerator and denominator of the fan-out weighted average of ``value``."""
    return [
        F.sum(F.col(value) * F.col("w")).alias(f"{name}_sum"),
        F.sum(F.when(F.col(value).isNotNull(), F.col("w"))).alias(f"{name}_n"),
    ]


def _links_with(star: Star, *columns: str, how: str = "inner") -> DataFrame:
    return star.links.select("job_id", "skill_id", "confidence_score").join(
        star.jobs.select("job_id", *columns), "job_id", how
    )


def published_since(jobs: DataFrame, day: Column) -> DataFrame:
    """Jobs from ``day`` on; where the fact is stored by month, older partitions are not read."""
    since = F.col("publish_date") >= day
    if "publish_month" in jobs.columns:
        since = since & (F.col("publish_month") >= F.date_format(day, "yyyy-MM"))
    return jobs.filter(since)


def _job_total(star: Star) -> Column:
    return star.jobs.agg(F.countDistinct("job_id").alias("n")).scalar()


def _pairs(star: Star) -> DataFrame:
    """One row per (job, skill) with the score sum and count of the links that it stands for.

    Many links are dealt by job into a number of partitions that follows their number, which what
    is grouped or joined by job after them keeps.
    """
    parts = star.parts() if star.parts else None
    links = star.links.repartition(parts, "job_id") if parts else star.links
    return links.groupBy("job_id", "skill_id").agg(
        F.sum("confidence_score").alias("score_sum"), F.count("confidence_score").alias("score_n")
    )


def _jobs_with_skills(star: Star, *columns: str) -> DataFrame:
    """Jobs with ``w`` (rows after joining their links, at least 1) and ``skill_ids``: links are read once."""
    per_job = star.links.groupBy("job_id").agg(F.count("*").alias("w"), F.collect_set("skill_id").alias("skill_ids"))
    return star.jobs.select("job_id", *columns).join(per_job, "job_id", "left").withColumn(
        "w", F.coalesce("w", F.lit(1))
    )


def _skills_per_job(star: Star, *aggregates: Column) -> DataFrame:
    named = _pairs(star).join(
        star.skills.select("skill_id", "skill_name", "skill_category"), "skill_id", "left"
    )
    return named.groupBy("job_id").agg(F.countDistinct("skill_id").alias("n_skills"), *aggregates)


def vw_jobs_full_context(star: Star) -> DataFrame:
    """Each job with its company, place and ordered skill and category lists."""
    lists = _skills_per_job(
        star, _listed("skill_name").alias("required_skills"),
        _listed("skill_category").alias("skill_categories"),
    )
    c = star.companies.select("company_id", "company_name", "industry", F.col("country").alias("company_country"))
    place = star.locations.select("location_id", "location_name", "country", "region")
    return (
        star.jobs.join(lists, "job_id", "left")
        .join(c, "company_id", "left")
        .join(place, "location_id", "left")
        .select(
            "job_id", "job_title", "job_title_normalized", "company_name", "industry",
            "company_country", "location_name", "country", "region", "description",
            "description_length", "source", "publish_date", "scrape_date",
            "job_posting_days_old", "url",
            F.coalesce("n_skills", F.lit(0)).alias("required_skills_count"),
            F.coalesce("required_skills", F.lit("")).alias("required_skills"),
            F.coalesce("skill_categories", F.lit("")).alias("skill_categories"),
        )
    )


def vw_skills_demand(star: Star) -> DataFrame:
    """Per skill: jobs, share of all jobs, confidence, companies, places, sources."""
    pairs = _pairs(star).withColumn("jobs", F.when(F.col("job_id").isNotNull(), F.lit(1).cast("long")))
    known = pairs.join(star.jobs.select("job_id", "company_id", "location_id", "source"), "job_id", "left")
    spread = profile(
        known, "skill_id", {"companies": "company_id", "locations": "location_id"}, {"sources": "source"},
        {"jobs": F.sum("jobs"), "score_sum": F.sum("score_sum"), "score_n": F.sum("score_n")})
    jobs = F.coalesce("jobs", F.lit(0))
    return star.skills.select("skill_id", "skill_name", "skill_category").join(spread, "skill_id", "left").select(
        "skill_id", "skill_name", "skill_category",
        jobs.alias("jobs_requiring_skill"),
        F.round(F.try_divide(jobs * 100.0, _job_total(star)), 2).alias("demand_percentage"),
        F.round(_mean("score_sum", "score_n"), 3).alias("avg_confidence"),
        F.coalesce("companies", F.lit(0)).alias("companies_seeking"),
        F.coalesce("locations", F.lit(0)).alias("locations_seeking"),
        F.coalesce("sources", F.lit("")).alias("job_sources"),
    ).orderBy(F.desc("jobs_requiring_skill"), "skill_id")


def vw_jobs_by_title(star: Star) -> DataFrame:
    """Per title: jobs, companies, places, age and date range."""
    small = star.jobs.groupBy("job_title_normalized", "company_id", "location_id").agg(
        F.count("*").alias("n"),
        F.sum("job_posting_days_old").alias("age_sum"), F.count("job_posting_days_old").alias("age_n"),
        F.min("publish_date").alias("lo"), F.max("publish_date").alias("hi"),
    )
    c = star.companies.select("company_id", F.col("company_id").alias("known_company"))
    place = star.locations.select("location_id", F.col("location_id").alias("known_location"), "location_name")
    known = small.join(c, "company_id", "left").join(place, "location_id", "left")
    per_title = profile(
        known, "job_title_normalized",
        {"company_count": "known_company", "location_count": "known_location"}, {"locations": "location_name"},
        {"n": F.sum("n"), "age_sum": F.sum("age_sum"), "age_n": F.sum("age_n"), "lo": F.min("lo"), "hi": F.max("hi")},
    )
    return per_title.select(
        "job_title_normalized", F.col("n").alias("job_count"), "company_count", "location_count",
        F.round(_mean("age_sum", "age_n"), 0).alias("avg_posting_days_old"),
        F.col("lo").alias("oldest_posting"), F.col("hi").alias("newest_posting"), "locations",
    ).orderBy(F.desc("job_count"), "job_title_normalized")


def vw_market_overview(star: Star, as_of: Column) -> DataFrame:
    """One row of totals."""

    def keys(df: DataFrame, key: str) -> Column:
        return df.agg(F.countDistinct(key).alias("n")).scalar()

    return star.jobs.agg(
        F.countDistinct("job_id").alias("total_jobs"),
        F.countDistinct("source").alias("job_sources"),
        F.round(F.avg("job_posting_days_old"), 1).alias("avg_job_age_days"),
    ).select(
        "total_jobs",
        keys(star.companies, "company_id").alias("total_companies"),
        keys(star.locations, "location_id").alias("total_locations"),
        keys(star.skills, "skill_id").alias("total_skills"),
        star.links.agg(F.count("*").alias("n")).scalar().alias("total_skill_mentions"),
        "job_sources", "avg_job_age_days", as_of.cast("date").alias("last_updated"),
    )


def vw_company_opportunities(star: Star) -> DataFrame:
    """Per company: positions, places, age (fan-out weighted), skills, dates, sources."""
    weighted = _jobs_with_skills(
        star, "company_id", "location_id", "job_posting_days_old", "publish_date", "source"
    )
    age = F.col("job_posting_days_old")
    from_jobs = profile(
        weighted.withColumns({
            "age_sum": age * F.col("w"),
            "age_n": F.when(age.isNotNull(), F.col("w")), "oldest_posting": F.col("publish_date"),
            "newest_posting": F.col("publish_date"),
        }),
        "company_id", {"open_positions": "job_id", "locations_hiring": "location_id"}, {"job_sources": "source"},
        {
            "age_sum": F.sum("age_sum"), "age_n": F.sum("age_n"),
            "oldest_posting": F.min("oldest_posting"), "newest_posting": F.max("newest_posting"),
        },
    )
    pairs = weighted.select("company_id", F.explode("skill_ids").alias("skill_id")).distinct()
    from_links = pairs.join(star.skills.select("skill_id", "skill_name"), "skill_id", "left").groupBy(
        "company_id"
    ).agg(F.count("skill_id").alias("n_skills"), _listed("skill_name").alias("top_skills"))
    return (
        star.companies.select("company_id", "company_name", "industry", "country")
        .join(from_jobs, "company_id", "left").join(from_links, "company_id", "left")
        .select(
            "company_id", "company_name", "industry", "country",
            F.coalesce("open_positions", F.lit(0)).alias("open_positions"),
            F.coalesce("locations_hiring", F.lit(0)).alias("locations_hiring"),
            F.round(_mean("age_sum", "age_n"), 0).alias("avg_posting_age_days"),
            F.coalesce("n_skills", F.lit(0)).alias("unique_skills_required"),
            F.coalesce("top_skills", F.lit("")).alias("top_skills"),
            "oldest_posting", "newest_posting",
            F.coalesce("job_sources", F.lit("")).alias("job_sources"),
        )
        .orderBy(F.desc("open_positions"), "company_id")
    )


def vw_regional_analysis(star: Star) -> DataFrame:
    """Per place (name, region and country, not key): jobs, companies, skills, age (fan-out weighted).

    Rows are grouped by (place, job), (place, company) and (place, skill) first, so a place that
    holds most jobs is spread over many tasks.
    """
    place = ["location_name", "region", "country"]
    number = F.min("location_id").over(Window.partitionBy(*place))  # one number for places of one name
    named = star.locations.select("location_id", *place, number.alias("place"))
    known = star.companies.select("company_id", F.col("company_id").alias("known"))
    age = F.col("job_posting_days_old")
    rows = _jobs_with_skills(star, "location_id", "company_id", "job_posting_days_old").join(
        named.select("location_id", "place"), "location_id")
    rows = rows.join(known, "company_id", "left").withColumns({
        "age_sum": age * F.col("w"), "age_n": F.when(age.isNotNull(), F.col("w")),
    })
    jobs = profile(
        rows, "place", {"job_count": "job_id", "company_count": "known"}, {},
        {"age_sum": F.sum("age_sum"), "age_n": F.sum("age_n")},
    )
    skills = rows.select("place", F.explode("skill_ids").alias("skill_id")).distinct().groupBy("place").agg(
        F.count("*").alias("unique_skills"))
    return (
        named.select("place", *place).distinct().join(jobs, "place", "left").join(skills, "place", "left")
        .select(
            "location_name",
            F.coalesce("region", F.lit("Unknown")).alias("region"),
            F.coalesce("country", F.lit("International")).alias("country"),
            F.coalesce("job_count", F.lit(0)).alias("job_count"),
            F.coalesce("company_count", F.lit(0)).alias("company_count"),
            F.coalesce("unique_skills", F.lit(0)).alias("unique_skills"),
            F.round(_mean("age_sum", "age_n"), 1).alias("avg_job_age"),
        )
        .orderBy(F.desc("job_count"), "location_name")
    )


def vw_skill_specialization(star: Star) -> DataFrame:
    """Per title, skill name and category: jobs, share of the title's jobs, confidence.

    The correlated count per title is a join to the title totals; a null title meets no
    total and its share is null.
    """
    names = ["job_title_normalized", "skill_name", "skill_category"]
    met = _pairs(star).join(star.jobs.select("job_id", "job_title_normalized"), "job_id").join(
        star.skills.select("skill_id", "skill_name", "skill_category"), "skill_id")
    sums = [F.sum("score_sum").alias("score_sum"), F.sum("score_n").alias("score_n")]
    named = met.groupBy(*names, "job_id").agg(*sums).groupBy(*names).agg(F.count("*").alias("jobs"), *sums)
    totals = star.jobs.groupBy("job_title_normalized").agg(F.countDistinct("job_id").alias("total"))
    return named.join(totals, "job_title_normalized", "left").select(
        "job_title_normalized", "skill_name", "skill_category",
        F.col("jobs").alias("jobs_mentioning_skill"),
        F.round(F.try_divide(F.col("jobs") * 100.0, F.col("total").cast("double")), 2).alias("skill_relevance_pct"),
        F.round(_mean("score_sum", "score_n"), 3).alias("avg_confidence"),
    ).orderBy("job_title_normalized", F.desc("jobs_mentioning_skill"), "skill_name")


def vw_trending_skills(star: Star, as_of: Column) -> DataFrame:
    """Skills of jobs published in the last 30 days, and how many in the last 7.

    A skill without such a job is not in the result, so older jobs are filtered in the scan.
    """
    recent = published_since(star.jobs, F.date_sub(as_of, 30)).select(
        "job_id", (F.col("publish_date") >= F.date_sub(as_of, 7)).alias("this_week")
    ).groupBy("job_id").agg(F.max("this_week").alias("this_week"))
    counted = _pairs(star).join(recent, "job_id").groupBy("skill_id").agg(
        F.count("*").alias("recent_jobs_30d"), F.count_if("this_week").alias("recent_jobs_7d"),
        F.round(F.try_divide(F.sum("score_sum").cast("double"), F.sum("score_n").cast("double")), 3).alias(
            "recent_avg_confidence"),
    )
    return star.skills.select("skill_id", "skill_name", "skill_category").join(counted, "skill_id").orderBy(
        F.desc("recent_jobs_30d"), "skill_id"
    )


def vw_job_complexity(star: Star) -> DataFrame:
    """Per title: job x skill rows, length (fan-out weighted), distinct skills, score."""
    jobs = _weighted_jobs(star, "job_title_normalized", "description_length").groupBy(
        "job_title_normalized"
    ).agg(F.sum("w").alias("job_count"), *_weighted("description_length", "len"))
    skills = (
        _links_with(star, "job_title_normalized").select("job_title_normalized", "skill_id").distinct()
        .groupBy("job_title_normalized").agg(F.count("skill_id").alias("n_skills"))
    )
    n = F.coalesce("n_skills", F.lit(0))
    length = _mean("len_sum", "len_n")
    same = jobs["job_title_normalized"].eqNullSafe(skills["job_title_normalized"])
    return jobs.join(skills, same, "left").select(
        jobs["job_title_normalized"], "job_count",
        F.round(length, 0).alias("avg_description_length"),
        n.cast("double").alias("avg_skills_required"),
        n.alias("total_unique_skills"),
        F.round(length + n * 10, 0).alias("complexity_score"),
    ).orderBy(F.desc("complexity_score"), "job_title_normalized")


def vw_job_skills_aggregated(star: Star) -> DataFrame:
    """Per job: number of skills, ordered skill list, confidence."""
    lists = _skills_per_job(
        star, _listed("skill_name").alias("required_skills"),
        F.try_divide(F.sum("score_sum").cast("double"), F.sum("score_n").cast("double")).alias("avg_confidence"),
    )
    return star.jobs.select("job_id", "job_title_normalized", "company_id", "location_id").join(
        lists, "job_id", "left"
    ).select(
        "job_id", "job_title_normalized", "company_id", "location_id",
        F.coalesce("n_skills", F.lit(0)).alias("total_skills_required"),
        F.coalesce("required_skills", F.lit("")).alias("required_skills"), "avg_confidence",
    )


def vw_skills_demand_v1(star: Star) -> DataFrame:
    """Earlier form of :func:`vw_skills_demand`: jobs, plain average, share."""
    per_skill = _pairs(star).groupBy("skill_id").agg(
        F.count("job_id").alias("jobs"),
        F.try_divide(F.sum("score_sum").cast("double"), F.sum("score_n").cast("double")).alias("avg_confidence"),
    )
    jobs = F.coalesce("jobs", F.lit(0))
    return star.skills.select("skill_id", "skill_name", "skill_category").join(
        per_skill, "skill_id", "left"
    ).select(
        "skill_id", "skill_name", "skill_category", jobs.alias("job_count"), "avg_confidence",
        F.round(F.try_divide(jobs * 100.0, _job_total(star)), 2).alias("demand_percentage"),
    ).orderBy(F.desc("job_count"), "skill_id")


def vw_jobs_by_title_v1(star: Star) -> DataFrame:
    """Earlier form of :func:`vw_jobs_by_title`: per title and source."""
    return star.jobs.groupBy("job_title_normalized", "source").agg(
        F.count("*").alias("job_count"), F.countDistinct("company_id").alias("unique_companies"),
        F.countDistinct("location_id").alias("unique_locations"),
        F.min("publish_date").alias("earliest_posting"), F.max("publish_date").alias("latest_posting"),
    ).orderBy(F.desc("job_count"), "job_title_normalized", "source")


def vw_market_overview_v1(star: Star) -> DataFrame:
    """Totals over jobs x skills, without the product: zero and null if either side is empty."""
    jobs = star.jobs.agg(
        F.countDistinct("job_id").alias("jobs"), F.countDistinct("company_id").alias("companies"),
        F.countDistinct("location_id").alias("locations"),
        F.avg("job_posting_days_old").alias("age"), F.max("scrape_date").alias("scraped"),
    ).withColumn("skills", star.skills.agg(F.countDistinct("skill_id")).scalar())
    both = (F.col("jobs") > 0) & (F.col("skills") > 0)

    def kept(c: str) -> Column:
        return F.when(both, F.col(c)).otherwise(F.lit(0))

    return jobs.select(
        kept("jobs").alias("total_jobs"), kept("companies").alias("unique_companies"),
        kept("locations").alias("unique_locations"), kept("skills").alias("unique_skills"),
        F.when(both, F.col("age")).alias("avg_posting_age_days"),
        F.when(both, F.col("scraped")).alias("last_scrape_date"),
    )


# ------------------------------------------------- variants without the fan-out weight

def company_age_per_job(star: Star) -> DataFrame:
    """Average age per company over jobs, each counted once."""
    ages = star.jobs.groupBy("company_id").agg(F.round(F.avg("job_posting_days_old"), 0).alias("avg_posting_age_days"))
    return star.companies.select("company_id", "company_name").join(ages, "company_id", "left")


def title_length_per_job(star: Star) -> DataFrame:
    """Jobs and average description length per title, each job counted once."""
    return star.jobs.groupBy("job_title_normalized").agg(
        F.count("*").alias("job_count"),
        F.round(F.avg("description_length"), 0).alias("avg_description_length"),
    )
