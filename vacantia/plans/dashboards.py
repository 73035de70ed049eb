"""Dashboard queries: filter, group, order and limit over the star and its views.

Every ranking breaks ties by name, so a top list is the same on every run.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, functions as F

from vacantia.operators.warehouse import check_constraints
from vacantia.plans import views as vw
from vacantia.plans.views import Star


def _top(df: DataFrame, by: str, tie: str, n: int | None, *columns: str) -> DataFrame:
    ordered = df.select(*columns).orderBy(F.desc_nulls_last(by), tie)
    return ordered if n is None else ordered.limit(n)


def _sum_by(df: DataFrame, key: str, **sums: str) -> DataFrame:
    return df.groupBy(key).agg(*[F.sum(c).alias(name) for name, c in sums.items()])


# -------------------------------------------------------------- market overview

def kpi_total_jobs(star: Star) -> DataFrame:
    return star.jobs.agg(F.countDistinct("job_id").alias("total_jobs"))


def kpi_total_companies(star: Star) -> DataFrame:
    return star.companies.agg(F.count("company_id").alias("total_companies"))


def kpi_total_skills(star: Star) -> DataFrame:
    return star.skills.agg(F.count("skill_id").alias("total_skills"))


def kpi_avg_job_age(star: Star) -> DataFrame:
    return star.jobs.agg(F.avg("job_posting_days_old").alias("avg_job_age"))


def top_titles(star: Star, n: int = 15) -> DataFrame:
    return _top(
        vw.vw_jobs_by_title(star), "job_count", "job_title_normalized", n, "job_title_normalized", "job_count"
    )


def jobs_by_source(star: Star) -> DataFrame:
    return star.jobs.groupBy("source").agg(F.countDistinct("job_id").alias("jobs"))


def jobs_by_location(star: Star) -> DataFrame:
    return _sum_by(vw.vw_regional_analysis(star), "location_name", jobs="job_count").orderBy(
        F.desc("jobs"), "location_name"
    )


# -------------------------------------------------------------------- skills

def filter_category(star: Star, categories: list[str]) -> DataFrame:
    """Skill demand of the chosen categories only."""
    return vw.vw_skills_demand(star).filter(F.col("skill_category").isin(categories))


def top_skills_demand(star: Star, n: int = 20) -> DataFrame:
    return _top(
        vw.vw_skills_demand(star), "jobs_requiring_skill", "skill_name", n,
        "skill_name", "skill_category", "jobs_requiring_skill", "demand_percentage", "avg_confidence",
    )


def top_skills_pct(star: Star, n: int = 20) -> DataFrame:
    return _top(
        vw.vw_skills_demand(star), "demand_percentage", "skill_name", n, "skill_name", "demand_percentage"
    )


def jobs_by_category(star: Star) -> DataFrame:
    return _sum_by(vw.vw_skills_demand(star), "skill_category", jobs="jobs_requiring_skill")


def jobs_by_category_and_skill(star: Star) -> DataFrame:
    return vw.vw_skills_demand(star).groupBy("skill_category", "skill_name").agg(
        F.sum("jobs_requiring_skill").alias("jobs")
    )


def skill_metrics_table(star: Star) -> DataFrame:
    return _top(
        vw.vw_skills_demand(star), "jobs_requiring_skill", "skill_name", None,
        "skill_name", "skill_category", "jobs_requiring_skill", "demand_percentage", "avg_confidence",
    )


def trending_top(star: Star, as_of: Column, n: int = 15) -> DataFrame:
    return _top(
        vw.vw_trending_skills(star, as_of), "recent_jobs_30d", "skill_name", n, "skill_name", "recent_jobs_30d"
    )


def demand_vs_confidence(star: Star) -> DataFrame:
    return vw.vw_skills_demand(star).select(
        "skill_name", "jobs_requiring_skill", "avg_confidence", "demand_percentage"
    )


# ------------------------------------------------------------------ companies

def top_companies(star: Star, n: int = 20) -> DataFrame:
    return _top(
        vw.vw_company_opportunities(star), "open_positions", "company_name", n, "company_name", "open_positions"
    )


def positions_by_industry(star: Star) -> DataFrame:
    return _sum_by(vw.vw_company_opportunities(star), "industry", positions="open_positions")


def company_locations(star: Star, n: int = 15) -> DataFrame:
    return _top(
        vw.vw_company_opportunities(star), "locations_hiring", "company_name", n,
        "company_name", "locations_hiring",
    )


def company_skills(star: Star, companies: list[str]) -> DataFrame:
    """Skill list of the chosen companies; the choice is made before the view is built."""
    chosen = star.companies.filter(F.col("company_name").isin(companies))
    jobs = star.jobs.join(chosen.select("company_id"), "company_id", "left_semi")
    narrowed = Star(chosen, star.locations, star.skills, jobs, star.links)
    return vw.vw_company_opportunities(narrowed).select("company_name", "top_skills")


# --------------------------------------------------------------- job explorer

def job_search(
    star: Star, titles: list[str] | None = None, companies: list[str] | None = None,
    locations: list[str] | None = None, sources: list[str] | None = None,
    skills: list[str] | None = None,
) -> DataFrame:
    """Jobs that pass every filter given; within one filter any value will do."""
    jobs = star.jobs
    if titles:
        jobs = jobs.filter(F.col("job_title_normalized").isin(titles))
    if sources:
        jobs = jobs.filter(F.col("source").isin(sources))
    if companies:
        picked = star.companies.filter(F.col("company_name").isin(companies)).select("company_id")
        jobs = jobs.join(picked, "company_id", "left_semi")
    if locations:
        picked = star.locations.filter(F.col("location_name").isin(locations)).select("location_id")
        jobs = jobs.join(picked, "location_id", "left_semi")
    if skills:
        ids = star.skills.filter(F.col("skill_name").isin(skills)).select("skill_id")
        jobs = jobs.join(star.links.join(ids, "skill_id", "left_semi").select("job_id"), "job_id", "left_semi")
    return jobs.select("job_id", "job_title", "job_title_normalized", "source", "publish_date")


def job_listing(star: Star, since: Column | None = None) -> DataFrame:
    """All jobs, latest first, or those published ``since`` a day (a fact stored by month is pruned by it)."""
    if since is not None:
        star = replace(star, jobs=vw.published_since(star.jobs, since))
    counts = star.links.groupBy("job_id").agg(F.count("*").alias("n"))
    return (
        star.jobs.join(counts, "job_id", "left")
        .join(star.companies.select("company_id", "company_name"), "company_id", "left")
        .join(star.locations.select("location_id", "location_name"), "location_id", "left")
        .select(
            "job_id", "job_title", "company_name", "location_name",
            F.coalesce("n", F.lit(0)).alias("required_skills_count"), "source", "publish_date",
        )
        .orderBy(F.desc("publish_date"), "job_id")
        .drop("job_id")
    )


def job_detail_text(star: Star, job_ids: list) -> DataFrame:
    """Description and skills of chosen jobs; the choice is pushed into both facts."""
    jobs = star.jobs.filter(F.col("job_id").isin(job_ids))
    links = star.links.filter(F.col("job_id").isin(job_ids))
    return vw.vw_jobs_full_context(Star(star.companies, star.locations, star.skills, jobs, links)).select(
        "job_id", "description", "required_skills"
    )


# -------------------------------------------------------------------- regions

def jobs_by_country(star: Star) -> DataFrame:
    return _sum_by(
        vw.vw_regional_analysis(star), "country", jobs="job_count", companies="company_count"
    )


def jobs_by_region(star: Star) -> DataFrame:
    return _sum_by(vw.vw_regional_analysis(star), "region", jobs="job_count").orderBy(F.desc("jobs"), "region")


def companies_by_region(star: Star) -> DataFrame:
    return _sum_by(vw.vw_regional_analysis(star), "region", companies="company_count")


def job_age_by_region(star: Star) -> DataFrame:
    return vw.vw_regional_analysis(star).groupBy("region").agg(
        F.round(F.avg("avg_job_age"), 6).alias("avg_job_age")
    )


# ---------------------------------------------------------------------- roles

def _role(star: Star, title: str | None) -> DataFrame:
    if title is None:
        return vw.vw_skill_specialization(star)
    jobs = star.jobs.filter(F.col("job_title_normalized") == title)
    return vw.vw_skill_specialization(replace(star, jobs=jobs))


def role_top_skills(star: Star, title: str) -> DataFrame:
    return _top(
        _role(star, title), "skill_relevance_pct", "skill_name", None, "skill_name", "skill_relevance_pct"
    )


def role_skill_categories(star: Star, title: str | None = None) -> DataFrame:
    return _sum_by(_role(star, title), "skill_category", mentions="jobs_mentioning_skill")


def role_confidence(star: Star, title: str | None = None) -> DataFrame:
    return _role(star, title).select(
        "job_title_normalized", "skill_name", "skill_category", "jobs_mentioning_skill", "avg_confidence",
        "skill_relevance_pct",
    )


# ------------------------------------------------------------------- measures

def m_total_jobs(star: Star) -> DataFrame:
    return star.jobs.agg(F.countDistinct("job_id").alias("value"))


def m_total_companies(star: Star) -> DataFrame:
    return star.companies.agg(F.countDistinct("company_id").alias("value"))


def m_total_skills(star: Star) -> DataFrame:
    return star.skills.agg(F.countDistinct("skill_id").alias("value"))


def m_avg_job_age(star: Star) -> DataFrame:
    return star.jobs.agg(F.avg("job_posting_days_old").alias("value"))


def m_jobs_with_skills(star: Star) -> DataFrame:
    having = star.links.filter(F.col("skill_id").isNotNull()).select("job_id")
    return star.jobs.join(having, "job_id", "left_semi").agg(F.countDistinct("job_id").alias("value"))


def m_avg_skills_per_job(star: Star) -> DataFrame:
    jobs = star.jobs.agg(F.countDistinct("job_id").alias("n")).scalar()
    return star.links.agg(F.try_divide(F.count("skill_id").cast("double"), jobs.cast("double")).alias("value"))


def _ties_at_top(df: DataFrame, by: str) -> DataFrame:
    """Rows that share the largest value: a filter on one aggregate, no global sort."""
    return df.filter(F.col(by) == df.agg(F.max(by).alias("top")).scalar())


def m_most_common_title(star: Star) -> DataFrame:
    counted = star.jobs.groupBy("job_title_normalized").agg(F.count("job_id").alias("jobs"))
    return _ties_at_top(counted, "jobs")


def m_jobs_this_month(star: Star, as_of: Column) -> DataFrame:
    inside = vw.published_since(star.jobs, F.trunc(as_of, "month")).filter(F.col("publish_date") <= as_of)
    return inside.agg(F.countDistinct("job_id").alias("value"))


def m_top_skill(star: Star) -> DataFrame:
    counted = star.links.groupBy("skill_id").agg(F.count("job_id").alias("jobs"))
    return _ties_at_top(counted, "jobs").join(
        star.skills.select("skill_id", "skill_name"), "skill_id"
    ).select("skill_name", "jobs")


def m_check_relationships(star: Star) -> DataFrame:
    """Key and reference checks of the star's relations."""
    return check_constraints(star.tables())
