"""Time the headline queries and print one JSON line.

Each query is written to the ``noop`` sink, so every column of every row is computed.
``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

from vacantia.session import build_session

HEADLINE = [
    "vw_jobs_full_context", "vw_skills_demand", "vw_jobs_by_title", "vw_company_opportunities",
    "vw_regional_analysis", "vw_skill_specialization", "vw_trending_skills", "vw_job_complexity",
    "vw_job_skills_aggregated", "job_search", "job_listing", "m_check_relationships",
    "clean_jobs", "normalize_records", "match_lexicon", "match_lexicon_tech", "extract_job_skills",
    "fact_jobs", "match_candidates", "multi_factor_score", "parse_regional", "parse_international",
    "extract_links", "strip_html",
]


def main() -> None:
    from vacantia.catalogue import registry

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "12g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    registry.QUERIES["kpi_total_jobs"](spark, sf_dir).collect()  # start the engine
    seconds = {}
    for name in names:
        started = time.perf_counter()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total seconds of headline queries", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
    }))


if __name__ == "__main__":
    main()
