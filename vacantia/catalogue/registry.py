"""All topics in one place."""

from __future__ import annotations

from vacantia.catalogue import load_queries, mart_queries, page_queries, rank_queries, star_queries, text_queries

TOPICS = [star_queries, load_queries, mart_queries, text_queries, rank_queries, page_queries]

QUERIES: dict = {}
ORACLES: dict = {}
for _topic in TOPICS:
    QUERIES.update(_topic.QUERIES)
    ORACLES.update(_topic.ORACLES)
