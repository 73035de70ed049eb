"""Connected components of links that nobody collects."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vacantia.session import stage


LINKS_PER_TASK = 1_000_000  # what a task turns into stars at once, some 100 MB


def least_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest node that the pairs connect it with."""
    label = np.arange(n)
    while True:
        old = label.copy()
        low = np.minimum(label[a], label[b])
        for side in (a, b):
            np.minimum.at(label, label[side], low)
            np.minimum.at(label, side, low)
        label = label[label]
        if (label == old).all():
            return label


def _forest(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task as stars around the smallest node of each of its components."""
    held = [(part["a"].to_numpy(), part["b"].to_numpy()) for part in parts]
    if held:
        a, b = (np.concatenate(v) for v in zip(*held))
        node, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        least = node[least_reachable(len(node), place[: len(a)], place[len(a) :])]
        leaf = node != least
        yield pa.record_batch({"a": pa.array(node[leaf]), "b": pa.array(least[leaf])})


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every end of ``links(a, b)``: equal roots mark one component.

    In each round every task replaces its links by stars; then every node hooks to the neighbour (or
    itself) that comes first, in turn by number, which settles stars at once, and in an order drawn anew from a
    hash, which leaves a constant share of the nodes of any shape; the graph is contracted.  So the
    number of rounds is logarithmic, and one for links that fit a task.  Only grouped aggregates and joins on node ids
    are used, so a node with very many links is pre-aggregated or split, never gathered.  Every round is
    written to the shared folder.
    """
    edges = stage(links.selectExpr("cast(a AS long) a", "cast(b AS long) b").filter("a <> b").distinct(), "edges")
    member = stage(edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct().withColumn("root", F.col("id")), "members")
    turn = 0
    while (number := edges.count()) > 0:
        turn += 1
        tasks = -(-number // LINKS_PER_TASK)
        stars = edges.coalesce(tasks).mapInArrow(_forest, "a long, b long")
        if tasks == 1:  # the stars of one task are whole components
            last = stars.select(F.col("a").alias("root"), F.col("b").alias("to"))
            return stage(member.join(last, "root", "left").select("id", F.coalesce("to", "root").alias("root")), "members")
        edges = stage(stars.distinct(), "stars")
        rank = lambda c: F.struct(
            (F.xxhash64(F.col(c), F.lit(turn)) if turn % 2 == 0 else F.col(c)).alias("r"), F.col(c).alias("n"))
        both = edges.select("a", rank("b").alias("k")).union(edges.select("b", rank("a")))
        hook = both.groupBy("a").agg(F.min("k").alias("k")).select("a", F.least("k", rank("a"))["n"].alias("to"))
        hook = stage(hook, "hooks")
        member = stage(
            member.join(hook.withColumnRenamed("a", "root"), "root", "left").select("id", F.coalesce("to", "root").alias("root")),
            "members",
        )
        moved = edges.join(hook.withColumnRenamed("to", "x"), "a").select("x", F.col("b").alias("a"))
        moved = moved.join(hook.withColumnRenamed("to", "y"), "a").select(F.col("x").alias("a"), F.col("y").alias("b"))
        edges = stage(moved.filter("a <> b").distinct(), "edges")
    return member
