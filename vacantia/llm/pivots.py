"""Near-duplicate vectors by a pivot-permutation index.

Every vector is described by its ``PREFIX`` nearest reference points, nearest first.  Inverted lists are
kept per pair of pivots, so two vectors meet in a list exactly when they share two pivots or more;
inside a list all are compared in double precision, block by block, and a pair counts in the list of
its two smallest shared pivots only.  Long lists are cut into blocks that meet pairwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from vacantia.llm import blocks as B
from vacantia.llm.components import components, least_reachable
from vacantia.session import stage

SIMILARITY = 0.95
PREFIX = 5
SAMPLE = 8192
MAX_PIVOTS = 1024
BLOCK = 1024


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows of the sample, each as far as possible from those chosen before."""
    n = min(n, len(sample))
    chosen, nearest = [0], sample @ sample[0] if n else None
    for _ in range(1, n):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, sample @ sample[chosen[-1]])
    return sample[chosen] if n else sample


def unit_rows(column: pa.Array, width: int) -> np.ndarray:
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # no overflow or underflow in the norm
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _permute(pivots: np.ndarray):
    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            near = unit_rows(part["vector"], pivots.shape[1]) @ pivots.T
            own = np.argsort(-near, axis=1, kind="stable")[:, :PREFIX].astype(np.int32)
            ends = pa.array(np.arange(len(own) + 1, dtype=np.int32) * own.shape[1])
            yield part.append_column("pivots", pa.ListArray.from_arrays(ends, pa.array(own.ravel())))
    return work


def _first_shared(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The two smallest pivots that each pair of prefixes shares, as one number."""
    shared = (one[:, :, None] == two[:, None, :]).any(axis=2)
    low = np.sort(np.where(shared, one, 1 << 20), axis=1)[:, :2].astype(np.int64)
    return low[:, 0] * (1 << 20) + low[:, 1]


def _compare(width: int, similarity: float):
    def work(part: pa.Table) -> pa.Table:
        part = part.combine_chunks()
        rid, weight = part["rid"].to_numpy(), part["copies"].to_numpy()
        pivots = part["pivots"].combine_chunks().flatten().to_numpy().reshape(len(rid), -1)
        key, one, two = (part[c][0].as_py() for c in ("key", "one", "two"))
        block = part["block"].to_numpy()
        unit = unit_rows(part["vector"].combine_chunks(), width)
        left = np.flatnonzero(block == one)
        right = left if one == two else np.flatnonzero(block == two)
        i, j = np.nonzero(unit[left] @ unit[right].T >= similarity - 1e-9)
        a, b = left[i], right[j]
        if one == two:
            a, b = a[i < j], b[i < j]
        mine = _first_shared(pivots[a], pivots[b]) == key
        a, b = a[mine], b[mine]
        mine = (unit[a] * unit[b]).sum(axis=1) >= similarity
        a, b = a[mine], b[mine]
        links = np.bincount(a, weight[b], len(rid)) + np.bincount(b, weight[a], len(rid))
        order = np.argsort(rid, kind="stable")
        place = np.empty(len(rid), np.int64)
        place[order] = np.arange(len(rid))
        least = rid[order][least_reachable(len(rid), place[a], place[b])][place]
        some = np.flatnonzero(links)
        return pa.table({"rid": rid[some], "links": links[some].astype(np.int64), "least": least[some]})
    return work


def sound(vector: Column) -> Column:
    """Not null, no null or non-finite component, and not zero."""
    value = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, value) & F.exists(vector, lambda x: x != 0)


def _linked(good: DataFrame, width: int, n: int, similarity: float) -> DataFrame:
    """(uid, n_links, component_id) of the ``n`` sound vectors of one width."""
    good = good.filter(F.size("vector") == width).withColumn("digest", F.sha2(F.to_binary(F.array_join("vector", ","), F.lit("utf-8")), 256))
    same = stage(good.groupBy("digest").agg(
        F.min("uid").alias("rid"), F.count("*").alias("copies"), F.min("vector").alias("vector")), "distinct")
    sample = same.orderBy(F.xxhash64("rid"), "rid").limit(SAMPLE).select("vector").toArrow()  # bounded, only to choose pivots
    pivots = choose_pivots(unit_rows(sample["vector"].combine_chunks(), width), min(MAX_PIVOTS, max(32, int(2 * n**0.5))))
    kinds = "rid long, copies long, vector array<double>, pivots array<int>"
    placed = stage(same.select("rid", "copies", "vector").mapInArrow(_permute(pivots), kinds), "permuted")
    low = F.array_sort("pivots")
    lists = F.flatten(F.transform(low, lambda p: F.transform(
        F.filter(low, lambda q: q > p), lambda q: p.cast("long") * (1 << 20) + q)))
    posted = placed.select("rid", F.explode(lists).alias("key"))
    cuts = posted.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key", F.ceil(F.col("n") / BLOCK).alias("parts"))
    member = posted.join(cuts, "key").withColumn("block", F.pmod(F.xxhash64("rid"), F.col("parts")))
    member = member.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    member = member.select("rid", "key", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    met = member.join(placed, "rid").groupBy("key", "one", "two").applyInArrow(
        _compare(width, similarity), "rid long, links long, least long")
    met = stage(met, "links")
    root = components(met.select(F.col("rid").alias("a"), F.col("least").alias("b")))
    links = met.groupBy("rid").agg(F.sum("links").alias("links"))
    of = same.select("digest", "rid", "copies").join(links, "rid", "left").join(root.withColumnRenamed("id", "rid"), "rid", "left")
    of = of.select("digest", F.coalesce("root", "rid").alias("root"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    named = good.select("uid", "id", "digest").join(of, "digest")
    heads = named.groupBy("root").agg(F.min("id").alias("component_id"))
    return named.join(heads, "root").select("uid", "n_links", "component_id")


def near_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", similarity: float = SIMILARITY,
) -> DataFrame:
    """Per row: id, ``n_links`` (other rows at ``similarity`` or more), ``component_id``, ``kept``.

    Rows whose vector is null, zero, or holds null or non-finite components link with nothing, and vectors of different
    widths do not link with each other; every width is indexed by itself, one after another.  Equal vectors are compared once and counted with their number.  A component
    is named by its smallest id (nulls last); ``kept`` says that the row's id is that one, so repeated
    rows are all kept or all dropped.  Other columns are ignored; an empty table gives an empty result.
    """
    rows = stage(vectors.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_column).alias("id"),
        F.transform(F.col(vector_column), lambda x: x.cast("double")).alias("vector")), "vectors")
    good = rows.filter(sound(F.col("vector")))
    widths = good.groupBy(F.size("vector").alias("w")).count().orderBy("w").collect()
    if not widths:
        return rows.select(F.col("id").alias(id_column), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    found = reduce(DataFrame.union, [_linked(good, w["w"], w["count"], similarity) for w in widths])
    return rows.select("uid", "id").join(found, "uid", "left").select(
        F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("component_id", "id")).alias("kept"),
    )
