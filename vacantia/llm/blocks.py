"""Bounded blocks of documents and sorted number lists exchanged between them.

A block holds about ``BLOCK_BYTES`` of text, so the number of blocks follows the data and a
task that takes one block has bounded memory.  Documents are written once, bucketed by
block, into the shared folder; later passes meet them without moving the texts again and
survive lost executors by reading the files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vacantia.llm.workers import give_back
from vacantia.session import scratch_path

BLOCK_BYTES = 16 << 20


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def block_count(docs: DataFrame, text: Column, size: int = BLOCK_BYTES) -> int:
    """Blocks of about ``size`` bytes for all texts, and one per shuffle partition at least."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(shuffle_width(docs.sparkSession), -(-total // size))


def in_blocks(docs: DataFrame, columns: Sequence[Column], blocks: int) -> DataFrame:
    """``columns`` of all rows with ``uid`` (one per row) and ``block``, written bucketed by block."""
    spark = docs.sparkSession
    name = f"vacantia_blocks_{uuid.uuid4().hex}"
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), *columns)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(blocks)))
    (
        rows.repartition(blocks, "block").write.format("parquet").option("compression", "zstd")
        .option("path", scratch_path(spark, "blocks")).bucketBy(blocks, "block").saveAsTable(name)
    )
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay: the table is external
    return table


def meet(
    left: DataFrame, right: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str
) -> DataFrame:
    """``work(rows of left, rows of right)`` for every block."""
    def run(one: pa.Table, two: pa.Table) -> pa.Table:
        try:
            return work(one, two)
        finally:
            give_back()
    return left.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(run, schema)


def numbers(column: pa.ChunkedArray, kind=np.uint64) -> np.ndarray:
    """All numbers of a column of packed binary lists."""
    parts = [np.frombuffer(v.as_buffer(), kind) for v in column if v.is_valid]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def sizes(column: pa.ChunkedArray, width: int = 8) -> np.ndarray:
    """How many numbers each packed list of a column holds."""
    return np.array([len(v.as_buffer()) // width for v in column], np.int64)


def pieces(keys: np.ndarray, *lists: np.ndarray) -> Iterator[tuple]:
    """``(key, bytes of each list where keys == key)`` for every key, lists keep their order."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    lists = [v[order] for v in lists]
    cuts = np.flatnonzero(np.diff(keys)) + 1
    for a, b in zip([0, *cuts], [*cuts, len(keys)]):
        if b > a:
            yield (int(keys[a]), *(v[a:b].tobytes() for v in lists))


def table(rows: list[tuple], **types: pa.DataType) -> pa.Table:
    """An Arrow table of ``rows`` with the named column types."""
    columns = list(zip(*rows)) if rows else [[] for _ in types]
    return pa.table({n: pa.array(c, t) for (n, t), c in zip(types.items(), columns)})


def batches(rows: list[tuple], **types: pa.DataType) -> Iterator[pa.RecordBatch]:
    yield from table(rows, **types).to_batches()


# --- Numbers that occur more than once over all blocks ------------------------------------

OFFER = "shard long, block long, hashes binary, repeated binary"
_OFFER = {"shard": pa.int64(), "block": pa.int64(), "hashes": pa.binary(), "repeated": pa.binary()}


def offer(hashes: np.ndarray, block: int, shards: int) -> list[tuple]:
    """Rows that tell each shard which hashes a block has, and which it has twice or more."""
    found, count = np.unique(hashes, return_counts=True)
    return [
        (shard, block, h, r)
        for shard, h, r in pieces((found % np.uint64(shards)).astype(np.int64), found, count > 1)
    ]


def offers(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    return batches(rows, **_OFFER)


def _shared(part: pa.Table) -> pa.Table:
    """Per block the hashes of one shard that another block has too, or the block itself twice."""
    hashes = numbers(part["hashes"])
    repeated = numbers(part["repeated"], np.bool_)
    block = np.repeat(part["block"].to_numpy(), sizes(part["hashes"]))
    _, which, count = np.unique(hashes, return_inverse=True, return_counts=True)
    count = count + np.bincount(which, repeated, len(count))
    keep = count[which] > 1
    having = np.bincount(which, minlength=len(count))[which].astype(np.int64)
    return table(
        list(pieces(block[keep], hashes[keep], having[keep])), block=pa.int64(), hashes=pa.binary(), having=pa.binary())


def shared_hashes(offered: DataFrame) -> DataFrame:
    """(block, hashes, having) of all hashes that occur at least twice, from :func:`offer` rows.

    ``having`` is the number of blocks that have the hash.  One entry per block and hash is
    moved, so a hash of a third of all documents weighs no more in its shard than one entry per block.
    """
    return offered.groupBy("shard").applyInArrow(_shared, "block long, hashes binary, having binary")


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which ``values`` are in the sorted list ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values
