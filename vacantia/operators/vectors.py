"""Dense vectors: bounded blocks against a partitioned table, and column expressions."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from vacantia.operators.rows import number_rows
from vacantia.session import stage

# Largest number of rows that is ever sent to every task at once, and rows of the other side that meet a block in one task.
BLOCK_ROWS = 2000
TILE_ROWS = 20_000


def unit_rows(cells: pd.Series, width: int | None = None) -> np.ndarray:
    """Rows scaled to length 1; a missing or zero vector stays zero, one of another width is an error."""
    if width is None:
        width = next((len(v) for v in cells if v is not None), 0)
    out = np.zeros((len(cells), width))
    for i, v in enumerate(cells):
        if v is not None:
            if len(v) != width:
                raise ValueError(f"a vector has {len(v)} numbers where others have {width}")
            out[i] = v
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, norms, out=np.zeros_like(out), where=norms > 0)


def over_blocks(
    df: DataFrame,
    small: DataFrame,
    key: str,
    make_kernel: Callable[[pd.DataFrame], Callable],
    schema: str,
    size: int = BLOCK_ROWS,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Run ``df`` past every row of ``small`` in one job, at most ``size`` rows of it at a time.

    ``make_kernel(block)`` returns a ``mapInPandas`` function.  The number of rows is checked first: a
    table of one block goes to the tasks in one piece, and ``df`` stays where it is.  Otherwise both sides are
    numbered and cut, ``small`` into blocks and ``df`` into tiles of about ``tile_rows``, and every tile meets every
    block in a task of its own; a task holds one tile and one block, whatever the size of the two tables.
    """
    spark = df.sparkSession
    size_of = F.size("embedding") if "embedding" in small.columns else F.lit(None)
    total, least, most = small.agg(F.count("*"), F.min(F.when(size_of >= 0, size_of)), F.max(size_of)).first()
    if least is not None and least != most:
        raise ValueError(f"vectors of {least} and of {most} numbers in one table")
    if total == 0:
        return spark.createDataFrame([], schema)
    if total <= size:
        block = small.orderBy(key).limit(size).toArrow()  # bounded by ``size``
        return df.mapInPandas(make_kernel(block.to_pandas()), schema)
    # Written with their numbers, so that a lost executor cannot deal them anew.
    rows = stage(df.withColumn("_uid", F.monotonically_increasing_id()), "rows")
    tiles, blocks = max(1, -(-rows.count() // tile_rows)), -(-total // size)
    numbered = number_rows(small, [key], name="_no")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumns({"_tile": F.pmod("_uid", F.lit(tiles)).cast("int"), "_block": every(blocks)})
    right = numbered.withColumns({"_block": F.floor((F.col("_no") - 1) / size).cast("int"), "_tile": every(tiles)})

    def meet(tile: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        work = make_kernel(block.drop(columns=["_no", "_block", "_tile"]).sort_values(key, kind="stable").reset_index(drop=True))
        found = [out for out in work(iter([tile.drop(columns=["_uid", "_block", "_tile"])] if len(tile) else []))]
        return pd.concat(found, ignore_index=True) if found else pd.DataFrame(columns=names)

    names = spark.createDataFrame([], schema).columns
    return left.groupBy("_tile", "_block").cogroup(right.groupBy("_tile", "_block")).applyInPandas(meet, schema)


def norm(vector: Column) -> Column:
    """Euclidean length of an array column."""
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two array columns; 0 where either is missing or zero."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))
