"""First-per-key, numbering and counting helpers that hold up under hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from vacantia.session import stage


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in ``order``; null keys are equal to each other.

    ``row_number() = 1`` is planned as a group limit below the shuffle as well as above
    it, so each task sends at most one row per key even when one key holds most rows.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def top_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], k: int
) -> DataFrame:
    """The first ``k`` rows per key in ``order`` (planned like :func:`keep_first`)."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= k).drop("_rank")


def number_rows(
    df: DataFrame, order: Sequence[str], by: Sequence[str] = (), name: str = "row_no"
) -> DataFrame:
    """Gap-free numbers 1, 2, ... in ``order``, restarted per ``by`` group.

    A plain ``row_number`` would sort a whole group - or the whole table - in one task.
    Here rows are range-partitioned, numbered inside their range, and shifted by the
    counts of the ranges before it.  The ranged table is written first, so that a lost
    executor cannot re-draw the ranges between the two uses.  Range partitioning reads its
    input twice: pass keys only, and a staged table if they are costly to compute.
    """
    ranged = stage(
        df.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    before = (
        Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    ).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range", *by).agg(F.count("*").alias("_n"))
        .withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    within = Window.partitionBy("_range", *by).orderBy(*order)
    numbered = ranged.withColumn("_local", F.row_number().over(within)).alias("r")
    match = [F.col("r._range") == F.col("o._range")]
    match += [F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}")) for c in by]
    return numbered.join(offsets.alias("o"), match).select(
        *[F.col(f"r.{c}") for c in df.columns],
        (F.col("_local") + F.col("_shift")).alias(name),
    )


def profile(
    df: DataFrame, key: str, counted: dict[str, str], listed: dict[str, str], totals: dict[str, Column]
) -> DataFrame:
    """Per key: distinct counts, ordered distinct lists, and sums or extremes, in one pass.

    ``counted`` and ``listed`` map result names to columns; ``totals`` maps result names to
    aggregates of the columns named like the results (``F.sum("n")`` for ``n``).

    Several distinct counts next to a collected set would send every expanded row through
    an object aggregate.  Here each row is tagged once per wanted column, repeats are
    removed by plain hash aggregates - most of them before the shuffle - and sets are only
    collected from what is left, a handful of rows per key.  A key that holds most rows is
    spread over its values.
    """
    names = list(totals)
    nothing = [F.lit(None).cast(df.schema[n].dataType).alias(n) for n in names]

    def tag(kind: str, value: Column, measures: list) -> Column:
        return F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"), *measures)

    tags = [tag("", F.lit(""), [F.col(n) for n in names])]
    tags += [tag(name, F.col(c), nothing) for name, c in {**counted, **listed}.items()]
    rows = df.select(F.col(key), F.inline(F.array(*tags))).filter(F.col("value").isNotNull())
    first = [totals[n].alias(n) for n in names]
    values = rows.groupBy(key, "kind", "value").agg(*first) if first else rows.select(key, "kind", "value").distinct()
    member = F.when(F.col("kind").isin(list(listed)), F.col("value"))
    small = values.groupBy(key, "kind", member.alias("member")).agg(F.count("*").alias("_n"), *first)

    def of(kind: str, c: str) -> Column:
        return F.when(F.col("kind") == kind, F.col(c))

    return small.groupBy(key).agg(
        *[F.max(of("", n)).alias(n) for n in names],
        *[F.coalesce(F.max(of(name, "_n")), F.lit(0)).alias(name) for name in counted],
        *[F.array_join(F.array_sort(F.collect_list(of(name, "member"))), ", ").alias(name) for name in listed],
    )


def value_counts(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Occurrences of each non-null value, most frequent first, ties by value."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    ordered = counted.orderBy(F.desc("n"), column)
    return ordered if limit is None else ordered.limit(limit)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    parts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
