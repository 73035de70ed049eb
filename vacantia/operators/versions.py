"""Versions of rows: what a load adds to a log of changes, and the state that the log stands for.

Rows are compared by a digest of their values that is kept in the log, so a load moves keys and digests of
both sides and the values of changed rows only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from vacantia.operators.rows import keep_first, number_rows
from vacantia.session import stage


def row_digest(values: Sequence[str]) -> Column:
    """One text for all values; nulls differ from empty texts."""
    return F.sha2(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}), 256)


def latest(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last row of every key: the current state, closed rows included."""
    return keep_first(log, keys, [F.desc("load_no")])


def changed_rows(
    log: DataFrame, incoming: DataFrame, keys: Sequence[str], values: Sequence[str], at: Column, load_no: Column,
    close_missing: bool = True,
) -> DataFrame:
    """Rows to add to ``log`` so that its latest state is ``incoming``: keys, values and the columns of a version.

    ``change`` is new, changed (a value differs), closed (the key is gone) or reopened (it is back).
    ``created_at`` is the time of the first load with the key, ``updated_at`` that of this load; rows without a change are not
    added, so the same load again adds nothing.  Of repeats inside ``incoming`` the first by its digest
    counts.  Keys must not be null.  ``close_missing=False`` never closes rows.
    """
    digested = incoming.select(*keys, *values, row_digest(values).alias("row_digest"))
    fresh = keep_first(digested, keys, ["row_digest"])
    before = latest(log.select(*keys, "row_digest", "is_active", "created_at", "load_no"), keys)
    before = before.select(*keys, F.col("row_digest").alias("_digest"), F.col("is_active").alias("_active"),
                           F.col("created_at").alias("_created"), F.col("load_no").alias("_load"))
    gone = F.when(F.col("_active") & F.lit(close_missing), F.lit("closed"))
    change = (
        F.when(F.col("_load").isNull(), F.lit("new")).when(F.col("row_digest").isNull(), gone)
        .when(~F.col("_active"), F.lit("reopened")).when(F.col("row_digest") != F.col("_digest"), F.lit("changed"))
    )
    compared = fresh.select(*keys, "row_digest").join(before, list(keys), "full").withColumn("change", change)
    slim = stage(compared.filter("change IS NOT NULL").select(*keys, "change", "_created", "_load"), "changes")
    version = [
        F.col("change"), (F.col("change") != "closed").alias("is_active"), F.coalesce("_created", at).alias("created_at"),
        at.alias("updated_at"), load_no.cast("long").alias("load_no"),
    ]
    opened = fresh.join(slim.filter("change <> 'closed'"), list(keys))
    old = log.select(*keys, *values, "row_digest", F.col("load_no").alias("_load"))
    closed = old.join(slim.filter("change = 'closed'"), [*keys, "_load"])
    names = [*keys, *values, "row_digest"]
    return opened.select(*names, *version).unionByName(closed.select(*names, *version))


def described(rows: DataFrame, name: str, attributes: dict[str, str], order: Sequence[str]) -> DataFrame:
    """One row per name that is not null, each attribute from the first row in ``order`` that has one.

    Attributes are plain aggregates with partial results below the shuffle, so a name on a
    third of all rows is one row per task.
    """
    first = [
        F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(*order, c))).alias(out) for out, c in attributes.items()
    ]
    return rows.filter(F.col(name).isNotNull()).groupBy(name).agg(*first)


def with_keys(changes: DataFrame, log: DataFrame, name: str, key: str) -> DataFrame:
    """Changes of a dimension with surrogate keys: the stored one of a known name, the next numbers for new names."""
    known = log.groupBy(name).agg(F.min(key).alias(key))
    found = stage(changes.join(known, name, "left"), "members")
    top = log.agg(F.coalesce(F.max(key), F.lit(0))).first()[0]
    new = number_rows(found.filter(F.col(key).isNull()).select(name), [name], name=key)
    numbered = found.filter(F.col(key).isNull()).drop(key).join(new.withColumn(key, F.col(key) + top), name)
    return found.filter(F.col(key).isNotNull()).unionByName(numbered)


def change_counts(logs: dict[str, DataFrame]) -> DataFrame:
    """Rows per table, load and kind of change."""
    return reduce(DataFrame.unionByName, [
        log.groupBy("load_no", "change").agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "load_no", "change", "n")
        for t, log in logs.items()
    ])
