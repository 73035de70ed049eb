"""Vectors computed from texts alone: hashed term counts, inverse document frequency, unit length.

Counts are made inside the row (buckets sorted, runs counted), so no text and no term is moved; one number
per bucket is gathered for the frequencies, whatever the number of texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vacantia.functions import text as tx

DIMENSIONS = 1024


def term_buckets(text: Column, dimensions: int = DIMENSIONS) -> Column:
    """Sorted buckets of all words of a lowered text, one entry per word; null: none."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"([{tx.WORD}]+)"), 1)
    bucket = lambda w: F.conv(F.substring(F.md5(w.cast("binary")), 1, 8), 16, 10).cast("long") % dimensions
    return F.array_sort(F.transform(words, bucket))


def counted(buckets: Column) -> Column:
    """``(bucket, n)`` of every run of equal values in a sorted array."""
    def runs(b: Column) -> Column:
        places = F.when(F.size(b) > 0, F.sequence(F.lit(0), F.size(b) - 1)).otherwise(F.array().cast("array<int>"))
        starts = F.filter(places, lambda i: (i == 0) | (F.get(b, i) != F.get(b, i - 1)))
        return tx.let(starts, lambda s: F.zip_with(
            s, F.slice(F.array_append(s, F.size(b)), 2, F.size(s)),
            lambda at, end: F.struct(F.get(b, at).alias("bucket"), (end - at).alias("n"))))

    return tx.let(buckets, runs)  # the buckets are made once, not once per element


def document_frequency(texts: DataFrame, column: str = "description", dimensions: int = DIMENSIONS) -> DataFrame:
    """``(bucket, weight)``: ``ln((texts + 1) / (texts with it + 1))``; empty and null texts count as texts."""
    found = texts.select(F.explode(F.array_distinct(term_buckets(F.col(column), dimensions))).alias("bucket"))
    total = texts.agg(F.count("*").alias("n")).scalar()
    per_bucket = found.groupBy("bucket").agg(F.count("*").alias("d"))
    return per_bucket.select("bucket", F.log((total + 1) / (F.col("d") + 1)).alias("weight"))


def term_weights(
    texts: DataFrame, frequency: DataFrame, column: str = "description", dimensions: int = DIMENSIONS,
) -> DataFrame:
    """Adds ``terms``: the non-zero ``(bucket, weight)`` of a unit vector, by bucket; none for texts without words.

    Buckets that ``frequency`` does not know weigh nothing.
    """
    at = F.map_from_entries(F.collect_list(F.struct("bucket", "weight")))
    every = F.sequence(F.lit(0).cast("long"), F.lit(dimensions - 1).cast("long"))
    known = frequency.agg(at.alias("m")).select(
        F.transform(every, lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0))).alias("w")).scalar()  # one number per bucket

    def unit(entries: Column) -> Column:
        length = F.sqrt(F.aggregate(entries, F.lit(0.0), lambda acc, e: acc + e["weight"] * e["weight"]))
        return tx.let(length, lambda n: F.transform(
            entries, lambda e: F.struct(e["bucket"].alias("bucket"), (e["weight"] / n).alias("weight"))))

    raw = texts.withColumn("_idf", known)
    weighed = F.transform(counted(term_buckets(F.col(column), dimensions)), lambda e: F.struct(
        e["bucket"].alias("bucket"), (e["n"] * F.get(F.col("_idf"), e["bucket"].cast("int"))).alias("weight")))
    return raw.withColumn("terms", tx.let(F.filter(weighed, lambda e: e["weight"] > 0), unit)).drop("_idf")


def dense(terms: Column, dimensions: int = DIMENSIONS) -> Column:
    """The same as an array of ``dimensions`` numbers, as the ranking takes it."""
    at = F.map_from_entries(F.transform(terms, lambda e: F.struct(e["bucket"], e["weight"].cast("float"))))
    every = F.sequence(F.lit(0).cast("long"), F.lit(dimensions - 1).cast("long"))
    return tx.let(at, lambda m: F.transform(every, lambda i: F.coalesce(F.try_element_at(m, i), F.lit(0.0).cast("float"))))


def text_vectors(texts: DataFrame, column: str = "description", dimensions: int = DIMENSIONS) -> DataFrame:
    """``texts`` with ``embedding``, fitted on all of them."""
    weighed = term_weights(texts, document_frequency(texts, column, dimensions), column, dimensions)
    return weighed.withColumn("embedding", dense(F.col("terms"), dimensions)).drop("terms")
