from pyspark.sql import functions as F

from vacantia.operators.rows import number_rows, top_per_key, value_counts
from vacantia.operators.vectors import over_blocks


def test_numbers_are_gap_free_with_a_hot_group(spark):
    df = spark.range(3000).select(
        (F.col("id") * 7919 % 3000).alias("seq"), F.when(F.col("id") < 2000, "hot").otherwise(
            F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))).alias("g"),
    )
    for group, rows in _grouped(number_rows(df, ["seq"], ["g"])).items():
        assert [n for _, n in rows] == list(range(1, len(rows) + 1)), group
    whole = number_rows(df, ["seq"]).orderBy("seq").collect()
    assert [r["row_no"] for r in whole] == list(range(1, 3001))


def _grouped(df):
    out = {}
    for r in df.orderBy("seq").collect():
        out.setdefault(r["g"], []).append((r["seq"], r["row_no"]))
    return out


def test_null_group_is_numbered(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "seq int, g string")
    assert sorted(r["row_no"] for r in number_rows(df, ["seq"], ["g"]).collect()) == [1, 1, 2]


def test_top_per_key_and_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 1), (None, 1)], "k string, v int")
    assert sorted((r["k"] or "", r["v"]) for r in top_per_key(df, ["k"], [F.desc("v")], 2).collect()) == [
        ("", 1), ("a", 2), ("a", 3), ("b", 1)]
    assert [(r["k"], r["n"]) for r in value_counts(df, "k").collect()] == [("a", 3), ("b", 1)]


def test_blocks_cover_every_row(spark):
    left = spark.range(50).select(F.col("id").alias("x"))
    small = spark.range(23).select(F.col("id").alias("k"))

    def kernel(block):
        total = int(block["k"].sum())

        def run(batches):
            for b in batches:
                yield b.assign(s=total)
        return run

    whole = over_blocks(left, small, "k", kernel, "x bigint, s bigint").agg(F.sum("s")).first()[0]
    pieces = over_blocks(left, small, "k", kernel, "x bigint, s bigint", size=5).agg(F.sum("s")).first()[0]
    assert whole == pieces == 50 * sum(range(23))
    assert over_blocks(left, small.limit(0), "k", kernel, "x bigint, s bigint").count() == 0
