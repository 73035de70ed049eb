"""CSV, JSON and Parquet edges of the flow, always with an explicit schema."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from vacantia import schemas
from vacantia.session import stage

# Texts that count as missing in a CSV field (fixed values).
NULL_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def _nulled(df: DataFrame) -> DataFrame:
    def fix(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            return F.when(~c.isin(NULL_WORDS), c).alias(field.name)
        return c

    return df.select(*[fix(f) for f in df.schema.fields])


def read_csv(spark: SparkSession, path: str, schema: T.StructType, must_exist: bool = False) -> DataFrame:
    """A CSV with header; quoted fields may hold line breaks.

    Such files cannot be split, so large ones should be stored as Parquet once.  A path
    that does not exist gives an empty frame, or an error with ``must_exist``.
    """
    reader = (
        spark.read.schema(schema).option("header", True).option("multiLine", True)
        .option("quote", '"').option("escape", '"').option("encoding", "UTF-8")
    )
    try:
        return _nulled(reader.csv(path))
    except AnalysisException as problem:
        if must_exist or problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


_QUOTED = r'"(?:[^"]|"")*"'


def read_csv_checked(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Rows that fit ``schema``, and the others as ``(file, reason, n_lines, record)``; no line is lost.

    ``reason`` is "short" or "long" (number of fields), "type" (a field does not fit its type) or "unclosed" (a quote is
    not closed, so the record runs to the end of its file).  A last text field that ends with a line break counts as
    unclosed.  Files are parsed once, into a written table that both results read.
    """
    declared = T.StructType([*schema.fields, T.StructField("_record", T.StringType())])
    parsed = (
        spark.read.schema(declared).option("header", header).option("multiLine", True).option("quote", '"').option("escape", '"')
        .option("encoding", "UTF-8").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_record").csv(path)
    ).withColumn("_file", F.col("_metadata.file_name"))
    last = schema.fields[-1]
    if isinstance(last.dataType, T.StringType):
        runs_on = F.col("_record").isNull() & F.endswith(F.col(last.name), F.lit("\n"))
        fields = [F.coalesce(F.col(f.name).cast("string"), F.lit("")) for f in schema.fields]
        parsed = parsed.withColumn("_record", F.when(runs_on, F.concat(F.concat_ws(",", *fields[:-1]), F.lit(',"'), fields[-1])).otherwise(F.col("_record")))
    parsed = stage(parsed, "parsed")
    record = F.col("_record")
    bare = F.regexp_replace(record, _QUOTED, "")
    count = F.size(F.split(bare, ",", -1))
    reason = (
        F.when(F.contains(bare, F.lit('"')), "unclosed").when(count < len(schema.fields), "short")
        .when(count > len(schema.fields), "long").otherwise("type")
    )
    whole = F.regexp_replace(record, r"\n+$", "")
    lines = F.length(whole) - F.length(F.replace(whole, F.lit("\n"), F.lit(""))) + 1
    good = parsed.filter(record.isNull()).drop("_record", "_file")
    bad = parsed.filter(record.isNotNull()).select(
        F.col("_file").alias("file"), reason.alias("reason"), lines.alias("n_lines"), whole.alias("record"))
    return _nulled(good), bad


def read_raw_jobs_checked(
    spark: SparkSession, with_date: str, without_date: str,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """:func:`read_raw_jobs` without the rows that do not fit, and those rows of both files."""
    one, bad = read_csv_checked(spark, with_date, schemas.RAW_JOBS)
    two, worse = read_csv_checked(spark, without_date, schemas.RAW_JOBS_WITHOUT_DATE)
    return one, two, bad.unionByName(worse)


def write_csv(df: DataFrame, path: str) -> str:
    """Header, no index, UTF-8; one file per partition."""
    (
        df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
        .option("encoding", "UTF-8").option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return path


def read_raw_jobs(spark: SparkSession, with_date: str, without_date: str) -> tuple[DataFrame, DataFrame]:
    """The two source files, one with and one without a publish date."""
    return (
        read_csv(spark, with_date, schemas.RAW_JOBS),
        read_csv(spark, without_date, schemas.RAW_JOBS_WITHOUT_DATE),
    )


def read_clean_jobs(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    if fmt == "parquet":
        return spark.read.schema(schemas.JOBS_CLEANED).parquet(path)
    return read_csv(spark, path, schemas.JOBS_CLEANED, must_exist=True)


def read_job_skills(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    if fmt == "parquet":
        return spark.read.schema(schemas.JOB_SKILLS).parquet(path)
    return read_csv(spark, path, schemas.JOB_SKILLS, must_exist=True)


def read_api_json(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Postings of JSON array payloads: entries that are no object are skipped.

    Payloads that are no array give no row here; :func:`rejected_payloads` has them.
    """
    entries = payloads.select(F.explode(F.from_json(column, "array<string>")).alias("entry"))
    objects = entries.filter(F.ltrim("entry").startswith("{"))
    item = objects.select(F.from_json("entry", schemas.API_ITEM).alias("item"))
    return item.select(
        F.col("item.position").alias("title"), "item.company", "item.location", "item.url",
        "item.description", F.coalesce(F.array_join("item.tags", ", "), F.lit("")).alias("skills"),
    )


def rejected_payloads(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Rows whose payload is missing or does not parse as a JSON array."""
    return payloads.filter(F.from_json(column, "array<string>").isNull())


def persist_embeddings(vectors: DataFrame, path: str) -> DataFrame:
    """Vectors per job as Parquet, with the norm that similarity needs."""
    from vacantia.operators.vectors import norm

    vectors.withColumn("description_norm", norm(F.col("description_embedding"))).write.mode(
        "overwrite"
    ).parquet(path)
    return vectors.sparkSession.read.parquet(path)
