"""JSON lines: strict and tolerant scans, with digests and an oversize ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, value, sha256, bytes)`` of each line that is not blank."""
    return spark.read.text(path).select(F.input_file_name().alias("file"), "value").filter("trim(value) <> ''").select(
        "file", "value", F.sha2("value", 256).alias("sha256"), F.octet_length("value").alias("bytes")
    )


def strict(spark: SparkSession, path: str) -> DataFrame:
    """Every line as a VARIANT ``record``; a malformed line fails the read and names its file."""
    parsed = lines(spark, path).withColumn("record", F.try_parse_json("value"))
    fail = F.raise_error(F.concat(F.lit("malformed JSON line in "), "file", F.lit(" with digest "), "sha256"))
    return parsed.withColumn("record", F.when(F.col("record").isNull(), fail.cast("variant")).otherwise(F.col("record")))


def tolerant(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Parsed lines, and a ledger of malformed ones as ``invalid_json`` decisions."""
    parsed = lines(spark, path).withColumn("record", F.try_parse_json("value"))
    bad = parsed.filter("record is null").select("file", "sha256", "bytes", F.lit("invalid_json").alias("decision"))
    return parsed.filter("record is not null"), bad


def preflight(spark: SparkSession, path: str, max_record_chars: int) -> DataFrame:
    """A row a file: lines, bytes, malformed and oversized lines, and the largest line."""
    parsed = lines(spark, path).withColumn("bad", F.try_parse_json("value").isNull())
    return parsed.groupBy("file").agg(
        F.count("*").alias("lines"), F.sum("bytes").alias("bytes"), F.count_if("bad").alias("malformed"),
        F.count_if(F.length("value") > max_record_chars).alias("oversized"),
        F.max("bytes").alias("largest"), F.max_by("sha256", "bytes").alias("largest_sha256"),
    )


def write(rows: DataFrame, path: str) -> None:
    """One JSON object a line, nulls kept."""
    rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)
