"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.session import discard, materialize, release

__all__ = ["ASCII_LOWER", "ASCII_UPPER", "discard", "materialize", "release", "shuffle_parts", "table", "word_count", "world"]

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs (null and empty: 0), JVM-side.

    Maps the six separators to one, trims and counts separator runs' ends by
    the difference of two lengths, so no array of words is built."""
    spaced = F.trim(F.translate(text, "\t\n\x0b\x0c\r", "     "))
    squeezed = F.regexp_replace(spaced, " {2,}", " ")
    gaps = F.length(squeezed) - F.length(F.translate(squeezed, " ", ""))
    return F.coalesce(F.when(F.length(spaced) > 0, gaps + 1), F.lit(0)).cast("long")


def world(spark: SparkSession) -> int:
    """Task slots that the session has; only sizes partitions, never results."""
    return max(1, spark.sparkContext.defaultParallelism)
