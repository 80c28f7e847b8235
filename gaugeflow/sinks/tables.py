"""Layers as bucketed catalog tables.

Tables bucketed on one key into one number of buckets share a partitioning that
outlives the run: the dedupe of bronze, the uniqueness check, the semi joins and
lineage then read bucket by bucket and exchange nothing on the key. A bucket is
read as a stream, so a key with very many copies makes its task longer but no
larger; its files are still written by several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def save_bucketed(df: DataFrame, table: str, path: str, key: str = "reading_id", buckets: int | None = None) -> DataFrame:
    """Write ``df`` under ``path`` as the catalog table ``table``, bucketed by ``key``, and read it back.

    ``buckets`` is one number for all tables that are to meet (default: the session's
    shuffle partitions, which are sized for the largest of them). An existing
    table of that name is replaced; files under its old path stay for its readers.
    Null keys are a bucket's rows like others; an empty table is a table without files."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Rows of a bucket meet in few tasks, so few files; AQE splits a large one.
    spread = df.withColumn("_bucket", F.pmod(F.hash(key), F.lit(buckets))).hint("rebalance", "_bucket").drop("_bucket")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spread.write.mode("errorifexists").bucketBy(buckets, key).option("path", path).option(
        f"parquet.bloom.filter.enabled#{key}", "true"
    ).saveAsTable(table)
    return spark.table(table)
