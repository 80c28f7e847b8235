"""Optional metadata documents (prior-run metadata, test results): a missing
document yields one row of nulls rather than an error."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

INGEST_META = T.StructType(
    [
        T.StructField("last_ingest_utc", T.StringType()),
        T.StructField("since", T.StringType()),
        T.StructField("rows_ingested", T.LongType()),
        T.StructField("stations", T.LongType()),
        T.StructField("attribution", T.StringType()),
    ]
)

RUN_RESULTS = T.StructType(
    [
        T.StructField(
            "results",
            T.ArrayType(T.StructType([T.StructField("unique_id", T.StringType()), T.StructField("status", T.StringType())])),
        )
    ]
)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def _is_dir(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.getFileStatus(p).isDirectory())


def read_json_or_nulls(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A folder of JSON files is read by Spark; a single small document (whose
    name may start with ``_``, which file listings skip) is read as text and
    parsed with ``from_json``; a missing path gives one row of nulls."""
    from pyspark.sql import functions as F

    if not path_exists(spark, path):
        return spark.createDataFrame([tuple(None for _ in schema.fields)], schema)
    if _is_dir(spark, path):
        return spark.read.schema(schema).option("multiLine", "true").json(path)
    from gaugeflow.plans.publish import read_text

    text = read_text(spark, path) or ""
    return spark.range(1).select(F.from_json(F.lit(text), schema).alias("d")).select("d.*")


def read_test_results(spark: SparkSession, path: str) -> DataFrame:
    """``(unique_id, status)`` rows; none when the document is missing."""
    from pyspark.sql import functions as F

    doc = read_json_or_nulls(spark, path, RUN_RESULTS)
    return doc.select(F.explode_outer("results").alias("r")).select("r.unique_id", "r.status")
