"""Bronze scans.

:func:`read_bronze` unions every Parquet file under a root by column name
even when files disagree on the type of ``value`` (double, text, all-null
or missing) — a case where ``mergeSchema`` and an explicit schema both fail.

Where the writer recorded the kind of ``value`` when the files landed (a ``kind`` folder,
:func:`write_drifted`), each kind is one scan of the root with its own schema and a partition filter:
no footers are read and no paths are gathered. Files of other writers are
told apart by their footers. They are listed with the ``binaryFile`` source without reading their
content and each task reads only the footers of its files. Where all footers
agree the root is read as it is. Otherwise the folders are told apart by
schema (a folder whose files disagree file by file), each schema is read once
with ``value`` cast to text, and the parts are combined with
``unionByName(allowMissingColumns=True)``.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.schemas import BRONZE
from gaugeflow.session import materialize
from gaugeflow.sources.meta import path_exists

_FOOTER_SCHEMA = "path string, signature string"
#: Hadoop's names of schemes that the footer reader knows under another one.
_SCHEMES = {"s3a": "s3", "s3n": "s3"}


def _footer_signatures(batches):
    """Per file: ``col:type,…`` of the Parquet footer (only the footer is read)."""
    from urllib.parse import urlparse

    import pyarrow.fs as pafs
    import pyarrow.parquet as pq

    for pdf in batches:
        sigs = []
        for p in pdf["path"]:
            if p.startswith("file:"):
                fs, path = pafs.LocalFileSystem(), urlparse(p).path
            else:
                scheme, rest = p.split(":", 1)
                fs, path = pafs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")
            schema = pq.read_schema(path, filesystem=fs)
            sigs.append(",".join(f"{f.name}:{f.type}" for f in schema))
        yield pd.DataFrame({"path": pdf["path"], "signature": sigs})


def _ship_by_value() -> None:
    """Send the footer reader to Python workers by value, so they need no
    installed copy of this package (only pyarrow/pandas)."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])


def file_signatures(spark: SparkSession, root: str) -> DataFrame:
    """``(path, signature)`` of every Parquet file below ``root``."""
    _ship_by_value()
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path")
    )
    return files.mapInPandas(_footer_signatures, _FOOTER_SCHEMA)


def _as_bronze_text(df: DataFrame) -> DataFrame:
    cols = []
    for f in BRONZE.fields:
        if f.name in df.columns:
            dtype = df.schema[f.name].dataType.simpleString()
            c = F.col(f.name)
            # A file whose column is all-null may carry the Parquet null type (read as int/void).
            cols.append((F.lit(None).cast("string") if dtype in ("void", "null") else c.cast("string")).alias(f.name))
        else:
            cols.append(F.lit(None).cast("string").alias(f.name))
    extra = [c for c in df.columns if c not in BRONZE.fieldNames()]
    return df.select(*cols, *extra)


def _paths_by_schema(files: DataFrame, root: str) -> list[list[str]]:
    """Paths to read together, one list per footer schema. A single schema needs
    only the root. Otherwise folders stream back to the driver one by one (as
    many as the layout has partitions), and the files of those folders alone
    whose schemas differ; no task gathers them."""
    files = materialize(files.withColumn("folder", F.regexp_replace("path", "/[^/]*$", "")), "footers")
    schemas = files.select("signature").distinct().limit(2).count()
    if schemas < 2:
        return [[root]] * schemas
    kinds = files.groupBy("folder").agg(F.min("signature").alias("signature"), F.max("signature").alias("last"))
    kinds = materialize(kinds, "footer-folders")
    uniform = kinds.where("signature = last").select("signature", F.col("folder").alias("path"))
    mixed = files.join(kinds.where("signature <> last").select("folder"), "folder", "left_semi").select("signature", "path")
    paths = defaultdict(list)
    for row in uniform.union(mixed).toLocalIterator():
        paths[row["signature"]].append(row["path"])
    return [sorted(p) for _, p in sorted(paths.items())]


#: Kinds of ``value`` that landing records, and the type their files have.
KINDS = {"double": T.DoubleType(), "text": T.StringType(), "missing": None}


def read_kinds(spark: SparkSession, root: str, with_file: bool = False) -> DataFrame | None:
    """Files landed with their kind recorded; None where the root has no such folders."""
    kinds = [k for k in KINDS if path_exists(spark, f"{root}/kind={k}")]
    parts = []
    for kind in kinds:
        fields = [f for f in BRONZE.fields if f.name != "value"]
        schema = T.StructType(fields + ([T.StructField("value", KINDS[kind])] if KINDS[kind] else []))
        # The kind's own schema holds for its folder alone, which is all that the filter leaves.
        df = spark.read.schema(schema).parquet(root).where(F.col("kind") == kind)
        if with_file:
            df = df.withColumn("_file", F.col("_metadata.file_path"))
        parts.append(_as_bronze_text(df))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


def read_bronze(spark: SparkSession, root: str, with_file: bool = False) -> DataFrame:
    """All bronze files below ``root`` as text columns of the bronze schema
    (plus partition columns such as ``dt`` / ``batch`` when the layout has them)."""
    recorded = read_kinds(spark, root, with_file)
    if recorded is not None:
        return recorded
    parts = []
    for paths in _paths_by_schema(file_signatures(spark, root), root):
        df = spark.read.option("basePath", root).parquet(*paths)
        if with_file:
            df = df.withColumn("_file", F.col("_metadata.file_path"))
        parts.append(_as_bronze_text(df))
    if not parts:
        return spark.createDataFrame([], BRONZE)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def write_drifted(bronze: DataFrame, root: str) -> None:
    """Land bronze rows as three kinds of file, each in the folder of its kind: ``value`` as
    double where it parses, as text where it does not, and without the column where null."""
    numeric = F.col("value").try_cast("double")
    bronze.where(numeric.isNotNull()).withColumn("value", numeric).write.mode("append").parquet(f"{root}/kind=double")
    bronze.where(F.col("value").isNotNull() & numeric.isNull()).write.mode("append").parquet(f"{root}/kind=text")
    bronze.where(F.col("value").isNull()).drop("value").write.mode("append").parquet(f"{root}/kind=missing")
