"""Gated, last-known-good publish.

Artifacts of a run are written under ``<root>/versions/<run_id>/``; only when
the checks allow it is a pointer ``<root>/published/<number>-<run_id>`` added, an
empty file that says all in its name. The newest pointer (largest number, then
run id) is the published version. Readers resolve it, so they see either the previous
complete version or the new complete one — never a half-written folder, and a
failed run leaves the last good version in place. No path is ever overwritten.

Writers need no lock, rename or conditional write: each adds a name of its own, so two
that publish at once may take one number, but neither replaces the other's pointer, both versions stay
in the log, and all readers agree on which is newer. Creating an empty file is one step in every file system.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.config import ATTRIBUTION, FORECAST_METHOD, PIPELINE_STAGES

POINTERS = "published"
#: Where roots published by earlier releases keep their pointer.
OLD_POINTER = "CURRENT"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme and without a closing slash, so that spellings of one place compare equal."""
    p, fs = _fs(spark, path)
    return fs.makeQualified(p).toString().rstrip("/")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file atomically: a temporary name, then one rename
    that replaces the old file (an error leaves the old file as it was)."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    p, fs = _fs(spark, path)
    # A name of its own, so that two writers of one file do not meet in it.
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex[:12]}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    context.rename(fs.makeQualified(tmp), fs.makeQualified(p), how)


def read_text(spark: SparkSession, path: str) -> str | None:
    """Whole content of a small text file (None when it does not exist)."""
    p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        return "\n".join(lines)
    finally:
        stream.close()


def version_path(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/versions/{run_id}"


def published_log(spark: SparkSession, root: str) -> list[tuple[int, str]]:
    """``(number, run_id)`` of every publish that is kept, oldest first."""
    p, fs = _fs(spark, f"{root.rstrip('/')}/{POINTERS}")
    if not fs.exists(p):
        return []
    named = (re.fullmatch(r"(\d+)-(.+)", f.getPath().getName()) for f in fs.listStatus(p))
    return sorted((int(m[1]), m[2]) for m in named if m)


def current_version(spark: SparkSession, root: str) -> str | None:
    """Folder of the published version, or None before the first publish."""
    log = published_log(spark, root)
    run_id = log[-1][1] if log else read_text(spark, f"{root.rstrip('/')}/{OLD_POINTER}")
    return version_path(root, run_id.strip()) if run_id else None


def run_concurrently(actions: list, max_workers: int = 4) -> list:
    """Submit independent Spark actions from several driver threads, so small
    jobs overlap instead of leaving task slots idle (Spark's scheduler is
    thread-safe; each thread's job is scheduled as usual)."""
    from concurrent.futures import ThreadPoolExecutor

    if len(actions) <= 1 or max_workers <= 1:
        return [a() for a in actions]
    with ThreadPoolExecutor(max_workers=max_workers) as pool:
        futures = [pool.submit(a) for a in actions]
        return [f.result() for f in futures]


def expire_versions(spark: SparkSession, root: str, keep: int = 3) -> None:
    """Delete all but the ``keep`` newest version folders; the published one
    always stays, so readers of the pointer lose nothing."""
    current = current_version(spark, root)
    p, fs = _fs(spark, f"{root.rstrip('/')}/versions")
    if not fs.exists(p):
        return
    folders = sorted(fs.listStatus(p), key=lambda f: -f.getModificationTime())
    for f in folders[keep:]:
        if current is None or f.getPath().getName() != current.rsplit("/", 1)[-1]:
            fs.delete(f.getPath(), True)
    left = {f.getPath().getName() for f in fs.listStatus(p)}
    for number, run_id in published_log(spark, root)[:-1]:
        if run_id not in left:
            pointer, _ = _fs(spark, _pointer(root, number, run_id))
            fs.delete(pointer, False)


def _pointer(root: str, number: int, run_id: str) -> str:
    return f"{root.rstrip('/')}/{POINTERS}/{number:012d}-{run_id}"


def read_published(spark: SparkSession, root: str, artifact: str, fmt: str = "parquet") -> DataFrame:
    """An artifact of the version the pointer names (last-known-good)."""
    folder = current_version(spark, root)
    if folder is None:
        raise FileNotFoundError(f"nothing published under {root}")
    reader = spark.read.option("basePath", f"{folder}/{artifact}")
    return reader.json(f"{folder}/{artifact}") if fmt == "json" else reader.parquet(f"{folder}/{artifact}")


def key_index(writer, df: DataFrame, key: str = "reading_id"):
    """Parquet Bloom filters on the key, which is a digest: every row group's
    range of keys holds every key, so only a filter tells which group has it."""
    return writer.option(f"parquet.bloom.filter.enabled#{key}", "true") if key in df.columns else writer


def write_artifacts(
    artifacts: dict[str, DataFrame], folder: str, formats: dict[str, str] | None = None, max_workers: int = 4
) -> None:
    formats = formats or {}

    def writer(name: str, df: DataFrame):
        def run():
            fmt = formats.get(name, "parquet")
            w = df.write.mode("errorifexists")
            if fmt == "json":
                w.option("ignoreNullFields", "false").json(f"{folder}/{name}")
            else:
                key_index(w, df).parquet(f"{folder}/{name}")

        return run

    run_concurrently([writer(n, d) for n, d in artifacts.items()], max_workers)


def publish(spark: SparkSession, root: str, run_id: str, publishable: bool) -> bool:
    """Add the pointer to ``run_id`` when allowed; returns whether it did."""
    if publishable:
        log = published_log(spark, root)
        pointer, fs = _fs(spark, _pointer(root, log[-1][0] + 1 if log else 1, run_id))
        fs.create(pointer, False).close()
    return publishable


def run_meta_document(meta: DataFrame) -> DataFrame:
    """The run-metadata document (one row) with stage statuses. A run that gets here has
    ingested (also nothing) and built; its checks and its publish are as its status says, so
    every stage of a published run is ``ok``."""
    ok = F.col("status") == "ok"
    stage = lambda name, good: F.struct(F.lit(name).alias("name"), F.when(good, "ok").otherwise("failed").alias("status"))
    return meta.select(
        F.date_format("last_run_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("last_run_utc"),
        "rows_ingested",
        "silver_rows",
        "stations",
        "above_threshold",
        "tests_passed",
        "tests_total",
        F.array(
            *[
                stage(name, good)
                for name, good in zip(
                    PIPELINE_STAGES, (F.lit(True), F.lit(True), ok, ok), strict=True
                )
            ]
        ).alias("stages"),
        "status",
        F.lit(ATTRIBUTION).alias("attribution"),
    )


def dashboard_header() -> dict[str, str]:
    return {"forecast_method": FORECAST_METHOD, "attribution": ATTRIBUTION}
