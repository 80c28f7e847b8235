"""Keyed tables kept as runs: merge on read, size-tiered compaction.

A micro-batch appends one run of rows, each key once, sorted by key, to the partitions it
touches; nothing stored before is rewritten, so a late row costs what a row costs. A
reader merges the live runs of a partition: of the rows of a key the one that is
last in ``order`` counts. Runs of about the same size are merged into a larger one
when ``FAN`` of them have gathered, so a row is rewritten as often as the logarithm of
its partition's size, and a partition has few live runs.

Runs become visible through a log of small files (``_log``), each written in one step after its run's
data: which (partition, run) it adds and which it replaces. A batch that is replayed
writes the same run again. Two writers that compact at once both add the
merged rows; merging on read makes that harmless. Files of replaced runs stay
until :func:`RunTable.vacuum` removes those older than a reader may need.
"""

from __future__ import annotations

import json
import math
import uuid
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeflow.plans.publish import _fs, write_text
from gaugeflow.session import materialize
from gaugeflow.sources.meta import path_exists

FAN = 4
LOG = "part string, run string, rows long, live boolean"


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key the row that is last in ``order`` (nulls first; ties by the other columns)."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns])


def tier(rows: int) -> int:
    return int(math.log(max(rows, 1), FAN))


@dataclass(frozen=True)
class RunTable:
    spark: SparkSession
    root: str
    part: str  # partition column, with few values a micro-batch (dates, hash buckets)
    keys: tuple[str, ...]
    order: tuple[str, ...]
    schema: T.StructType  # the partition column included

    def _log_rows(self) -> DataFrame | None:
        if not path_exists(self.spark, f"{self.root}/_log"):
            return None
        return self.spark.read.schema(LOG).json(f"{self.root}/_log")

    def live(self) -> DataFrame:
        """``part, run, rows`` of the runs that count."""
        log = self._log_rows()
        kind = self.schema[self.part].dataType
        if log is None:
            log = self.spark.createDataFrame([], LOG)
        runs = log.groupBy("part", "run").agg(F.max("rows").alias("rows"), F.min("live").alias("live")).where("live")
        return runs.select(F.col("part").cast(kind).alias(self.part), "run", "rows")

    def _data(self, parts: Sequence | None, runs: Sequence[str] | None = None) -> DataFrame:
        wide = T.StructType([*self.schema.fields, T.StructField("run", T.StringType())])
        if not path_exists(self.spark, self.root):
            return self.spark.createDataFrame([], wide)
        data = self.spark.read.schema(wide).parquet(self.root)
        # Literals prune folders before they are listed.
        if parts is not None:
            data = data.where(F.col(self.part).isin(list(parts)))
        return data if runs is None else data.where(F.col("run").isin(list(runs)))

    def read(self, parts: Sequence | None = None) -> DataFrame:
        """The merged table, or the partitions ``parts`` of it. A partition with one run needs no merge."""
        live = self.live()
        if parts is not None:
            live = live.where(F.col(self.part).isin(list(parts)))
        counted = live.withColumn("_runs", F.count(F.lit(1)).over(Window.partitionBy(self.part))).drop("rows")
        rows = self._data(parts).join(counted, [self.part, "run"])
        names = self.schema.fieldNames()
        return rows.where("_runs = 1").select(names).unionByName(keep_last(rows.where("_runs > 1").select(names), self.keys, self.order))

    def rows_of(self, runs: DataFrame) -> DataFrame:
        """The rows of given (partition, run) pairs, as they were appended."""
        return self._data(None).join(runs.select(F.col("part").cast(self.schema[self.part].dataType).alias(self.part), "run"), [self.part, "run"], "left_semi").drop("run")

    def _write(self, rows: DataFrame, run: str, replaced: Sequence[tuple[str, str]] = ()) -> list:
        rows = materialize(rows.select(self.schema.fieldNames()), "run")
        # One number per partition of the run.
        sizes = [(r[0], r[1]) for r in rows.groupBy(F.col(self.part).cast("string")).count().collect()]
        if not sizes:
            return []
        (
            rows.withColumn("run", F.lit(run))
            .hint("rebalance", self.part)
            .sortWithinPartitions(self.part, "run", *self.keys)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.part, "run")
            .parquet(self.root)
        )
        entries = [{"part": p, "run": run, "rows": n, "live": True} for p, n in sizes]
        entries += [{"part": p, "run": r, "rows": 0, "live": False} for p, r in replaced]
        write_text(self.spark, f"{self.root}/_log/{run}.json", "\n".join(json.dumps(e) for e in entries))
        return [p for p, _ in sizes]

    def append(self, rows: DataFrame, run: str | None = None) -> list:
        """Adds a run (each key's last row) and merges runs where enough have
        gathered; returns the partitions it touches."""
        parts = self._write(keep_last(rows.select(self.schema.fieldNames()), self.keys, self.order), run or f"b-{uuid.uuid4().hex[:16]}")
        if parts:
            self.compact(parts)
        return parts

    def compact(self, parts: Sequence) -> None:
        """Size-tiered: where a tier of a partition has ``FAN`` runs, they and all smaller ones become one."""
        found = self.live().where(F.col(self.part).cast("string").isin(list(parts))).select(F.col(self.part).cast("string").alias("part"), "run", "rows").collect()
        tiers: dict = defaultdict(lambda: defaultdict(list))
        for r in found:  # few: the touched partitions, some runs each
            tiers[r["part"]][tier(r["rows"])].append(r["run"])
        merged = []
        for part, by_tier in tiers.items():
            full = [t for t, runs in by_tier.items() if len(runs) >= FAN]
            if full:
                merged += [(part, run) for t, runs in by_tier.items() if t <= max(full) for run in runs]
        if not merged:
            return
        pairs = self.spark.createDataFrame(merged, "part string, run string")
        kind = self.schema[self.part].dataType
        picked = self._data([p for p, _ in merged], [r for _, r in merged]).join(
            pairs.select(F.col("part").cast(kind).alias(self.part), "run"), [self.part, "run"], "left_semi"
        )
        self._write(keep_last(picked.drop("run"), self.keys, self.order), f"c-{uuid.uuid4().hex[:16]}", merged)

    def vacuum(self, older_than_ms: int) -> int:
        """Deletes files of replaced runs that were written before; returns how many runs went."""
        log = self._log_rows()
        if log is None:
            return 0
        dead = log.groupBy("part", "run").agg(F.min("live").alias("live")).where("NOT live").select("part", "run")
        gone = 0
        for r in dead.toLocalIterator():
            p, fs = _fs(self.spark, f"{self.root}/{self.part}={r['part']}/run={r['run']}")
            if fs.exists(p) and fs.getFileStatus(p).getModificationTime() < older_than_ms:
                fs.delete(p, True)
                gone += 1
        return gone
