"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

Groups of equal texts are hashed into a fixed number of cells, so that what
is packed is bounded whatever the corpus. A group that alone holds more than
1/``grain`` of a shard in any dimension is split by document into pieces (there are
at most 3 * shards * grain of those groups). Cells and pieces, largest first,
go to the shard where the dot product of their share vector with the residual
capacity is highest. The driver holds only those at most
``cells + 6 * shards * grain`` sums; documents get their shard by a join.

Defined cases: a null text has no bytes and no tokens and is its own group;
null ids are placed by text; repeated rows are placed each; an empty table
gives no rows. Slots count from 0 in each shard, without gaps, by
(sub-bucket, doc_id, size, crc).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.base import materialize, word_count

DIMENSIONS = ("bytes", "tokens", "one")


def measured(docs: DataFrame) -> DataFrame:
    """Narrow rows: ``doc_id, size, text_crc32, group, bytes, tokens, one``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = F.octet_length(text).cast("long") + 1
    return docs.select(
        "doc_id",
        size.alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.col("text").isNull(), text).alias("group"),
        size.alias("bytes"),
        word_count(F.col("text")).alias("tokens"),
        F.lit(1).cast("long").alias("one"),
    )


def place(items: list[tuple[int, tuple[float, ...]]], shards: int) -> dict[int, int]:
    """Item -> shard. Items are (id, share of the total in each dimension);
    the largest share goes first, ties by id; each goes where the dot product
    with the residual capacity is highest, ties to the lowest shard."""
    residual = np.full((shards, len(DIMENSIONS)), 1.0 / shards)
    out = {}
    for key, share in sorted(items, key=lambda x: (-max(x[1]), -sum(x[1]), x[0])):
        v = np.asarray(share)
        best = int(np.argmax(residual @ v))
        out[key] = best
        residual[best] -= v
    return out


def pack(docs: DataFrame, shards: int = 16, cells: int = 4096, grain: int = 32) -> DataFrame:
    """``doc_id, size, text_crc32, tokens, shard, slot`` for every row of ``docs``."""
    spark = docs.sparkSession
    rows = materialize(measured(docs), "measured")
    sums = [F.sum(c).cast("double").alias(c) for c in DIMENSIONS]
    total = rows.agg(*sums).first()
    whole = [max(total[c] or 0.0, 1.0) for c in DIMENSIONS]
    share = F.greatest(*[F.col(c) / F.lit(w) for c, w in zip(DIMENSIONS, whole)])
    limit = 1.0 / (shards * grain)
    # At most one group per ``limit`` of each dimension: 3 * shards * grain rows.
    heavy = rows.groupBy("group").agg(*sums).select("group", share.alias("share")).filter(F.col("share") > limit)
    heavy = heavy.select("group", F.ceil(F.col("share") / limit).cast("long").alias("pieces")).collect()
    first, plan = cells, []
    for g, pieces in sorted((r["group"], r["pieces"]) for r in heavy):
        plan.append((g, first, pieces))
        first += pieces
    split = spark.createDataFrame(plan, "group long, first long, pieces long")
    own = F.pmod(F.xxhash64("doc_id", "text_crc32"), F.col("pieces"))
    item = F.coalesce(F.col("first") + own, F.pmod(F.col("group"), F.lit(cells)))
    rows = rows.join(F.broadcast(split), "group", "left").withColumn("item", item)
    vectors = rows.groupBy("item").agg(*sums).collect()
    placed = place([(r["item"], tuple(r[c] / w for c, w in zip(DIMENSIONS, whole))) for r in vectors], shards)
    where = spark.createDataFrame(sorted(placed.items()), "item long, shard int")
    rows = rows.join(F.broadcast(where), "item").select("doc_id", "size", "text_crc32", "tokens", "shard")
    return with_slots(materialize(rows, "placed"), total["one"] or 0)


def with_slots(rows: DataFrame, count: float, sub_rows: int = 500_000) -> DataFrame:
    """Gapless ``slot`` in each shard. A shard is numbered in sub-buckets (by
    hash, about ``sub_rows`` rows of a shard at most), each by its own window,
    and the sub-buckets' counts give the offsets; no window holds a shard."""
    subs = max(16, math.ceil(count / sub_rows))
    rows = rows.withColumn("sub", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(subs)).cast("int"))
    within = Window.partitionBy("shard", "sub").orderBy("doc_id", "size", "text_crc32")
    before = Window.partitionBy("shard").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("shard", "sub").agg(F.count(F.lit(1)).alias("n"))
    offsets = offsets.select("shard", "sub", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    numbered = rows.withColumn("at", F.row_number().over(within) - 1)
    return numbered.join(offsets, ["shard", "sub"]).withColumn("slot", (F.col("offset") + F.col("at")).cast("long")).drop("sub", "offset", "at")
