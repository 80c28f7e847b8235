"""Mixing sources to target weights along a time-varying curriculum.

Targets: sources in code-point order (null last) take their weights from a
repeating cycle and share the total size; no target exceeds ``max_repeats``
times its source's size, the excess going to the others by weight (water
filling, solved in one pass over the sorted ratios). Schedules: each weight of
the cycle has a piecewise-linear rate over training time [0, 1]. Its integral,
scaled to the target, is the cumulative token demand; a document copy that
starts at cumulative token c of its source trains at the time when the demand
reaches c. Documents are then range-sorted by that position.

A source's documents stand in the order of md5(doc_id). Whole epochs take
every document; the last, partial one takes those whose midpoint lies before the
remainder, so a source is off its target by half a document at most.

Scale: a source is never gathered: running sums are taken inside
(source, hash prefix) buckets of about ``BUCKET_ROWS`` rows and offset by the buckets' totals. Sums over
buckets and over sources are running sums over ranges (``before``), so neither a
source's buckets nor all sources meet in one task; the driver sees a row count
and three totals. The tables of sources and buckets are written first, so a
hot source's join is split by AQE.

Defined cases: null or empty texts have size 0 and are not taken; null ids
sort as the empty string; repeated rows are separate documents; texts of any length are counted whole; a null source
is a source; an empty table gives no rows. Clashing column names in the
input are kept out: only doc_id, source and text are read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.base import materialize, word_count

WEIGHTS = (5.0, 2.0, 1.0)
#: Rate knots (time, rate) of each weight: early, level and late sources.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 0.75), (1.0, 2.0)))
MAX_REPEATS = 3
#: Rows of a hash bucket, about, if one source held all rows.
BUCKET_ROWS = 1 << 10


def before(rows: DataFrame, order: Sequence[Column], sums: Mapping[str, Column]) -> DataFrame:
    """``rows`` and, under each name of ``sums``, the sum over all rows that stand
    earlier in ``order`` (which has no ties): sums inside ranges, plus
    those of the earlier ranges (one row for each range meets in one task)."""
    ranged = rows.withColumns(dict(sums)).repartitionByRange(*order)
    ranged = materialize(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(*[F.sum(name).alias(name) for name in sums])
    starts = totals.select("_range", *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_{name}") for name in sums])
    summed = ranged.withColumns({name: F.coalesce(F.sum(name).over(inside), F.lit(0)) for name in sums}).join(starts, "_range")
    return summed.withColumns({name: F.col(name) + F.col(f"_{name}") for name in sums}).drop("_range", *[f"_{name}" for name in sums])


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size, turn, weight, target`` from ``source, source_size``
    (one row per source)."""
    s = before(sizes.select("source", "source_size"), [F.col("source").asc_nulls_last()], {"turn": F.lit(1)})
    s = s.withColumn("turn", (F.col("turn") % len(weights)).cast("int"))
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("turn") + 1))
    s = s.withColumn("cap", F.col("source_size") * F.lit(float(max_repeats)))
    ratio = F.col("cap") / F.col("weight")
    order = [ratio, F.col("source").asc_nulls_last()]
    s = materialize(before(s, order, {"full": F.col("cap"), "used": F.col("weight")}), "mix-sources")
    size, weight = s.agg(F.sum("source_size").cast("double"), F.sum("weight")).first()
    if size is None:
        return s.select("source", "source_size", "turn", "weight", F.col("cap").alias("target"))
    # The first source, by ratio, whose cap is not below the level sets it.
    level = (F.lit(size) - F.col("full")) / (F.lit(weight) - F.col("used"))
    first = F.struct(ratio.alias("ratio"), F.col("source").isNull().alias("none"), "source", level.alias("level"))
    found = s.filter(ratio >= level).agg(F.min(first).alias("first")).first()["first"]
    target = F.col("cap") if found is None else F.least(F.col("cap"), F.lit(found["level"]) * F.col("weight"))
    return s.select("source", "source_size", "turn", "weight", target.alias("target"))


def position(share: Column, knots: Sequence[tuple[float, float]]) -> Column:
    """Time at which ``share`` (0..1) of the integrated schedule is reached.
    Rates are linear between knots, so each piece inverts a quadratic."""
    pieces, done = [], 0.0
    for (t0, r0), (t1, r1) in zip(knots, knots[1:]):
        pieces.append((done, t0, t1, r0, (r1 - r0) / (t1 - t0)))
        done += (t1 - t0) * (r0 + r1) / 2
    reached = share * F.lit(done)
    out = None
    for begun, t0, t1, r0, slope in reversed(pieces):
        need = F.greatest(reached - F.lit(begun), F.lit(0.0))
        if slope:
            step = (F.sqrt(F.greatest(F.lit(r0 * r0) + F.lit(2 * slope) * need, F.lit(0.0))) - F.lit(r0)) / F.lit(slope)
        else:
            step = need / F.lit(r0)
        here = F.least(F.lit(t0) + step, F.lit(t1))
        out = here if out is None else F.when(reached >= F.lit(upper), out).otherwise(here)
        upper = begun
    return out


def plan(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    max_repeats: int = MAX_REPEATS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, source, size, source_size, target, copies,
    taken, turn, start`` (cumulative tokens before it in its source) and the
    columns of ``keep``."""
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *keep)
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    # Source as a never-null key.
    rows = rows.withColumn("hash", order).withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    rows = materialize(rows, "mix-rows")
    count, digits = rows.count(), 1  # digits of the hash in a bucket's name
    while count >> (4 * digits) > BUCKET_ROWS:
        digits += 1
    rows = rows.withColumn("bucket", F.substring("hash", 1, digits))
    parts = rows.groupBy("key", "bucket").agg(F.first("source").alias("source"), F.sum("size").alias("part"))
    parts = materialize(before(parts, [F.col("key"), F.col("bucket")], {"offset": F.col("part")}), "mix-parts")
    sizes = materialize(parts.groupBy("key").agg(F.first("source").alias("source"), F.sum("part").alias("source_size"), F.min("offset").alias("base")), "mix-sizes")
    goals = targets(sizes, weights, max_repeats)
    goals = goals.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))).drop("source")
    goals = materialize(goals.join(sizes.select("key", "base"), "key"), "mix-goals")
    offsets = parts.select("key", "bucket", "offset").join(goals, "key").withColumn("offset", F.col("offset") - F.col("base")).drop("base")
    offsets = materialize(offsets, "mix-offsets")
    inside = Window.partitionBy("key", "bucket").orderBy("hash", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("upto", F.sum("size").over(inside)).join(offsets, ["key", "bucket"])
    start = (F.col("offset") + F.col("upto") - F.col("size")).cast("double")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rows = rows.withColumns({"start": start, "epochs": epochs})
    rest = F.col("target") - F.col("epochs") * F.col("source_size")
    more = (F.col("start") + F.col("size") / 2 <= rest).cast("int")
    copies = F.when(F.col("size") > 0, F.least(F.col("epochs") + more, F.lit(max_repeats))).otherwise(0).cast("int")
    rows = rows.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
    return rows.select("doc_id", "source", "size", "source_size", "target", "copies", "taken", "turn", "start", *keep)


def copy_position(copy: Column, schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES) -> Column:
    """Training position of copy number ``copy`` (from 0) of a planned row."""
    share = F.least((copy * F.col("source_size") + F.col("start") + F.col("size") / 2) / F.col("target"), F.lit(1.0))
    out = F.lit(None).cast("double")
    for turn, knots in enumerate(schedules):
        out = F.when(F.col("turn") == turn, position(share, knots)).otherwise(out)
    return F.when(F.col("taken") > 0, out)


def mix(planned: DataFrame, schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES) -> DataFrame:
    """One row per taken copy with ``copy`` and ``position``, range-sorted by
    position (ties by doc_id, copy); at most ``max_repeats`` rows per document."""
    each = planned.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    return each.withColumn("position", copy_position(F.col("copy"), schedules)).orderBy("position", "doc_id", "copy")
