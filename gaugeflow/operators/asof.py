"""As-of (backward) lookup: for each key's newest row, the newest value at
least ``lag`` older than it.

Spark has no as-of join. The correlated scalar subquery form
(``select v from t2 where t2.k = t1.k and t2.ts <= t1.ts - lag order by ts
desc limit 1``) decorrelates into several exchanges. This rewrite is:

1. newest row per key — an aggregate (``max_by``), combined map-side, whose
   result (one row per key) is written to the shared folder;
2. join each row to its key's cutoff — both sides are then plain scans, so AQE
   broadcasts the cutoffs when they are small and can split the rows of a hot
   key otherwise;
3. newest row at or before the cutoff — combined in each split of the join,
   then aggregated by the key wrapped in a struct. That gives the aggregate an exchange
   of its own: were it to reuse the join's partitioning, the join could not
   be split.

No window over a key is used, so no task must hold all rows of a key.

:func:`asof_every` looks back from every row instead of the newest one (any number of
probes per key). It is a segmented prefix scan: probes and values are range-partitioned together on
(key, time), the last value is carried inside each range, and what crosses
from one range into the next comes from one row per (range, key), scanned over the few ranges
that a key spans. A hot key is as many ranges as its rows fill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.session import materialize

def latest_per_key(df: DataFrame, key: Sequence[str], ts: str, tie: str, cols: Sequence[str]) -> DataFrame:
    """Newest row per key (ties on ``ts`` broken by the larger ``tie``)."""
    keep = [c for c in cols if c not in key]
    best = F.max_by(F.struct(*[F.col(c) for c in keep]), F.struct(F.col(ts), F.col(tie))).alias("_l")
    return df.groupBy(*key).agg(best).select(*key, *[F.col(f"_l.{c}").alias(c) for c in keep])


def asof_lag(
    df: DataFrame,
    key: Sequence[str] | str,
    ts: str,
    value: str,
    lag: str = "24 hours",
    tie: str | None = None,
    cols: Sequence[str] | None = None,
    tolerance: str | None = None,
    out_col: str = "value_lag",
) -> DataFrame:
    """One row per key: the newest row (``cols``) plus ``out_col``, the newest
    ``value`` with ``ts <= newest ts - lag`` (null when there is none; with a
    ``tolerance`` the candidate must also be no older than ``cutoff - tolerance``).

    The newest row's columns stay with the written cutoffs and meet the
    aggregate (one row per key) at the end.
    """
    key = [key] if isinstance(key, str) else list(key)
    tie = tie or ts
    cols = list(cols) if cols is not None else df.columns
    if ts not in cols:
        cols.append(ts)
    keep = [c for c in cols if c not in key]
    latest = latest_per_key(df, key, ts, tie, cols)
    anchor = latest.select(
        *key,
        *[F.col(c).alias(f"_l_{c}") for c in keep],
        (F.col(ts) - F.expr(f"INTERVAL {lag}")).alias("_cut"),
    )
    # The newest row itself is a row of the key: its columns come from the written side.
    anchor = materialize(anchor, "asof-anchor")
    rows = df.select(*key, F.col(ts).alias("_ts"), F.col(tie).alias("_tie"), F.col(value).alias("_value"))
    in_reach = F.col("_ts") <= F.col("_cut")
    if tolerance:
        in_reach = in_reach & (F.col("_ts") >= F.col("_cut") - F.expr(f"INTERVAL {tolerance}"))
    joined = rows.join(anchor.select(*key, "_cut"), key, "inner").where(in_reach)
    newest = F.max(F.struct("_ts", "_tie", "_value")).alias("_best")
    best = joined.groupBy(F.struct(*key).alias("_key")).agg(newest).select("_key.*", "_best")
    return anchor.join(best, key, "left").select(
        *key, *[F.col(f"_l_{c}").alias(c) for c in keep], F.col("_best._value").alias(out_col)
    )


def asof_every(
    df: DataFrame,
    key: Sequence[str] | str,
    ts: str,
    value: str,
    lag: str = "24 hours",
    tie: str | None = None,
    out_col: str = "value_lag",
    tolerance: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Every row of ``df`` with ``out_col``, the newest ``value`` of its key with
    ``ts <= own ts - lag`` (ties to the larger ``tie``; with a ``tolerance`` no older
    than that before the bound). Rows without a key or a time have none and are none."""
    key = [key] if isinstance(key, str) else list(key)
    own = F.struct(*[F.col(c) for c in df.columns])
    tie_of = F.col(tie or ts)
    usable = F.col(ts).isNotNull()
    for c in key:
        usable = usable & F.col(c).isNotNull()
    part = lambda at, kind, row, seen: F.struct(at.alias("at"), F.lit(kind).alias("kind"), row.alias("row"), seen.alias("seen"))
    seen = F.struct(F.col(ts).alias("at"), F.col(value).alias("value"))
    # Each row is a value at its own time and a probe at the bound, from one scan.
    as_value = F.when(usable, part(F.col(ts), 0, F.when(F.lit(False), own), seen))
    as_probe = part(F.col(ts) - F.expr(f"INTERVAL {lag}"), 1, own, F.when(F.lit(False), seen))
    keys = [f"_k{i}" for i in range(len(key))]
    both = df.select(
        *[F.col(c).alias(k) for c, k in zip(key, keys)], tie_of.alias("_tie"), F.explode(F.array(as_value, as_probe)).alias("_p")
    ).where("_p IS NOT NULL")
    order = [*[F.col(k) for k in keys], F.col("_p.at"), F.col("_p.kind"), F.col("_tie")]
    ranged = both.repartitionByRange(ranges, *order) if ranges else both.repartitionByRange(*order)
    ranged = materialize(ranged.withColumn("_range", F.spark_partition_id()), "asof-ranges")

    inside = Window.partitionBy("_range", *keys).orderBy("_p.at", "_p.kind", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    carried = ranged.select("_range", *keys, "_p", F.last("_p.seen", ignorenulls=True).over(inside).alias("_inside"))
    # One row per (range, key): its last value, and from it what the earlier ranges hand on.
    last = F.max_by("_p.seen", F.struct("_p.at", "_tie"))
    ends = ranged.where("_p.kind = 0").groupBy("_range", *keys).agg(last.alias("_last"))
    ends = materialize(ends, "asof-range-ends")
    spans = ranged.groupBy(*keys).agg(F.min("_range").alias("_from"), F.max("_range").alias("_to")).where("_to > _from")
    across = spans.select(*keys, F.explode(F.sequence("_from", "_to")).alias("_range")).join(ends, ["_range", *keys], "left")
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    handed = across.select("_range", *keys, F.last("_last", ignorenulls=True).over(earlier).alias("_before")).where("_before IS NOT NULL")
    found = carried.where("_p.kind = 1").join(handed, ["_range", *keys], "left")
    best = F.coalesce("_inside", "_before")
    near = best["at"].isNotNull()
    if tolerance:
        near = near & (best["at"] >= F.col("_p.at") - F.expr(f"INTERVAL {tolerance}"))
    return found.select("_p.row.*", F.when(near, best["value"]).alias(out_col))
