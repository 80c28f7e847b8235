"""Approximate nearest neighbours by shifted Hilbert orderings.

Vectors are rotated at random and projected to a few dimensions, shifted, and
put on a Hilbert curve; several orderings differ in rotation and shift. Each
ordering is range-partitioned and sorted by Spark, which gives every vector
its position; a query meets the vectors whose positions lie within a window of
its own in any ordering, and these are reranked by their exact distance.

Equal vectors are indexed once, with their k + 1 smallest ids, so that a very
common vector neither fills windows nor breaks ties. The window is not fixed:
it is the smallest one that finds ``target`` of the true neighbours of
``probes`` rows (chosen by hash, compared with all rows), so on data without structure it
is wide, and on clustered data narrow. The projections' scale comes from at
most ``sample`` rows. Both are bounded; the index holds every row.

Positions are cut into blocks of equal size; a window's blocks get a copy of
the query. Only counts per partition, the probes' neighbours and the window
reach the driver.

Defined cases: unusable vectors (see ``vectors``) and zero vectors take no
part; rows that repeat an id count once; ties go to the smaller id; with fewer
rows than k all are returned; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.base import materialize, shuffle_parts
from gaugeflow.llm.vectors import matrix, one_per_id


@dataclass(frozen=True)
class Curves:
    orderings: int = 8
    dims: int = 8
    bits: int = 7
    seed: int = 5
    sample: int = 4096
    probes: int = 192
    target: float = 0.98
    block: int = 4096


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (rows x dims, each
    in 0 .. 2**bits - 1). Walking down the bits, the sub-cube entered reflects
    or swaps the lower bits of the first axis; Gray decoding gives the key."""
    x = cells.T.astype(np.int64).copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for axis in range(dims):
            upper = (x[axis] >> level) & 1 == 1
            x[0] = np.where(upper, x[0] ^ low, x[0])
            swap = np.where(upper, 0, (x[0] ^ x[axis]) & low)
            x[0] ^= swap
            x[axis] ^= swap
    for axis in range(1, dims):
        x[axis] ^= x[axis - 1]
    flips = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        flips = np.where((x[-1] >> level) & 1 == 1, flips ^ ((1 << level) - 1), flips)
    x ^= flips
    key = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(dims):
            key = (key << 1) | ((x[axis] >> level) & 1)
    return key


def projections(width: int, c: Curves) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rotation, shift) of each ordering."""
    rng = np.random.default_rng(c.seed)
    out = []
    for _ in range(c.orderings):
        full = np.linalg.qr(rng.normal(size=(max(width, c.dims), max(width, c.dims))))[0]
        out.append((full[:width, : c.dims], rng.uniform(-0.1, 0.1, c.dims)))
    return out


def _positions(classes: DataFrame, width: int, sample: np.ndarray, n: int, c: Curves) -> DataFrame:
    """``id, ordering, pos``: the place of every vector in every ordering."""
    spark = classes.sparkSession
    turned = [(r, s, (sample @ r).mean(0), np.maximum((sample @ r).std(0), 1e-300)) for r, s in projections(width, c)]
    shared = spark.sparkContext.broadcast(turned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, ids = matrix(b.column("vec"), width), b.column("id")
            for i, (rotation, shift, mean, spread) in enumerate(shared.value):
                unit = ((x @ rotation) - mean) / spread / 6 + 0.5 + shift
                cells = np.clip(unit * (1 << c.bits), 0, (1 << c.bits) - 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), i, np.int32)), pa.array(hilbert_keys(cells, c.bits)), ids], ["ordering", "key", "id"])

    keys = classes.select("id", "vec").mapInArrow(run, "ordering int, key long, id long")
    keys = keys.repartitionByRange(shuffle_parts(spark), "ordering", "key", "id").sortWithinPartitions("ordering", "key", "id")
    keys = materialize(keys.select("ordering", "id", F.monotonically_increasing_id().alias("mark")), "hilbert-order")
    # The mark holds the partition above bit 33 and the row within it below.
    part, row = F.shiftright("mark", 33), F.col("mark").bitwiseAND(F.lit((1 << 33) - 1))
    counts = sorted((r["part"], r["count"]) for r in keys.groupBy(part.alias("part")).count().collect())
    offsets, total = [], 0
    for p, k in counts:
        offsets.append((p, total))
        total += k
    offsets = spark.createDataFrame(offsets, "part long, offset long")  # one row per partition
    placed = keys.withColumns({"part": part, "row": row}).join(F.broadcast(offsets), "part")
    return materialize(placed.select("id", "ordering", (F.col("offset") + F.col("row") - F.col("ordering") * F.lit(n)).alias("pos")), "hilbert-positions")


def _nearest(distance: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k smallest, ties to the smaller id."""
    if len(ids) > 4 * k:
        edge = np.partition(distance, k - 1)[k - 1]
        own = np.flatnonzero(distance <= edge)
        return own[np.lexsort((ids[own], distance[own]))[:k]]
    return np.lexsort((ids, distance))[:k]


def _true_neighbours(classes: DataFrame, probes: list, width: int, k: int) -> DataFrame:
    """``probe, id`` of the k nearest other vectors of each probe, all rows."""
    shared = classes.sparkSession.sparkContext.broadcast(([r["id"] for r in probes], [list(r["vec"]) for r in probes]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vecs = shared.value
        asked = np.zeros((len(ids), width))
        for i, v in enumerate(vecs):
            asked[i, : len(v)] = v
        for b in batches:
            x, own = matrix(b.column("vec"), width), b.column("id").to_numpy()
            squared = (x * x).sum(1)
            out: list = []
            for i, (probe, v) in enumerate(zip(ids, asked)):
                d = squared - 2 * (x @ v)
                d[own == probe] = np.inf
                near = _nearest(d, own, min(k, len(own)))
                out += [(probe, int(own[j]), float(d[j])) for j in near if np.isfinite(d[j])]
            probe, near, d = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(probe, pa.int64()), pa.array(near, pa.int64()), pa.array(d, pa.float64())], ["probe", "id", "d"])

    each = classes.select("id", "vec").mapInArrow(run, "probe long, id long, d double")
    order = Window.partitionBy("probe").orderBy("d", "id")
    return each.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).select("probe", "id")


def _window(classes: DataFrame, positions: DataFrame, width: int, k: int, c: Curves) -> int:
    """Smallest window that finds ``target`` of the probes' neighbours."""
    probes = classes.select("id", "vec").orderBy(F.xxhash64("id"), "id").limit(c.probes).collect()
    pairs = materialize(_true_neighbours(classes, probes, width, k), "probe-neighbours")
    own = positions.join(pairs.select(F.col("probe").alias("id")).distinct(), "id").select(F.col("id").alias("probe"), "ordering", F.col("pos").alias("at"))
    gaps = pairs.join(positions, "id").join(own, ["probe", "ordering"]).groupBy("probe", "id").agg(F.min(F.abs(F.col("pos") - F.col("at"))).alias("gap"))
    found = sorted(r["gap"] for r in gaps.collect())  # at most probes * k rows
    return int(found[min(len(found) - 1, int(np.ceil(len(found) * c.target)) - 1)]) if found else 1


def neighbours(rows: DataFrame, is_query: Callable[[Column], Column], k: int, curves: Curves = Curves(), key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` (Euclidean distance) of the k nearest
    found rows of every row whose id is a query."""
    c = curves
    nonzero = F.exists("vec", lambda x: x != 0)
    base = materialize(one_per_id(rows, key, vector).filter(nonzero), "ann-vectors")
    same = Window.partitionBy("vec").orderBy("id")
    first = base.withColumn("r", F.row_number().over(same)).filter(F.col("r") <= k + 1)
    classes = first.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))  # at most k + 1 ids
    classes = materialize(classes.select(F.element_at("ids", 1).alias("id"), "ids", "vec"), "ann-classes")
    facts = classes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("vec")), F.lit(1)).alias("width")).first()
    n, width = facts["n"], facts["width"]
    spark = rows.sparkSession
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = matrix(pa.array([list(r["vec"]) for r in classes.orderBy(F.xxhash64("id"), "id").limit(c.sample).select("vec").collect()], pa.list_(pa.float64())), width)
    positions = _positions(classes, width, sample, n, c)
    window = _window(classes, positions, width, k, c)
    asked = base.filter(is_query(F.col("id"))).select(F.col("id").alias("query_id"), "vec").join(classes.select("vec", F.col("id").alias("class")), "vec")
    asked = materialize(asked.select("query_id", "class"), "ann-queries")
    block = F.floor(F.col("pos") / c.block).cast("long")
    places = positions.groupBy("id").agg(F.collect_list(F.struct("ordering", "pos")).alias("places"))  # one per ordering
    spots = materialize(classes.join(places, "id"), "ann-places")
    held = spots.select("id", "ids", "vec", F.explode("places").alias("p")).select("id", "ids", "vec", "p.ordering", "p.pos").withColumn("block", block)
    wanted = spots.join(asked.select(F.col("class").alias("id")).distinct(), "id", "left_semi")
    wanted = wanted.select(F.col("id").alias("class"), F.col("vec").alias("asked"), F.explode("places").alias("p"))
    wanted = wanted.select("class", "asked", F.col("p.ordering").alias("curve"), F.col("p.pos").alias("at"))
    low = F.floor(F.greatest(F.col("at") - window, F.lit(0)) / c.block)
    high = F.floor(F.least(F.col("at") + window, F.lit(n - 1)) / c.block)
    wanted = wanted.withColumn("stretch", F.explode(F.sequence(low.cast("long"), high.cast("long"))))

    def rerank(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list = []
        if left.num_rows and right.num_rows:
            order = np.argsort(left.column("pos").to_numpy())
            pos, x = left.column("pos").to_numpy()[order], matrix(left.column("vec"), width)[order]
            ids = left.column("ids").to_pylist()
            least = left.column("id").to_numpy()[order]
            for q, at, v in zip(right.column("class").to_pylist(), right.column("at").to_pylist(), matrix(right.column("asked"), width)):
                a, b = np.searchsorted(pos, at - window, "left"), np.searchsorted(pos, at + window, "right")
                d = x[a:b] - v
                d = np.einsum("ij,ij->i", d, d)
                near = _nearest(d, least[a:b], min(k + 1, b - a)) if b > a else ()
                out += [(q, i, float(d[j])) for j in near for i in ids[order[a + j]]]
        q, i, d = zip(*out) if out else ((), (), ())
        return pa.table({"class": pa.array(q, pa.int64()), "vec_id": pa.array(i, pa.int64()), "score": pa.array(np.sqrt(np.array(d, np.float64)))})

    near = held.groupBy("ordering", "block").cogroup(wanted.groupBy("curve", "stretch")).applyInArrow(rerank, "class long, vec_id long, score double")
    near = near.groupBy("class", "vec_id").agg(F.min("score").alias("score"))
    of_class = Window.partitionBy("class").orderBy("score", "vec_id")
    near = materialize(near.withColumn("r", F.row_number().over(of_class)).filter(F.col("r") <= k + 1).drop("r"), "ann-near")
    merged = asked.join(near, "class").filter("vec_id <> query_id")
    of_query = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = merged.withColumn("rank", F.row_number().over(of_query)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
