"""Exact top-k inner products by MaxScore over shards of the rows.

Every dimension is a query term with the rows' values as its postings. In a
block of a shard a term's score bound is the largest of query value times the
block's extreme values. Terms are sorted by bound; the smallest bounds that
together cannot reach the query's k-th score so far are non-essential. The
essential postings are traversed for all rows; the others are probed, in
descending order of their bounds, only for rows whose partial score plus what is left can still
compete. A block's bounds are its own, so later blocks split better.

Queries are packed in blocks and rows in shards, both by hash and bounded; each
(query block, shard) is one task's unit, and the shards' lists are merged by a
window per query that holds k rows per shard. The work is rows times queries by nature.

Defined cases: unusable vectors (see ``vectors``) take no part; rows that
repeat an id count once; shorter vectors count as ending in zeros; ties go to
the smaller id; products beyond 2**53 are computed with whole numbers and
clipped to 64 bits; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.base import materialize
from gaugeflow.llm.vectors import matrix, one_per_id

SHARD_ROWS = 16384
QUERY_ROWS = 1024
BLOCK_ROWS = 2048
FIRST_BLOCK = 64
EXACT = float(1 << 53)


def scaled(x: np.ndarray, scale: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(x * scale), -1e300, 1e300)


def _best(query: np.ndarray, rows: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple:
    """The k best (score, smaller id first) of each query, as flat arrays."""
    order = np.lexsort((ids[rows], -score, query))
    query, rows, score = query[order], rows[order], score[order]
    first = np.searchsorted(query, query, "left")
    keep = np.arange(len(query)) - first < k
    return query[keep], rows[keep], score[keep]


def search(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query index, row index, score) of the k best rows of each query."""
    n, dims = rows.shape
    found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    limit = np.full(len(queries), -np.inf)
    start, size = 0, FIRST_BLOCK
    while start < n:
        block = rows[start : start + size]
        bound = np.maximum(queries * block.max(0), queries * block.min(0))
        order = np.argsort(-bound, axis=1, kind="stable")
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.broadcast_to(np.arange(dims), order.shape), 1)
        # left[q, e]: what all terms from the e-th on can add.
        left = np.zeros((len(queries), dims + 1))
        left[:, :-1] = np.cumsum(np.take_along_axis(bound, order, 1)[:, ::-1], 1)[:, ::-1]
        essential = (left[:, 1:] >= limit[:, None]).sum(1)
        done = np.zeros(len(queries), np.int64)
        partial = np.zeros((len(queries), len(block)))
        alive = ids[None, start : start + size] != own[:, None]
        for share in (0.0, 0.5, 1.0):
            upto = essential + np.ceil((dims - essential) * share).astype(np.int64)
            terms = (place >= done[:, None]) & (place < upto[:, None])
            if alive.mean() > 0.125:  # most rows compete: one product for all
                partial += (queries * terms) @ block.T
            else:
                q, r = np.nonzero(alive)
                for a in range(0, len(q), 1 << 15):
                    b = slice(a, a + (1 << 15))
                    partial[q[b], r[b]] += np.einsum("ij,ij->i", queries[q[b]] * terms[q[b]], block[r[b]])
            alive &= partial + np.take_along_axis(left, upto[:, None], 1) >= limit[:, None]
            done = upto
        q, r = np.nonzero(alive)
        merged = [np.concatenate(x) for x in zip(found, (q, r + start, partial[q, r]))]
        found = _best(*merged, ids, k)
        last = np.flatnonzero(np.bincount(found[0], minlength=len(queries)) >= k)
        ends = np.searchsorted(found[0], last, "right") - 1
        limit[last] = found[2][ends]
        start, size = start + len(block), min(size * 2, BLOCK_ROWS)
    return found


def _exact(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple:
    """The same with whole numbers of any size."""
    whole = np.frompyfunc(int, 1, 1)
    score = np.clip(whole(queries).dot(whole(rows).T), -(1 << 63), (1 << 63) - 1)
    out: list = []
    for q in range(len(queries)):
        best = sorted((-int(s), int(ids[r]), r) for r, s in enumerate(score[q]) if ids[r] != own[q])[:k]
        out += [(q, r, -s) for s, _, r in best]
    q, r, s = zip(*out) if out else ((), (), ())
    return np.array(q, np.int64), np.array(r, np.int64), np.array(s, np.int64)


def _packed(rows: DataFrame, name: str, parts: int, width: int, scale: float) -> DataFrame:
    """``name, ids, values``: the rows of one hash part in one row, by id."""

    def run(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("id").to_numpy())
        ids = group.column("id").to_numpy()[order]
        values = scaled(matrix(group.column("vec"), width)[order], scale)
        return pa.table({name: group.column(name).slice(0, 1), "ids": [ids.astype(np.int64).tobytes()], "values": [values.tobytes()]})

    part = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")
    return rows.withColumn(name, part).groupBy(name).applyInArrow(run, f"{name} int, ids binary, values binary")


def top_k(rows: DataFrame, is_query: Callable[[Column], Column], k: int, scale: float = 64.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row whose id is a query
    the ``k`` other rows of the highest inner product of floor(scale * x)."""
    base = materialize(one_per_id(rows, key, vector), "vectors")
    facts = base.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("vec")), F.lit(0)).alias("width"), F.coalesce(F.sum(is_query(F.col("id")).cast("int")), F.lit(0)).alias("q")).first()
    width, shards, blocks = max(facts["width"], 1), facts["n"] // SHARD_ROWS + 1, facts["q"] // QUERY_ROWS + 1
    docs = _packed(base, "shard", shards, width, scale).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asks = _packed(base.filter(is_query(F.col("id"))), "block", blocks, width, scale)
    asks = asks.withColumnsRenamed({"ids": "query_ids", "values": "query_values"})
    # Every query block meets every shard once; both are packed rows.
    asks = asks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, values, query_ids, query_values in zip(*[b.column(c).to_pylist() for c in ("ids", "values", "query_ids", "query_values")]):
                ids, own = np.frombuffer(ids, np.int64), np.frombuffer(query_ids, np.int64)
                values, asked = np.frombuffer(values).reshape(len(ids), width), np.frombuffer(query_values).reshape(len(own), width)
                small = width * max(np.abs(values).max(), 1.0) * max(np.abs(asked).max(), 1.0) < EXACT
                q, r, score = (search if small else _exact)(asked, own, values, ids, k)
                yield pa.RecordBatch.from_arrays([pa.array(own[q]), pa.array(ids[r]), pa.array(score.astype(np.int64))], ["query_id", "vec_id", "score"])

    parts = docs.join(asks, ["shard", "block"]).mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = parts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
