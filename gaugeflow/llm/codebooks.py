"""Vector code compression: product codebooks with Orchard search.

A vector of whole numbers is cut into equal parts; each part position has a
codebook, refined by rounds of assignment and averaging. An assignment finds
the exact nearest entry by Orchard's method: every entry has a list of the
others sorted by distance. A search stands at the best entry so far and walks
its list; an entry that is nearer becomes the best one and the walk goes on
in its list. Entries measured before are marked and not measured again. The
walk stops at the first entry farther than twice the current distance: by the
triangle inequality neither it nor any behind it can be nearer, or as near. Searches
of a batch advance together, some list entries at a time.

A round is one pass over the rows; each task adds counts and sums per entry,
which are summed to one array of (parts x entries x part width).

Defined cases: rows whose vector is null or holds null or non-finite
components take no part; all others count, also those that repeat an id or
have none (they follow all ids); vectors are filled up with zeros to the longest
one, rounded up to whole parts. Ties go to the lower entry. With fewer rows than entries
the codebooks have an entry per row. An empty table gives no rows. A component beyond 2**29
in whole numbers, or a squared distance beyond 64 bits, raises an error. Only the key, vector and label
columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.base import materialize
from gaugeflow.llm.passes import slices, summed
from gaugeflow.llm.vectors import finite, matrix

LARGEST = float(1 << 29)
#: List entries that a search looks at before it moves on, and the entries it may start from.
STRIDE = 16
STARTS = 16
SEARCHES = 4096


@dataclass(frozen=True)
class Book:
    """Entries of one part position and, per entry, the others by distance."""

    entries: np.ndarray  # whole numbers
    order: np.ndarray
    gaps: np.ndarray  # squared distances in that order


def book(entries: np.ndarray) -> Book:
    exact = _kind(np.abs(entries).max(initial=0), entries.shape[1])
    e = entries.astype(exact)
    k = len(e)
    square = np.zeros((k, k), exact)
    for i in range(k):
        square[i] = ((e - e[i]) ** 2).sum(axis=1)
    # An entry is not in its own list.
    others = np.array([[j for j in range(k) if j != i] for i in range(k)], np.int64).reshape(k, k - 1)
    gaps = np.take_along_axis(square, others, axis=1)
    rank = np.argsort(gaps, axis=1, kind="stable")
    return Book(entries, np.take_along_axis(others, rank, axis=1), np.take_along_axis(gaps, rank, axis=1))


def _kind(largest: float, width: int) -> type:
    """Doubles where they hold four times every squared distance exactly."""
    most = 4 * (2 * float(largest)) ** 2 * width
    if most < 2.0**53:
        return np.float64
    if largest < LARGEST and most < 2.0**63:
        return np.int64
    raise ValueError("a component is too large for exact distances")


def orchard(rows: np.ndarray, books: Book) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, squared distance) of each row; ties to the lower entry."""
    kind = _kind(max(np.abs(rows).max(initial=0), np.abs(books.entries).max(initial=0)), rows.shape[1])
    entries, points, gaps, order = books.entries.astype(kind), rows.astype(kind), books.gaps.astype(kind), books.order
    k, n = len(entries), len(rows)
    best, least = np.zeros(n, np.int64), np.zeros(n, kind)
    for a in range(0, n, SEARCHES):
        best[a : a + SEARCHES], least[a : a + SEARCHES] = _search(points[a : a + SEARCHES], entries, order, gaps, k)
    return best, least.astype(np.int64)


def _search(points, entries, order, gaps, k):
    n = len(points)
    starts = np.unique(np.linspace(0, k - 1, STARTS).astype(np.int64))
    apart = np.stack([((points - entries[s]) ** 2).sum(axis=1) for s in starts], axis=1)
    at = apart.argmin(axis=1)
    best, least = starts[at], apart[np.arange(n), at]
    seen = np.zeros((n, k), bool)
    seen[:, starts] = True
    place = np.zeros(n, np.int64)
    going = np.arange(n) if k > 1 else np.zeros(0, np.int64)
    ahead = np.arange(STRIDE)
    unmeasured = np.inf if points.dtype == np.float64 else np.iinfo(np.int64).max
    while len(going):
        where = place[going][:, None] + ahead
        there = where < k - 1
        where = np.minimum(where, k - 2)
        stand = best[going]
        flat = stand[:, None] * (k - 1) + where
        entry = order.take(flat)
        near = there & (gaps.take(flat) <= 4 * least[going][:, None])
        slot = going[:, None] * k + entry
        fresh = near & ~seen.take(slot)
        i, j = np.nonzero(fresh)
        measured = entry[i, j]
        seen.reshape(-1)[slot[i, j]] = True
        off = points.take(going[i], axis=0) - entries.take(measured, axis=0)
        # The nearest of the measured ones, ties to the lower entry.
        apart = np.full(fresh.shape, unmeasured, points.dtype)
        apart[i, j] = np.einsum("ij,ij->i", off, off)
        nearest = apart.min(axis=1)
        lowest = np.where(fresh & (apart == nearest[:, None]), entry, k).min(axis=1)
        better = (nearest < least[going]) | ((nearest == least[going]) & (lowest < stand))
        moved = going[better]
        best[moved], least[moved] = lowest[better], nearest[better]
        place[going] += STRIDE
        place[moved] = 0
        # Done: the list ended or went beyond twice the distance, without a move.
        going = going[near.all(axis=1) | better]
    return best, least


def _whole(rows: DataFrame, key: str, vector: str, label: str | None, scale: int) -> DataFrame:
    """``id, label, x``: usable rows with floor(scale * component) as doubles."""
    part = F.col(label) if label else F.lit(None).cast("int")
    usable = rows.select(F.col(key).alias("id"), part.alias("label"), F.col(vector).alias("x")).filter(finite("x"))
    wide = lambda c: c.cast("double") * F.lit(float(scale))
    return usable.withColumn("x", F.transform("x", lambda c: F.when(F.abs(wide(c)) < LARGEST, F.floor(wide(c)).cast("double")).otherwise(wide(c))))


def _parts(column, width: int, parts: int):
    """Batches of rows cut into parts: rows x parts x part width, whole numbers."""
    for x in slices(matrix(column, width)):
        if len(x) and np.abs(x).max() >= LARGEST:
            raise ValueError("a component is too large for exact distances")
        yield x.astype(np.int64).reshape(len(x), parts, width // parts)


def learn(table: DataFrame, parts: int, entries: int, rounds: int) -> np.ndarray:
    """Codebooks (parts x entries x part width) after ``rounds`` rounds."""
    width = table.agg(F.max(F.size("x"))).first()[0] or 0
    width = -(-width // parts) * parts
    # The entries to start from are as many as the books have (bounded).
    seeds = table.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    start = np.zeros((len(seeds), width), np.int64)
    for i, r in enumerate(seeds):
        if max(map(abs, r["x"]), default=0) >= LARGEST:
            raise ValueError("a component is too large for exact distances")
        start[i, : len(r["x"])] = r["x"]
    found = start.reshape(len(seeds), parts, width // parts).transpose(1, 0, 2).copy()
    k, w = found.shape[1:]
    if not k or not w:
        return found
    for _ in range(rounds):
        books = [book(e) for e in found]

        def add(batch, total):
            for cut in _parts(batch.column(0), width, parts):
                for p in range(parts):
                    code, _ = orchard(cut[:, p], books[p])
                    rank = np.argsort(code, kind="stable")
                    own, first = np.unique(code[rank], return_index=True)
                    total[p, own, :w] += np.add.reduceat(cut[rank, p], first, axis=0)
                    total[p, own, w] += np.bincount(code, minlength=k)[own]

        total = summed(table.select("x"), add, (parts, k, w + 1), np.int64)
        count = total[:, :, w:]
        found = np.where(count > 0, total[:, :, :w] // np.maximum(count, 1), found)
    return found


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def compress(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str | None = "label",
    parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024,
) -> DataFrame:
    """One row per usable row: ``id, label, code, error, label_error, codebooks_sha256``."""
    if entries > 256:
        raise ValueError("a code has two hex digits: at most 256 entries")
    table = materialize(_whole(rows, key, vector, label, scale), "codebook-rows")
    books = learn(table, parts, entries, rounds)
    made = digest(books)
    k, w = books.shape[1:]
    width = parts * w
    kind, group = (table.schema[c].dataType.simpleString() for c in ("id", "label"))

    def encode(batches):
        lists = [book(e) for e in books] if k and w else []
        for batch in batches:
            ids, labels, at = batch.column(0), batch.column(1), 0
            for cut in _parts(batch.column(2), width, parts) if w else [np.zeros((batch.num_rows, parts, 0), np.int64)]:
                m = len(cut)
                both = [orchard(cut[:, p], b) for p, b in enumerate(lists)]
                codes = np.stack([c for c, _ in both], axis=1) if both else np.zeros((m, parts), np.int64)
                text = [bytes(r).hex() for r in codes.astype(np.uint8)]
                error = sum((e for _, e in both), np.zeros(m, np.int64))
                yield pa.record_batch([ids.slice(at, m), labels.slice(at, m), pa.array(text, pa.string()), pa.array(error)], names=["id", "label", "code", "error"])
                at += m

    coded = materialize(table.select("id", "label", "x").mapInArrow(encode, f"id {kind}, label {group}, code string, error long"), "codes")
    # Written, so the join below reads one row per label as a plain scan and AQE can split a hot label.
    sums = materialize(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "id", "label", "code", "error", "label_error", F.lit(made).alias("codebooks_sha256")
    )
