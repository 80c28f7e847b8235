"""Embedding whitening by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance are found without forming it. A
block of vectors Q is multiplied by the covariance in one pass over the rows:
every task centres its rows and adds their part of X'(XQ), which is summed to
one matrix of dimensions x block. A Chebyshev polynomial of the covariance,
evaluated by its three-term recurrence (one pass a degree), keeps the unwanted
part of the spectrum below one and lifts the rest; QR and Rayleigh-Ritz turn
the filtered block into eigenvalue estimates, whose smallest is the next cut.
A Lanczos vector that rides along with the first filter bounds the spectrum
from below, so that nothing under the cut is lifted either. The cycles end when the
residual of every wanted pair is within ``tolerance`` of the largest
eigenvalue; a fit that cannot be certified raises an error.

Entries become whole numbers, floor(scale * c) + offset. The offset cancels in
every centred value, so it is never added before centring.

Defined cases: rows whose vector is null or holds null or non-finite entries
take no part; all other rows count and are returned, also those that repeat
an id or have none; shorter vectors end in zeros. Components whose
eigenvalue is zero within rounding are not returned (so equal rows, or a single one, give
no rows), nor more than there are dimensions. Equal eigenvalues keep the order of the
iteration. An empty table gives no rows. An entry beyond 2**52 in whole
numbers, or a deviation beyond 64 bits, raises an error. Only the key and the vector
column are read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.base import materialize
from gaugeflow.llm.passes import slices, summed
from gaugeflow.llm.vectors import finite, matrix

MOST = float(1 << 52)


@dataclass(frozen=True)
class Settings:
    scale: int = 64
    degree: int = 12
    oversampling: float = 0.5  # further block vectors, as a share of the components
    tolerance: float = 1e-13  # residual against the largest eigenvalue
    cycles: int = 40
    seed: int = 20240301


@dataclass(frozen=True)
class Fit:
    """``n`` rows; per-dimension ``sums`` of the unshifted whole numbers."""

    n: int
    sums: np.ndarray
    mean: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray  # dimensions x components
    residual: float
    passes: int


def whole_rows(rows: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """``id, x``: usable rows with floor(scale * entry) as a double array."""
    usable = rows.select(F.col(key).alias("id"), F.col(vector).alias("x")).filter(finite("x"))
    # Doubles hold these whole numbers exactly; entries beyond that are refused when they are read.
    return usable.withColumn("x", F.transform("x", lambda c: _floor(c, scale)))


def _floor(c, scale: int):
    wide = c.cast("double") * F.lit(float(scale))
    # Doubles from 2**52 on are whole; floor to a long would fail on the largest.
    return F.when(F.abs(wide) < MOST, F.floor(wide).cast("double")).otherwise(wide)


def _sums(table: DataFrame, width: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Exact row count, sums and sums of squares: squares are added in two
    halves of 26 bits, which stay within 64 bits for 2**11 times 2**26 rows."""

    def add(batch, total):
        for x in slices(matrix(batch.column(0), width)):
            if len(x) and np.abs(x).max() >= MOST:
                raise ValueError("an entry is too large for exact sums")
            w = x.astype(np.int64)
            high, low = w >> 26, w & ((1 << 26) - 1)
            total[0] += len(w)
            total[1] += high.sum(axis=0)
            total[2] += low.sum(axis=0)
            for k, product in enumerate((high * high, high * low, low * low)):
                total[3 + 2 * k] += (product >> 26).sum(axis=0)
                total[4 + 2 * k] += (product & ((1 << 26) - 1)).sum(axis=0)

    t = summed(table.select("x"), add, (9, width), np.int64)
    n = int(t[0, 0])
    whole = lambda k: [(int(a) << 26) + int(b) for a, b in zip(t[k], t[k + 1])]
    hh, hl, ll = whole(3), whole(5), whole(7)
    squares = [(a << 52) + (b << 27) + c for a, b, c in zip(hh, hl, ll)]
    return n, np.array(whole(1), object), np.array(squares, object)


def products(table: DataFrame, mean: np.ndarray, block: np.ndarray, n: int) -> np.ndarray:
    """Covariance times ``block`` in one pass."""
    width = len(mean)

    def add(batch, total):
        for x in slices(matrix(batch.column(0), width)):
            centred = x - mean
            total += centred.T @ (centred @ block)

    return summed(table.select("x"), add, block.shape) / n


def _lower_bound(alphas: list[float], betas: list[float]) -> float:
    t = np.diag(alphas) + np.diag(betas[:-1], 1) + np.diag(betas[:-1], -1)
    values, vectors = np.linalg.eigh(t)
    return max(0.0, values[0] - abs(betas[-1] * vectors[-1, 0]))


def fit(table: DataFrame, components: int, settings: Settings = Settings()) -> Fit:
    """Leading eigenpairs of the covariance of ``table`` (see ``whole_rows``)."""
    width = table.agg(F.max(F.size("x"))).first()[0] or 0
    none = Fit(0, np.zeros(width, object), np.zeros(width), 0.0, np.zeros(0), np.zeros((width, 0)), 0.0, 0)
    if not width:
        return none
    n, sums, squares = _sums(table, width)
    mean = np.array([float(s) / n for s in sums])  # of numbers below 2**52 each
    trace = float(sum(n * q - s * s for s, q in zip(sums, squares))) / n / n
    if trace <= 0:
        return Fit(n, sums, mean, 0.0, np.zeros(0), np.zeros((width, 0)), 0.0, 1)
    size = min(width, components + max(8, int(components * settings.oversampling)))
    wanted = min(components, width)
    rng = np.random.default_rng(settings.seed)
    block = np.linalg.qr(rng.standard_normal((width, size)))[0]
    lanczos = [np.linalg.qr(rng.standard_normal((width, 1)))[0][:, 0]]
    alphas, betas = [], []
    low, cut, top, passes = 0.0, trace / width, trace, 2
    image, best, stalled = None, np.inf, 0
    for cycle in range(settings.cycles):
        if size < width:  # a block of all dimensions needs no filter
            centre, half = (cut + low) / 2, max((cut - low) / 2, trace * 1e-15)
            # Scaled by the value at the largest eigenvalue, so nothing overflows.
            sigma = half / (top - centre)
            first = sigma
            before, now = block, None
            for step in range(settings.degree):
                if now is None and image is not None:
                    product = image
                else:
                    source = block if now is None else now
                    rides = len(alphas) < min(settings.degree, width - 1) and cycle == 0 and len(lanczos) > len(alphas)
                    stacked = np.column_stack((source, lanczos[-1])) if rides else source
                    product = products(table, mean, stacked, n)
                    passes += 1
                    if rides:
                        w, product = product[:, -1], product[:, :-1]
                        alphas.append(float(w @ lanczos[-1]))
                        basis = np.column_stack(lanczos)
                        for _ in range(2):
                            w = w - basis @ (basis.T @ w)
                        betas.append(float(np.linalg.norm(w)))
                        if betas[-1] > 1e-12 * trace:
                            lanczos.append(w / betas[-1])
                if now is None:
                    now = (product - centre * block) * (first / half)
                else:
                    following = 1 / (2 / first - sigma)
                    now, before = 2 * (following / half) * (product - centre * now) - (sigma * following) * before, now
                    sigma = following
            block = np.linalg.qr(now)[0]
            if cycle == 0:
                low = _lower_bound(alphas, betas)
        image = products(table, mean, block, n)
        passes += 1
        small = block.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        order = np.argsort(-values, kind="stable")
        values, turn = values[order], turn[:, order]
        block, image = block @ turn, image @ turn
        residual = float(np.linalg.norm(image - block * values, axis=0)[:wanted].max() / values[0])
        if residual <= settings.tolerance or size == width:
            break
        # At the level of rounding no cycle gets further.
        stalled = stalled + 1 if residual > best / 2 else 0
        best = min(best, residual)
        if stalled >= 3 and best <= 100 * settings.tolerance:
            break
        top, cut = values[0], min(max(values[-1], low + 1e-3 * (values[0] - low)), values[wanted - 1])
    else:
        raise ValueError(f"no certified eigenvectors after {settings.cycles} cycles: residual {residual:.3g}")
    keep = int(np.count_nonzero(values[:wanted] > 1e-12 * values[0]))
    return Fit(n, sums, mean, trace, values[:keep], block[:, :keep], residual, passes)


def identity_error(table: DataFrame, found: Fit) -> float:
    """Largest entry of the whitened rows' covariance minus the identity."""
    turn, width, k = found.vectors / np.sqrt(found.values), len(found.mean), len(found.values)

    def sums(batch, total):
        for x in slices(matrix(batch.column(0), width)):
            total += ((x - found.mean) @ turn).sum(axis=0)

    mean = summed(table.select("x"), sums, (k,)) / found.n

    def squares(batch, total):
        for x in slices(matrix(batch.column(0), width)):
            w = (x - found.mean) @ turn - mean
            total += w.T @ w

    return float(np.abs(summed(table.select("x"), squares, (k, k)) / found.n - np.eye(k)).max())


def whiten(rows: DataFrame, components: int = 32, key: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """One row per usable row and component: ``id``, ``component`` (from 1), ``n``,
    ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    spark = rows.sparkSession
    table = materialize(whole_rows(rows, key, vector, settings.scale), "whitening-rows")
    kind = table.schema["id"].dataType.simpleString()
    schema = f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    found = fit(table, components, settings)
    k, width, n = len(found.values), len(found.mean), found.n
    if not k:
        return spark.createDataFrame([], schema)
    error = identity_error(table, found)
    turn, mean, sums = found.vectors / np.sqrt(found.values), found.mean, [int(s) for s in found.sums]
    explained = found.values / found.trace

    def project(batches):
        exact = np.array(sums, np.int64) if max(map(abs, sums)) < 1 << 62 else None
        for batch in batches:
            ids = batch.column(0)
            at = 0
            for x in slices(matrix(batch.column(1), width)):
                m = len(x)
                far = np.abs(x * float(n) - np.array(sums, np.float64)).max() if m else 0.0
                if exact is None or far * far * width >= 2.0**62:
                    wide = [sum((n * int(a) - s) ** 2 for a, s in zip(r, sums)) for r in x]
                    if max(wide, default=0) >= 1 << 63:
                        raise ValueError("a deviation is beyond 64 bits")
                    deviation = np.array(wide, np.int64)
                else:
                    off = x.astype(np.int64) * n - exact
                    deviation = (off * off).sum(axis=1)
                white = (x - mean) @ turn
                own = ids.slice(at, m).take(pa.array(np.repeat(np.arange(m), k)))
                yield pa.record_batch(
                    [own, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, n, np.int64)),
                     pa.array(np.repeat(deviation, k)), pa.array(white.reshape(-1)), pa.array(np.tile(explained, m)),
                     pa.array(np.full(m * k, error))],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )
                at += m

    return table.select("id", "x").mapInArrow(project, schema)
