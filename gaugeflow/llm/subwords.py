"""Quality classifier over learned subword embeddings.

Every word, pair of neighbouring words and n-gram of 3 to 5 characters of a
text is hashed to one of ``buckets`` learned vectors; the average of a
text's vectors goes through a linear layer and a softmax. Vectors and layer
are trained by stochastic gradient descent in numpy, one document at a time with a
falling rate, on a bounded sample of the labelled rows: those with the
smallest hashes of their id, at most ``sample_rows`` of them and ``sample_features`` hashed features
(a documented bound; memory of the fit follows it). All rows are scored, over their whole
texts. As the layer is linear, the score of a text is the softmax of the average of
per-bucket scores, so scoring looks up one number per feature and class.

Words are runs of characters outside ``[\\x20\\x09-\\x0D]`` with A-Z lower-cased; an n-gram
may hold the space before and behind its word; a word that repeats the one before makes one
and the same pair, whatever the word. Features are taken in
chunks of whole texts, so memory follows the chunk or the longest text.

Defined cases: a null or empty text has no features and gets the softmax of the layer's
bias; null labels teach nothing, an id with several labels counts once for each; ties of
the sample's hash go to the smaller id; no labelled rows at all give
every class the same probability, a single class gives it one. Rows that repeat are scored
each by itself, but teach once, with the smallest text of their id. An empty table gives no rows. Only key, text and the columns named
``keep`` are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.base import materialize
from gaugeflow.llm.words import mix

_U = np.uint64
_RNG = np.random.default_rng(20240302)
_LANE = _RNG.integers(1, 1 << 63, 8, dtype=np.uint64) * _U(2) + _U(1)
_STEP = (int(_RNG.integers(1, 1 << 61)) * 8 + 5) % (1 << 64)
_STEP_INV = pow(_STEP, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 17
    dim: int = 8
    shortest: int = 3
    longest: int = 5
    epochs: int = 6
    rate: float = 2.0
    decay: float = 1e-5  # pulls used vectors towards zero
    sample_rows: int = 8192
    sample_features: int = 6_000_000
    chunk_chars: int = 1 << 16
    seed: int = 20240303


@dataclass(frozen=True)
class Model:
    classes: list[int]
    scores: np.ndarray  # buckets x classes: vectors through the layer
    bias: np.ndarray
    settings: Settings


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 17), _U(base))
        have[0] = 1
        _powers[base] = have = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def _features(texts: Sequence[str], settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Parts (buckets, text of each) of all features of a chunk of texts."""
    joined = " " + " ".join(texts) + " "
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    capital = (points >= 65) & (points <= 90)
    space = (points == 32) | ((points >= 9) & (points <= 13))
    points = np.where(space, np.uint32(32), points + (capital.astype(np.uint32) << 5))
    n = len(points)
    text_of = np.repeat(np.arange(len(texts), dtype=np.int64), [len(t) + 1 for t in texts])
    text_of = np.concatenate((text_of[:1], text_of, text_of[-1:]))[:n]
    shift = _U(64 - (settings.buckets.bit_length() - 1))
    wide = points.astype(np.uint64)
    spaces = np.concatenate(([0], np.cumsum(space)))
    acc = np.zeros(n, np.uint64)
    for k in range(settings.longest):
        if k >= n:
            break
        acc = acc[: n - k] + wide[k:] * _LANE[k]
        size = k + 1
        if size >= settings.shortest:
            # Spaces only at the ends, and not at both of a single letter's.
            at = np.flatnonzero(spaces[size - 1 : n] == spaces[1 : n - size + 2])
            yield (mix(acc[at] + _U(size)) >> shift).astype(np.int64), text_of[at + 1]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    run = np.concatenate((np.zeros(1, np.uint64), np.cumsum(wide * _power(_STEP, n), dtype=np.uint64)))
    word = mix((run[end] - run[start]) * _power(_STEP_INV, n)[start])
    of = text_of[start]
    yield (mix(word + _U(101)) >> shift).astype(np.int64), of
    same = np.flatnonzero(of[1:] == of[:-1])
    pair = np.where(word[same] == word[same + 1], _LANE[5], word[same] * _LANE[6] + word[same + 1] * _LANE[7])
    yield (mix(pair) >> shift).astype(np.int64), of[same]


def _chunks(texts: list[str | None], limit: int) -> Iterator[list[str]]:
    own, size = [], 0
    for t in texts:
        own.append(t or "")
        size += len(own[-1])
        if size >= limit:
            yield own
            own, size = [], 0
    if own:
        yield own


def counted(texts: list[str | None], settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, shares) of each text: how much of its average each one is."""
    for part in _chunks(texts, settings.chunk_chars):
        bucket, of = (np.concatenate(x) for x in zip(*_features(part, settings)))
        keys, counts = np.unique(of * settings.buckets + bucket, return_counts=True)
        owner = keys // settings.buckets
        stops = np.searchsorted(owner, np.arange(len(part) + 1))
        for a, b in zip(stops, stops[1:]):
            yield (keys[a:b] % settings.buckets).astype(np.int32), (counts[a:b] / max(1, counts[a:b].sum())).astype(np.float32)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], settings: Settings) -> Model:
    """``rows``: (class, buckets, shares)."""
    classes = sorted({c for c, _, _ in rows})
    k = max(1, len(classes))
    if len(classes) < 2:
        return Model(classes, np.zeros((settings.buckets, k), np.float32), np.zeros(k), settings)
    index = {c: i for i, c in enumerate(classes)}
    rng = np.random.default_rng(settings.seed)
    vectors = (rng.random((settings.buckets, settings.dim), np.float32) - np.float32(0.5)) / np.float32(settings.dim)
    layer, bias = np.zeros((settings.dim, k), np.float32), np.zeros(k, np.float32)
    steps, done = settings.epochs * len(rows), 0
    for _ in range(settings.epochs):
        for i in rng.permutation(len(rows)):
            target, bucket, share = rows[i]
            rate = np.float32(settings.rate * (1 - done / steps))
            done += 1
            own = vectors[bucket]
            mean = share @ own
            off = _softmax(mean @ layer + bias)
            off[index[target]] -= 1
            back = layer @ off
            layer -= rate * np.outer(mean, off)
            bias -= rate * off
            # Shares are small; their gradient is scaled up to the size of one feature among equals.
            vectors[bucket] = own * np.float32(1 - rate * settings.decay) - np.outer(rate * len(bucket) ** 0.5 * share, back)
    return Model(classes, vectors @ layer, bias.astype(np.float64), settings)


def score(texts: list[str | None], model: Model) -> np.ndarray:
    """Probabilities (texts x classes)."""
    k = model.scores.shape[1]
    columns = [np.ascontiguousarray(model.scores[:, j]) for j in range(k)]
    out = []
    for part in _chunks(texts, model.settings.chunk_chars):
        total, count = np.zeros((len(part), k)), np.zeros(len(part))
        for bucket, of in _features(part, model.settings):
            count += np.bincount(of, minlength=len(part))
            for j, c in enumerate(columns):
                total[:, j] += np.bincount(of, c[bucket], len(part))
        out.append(_softmax(total / np.maximum(count, 1)[:, None] + model.bias))
    return np.concatenate(out) if out else np.zeros((0, k))


def sample(docs: DataFrame, labels: DataFrame, key: str, label: str, settings: Settings) -> DataFrame:
    """``hash, class, text`` of the labelled rows with the smallest hashes."""
    ids = labels.select(F.col(key).alias("id"), F.col(label).cast("long").alias("class")).filter("id IS NOT NULL AND class IS NOT NULL").distinct()
    ranked = ids.select(F.xxhash64("id").alias("hash"), "id", "class")
    # Narrow rows alone are ranked; the limit is the sample's documented size.
    chosen = materialize(ranked.orderBy("hash", "id", "class").limit(settings.sample_rows), "quality-sample")
    texts = docs.select(F.col(key).alias("id"), "text")
    # An id that repeats counts with its smallest text, so the sample keeps its size.
    return texts.join(chosen, "id").groupBy("hash", "id", "class").agg(F.min("text").alias("text"))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", settings: Settings = Settings()) -> Model:
    """Fit on labelled rows of ``docs``; ``labels`` holds ``key`` and ``label``."""

    def featurise(batches):
        for batch in batches:
            made = list(counted(batch.column(3).to_pylist(), settings))
            bucket, share = [b for b, _ in made], [s for _, s in made]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(bucket, pa.list_(pa.int32())), pa.array(share, pa.list_(pa.float32()))],
                names=["hash", "id", "class", "buckets", "shares"],
            )

    kind = docs.schema[key].dataType.simpleString()
    made = sample(docs, labels, key, label, settings).mapInArrow(featurise, f"hash long, id {kind}, class long, buckets array<int>, shares array<float>")
    made = materialize(made, "quality-features")
    # The sizes (one number a row of the sample) say how many rows, in the order of the hash, meet the bound.
    rows, held = [], 0
    used = made.select("hash", "id", "class", F.size("buckets").alias("n")).collect()
    last = None
    for r in sorted(used, key=lambda r: (r["hash"], r["id"], r["class"])):
        held += r["n"]
        if held > settings.sample_features and last is not None:
            break
        last = r["hash"]
    if last is not None:
        for r in made.filter(F.col("hash") <= last).select("hash", "id", "class", "buckets", "shares").toLocalIterator():
            rows.append(((r["hash"], r["id"], r["class"]), int(r["class"]), np.array(r["buckets"], np.int32), np.array(r["shares"], np.float32)))
    rows.sort(key=lambda r: r[0])
    return train([r[1:] for r in rows], settings)


def is_held_out(key: Column, parts: int = 5, part: int = 0) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts == part, F.lit(False))


def classify(docs: DataFrame, model: Model, positive: int = 1, key: str = "doc_id", keep: Sequence[str] = ()) -> DataFrame:
    """``key``, the columns of ``keep`` and ``score``, the probability of ``positive``."""
    k = max(1, len(model.classes))
    at = model.classes.index(positive) if positive in model.classes else None
    given = 0.5 if not model.classes else 0.0
    wanted = [key, *keep]
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in wanted) + ", score double"

    def run(batches):
        for batch in batches:
            texts = batch.column(len(wanted)).to_pylist()
            own = np.full(len(texts), given) if at is None else np.ones(len(texts)) if k == 1 else score(texts, model)[:, at]
            yield pa.record_batch([*batch.columns[: len(wanted)], pa.array(own, pa.float64())], names=[*wanted, "score"])

    return docs.select(*wanted, F.col("text").alias("_text")).mapInArrow(run, schema)
