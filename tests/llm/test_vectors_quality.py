"""Whitening, codebooks and the quality classifier against brute force."""

import hashlib
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import codebooks, passes, subwords, whitening
from gaugeflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
VECS = "vec_id long, embedding array<float>, label int"


# --- whitening -------------------------------------------------------------


def check_whitening(found, rows, components):
    """Every contract of the result against numpy on whole numbers."""
    x = np.floor(64 * np.array(rows, np.float64))
    n, width = x.shape
    v = np.cov(x.T, bias=True).reshape(width, width)
    values = np.linalg.eigvalsh(v)[::-1]
    k = min(components, int((values > 1e-12 * values[0]).sum()))
    assert len(found) == n * k
    white = np.array([r["whitened"] for r in found]).reshape(n, k)
    assert np.abs(np.cov(white.T, bias=True).reshape(k, k) - np.eye(k)).max() < 1e-8
    assert np.abs(white.mean(axis=0)).max() < 1e-9
    # Turned back, a component is a unit eigenvector.
    turn = np.linalg.lstsq(x - x.mean(axis=0), white, rcond=None)[0] * np.sqrt(values[:k])
    exact = [int(a) for a in x.sum(axis=0)]
    for j, r in enumerate(found[:k]):
        assert r["component"] == j + 1 and abs(r["explained"] - values[j] / np.trace(v)) < 1e-9 * r["explained"] and r["identity_error"] < 1e-10
    deviation = [sum((n * int(c) - s) ** 2 for c, s in zip(row, exact)) for row in x]
    assert [r["deviation"] for r in found[::k]] == deviation and {r["n"] for r in found} == {n}
    return turn, v, values[:k]


def ordered(frame):
    return sorted(frame.collect(), key=lambda r: (r["id"], r["component"]))


def test_whitening_matches_a_full_decomposition(spark):
    rng = np.random.default_rng(5)
    # Close eigenvalues, a strong direction, and a large offset that must not cost digits.
    rows = (rng.standard_normal((700, 24)) * np.linspace(1, 1.6, 24) + 3 * rng.standard_normal((700, 1)) * (np.arange(24) == 4) + 5).astype(np.float32)
    frame = spark.createDataFrame([(i, r.tolist(), None) for i, r in enumerate(rows)], VECS).repartition(5)
    found = ordered(whitening.whiten(frame, components=5))
    turn, v, values = check_whitening(found, rows, 5)
    assert np.abs(v @ turn - turn * values).max() < 1e-7 * values[0]
    table = whitening.whole_rows(frame, "vec_id", "embedding", 64)
    fit = whitening.fit(table, 5)
    assert fit.passes > 12 and fit.residual < 1e-12  # the filter ran: the block is smaller than the space
    assert np.abs(v @ fit.vectors - fit.vectors * values).max() < 1e-11 * values[0]


def test_whitening_of_a_tail_near_zero(spark):
    """Most of the spectrum near zero, a few strong directions: nothing under the cut is lifted."""
    rng = np.random.default_rng(6)
    scales = np.concatenate((np.linspace(4, 3, 6), np.full(34, 0.02)))
    rows = (rng.standard_normal((400, 40)) * scales).astype(np.float32)
    frame = spark.createDataFrame([(i, r.tolist(), None) for i, r in enumerate(rows)], VECS)
    check_whitening(ordered(whitening.whiten(frame, components=6)), rows, 6)


def test_whitening_odd_rows(spark):
    base = [[1.0, 2.0], [2.0, 1.0], [0.5, 0.25], [1.0, 2.0]]
    rows = [(i, v, 0) for i, v in enumerate(base)] + [(1, [9.0], 0), (None, [3.0, 3.0], 1)]
    bad = [(20, None, 0), (21, [None, 1.0], 0), (22, [float("nan"), 1.0], 0), (23, [float("inf"), 0.0], 0)]
    frame = spark.createDataFrame(rows + bad, VECS).select("*", F.lit("x").alias("id"), F.lit(1).alias("x"), F.lit(2).alias("component"))
    got = whitening.whiten(frame, components=32).collect()
    # Repeated ids and a missing one stay rows; the short vector ends in a zero.
    assert sorted((r["id"] is None, r["id"]) for r in got if r["component"] == 1) == [(False, 0), (False, 1), (False, 1), (False, 2), (False, 3), (True, None)]
    assert {r["component"] for r in got} == {1, 2} and {r["n"] for r in got} == {6}
    flat = np.floor(64 * np.array([[*v, 0.0][:2] for _, v, _ in rows]))
    assert sorted(r["deviation"] for r in got if r["component"] == 1) == sorted(int(((6 * x - flat.sum(axis=0)) ** 2).sum()) for x in flat)
    for none in (frame.limit(0), spark.createDataFrame([(1, [2.0, 3.0], 0)] * 3, VECS), spark.createDataFrame([(1, [], 0)], VECS)):
        assert whitening.whiten(none).collect() == []
    # One direction only: one component.
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0], 0) for i in range(6)], VECS)
    assert {r["component"] for r in whitening.whiten(line).collect()} == {1}
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [1e300], 0), (2, [1.0], 0)], "vec_id long, embedding array<double>, label int"))


def test_deviation_beyond_doubles_is_exact(spark):
    rows = [(i, [float(2**20 + i), 0.5 * i], 0) for i in range(2000)]
    got = {r["id"]: r["deviation"] for r in whitening.whiten(spark.createDataFrame(rows, VECS), components=1).collect()}
    x = [[64 * (2**20 + i), 32 * i] for i in range(2000)]
    sums = [sum(c) for c in zip(*x)]
    assert got == {i: sum((2000 * c - s) ** 2 for c, s in zip(r, sums)) for i, r in enumerate(x)}


def test_whitening_query(spark):
    found = sorted(QUERIES["op11_whitening"](spark, SF).collect(), key=lambda r: (r["vec_id"], r["component"]))
    rows = sorted((r["vec_id"], r["embedding"]) for r in pq.read_table(f"{SF}/embeddings.parquet").to_pylist())
    check_whitening(found, [v for _, v in rows], 32)


def test_sums_over_many_tasks(spark):
    frame = spark.range(0, 5000, 1, 37).select(F.array("id", F.col("id") * 2).alias("x"))

    def add(batch, total):
        total += np.array(batch.column(0).to_pylist(), np.int64).sum(axis=0)

    assert passes.summed(frame, add, (2,), np.int64).tolist() == [12497500, 24995000]


# --- codebooks -------------------------------------------------------------


def plain_nearest(rows, entries):
    square = ((rows[:, None, :].astype(object) - entries[None].astype(object)) ** 2).sum(axis=2)
    best = [min(range(len(entries)), key=lambda k: (r[k], k)) for r in square]
    return np.array(best), np.array([square[i, b] for i, b in enumerate(best)], object)


def plain_codes(rows, parts=4, entries=256, rounds=4):
    """rows: (id, label, vector) usable, in order of the start."""
    x = np.array([[int(np.floor(1024 * float(c))) for c in v] for _, _, v in rows], np.int64)
    cut = x.reshape(len(x), parts, -1)
    books = [cut[:entries, p].copy() for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            code, _ = plain_nearest(cut[:, p], books[p])
            for k in range(len(books[p])):
                own = cut[code == k, p]
                if len(own):
                    books[p][k] = own.sum(axis=0) // len(own)
    last = [plain_nearest(cut[:, p], books[p]) for p in range(parts)]
    error = [int(sum(d[i] for _, d in last)) for i in range(len(x))]
    by_label = {}
    for (_, label, _), e in zip(rows, error):
        by_label[label] = by_label.get(label, 0) + e
    sha = hashlib.sha256(",".join(str(int(c)) for b in books for c in b.reshape(-1)).encode()).hexdigest()
    return [(i, bytes([int(c[n]) for c, _ in last]).hex(), e, by_label[label], sha) for n, ((i, label, _), e) in enumerate(zip(rows, error))]


@pytest.mark.parametrize("spread, size", [(3, 256), (200, 256), (5, 40), (1 << 24, 60), (2, 1), (2, 2)])
def test_orchard_finds_the_nearest_and_lowest(spread, size):
    """Small spreads make many ties and equal entries; the largest needs whole numbers."""
    rng = np.random.default_rng(size + spread)
    rows, entries = rng.integers(-spread, spread, (900, 4)), rng.integers(-spread, spread, (size, 4))
    best, square = codebooks.orchard(rows, codebooks.book(entries))
    want, error = plain_nearest(rows, entries)
    assert (best == want).all() and (square == error.astype(np.int64)).all()


def test_orchard_skips_what_is_far():
    """Two far clusters: entries of the other one are never measured."""
    entries = np.concatenate((np.arange(64)[:, None] * 10, np.arange(64)[:, None] * 10 + 10**6))
    books, rows = codebooks.book(entries), np.array([[5], [10**6 + 205]])
    best, square = codebooks.orchard(rows, books)
    assert best.tolist() == [0, 84] and square.tolist() == [25, 25]
    assert (books.gaps[0] <= 4 * 25).sum() == 1


def test_codes_match_plain_rounds(spark):
    rng = np.random.default_rng(9)
    rows = [(int(i), int(i) % 3 if i % 5 else None, [float(np.float32(c)) for c in rng.integers(-9, 9, 8) / 8]) for i in rng.permutation(400) - 7]
    frame = spark.createDataFrame([(i, v, lab) for i, lab, v in rows], VECS).repartition(7)
    got = sorted(map(tuple, codebooks.compress(frame).select("id", "code", "error", "label_error", "codebooks_sha256").collect()))
    assert got == sorted(plain_codes(sorted(rows, key=lambda r: r[0])))


def test_codes_of_odd_rows(spark):
    rows = [(1, [1.0, 2.0, 3.0], None), (1, [1.0, 2.0, 3.0], None), (2, [0.5], 4), (None, [0.25, 0.5, 1.0, 2.0, 8.0], 4), (3, [], 4)]
    bad = [(10, None, 1), (11, [None], 1), (12, [float("nan")], 1), (13, [float("-inf")], 1)]
    frame = spark.createDataFrame(rows + bad, VECS).select("*", F.lit(1).alias("id"), F.lit(2).alias("x"), F.lit("c").alias("code"))
    got = codebooks.compress(frame, entries=2).collect()
    full = [(i, lab, ([*v] + [0.0] * 8)[:8]) for i, v, lab in rows]
    want = plain_codes(sorted(full, key=lambda r: (r[0] is None, r[0] or 0, r[2])), entries=2)
    key = lambda r: tuple(map(str, r))
    assert sorted(((r["id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got), key=key) == sorted(want, key=key)
    assert codebooks.compress(frame.limit(0)).collect() == []
    assert [r["code"] for r in codebooks.compress(spark.createDataFrame([(1, [], 0)], VECS)).collect()] == ["00000000"]
    with pytest.raises(Exception, match="too large"):
        codebooks.compress(spark.createDataFrame([(1, [1e30], 0), (2, [1.0], 0)], VECS))
    with pytest.raises(ValueError):
        codebooks.compress(frame, entries=300)


# --- quality classifier ----------------------------------------------------

SMALL = subwords.Settings(buckets=1 << 12, sample_rows=300, epochs=4)


def plain_features(text, settings):
    """(kind, value) of every feature, one by one."""
    words = [w.decode("utf-8", "surrogatepass") for w in (text or "").encode("utf-8", "surrogatepass").lower().split()]
    out = []
    for w in words:
        marked = f" {w} "
        for n in range(settings.shortest, settings.longest + 1):
            out += [marked[i : i + n] for i in range(len(marked) - n + 1)]
        out.append(("word", w))
    return out + [("same",) if a == b else ("pair", a, b) for a, b in zip(words, words[1:])]


def test_features_are_those_of_each_text():
    """Equal features meet in equal buckets, wherever they stand and whatever stands around."""
    settings = subwords.Settings(buckets=1 << 30)
    texts = ["", None, "a", "ab ab", "The  the\tcat\n", "ÉA éa x", "one two one two", "😀 b", " ", "x" * 70000 + " y", "the cat"]
    named, made = {}, list(subwords.counted(texts, settings))
    for t, (bucket, share) in zip(texts, made):
        want = plain_features(t, settings)
        assert len(bucket) == len(set(want)) and (not want or abs(share.sum() - 1) < 1e-3)
        counts = sorted(want.count(f) for f in set(want)) if len(want) < 1000 else None
        assert counts is None or counts == sorted(np.rint(share * len(want)).astype(int).tolist())
        named.setdefault(frozenset(want), set()).add(tuple(bucket.tolist()))
    assert all(len(v) == 1 for v in named.values())
    cat = lambda t: set(made[texts.index(t)][0].tolist())
    assert len(cat("the cat") & cat("The  the\tcat\n")) == len(set(plain_features("the cat", settings)))


def test_training_follows_the_gradient():
    """Losses fall, and the score is the softmax of averaged vectors through the layer."""
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["good", "fine", "nice"] if y else ["bad", "poor", "sad"], 6)) for y in (0, 1) * 60]
    rows = [(i % 2, *f) for i, f in enumerate(subwords.counted(texts, SMALL))]
    model = subwords.train(rows, SMALL)
    scores = subwords.score(texts + ["", None], model)
    assert ((scores[:120, 1] > 0.5) == (np.arange(120) % 2 == 1)).all()
    for (_, bucket, share), s in zip(rows[:20], scores):
        plain = share @ model.scores[bucket] + model.bias
        assert np.abs(np.exp(plain) / np.exp(plain).sum() - s).max() < 1e-5
    assert np.abs(scores[120] - scores[121]).max() == 0 and np.abs(subwords._softmax(model.bias) - scores[120]).max() < 1e-12


def test_classifier_on_odd_rows(spark):
    docs = spark.createDataFrame([(1, "good text"), (1, "good text"), (2, None), (None, "x y"), (4, ""), (5, "word " * 30000)], "doc_id long, text string")
    docs = docs.select("*", F.lit(9).alias("score"), F.lit("s").alias("_text"), F.lit(3).alias("class"))
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (4, None), (None, 1), (5, 0), (7, 1)], "doc_id long, quality int")
    model = subwords.learn(docs, labels, settings=SMALL)
    got = subwords.classify(docs, model, keep=["class"])
    assert got.columns == ["doc_id", "class", "score"]
    rows = got.collect()
    assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (2, 4)}) == 1
    assert subwords.classify(docs.limit(0), model).collect() == []
    none = subwords.learn(docs, labels.limit(0), settings=SMALL)
    assert {r["score"] for r in subwords.classify(docs, none).collect()} == {0.5}
    one = subwords.learn(docs, labels.filter("quality = 0"), settings=SMALL)
    assert {r["score"] for r in subwords.classify(docs, one).collect()} == {0.0}
    assert {r["score"] for r in subwords.classify(docs, one, positive=0).collect()} == {1.0}


def test_the_sample_keeps_its_bound(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    few = subwords.Settings(buckets=1 << 10, sample_rows=50)
    got = subwords.sample(docs, labels, "doc_id", "quality", few).select("id").collect()
    want = labels.orderBy(F.xxhash64("doc_id")).limit(50).select("doc_id").collect()
    assert sorted(r[0] for r in got) == sorted(r[0] for r in want)


def test_quality_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in QUERIES["op12_quality_subwords"](spark, sf).collect()}
    docs = pq.read_table(f"{sf}/documents.parquet").to_pylist()
    assert set(rows) == {d["doc_id"] for d in docs}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.3) for i, r in rows.items())
    held = [(rows[x["doc_id"]]["predicted"], x["quality"]) for x in pq.read_table(f"{sf}/labels.parquet").to_pylist() if rows[x["doc_id"]]["held_out"]]
    assert len(held) > 50 and sum(p == q for p, q in held) / len(held) > 0.9
