"""Operators on small tables with nulls, empty and long texts, ties, repeated
rows, empty tables and clashing column names, against brute force."""

import base64
import hashlib
import json
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gaugeflow.llm import binpack, curriculum, hilbert, language, maxscore, ngram_join, pieces, toolcalls, url_reputation, warc_store
from gaugeflow.llm.components import components
from gaugeflow.llm.queries import PIECE_MODEL, TOOLS, URL_RULES
from gaugeflow.llm.words import shingle_sets, word_codes

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], DOCS)


# --- words -----------------------------------------------------------------


def test_words_follow_ascii_spaces_only():
    texts = ["", " \t\n", "One two\u00a0three\x0bone", "ÉA éa", "a" * 3_000_000]
    codes, counts = word_codes([t.encode() for t in texts])
    assert counts.tolist() == [len(t.encode().split()) for t in texts] == [0, 0, 3, 2, 1]
    assert codes[0] == codes[2]  # A-Z lower-cased
    assert codes[3] != codes[4]  # other letters are not


def test_shingle_sets_count_distinct_sequences():
    rng = random.Random(1)
    texts = [None, "", "a", "a b c d", "a b c d", "A b c d e"] + [" ".join(rng.choices("abc", k=rng.randint(0, 40))) for _ in range(200)]
    sets = list(shingle_sets(texts, 5))

    def plain(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()

    for i, t in enumerate(texts):
        assert len(sets[i]) == len(plain(t))
        for j in (0, 3, 17):
            assert len(np.intersect1d(sets[i], sets[j])) == len(plain(t) & plain(texts[j]))


# --- components ------------------------------------------------------------


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, k) for k in range(1001, 1040)] + [(7, 7), (None, 3), (3, None)]
    edges += [(rng.randint(2000, 2200), rng.randint(2000, 2200)) for _ in range(120)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert got == {n: find(n) for n in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- 1 url reputation --------------------------------------------------------


def test_url_rules_and_parts(spark):
    urls = {
        1: "http://A.Example.ORG/es/x?q#f", 2: "https://b.org", 3: "http://b.org?x/", 4: "x://example.org/en/1", 5: None,
        6: "no scheme/path", 7: "http://shop.com/de/", 8: "http://shop.com/fr/a://b/", 9: "http://notorg/", 10: "http://example.org/en/2",
    }
    pages = spark.createDataFrame([(k, u, "x") for k, u in urls.items()], "page_id long, url string, host string")
    labels = spark.createDataFrame([], "page_id long, good int")
    got = {r["page_id"]: r for r in url_reputation.judge_urls(pages, labels, URL_RULES).collect()}
    assert (got[1]["host"], got[1]["path"], got[1]["rule"], got[1]["verdict"]) == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert (got[2]["path"], got[2]["rule"]) == ("", None) and got[3]["host"] == "b.org" and got[3]["path"] == ""
    assert (got[4]["rule"], got[4]["verdict"]) == ("example.org/en/1", "block")
    assert got[5]["host"] == got[5]["path"] == got[6]["host"] == got[6]["path"] == ""
    assert (got[7]["verdict"], got[8]["verdict"], got[9]["rule"], got[10]["rule"]) == ("block", "allow", None, "org/")
    assert all(got[k]["verdict"] in ("allow", "block") for k in got)


def test_reputation_shrinks_to_the_domain(spark):
    pages, labels = [], []
    for host, good, bad in (("a.good.net", 40, 2), ("b.good.net", 35, 1), ("new.good.net", 0, 0), ("x.bad.net", 1, 30), ("new.bad.net", 0, 0), ("one.bad.net", 1, 0)):
        for k in range(max(good + bad, 1)):
            pages.append((len(pages), f"http://{host}/{k}"))
            if good + bad:
                labels.append((len(pages) - 1, int(k < good)))
    labels += [(None, 1), (0, None), (10**9, 1)]
    got = url_reputation.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, good int"))
    mean = {r["host"]: r["mean"] for r in got.collect()}
    assert min(mean["a.good.net"], mean["new.good.net"]) > 0.8 > mean["new.bad.net"] and mean["one.bad.net"] < 0.6
    assert got.count() == len(pages)


# --- 2 maxscore ----------------------------------------------------------------


def plain_top(vectors, is_query, k):
    v = {i: [int(np.floor(64 * float(x))) for x in e] for i, e in vectors.items()}
    out = {}
    for q in v:
        if is_query(q):
            scores = [(-sum(a * b for a, b in zip(v[q], v[c])), c) for c in v if c != q]
            out[q] = [(c, -s) for s, c in sorted(scores)[:k]]
    return out


@pytest.mark.parametrize("kind", ["dense", "sparse", "ties"])
def test_maxscore_blocks_are_exact(kind):
    rng = np.random.default_rng(4)
    rows = rng.integers(-30, 31, (700, 24)).astype(float)
    if kind == "sparse":
        rows[rng.random(rows.shape) < 0.9] = 0
    if kind == "ties":
        rows[100:400] = rows[5]
    ids, asked = np.arange(700) * 3, np.arange(0, 700, 7)
    q, r, s = maxscore.search(rows[asked], ids[asked], rows, ids, 20)
    for n, a in enumerate(asked):
        score = rows @ rows[a]
        want = [(int(i), score[i]) for i in np.lexsort((ids, -score)) if i != a][:20]
        assert [(int(x), y) for x, y in zip(r[q == n], s[q == n])] == want


def test_maxscore_query(spark):
    rng = np.random.default_rng(5)
    rows = {i: rng.normal(size=6).tolist() for i in range(1, 120)}
    rows |= {200: rows[20], 220: rows[20], 240: [0.0] * 6, 260: [1.0, 2.0], 280: []}
    bad = [(300, None), (320, [1.0, None]), (340, [float("nan")]), (360, [float("inf")]), (None, [1.0])]
    frame = spark.createDataFrame([(i, v, 7) for i, v in [*rows.items(), *bad, (20, rows[20])]], "vec_id long, embedding array<double>, rank int")
    got = {}
    for r in maxscore.top_k(frame, lambda i: i % 20 == 0, 20).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = plain_top({i: v + [0.0] * (6 - len(v)) for i, v in rows.items()}, lambda i: i % 20 == 0, 20)
    assert {q: [(c, s) for _, c, s in sorted(x)] for q, x in got.items()} == want
    assert all([r for r, _, _ in sorted(x)] == list(range(1, 21)) for x in got.values())
    assert maxscore.top_k(frame.limit(0), lambda i: i % 20 == 0, 20).count() == 0


def test_maxscore_of_huge_components(spark):
    frame = spark.createDataFrame([(20, [1e7, 3.0]), (21, [1e7, 1.0]), (22, [1e300, 1.0])], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["score"] for r in maxscore.top_k(frame, lambda i: i % 20 == 0, 20).collect()}
    assert got == {21: 640_000_000**2 + 192 * 64, 22: 2**63 - 1}


# --- 3 n-gram join ---------------------------------------------------------------


def plain_components(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return sorted(((k, len(s), least.get(find(i)) if s else k) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=repr)


def near_copies(rng, words, n, edits):
    out = []
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"x{rng.randint(0, 5000)}"
        out.append(" ".join(w))
    return out


def test_ngram_components(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = rng.choices(vocabulary, k=60)
    texts = [None, "", "  \n", "one", "ONE", "one two three", "a b c d e", "A b  c\td e", "z" * 200_000]
    texts += near_copies(rng, rng.choices(vocabulary, k=120), 130, 9)
    texts += [" ".join(rng.choices(vocabulary, k=rng.randint(5, 200)) + passage) for _ in range(150)]
    for size in (8, 15, 40, 400):
        base = rng.choices(vocabulary, k=size)
        texts += near_copies(rng, base, 12, 3) + [" ".join(base[: rng.randint(1, size)]) for _ in range(6)]
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)] + [(None, texts[30]), (3, "one"), (None, "alone in this world of words")]
    frame = spark.createDataFrame([(k, t, "clash") for k, t in rows], "doc_id long, text string, fp string")
    got = sorted((tuple(r) for r in ngram_join.jaccard_components(frame).collect()), key=repr)
    assert got == plain_components(rows)
    assert ngram_join.jaccard_components(frame.limit(0)).count() == 0


def test_ngram_large_groups_and_blocks(spark, monkeypatch):
    """Chained codes, thinned slabs and block pairs give the same components."""
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(80)]
    texts = near_copies(rng, rng.choices(vocabulary, k=60), 160, 12) + near_copies(rng, rng.choices(vocabulary, k=50), 40, 3)
    rows = list(enumerate(texts))
    for name, value in (("PAIRED", 4), ("BLOCK_CODES", 900), ("ORDERED_CODES", 1500), ("SLAB_CODES", 2000), ("BROADCAST_BYTES", 0)):
        monkeypatch.setattr(ngram_join, name, value)
    got = sorted((tuple(r) for r in ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == plain_components(rows)


def test_ngram_thinned_sets_keep_their_links(spark, monkeypatch):
    """Unlike sets of one size share all their prefix codes; one entry stands for
    them all, and the near copy of a hidden one is in another slab."""
    for name, value in (("PAIRED", 4), ("HOT_LOCAL", 1 << 30), ("ORDERED_CODES", 30 * 200), ("BUCKET_ENTRIES", 1)):
        monkeypatch.setattr(ngram_join, name, value)  # without a frequency table, codes order the sets
    words = [f"v{i}" for i in range(31 * 189 + 11)]
    words.sort(key=dict(zip(words, shingle_sets(words, 1))).get)
    first, rest = words[:11], words[11:]
    texts = [" ".join(first + rest[i * 189 : (i + 1) * 189]) for i in range(30)]
    hidden = texts[17].split()
    rows = [*enumerate(texts), (30, " ".join(hidden[:-2] + rest[-2:]))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.jaccard_components(frame, width=1, percent=95).collect()}
    assert got == {**{i: i for i in range(30)}, 30: 17}


def test_ngram_pairs_are_sure_by_any_shared_code():
    """A thinned entry counts beside a plain one of the same two sets, and beside its own repeat."""
    alone = [(10 + k, 100 + k % 2, 50, 0) for k in range(12)]
    entries = [(1, 100, 50, 0), (1, 101, 50, 0), (2, 100, 50, 3), (2, 100, 50, -1), (2, 101, 50, 3), *alone]
    packed = pa.table({"entries": pa.array([np.array(entries, np.int64).tobytes()], pa.binary()), "edges": pa.array([b""], pa.binary())})
    assert ngram_join._bucket_edges(packed, 80).to_pylist() == [{"a": 101, "b": 100, "sure": True}]


def test_ngram_thinned_entries_stand_for_any_size():
    """One entry of a common code links to sets of all sizes, and chains of a slab are a forest."""
    entries = [(1, 100, 20, -1), (1, 101, 50, 0), (1, 102, 300, 7), (1, 103, 301, 290), (2, 104, 10, 0), (2, 105, 90, 0)]
    packed = pa.table({"entries": pa.array([np.array(entries, np.int64).tobytes()], pa.binary()), "edges": pa.array([b""], pa.binary())})
    assert ngram_join._bucket_edges(packed, 80).to_pylist() == [{"a": x, "b": 100, "sure": True} for x in (101, 102, 103)]
    sets = ngram_join.PAIRED + 9
    code = np.concatenate((np.full(sets, 7), np.full(sets, 8), [9, 9])).astype(np.uint64)
    fp = np.concatenate((np.arange(sets), np.arange(sets), [500, 501])) + 1000
    code, fp, size, pos, edges = ngram_join._thinned(code, fp, fp % 40 + 5, np.zeros(len(fp), np.int64))
    assert code.tolist() == [7, 8, 9, 9] and (pos < 0).tolist() == [True, True, False, False]
    assert sorted(edges[:, 0].tolist()) == list(range(1001, 1000 + sets)) and set(edges[:, 1].tolist()) == {1000}
    dealt = ngram_join._dealt(edges[:, 0].view(np.uint64), edges, 5)
    assert sorted(dealt) == [0, 1, 2, 3, 4]
    assert all((ngram_join._unpack(pa.array([x], pa.binary()), 2)[:, 0] % 5 == k).all() for k, x in dealt.items())


def test_histogram_bound_never_excludes_a_link():
    rng = np.random.default_rng(8)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate((a[: int(len(a) * rng.uniform(0.7, 1))], rng.integers(0, 1 << 63, int(rng.integers(0, n // 4 + 1)), dtype=np.uint64))))
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= 80 * (len(a) + len(b) - both):
            assert ngram_join.may_link(ngram_join.histogram(a), ngram_join.histogram(b), len(a), len(b), 80)


# --- 4 language --------------------------------------------------------------------


def test_language_spans(spark):
    rng = random.Random(9)
    words = {"xx": ["thing", "wash", "the", "with"], "yy": ["éaux", "çelle", "les", "queau"], "ru": ["привет", "мир"]}
    say = lambda k, n: " ".join(rng.choices(words[k], k=n))
    train = [(i, say(k, 30), k, "s") for i, k in enumerate(["xx", "yy", "ru"] * 10)] + [(90, None, "xx", "s"), (91, "text", None, "s")]
    model = language.learn(docs_frame(spark, train))
    assert model.languages == ["ru", "xx", "yy"]
    mixed = say("xx", 30) + " " + say("yy", 12)
    rows = [(1, mixed, None, "s"), (2, None, "xx", "s"), (3, "", "xx", "s"), (4, "12 !? ☃", "xx", "s"), (5, say("ru", 3), None, "s"), (6, say("yy", 20_000), None, "s"), (7, "the 漢字", None, None)]
    frame = docs_frame(spark, rows).withColumnRenamed("n_chars", "score")
    got = {r["doc_id"]: r for r in language.identify(frame, model).collect()}
    assert [(s["lang"], s["first"], s["words"]) for s in got[1]["spans"]] == [("xx", 0, 30), ("yy", 30, 12)]
    assert got[1]["lang_pred"] == "xx" and 0.5 < got[1]["score"] < 1
    assert [(got[i]["lang_pred"], got[i]["score"], got[i]["spans"]) for i in (2, 3, 4)] == [("und", 0.0, [])] * 3
    assert (got[5]["lang_pred"], got[6]["lang_pred"], got[7]["lang_pred"]) == ("ru", "yy", "xx")
    empty = language.learn(docs_frame(spark, []))
    assert {r["lang_pred"] for r in language.identify(frame, empty).collect()} == {"und"}
    assert language.identify(frame.limit(0), model).count() == 0


def test_every_label_is_learnt(spark, monkeypatch):
    """More labels than full tables hold, the rare ones included; too large a model raises an error."""
    own = {f"l{i:03}": chr(0x4E00 + 3 * i) * 3 for i in range(260)}
    train = [(i, " ".join([w] * (60 if k < "l250" else 40)), k, "s") for i, (k, w) in enumerate(sorted(own.items()) * 2)]
    train = train[: 260 + 250]  # the last ten labels occur once
    frame = docs_frame(spark, train)
    small = language.Settings(cells=1 << 14)
    full = language.learn(frame, small)
    assert full.languages == sorted(own)
    rows = [(i, " ".join([w] * 20), None, "s") for i, w in enumerate(own.values())]
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(docs_frame(spark, rows), full, small).collect()}
    assert got == dict(enumerate(own))
    monkeypatch.setattr(language, "DENSE_KEYS", 0)
    monkeypatch.setattr(language, "SPARSE_KEYS", 16)
    monkeypatch.setattr(language, "LANGUAGES_AT_ONCE", 7)
    sparse = language.learn(frame, small)
    assert sparse.languages == full.languages
    assert (sparse.scores == full.scores).all() and (sparse.scripts == full.scripts).all()
    with pytest.raises(ValueError, match="more than 259 languages"):
        language.learn(frame, language.Settings(cells=1 << 14, model_bytes=259 << 16))


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(10)
    counts = np.array([0, 1, 7, 3, 0, 6])
    scores, penalty = rng.normal(size=(17, 3)), 1.1
    got = language.viterbi(scores, counts, penalty)
    worth = lambda path, s: sum(s[i, l] for i, l in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))
    start = 0
    for n in counts:
        own = scores[start : start + n]
        every = np.array(np.meshgrid(*[range(3)] * n)).reshape(n, -1).T if n else [()]
        assert worth(got[start : start + n], own) == pytest.approx(max(worth(p, own) for p in every))
        start += n


def test_language_held_out_accuracy(spark):
    from gaugeflow.llm.queries import op4_language_spans

    path = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in op4_language_spans(spark, path).collect()}
    docs = spark.read.parquet(f"{path}/documents.parquet").collect()
    assert all(got[d["doc_id"]]["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2) for d in docs)
    held = [d["lang"] == got[d["doc_id"]]["lang_pred"] for d in docs if got[d["doc_id"]]["held_out"]]
    assert np.mean(held) > 0.98


# --- 5 neighbours --------------------------------------------------------------------


def test_hilbert_keys_are_a_curve():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims)).reshape(dims, -1).T
        keys = hilbert.hilbert_keys(grid, bits)
        assert sorted(keys) == list(range(len(grid)))
        walk = grid[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()  # neighbours on the curve touch


def test_neighbours(spark):
    rng = np.random.default_rng(11)
    rows = {i: rng.normal(size=12).tolist() for i in range(900)}
    for i in range(300, 500):
        rows[i] = rows[7]  # one very common vector
    bad = [(1000, None), (1100, [0.0] * 12), (1200, [float("nan")] * 12), (1300, [None, 1.0]), (None, rows[1])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in [*rows.items(), *bad, (100, rows[100])]], "vec_id long, embedding array<double>, label string")
    got = {}
    for r in hilbert.neighbours(frame, lambda i: i % 100 == 0, 10).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    x, hits = np.array([rows[i] for i in range(900)]), []
    assert set(got) == set(range(0, 900, 100))
    for q, found in got.items():
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        d[q] = np.inf
        want = np.lexsort((np.arange(900), d))[:10].tolist()
        assert [r for r, _, _ in sorted(found)] == list(range(1, 11))
        assert all(s == pytest.approx(d[v], abs=1e-12) for _, v, s in found)
        hits.append(len({v for _, v, _ in found} & set(want)) / 10)
        if 300 <= q < 500:
            assert [v for _, v, _ in sorted(found)] == want
    assert np.mean(hits) >= 0.9
    few = {r["vec_id"] for r in hilbert.neighbours(frame.filter("vec_id in (0, 1, 2)"), lambda i: i % 100 == 0, 10).collect()}
    assert few == {1, 2}
    assert hilbert.neighbours(frame.limit(0), lambda i: i % 100 == 0, 10).count() == 0


# --- 6 sharding ------------------------------------------------------------------------


def test_bin_packing(spark):
    rng = random.Random(12)
    texts = [" ".join(["w"] * rng.randint(0, 60)) + str(i) for i in range(600)] + ["hot text " * 8] * 500 + [None, "", "é", "long " * 20_000]
    rows = [(i if i % 50 else None, t, "en", "s") for i, t in enumerate(texts)] + [(1, texts[1], "en", "s")]
    got = binpack.pack(docs_frame(spark, rows).withColumnRenamed("lang", "group"), 8).collect()
    assert len(got) == len(rows)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _, _ in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    for s in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert binpack.pack(docs_frame(spark, []), 8).count() == 0


def test_bin_packing_balances_all_three(spark):
    rng = random.Random(13)
    rows = [(i, " ".join("w" * rng.randint(1, 9) for _ in range(rng.randint(1, 80))) + f" {i}", "en", "s") for i in range(4000)] + [(9000 + i, "same words here", "en", "s") for i in range(2000)]
    got = binpack.pack(docs_frame(spark, rows), 16).collect()
    for value in (lambda r: r["size"], lambda r: r["tokens"], lambda r: 1):
        sums = [sum(value(r) for r in got if r["shard"] == s) for s in range(16)]
        assert max(sums) / (sum(sums) / 16) < 1.02
    again = binpack.pack(docs_frame(spark, rows), 16).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


# --- 7 WARC ------------------------------------------------------------------------------


def test_warc_round_trip(spark):
    rows = [(5, "http://a/", "same"), (3, "http://b/\r\nX: y", "same"), (9, None, "same"), (4, "u", None), (2, "u", ""), (7, "u", "é" * 50_000), (5, "http://a/", "same"), (3, "http://b/\r\nX: y", "same"), (None, "n", "lost")]
    frame = spark.createDataFrame([(*r, "d") for r in rows], "page_id long, url string, html string, digest string")
    headers, payloads = warc_store.write_archive(frame)
    assert payloads.count() == 4
    read = warc_store.read_records(headers, payloads)
    records = [(r["page_id"], bytes(r["record"])) for r in read.collect()]
    got = [r.asDict() for r in warc_store.parsed(read, headers).collect()]
    assert sorted(r["record_bytes"] for r in got) == sorted(len(b) for _, b in records)
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    first = {}
    for i, _, t in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    want = Counter((i, len((t or "").encode()), sha(t), "response" if first.get(t or "", i) == i else "revisit", None if first.get(t or "", i) == i else first[t or ""]) for i, _, t in rows)
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == want
    for page, record in records:
        head, _, block = record.partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        body = block[: int(fields["Content-Length"])]
        assert block[len(body) :] == b"\r\n\r\n" and head.startswith(b"WARC/1.1")
        payload = body.partition(b"\r\n\r\n")[2]
        if fields["WARC-Type"] == "response":
            assert fields["WARC-Payload-Digest"] == "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
        else:
            assert payload == b"" and "WARC-Refers-To" in fields
    none = warc_store.write_archive(frame.limit(0))
    assert warc_store.parsed(warc_store.read_records(*none), none[0]).count() == 0
    # A revisit whose response is gone.
    lost = headers.filter("revisit OR page_id IS NULL OR page_id <> 3")
    with pytest.raises(Exception, match="no such record"):
        warc_store.parsed(warc_store.read_records(lost, payloads), lost).collect()


def test_warc_html_crosses_the_network_twice(spark):
    """Without broadcasts: one exchange of payloads to write them, one to read them."""
    import contextlib
    import io

    frame = spark.createDataFrame([(i, "u", f"text {i % 7}") for i in range(40)], "page_id long, url string, html string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        records = frame.select("page_id", F.coalesce("html", F.lit("")).cast("binary").alias("payload")).withColumn("digest", F.unhex(F.sha2("payload", 256)))
        headers, payloads = warc_store.write_archive(frame)
        assert payloads.count() == 7 and records.count() == 40
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            warc_store.read_records(headers, payloads).explain("simple")
        assert out.getvalue().count("Exchange hashpartitioning(digest") == 2  # headers and payloads, once each
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_warc_refuses_changed_payloads(spark):
    headers, payloads = warc_store.write_archive(spark.createDataFrame([(1, "u", "text")], "page_id long, url string, html string"))
    changed = payloads.selectExpr("digest", "cast('tex!' as binary) as payload")
    with pytest.raises(Exception, match="does not match"):
        warc_store.read_records(headers, changed).collect()
    small, _ = warc_store.write_archive(spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string"), min_bytes=3)
    assert small.filter("NOT revisit").count() == 2


# --- 8 mixing ------------------------------------------------------------------------------


def test_targets_are_water_filled(spark):
    rng = random.Random(14)
    for _ in range(4):
        sizes = [(f"s{i}", rng.choice([0, 1, 10, 1000, 100000])) for i in range(rng.randint(1, 9))] + [(None, 50)]
        got = {r["source"]: r["target"] for r in curriculum.targets(spark.createDataFrame(sizes, "source string, source_size long")).collect()}
        names = sorted((s for s, _ in sizes if s is not None)) + [None]
        weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
        size, left, want, open_ = dict(sizes), float(sum(n for _, n in sizes)), {}, set(names)
        while open_:
            total = sum(weight[s] for s in open_)
            over = {s for s in open_ if left * weight[s] / total > 3 * size[s]}
            if not over:
                want |= {s: left * weight[s] / total for s in open_}
                break
            want |= {s: 3.0 * size[s] for s in over}
            left -= sum(want[s] for s in over)
            open_ -= over
        assert got == pytest.approx(want)


def test_sums_before_a_row_over_ranges(spark):
    rng = random.Random(16)
    names = [None, *{rng.randbytes(3).hex() for _ in range(400)}]
    rows = spark.createDataFrame([(n, rng.randint(0, 9)) for n in names], "name string, n long")
    got = curriculum.before(rows, [F.col("name").asc_nulls_last()], {"first": F.lit(1), "sum": F.col("n")}).collect()
    size, want, total = {r["name"]: r["n"] for r in got}, {}, 0
    for i, name in enumerate(sorted(n for n in names if n) + [None]):
        want[name] = (i, total)
        total += size[name]
    assert {r["name"]: (r["first"], r["sum"]) for r in got} == want


def test_mix_is_the_same_in_buckets_of_any_size(spark, monkeypatch):
    frame = docs_frame(spark, [(i, "w " * (i * 7 % 23), "en", "ab"[i % 3 == 0]) for i in range(300)])
    plans = [sorted(map(tuple, curriculum.plan(frame).collect()))]
    monkeypatch.setattr(curriculum, "BUCKET_ROWS", 1)
    plans.append(sorted(map(tuple, curriculum.plan(frame).collect())))
    assert plans[0] == plans[1]
    starts = sorted((r[1], r[8], r[2]) for r in plans[0] if r[2])
    assert all(b[1] == a[1] + a[2] for a, b in zip(starts, starts[1:]) if a[0] == b[0])


def test_mix(spark):
    rng = random.Random(15)
    rows = [(i if i % 97 else None, " ".join(["w"] * rng.randint(0, 30)), "en", rng.choice(["a", "b", "b", "b", "c", None])) for i in range(900)]
    rows += [(5000, None, "en", "a"), (5001, "", "en", None), (5002, "w " * 300, "en", "c"), (7, "repeat me", "en", "a"), (7, "repeat me", "en", "a")]
    frame = docs_frame(spark, rows).withColumnRenamed("n_chars", "size")
    planned = curriculum.plan(frame.select("doc_id", "text", "lang", "source")).collect()
    assert len(planned) == len(rows)
    for source in {r["source"] for r in planned}:
        own = [r for r in planned if r["source"] == source]
        longest = max(r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= longest / 2 + 1e-6
        assert all(r["taken"] <= 3 * r["size"] for r in own)
    mixed = curriculum.mix(curriculum.plan(frame)).collect()
    at = [r["position"] for r in mixed]
    assert at == sorted(at) and 0 <= at[0] and at[-1] <= 1
    assert Counter(r["doc_id"] for r in mixed) == Counter({k: n for k, n in Counter({r["doc_id"]: 0 for r in planned} | dict(sum((Counter({r["doc_id"]: r["copies"]}) for r in planned), Counter()))).items() if n})
    assert curriculum.plan(docs_frame(spark, [])).count() == 0
    # Early sources come before late ones on average.
    turn = {t: np.mean([r["position"] for r in mixed if r["turn"] == t]) for t in {r["turn"] for r in mixed}}
    assert turn[0] < turn[1] < turn[2]


# --- 9 sentencepiece --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def table():
    return pieces.Pieces(*pieces.load(PIECE_MODEL))


def test_encoding_is_the_librarys(table):
    import pyarrow.parquet as pq
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    rng = random.Random(16)
    alphabet = "abcdeft hin ▁ \n\té漢字<>#==--''.,  0123 İ😀\x00"
    texts = ["", " ", "  ", "   a", "a   ", "a" * 500, " " * 90, "☃", "\n\n", "x                 y", "word " * 3000]
    texts += ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(1500)]
    texts += pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    ids, counts = pieces.encode_batch(texts, table)
    parts = np.split(ids, np.cumsum(counts)[:-1])
    for text, own, want in zip(texts, parts, library.encode(texts)):
        assert own.tolist() == want, repr(text[:60])
    assert pieces.decode_batch(ids, counts, table) == [t.replace("▁", " ") for t in texts]


def test_unigram_scores_are_maximal(table):
    """The same Viterbi with open seams: best sum of scores, by brute force."""
    loose = pieces.Pieces(*[*pieces.load(PIECE_MODEL)[:5], False, 0])
    by = {"".join(map(chr, loose.chars[i, : loose.size[i]])): loose.score[i] for i in np.flatnonzero(loose.size)}
    for word in ("▁there", "▁thing", "▁walking", "▁queau"):
        ids, _ = pieces.solve(np.array([[ord(c) for c in word]], np.uint32), loose)

        def best(s):
            return max([by[s[:k]] + best(s[k:]) for k in range(1, len(s) + 1) if s[:k] in by], default=-np.inf) if s else 0

        assert loose.score[ids].sum() == pytest.approx(best(word))


def test_encode_and_decode_frames(spark):
    rows = [(1, "Hello  world", "x", 1), (2, None, "x", 2), (3, "", "x", 3), (None, "a ▁ b", "x", 4), (1, "Hello  world", "x", 1)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string, n int")
    encoded = pieces.encode(frame, PIECE_MODEL)
    got = encoded.collect()
    assert [r["round_trip"] for r in got] == [True, True, True, False, True] and got[1]["ids"] is None and got[2]["ids"] == []
    assert [r["text"] for r in pieces.decode(encoded, PIECE_MODEL).collect()] == ["Hello  world", None, "", "a   b", "Hello  world"]
    assert pieces.encode(frame.limit(0), PIECE_MODEL).count() == 0


# --- 10 tool calls ----------------------------------------------------------------------------


def test_tool_calls(spark):
    good = '{"limit": 3, "query": "é \\u00e9"}'
    calls = [(1, "a", 1, "search", good), (1, "b", 3, "search", '{"query": "x", "limit": "3"}'), (1, "c", 5, "nothing", "{}"), (2, "d", 1, "count", None), (2, "e", 3, "count", ""),
             (2, "f", 5, "count", '{"text": "t", "more": 1}'), (3, "g", 1, "lookup", '{"strict": 1, "key": "k"}'), (3, "h", 3, "lookup", '{"key":"k","strict":true}'), (1, "a", 9, "count", "{}"), (4, None, 1, "count", "{}"),
             (5, "x", 1, "count", '{"text":"q"}'), (5, "y", 2, "count", '{"text":"q"}'), (5, "z", 3, "count", '{"text":"q"}'), (5, "w", 4, "count", "[1"), (6, "p", 1, "count", '{"text":NaN}'), (7, "m", 1, "count", '{"text":"' + "long " * 50_000 + '"}')]
    needs = [("b", "a"), ("c", "missing"), ("d", "f"), ("f", "e"), ("x", "y"), ("y", "x"), ("w", "x"), ("z", "q"), ("h", "a"), ("a", None)]
    results = [("a", 8, "later"), ("a", 2, "first"), ("h", 4, None), ("zz", 1, "orphan"), ("x", 2, "r"), (None, 1, "r"), ("m", 2, "r")]
    frames = spark.createDataFrame(calls, "conv_id long, call_id string, turn long, name string, arguments string"), spark.createDataFrame(needs, "call_id string, needs string"), spark.createDataFrame(results, "call_id string, turn long, content string")
    rows = toolcalls.link(*frames, TOOLS).collect()
    got = {r["call_id"]: r for r in rows}
    assert len(rows) == len(got) == 14
    assert {k: r["status"] for k, r in got.items()} == {"a": "ok", "b": "bad_arguments", "c": "unknown_tool", "d": "bad_arguments", "e": "bad_arguments", "f": "bad_arguments", "g": "bad_arguments",
        "h": "ok", "x": "cycle", "y": "cycle", "z": "no_result", "w": "cycle", "p": "bad_arguments", "m": "ok"}
    assert got["a"]["message"] == '{"arguments":{"limit":3,"query":"é é"},"id":"a","name":"search","result":"first","status":"ok"}'
    assert json.loads(got["h"]["message"])["result"] is None
    assert (got["e"]["level"], got["f"]["level"], got["d"]["level"], got["b"]["level"], got["w"]["level"]) == (0, 1, 2, 0, None)
    order = [r["call_id"] for r in rows]
    assert order.index("e") < order.index("f") < order.index("d")
    assert [r["call_id"] for r in toolcalls.orphans(frames[0], frames[2]).filter("call_id is not null").collect()] == ["zz"]
    assert toolcalls.link(frames[0].limit(0), frames[1].limit(0), frames[2].limit(0), TOOLS).count() == 0


def test_levels_of_random_graphs(spark):
    rng = random.Random(17)
    edges = [(f"n{rng.randint(0, 40)}", f"n{rng.randint(0, 40)}") for _ in range(45)]
    below = {}
    for a, b in edges:
        below.setdefault(a, set()).add(b)

    def level(n, path=()):
        if n in path:
            return None
        kids = [level(k, (*path, n)) for k in below.get(n, ())]
        return None if None in kids else 1 + max(kids, default=-1)

    frame = spark.createDataFrame(edges, "call_id string, needs string")
    want = {n: level(n) for n in below if level(n) is not None}
    assert {r["call_id"]: r["level"] for r in toolcalls.levels(frame).collect()} == want
    single = {a: sorted(b)[0] for a, b in below.items()}
    below = {a: {b} for a, b in single.items()}
    want = {n: level(n) for n in below if level(n) is not None}
    got = toolcalls.depths(spark.createDataFrame(sorted(single.items()), "call_id string, needs string"))
    assert {r["call_id"]: r["level"] for r in got.collect()} == want


def test_arguments_that_json_takes_but_text_does_not(spark):
    """Half surrogate pairs, numbers beyond doubles and deep nesting have defined results."""
    schemas = {"t": {"type": "object", "required": ["text"], "properties": {"text": {"type": "string"}}},
               "a": {"type": "array"}, "n": {"type": "number"}}
    deep = lambda n: "[" * n + "]" * n
    given = [("t", '{"text":"\\ud800"}', "ok"), ("t", '{"text":"\\ud83d\\ude00"}', "ok"), ("t", '{"te\\udc00xt":"x"}', "bad_arguments"),
             ("n", "1e999", "bad_arguments"), ("n", "-1e999", "bad_arguments"), ("n", "1e308", "ok"), ("a", "[1e999]", "bad_arguments"),
             ("a", deep(300), "ok"), ("a", deep(302), "bad_arguments"), ("a", deep(600), "bad_arguments"), ("a", deep(2000), "bad_arguments"),
             ("a", deep(20000), "bad_arguments"), ("n", "9" * 5000, "bad_arguments"), ("a", "[" + "1," * 20000 + "1]", "ok")]
    calls = spark.createDataFrame([(1, f"c{i}", i, n, a) for i, (n, a, _) in enumerate(given)], "conv_id long, call_id string, turn int, name string, arguments string")
    results = calls.selectExpr("call_id", "turn", "'r' as content")
    # Columns with the names of the result.
    calls, results = (d.selectExpr("*", "1 as status", "2 as message", "3 as level", "4 as open") for d in (calls, results))
    rows = {r["call_id"]: r for r in toolcalls.link(calls, spark.createDataFrame([], "call_id string, needs string"), results, schemas).collect()}
    assert [rows[f"c{i}"]["status"] for i in range(len(given))] == [s for _, _, s in given]
    assert '"text":"\\ud800"' in rows["c0"]["message"] and '"text":"😀"' in rows["c1"]["message"]
    for i, (_, arguments, status) in enumerate(given):
        read = json.loads(rows[f"c{i}"]["message"], parse_constant=lambda c: 1 / 0)["arguments"]
        assert read == (json.loads(arguments) if status == "ok" else None)
