"""The registered queries against DuckDB and brute force, and the pipeline."""

import math
import zlib

import duckdb
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from gaugeflow.llm import pipeline_stages
from gaugeflow.llm.base import materialize
from gaugeflow.llm.oracle import ORACLE_SQL
from gaugeflow.llm.queries import PIECE_MODEL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    return ("NaN" if math.isnan(v) else float(f"{v:.9g}")) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cursor = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in cursor.description]
    want = sorted((tuple(_norm(v) for _, v in sorted(zip(columns, r))) for r in cursor.fetchall()), key=repr)
    frame = entry.queries()[name](spark, SF)
    got = sorted((tuple(_norm(v) for _, v in sorted(zip(frame.columns, r))) for r in frame.collect()), key=repr)
    assert sorted(frame.columns) == sorted(columns) and got == want


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert {*QUERIES, "pipeline"} <= set(entry.queries())


def test_packing_query(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    rows = QUERIES["op6_vector_bin_packing"](spark, SF).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in rows} == {i: (len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in docs.items()}
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)} and {r["shard"] for r in rows} <= set(range(16))


def test_join_query(spark):
    from test_operators import plain_components

    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    got = sorted((tuple(r) for r in QUERIES["op3_ngram_jaccard"](spark, SF).collect()), key=repr)
    assert got == plain_components(rows)


def test_encoding_query(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    docs = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    for r in QUERIES["op9_sentencepiece"](spark, SF).collect():
        assert r["round_trip"] and r["ids"] == library.encode(docs[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])


def test_pipeline(spark):
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        kept.append(docs)
    texts = [[r["text"] for r in d.collect()] for d in kept[:3]]
    assert all(d.columns == ["doc_id", "text", "lang", "source", "n_chars"] for d in kept[:3])
    assert len(texts[1]) == len(set(texts[1])) < len(texts[0]) and set(texts[2]) <= set(texts[1])
    got = sorted((r["doc_id"], tuple(r["ids"])) for r in kept[3].collect())
    assert got == sorted((r["doc_id"], tuple(r["ids"])) for r in corpus_pipeline.run(spark, SF).collect())


def test_stages_on_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    body = "some words that stand in every one of these rows and repeat"
    rows = [(1, body, "en", "a", 1), (1, body, "en", "a", 1), (2, body, "en", None, 1), (None, body + " again", "en", "a", 1), (4, None, "en", "a", None),
            (5, "", None, "a", 0), (6, "123 456", "en", "b", 7), (None, "ganz andere worte sind hier zu lesen", "de", "b", 3)]
    docs = spark.createDataFrame(rows, schema)
    clean = pipeline_stages.language_id(spark, docs, SF)
    assert sorted(r["text"] for r in clean.collect()) == sorted(t for _, t, *_ in rows if t and t[0].isalpha())
    joined = pipeline_stages.ngram_jaccard_join(spark, docs, SF).collect()
    assert len(joined) == 5 and sorted(r["doc_id"] for r in joined if r["text"] and r["text"].startswith(body)) != []
    for stage in (s for _, s in corpus_pipeline.STAGES):
        assert stage(spark, docs.limit(0), SF).count() == 0
        stage(spark, docs, SF).collect()


def test_stages_keep_columns_of_any_name(spark):
    from pyspark.sql import functions as F

    names = ("body score spans lang_pred key bucket hash size start epochs target turn weight copies taken copy position source_size "
             "id n fp cells cluster root tasks rep held_out _key _text _m ids round_trip n_tokens").split()  # fmt: skip
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    wide = docs.select("*", *[F.concat(F.lit(f"{n}-"), F.col("doc_id").cast("string")).alias(n) for n in names])
    for _, stage in corpus_pipeline.STAGES[:3]:
        plain, own = stage(spark, docs, SF), stage(spark, wide, SF)
        assert own.columns == wide.columns
        rows = own.collect()
        assert all(r[n] == f"{n}-{r['doc_id']}" for r in rows for n in names)
        assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in plain.collect())
    corpus_pipeline.STAGES[3][1](spark, wide, SF).collect()


def test_stages_take_columns_of_odd_names(spark):
    """Dots, quotes, colons, and capitals like those of a column that a stage reads."""
    odd = ["a.b", "a`b", "a:b", "Text", "DOC_ID", "x y", "_row", "_rest", "c0", "Ünï"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    wide = docs.select("*", *[docs["doc_id"].cast("string").alias(f"n{i}") for i in range(len(odd))]).toDF(*docs.columns, *odd)
    for _, stage in corpus_pipeline.STAGES[:3]:
        own = stage(spark, wide, SF)
        assert own.columns == wide.columns
        rows = [tuple(r) for r in own.collect()]
        assert rows and all(r[len(docs.columns) + i] == str(r[0]) for r in rows for i in range(len(odd)))
        assert sorted(r[0] for r in rows) == sorted(r["doc_id"] for r in stage(spark, docs, SF).collect())
    assert len(corpus_pipeline.STAGES[3][1](spark, wide, SF).collect()) == 40


def test_ids_that_repeat_with_other_texts(spark):
    """A near copy goes, whichever of its id's texts it is."""
    words = [f"w{i}" for i in range(60)]
    near, other = " ".join(words), " ".join(f"v{i}" for i in range(60))
    rows = [(1, other), (1, near), (0, near + " more"), (None, near + " yet"), (1, near), (2, None), (2, ""), (None, None), (None, "alone by itself")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r["doc_id"], r["text"]) for r in pipeline_stages.ngram_jaccard_join(spark, docs, SF).collect()), key=repr)
    assert got == sorted([(0, near + " more"), (1, other), (2, None), (2, ""), (None, None), (None, "alone by itself")], key=repr)
