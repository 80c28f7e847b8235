"""Registered queries of the operators of this subpackage.

Each takes (spark, sf_dir) and applies its operator, with production
parameters, to the whole table it is meant for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm import (
    binpack,
    codebooks,
    curriculum,
    hilbert,
    language,
    maxscore,
    ngram_join,
    pieces,
    subwords,
    toolcalls,
    url_reputation,
    warc_store,
    whitening,
)
from gaugeflow.llm.base import table

# FIXED VALUES of the url query.
URL_RULES = (
    url_reputation.Rule("allow", "org", "/"),
    url_reputation.Rule("block", "example.org", "/es/"),
    url_reputation.Rule("block", "example.org", "/en/1"),
    url_reputation.Rule("allow", "com", "/fr/"),
    url_reputation.Rule("block", "com", "/de/"),
)
SHARDS = 16
# FIXED VALUES of the tool-call query: the table has no calls, so every assistant
# turn makes one by this rule, and the user turn behind it is its result.
TOOLS = {
    "search": {
        "type": "object",
        "required": ["query", "limit"],
        "properties": {"query": {"type": "string"}, "limit": {"type": "integer"}},
    },
    "count": {"type": "object", "required": ["text"], "properties": {"text": {"type": "string"}}},
    "lookup": {
        "type": "object",
        "required": ["key"],
        "properties": {"key": {"type": "string"}, "strict": {"type": "boolean"}},
    },
}
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled outcome of a page: the label of its id; good means quality 1
    and not toxic."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"),
        ((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).cast("int").alias("good"),
    )
    judged = url_reputation.judge_urls(table(spark, sf_dir, "pages"), labels, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", F.round("low", 6).alias("low"))


def op2_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0, 20)


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op4_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from every document that is not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", language.is_held_out(F.col("doc_id")))
    model = language.learn(docs.filter(~F.col("held_out")))
    found = language.identify(docs.select("doc_id", "held_out", "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))


def op5_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.neighbours(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0, 10)


def op6_vector_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = binpack.pack(table(spark, sf_dir, "documents"), SHARDS)
    return packed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "tokens",
    )


def op7_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers, payloads = warc_store.write_archive(table(spark, sf_dir, "pages"))
    records = warc_store.parsed(warc_store.read_records(headers, payloads), headers)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_bytes")


def op8_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = curriculum.plan(table(spark, sf_dir, "documents"))
    first = F.round(curriculum.copy_position(F.lit(0)), 6)
    return planned.select("doc_id", "size", "source_size", "target", "taken", first.alias("first_position")).orderBy(
        "first_position", "doc_id"
    )


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they decode to the text."""
    encoded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), PIECE_MODEL)
    return encoded.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "ids", "round_trip")


def derived_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(calls, needs, results). A call needs that of the assistant turn before,
    in every fifth conversation that of the turn behind; every eleventh call
    has a limit in quotes."""
    rows = conversations.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    name_of = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    word = F.coalesce(F.regexp_extract("text", "[A-Za-z]+", 0), F.lit(""))
    size = F.coalesce(F.length("text"), F.lit(0))
    kind, odd = (F.col("conv_id") + F.col("turn")) % 3, (F.col("conv_id") + F.col("turn")) % 11 == 0
    quote = F.when(odd, '"').otherwise("")
    search = F.concat(F.lit('{ "query": "'), word, F.lit('", "limit": '), quote, (size % 50).cast("string"), quote, F.lit(" }"))
    count = F.concat(F.lit('{"text":"'), word, F.lit('"}'))
    lookup = F.concat(F.lit('{"strict": true, "key": "'), word, F.lit('"}'))
    calls = rows.filter("role = 'assistant'")
    made = calls.select(
        "conv_id", name_of(F.col("turn")).alias("call_id"), "turn",
        F.when(kind == 0, "search").when(kind == 1, "count").otherwise("lookup").alias("name"),
        F.when(kind == 0, search).when(kind == 1, count).otherwise(lookup).alias("arguments"),
    )
    other = F.when(F.col("conv_id") % 5 == 0, F.col("turn") + 2).otherwise(F.col("turn") - 2)
    needs = calls.select(name_of(F.col("turn")).alias("call_id"), name_of(other).alias("needs"))
    results = rows.filter("role = 'user'").select(name_of(F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    return made, needs, results


def op10_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toolcalls.link(*derived_calls(table(spark, sf_dir, "conversations")), TOOLS)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), components=32).withColumnRenamed("id", "vec_id")


QUALITY_THRESHOLD = 0.3


def op12_quality_subwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from a bounded sample of the labels that are not held out, scores every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", subwords.is_held_out(F.col("doc_id")))
    labels = table(spark, sf_dir, "labels").filter(~subwords.is_held_out(F.col("doc_id")))
    scored = subwords.classify(docs, subwords.learn(docs, labels), keep=["held_out"])
    return scored.withColumn("predicted", (F.col("score") >= QUALITY_THRESHOLD).cast("int"))


def op13_orchard_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = codebooks.compress(table(spark, sf_dir, "embeddings"))
    return coded.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


QUERIES = {
    "op1_url_reputation": op1_url_reputation,
    "op2_maxscore": op2_maxscore,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_language_spans": op4_language_spans,
    "op5_hilbert_neighbours": op5_hilbert_neighbours,
    "op6_vector_bin_packing": op6_vector_bin_packing,
    "op7_warc_archive": op7_warc_archive,
    "op8_curriculum_mix": op8_curriculum_mix,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_tool_calls": op10_tool_calls,
    "op11_whitening": op11_whitening,
    "op12_quality_subwords": op12_quality_subwords,
    "op13_orchard_codes": op13_orchard_codes,
}
