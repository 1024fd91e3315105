"""The queries of the operators and the SQL that gives the same rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom.llm import (
    dialogues,
    jaccard,
    leaks,
    lines,
    linkgraph,
    mainhtml,
    personal,
    quality,
    repeats,
    sentencepieces,
    spellings,
    sql,
    suffixes,
    warc,
)
from labelloom.llm.common import table

PIECES = "piece_bpe_32k.model"
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql:
            ORACLES[run.__name__] = sql
        return run

    return register


@query(sql.QUALITY)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", *quality.BASE, "base_failed", "kept", F.array_join("failed", ",").alias("failed")
    )


@query(sql.LINES)
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lines.dedup_lines(table(spark, sf_dir, "documents"))
    text = F.col("row.text")
    return cut.select(
        "row.doc_id",
        "n_lines",
        "n_removed",
        F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256).alias("text_sha256"),
    )


@query(sql.repeats_sql(50))
def op3_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.suffix_array(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256", F.size("spans").cast("long").alias("n_spans")
    )


@query()
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sentencepieces.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))
    return sentencepieces.token_digests(encoded)


@query(sql.repeats_sql(35))
def op5_seed_and_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.seed_and_extend(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256", F.size("spans").cast("long").alias("n_spans")
    )


@query(sql.JACCARD)
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


@query()
def op7_consensus_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = mainhtml.main_text(table(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query(sql.WARC)
def op8_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_archives(index).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query()
def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_key")


@query(sql.url_filter_sql())
def op9_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linkgraph.judged(table(spark, sf_dir, "pages"), linkgraph.rule_table(spark, RULES))


@query(sql.SPELLINGS)
def op11_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spellings.spelling_groups(table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


@query(sql.TRIE)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogues.prefix_trie(table(spark, sf_dir, "conversations"))


@query()
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal.reported(personal.find_personal(table(spark, sf_dir, "documents")))
