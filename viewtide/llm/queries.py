"""One query per training-data operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from viewtide.llm import (
    decontamination,
    html_text,
    lexical,
    packing,
    pii,
    ppm,
    prefix_join,
    quality,
    sharding,
    simhash,
    token_files,
    toxicity,
    whitening,
)
from viewtide.storage import scratch_path

# Stands for the secret of a deployment; whoever holds it can undo the pseudonyms.
PSEUDONYM_KEY = "key of the example queries"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality.quality_verdicts(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return verdicts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                           "n_repeat_words", "base_failed", "kept")


def op2_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", (toxicity.fold(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = pii.pseudonymize(_table(spark, sf_dir, "documents").select("doc_id", "text"),
                                PSEUDONYM_KEY, found="found")
    return replaced.select("doc_id", "text", F.size("found").alias("n_found"),
                           F.col("found.kind").alias("kinds"))


def op5_minimum_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(_table(spark, sf_dir, "documents"), TOKENIZER, end_id=1)
    sums = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens")
    return packing.pack(sums).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
        "sequence_size", "padded_size")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token_files")
    token_files.write_token_files(
        _table(spark, sf_dir, "documents"), folder, TOKENIZER, end_id=2)
    return token_files.read_token_files(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hexadecimal(F.col("fingerprint")).alias("fingerprint"),
                         "component_id")


def op8_partial_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.benchmark_matches(
        _table(spark, sf_dir, "documents").select("doc_id", "text"),
        _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", (F.size("matches") > 0).alias("contaminated"),
        F.array_sort(F.array_distinct("matches.item_id")).alias("item_ids"),
        F.array_max("matches.similarity").alias("similarity"), "matches")


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return (html_text.extract_pages(pages)
            .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars")))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(_table(spark, sf_dir, "documents"),
                                  _table(spark, sf_dir, "benchmark"))


def op13_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_join.link_documents(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_label_propagation": op2_label_propagation,
    "op3_toxicity": op3_toxicity,
    "op4_pseudonyms": op4_pseudonyms,
    "op5_minimum_slack": op5_minimum_slack,
    "op6_token_files": op6_token_files,
    "op7_simhash": op7_simhash,
    "op8_partial_matching": op8_partial_matching,
    "op9_decontamination": op9_decontamination,
    "op10_main_text": op10_main_text,
    "op11_whitening": op11_whitening,
    "op12_lexical_search": op12_lexical_search,
    "op13_prefix_join": op13_prefix_join,
}
SQL: dict[str, str] = {"op12_lexical_search": lexical.SQL, "op13_prefix_join": prefix_join.SQL}
