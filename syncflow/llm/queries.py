"""The registered query of each operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from syncflow.llm import (
    disclosure,
    fm_index,
    golay,
    gumbel_pieces,
    line_runs,
    pivot_index,
    ppm,
    prefix_trie,
    quotes,
    risk_rules,
    schedule,
    token_alignment,
    warc,
)
from syncflow.staging import Staging


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    held_out = F.coalesce(held_out, F.lit(False))
    model = ppm.train(docs.where(~held_out))
    return ppm.identify(docs.select("doc_id", "text"), model).select(
        "row.doc_id",
        F.coalesce(
            F.crc32(F.col("row.doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False)
        ).alias("held_out"),
        "lang_pred",
        "score",
    )


def op2_quote_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    linked = quotes.link_quotes(quotes.as_mailbox(turns), ["conv_id", "turn"])
    return linked.select(
        "id.conv_id",
        "id.turn",
        F.col("parent.conv_id").alias("parent_conv_id"),
        F.col("parent.turn").alias("parent_turn"),
        F.col("root.conv_id").alias("root_conv_id"),
        F.col("root.turn").alias("root_turn"),
        "depth",
        "n_quoted",
        "n_linked",
        F.sha2("own_text", 256).alias("own_sha256"),
    )


def op3_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return pivot_index.top_k(vectors, F.col("vec_id") % 50 == 0).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score"
    )


def op4_risk_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    return risk_rules.judge(docs, labels).documents.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


#: A public sentence piece vocabulary; only the driver reads it.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def op5_gumbel_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = gumbel_pieces.Vocabulary.load(VOCABULARY)
    sampled = gumbel_pieces.sample_segmentations(
        docs, vocabulary, F.col("doc_id").cast("string"), verify=True
    )
    return sampled.select(
        "row.doc_id",
        "rank",
        F.size("ids").cast("long").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_hash"),
        "log_prob",
        "perturbed",
        "inclusion",
        "round_trip",
    )


def op6_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return disclosure.sanitise(docs, min_term=1, keep_text=False).select(
        "doc_id",
        *[disclosure.kind_count(k).alias(f"n_{k}") for k in disclosure.KINDS],
        F.sha2(disclosure.span_list(False), 256).alias("base_sha256"),
        disclosure.span_list(True).alias("spans"),
    )


def op7_source_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return schedule.tokens_taken(schedule.mix_sources(docs)).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken"
    )


def op8_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return golay.near_duplicates(docs).select(
        "doc_id", golay.hex_print(F.col("print")).alias("fingerprint"), "component_id"
    )


def op9_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Staging(spark, "warc").folder("archives")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_runs.dedup_lines(docs).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


#: A public byte-level vocabulary; only the driver reads it.
BYTE_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    aligned = token_alignment.align(docs, BYTE_VOCABULARY, VOCABULARY)
    return aligned.documents.withColumnRenamed("id", "doc_id")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.ordered_turns(_table(spark, sf_dir, "conversations"))
    turns = Staging(spark, "turns").write(turns)
    convs = turns.select("conv_id").distinct()
    rebuilt = prefix_trie.share_openings(turns, convs, group=5, lengths=9)
    return prefix_trie.prefix_trie(rebuilt, convs)


def op13_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return fm_index.decontaminate(docs, _table(spark, sf_dir, "benchmark")).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


QUERIES = {
    "op1_ppm_language": op1_ppm_language,
    "op2_quote_links": op2_quote_links,
    "op3_pivot_search": op3_pivot_search,
    "op4_risk_rules": op4_risk_rules,
    "op5_gumbel_pieces": op5_gumbel_pieces,
    "op6_disclosure": op6_disclosure,
    "op7_source_schedule": op7_source_schedule,
    "op8_golay_simhash": op8_golay_simhash,
    "op9_warc_segments": op9_warc_segments,
    "op10_line_runs": op10_line_runs,
    "op11_token_alignment": op11_token_alignment,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_fm_index": op13_fm_index,
}
