"""The registered queries of the training-data operators: one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm.common import tokenizer_path
from candela.sources.tables import read_table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candela.llm.license import label_list, scan
    found = scan(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    base = F.filter("licences", lambda x: x["base"])
    starts = F.transform(base, lambda x: x["start"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        label_list(base).alias("base_labels"), label_list(F.col("licences")).alias("labels"),
        F.coalesce(F.array_max(F.transform("licences", lambda x: x["coverage"])), F.lit(0.0)).alias("score"))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candela.llm.bitslice import top_k
    return top_k(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candela.llm.classifier import THRESHOLD, held_out, score
    scored = score(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                   read_table(spark, sf_dir, "labels", ["doc_id", "quality"]))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candela.llm.bpe import encode_decode
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return encode_decode(docs, tokenizer_path("word_bpe_49k.json")).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candela.llm.mix import mix
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candela.llm.jaccard import join
    return join(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op7_chat_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candela.llm.chat import link
    messages = link(read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"]))
    return messages.select("conv_id", "turn", "role", "text", "reply_to", "thread", "depth", "n_quotes", "n_linked")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candela.llm.rules import judge
    judged, _ = judge(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                      read_table(spark, sf_dir, "labels", ["doc_id", "quality"]))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candela.llm.wordpiece import token_counts
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return token_counts(docs, tokenizer_path("piece_bpe_32k.model")).select("doc_id", "n_words", "n_tokens")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candela.llm.html import extract
    pages = extract(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]))
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candela.llm.align import align
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return align(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candela.llm.trie import conversation_trie
    return conversation_trie(read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "role", "text"]))


def op13_rans_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from candela.llm.rans import ids_round_trip
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return ids_round_trip(docs, tokenizer_path("word_bpe_49k.json")).select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_top_k": op2_top_k,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_bpe": op4_bpe,
    "op5_source_mix": op5_source_mix,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_chat_threads": op7_chat_threads,
    "op8_quality_rules": op8_quality_rules,
    "op9_token_counts": op9_token_counts,
    "op10_html_text": op10_html_text,
    "op11_token_alignment": op11_token_alignment,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_rans_ids": op13_rans_ids,
}
