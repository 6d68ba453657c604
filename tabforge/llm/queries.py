"""Registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm import (ann, divergence, licenses, line_dedup, minhash, mixing, oracles, packing,
                          quality_cnn, quality_rules, simhash, suffix_dedup, warc, whitening)
from tabforge.session import scratch_path
from tabforge.sources.tables import read_table

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read_table(spark, sf_dir, "embeddings"), k=20, every=20)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"])
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return line_dedup.dedup_lines(docs, min_docs=10, min_chars=1).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return suffix_dedup.dedup_substrings(docs, length=100).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    net = quality_cnn.fit(docs, read_table(spark, sf_dir, "labels", ["doc_id", "quality"]))
    return quality_cnn.score(docs, net).select("doc_id", "held_out", "score", "predicted")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return simhash.simhash_groups(docs, shingle=3, radius=3).select(
        "doc_id", "fingerprint", "component_id")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files are the documents, at ``source/lang/<doc_id div 64>/<doc_id>.txt``."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source"])
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")),
                       F.floor(F.col("doc_id") / 64).cast("string"),
                       F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return licenses.scan_licenses(docs.withColumn("path", path))


def op8_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_warc(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]), path)
    records = warc.read_warc(spark, path).where(F.col("status") == "record")
    return records.select(
        warc.page_id(F.col("record_id")).cast("long").alias("page_id"), "payload_bytes",
        "payload_digest", "record_type", warc.page_id(F.col("refers_to")).cast("long").alias("refers_to"))


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return packing.pack(docs, tokenizer_path())


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return quality_rules.apply_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines_removed", "lost_chars")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    return whitening.whiten(vectors, components=8).withColumn("deviation", F.col("deviation").cast("long"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["lang", "source", "text"])
    return divergence.divergence(docs, min_docs=10, top=10)


def op13_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return minhash.minhash_groups(docs, similarity=Fraction(85, 100), shingle=3)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_learned_partitions, op2_mix_sources, op3_line_dedup, op4_suffix_dedup, op5_quality_cnn,
        op6_simhash, op7_license_scan, op8_warc_salvage, op9_pack, op10_quality_rules, op11_whitening,
        op12_source_divergence, op13_bbit_minhash)
}

#: The others rest on XXH64, a fitted model or an online packing, which SQL doesn't express; their
#: tests compare with brute force, held-out accuracy or the texts put together again.
ORACLE: dict[str, str] = {
    "op2_mix_sources": oracles.MIX,
    "op3_line_dedup": oracles.LINES,
    "op4_suffix_dedup": oracles.SUBSTRINGS,
    "op8_warc_salvage": oracles.WARC,
    "op12_source_divergence": oracles.DIVERGENCE,
    "op10_quality_rules": oracles.quality_rules(quality_rules.BOILERPLATE),
}
