"""Corpus preparation: quality classifier, line dedup, near-duplicate removal, mixing, packing.

Each stage takes all that the one before kept.  All but the last return the columns of
``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm import line_dedup, mixing, packing, quality_cnn, simhash
from tabforge.llm.queries import tokenizer_path
from tabforge.session import scratch_path
from tabforge.sources.tables import read_table

#: The classifier, the fingerprints and the packing are beyond SQL; tests compare the stages with
#: brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.3 go."""
    net = quality_cnn.fit(docs, read_table(spark, sf_dir, "labels", ["doc_id", "quality"]))
    return quality_cnn.keep_good(docs, net, threshold=0.3)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of at least ten documents go; every document stays, if only with an empty text."""
    kept = line_dedup.dedup_lines(docs, min_docs=10, min_chars=1)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by fingerprints within three bits stays."""
    return simhash.keep_one(docs, shingle=3, radius=3)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target takes it."""
    return mixing.apply_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of at most 1024 tokens, a row per piece."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates),
          ("mix", mix), ("pack", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared checkpoint folder and read
    again, so a lost executor never costs more than the stage it was in."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
