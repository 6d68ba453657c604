"""Line dedup: lines that many documents share are dropped from every document."""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tabforge.llm.common import SPACE, text_bytes

_SPACE = SPACE.encode()


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """128-bit hash of the stripped, A-Z lower-cased line; None if it is too short to count."""
    key = line.strip(_SPACE).lower()
    if len(key) < min_chars or (min_chars > 1 and len(key.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def _keys_udf(min_chars: int):
    @arrow_udf("array<binary>")
    def line_keys(text: pa.Array) -> pa.Array:
        out = []
        for raw in text_bytes(text):
            keys = {line_key(line, min_chars) for line in raw.split(b"\n")}
            keys.discard(None)
            out.append(list(keys))
        return pa.array(out, pa.list_(pa.binary()))

    return line_keys


def _keep_udf(min_chars: int):
    @arrow_udf("struct<text:string,n_lines:long,n_dropped:long>")
    def keep_lines(text: pa.Array, hot: pa.Array) -> pa.Array:
        texts, counts, drops = [], [], []
        for raw, gone in zip(text_bytes(text), hot.to_pylist(), strict=True):
            lines = raw.split(b"\n")
            kept = lines
            if gone:
                gone = set(gone)
                kept = [line for line in lines if line_key(line, min_chars) not in gone]
            texts.append(b"\n".join(kept))
            counts.append(len(lines))
            drops.append(len(lines) - len(kept))
        return pa.StructArray.from_arrays(
            [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()),
             pa.array(drops, pa.int64())], names=["text", "n_lines", "n_dropped"])

    return keep_lines


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Drop every line whose key is found in at least ``min_docs`` documents.

    Returns ``docs`` with the kept lines, joined in their order, in ``text_col``, and ``n_lines``
    (before dropping) and ``n_dropped``; columns of these names are replaced, all others stay.

    Plan: every document's distinct line keys are exploded to ``(key, id)``; distinct documents
    are counted per key in two aggregations that combine before the shuffle, so a line of a third
    of all documents meets as one partial count a task.  Hot keys go back to ``(key, id)`` by a
    sort-merge join (AQE splits a skewed key) and are gathered per document, which bounds that
    list by the document's own lines.  Texts move once, for the last join.

    Null and empty texts are one empty line, which no rule drops, and come back empty.  Documents
    are told apart by ``id_col``: rows repeating an id count as one document, and each of them
    loses the lines that are hot.  All null ids count as one document.  An empty table gives an
    empty result.
    """
    pairs = (docs.select(F.col(id_col).alias("_id"),
                         F.explode(_keys_udf(min_chars)(F.col(text_col))).alias("_key"))
             .distinct())
    hot = pairs.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_docs)
    gone = (pairs.join(hot.select("_key"), "_key", "left_semi")
            .groupBy("_id").agg(F.collect_set("_key").alias("_gone"))
            .withColumnRenamed("_id", "_gone_id"))
    joined = docs.join(gone, docs[id_col].eqNullSafe(gone["_gone_id"]), "left")
    kept = joined.withColumn("_kept", _keep_udf(min_chars)(F.col(text_col), F.col("_gone")))
    return kept.withColumns({
        text_col: F.col("_kept.text"), "n_lines": F.col("_kept.n_lines"),
        "n_dropped": F.col("_kept.n_dropped"),
    }).drop("_kept", "_gone", "_gone_id")
