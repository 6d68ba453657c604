"""Mixing sources to target weights by hash-threshold histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.common import n_words
from tabforge.session import checkpoint

HASH_BITS = 60
LEVEL_BITS = 12


def mix_hash(id_col: Column) -> Column:
    """The 60 leading bits of the id's MD5, as a long (null: the empty string's)."""
    text = F.coalesce(id_col.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3),
                   max_repeats: int = 3) -> DataFrame:
    """Target of each row of ``(source, source_size)``: weights repeat over the sources in code
    point order (null last) and share the whole size; a target stops at ``max_repeats`` times
    its source's size and the excess goes to the others by weight.

    In the order of ``cap / weight`` the capped sources are a prefix, so one running sum finds
    the level at which no source is above its cap.  The table has one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    k = (F.row_number().over(by_name) - 1) % len(weights)
    table = (sizes.withColumn("_w", F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                                                 (k + 1).cast("int")).cast("long"))
             .withColumn("_cap", F.col("source_size") * F.lit(max_repeats).cast("long"))
             .withColumn("_ratio", F.col("_cap").cast("double") / F.col("_w")))
    order = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    zero = F.lit(0).cast("long")
    table = (table.withColumn("_left", F.sum("source_size").over(everything)
                              - F.coalesce(F.sum("_cap").over(before), zero))
             .withColumn("_wleft", F.sum("_w").over(everything)
                         - F.coalesce(F.sum("_w").over(before), zero))
             .withColumn("_level", F.col("_left").cast("double") / F.col("_wleft"))
             .withColumn("_open", F.max((F.col("_level") <= F.col("_ratio")).cast("int"))
                         .over(order.rowsBetween(Window.unboundedPreceding, 0)))
             .withColumn("_final", F.max(F.when((F.col("_open") == 1), F.struct(
                 -F.row_number().over(order), F.col("_level").alias("level")))).over(everything)))
    return table.select("source", "source_size", F.when(
        F.col("_open") == 1, F.col("_final.level") * F.col("_w"))
        .otherwise(F.col("_cap").cast("double")).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """How much of each document the mix takes.

    Returns ``docs`` with ``size`` (words), ``source_size``, ``target`` and ``taken`` (words,
    repeats counted); columns of these names are replaced.  A target of ``k`` whole passes and a
    rest takes every document ``k`` times and once more those whose hash is below the source's
    threshold.

    Thresholds: words are summed by source and the leading 12 bits of the hash; running sums (at
    most 2^12 rows a source) give the bucket in which the budget ends, and only that bucket's
    documents are summed by the next 12 bits, down to one hash value, which is taken if the sum
    gets nearer to the target with it.  No document is sorted, a larger budget's choice holds a
    smaller one's, and reruns agree since the hash is the id's.  Histograms combine before the
    shuffle, so a source with a third of the rows is a few thousand partial sums.

    Null texts have size 0, null sources are a source of their own, rows that repeat an id share
    its hash and are taken together, sources without words get target 0, and an empty table an
    empty result.
    """
    docs = docs.drop("size", "source_size", "target", "taken")
    sized = checkpoint(docs.select(F.col(source_col).alias("source"), mix_hash(F.col(id_col)).alias("h"),
                                   n_words(F.col(text_col)).alias("size"))
                       .groupBy("source", "h").agg(F.sum("size").alias("size")))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    passes = F.when(F.col("source_size") > 0,
                    F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    state = checkpoint(
        source_targets(sources, weights, max_repeats)
        .withColumn("passes", passes)
        .withColumn("rest", F.floor("target").cast("long") - F.col("passes") * F.col("source_size"))
        .withColumn("prefix", F.lit(0).cast("long")))
    state = thresholds(sized, state)
    plan = state.select(F.col("source").alias("_source"), "source_size", "target",
                        F.col("passes").alias("_passes"), F.col("below").alias("_below"))
    out = docs.withColumns({"size": n_words(F.col(text_col)), "_h": mix_hash(F.col(id_col))})
    out = out.join(plan, out[source_col].eqNullSafe(plan["_source"]), "left")
    once = (F.col("_h") < F.col("_below")).cast("long")
    return (out.withColumn("taken", F.col("size") * (F.col("_passes") + once))
            .drop("_h", "_source", "_passes", "_below"))


def thresholds(sized: DataFrame, state: DataFrame) -> DataFrame:
    """Add ``below`` to ``state (source, rest, prefix, ...)``: hashes under it are taken once
    more.  ``rest`` is what the budget still has at the start of the bucket ``prefix``."""
    for level in range(HASH_BITS // LEVEL_BITS):
        shift = HASH_BITS - LEVEL_BITS * (level + 1)
        inside = sized.withColumn("_b", F.shiftright("h", shift))
        if level:
            edge = state.select(F.col("source").alias("_s"), "prefix")
            inside = (inside.join(edge, inside["source"].eqNullSafe(edge["_s"])
                                  & (F.shiftright("_b", LEVEL_BITS) == F.col("prefix")))
                      .drop("_s", "prefix"))
        hist = inside.groupBy("source", "_b").agg(F.sum("size").alias("_n"))
        run = Window.partitionBy("source").orderBy("_b")
        hist = (hist.withColumn("_upto", F.sum("_n").over(run))
                .withColumn("_before", F.col("_upto") - F.col("_n"))
                .select(F.col("source").alias("_s"), "_b", "_n", "_upto", "_before"))
        bucket = (state.join(hist, state["source"].eqNullSafe(hist["_s"])
                             & (F.col("_upto") > F.col("rest")))
                  .groupBy(F.col("source").alias("_s"))
                  .agg(F.min(F.struct("_b", "_before", "_n")).alias("_e")))
        state = checkpoint(
            state.join(bucket, state["source"].eqNullSafe(bucket["_s"]), "left")
            .withColumn("rest", F.col("rest") - F.coalesce(F.col("_e._before"), F.lit(0)))
            .withColumn("prefix", F.coalesce(F.col("_e._b"), F.lit(0)))
            .withColumn("_last", F.col("_e._n")).drop("_s", "_e")
            .select(*[c for c in state.columns if c != "_last"], "_last"))
    over = F.coalesce(F.col("_last"), F.lit(0)) - F.col("rest")
    return state.withColumn("below", F.when((F.col("rest") > 0) & (over < F.col("rest")),
                                            F.col("prefix") + 1).otherwise(F.col("prefix")))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              source_col: str = "source", **kwargs) -> DataFrame:
    """The mixed corpus: every document as many times as the mix takes it, with the columns of
    ``docs``.  A document without words has nothing to take and goes."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       F.col(id_col).alias("_id"), F.col(text_col).alias("_text"),
                       F.col(source_col).alias("_from"))
    plan = mix(rows, id_col="_id", text_col="_text", source_col="_from", **kwargs)
    times = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(F.lit(0))
    return (plan.withColumn("_times", times.cast("int")).where(F.col("_times") > 0)
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select("_row.*"))
