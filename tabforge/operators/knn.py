"""k-nearest-neighbour imputation (KNNimpute, Troyanskaya et al. 2001).

For a row with a NULL in target column ``t``, the donors are the rows of the
same block with ``t`` observed.  The distance is the mean squared difference
over the features observed in both rows (donors sharing no observed feature
are skipped).  The value is the ``1/distance``-weighted mean of ``t`` over the
``k`` nearest donors, ties broken by donor key; if some of them are at
distance 0 the value is the mean of those; fewer than ``k`` donors use all of
them; no donor leaves the cell NULL.

Spark plan (no candidate cap):

* **profiles, not rows.**  A query's answer depends only on its block, target
  and feature vector (its *profile*), so queries are grouped by profile and
  answered once.  Donors with the same block, target and feature vector
  (target masked) are at the same distance from every query, so each donor
  profile keeps only its ``k`` smallest-key donors (a bounded array, chosen by
  a two-level top-k so a hot profile is split across tasks);
* query profiles meet donor profiles cell by cell
  (:mod:`tabforge.operators.neighbours`): a step holds one cell of donors and a
  slice of queries, keeps a running top-k and emits at most ``k`` rows a query,
  so no row per pair is ever made or shuffled.  Boxes around the cells tell
  which ones a query can leave out; ``method="hash"`` looks in the buckets of
  random-projection hash tables instead;
* answers go back to the rows by a join on the profile, and to columns by a
  pivot over the ``#targets`` values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.functions.nullsafe import qcol
from tabforge.operators.neighbours import CELL_ROWS, SLICE_ROWS, approximate_nearest, exact_nearest
from tabforge.session import checkpoint

# Buckets used to split one hot donor profile before keeping its k smallest keys.
PROFILE_SALT = 16


def _top_k(df: DataFrame, part: list[str], order: list[Column], k: int, salt: Column | None,
           nb: int) -> DataFrame:
    """Rows with the k smallest ``order`` per ``part``; with a salt, first per
    ``(part, salt)`` and then over the at most ``nb * k`` survivors."""
    if salt is not None and nb > 1:
        w1 = Window.partitionBy(*part, salt).orderBy(*order)
        df = df.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k).drop("_r1")
    w2 = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn("_r2", F.row_number().over(w2)).where(F.col("_r2") <= k).drop("_r2")


def knn_impute(df: DataFrame, key: str, features: Sequence[str],
               targets: Sequence[str] | None = None, k: int = 10,
               block: Sequence[str] | str | None = None,
               method: str = "exact", tables: int = 8, cell_rows: int = CELL_ROWS,
               slice_rows: int = SLICE_ROWS, donors: Column | None = None) -> DataFrame:
    """Fill NULLs of ``targets`` (default: all ``features``); other cells unchanged.

    With a condition ``donors`` only the rows that meet it give values; all rows are filled.

    ``method="hash"`` is the approximate mode: donors are looked up in ``tables``
    random-projection hash tables over the features without NULLs (queries that
    find fewer than ``k`` donors there are answered exactly).
    """
    if method not in ("exact", "hash"):
        raise ValueError(f"unknown method {method!r}")
    feats = list(features)
    targets = list(targets) if targets else feats
    tidx = [feats.index(t) for t in targets]
    blocks = [block] if isinstance(block, str) else list(block or [])
    d = len(feats)
    bcols = [f"_b{i}" for i in range(len(blocks))]

    base = df.select(qcol(key).alias("_key"),
                     *[qcol(b).alias(f"_b{i}") for i, b in enumerate(blocks)],
                     F.array(*[qcol(f).cast("double") for f in feats]).alias("_x"),
                     (F.lit(True) if donors is None else donors).alias("_gives"))
    x = F.col("_x")

    # query rows, one per missing target; their profile is the whole vector
    missing = F.filter(F.array(*[F.when(x[i].isNull(), F.lit(j)) for j, i in enumerate(tidx)]),
                       lambda v: v.isNotNull())
    qrows = base.select("_key", *bcols, F.explode(missing).alias("_t"), x.alias("_qp"))
    named = [F.col(c).isNotNull() for c in bcols]
    inside = reduce(lambda a, b: a & b, named, F.lit(True))
    group = F.xxhash64(*bcols, "_t")
    qprof = checkpoint(qrows.where(inside).select(*bcols, "_t", "_qp").distinct()
                       .withColumn("q", F.monotonically_increasing_id()))

    # donor rows, one per observed target; profile = vector with the target masked
    observed = F.filter(F.array(*[
        F.when(x[i].isNotNull(), F.struct(F.lit(j).alias("t"), x[i].alias("v"),
                                          F.array(*[F.lit(None).cast("double") if m == i else x[m]
                                                    for m in range(d)]).alias("p")))
        for j, i in enumerate(tidx)]), lambda s: s.isNotNull())
    drows = (base.where("_gives").select("_key", *bcols, F.explode(observed).alias("_o"))
             .select(F.col("_key").alias("_dkey"), *bcols, F.col("_o.t").alias("_t"),
                     F.col("_o.v").alias("_v"), F.col("_o.p").alias("_dp")))
    # keep the k smallest keys of every donor profile (bounded, split when hot)
    dsalt = F.pmod(F.xxhash64("_dkey"), F.lit(PROFILE_SALT))
    dtop = _top_k(drows, bcols + ["_t", "_dp"], [F.col("_dkey")], k, dsalt, PROFILE_SALT)
    dprof = checkpoint(dtop.where(inside).groupBy(*bcols, "_t", "_dp")
                       .agg(F.collect_list(F.struct(F.col("_dkey").alias("key"), F.col("_v").alias("v")))
                            .alias("donors"))
                       .select(group.alias("g"), F.col("_dp").alias("x"), "donors"))
    queries = qprof.select("q", group.alias("g"), F.col("_qp").alias("x"))
    key_type = df.schema[key].dataType
    if method == "hash":
        gaps = base.agg(*[F.max(x[i].isNull().cast("int")).alias(str(i)) for i in range(d)]).first()
        whole = [i for i in range(d) if gaps[str(i)] == 0 and i not in tidx]
        found = approximate_nearest(queries, dprof, d, k, key_type, whole, tables,
                                    cell_rows=cell_rows, slice_rows=slice_rows)
    else:
        found = exact_nearest(queries, dprof, d, k, key_type, cell_rows, slice_rows)
    total = lambda rows, value: F.aggregate(rows, F.lit(0.0), lambda acc, r: acc + value(r))
    zero, near = F.filter("best", lambda r: r["d"] == 0), F.col("best")
    fill = (F.when(F.size(zero) > 0, total(zero, lambda r: r["v"]) / F.size(zero))
            .otherwise(total(near, lambda r: r["v"] / r["d"]) / total(near, lambda r: F.lit(1.0) / r["d"])))
    answers = found.where(F.size("best") > 0).select("q", fill.alias("_fill")).join(qprof, "q").drop("q")

    filled = qrows.join(answers, on=bcols + ["_t", "_qp"], how="inner").select("_key", "_t", "_fill")
    wide = filled.groupBy("_key").pivot("_t", list(range(len(targets)))).agg(F.first("_fill"))
    wide = wide.select(F.col("_key").alias("__knn_key"),
                       *[F.col(str(j)).alias(f"__knn_{j}") for j in range(len(targets))])
    joined = df.join(wide, df[key] == wide["__knn_key"], "left")
    pos = {t: j for j, t in enumerate(targets)}
    out = [F.coalesce(qcol(c), F.col(f"__knn_{pos[c]}")).cast(df.schema[c].dataType).alias(c)
           if c in pos else qcol(c) for c in df.columns]
    return joined.select(*out)
