"""Pairwise-complete correlations of thousands of columns from sums over bands of columns.

For columns ``i`` and ``j`` everything that r needs over the rows that have both is an entry of a
product of matrices: with ``X`` the values (0 where missing) and ``M`` their presence, ``M'M`` counts
the rows, ``X'M`` and ``(X*X)'M`` sum one column where the other is present and ``X'X`` sums the
products.  A task multiplies its batches in numpy and emits a row per column, rows are added in
a tree of bounded fan-in, and r is worked out where a column's sums lie.  A band holds as many columns as
keep a task's sums within ``BAND`` doubles; more columns take more passes.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.nullsafe import qcol
from tabforge.session import checkpoint

#: Doubles that a task's sums may take (64 MB).
BAND = 8_000_000
#: Vectors added in one step of the tree.
FANIN = 32
#: Doubtful pairs settled in one aggregation.
CHUNK = 200
#: Spread, relative to the mean square, below which sums cannot tell a constant.
NOISE = 1e-10


def masked_correlations(df: DataFrame, columns: Sequence[str], band: int | None = None) -> DataFrame:
    """``(a, b, r)`` of every pair, ``a < b`` by name; NULL and NaN are missing.

    r is NULL where either column is constant over the rows that have both.  Sums are shifted by the
    column means; pairs whose spread is lost against their distance from it even so are worked out
    again from their rows, centred by their own means.
    """
    names = list(columns)
    d = len(names)
    rows = df.select(*[_present(qcol(c)).alias(f"x{i}") for i, c in enumerate(names)])
    first = rows.agg(*[a for i in range(d) for a in (
        F.avg(f"x{i}").alias(f"m{i}"), F.min(f"x{i}").alias(f"lo{i}"),
        F.max(f"x{i}").alias(f"hi{i}"))]).first()
    shift = np.array([first[f"m{i}"] or 0.0 for i in range(d)])
    varies = np.array([first[f"lo{i}"] != first[f"hi{i}"] for i in range(d)])
    band = band or max(1, min(d, BAND // (6 * max(1, d))))
    out = None
    for start in range(0, d - 1, band):
        part = _band(rows, range(start, min(start + band, d)), d, shift, varies)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return df.sparkSession.createDataFrame([], "a string, b string, r double")
    out = checkpoint(out)
    doubtful = [(r["i"], r["j"]) for r in out.where("doubtful").select("i", "j").collect()]
    if doubtful:
        exact = df.sparkSession.createDataFrame(_centred(rows, doubtful), "i int, j int, e double")
        out = out.join(F.broadcast(exact), ["i", "j"], "left").withColumn(
            "r", F.when(F.col("doubtful"), F.col("e")).otherwise(F.col("r")))
    labels = F.array(*[F.lit(c) for c in names])
    a, b = F.get(labels, F.col("i")), F.get(labels, F.col("j"))
    return out.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), "r")


def _present(c: Column) -> Column:
    x = c.cast("double")
    return F.when(~F.isnan(x), x)


def _band(rows: DataFrame, band: range, d: int, shift: np.ndarray, varies: np.ndarray) -> DataFrame:
    """``(i, j, r, doubtful)`` of the columns of a band with every later column."""
    start, own = band.start, len(band)
    shift, varies = shift[start:], varies[start:]
    xs = rows.select(*[f"x{i}" for i in range(start, d)])

    def sums(batches):
        acc = np.zeros((own, 6, d - start))
        for pdf in batches:
            x = pdf.to_numpy(dtype=np.float64, na_value=np.nan) - shift
            m = (~np.isnan(x)).astype(np.float64)
            x = np.where(m > 0, x, 0.0)
            xb, mb = x[:, :own], m[:, :own]
            for at, (left, right) in enumerate(((mb, m), (xb, m), (mb, x), (xb * xb, m),
                                                (mb, x * x), (xb, x))):
                acc[:, at] += left.T @ right
        yield pd.DataFrame({"i": np.arange(own, dtype=np.int32), "v": list(acc.reshape(own, -1))})

    def added(c: str) -> Column:
        zero = F.array_repeat(F.lit(0.0), 6 * (d - start))
        return F.aggregate(F.collect_list(c), zero,
                           lambda acc, v: F.zip_with(acc, v, lambda p, q: p + q))

    parts = xs.mapInPandas(sums, "i int, v array<double>")
    width = max(1, xs.rdd.getNumPartitions())
    parts = parts.withColumn("t", F.spark_partition_id())
    while width > FANIN:
        width = -(-width // FANIN)
        parts = (parts.withColumn("t", F.floor(F.col("t") / FANIN).cast("int"))
                 .groupBy("i", "t").agg(added("v").alias("v")))
    whole = parts.groupBy("i").agg(added("v").alias("v"))

    def correlate(batches):
        for pdf in batches:
            for i, v in zip(pdf["i"], pdf["v"]):
                n, sx, sy, sxx, syy, sxy = np.asarray(v).reshape(6, -1)[:, i + 1:]
                with np.errstate(divide="ignore", invalid="ignore"):
                    vx, vy = sxx / n - (sx / n) ** 2, syy / n - (sy / n) ** 2
                    r = (sxy / n - sx / n * (sy / n)) / np.sqrt(vx * vy)
                    known = (n > 1) & varies[i] & varies[i + 1:]
                    clear = (vx > NOISE * sxx / n) & (vy > NOISE * syy / n)
                yield pd.DataFrame({
                    "i": np.int32(start + i), "j": np.arange(start + i + 1, d, dtype=np.int32),
                    "r": pd.Series(np.where(known & clear, r, np.nan), dtype=object).where(known & clear, None),
                    "doubtful": known & ~clear})

    return whole.mapInPandas(correlate, "i int, j int, r double, doubtful boolean")


def _centred(rows: DataFrame, pairs: Sequence[tuple[int, int]]) -> list[tuple[int, int, float | None]]:
    """r of single pairs by Spark's centred aggregates."""
    out = []
    for start in range(0, len(pairs), CHUNK):
        chunk, aggs = pairs[start:start + CHUNK], []
        for k, (i, j) in enumerate(chunk):
            x, y = F.col(f"x{i}"), F.col(f"x{j}")
            both = x.isNotNull() & y.isNotNull()
            x, y = F.when(both, x), F.when(both, y)
            r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
            aggs.append(F.when((F.max(x) > F.min(x)) & (F.max(y) > F.min(y)), r).alias(f"r{k}"))
        got = rows.agg(*aggs).first()
        out += [(i, j, got[f"r{k}"]) for k, (i, j) in enumerate(chunk)]
    return out
