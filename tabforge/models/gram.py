"""Sufficient statistics of linear least squares, per fold, in one pass.

For every fold ``g`` the pass yields ``n, Σx, Σy, XᵀX, Xᵀy, yᵀy``.  Training
statistics of "all folds but g" are *total minus fold*, so every α, l1 ratio
and fold of a cross-validated linear model is solved on ``d x d`` matrices
without touching the rows again.

Plan: ``mapInPandas`` accumulates the statistics of its partition with numpy
(one flat vector per fold), then a tree reduction sums the vectors: partition
ids are divided by ``fanin`` level by level, so every group sums at most
``fanin`` vectors and no task receives all partitions' vectors.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.nullsafe import qcol
from tabforge.sources.tables import nan_to_null


@dataclass
class Stats:
    """Statistics of one row set (a fold, a complement, or everything).

    The sums are those of ``x - x0`` and ``y - y0``; a shift near the means keeps the centred
    moments free of cancellation.  Sets that are added or subtracted share their shift.
    """
    n: float
    sx: np.ndarray
    sy: float
    sxx: np.ndarray
    sxy: np.ndarray
    syy: float
    x0: np.ndarray | float = 0.0
    y0: float = 0.0

    def __add__(self, o: "Stats") -> "Stats":
        return Stats(self.n + o.n, self.sx + o.sx, self.sy + o.sy, self.sxx + o.sxx,
                     self.sxy + o.sxy, self.syy + o.syy, self.x0, self.y0)

    def __sub__(self, o: "Stats") -> "Stats":
        return Stats(self.n - o.n, self.sx - o.sx, self.sy - o.sy, self.sxx - o.sxx,
                     self.sxy - o.sxy, self.syy - o.syy, self.x0, self.y0)

    @property
    def d(self) -> int:
        return len(self.sx)

    def means(self) -> tuple[np.ndarray, float]:
        return self.sx / self.n + self.x0, self.sy / self.n + self.y0

    def moments(self) -> tuple[np.ndarray, np.ndarray]:
        """``XᵀX, Xᵀy`` of the unshifted rows."""
        x0 = np.broadcast_to(self.x0, self.sx.shape)
        sx = self.sx + self.n * x0
        sy = self.sy + self.n * self.y0
        return (self.sxx + np.outer(self.sx, x0) + np.outer(x0, sx),
                self.sxy + self.sx * self.y0 + x0 * sy)

    def sst(self) -> float:
        """``Σ (y - ȳ)²``."""
        return self.syy - self.sy * self.sy / self.n

    def centered(self) -> tuple[np.ndarray, np.ndarray, float]:
        """``XcᵀXc, Xcᵀyc, ycᵀyc`` around this set's own means."""
        mx, my = self.sx / self.n, self.sy / self.n
        g = self.sxx - self.n * np.outer(mx, mx)
        c = self.sxy - self.n * mx * my
        s = self.syy - self.n * my * my
        return g, c, s

    def scaled(self, center: np.ndarray, scale: np.ndarray) -> "Stats":
        """Statistics of ``(x - center) / scale`` (an affine map of the rows)."""
        inv = 1.0 / scale
        center = center - self.x0
        sx = (self.sx - self.n * center) * inv
        sxx = (self.sxx - np.outer(self.sx, center) - np.outer(center, self.sx)
               + self.n * np.outer(center, center)) * np.outer(inv, inv)
        sxy = (self.sxy - center * self.sy) * inv
        return Stats(self.n, sx, self.sy, sxx, sxy, self.syy, 0.0, self.y0)

    def sse(self, w: np.ndarray, b: float) -> float:
        """``Σ (y - xw - b)²`` over this set."""
        b = b + float(np.sum(w * self.x0)) - self.y0
        return float(self.syy - 2 * w @ self.sxy - 2 * b * self.sy + w @ self.sxx @ w
                     + 2 * b * w @ self.sx + self.n * b * b)


@dataclass
class FoldStats:
    folds: dict[int, Stats]
    _total: Stats | None = None

    def total(self) -> Stats:
        if self._total is None:
            it = iter(self.folds.values())
            acc = next(it)
            for s in it:
                acc = acc + s
            self._total = acc
        return self._total

    def train(self, fold: int) -> Stats:
        return self.total() - self.folds[fold]

    def marginal(self, to_fold) -> "FoldStats":
        """Merge fine-grained folds into coarser ones (``to_fold(fine_id) -> coarse_id``)."""
        out: dict[int, Stats] = {}
        for k, s in self.folds.items():
            c = int(to_fold(k))
            out[c] = out[c] + s if c in out else s
        return FoldStats(out)


def layout_size(d: int) -> int:
    """Doubles in one statistics vector for ``d`` features."""
    return _layout(d)


def _layout(d: int) -> int:
    return 1 + d + 1 + d * d + d + 1


def _unpack(v: np.ndarray, d: int, x0: np.ndarray, y0: float) -> Stats:
    i = 0
    n = v[i]; i += 1
    sx = v[i:i + d]; i += d
    sy = v[i]; i += 1
    sxx = v[i:i + d * d].reshape(d, d); i += d * d
    sxy = v[i:i + d]; i += d
    syy = v[i]
    return Stats(float(n), sx.copy(), float(sy), sxx.copy(), sxy.copy(), float(syy), x0, y0)


def gram_stats(df: DataFrame, features: Sequence[str], label: str,
               fold: str | None = None, fanin: int = 32, nulls: str = "error") -> FoldStats:
    """Per-fold statistics of ``label ~ features``.

    Rows with a NULL (or NaN) feature, label or fold are counted and raise an error;
    ``nulls="skip"`` leaves them out instead.  A first aggregation takes the column means, by
    which the second pass shifts its sums.
    """
    if nulls not in ("error", "skip"):
        raise ValueError(f"unknown treatment of NULLs {nulls!r}")
    feats = list(features)
    d = len(feats)
    m = _layout(d)
    fold_col = qcol(fold).cast("int") if fold else F.lit(0)
    src = df.select(fold_col.alias("_fold"), qcol(label).cast("double").alias("_y"),
                    *[qcol(c).cast("double").alias(f"_f{i}") for i, c in enumerate(feats)])
    src = nan_to_null(src)
    xnames = [f"_f{i}" for i in range(d)]
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in src.columns])
    first = src.agg(F.count_if(bad).alias("bad"),
                    *[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in ["_y", *xnames]]).first()
    if first["bad"] and nulls == "error":
        raise ValueError(f"{first['bad']} rows hold a NULL feature or label: impute them first, "
                         "or leave them out by nulls='skip'")
    src = src.dropna()
    x0, y0 = np.array([first[c] for c in xnames], dtype=np.float64), float(first["_y"])

    def partial(batches):
        acc: dict[int, np.ndarray] = {}
        for pdf in batches:
            for g, part in pdf.groupby("_fold"):
                x = part[xnames].to_numpy(dtype=np.float64) - x0
                y = part["_y"].to_numpy(dtype=np.float64) - y0
                v = np.concatenate([[len(y)], x.sum(0), [y.sum()], (x.T @ x).ravel(),
                                    x.T @ y, [y @ y]])
                g = int(g)
                acc[g] = acc[g] + v if g in acc else v
        if acc:
            yield pd.DataFrame({"_fold": list(acc), "_v": [a.tolist() for a in acc.values()]})

    parts = src.mapInPandas(partial, "_fold int, _v array<double>")
    zeros = F.array_repeat(F.lit(0.0), m)

    def vsum(col):
        return F.aggregate(F.collect_list(col), zeros,
                           lambda acc, v: F.zip_with(acc, v, lambda a, b: a + b))
    # tree reduction: every group sums at most ``fanin`` vectors
    width = max(1, src.rdd.getNumPartitions())
    cur = parts.withColumn("_b", F.spark_partition_id().cast("long"))
    while width > fanin:
        width = -(-width // fanin)
        cur = (cur.withColumn("_b", F.floor(F.col("_b") / fanin))
               .groupBy("_fold", "_b").agg(vsum("_v").alias("_v")))
    final = cur.groupBy("_fold").agg(vsum("_v").alias("_v"))
    out = {}
    for r in final.collect():
        out[int(r["_fold"])] = _unpack(np.asarray(r["_v"], dtype=np.float64), d, x0, y0)
    return FoldStats(out)
