"""Skew correction: Box-Cox λ fitting and the skewness-driven ``SkewFix``.

The reference de-skews every numeric column whose population skewness
exceeds 0.5 with ``boxcox1p(x, boxcox_normmax(x + 1))``.  ``boxcox_normmax``
chooses λ by maximising the Pearson correlation between the sorted
transformed data and normal order-statistic medians (``method="pearsonr"``),
or by maximising the Box-Cox log-likelihood (``method="mle"``).

Spark plan:

* ``value_ranks`` gives every distinct value its rank range in its column
  (distributed; a hot value or column is never collected into one task);
* for ``pearsonr``, the normal scores of the ranks are summed per distinct
  value (ranks are enumerated in bounded chunks, spread by a round-robin
  repartition), so each value carries ``(x, cnt, Σz)``;
* that table (at most one row per distinct value) is checkpointed, then λ is
  searched with a coarse grid and three refining grids; each grid is *one*
  aggregation holding the sums for every candidate λ of every column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.normal import add_norm_ppf
from tabforge.functions.numeric import boxcox1p
from tabforge.functions.nullsafe import qcol
from tabforge.operators.quantiles import unpivot, value_ranks
from tabforge.operators.stats import skew_report
from tabforge.session import checkpoint

RANK_CHUNK = 100_000


def boxcox_col(x: Column, lam: Column) -> Column:
    """Box-Cox with λ given as a Column (one expression per candidate λ)."""
    return F.when(F.abs(lam) < F.lit(1e-12), F.log(x)).otherwise((F.pow(x, lam) - 1) / lam)


def llf_grid(df: DataFrame, column: str, lambdas: Sequence[float], shift: float = 0.0) -> DataFrame:
    """Box-Cox log-likelihood of ``column + shift`` for each λ: ``(lambda, llf)``.

    ``llf = (λ-1) Σ log x - n/2 log var_pop(boxcox(x, λ))``.  Each row is
    expanded once per candidate λ (a fixed fan-out) and aggregated per λ.
    """
    x = (qcol(column).cast("double") + F.lit(float(shift)))
    base = df.select(x.alias("x")).where(F.col("x").isNotNull())
    lam_arr = F.array(*[F.lit(float(lam)) for lam in lambdas])
    per = (base.select("x", F.explode(lam_arr).alias("lambda"))
           .groupBy("lambda")
           .agg(F.sum(F.log("x")).alias("slog"), F.count(F.lit(1)).alias("n"),
                F.var_pop(boxcox_col(F.col("x"), F.col("lambda"))).alias("v")))
    return per.select("lambda", ((F.col("lambda") - 1) * F.col("slog")
                                 - F.col("n") / 2.0 * F.log(F.col("v"))).alias("llf"))


def normal_score_sums(ranks: DataFrame) -> DataFrame:
    """``(feature, x, cnt, z)``: Σ of normal order-statistic medians over each value's ranks.

    Filliben's medians: ``1 - 0.5**(1/n)`` for rank 1, ``0.5**(1/n)`` for rank
    n, ``(i - 0.3175) / (n + 0.365)`` between.
    """
    chunks = ranks.select(
        "feature", "x", "_cnt", "_before", "_n",
        F.explode(F.sequence(F.lit(0), F.ceil(F.col("_cnt") / RANK_CHUNK).cast("int") - 1))
        .alias("_chunk"))
    spread = chunks.repartition(int(ranks.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    lo = F.col("_before") + 1 + F.col("_chunk") * RANK_CHUNK
    hi = F.least(lo + RANK_CHUNK - 1, F.col("_before") + F.col("_cnt"))
    rows = spread.select("feature", "x", "_n", "_cnt",
                         F.explode(F.sequence(lo.cast("long"), hi.cast("long"))).alias("i"))
    n = F.col("_n").cast("double")
    i = F.col("i").cast("double")
    top = F.pow(F.lit(0.5), F.lit(1.0) / n)
    u = (F.when(F.col("i") == F.col("_n"), top)
         .when(F.col("i") == 1, F.lit(1.0) - top)
         .otherwise((i - 0.3175) / (n + 0.365)))
    scored = add_norm_ppf(rows.select("feature", "x", "_cnt", "_n", u.alias("_u")), "_u", "_zn")
    z = F.when(F.col("_n") == 1, F.lit(0.0)).otherwise(F.col("_zn"))
    return (scored.select("feature", "x", "_cnt", "_n", z.alias("_z"))
            .groupBy("feature", "x")
            .agg(F.max("_cnt").alias("_cnt"), F.max("_n").alias("_n"),
                 F.sum("_z").alias("z"), F.sum(F.col("_z") * F.col("_z")).alias("zz")))


@dataclass
class LambdaFit:
    lambdas: dict[str, float]
    scores: dict[str, float] = field(default_factory=dict)


#: Times that the search for lambda may widen its range before it gives up with an error.
MAX_WIDENINGS = 8


def fit_lambdas(df: DataFrame, columns: Sequence[str], method: str = "pearsonr",
                shift: float = 1.0, lo: float = -5.0, hi: float = 5.0, grid: int = 41,
                refinements: int = 3) -> LambdaFit:
    """λ per column for ``boxcox(column + shift)`` (``shift=1`` as ``boxcox_normmax(x + 1)``).

    Columns must be ``> -shift`` (else an error).  Grid search over ``[lo, hi]``, which moves on
    and widens while the best point is at its edge, then
    ``refinements`` grids of the same size around the best point; the final
    step is ``(hi - lo) / (grid - 1) ** (refinements + 1) * 2**refinements``.
    """
    cols = list(columns)
    if not cols:
        return LambdaFit({})
    long = unpivot(df, cols).where(F.col("value").isNotNull())
    long = long.select("feature", (F.col("value") + F.lit(float(shift))).alias("x"))
    ranks = value_ranks(long, "x", by=["feature"])
    if method == "pearsonr":
        table = normal_score_sums(ranks)
    elif method == "mle":
        table = ranks.select("feature", "x", "_cnt", "_n", F.lit(0.0).alias("z"),
                             F.lit(0.0).alias("zz"))
    else:
        raise ValueError(f"unknown method {method!r}")
    # one row per distinct value; cut the lineage before the λ passes
    table = checkpoint(table)
    ends = table.groupBy("feature").agg(F.min("x").alias("lo"), F.max("x").alias("hi")).collect()
    if same := sorted(r["feature"] for r in ends if r["lo"] == r["hi"]):
        raise ValueError(f"constant columns have no best lambda: {same}")
    if low := [r["feature"] for r in ends if r["lo"] <= 0]:
        raise ValueError(f"values at or below {-shift} have no Box-Cox transform: {sorted(low)}")
    # per-column constants, λ-independent: Σz, Σz², Σ cnt·log x, n, a centring point
    consts = {r["feature"]: r for r in table.groupBy("feature").agg(
        F.sum("z").alias("sz"), F.sum("zz").alias("szz"), F.max("_n").alias("n"),
        F.sum(F.col("_cnt") * F.log("x")).alias("slog"),
        (F.sum(F.col("_cnt") * F.col("x")) / F.sum("_cnt")).alias("xbar")).collect()}

    centers = {c: (lo + hi) / 2.0 for c in cols}
    half = {c: (hi - lo) / 2.0 for c in cols}
    best: dict[str, float] = {}
    score: dict[str, float] = {}
    passes, widened = refinements + 1, 0
    while passes:
        cand = {c: np.linspace(centers[c] - half[c], centers[c] + half[c], grid) for c in cols}
        vals = _grid_pass(table, cand, consts, method)
        for c in cols:
            if not np.isfinite(vals[c]).any():
                raise ValueError(f"no lambda has a score: {c}")
            k = int(np.nanargmax(vals[c]))
            best[c] = float(cand[c][k])
            score[c] = float(vals[c][k])
        # while some best point lies on its grid's edge, look on around it, twice as wide
        edge = {c for c in cols if np.isfinite(score[c])
                and best[c] in (float(cand[c][0]), float(cand[c][-1]))}
        if edge and widened < MAX_WIDENINGS:
            widened += 1
            for c in edge:
                centers[c], half[c] = best[c], 2 * half[c]
            continue
        if edge:
            raise ValueError(f"no best lambda within {widened} widenings: {sorted(edge)}")
        passes -= 1
        for c in cols:
            centers[c], half[c] = best[c], cand[c][1] - cand[c][0]
    return LambdaFit(best, score)


def _grid_task(cand: dict[str, np.ndarray], lgm: dict[str, float], ybar: dict[str, np.ndarray]):
    """``(feature, k, Σwy, Σwy², Σzy)`` of a task's values under each candidate λ."""

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(0).to_numpy(zero_copy_only=False)
            x, w, z = (batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 2, 3))
            for f in set(names) & set(cand):
                at = names == f
                lam = cand[f][:, None]
                zero = np.abs(lam) < 1e-12
                with np.errstate(all="ignore"):
                    t = np.log(x[at]) - lgm[f]
                    y = np.where(zero, t, np.expm1(lam * t) / np.where(zero, 1.0, lam)) - ybar[f][:, None]
                    wy = y * w[at]
                    own = np.stack([wy.sum(axis=1), (wy * y).sum(axis=1), (y * z[at]).sum(axis=1)])
                    total[f] = total[f] + own if f in total else own
        for f, (sy, syy, szy) in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([f] * len(sy)), pa.array(np.arange(len(sy)), pa.int32()), pa.array(sy), pa.array(syy),
                 pa.array(szy)], names=["feature", "k", "sy", "syy", "szy"])

    return run


def _grid_pass(table: DataFrame, cand: dict[str, np.ndarray], consts, method) -> dict:
    """Score every candidate λ of every column in one aggregation.

    Tasks evaluate all candidates of a batch of distinct values as a matrix and pass on their sums,
    a row per ``(feature, k)``.
    """
    feats = list(cand)
    g = len(next(iter(cand.values())))
    # values count relative to their geometric mean, in logarithms: x^lam = gm^lam u^lam, so
    # correlations stay, a variance gains a known factor, and large x or lam don't overflow
    lgm = {f: float(consts[f]["slog"]) / float(consts[f]["n"]) for f in feats}

    def centre(f: str, lam: float) -> float:
        t = np.log(float(consts[f]["xbar"])) - lgm[f]
        value = t if abs(lam) < 1e-12 else float(np.expm1(min(lam * t, 700.0)) / lam)
        return float(value)
    # the centring term is per candidate, not per row: computed here once
    ybar = {f: np.array([centre(f, float(lam)) for lam in cand[f]]) for f in feats}
    sums = (table.select("feature", "x", F.col("_cnt").cast("double").alias("w"), "z")
            .mapInArrow(_grid_task(cand, lgm, ybar), "feature string, k int, sy double, syy double, szy double")
            .groupBy("feature", "k")
            .agg(F.sum("sy").alias("sy"), F.sum("syy").alias("syy"), F.sum("szy").alias("szy")))
    got = {(r["feature"], r["k"]): r for r in sums.collect()}
    rows = {f: {f"{name}{k}": got[(f, k)][name] for k in range(g) for name in ("sy", "syy", "szy")}
            for f in feats}
    out = {}
    for f in feats:
        r, c = rows[f], consts[f]
        n = float(c["n"])
        vals = np.full(g, np.nan)
        for k in range(g):
            sy, syy = r[f"sy{k}"], r[f"syy{k}"]
            var = syy / n - (sy / n) ** 2
            if method == "mle":
                if 0 < var < np.inf:
                    vals[k] = (cand[f][k] - 1) * c["slog"] - n / 2 * (2 * cand[f][k] * lgm[f] + np.log(var))
            else:
                szy, sz = r[f"szy{k}"], c["sz"]
                szz = c["szz"]
                cov = szy / n - (sz / n) * (sy / n)
                varz = szz / n - (sz / n) ** 2
                if 0 < var < np.inf and varz > 0:
                    vals[k] = cov / np.sqrt(var * varz)
        out[f] = vals
    return out


@dataclass
class SkewFixModel:
    """Columns selected for Box-Cox and their λ."""
    lambdas: dict[str, float]
    skew_before: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: boxcox1p(c, lam) for c, lam in self.lambdas.items()})

    def report(self, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        """``(feature, skew_before, skew_after, lambda)`` for ``columns`` (one job)."""
        after = {r["feature"]: r["skew"] for r in skew_report(self.transform(df), columns).collect()}
        rows = [(c, self.skew_before.get(c), after.get(c), self.lambdas.get(c)) for c in columns]
        return df.sparkSession.createDataFrame(
            rows, "feature string, skew_before double, skew_after double, lambda double")


def select_skewed(df: DataFrame, columns: Sequence[str], threshold: float = 0.5
                  ) -> tuple[list[str], dict[str, float]]:
    """Columns whose skewness exceeds ``threshold`` (positive only), and every column's skewness."""
    rep = {r["feature"]: r["skew"] for r in skew_report(df, columns).collect()}
    return [c for c in columns if rep.get(c) is not None and rep[c] > threshold], rep


def fit_skew_fix(df: DataFrame, columns: Sequence[str], threshold: float = 0.5,
                 method: str = "pearsonr") -> SkewFixModel:
    """Select columns with skewness > ``threshold`` (positive only) and fit λ on ``x + 1``."""
    chosen, rep = select_skewed(df, columns, threshold)
    fit = fit_lambdas(df, chosen, method=method, shift=1.0)
    return SkewFixModel(fit.lambdas, rep)
