"""Exact quantiles per group without gathering a hot group in one task.

Row counts per group divide the groups in two:

* groups of at most ``LIST_ROWS`` rows, or a ``MAX_HOT``-th of all rows where that is more, are
  finished by counting their values: counts combine before the shuffle, and the running count of
  a group is a window over a bounded number of values;
* the others are fewer than ``MAX_HOT``, whatever the data, so their brackets are broadcast and
  their rows are not shuffled.  As in ``brackets``, every wanted rank has a bracket of values with
  its exact number of rows; a mergeable sketch per group proposes a narrower one, exact counts
  below and inside it decide, and a bracket of at most ``LIST_ROWS`` rows is finished by counting
  its values.  A round leaves about a hundredth of a bracket, so 10^12 rows take four.

The driver sees row counts only; brackets stay in a table with a row per hot group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.functions.nullsafe import qcol
from tabforge.operators.brackets import ACCURACY, LIST_ROWS
from tabforge.session import checkpoint

#: Groups that can be hot at once, a bound of the broadcast table.
MAX_HOT = 100_000
#: Steps of the sketched values proposed in a round.
GRID = 200


def group_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str],
                    names: Sequence[str], list_rows: int = LIST_ROWS,
                    max_hot: int = MAX_HOT) -> DataFrame:
    """``by...`` and a double column per probability, linearly interpolated.

    NULL and NaN values have no rank; a NULL key is a group; a group without values is absent.
    ``df`` is read a few times, so give it a table or a checkpoint rather than a long plan.
    """
    keys = [f"_g{i}" for i in range(len(by))]
    rows = (df.select(*[qcol(b).alias(k) for b, k in zip(by, keys)],
                      qcol(value).cast("double").alias("_x"))
            .where(F.col("_x").isNotNull() & ~F.isnan("_x")))
    sizes = checkpoint(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                               F.min("_x").alias("_lo"), F.max("_x").alias("_hi")))
    total = sizes.agg(F.sum("_n")).first()[0] or 0
    hot = sizes.where(F.col("_n") > max(list_rows, total // max_hot))
    if hot.isEmpty():
        found = _by_counts(rows, keys, probs)
    else:
        cold = rows.join(F.broadcast(_other_keys(hot.select(*keys), keys)), _same(keys), "left_anti")
        found = _by_counts(cold, keys, probs).unionByName(
            _by_brackets(rows, hot, keys, probs, list_rows))
    return found.select(*[F.col(k).alias(b) for k, b in zip(keys, by)],
                        *[_between(i, p).alias(n) for i, (p, n) in enumerate(zip(probs, names))])


def _ranks(probs: Sequence[float]) -> list[Column]:
    """The two ranks that each probability lies between, from the group's rows ``_n``."""
    at = [(F.col("_n") - 1).cast("double") * F.lit(float(p)) for p in probs]
    return [f(a) for a in at for f in (F.floor, F.ceil)]


def _between(i: int, p: float) -> Column:
    at = (F.col("_n") - 1).cast("double") * F.lit(float(p))
    low, high = F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}")
    return F.when(low == high, low).otherwise(low + (at - F.floor(at)) * (high - low))


def _other_keys(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    return table.withColumnsRenamed({k: f"{k}_" for k in keys})


def _same(keys: Sequence[str]) -> Column:
    """Rows and a table of ``_other_keys`` of one group, NULL keys included."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys])


def _by_counts(rows: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    group = Window.partitionBy(*keys)
    before = group.orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    counts = (rows.groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_c"))
              .withColumn("_before", F.coalesce(F.sum("_c").over(before), F.lit(0)))
              .withColumn("_n", F.sum("_c").over(group)))
    return counts.groupBy(*keys).agg(F.max("_n").alias("_n"), *[
        F.max(F.when((F.col("_before") <= r) & (r < F.col("_before") + F.col("_c")), F.col("_x")))
        .alias(f"_v{j}") for j, r in enumerate(_ranks(probs))])


def _by_brackets(rows: DataFrame, hot: DataFrame, keys: list[str], probs: Sequence[float],
                 list_rows: int) -> DataFrame:
    targets = range(2 * len(probs))
    state = checkpoint(_other_keys(hot, keys).select(
        *[f"{k}_" for k in keys], "_n",
        *[c for j, r in enumerate(_ranks(probs))
          for c in (r.alias(f"r{j}"), F.col("_lo").alias(f"lo{j}"), F.col("_hi").alias(f"hi{j}"),
                    F.col("_n").alias(f"in{j}"))]))

    def wide(j: int) -> Column:
        return (F.col(f"in{j}") > list_rows) & (F.col(f"lo{j}") < F.col(f"hi{j}"))

    while not state.where(reduce(lambda a, b: a | b, [wide(j) for j in targets])).isEmpty():
        state = checkpoint(_narrowed(rows, _proposed(rows, state, keys, targets, wide), keys, targets))
    return _listed(rows, state, keys, targets)


def _proposed(rows: DataFrame, state: DataFrame, keys, targets, wide) -> DataFrame:
    """``state`` with a narrower bracket ``plo .. phi`` per wide target, others as they are."""
    steps = [i / GRID for i in range(GRID + 1)]
    x = F.col("_x")
    near = rows.join(F.broadcast(state), _same(keys))
    sketch = near.groupBy(*keys).agg(*[
        F.percentile_approx(F.when(wide(j) & x.between(F.col(f"lo{j}"), F.col(f"hi{j}")), x),
                            steps, ACCURACY).alias(f"s{j}") for j in targets])

    def ends(j: int) -> list[Column]:
        at = F.col(f"r{j}") / (F.col(f"in{j}") - 1) * GRID
        low, mid, high = [F.get(F.col(f"s{j}"), i.cast("int")) for i in (
            F.greatest(F.floor(at - 0.5), F.lit(0)), F.round(at),
            F.least(F.ceil(at + 0.5), F.lit(GRID)))]
        # two frequent values at the ends would not narrow it: cut out one value
        stuck = (low == F.col(f"lo{j}")) & (high == F.col(f"hi{j}"))
        return [F.when(~wide(j), F.col(f"{own}{j}")).when(stuck, mid).otherwise(end).alias(f"p{own}{j}")
                for own, end in (("lo", low), ("hi", high))]

    return (sketch.join(state, _same(keys))
            .select(*state.columns, *[c for j in targets for c in ends(j)]))


def _narrowed(rows: DataFrame, state: DataFrame, keys, targets) -> DataFrame:
    """Exact counts below and inside the proposals; every rank goes to the part that holds it."""
    state = checkpoint(state)
    x, aggs = F.col("_x"), []
    for j in targets:
        lo, hi, plo, phi = (F.col(f"{c}{j}") for c in ("lo", "hi", "plo", "phi"))
        left, mid, right = (x >= lo) & (x < plo), x.between(plo, phi), (x > phi) & (x <= hi)
        aggs += [F.count_if(left).alias(f"l{j}"), F.count_if(mid).alias(f"m{j}"),
                 F.max(F.when(left, x)).alias(f"la{j}"), F.min(F.when(mid, x)).alias(f"ma{j}"),
                 F.max(F.when(mid, x)).alias(f"mb{j}"), F.min(F.when(right, x)).alias(f"rb{j}")]
    counts = rows.join(F.broadcast(state), _same(keys)).groupBy(*keys).agg(*aggs)

    def part(j: int) -> list[Column]:
        r, n, left, mid = (F.col(f"{c}{j}") for c in ("r", "in", "l", "m"))

        def pick(a, b, c):
            return F.when(r < left, a).when(r < left + mid, b).otherwise(c)
        return [pick(r, r - left, r - left - mid).alias(f"r{j}"),
                pick(F.col(f"lo{j}"), F.col(f"ma{j}"), F.col(f"rb{j}")).alias(f"lo{j}"),
                pick(F.col(f"la{j}"), F.col(f"mb{j}"), F.col(f"hi{j}")).alias(f"hi{j}"),
                pick(left, mid, n - left - mid).alias(f"in{j}")]

    return counts.join(state, _same(keys)).select(
        *[f"{k}_" for k in keys], "_n", *[c for j in targets for c in part(j)])


def _listed(rows: DataFrame, state: DataFrame, keys, targets) -> DataFrame:
    """Values at the ranks: brackets of one value, or the counts of a short bracket's values."""
    x = F.col("_x")
    hits = F.array(*[F.when((F.col(f"lo{j}") < F.col(f"hi{j}"))
                            & x.between(F.col(f"lo{j}"), F.col(f"hi{j}")),
                            F.struct(F.lit(j).alias("j"), F.col(f"r{j}").alias("r"))) for j in targets])
    counts = (rows.join(F.broadcast(state), _same(keys))
              .select(*keys, "_x", F.explode(F.filter(hits, lambda h: h.isNotNull())).alias("h"))
              .groupBy(*keys, "h.j", "h.r", "_x").agg(F.count(F.lit(1)).alias("_c")))
    before = (Window.partitionBy(*keys, "j").orderBy("_x")
              .rowsBetween(Window.unboundedPreceding, -1))
    at = (counts.withColumn("_before", F.coalesce(F.sum("_c").over(before), F.lit(0)))
          .where((F.col("_before") <= F.col("r")) & (F.col("r") < F.col("_before") + F.col("_c")))
          .groupBy(*keys).agg(*[F.max(F.when(F.col("j") == j, x)).alias(f"x{j}") for j in targets]))
    return state.join(at, _same(keys), "left").select(
        *[F.col(f"{k}_").alias(k) for k in keys], "_n",
        *[F.when(F.col(f"lo{j}") == F.col(f"hi{j}"), F.col(f"lo{j}")).otherwise(F.col(f"x{j}"))
          .alias(f"_v{j}") for j in targets])
