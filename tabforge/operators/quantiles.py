"""Exact quantiles and ranks without collecting a group into one task.

``percentile`` / ``median`` keep a value -> count map per group inside one
aggregation buffer, and a window ordered inside a group sends the whole group
to one task.  Both break when one group holds a third of the rows.  Here:

1. ``groupBy(group, value).count()`` pre-aggregates map-side;
2. ``repartitionByRange(group, value)`` spreads even a single hot group over
   many partitions, in value order;
3. a window per *(partition, group)* gives running counts inside a partition
   (each window group is at most one range partition);
4. per-(partition, group) totals, at most ``#groups + #partitions`` rows,
   give each partition's offset inside its group (the range-partitioned table is
   checkpointed first, so both uses read identical partitions);
5. every distinct value then knows ``before`` (rows of its group with a
   smaller value) and ``n`` (rows of the group).

A quantile at ``p`` is read off as the values at ranks ``floor(p(n-1))`` and
``ceil(p(n-1))`` and interpolated linearly, which is what pandas, numpy and
DuckDB's ``quantile_cont`` compute.  The last step is one more aggregation,
again map-side combined.  Only weighted quantiles and ranks need this: unweighted ones come from
``brackets`` (whole columns) and ``group_brackets`` (groups), which sort no hot group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.functions.nullsafe import qcol
from tabforge.operators.brackets import quantile_values
from tabforge.operators.group_brackets import group_quantiles
from tabforge.session import checkpoint

_CNT, _BEFORE, _N, _PID = "_cnt", "_before", "_n", "_pid"


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8"))


def value_ranks(df: DataFrame, value: str, by: Sequence[str] = (),
                weight: str | None = None) -> DataFrame:
    """Distinct ``(by..., value)`` with ``_cnt``, ``_before`` and group size ``_n``.

    NULL values are ignored (they have no rank); NULL group keys form a group.
    ``weight`` names an integer multiplicity column (rows already counted);
    rows with weight 0 are ignored.
    """
    by = list(by)
    mult = F.lit(1) if weight is None else qcol(weight).cast("long")
    counts = (df.select(*[qcol(b) for b in by], qcol(value), mult.alias("_w"))
              .where(qcol(value).isNotNull() & (F.col("_w") > 0))
              .groupBy(*[qcol(b) for b in by], qcol(value)).agg(F.sum("_w").alias(_CNT)))
    # Both branches below (running counts, per-partition totals) must see the same
    # range partitioning; range bounds come from sampling, so a recomputed exchange
    # could pick other bounds.  The distinct-value table is materialised once.
    ranged = checkpoint(counts.repartitionByRange(_partitions(df), *[qcol(b) for b in by], qcol(value))
                        .withColumn(_PID, F.spark_partition_id()))
    w_local = (Window.partitionBy(F.col(_PID), *[qcol(b) for b in by]).orderBy(qcol(value))
               .rowsBetween(Window.unboundedPreceding, -1))
    local = ranged.withColumn("_lb", F.coalesce(F.sum(_CNT).over(w_local), F.lit(0)))
    totals = ranged.groupBy(F.col(_PID), *[qcol(b) for b in by]).agg(F.sum(_CNT).alias("_t"))
    w_off = Window.partitionBy(*[qcol(b) for b in by]).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    w_grp = Window.partitionBy(*[qcol(b) for b in by])
    offsets = totals.select(
        F.col(_PID).alias("_pid_o"), *[qcol(b).alias(f"_o_{i}") for i, b in enumerate(by)],
        F.coalesce(F.sum("_t").over(w_off), F.lit(0)).alias("_off"),
        F.sum("_t").over(w_grp).alias(_N))
    cond = local[_PID] == offsets["_pid_o"]
    for i, b in enumerate(by):
        cond = cond & local[b].eqNullSafe(offsets[f"_o_{i}"])
    joined = local.join(offsets, cond, "inner")
    return joined.select(*[local[b] for b in by], local[value], F.col(_CNT),
                         (F.col("_lb") + F.col("_off")).alias(_BEFORE), F.col(_N))


def _rank_value(ranks: DataFrame, value: str, rank: F.Column) -> F.Column:
    covers = (F.col(_BEFORE) <= rank) & (rank < F.col(_BEFORE) + F.col(_CNT))
    return F.max(F.when(covers, qcol(value).cast("double")))


def quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str] = (),
              names: Sequence[str] | None = None, approx: int | None = None,
              weight: str | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles of ``value`` per group (or globally).

    Returns ``by...`` plus one double column per probability, named by
    ``names`` (default ``q_<index>``).  Groups whose values are all NULL are
    absent from the result.  ``approx=<accuracy>`` opts into
    ``percentile_approx`` (a bounded sketch per group, rank error about
    ``n / accuracy``, no interpolation) when exact values are not needed.
    """
    by = list(by)
    names = list(names) if names else [f"q_{i}" for i in range(len(probs))]
    if approx:
        q = F.percentile_approx(qcol(value).cast("double"), [float(p) for p in probs], int(approx))
        per = df.groupBy(*[qcol(b) for b in by]).agg(q.alias("_q"))
        return per.select(*[qcol(b) for b in by],
                          *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    if not by and weight is None:
        got = quantile_values(df, {value: qcol(value)}, probs)
        return df.sparkSession.createDataFrame(
            [tuple(map(float, v)) for v in got.values()], ", ".join(f"`{n}` double" for n in names))
    if weight is None:
        return group_quantiles(df, value, probs, by, names)
    ranks = value_ranks(df, value, by, weight)
    n1 = (F.col(_N) - 1).cast("double")
    aggs = []
    for i, p in enumerate(probs):
        pos = n1 * F.lit(float(p))
        aggs.append(_rank_value(ranks, value, F.floor(pos)).alias(f"_lo{i}"))
        aggs.append(_rank_value(ranks, value, F.ceil(pos)).alias(f"_hi{i}"))
    aggs.append(F.max(_N).alias(_N))
    per = ranks.groupBy(*[qcol(b) for b in by]).agg(*aggs)
    outs = []
    for i, p in enumerate(probs):
        pos = (F.col(_N) - 1).cast("double") * F.lit(float(p))
        frac = pos - F.floor(pos)
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        outs.append((lo + frac * (hi - lo)).alias(names[i]))
    return per.select(*[qcol(b) for b in by], *outs)


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                     names: Sequence[str] | None = None) -> DataFrame:
    """Exact quantiles of many numeric columns: ``(feature, q...)`` rows, columns without values
    left out.  Brackets are narrowed for all columns together (``brackets``)."""
    names = list(names) if names else [f"q_{i}" for i in range(len(probs))]
    got = quantile_values(df, {c: qcol(c) for c in columns}, probs)
    return df.sparkSession.createDataFrame(
        [(c, *map(float, v)) for c, v in got.items()],
        "feature string, " + ", ".join(f"`{n}` double" for n in names))


def unpivot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(feature, value double)`` long form of numeric columns."""
    pairs = [F.struct(F.lit(c).alias("feature"), qcol(c).cast("double").alias("value"))
             for c in columns]
    return df.select(F.explode(F.array(*pairs)).alias("_kv")).select("_kv.feature", "_kv.value")
