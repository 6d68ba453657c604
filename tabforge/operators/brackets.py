"""Exact quantiles of whole columns by narrowing brackets; rows are never shuffled.

A quantile is the value at one or two ranks.  For every rank the operator keeps a bracket of
values that holds it, with the exact number of rows below and inside:

1. one aggregation gives each column's row count, least and largest value and a sketch
   (``percentile_approx``) of values just below and above the wanted ranks;
2. one aggregation counts exactly how many rows lie below and inside each proposed bracket.  A
   rank that the proposal misses goes to the bracket beside it, so a poor sketch costs a pass,
   never a wrong result;
3. brackets of one distinct value are done; those with at most ``LIST_ROWS`` rows are finished
   by counting their values; wider ones are proposed again from a sketch of their rows alone.

Tasks count with numpy in sorted batches: hundreds of conditions in one aggregation are more than
Spark compiles, and cost a row 50 times as much.  A pass shuffles one partial aggregate per task and leaves about a 200th of a bracket, so 10^12
rows take five rounds; a proposal that cannot narrow a bracket cuts out one value instead, so
every pass makes progress.  The driver holds a few numbers per column and probability.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Accuracy of the sketches: rank errors stay below rows / ACCURACY.
ACCURACY = 1_000
#: Rows of a bracket whose values are counted one by one.
LIST_ROWS = 50_000
#: Columns handled in one aggregation.
BATCH = 48


@dataclass
class _Bracket:
    """Values ``lo .. hi`` of a column, ``below`` smaller rows and ``inside`` rows in it."""
    column: str
    lo: float
    hi: float
    below: int
    inside: int


def _value(columns: Mapping[str, Column], name: str) -> Column:
    x = columns[name].cast("double")
    return F.when(~F.isnan(x), x)


def _around(at: float) -> list[float]:
    """Percentages just below ``at``, at it and just above."""
    pad = 2.0 / ACCURACY
    return [max(0.0, at - pad), at, min(1.0, at + pad)]


def quantile_values(df: DataFrame, columns: Mapping[str, Column], probs: Sequence[float]
                    ) -> dict[str, list[float]]:
    """``{name: [quantile per probability]}`` by linear interpolation, exact.

    NULL and NaN have no rank; a column without values is absent from the result.  ``df`` is read
    two or three times, so give it a table or a checkpoint rather than a long plan.
    """
    names = list(columns)
    out: dict[str, list[float]] = {}
    for start in range(0, len(names), BATCH):
        out |= _batch(df, {n: columns[n] for n in names[start:start + BATCH]}, list(probs))
    return out


def _batch(df: DataFrame, columns: Mapping[str, Column], probs: list[float]) -> dict[str, list[float]]:
    names, pos = list(columns), {n: i for i, n in enumerate(columns)}
    rows = df.select(*[_value(columns, n).alias(f"x{i}") for i, n in enumerate(names)])
    asked = [q for p in probs for q in _around(float(p))[::2]]
    aggs = []
    for i in range(len(names)):
        x = F.col(f"x{i}")
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
                 F.percentile_approx(x, asked, ACCURACY).alias(f"s{i}")]
    first = rows.agg(*aggs).first()

    ranks: dict[str, list[tuple[int, int, float]]] = {}
    todo: dict[tuple[str, int], _Bracket] = {}        # (column, rank) -> bracket that holds it
    proposals: dict[tuple[str, int], tuple[float, float]] = {}
    for i, name in enumerate(names):
        n = first[f"n{i}"]
        if not n:
            continue
        whole = _Bracket(name, first[f"lo{i}"], first[f"hi{i}"], 0, n)
        ranks[name] = []
        for k, p in enumerate(probs):
            at = (n - 1) * float(p)
            low, high = math.floor(at), math.ceil(at)
            ranks[name].append((low, high, at - low))
            for r in (low, high):
                todo[name, r] = whole
                proposals[name, r] = tuple(first[f"s{i}"][2 * k:2 * k + 2])

    found: dict[tuple[str, int], float] = {}
    while todo:
        todo = _count(rows, pos, todo, proposals)
        for key, b in list(todo.items()):
            if b.lo == b.hi:
                found[key] = b.lo
                del todo[key]
        short = {k: b for k, b in todo.items() if b.inside <= LIST_ROWS}
        found |= _list(rows, pos, short)
        todo = {k: b for k, b in todo.items() if k not in short}
        proposals = _propose(rows, pos, todo)
    return {name: [found[name, lo] + f * (found[name, hi] - found[name, lo]) for lo, hi, f in rs]
            for name, rs in ranks.items()}


def _sorted_columns(batch, used: list[int]):
    """``(k, {column: sorted values})`` per fold of a batch, NULLs left out."""
    fold = batch.column(0).to_numpy(zero_copy_only=False)
    values = [batch.column(1 + c).to_numpy(zero_copy_only=False) for c in range(len(used))]
    for k in np.unique(fold).tolist():
        own = fold == k
        out = {}
        for i, v in zip(used, values, strict=True):
            x = v[own]
            out[i] = np.sort(x[~np.isnan(x)])
        yield k, out


def _span_task(spans: list[tuple], used: list[int]):
    """Of a task's rows per fold and span ``(column, a, b, lo, hi)``: rows left of, in and right of
    ``lo .. hi``, the ends inside and the values beside it."""

    def run(batches):
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for k, columns in _sorted_columns(batch, used):
                if k not in found:
                    found[k] = (np.zeros((3, len(spans)), np.int64),
                                np.array([[np.inf], [-np.inf], [-np.inf], [np.inf]]) * np.ones(len(spans)))
                n, ends = found[k]
                for i in used:
                    x = columns[i]
                    at = [j for j, s in enumerate(spans) if s[0] == i]
                    a, b, lo, hi = (np.array([spans[j][c] for j in at]) for c in range(1, 5))
                    ia, il = np.searchsorted(x, a), np.searchsorted(x, lo)
                    ih, ib = np.searchsorted(x, hi, "right"), np.searchsorted(x, b, "right")
                    for row, (low, high) in enumerate(((ia, il), (il, ih), (ih, ib))):
                        n[row, at] += np.maximum(high - low, 0)
                    for row, (has, place, best) in enumerate((
                            (ih > il, il, np.minimum), (ih > il, ih - 1, np.maximum),
                            (il > ia, il - 1, np.maximum), (ib > ih, ih, np.minimum))):
                        to = np.array(at)[has]
                        ends[row, to] = best(ends[row, to], x[place[has]])
        for k, (n, ends) in found.items():
            none = np.stack([n[1], n[1], n[0], n[2]]) == 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(spans), k, np.int64)), pa.array(np.arange(len(spans))),
                 *map(pa.array, n), *[pa.array(e, mask=m) for e, m in zip(ends, none, strict=True)]],
                names=["k", "j", "l", "m", "r", "lo", "hi", "la", "rb"])

    return run


def _span_counts(rows: DataFrame, spans: list[tuple], fold: Column):
    """A row per fold and span, whose expressions would be too many for one aggregation's code."""
    used = sorted({s[0] for s in spans})
    return (rows.select(fold.cast("long").alias("k"), *[F.col(f"x{i}") for i in used])
            .mapInArrow(_span_task(spans, used), "k long, j long, l long, m long, r long, lo double, "
                                                 "hi double, la double, rb double")
            .groupBy("k", "j").agg(F.sum("l").alias("l"), F.sum("m").alias("m"), F.sum("r").alias("r"),
                                   F.min("lo").alias("lo"), F.max("hi").alias("hi"),
                                   F.max("la").alias("la"), F.min("rb").alias("rb")).collect())


def _list_task(spans: list[tuple], used: list[int]):
    """``(k, j, x, n)``: counts of the distinct values of a batch in each span ``(column, lo, hi)``."""

    def run(batches):
        for batch in batches:
            for k, columns in _sorted_columns(batch, used):
                for j, (i, lo, hi) in enumerate(spans):
                    x = columns[i]
                    x, n = np.unique(x[np.searchsorted(x, lo):np.searchsorted(x, hi, "right")],
                                     return_counts=True)
                    if len(x):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(x), k, np.int64)), pa.array(np.full(len(x), j, np.int64)),
                             pa.array(x), pa.array(n)], names=["k", "j", "x", "n"])

    return run


def _value_counts(rows: DataFrame, spans: list[tuple], fold: Column):
    used = sorted({s[0] for s in spans})
    return (rows.select(fold.cast("long").alias("k"), *[F.col(f"x{i}") for i in used])
            .mapInArrow(_list_task(spans, used), "k long, j long, x double, n long")
            .groupBy("k", "j", "x").agg(F.sum("n").alias("n")).collect())


def _count(rows: DataFrame, pos: Mapping[str, int], todo, proposals):
    """Count below and inside the proposed brackets and place every rank in the part holding it."""
    spans = sorted({(k[0], todo[k].lo, todo[k].hi, *proposals[k]) for k in todo})
    got = {r["j"]: r for r in _span_counts(rows, [(pos[s[0]], *s[1:]) for s in spans], F.lit(0))}
    out = {}
    for key, b in todo.items():
        span = got[spans.index((key[0], b.lo, b.hi, *proposals[key]))]
        left, mid = span["l"], span["m"]
        r = key[1] - b.below
        if r < left:
            out[key] = _Bracket(b.column, b.lo, span["la"], b.below, left)
        elif r < left + mid:
            out[key] = _Bracket(b.column, span["lo"], span["hi"], b.below + left, mid)
        else:
            out[key] = _Bracket(b.column, span["rb"], b.hi, b.below + left + mid,
                                b.inside - left - mid)
    return out


def _propose(rows: DataFrame, pos: Mapping[str, int], todo) -> dict:
    if not todo:
        return {}
    keys = list(todo)
    aggs = []
    for j, key in enumerate(keys):
        b, x = todo[key], F.col(f"x{pos[key[0]]}")
        aggs.append(F.percentile_approx(F.when((x >= b.lo) & (x <= b.hi), x),
                                        _around((key[1] - b.below) / (b.inside - 1)),
                                        ACCURACY).alias(f"s{j}"))
    got = rows.agg(*aggs).first()
    out = {}
    for j, key in enumerate(keys):
        low, mid, high = got[f"s{j}"]
        # a proposal as wide as the bracket (two frequent values) would not narrow it: cut out one value
        whole = (low, high) == (todo[key].lo, todo[key].hi)
        out[key] = (mid, mid) if whole else (low, high)
    return out


def _list(rows: DataFrame, pos: Mapping[str, int], todo) -> dict[tuple[str, int], float]:
    """Values at the ranks of short brackets, from the counts of their distinct values."""
    if not todo:
        return {}
    spans = sorted({(k[0], b.lo, b.hi, b.below) for k, b in todo.items()})
    counts = _value_counts(rows, [(pos[n], lo, hi) for n, lo, hi, _ in spans], F.lit(0))
    values: dict[int, list[tuple[float, int]]] = {j: [] for j in range(len(spans))}
    for r in counts:
        values[r["j"]].append((r["x"], r["n"]))
    found = {}
    for key, b in todo.items():
        seen = b.below
        for x, n in sorted(values[spans.index((key[0], b.lo, b.hi, b.below))]):
            seen += n
            if key[1] < seen:
                found[key] = x
                break
    return found


# ----------------------------------------------------------------------------- fold complements

#: Steps of the sketched values proposed for the complements of folds.
GRID = 200
#: Brackets sketched in one aggregation.
SPANS = 120


@dataclass
class _Part(_Bracket):
    """A bracket in the complement of a fold; ``rows`` counts those of all folds in it."""
    rows: int = 0


def complement_values(df: DataFrame, columns: Mapping[str, Column], fold: Column, n_folds: int,
                      probs: Sequence[float]) -> dict[tuple[str, int], list[float]]:
    """``{(name, fold): [quantile per probability]}`` of all rows outside each fold, exact.

    Every bracket is counted per fold in one pass; the counts of a complement are those of all
    rows less the fold's own, so no row is copied or shuffled.  Rows without a fold, or of another
    number, belong to every complement.  A complement without values is absent.  The driver holds a
    bracket per column, fold and rank and at most about ``LIST_ROWS`` counted values at once.
    """
    names = list(columns)
    out: dict[tuple[str, int], list[float]] = {}
    for start in range(0, len(names), BATCH):
        part = {n: columns[n] for n in names[start:start + BATCH]}
        out |= _complements(df, part, fold, n_folds, list(probs))
    return out


def _complements(df, columns, fold, n_folds, probs):
    names, pos = list(columns), {n: i for i, n in enumerate(columns)}
    # a row without a fold is of one that is no complement's
    rows = df.select(F.coalesce(fold.cast("int"), F.lit(-1)).alias("k"),
                     *[_value(columns, n).alias(f"x{i}") for i, n in enumerate(names)])
    cols = [(i, F.col(f"x{i}")) for i in range(len(names))]
    sizes = {r["k"]: r for r in rows.groupBy("k").agg(
        *[F.count(x).alias(f"n{i}") for i, x in cols]).collect()}         # a row per fold
    asked = [q for p in probs for q in _around(float(p))[::2]]
    first = rows.agg(*[a for i, x in cols for a in (
        F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"),
        F.percentile_approx(x, asked, ACCURACY).alias(f"s{i}"))]).first()

    ranks, todo, proposals = {}, {}, {}
    for i, name in enumerate(names):
        total = sum(r[f"n{i}"] for r in sizes.values())
        for k in range(n_folds):
            n = total - (sizes[k][f"n{i}"] if k in sizes else 0)
            if not n:
                continue
            ranks[name, k] = []
            for p_at, p in enumerate(probs):
                at = (n - 1) * float(p)
                low, high = math.floor(at), math.ceil(at)
                ranks[name, k].append((low, high, at - low))
                for r in (low, high):
                    todo[name, k, r] = _Part(name, first[f"lo{i}"], first[f"hi{i}"], 0, n, total)
                    proposals[name, k, r] = tuple(first[f"s{i}"][2 * p_at:2 * p_at + 2])

    found: dict[tuple[str, int, int], float] = {}
    while todo:
        todo = _count_folds(rows, pos, todo, proposals)
        found |= {key: b.lo for key, b in todo.items() if b.lo == b.hi}
        todo = {key: b for key, b in todo.items() if b.lo != b.hi}
        # the lists of all brackets together stay within LIST_ROWS
        most = max(1, LIST_ROWS // max(1, len({(b.column, b.lo, b.hi) for b in todo.values()})))
        short = {key: b for key, b in todo.items() if b.rows <= most}
        found |= _list_folds(rows, pos, short)
        todo = {key: b for key, b in todo.items() if key not in short}
        proposals = _propose_grid(rows, pos, todo)
    return {(name, k): [found[name, k, lo] + (f * (found[name, k, hi] - found[name, k, lo]) if f else 0.0)
                        for lo, hi, f in rs] for (name, k), rs in ranks.items()}


def _count_folds(rows: DataFrame, pos: Mapping[str, int], todo, proposals):
    spans = sorted({(key[0], b.lo, b.hi, *proposals[key]) for key, b in todo.items()})
    counts = {span: ({}, [0, 0, 0], [None] * 4) for span in spans}
    for g in _span_counts(rows, [(pos[s[0]], *s[1:]) for s in spans], F.col("k")):    # a row per fold
        own, whole, ends = counts[spans[g["j"]]]
        own[g["k"]] = g["l"], g["m"], g["r"]
        for i, c in enumerate(("l", "m", "r")):
            whole[i] += g[c]
        for i, (c, end) in enumerate((("la", max), ("lo", min), ("hi", max), ("rb", min))):
            ends[i] = end((v for v in (ends[i], g[c]) if v is not None), default=None)
    out = {}
    for key, b in todo.items():
        own, whole, (la, mlo, mhi, rb) = counts[key[0], b.lo, b.hi, *proposals[key]]
        left, mid, right = (w - o for w, o in zip(whole, own.get(key[1], (0, 0, 0))))
        r = key[2] - b.below
        if r < left:
            out[key] = _Part(b.column, b.lo, la, b.below, left, whole[0])
        elif r < left + mid:
            out[key] = _Part(b.column, mlo, mhi, b.below + left, mid, whole[1])
        else:
            out[key] = _Part(b.column, rb, b.hi, b.below + left + mid, right, whole[2])
    return out


def _propose_grid(rows: DataFrame, pos: Mapping[str, int], todo) -> dict:
    """A narrower bracket for each rank, from one sketch per bracket over the rows of all folds;
    where a fold lies unevenly the proposal may miss, which the next count sets right."""
    steps = [i / GRID for i in range(GRID + 1)]
    spans = sorted({(key[0], b.lo, b.hi) for key, b in todo.items()})
    sketch = {}
    for start in range(0, len(spans), SPANS):
        chunk, aggs = spans[start:start + SPANS], []
        for j, (name, lo, hi) in enumerate(chunk):
            x = F.col(f"x{pos[name]}")
            aggs.append(F.percentile_approx(F.when((x >= lo) & (x <= hi), x), steps, ACCURACY).alias(f"s{j}"))
        got = rows.agg(*aggs).first()
        sketch |= {span: got[f"s{j}"] for j, span in enumerate(chunk)}
    out = {}
    for key, b in todo.items():
        s = sketch[key[0], b.lo, b.hi]
        at = (key[2] - b.below) / max(1, b.inside - 1) * GRID
        low, high = s[max(0, math.floor(at - 0.5))], s[min(GRID, math.ceil(at + 0.5))]
        mid = s[round(at)]
        out[key] = (mid, mid) if (low, high) == (b.lo, b.hi) else (low, high)
    return out


def _list_folds(rows: DataFrame, pos: Mapping[str, int], todo) -> dict:
    if not todo:
        return {}
    spans = sorted({(b.column, b.lo, b.hi) for b in todo.values()})
    values: dict[tuple, dict[float, dict]] = {span: {} for span in spans}
    for r in _value_counts(rows, [(pos[n], lo, hi) for n, lo, hi in spans], F.col("k")):
        values[spans[r["j"]]].setdefault(r["x"], {})[r["k"]] = r["n"]
    ordered = {span: sorted((x, sum(by.values()), by) for x, by in seen.items())
               for span, seen in values.items()}
    found = {}
    for key, b in todo.items():
        seen = b.below
        for x, n, by in ordered[b.column, b.lo, b.hi]:
            seen += n - by.get(key[1], 0)
            if key[2] < seen:
                found[key] = x
                break
    return found
