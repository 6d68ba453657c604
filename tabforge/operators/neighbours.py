"""Nearest donors of queries, without rows per pair.

Queries and donors are vectors that may miss values; their distance is the mean squared difference
over the features that both have (no such feature: no neighbours).  Donors lie in *cells*; a step of
the comparison takes one cell's donors and a slice of the queries that visit it, keeps each query's
``k`` best in numpy and emits only those.

* **exact**: donors go to the cell of their nearest pivot (a hashed sample of the donors), and each
  cell knows its box, the range of every feature.  A query first visits the cell whose box is
  nearest, which bounds its k-th distance; then it visits just the cells whose box is not farther
  than that.  A cell holds about ``cell_rows`` donors, whatever their number.
* **approximate** (``tables`` > 0): cells are the buckets of random-projection hash tables over the
  features that no row misses.  Queries that found fewer than ``k`` donors visit all cells of the
  exact search after all, so no answer is left out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.operators.joins import BROADCAST_MAX_ROWS, attach_counted
from tabforge.session import checkpoint

#: Donors of a cell and queries of a slice that one step compares.
CELL_ROWS, SLICE_ROWS = 16_384, 8_192
#: Distances computed at once.
CHUNK = 1 << 21
#: Rows from which the hash tables' bucket width is estimated, and projections per table.
SAMPLE_ROWS, PROJECTIONS = 2_000, 4


def distances(q: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Mean squared differences over co-observed features (NaN: missing), infinite without any."""
    total, count = np.zeros((len(q), len(d))), np.zeros((len(q), len(d)), np.int32)
    for f in range(q.shape[1]):
        diff = q[:, f, None] - d[None, :, f]
        ok = ~np.isnan(diff)
        total += np.where(ok, diff * diff, 0.0)
        count += ok
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(count > 0, total / count, np.inf)


def best_of(q: np.ndarray, d: np.ndarray, size: np.ndarray, keys: np.ndarray, k: int):
    """``(query, distance, donor)`` of the ``k`` best of each query by distance and key; ``size``
    donors stand behind each vector of ``d``, in order, with ranks ``keys``."""
    first = np.cumsum(size) - size
    out = []
    step = max(1, CHUNK // max(1, len(d)))
    for lo in range(0, len(q), step):
        dist = distances(q[lo:lo + step], d)
        kth = min(k, len(d)) - 1
        near = (dist <= np.partition(dist, kth, axis=1)[:, kth:kth + 1]) & np.isfinite(dist)
        of, at = np.nonzero(near)
        n = size[at]
        donor = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[at], n)
        of, far = np.repeat(of, n), np.repeat(dist[of, at], n)
        order = np.lexsort((keys[donor], far, of))
        of, far, donor = of[order], far[order], donor[order]
        start = np.searchsorted(of, of)
        keep = np.arange(len(of)) - start < k
        out.append((of[keep] + lo, far[keep], donor[keep]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _matrix(column, d: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)


def _compare(d: int, k: int, out_schema: pa.Schema):
    def run(queries: pa.Table, donors: pa.Table) -> pa.Table:
        if not queries.num_rows or not donors.num_rows:
            return out_schema.empty_table()
        held = donors["donors"].combine_chunks()
        size = pa.compute.list_value_length(held).to_numpy(zero_copy_only=False)
        key, value = (held.flatten().field(i) for i in range(2))
        rank = np.unique(key.to_numpy(zero_copy_only=False), return_inverse=True)[1]
        of, far, donor = best_of(_matrix(queries["x"], d), _matrix(donors["x"], d), size, rank, k)
        at = pa.array(donor)
        return pa.table([queries["q"].combine_chunks().take(pa.array(of)), pa.array(far),
                         key.take(at), value.take(at)], schema=out_schema)

    return run


def _visit(visits: DataFrame, donors: DataFrame, d: int, k: int, key_type, slice_rows: int) -> DataFrame:
    """``(q, d, key, v)``, at most ``k`` rows per visit ``(q, x, g, cell)``."""
    from pyspark.sql.pandas.types import to_arrow_type

    counts = visits.groupBy("g", "cell").agg(F.ceil(F.count(F.lit(1)) / slice_rows).cast("int").alias("slices"))
    counts = checkpoint(counts)
    dealt = (attach_counted(visits, counts, ["g", "cell"], "inner")
             .withColumn("slice", F.pmod(F.xxhash64("q"), F.col("slices")).cast("int")))
    copies = (attach_counted(donors, counts, ["g", "cell"], "inner")
              .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))))
    names = ["g", "cell", "slice"]
    schema = pa.schema([("q", pa.int64()), ("d", pa.float64()), ("key", to_arrow_type(key_type)), ("v", pa.float64())])
    return (dealt.select(*names, "q", "x").groupBy(*names)
            .cogroup(copies.select(*names, "x", "donors").groupBy(*names))
            .applyInArrow(_compare(d, k, schema), f"q long, d double, key {key_type.simpleString()}, v double"))


def _merged(found: DataFrame, k: int) -> DataFrame:
    """``(q, best)``: the ``k`` best rows of each query as structs ``(d, key, v)``, nearest first."""
    rows = F.array_distinct(F.collect_list(F.struct("d", "key", "v")))
    return found.groupBy("q").agg(F.slice(F.array_sort(rows), 1, k).alias("best"))


# ------------------------------------------------------------------------------ exact cells

@dataclass
class Cells:
    """Pivots and boxes of the cells of every group (block and target)."""
    pivots: dict[int, np.ndarray]
    boxes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def _nearest_pivot(pivots: dict[int, np.ndarray], d: int):
    def run(batches):
        for batch in batches:
            g = batch.column(0).to_numpy()
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)
            cell = np.zeros(len(g), np.int64)
            for group in np.unique(g):
                if len(p := pivots.get(int(group), np.zeros((0, d)))) > 1:
                    rows = np.flatnonzero(g == group)
                    step = max(1, CHUNK // len(p))
                    for lo in range(0, len(rows), step):
                        part = rows[lo:lo + step]
                        cell[part] = distances(x[part], p).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cell), *batch.columns[1:]],
                                             names=["g", "cell", *batch.schema.names[1:]])

    return run


def box_bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray, gappy: np.ndarray) -> np.ndarray:
    """Lower bounds of the distances of queries to all donors of each cell.  Where some donor of a
    cell misses a feature that the query has, its mean may run over any of the features, so the
    least gap is the bound; else it is the mean of the gaps."""
    total, least = np.zeros((len(q), len(low))), np.full((len(q), len(low)), np.inf)
    count, loose = np.zeros((len(q), 1)), np.zeros((len(q), len(low)), bool)
    for f in range(q.shape[1]):
        here = ~np.isnan(q[:, f])[:, None]
        gap = np.maximum(np.maximum(low[None, :, f] - q[:, f, None], q[:, f, None] - high[None, :, f]), 0.0)
        gap = np.where(np.isnan(gap), 0.0, gap * gap)
        total += np.where(here, gap, 0.0)
        least = np.where(here, np.minimum(least, gap), least)
        loose |= here & gappy[None, :, f]
        count += here
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = np.where(count > 0, total / count, np.inf)
    # a rounding error in the mean must not hide a donor on the bound
    return np.where(loose, least, mean) * (1 - 1e-12)


def _visits(cells: Cells, d: int, home: bool):
    """Cells that a query visits: its nearest box, or (with its k-th distance ``upto``) all others
    that are not farther."""

    def run(batches):
        for batch in batches:
            q, g = batch.column(0), batch.column(1).to_numpy()
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, d)
            at, to = [], []
            for group in np.unique(g):
                if int(group) not in cells.boxes:
                    continue
                ids, low, high, gappy = cells.boxes[int(group)]
                rows = np.flatnonzero(g == group)
                step = max(1, CHUNK // len(ids))
                for lo in range(0, len(rows), step):
                    part = rows[lo:lo + step]
                    bound = box_bounds(x[part], low, high, gappy)
                    first = bound.argmin(axis=1)
                    if home:
                        at.append(part)
                        to.append(ids[first])
                    else:
                        upto = batch.column(3).to_numpy(zero_copy_only=False)[part]
                        go = bound <= upto[:, None]
                        go[np.arange(len(part)), first] = False
                        own, cell = np.nonzero(go)
                        at.append(part[own])
                        to.append(ids[cell])
            take = pa.array(np.concatenate(at) if at else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [q.take(take), batch.column(1).take(take), batch.column(2).take(take),
                 pa.array(np.concatenate(to) if to else np.zeros(0, np.int64))], names=["q", "g", "x", "cell"])

    return run


def exact_cells(donors: DataFrame, d: int, cell_rows: int = CELL_ROWS) -> tuple[DataFrame, Cells]:
    """``donors (g, x, donors)`` with their ``cell``, and the cells.  The driver holds a pivot and a
    box per cell, at most about BROADCAST_MAX_ROWS of them: beyond that cells grow instead."""
    rows = max(cell_rows, -(-donors.count() // (BROADCAST_MAX_ROWS // 2)))
    sample = donors.where(F.pmod(F.xxhash64("x", "g"), F.lit(rows)) == 0).select("g", "x").collect()
    pivots: dict[int, list] = {}
    for r in sample:
        pivots.setdefault(r["g"], []).append([np.nan if v is None else v for v in r["x"]])
    table = {g: np.array(p, float) for g, p in pivots.items()}
    key = donors.schema["donors"].dataType.simpleString()
    placed = checkpoint(donors.select("g", "x", "donors").mapInArrow(
        _nearest_pivot(table, d), f"g long, cell long, x array<double>, donors {key}"))
    x = F.col("x")
    boxes: dict[int, list] = {}
    for r in placed.groupBy("g", "cell").agg(
            F.array(*[F.min(x[f]) for f in range(d)]).alias("low"), F.array(*[F.max(x[f]) for f in range(d)]).alias("high"),
            F.array(*[F.max(x[f].isNull()) for f in range(d)]).alias("gappy")).collect():
        boxes.setdefault(r["g"], []).append((r["cell"], r["low"], r["high"], r["gappy"]))
    real = lambda rows: np.array([[np.nan if v is None else v for v in row] for row in rows], float)
    return placed, Cells(table, {
        g: (np.array([b[0] for b in found]), real([b[1] for b in found]), real([b[2] for b in found]),
            np.array([b[3] for b in found], bool)) for g, found in boxes.items()})


def exact_nearest(queries: DataFrame, donors: DataFrame, d: int, k: int, key_type, cell_rows: int = CELL_ROWS,
                  slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``(q, best)`` for ``queries (q, g, x)`` among ``donors (g, x, donors array<(key, v)>)``."""
    placed, cells = exact_cells(donors, d, cell_rows)
    visit = "q long, g long, x array<double>, cell long"
    home = queries.select("q", "g", "x").mapInArrow(_visits(cells, d, True), visit)
    first = checkpoint(_visit(home, placed, d, k, key_type, slice_rows))
    if all(len(b[0]) == 1 for b in cells.boxes.values()):
        return _merged(first, k)
    bound = _merged(first, k).select("q", F.when(F.size("best") == k, F.element_at("best", -1)["d"]).alias("upto"))
    more = (queries.join(bound, "q", "left")
            .select("q", "g", "x", F.coalesce("upto", F.lit(float("inf"))).alias("upto"))
            .mapInArrow(_visits(cells, d, False), visit))
    return _merged(first.union(_visit(more, placed, d, k, key_type, slice_rows)), k)


# ----------------------------------------------------------------------------- hash tables

def bucket_width(donors: DataFrame, whole: list[int], k: int) -> float:
    """Four times the distance at which a donor's k-th neighbour is expected, from a bounded sample:
    a projection then keeps such a pair together with probability 0.8."""
    n = donors.count()
    part = donors.where(F.pmod(F.xxhash64("x", "g"), F.lit(max(1, n // SAMPLE_ROWS))) == 0)
    x = np.array([[r["x"][f] for f in whole] for r in part.select("x").limit(2 * SAMPLE_ROWS).collect()], float)
    if len(x) < 2:
        return 1.0
    far = np.sqrt(distances(x, x) * len(whole))
    np.fill_diagonal(far, np.inf)
    far.sort(axis=1)
    want = k * len(x) / max(n, 1)
    nth = min(len(x) - 1, max(1, int(np.ceil(want))))
    typical = float(np.median(far[:, nth - 1])) * min(1.0, want / nth) ** (1 / len(whole))
    return 4.0 * typical if typical > 0 else 1.0


def _hashed(df: DataFrame, whole: list[int], tables: int, width: float, seed: int) -> DataFrame:
    """One row per table, ``cell`` the hash of the table and its projections' buckets."""
    rng = np.random.default_rng(seed)
    cells = []
    for t in range(tables):
        parts = []
        for _ in range(PROJECTIONS):
            a, b = rng.normal(size=len(whole)), rng.uniform(0, width)
            dot = F.lit(float(b))
            for f, c in zip(whole, a, strict=True):
                dot = dot + F.col("x")[f] * F.lit(float(c))
            parts.append(F.floor(dot / F.lit(width)))
        cells.append(F.xxhash64(F.lit(t), *parts))
    return df.withColumn("cell", F.explode(F.array(*cells)))


def approximate_nearest(queries: DataFrame, donors: DataFrame, d: int, k: int, key_type, whole: list[int],
                        tables: int = 8, seed: int = 7, cell_rows: int = CELL_ROWS,
                        slice_rows: int = SLICE_ROWS) -> DataFrame:
    """As :func:`exact_nearest`, from the buckets of ``tables`` hash tables over the features
    ``whole``, which no row misses."""
    if not whole:
        raise ValueError("the approximate mode needs a feature without missing values")
    width = bucket_width(donors, whole, k)
    found = checkpoint(_merged(_visit(_hashed(queries, whole, tables, width, seed),
                                      _hashed(donors, whole, tables, width, seed), d, k, key_type, slice_rows), k))
    enough = found.where(F.size("best") == k)
    rest = checkpoint(queries.join(enough.select("q"), "q", "left_anti"))
    if rest.isEmpty():
        return enough
    return enough.unionByName(exact_nearest(rest, donors, d, k, key_type, cell_rows, slice_rows))
