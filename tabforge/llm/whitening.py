"""Embedding whitening by a bidiagonal qd solver.

1. Entries become integers, x = floor(scale * c) + offset; one aggregation counts rows and sums x.
2. Tasks reduce their centred rows to a triangle R block by block with QR; triangles meet in a tree
   of bounded fan-in.  RᵀR is n times the covariance, and is never formed.
3. The driver has one width x width triangle: Householder reflections make it bidiagonal, dqds finds
   its singular values to high relative accuracy, and a twisted factorisation at each gives the
   whitening direction.
4. Rows are projected on the directions where they lie; the covariance of the result is measured in
   a pass of its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.session import checkpoint

#: Rows per QR block, triangles per node of the reduction tree.
BLOCK_ROWS, FANIN = 4096, 16
#: Largest |x - offset|: a batch's sums of x stay exact in 64 bits.
MAX_X = 1 << 45
EPS = np.finfo(float).eps


# ------------------------------------------------------------------------- bidiagonal form

def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """``(a, b, reflectors)`` of a square matrix: U R V has diagonal ``a`` and superdiagonal ``b``;
    V is the product of the reflections I - 2 v vᵀ, reflector k acting on entries from k + 1."""
    m, d = r.astype(float).copy(), len(r)
    a, b, right = np.zeros(d), np.zeros(max(d - 1, 0)), []
    for k in range(d):
        v, a[k] = _reflector(m[k:, k])
        if v is not None:
            m[k:, k:] -= 2 * np.outer(v, v @ m[k:, k:])
        if k < d - 1:
            v, b[k] = _reflector(m[k, k + 1:])
            if v is not None:
                m[k:, k + 1:] -= 2 * np.outer(m[k:, k + 1:] @ v, v)
            right.append(v)
    return a, b, right


def _reflector(x: np.ndarray) -> tuple[np.ndarray | None, float]:
    """Unit ``v`` whose reflection maps ``x`` to a multiple of the first axis, and the multiple."""
    top = np.abs(x).max(initial=0.0)
    if len(x) < 2 or not np.abs(x[1:]).max():
        return None, float(x[0])
    y = x / top
    length = -np.copysign(np.sqrt(y @ y), y[0])
    v = y.copy()
    v[0] -= length
    return v / np.sqrt(v @ v), float(length * top)


# ----------------------------------------------------------------------------------- dqds

def _dqds(q: list[float], e: list[float], shift: float):
    """One differential quotient-difference step with a shift; None if the shift was too large."""
    n = len(q)
    nq, ne, d = [0.0] * n, [0.0] * max(n - 1, 0), q[0] - shift
    if not d >= 0:
        return None
    for k in range(n - 1):
        nq[k] = d + e[k]
        ratio = q[k + 1] / nq[k] if nq[k] else np.inf
        ne[k] = e[k] * ratio
        d = d * ratio - shift
        if not d >= 0:
            return None
    nq[-1] = d
    return nq, ne


def _newton_shift(q: list[float], e: list[float]) -> float:
    """A lower bound of the least eigenvalue of BᵀB, 1 / trace of its inverse.  For an upper
    bidiagonal B with q = a², e = b² the inverse's columns have square norms
    s(1) = 1 / q(1), s(k + 1) = (1 + e(k) s(k)) / q(k + 1), whose sum is that trace."""
    s = 1.0 / q[0]
    total = s
    for k in range(len(q) - 1):
        s = (1.0 + e[k] * s) / q[k + 1]
        total += s
    return 1.0 / total


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of the bidiagonal (a, b), falling, by dqds.

    Shifts are first guessed from the last corner and taken back if a d turns negative, then from
    the bound by the inverse's trace, which no exact arithmetic could exceed, then zero."""
    q, e = (np.asarray(a, float) ** 2).tolist(), (np.asarray(b, float) ** 2).tolist()
    top = max([*q, *e], default=0.0)
    if not top:
        return np.zeros(len(q))
    floor = top * EPS ** 4                    # zero diagonals, far below the rounding of R
    q = [max(x, floor) for x in q]
    found, todo = [], [(q, e, 0.0)]
    while todo:
        q, e, moved = todo.pop()
        while q:
            if len(q) == 1:
                found.append(q.pop() + moved)
                break
            if e[-1] <= EPS * EPS * (moved + q[-1]) or e[-1] <= floor * EPS:
                found.append(q.pop() + moved)
                e.pop()
                continue
            cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= EPS * EPS * moved
                        or e[k] <= floor * EPS), None)
            if cut is not None:
                todo.append((q[:cut + 1], e[:cut], moved))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            corner = max(q[-1] - np.sqrt(q[-1] * e[-1]), 0.0) if e[-1] < q[-1] / 16 else 0.0
            for shift in (corner, _newton_shift(q, e) * (1 - 8 * EPS), 0.0):
                if (step := _dqds(q, e, shift)) is not None:
                    break
            q, e = step
            q = [max(x, floor) for x in q]
            moved += shift
    return np.sort(np.array(found))[::-1]


# --------------------------------------------------------------------- twisted factorisations

def _twisted(q: np.ndarray, low: np.ndarray, lam: float):
    """Stationary and progressive factors of L D Lᵀ - lam and the twist values gamma."""
    n = len(q)
    tiny = np.finfo(float).tiny / EPS
    lp, um, s, p = np.zeros(n - 1), np.zeros(n - 1), np.zeros(n), np.zeros(n)
    s[0] = -lam
    for k in range(n - 1):                     # L+ D+ L+ᵀ from the top
        dp = s[k] + q[k]
        dp = dp if abs(dp) > tiny else tiny
        lp[k] = q[k] * low[k] / dp
        s[k + 1] = lp[k] * low[k] * s[k] - lam
    p[-1] = q[-1] - lam
    for k in range(n - 2, -1, -1):             # U- D- U-ᵀ from the bottom
        dm = q[k] * low[k] * low[k] + p[k + 1]
        dm = dm if abs(dm) > tiny else tiny
        ratio = q[k] / dm
        um[k] = low[k] * ratio
        p[k] = p[k + 1] * ratio - lam
    return lp, um, s + p + lam


def _vector(lp, um, r: int) -> np.ndarray:
    z = np.zeros(len(lp) + 1)
    z[r] = 1.0
    for k in range(r - 1, -1, -1):
        z[k] = -lp[k] * z[k + 1]
    for k in range(r, len(lp)):
        z[k + 1] = -um[k] * z[k]
    return z


def _times(q, low, z):
    """L D Lᵀ z."""
    y = z.copy()
    y[:-1] += low * z[1:]
    y *= q
    y[1:] += low * y[:-1]
    return y


def bidiagonal_vectors(a: np.ndarray, b: np.ndarray, lams: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of BᵀB for its largest eigenvalues ``lams``, as columns.

    Each is the solution of a twisted factorisation at its smallest twist, corrected once by the
    Rayleigh quotient.  Members of a cluster (relative gap below 1e-3) are made orthogonal to the
    earlier ones; one that vanishes by that, as equal eigenvalues have it, is sought by inverse
    iteration from another twist."""
    n = len(a)
    q = np.maximum(np.asarray(a, float) ** 2, (lams[0] if len(lams) else 0.0) * EPS ** 4)
    low = a[:-1] * b / q[:-1] if n > 1 else np.zeros(0)
    out = np.zeros((n, len(lams)))
    for j, lam in enumerate(lams):
        near = [i for i in range(j) if lams[i] - lam <= 1e-3 * lams[i]]
        base = out[:, near]
        for _ in range(2):
            lp, um, gamma = _twisted(q, low, lam)
            r = int(np.nanargmin(np.abs(gamma)))
            z = _vector(lp, um, r)
            size = z @ z
            if not near and abs(gamma[r]) <= 1e-3 * lam * size:
                lam = lam + gamma[r] / size
            z /= np.sqrt(size)
        if near:
            start = np.random.default_rng(j)
            for attempt in range(6):
                rest = z - base @ (base.T @ z)
                rest -= base @ (base.T @ rest)
                if np.sqrt(rest @ rest) > 0.1:
                    z = rest / np.sqrt(rest @ rest)
                    if np.linalg.norm(_times(q, low, z) - lam * z) <= 1e-12 * lams[0] * n:
                        break
                else:
                    z = start.normal(size=n)
                    z -= base @ (base.T @ z)
                # T - lam is symmetric: a solve by elimination with pivoting of its band
                z = _shifted_solve(q, low, lam * (1 - 4 * EPS * (attempt + 1)), z)
                z /= np.sqrt(z @ z)
            z -= base @ (base.T @ z)
            z /= np.sqrt(z @ z)
        out[:, j] = z
    return out


def _shifted_solve(q, low, lam, rhs):
    """Solve (L D Lᵀ - lam) z = rhs, tridiagonal, by Gaussian elimination with row exchanges."""
    n = len(q)
    main = q.copy()
    main[1:] += q[:-1] * low * low
    main = main - lam
    up = np.append(q[:-1] * low, 0.0)
    up2, z, tiny = np.zeros(n), rhs.astype(float).copy(), EPS * max(np.abs(main).max(), lam)
    under = up.copy()
    for k in range(n - 1):
        if abs(under[k]) > abs(main[k]):
            main[k], under[k] = under[k], main[k]
            up[k], main[k + 1] = main[k + 1], up[k]
            up2[k], up[k + 1] = up[k + 1], 0.0
            z[k], z[k + 1] = z[k + 1], z[k]
        pivot = main[k] if main[k] else tiny
        main[k] = pivot
        f = under[k] / pivot
        main[k + 1] -= f * up[k]
        up[k + 1] -= f * up2[k]
        z[k + 1] -= f * z[k]
    for k in range(n - 1, -1, -1):
        tail = up[k] * z[k + 1] if k + 1 < n else 0.0
        tail += up2[k] * z[k + 2] if k + 2 < n else 0.0
        z[k] = (z[k] - tail) / (main[k] if main[k] else tiny)
        if abs(z[k]) > 1e100:
            z /= abs(z[k])
    return z


def principal_directions(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest ``count`` eigenvalues of RᵀR (those above rounding) and their unit vectors."""
    top = np.abs(r).max(initial=0.0)
    if not top:
        return np.zeros(0), np.zeros((len(r), 0))
    a, b, right = bidiagonalise(r / top)
    lams = squared_singular_values(a, b)[:count]
    lams = lams[lams > lams[0] * (8 * len(r) * EPS) ** 2]
    vectors = bidiagonal_vectors(a, b, lams)
    for k in range(len(right) - 1, -1, -1):
        if right[k] is not None:
            vectors[k + 1:] -= 2 * np.outer(right[k], right[k] @ vectors[k + 1:])
    return lams * top * top, vectors


# --------------------------------------------------------------------------------- the passes

@dataclass
class Whitening:
    """A fitted whitening: integer sums, directions as columns, eigenvalues of the covariance."""
    n: int
    sums: list[int]
    directions: np.ndarray
    values: np.ndarray
    trace: float
    scale: int
    offset: int


def _integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int,
                     offset: int) -> DataFrame:
    """``(_id, _x)`` of the rows that take part."""
    return (vectors.select(F.col(id_col).alias("_id"), F.col(vec_col).alias("_c"))
            .where(F.coalesce(F.size(F.col("_c")) > 0, F.lit(False)))
            .select("_id", F.col("_c").cast("array<double>").alias("_c"))
            .where(F.forall("_c", lambda v: v.isNotNull() & ~F.isnan(v)
                            & (F.abs(v * float(scale)) < float(MAX_X))))
            .select("_id", F.transform("_c", lambda v: F.floor(v * float(scale)).cast("long")
                                       + F.lit(offset).cast("long")).alias("_x")))


def _matrix(column, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _sum_task():
    """Exact sums per width: ``(width, n, sums as text)``, one row per width of the partition."""

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            widths = pa.compute.list_value_length(batch.column(0)).to_numpy(zero_copy_only=False)
            for w in np.unique(widths):
                x = _matrix(batch.column(0).filter(pa.array(widths == w)), int(w))
                n, total = held.setdefault(int(w), [0, [0] * int(w)])
                part = x.sum(axis=0).tolist()
                held[int(w)] = [n + len(x), [s + t for s, t in zip(total, part, strict=True)]]
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.int32()), pa.array([v[0] for v in held.values()], pa.int64()),
                 pa.array([[str(s) for s in v[1]] for v in held.values()], pa.list_(pa.string()))],
                names=["width", "n", "sums"])

    return run


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S exactly: in 64 bits where that holds every value, else in Python's integers."""
    s = np.array(sums, dtype=object)
    if n * (MAX_X * 2) < 1 << 62 or n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) < 1 << 61:
        return x * np.int64(n) - s.astype(np.int64)
    return x.astype(object) * n - s


def _triangle_rows(key: int, r: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([key], pa.int64()), pa.array([r.ravel()], pa.list_(pa.float64()))], names=["part", "r"])


def _fold_qr(r, block):
    return np.linalg.qr(block if r is None else np.vstack([r, block]), mode="r")


def _square(r: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((width, width))
    out[:len(r)] = r
    return out


def _qr_task(n: int, sums: list[int]):
    width = len(sums)

    def run(batches):
        from pyspark import TaskContext

        r, key = None, TaskContext.get().partitionId()
        for batch in batches:
            x = _matrix(batch.column(0), width)
            for lo in range(0, len(x), BLOCK_ROWS):
                r = _fold_qr(r, _centred(x[lo:lo + BLOCK_ROWS], n, sums).astype(float) / n)
        if r is not None:
            yield _triangle_rows(key, _square(r, width))

    return run


def _merge_qr(width: int):
    def merge(table: pa.Table) -> pa.Table:
        r = None
        for row in table.sort_by("from")["r"]:
            r = _fold_qr(r, row.values.to_numpy().reshape(width, width))
        return pa.Table.from_batches([_triangle_rows(table["part"][0].as_py(), _square(r, width))])

    return merge


def _reduced(parts: DataFrame, merge) -> DataFrame:
    """Tree of ``merge`` over partition numbers, at most FANIN rows a group, in their order."""
    parts = checkpoint(parts)
    schema, count = parts.schema, parts.agg(F.max("part")).first()[0] + 1
    while count > 1:
        count = -(-count // FANIN)
        parts = (parts.withColumn("from", F.col("part"))
                 .withColumn("part", F.floor(F.col("part") / FANIN).cast("long"))
                 .groupBy("part").applyInArrow(merge, schema))
    return parts


def _moment_task(project):
    def run(batches):
        from pyspark import TaskContext

        held, key = None, TaskContext.get().partitionId()
        for batch in batches:
            held = _merge_moments(held, _moments(project(batch.column(0))))
        if held is not None:
            yield _moment_row(key, held)

    return run


def _moments(y: np.ndarray):
    mean = y.mean(axis=0) if len(y) else np.zeros(y.shape[1])
    return len(y), mean, (y - mean).T @ (y - mean)


def _merge_moments(a, b):
    if a is None or not a[0]:
        return b
    if not b[0]:
        return a
    n, step = a[0] + b[0], b[1] - a[1]
    return n, a[1] + step * (b[0] / n), a[2] + b[2] + np.outer(step, step) * (a[0] * b[0] / n)


def _moment_row(key, held) -> pa.RecordBatch:
    flat = np.concatenate([[float(held[0])], held[1], held[2].ravel()])
    return pa.RecordBatch.from_arrays([pa.array([key], pa.int64()),
                                       pa.array([flat], pa.list_(pa.float64()))], names=["part", "r"])


def _read_moments(flat: np.ndarray, k: int):
    return int(flat[0]), flat[1:k + 1], flat[k + 1:].reshape(k, k)


def _merge_moment_rows(k: int):
    def merge(table: pa.Table) -> pa.Table:
        held = None
        for row in table.sort_by("from")["r"]:
            held = _merge_moments(held, _read_moments(row.values.to_numpy(), k))
        return pa.Table.from_batches([_moment_row(table["part"][0].as_py(), held)])

    return merge


def fit(vectors: DataFrame, components: int = 8, id_col: str = "vec_id", vec_col: str = "embedding",
        scale: int = 1024, offset: int = 100000) -> Whitening | None:
    """Fit on all rows that take part (see :func:`whiten`); None if there are none."""
    rows = _integer_vectors(vectors, id_col, vec_col, scale, offset).select("_x")
    part = rows.mapInArrow(_sum_task(), "width int, n long, sums array<string>")
    totals = (part.select("width", "n", F.posexplode("sums").alias("dim", "s"))
              .groupBy("width", "dim").agg(F.sum("n").alias("n"),
                                           F.sum(F.col("s").cast("decimal(38,0)")).alias("s")))
    best = totals.where(F.col("dim") == 0).orderBy(F.desc("n"), F.desc("width")).first()
    if best is None:
        return None
    width, n = best["width"], best["n"]
    sums = [int(r["s"]) for r in totals.where(F.col("width") == width).orderBy("dim").collect()]
    own = rows.where(F.size("_x") == width)
    triangles = own.mapInArrow(_qr_task(n, sums), "part long, r array<double>")
    last = _reduced(triangles, _merge_qr(width)).first()
    r = np.array(last["r"]).reshape(width, width)
    values, directions = principal_directions(r, components)
    return Whitening(n, sums, directions, values / n, float((r * r).sum()) / n, scale, offset)


def _projector(model: Whitening):
    """Centred integers and whitened coordinates of a column of integer vectors."""
    into = model.directions / np.sqrt(model.values)

    def run(column) -> tuple[np.ndarray, np.ndarray]:
        far = _centred(_matrix(column, len(model.sums)), model.n, model.sums)
        return far, far.astype(float) / model.n @ into

    return run


def identity_error(vectors: DataFrame, model: Whitening, id_col: str = "vec_id",
                   vec_col: str = "embedding") -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured."""
    k = len(model.values)
    if not k:
        return 0.0
    rows = (_integer_vectors(vectors, id_col, vec_col, model.scale, model.offset).select("_x")
            .where(F.size("_x") == len(model.sums)))
    project = _projector(model)
    parts = rows.mapInArrow(_moment_task(lambda column: project(column)[1]), "part long, r array<double>")
    last = _reduced(parts, _merge_moment_rows(k)).first()
    n, _, square = _read_moments(np.array(last["r"]), k)
    return float(np.abs(square / n - np.eye(k)).max())


def _deviations(far: np.ndarray) -> list[int]:
    """Row sums of squares, exactly."""
    top = max((abs(int(v)) for v in (far.max(initial=0), far.min(initial=0))), default=0)
    if top * top * far.shape[1] < 1 << 63:
        return (far.astype(np.int64) ** 2).sum(axis=1).tolist()
    return (far.astype(object) ** 2).sum(axis=1).tolist()


def transform(vectors: DataFrame, model: Whitening, error: float, id_col: str = "vec_id",
              vec_col: str = "embedding") -> DataFrame:
    """A row per vector and component, see :func:`whiten`."""
    rows = (_integer_vectors(vectors, id_col, vec_col, model.scale, model.offset)
            .where(F.size("_x") == len(model.sums)))
    project, share, n = _projector(model), (model.values / model.trace).tolist(), model.n
    k = len(share)
    id_type = vectors.schema[id_col].dataType.simpleString()

    def run(batches):
        from decimal import Decimal

        for batch in batches:
            far, white = project(batch.column(1))
            at = np.repeat(np.arange(len(white)), k)
            squares = [Decimal(v) for v in _deviations(far)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1), len(white)), pa.int32()),
                 pa.array(np.full(len(at), n), pa.int64()),
                 pa.array(squares, pa.decimal128(38, 0)).take(pa.array(at)),
                 pa.array(white.ravel()), pa.array(np.tile(share, len(white))),
                 pa.array(np.full(len(at), error))],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, f"id {id_type}, component int, n long, deviation decimal(38,0), "
                                "whitened double, explained double, identity_error double"
                           ).withColumnRenamed("id", id_col)


def whiten(vectors: DataFrame, components: int = 8, id_col: str = "vec_id",
           vec_col: str = "embedding", scale: int = 1024, offset: int = 100000) -> DataFrame:
    """``(id_col, component, n, deviation, whitened, explained, identity_error)``: a row for each row
    of ``vectors`` that takes part and each of at most ``components`` components.

    Entry c counts as x = floor(scale * c) + offset.  With n rows and sums S of x, ``deviation`` is
    the exact sum of (n x - S)^2 (a decimal, as 64 bits hold it only while n is moderate),
    ``whitened`` is (x - S / n) on the component's unit eigenvector over the root of its eigenvalue,
    ``explained`` its share of the trace, ``identity_error`` the largest absolute entry of the
    whitened covariance minus the identity, measured over all rows.

    Rows do not take part if their vector is null, empty, or holds a null, a NaN or an entry whose
    scaled size reaches 2^45 (infinities included), or if it is not as wide as most (ties: the
    wider).  Repeated rows count as often as they occur; null ids are kept.  Components whose
    eigenvalue is rounding alone (constant or dependent dimensions, fewer rows) are left out, so
    equal rows and empty tables give an empty result.  Other columns are not read.

    The driver holds sums and one width x width triangle, whatever the number of rows; tasks hold a
    triangle and a block of rows.
    """
    model = fit(vectors, components, id_col, vec_col, scale, offset)
    if model is None or not len(model.values):
        id_type = vectors.schema[id_col].dataType.simpleString()
        return vectors.sparkSession.createDataFrame(
            [], f"`{id_col}` {id_type}, component int, n long, deviation decimal(38,0), whitened double, "
                "explained double, identity_error double")
    error = identity_error(vectors, model, id_col, vec_col)
    return transform(vectors, model, error, id_col, vec_col)
