"""Projection, schema checks, tagged union / split and keyed updates.

The reference relies on row positions (``concat`` then ``[:train_len]``); here
rows carry their key and a split tag, so nothing depends on row order or on
the number of partitions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.nullsafe import qcol

SPLIT = "_split"


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "column") -> None:
    """Raise if any of ``columns`` is missing (no job is run)."""
    present = set(df.columns)
    missing = [c for c in columns if c not in present]
    if missing:
        raise KeyError(f"{what}(s) not in the frame: {missing}")


def drop_strict(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop columns that must exist (the reference asserts before dropping)."""
    require_columns(df, columns, "column to drop")
    return df.drop(*columns)


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Select ``columns`` in order; the parquet scan reads only these."""
    require_columns(df, columns)
    return df.select(*[qcol(c) for c in columns])


def copy_column(df: DataFrame, source: str, target: str) -> DataFrame:
    """Keep a copy of ``source`` as ``target`` before ``source`` is recoded."""
    return df.withColumn(target, qcol(source))


def union_tagged(train: DataFrame, test: DataFrame, tag: str = SPLIT,
                 labels: tuple[str, str] = ("train", "test")) -> DataFrame:
    """UNION ALL by name; columns missing on one side (the label) become NULL."""
    return (train.withColumn(tag, F.lit(labels[0]))
            .unionByName(test.withColumn(tag, F.lit(labels[1])), allowMissingColumns=True))


def split(df: DataFrame, tag: str = SPLIT,
          labels: tuple[str, str] = ("train", "test")) -> tuple[DataFrame, DataFrame]:
    """Inverse of :func:`union_tagged` (a filter on the tag, pushed to the scan)."""
    return (df.where(F.col(tag) == labels[0]).drop(tag),
            df.where(F.col(tag) == labels[1]).drop(tag))


def split_counts(df: DataFrame, tag: str = SPLIT) -> DataFrame:
    """Rows per split: ``(tag, rows)``."""
    return df.groupBy(tag).agg(F.count(F.lit(1)).alias("rows"))


def check_counts(df: DataFrame, expected: Mapping[str, int], tag: str = SPLIT) -> None:
    """Assert the row count of every split (one small aggregation job)."""
    got = {r[tag]: r["rows"] for r in split_counts(df, tag).collect()}
    for k, v in expected.items():
        if got.get(k, 0) != v:
            raise AssertionError(f"split {k!r}: expected {v} rows, found {got.get(k, 0)}")


def update_from(df: DataFrame, other: DataFrame, key: str | Sequence[str],
                columns: Sequence[str] | None = None, bound: int | None = None) -> DataFrame:
    """``DataFrame.update``: overwrite cells with the non-NULL values of ``other``.

    Rows are aligned on ``key``; rows of ``df`` without a partner keep their
    values; a key that repeats in ``other`` is an error.  ``bound`` is a proven row bound of ``other`` (broadcast if small).
    """
    from tabforge.operators.joins import attach

    keys = [key] if isinstance(key, str) else list(key)
    cols = list(columns) if columns else [c for c in other.columns if c not in keys]
    require_columns(df, keys + cols)
    again = other.groupBy(*[qcol(k) for k in keys]).count().where(F.col("count") > 1)
    if not again.isEmpty():
        raise ValueError(f"update_from: {keys} repeats in the other table")
    renamed = other.select(*[qcol(k) for k in keys],
                           *[qcol(c).alias(f"__upd_{i}") for i, c in enumerate(cols)])
    joined = attach(df, renamed, on=keys, how="left", bound=bound)
    out = []
    pos = {c: i for i, c in enumerate(cols)}
    for c in df.columns:
        if c in pos:
            out.append(F.coalesce(F.col(f"__upd_{pos[c]}"), qcol(c)).alias(c))
        else:
            out.append(qcol(c))
    return joined.select(*out)


def shape(df: DataFrame) -> tuple[int, int]:
    """``(rows, columns)``; counting rows runs one job."""
    return df.count(), len(df.columns)
