"""Row filters, keyed drops, keyed cell patches and value replacement.

The reference drops rows and writes cells by *position*; here both are keyed
tables, so the result does not depend on row order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.nullsafe import qcol
from tabforge.operators.frame import require_columns
from tabforge.operators.joins import attach


def drop_where(df: DataFrame, *predicates: Column) -> DataFrame:
    """Drop the rows where *all* predicates hold; a NULL predicate keeps the row.

    pandas evaluates ``(a < 5) & (b > 2e5)`` to False on NaN, so such rows stay.
    """
    both = reduce(lambda a, b: a & b, predicates)
    return df.where(~F.coalesce(both, F.lit(False)))


def drop_keys(df: DataFrame, keys: DataFrame | Sequence, key: str,
              bound: int | None = None) -> DataFrame:
    """Drop the rows whose ``key`` is listed (left anti join).

    ``keys`` is a DataFrame with a ``key`` column or a Python list; a list has
    its length as proven bound and is broadcast.
    """
    if not isinstance(keys, DataFrame):
        values = list(keys)
        field = df.schema[key]
        keys = df.sparkSession.createDataFrame([(v,) for v in values],
                                               T.StructType([T.StructField(key, field.dataType)]))
        bound = len(values)
    return attach(df, keys.select(key).distinct(), on=[key], how="left_anti", bound=bound)


def patch_cells(df: DataFrame, patches: DataFrame | Sequence[tuple], key: str,
                bound: int | None = None) -> DataFrame:
    """Overwrite single cells addressed by ``(key, column, value)``.

    ``patches`` is either a Python list of triples or a wide DataFrame with
    ``key`` plus one column per patched column (NULL = leave the cell).  The
    patch table is joined once on the key; cells are ``coalesce(patch, cell)``.
    """
    if not isinstance(patches, DataFrame):
        patches, bound = _wide_patch_table(df, list(patches), key), len(patches)
    cols = [c for c in patches.columns if c != key]
    require_columns(df, [key] + cols)
    renamed = patches.select(qcol(key), *[qcol(c).alias(f"__patch_{i}") for i, c in enumerate(cols)])
    joined = attach(df, renamed, on=[key], how="left", bound=bound)
    pos = {c: i for i, c in enumerate(cols)}
    return joined.select(*[
        F.coalesce(F.col(f"__patch_{pos[c]}").cast(df.schema[c].dataType), qcol(c)).alias(c)
        if c in pos else qcol(c) for c in df.columns])


def _wide_patch_table(df: DataFrame, triples: list[tuple], key: str) -> DataFrame:
    spark: SparkSession = df.sparkSession
    cols = sorted({c for _, c, _ in triples})
    by_key: dict = {}
    for k, c, v in triples:
        by_key.setdefault(k, {})[c] = v
    schema = T.StructType([T.StructField(key, df.schema[key].dataType)] +
                          [T.StructField(c, df.schema[c].dataType) for c in cols])
    rows = [tuple([k] + [vals.get(c) for c in cols]) for k, vals in by_key.items()]
    return spark.createDataFrame(rows, schema)


def replace_values(df: DataFrame, mapping: Mapping, subset: Sequence[str]) -> DataFrame:
    """Whole-cell replacement ``old -> new`` in ``subset`` (other cells unchanged)."""
    require_columns(df, subset)
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    repl = {c: F.coalesce(F.try_element_at(lookup, qcol(c)), qcol(c)) for c in subset}
    return df.withColumns(repl)
