"""Ordinal maps, fixed and equal-width bins, one-hot encoding, level pruning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tabforge.functions.nullsafe import eq_flag, qcol
from tabforge.operators.frame import require_columns
from tabforge.session import checkpoint


def _c(x) -> Column:
    return qcol(x) if isinstance(x, str) else x


# ---------------------------------------------------------------- ordinal

def ordinal(c, mapping: Mapping) -> Column:
    """Dictionary lookup; unmapped values and NULL give NULL (``Series.map``).

    Several keys may share a value.  The map is a literal, so the lookup is
    compiled into the projection.
    """
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.try_element_at(lookup, _c(c))


def ordinal_encode(df: DataFrame, mappings: Mapping[str, Mapping],
                   outputs: Mapping[str, str] | None = None) -> DataFrame:
    """Encode several columns; ``outputs`` maps a column to a new name (keeps the source)."""
    outputs = outputs or {}
    require_columns(df, list(mappings))
    return df.withColumns({outputs.get(c, c): ordinal(c, m) for c, m in mappings.items()})


# ---------------------------------------------------------------- bins

def range_bins(c, bins: Sequence[tuple[int, int, int]]) -> Column:
    """Integer ranges ``[lo, hi) -> label``; values outside or not integral give NULL."""
    x = _c(c)
    integral = x == F.floor(x)
    expr = None
    for lo, hi, label in bins:
        cond = integral & (x >= lo) & (x < hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


@dataclass
class EqualWidthModel:
    column: str
    edges: list[float]

    def expr(self) -> Column:
        """Bin index = number of inner edges strictly below the value (right-closed bins)."""
        x = qcol(self.column).cast("double")
        inner = self.edges[1:-1]
        if not inner:
            return F.when(x.isNotNull(), F.lit(0))
        total = sum((F.when(x > F.lit(e), 1).otherwise(0) for e in inner[1:]),
                    F.when(x > F.lit(inner[0]), 1).otherwise(0))
        return F.when(x.isNotNull(), total)

    def transform(self, df: DataFrame, output: str) -> DataFrame:
        return df.withColumn(output, self.expr())


def fit_equal_width(df: DataFrame, column: str, n_bins: int) -> EqualWidthModel:
    """Equal-width bins over ``[min, max]`` like ``pandas.cut(x, n, labels=False)``.

    One aggregation finds min and max; the ``n + 1`` edges are computed as
    ``pandas`` does (``linspace``; a constant column is widened by 0.1 %), so
    values lying on an edge fall in the same bin in both.
    """
    row = df.agg(F.min(qcol(column)).cast("double").alias("lo"),
                 F.max(qcol(column)).cast("double").alias("hi")).first()
    lo, hi = row["lo"], row["hi"]
    if lo is None:
        return EqualWidthModel(column, [])
    if lo == hi:
        pad = 0.001 * abs(lo) if lo != 0 else 0.001
        lo, hi = lo - pad, hi + pad
    edges = [float(e) for e in np.linspace(lo, hi, n_bins + 1)]
    return EqualWidthModel(column, edges)


# ---------------------------------------------------------------- one-hot

@dataclass
class OneHotModel:
    """Fitted levels per column; output columns ``<col>_<level>`` in sorted order."""
    levels: dict[str, list[str]] = field(default_factory=dict)
    prefix_sep: str = "_"

    def output_columns(self) -> list[str]:
        return [f"{c}{self.prefix_sep}{lv}" for c, lvs in self.levels.items() for lv in lvs]

    def transform(self, df: DataFrame, drop_source: bool = True) -> DataFrame:
        """0/1 integer per level; NULL gives all zeros.  One projection for all columns."""
        dummies = []
        for c, lvs in self.levels.items():
            s = qcol(c).cast("string")
            dummies += [eq_flag(s, lv).alias(f"{c}{self.prefix_sep}{lv}") for lv in lvs]
        keep = [qcol(c) for c in df.columns if not (drop_source and c in self.levels)]
        return df.select(*keep, *dummies)


    def to_vector(self, df: DataFrame, output: str = "onehot", drop_source: bool = True) -> DataFrame:
        """The same encoding as one sparse vector column (for wide vocabularies).

        Uses the fitted levels (no new pass): a literal map gives each sorted
        level its index and NULL / unseen values one extra index, declared as
        nominal metadata; ``OneHotEncoder`` drops that extra slot, so every real
        level keeps a slot and NULL encodes as all zeros, as in the dense form.
        Slot order follows ``output_columns()``.
        """
        from pyspark.ml.feature import OneHotEncoder, VectorAssembler
        cols = list(self.levels)
        tmp_i = [f"_oh_i{i}" for i in range(len(cols))]
        tmp_v = [f"_oh_v{i}" for i in range(len(cols))]
        idx = {}
        for c, t in zip(cols, tmp_i):
            lvs = self.levels[c]
            lookup = F.create_map(*[x for i, lv in enumerate(lvs) for x in (F.lit(lv), F.lit(float(i)))])
            code = F.coalesce(F.try_element_at(lookup, qcol(c).cast("string")), F.lit(float(len(lvs))))
            meta = {"ml_attr": {"type": "nominal", "num_vals": len(lvs) + 1, "name": t}}
            idx[t] = code.alias(t, metadata=meta)
        indexed = df.select("*", *idx.values())
        # the extra last category (NULL / unseen) is dropped: it encodes as all zeros
        encoder = OneHotEncoder(inputCols=tmp_i, outputCols=tmp_v, dropLast=True).fit(indexed.limit(0))
        out = VectorAssembler(inputCols=tmp_v, outputCol=output).transform(encoder.transform(indexed))
        out = out.drop(*tmp_i, *tmp_v)
        return out.drop(*cols) if drop_source else out


def fit_one_hot(df: DataFrame, columns: Sequence[str], max_levels: int = 1000) -> OneHotModel:
    """Distinct levels of every column in one job (values read as strings).

    The fitted vocabulary is collected, so its size is checked: more than
    ``max_levels`` levels in a column raises instead of building a huge
    dense schema.  Columns with more levels go through ``fit_level_dictionary``.
    """
    require_columns(df, columns)
    if not columns:
        return OneHotModel({})
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), qcol(c).cast("string").alias("level")) for c in columns]))
    levels = (df.select(pairs.alias("kv")).select("kv.column", "kv.level")
              .where(F.col("level").isNotNull()).distinct())
    cap = max_levels * len(columns)
    rows = levels.limit(cap + 1).collect()
    if len(rows) > cap:
        raise ValueError(f"more than {max_levels} levels per column on average; "
                         "use fit_level_dictionary for columns of many levels")
    out: dict[str, list[str]] = {c: [] for c in columns}
    for r in rows:
        out[r["column"]].append(r["level"])
    for c, lvs in out.items():
        if len(lvs) > max_levels:
            raise ValueError(f"column {c!r} has {len(lvs)} levels (> {max_levels})")
        lvs.sort()
    return OneHotModel(out)


# ---------------------------------------------------------------- level dictionary

#: Bytes of levels up to which a column's dictionary is broadcast.
DICTIONARY_BROADCAST_BYTES = 32 << 20


@dataclass
class LevelDictionary:
    """Dense level ids of columns with any number of levels.

    ``levels`` is a table ``(column, level, id)``; ids run from 0 in each column, in the order of
    the levels, as the dense form's columns do.  The driver holds two numbers per column.
    """
    levels: DataFrame
    sizes: dict[str, int]
    level_bytes: dict[str, int]

    def index(self, df: DataFrame, outputs: Mapping[str, str]) -> DataFrame:
        """``df`` with a column of ids per ``{column: output}``; NULL and unseen levels give NULL.

        A dictionary of counted, small size is broadcast.  A larger one is joined by level; that
        join is left to AQE, which splits the partitions of hot levels and of NULL.
        """
        for i, (c, out) in enumerate(outputs.items()):
            ids = self.levels.where(F.col("column") == c).select(
                F.col("level").alias(f"_lv{i}"), F.col("id").alias(out))
            # 64 bytes a row for the hash table beside the level itself
            if self.level_bytes[c] + 64 * self.sizes[c] <= DICTIONARY_BROADCAST_BYTES:
                ids = F.broadcast(ids)
            df = df.join(ids, qcol(c).cast("string") == F.col(f"_lv{i}"), "left").drop(f"_lv{i}")
        return df

    def to_vector(self, df: DataFrame, output: str = "onehot", drop_source: bool = True) -> DataFrame:
        """All columns as one sparse 0/1 vector: a slot per level, columns in order; NULL and
        unseen levels give zeros.  A row holds one index per column, however many levels there are."""
        ids = [f"_oh_i{i}" for i in range(len(self.sizes))]
        out = self.index(df, dict(zip(self.sizes, ids, strict=True)))
        start = np.cumsum([0, *self.sizes.values()])
        slots = F.filter(F.array(*[(F.col(c) + F.lit(int(b))).cast("int") for c, b in zip(ids, start)]),
                         lambda v: v.isNotNull())
        # a vector's stored form, read back as one: ml's encoder would name every slot in the schema
        stored = F.to_json(F.struct(F.struct(
            F.lit(0).alias("type"), F.lit(int(start[-1])).alias("size"), slots.alias("indices"),
            F.transform(slots, lambda v: F.lit(1.0)).alias("values")).alias("v")))
        schema = StructType([StructField("v", VectorUDT())])
        out = out.withColumn(output, F.from_json(stored, schema)["v"]).drop(*ids)
        return out.drop(*self.sizes) if drop_source else out


def fit_level_dictionary(df: DataFrame, columns: Sequence[str]) -> LevelDictionary:
    """Number the distinct levels of every column (values read as strings) without collecting them.

    The distinct levels are range-partitioned, sorted and written once; a level's id is its place in
    its partition plus the rows of its column in earlier partitions.  Only a count per partition and
    column comes to the driver: at most the partitions plus the columns, as ranges are contiguous.
    """
    require_columns(df, columns)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), qcol(c).cast("string").alias("level")) for c in columns]))
    found = checkpoint(df.select(pairs.alias("kv")).select("kv.column", "kv.level")
                       .where(F.col("level").isNotNull()).distinct()
                       .repartitionByRange("column", "level").sortWithinPartitions("column", "level"))
    placed = found.select("column", "level", F.spark_partition_id().alias("_part"),
                          F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"))
    runs = (placed.groupBy("column", "_part")
            .agg(F.min("_at").alias("first"), F.count(F.lit(1)).alias("n"),
                 F.sum(F.octet_length("level")).alias("bytes")).collect())
    sizes, level_bytes, shifts = dict.fromkeys(columns, 0), dict.fromkeys(columns, 0), []
    for r in sorted(runs, key=lambda r: r["_part"]):
        shifts.append((r["column"], r["_part"], sizes[r["column"]] - r["first"]))
        sizes[r["column"]] += r["n"]
        level_bytes[r["column"]] += r["bytes"]
    shift = df.sparkSession.createDataFrame(shifts, "column string, _part int, _shift long")
    levels = (placed.join(F.broadcast(shift), ["column", "_part"])
              .select("column", "level", (F.col("_at") + F.col("_shift")).alias("id")))
    return LevelDictionary(levels, sizes, level_bytes)


def unshared_levels(df: DataFrame, columns: Sequence[str], tag: str = "_split",
                    labels: tuple[str, str] = ("train", "test")) -> DataFrame:
    """``(column, level, in_train, in_test)`` for levels seen in only one split."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), qcol(c).cast("string").alias("level")) for c in columns]))
    long = df.select(F.col(tag), pairs.alias("kv")).select(tag, "kv.column", "kv.level")
    per = (long.where(F.col("level").isNotNull())
           .groupBy("column", "level")
           .agg(F.max((F.col(tag) == labels[0]).cast("int")).alias("in_train"),
                F.max((F.col(tag) == labels[1]).cast("int")).alias("in_test")))
    return per.where((F.col("in_train") == 0) | (F.col("in_test") == 0))


def drop_unshared_levels(df: DataFrame, model: OneHotModel, tag: str = "_split",
                         labels: tuple[str, str] = ("train", "test"),
                         names: Sequence[str] | None = None) -> DataFrame:
    """Drop dummy columns whose level occurs in one split only.

    With ``names`` the listed dummy columns are dropped instead (the
    reference's fixed list); every name must exist.
    """
    if names is not None:
        require_columns(df, names, "dummy column to drop")
        return df.drop(*names)
    # the source columns are gone after encoding: read presence off the dummies
    cols = model.output_columns()
    present = df.groupBy(tag).agg(*[F.max(qcol(c)).alias(f"_m{i}") for i, c in enumerate(cols)])
    got = {r[tag]: r for r in present.collect()}
    drop = []
    for i, c in enumerate(cols):
        a = got.get(labels[0])
        b = got.get(labels[1])
        in_a = bool(a and a[f"_m{i}"])
        in_b = bool(b and b[f"_m{i}"])
        if in_a != in_b:
            drop.append(c)
    return df.drop(*drop)
