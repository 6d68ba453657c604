"""Scans and sinks.

The reference reads two CSV files with an inferred schema and ``NA`` as the
missing marker, and writes one ``(Id, prediction)`` CSV.  Here scans take a
schema, or infer one by a pass over the data, and both ``NA`` and the empty
string read as NULL.  Parquet is the format for the test
tables; Catalyst pushes projections and filters into those scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tabforge.functions.nullsafe import qcol

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """Scan one parquet table; selecting ``columns`` prunes the parquet read."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def _csv_reader(spark: SparkSession, null_value: str, timestamp_format: str | None):
    reader = (spark.read.option("header", "true")
              .option("nullValue", null_value)
              .option("emptyValue", None)
              .option("mode", "FAILFAST"))
    return reader.option("timestampFormat", timestamp_format) if timestamp_format else reader


#: Types of the inference, narrowest first; text takes what none of them does.
INFERRED = ("boolean", "long", "double", "date", "timestamp")


def infer_schema(spark: SparkSession, path: str, null_value: str = "NA",
                 timestamp_format: str | None = None) -> StructType:
    """Narrowest type of every CSV column, in one aggregation over all of them.

    A value has a bit per type that can hold it and a column the bits common to its values, which
    merge in any order.  Missing values take any type; a column of them alone is text.  Whole
    numbers beyond 64 bits stay text, so no digit is lost, and numbers with a trailing type letter
    or spaces are text.  All files need the header of the first.
    """
    raw = _csv_reader(spark, null_value, timestamp_format).csv(path)

    def mask(name: str) -> Column:
        c = qcol(name)
        whole = c.rlike(r"^[+-]?[0-9]+$")
        fits = whole & c.try_cast("bigint").isNotNull()
        real = c.rlike(r"^[+-]?([0-9]+\.[0-9]*|\.?[0-9]+)([eE][+-]?[0-9]+)?$|^NaN$|^-?Inf$")
        when = (F.try_to_timestamp(c, F.lit(timestamp_format)) if timestamp_format else
                F.when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T].+)?$"), c.try_cast("timestamp")))
        tests = [F.lower(c).isin("true", "false"), fits, fits | (real & ~whole),
                 c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & c.try_cast("date").isNotNull(),
                 when.isNotNull()]
        bits = sum((F.when(t, 1 << i).otherwise(0) for i, t in enumerate(tests)), F.lit(0))
        return F.bit_and(F.when(c.isNotNull(), bits))

    common = raw.agg(*[mask(c).alias(f"m{i}") for i, c in enumerate(raw.columns)]).first()
    schema = StructType()
    for i, c in enumerate(raw.columns):
        bits = common[f"m{i}"] or 0
        schema.add(c, next((t for j, t in enumerate(INFERRED) if bits >> j & 1), "string"))
    return schema


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             null_value: str = "NA", timestamp_format: str | None = None) -> DataFrame:
    """CSV scan with a header and ``NA`` / empty as NULL; without a schema it is inferred."""
    if schema is None:
        schema = infer_schema(spark, path, null_value, timestamp_format)
    return nan_to_null(_csv_reader(spark, null_value, timestamp_format).schema(schema).csv(path))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in float and double columns as NULL: missing is one thing."""
    real = [f.name for f in df.schema.fields if f.dataType.typeName() in ("float", "double")]
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in real})


def write_csv(df: DataFrame, path: str, null_value: str = "NA",
              timestamp_format: str | None = None) -> None:
    """CSV sink with a header; NULL is written as ``NA`` (the reference's marker)."""
    writer = df.write.mode("overwrite").option("header", "true").option("nullValue", null_value)
    if timestamp_format:
        writer = writer.option("timestampFormat", timestamp_format)
    writer.csv(path)


def write_predictions(df: DataFrame, path: str, key: str, prediction: str,
                      fmt: str = "csv") -> None:
    """Write ``(key, prediction)`` only, one file per partition (no driver collect)."""
    out = df.select(key, prediction)
    if fmt == "csv":
        write_csv(out, path)
    else:
        out.write.mode("overwrite").format(fmt).save(path)
