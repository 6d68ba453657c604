"""Error metrics as one-row aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.functions.nullsafe import qcol


def rmsle(df: DataFrame, label: str, prediction: str, by: list[str] | None = None) -> DataFrame:
    """``sqrt(mean((log1p y - log1p p)^2))``, optionally per group."""
    err = F.pow(F.log1p(qcol(label).cast("double")) - F.log1p(qcol(prediction).cast("double")), 2)
    agg = F.sqrt(F.avg(err)).alias("rmsle")
    return df.groupBy(*[qcol(b) for b in by]).agg(agg) if by else df.agg(agg)


def error_summary(df: DataFrame, error: str) -> DataFrame:
    """Mean, population variance and population std of an error column."""
    e = qcol(error).cast("double")
    return df.agg(F.avg(e).alias("mean"), F.var_pop(e).alias("variance"),
                  F.stddev_pop(e).alias("stdev"), F.count(e).cast("bigint").alias("n"))
