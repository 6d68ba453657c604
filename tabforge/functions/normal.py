"""Inverse standard normal CDF as a native Column expression.

Wichura's algorithm AS 241 (PPND16, Applied Statistics 37, 1988), accurate to
about 1e-16: a rational approximation in three regions.  Written with Column
arithmetic so it runs inside whole-stage codegen instead of a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# AS 241 coefficients, highest power first (numerator, denominator).
_CENTRAL_NUM = [2.5090809287301226727e+3, 3.3430575583588128105e+4, 6.7265770927008700853e+4,
                4.5921953931549871457e+4, 1.3731693765509461125e+4, 1.9715909503065514427e+3,
                1.3314166789178437745e+2, 3.3871328727963666080e+0]
_CENTRAL_DEN = [5.2264952788528545610e+3, 2.8729085735721942674e+4, 3.9307895800092710610e+4,
                2.1213794301586595867e+4, 5.3941960214247511077e+3, 6.8718700749205790830e+2,
                4.2313330701600911252e+1, 1.0]
_NEAR_NUM = [7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1,
             1.27045825245236838258e+0, 3.64784832476320460504e+0, 5.76949722146069140550e+0,
             4.63033784615654529590e+0, 1.42343711074968357734e+0]
_NEAR_DEN = [1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2,
             1.48103976427480074590e-1, 6.89767334985100004550e-1, 1.67638483018380384940e+0,
             2.05319162663775882187e+0, 1.0]
_TAIL_NUM = [2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3,
             2.65321895265761230930e-2, 2.96560571828504891230e-1, 1.78482653991729133580e+0,
             5.46378491116411436990e+0, 6.65790464350110377720e+0]
_TAIL_DEN = [2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5,
             7.86869131145613259100e-4, 1.48753612908506148525e-2, 1.36929880922735805310e-1,
             5.99832206555887937690e-1, 1.0]


def _poly(coefs: list[float], r: Column) -> Column:
    acc = F.lit(coefs[0])
    for c in coefs[1:]:
        acc = acc * r + F.lit(c)
    return acc


def norm_ppf(p: Column) -> Column:
    """Quantile of the standard normal distribution for ``0 < p < 1``."""
    q = p - F.lit(0.5)
    r_c = F.lit(0.180625) - q * q
    central = q * _poly(_CENTRAL_NUM, r_c) / _poly(_CENTRAL_DEN, r_c)
    r = F.sqrt(-F.log(F.least(p, F.lit(1.0) - p)))
    near = _poly(_NEAR_NUM, r - F.lit(1.6)) / _poly(_NEAR_DEN, r - F.lit(1.6))
    tail = _poly(_TAIL_NUM, r - F.lit(5.0)) / _poly(_TAIL_DEN, r - F.lit(5.0))
    outer = F.when(r <= F.lit(5.0), near).otherwise(tail)
    signed = F.when(q < 0, -outer).otherwise(outer)
    return F.when(F.abs(q) <= F.lit(0.425), central).otherwise(signed)


def add_norm_ppf(df: DataFrame, p: str, out: str) -> DataFrame:
    """``out = norm_ppf(p)`` computed in stages.

    The intermediate terms are separate columns so each polynomial refers to
    a column instead of repeating the whole sub-expression, which keeps the
    generated code small.
    """
    staged = df.withColumns({
        "_ppf_q": F.col(p) - F.lit(0.5),
        "_ppf_r": F.sqrt(-F.log(F.least(F.col(p), F.lit(1.0) - F.col(p)))),
    }).withColumns({
        "_ppf_rc": F.lit(0.180625) - F.col("_ppf_q") * F.col("_ppf_q"),
        "_ppf_r1": F.col("_ppf_r") - F.lit(1.6),
        "_ppf_r5": F.col("_ppf_r") - F.lit(5.0),
    })
    q, r = F.col("_ppf_q"), F.col("_ppf_r")
    rc, r1, r5 = F.col("_ppf_rc"), F.col("_ppf_r1"), F.col("_ppf_r5")
    central = q * _poly(_CENTRAL_NUM, rc) / _poly(_CENTRAL_DEN, rc)
    near = _poly(_NEAR_NUM, r1) / _poly(_NEAR_DEN, r1)
    tail = _poly(_TAIL_NUM, r5) / _poly(_TAIL_DEN, r5)
    outer = F.when(r <= F.lit(5.0), near).otherwise(tail)
    value = F.when(F.abs(q) <= F.lit(0.425), central).otherwise(F.when(q < 0, -outer).otherwise(outer))
    return staged.withColumn(out, value).drop("_ppf_q", "_ppf_r", "_ppf_rc", "_ppf_r1", "_ppf_r5")
