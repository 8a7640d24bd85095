"""Ordinary least squares in closed form from aggregate moments.

One aggregation pass yields the (co)variances; the normal equations for one
or two regressors are solved on that single row. This equals
``LinearRegression(solver="normal")`` and ``numpy.linalg.lstsq`` without
moving any row to the driver. (For many regressors use
``pyspark.ml.regression.LinearRegression`` — see ``operators.models``.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ieee_divide


def ols1(df: DataFrame, y: str, x: str) -> DataFrame:
    """y = a + b·x: slope, intercept, R² and n."""
    return df.agg(F.regr_slope(y, x).alias(f"coef_{x}"), F.regr_intercept(y, x).alias("intercept"),
                  F.regr_r2(y, x).alias("r2"), F.count(F.lit(1)).alias("n"))


def ols2(df: DataFrame, y: str, x1: str, x2: str,
         names: tuple[str, str] | None = None) -> DataFrame:
    """y = a + b1·x1 + b2·x2 from population (co)variances. Regressors that are constant or proportional have no single
    solution: their coefficients are not a number (or infinite), as IEEE division gives, not an error."""
    n1, n2 = names or (f"coef_{x1}", f"coef_{x2}")
    m = df.agg(F.covar_pop(y, x1).alias("syc"), F.covar_pop(y, x2).alias("syd"),
               F.var_pop(x1).alias("scc"), F.var_pop(x2).alias("sdd"),
               F.covar_pop(x1, x2).alias("scd"), F.avg(y).alias("my"), F.avg(x1).alias("mc"),
               F.avg(x2).alias("md"), F.var_pop(y).alias("syy"), F.count(F.lit(1)).alias("n"))
    det = F.col("scc") * F.col("sdd") - F.col("scd") * F.col("scd")
    b1 = ieee_divide(F.col("syc") * F.col("sdd") - F.col("syd") * F.col("scd"), det)
    b2 = ieee_divide(F.col("syd") * F.col("scc") - F.col("syc") * F.col("scd"), det)
    m = m.select("*", b1.alias("b1"), b2.alias("b2"))
    return m.select(
        F.col("b1").alias(n1), F.col("b2").alias(n2),
        (F.col("my") - F.col("b1") * F.col("mc") - F.col("b2") * F.col("md")).alias("intercept"),
        ieee_divide(F.col("b1") * F.col("syc") + F.col("b2") * F.col("syd"), F.col("syy")).alias("r2"),
        "n")
