"""ML on tables: vector assembly, linear regression fit / predict / summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import threshold
from tessera.operators.sample import split_by_hash
from tessera.plans import ml as M
from tessera.queries import register
from tessera.queries import sqlbits as S
from tessera.sources.tables import table as T

FEATURES = ("l_quantity", "l_discount", "l_tax")


def _lines(spark, sf):
    return T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice",
                                           *FEATURES)


@register("ml_assemble", """SELECT l_orderkey, l_linenumber, l_quantity AS f0, l_discount AS f1,
  l_tax AS f2, 3 AS n_features FROM lineitem""")
def ml_assemble(spark, sf):
    v = M.features_as_array(M.assemble(_lines(spark, sf), FEATURES))
    return v.select("l_orderkey", "l_linenumber", *[F.col("features")[i].alias(f"f{i}")
                                                      for i in range(len(FEATURES))],
                    F.size("features").alias("n_features"))


@register("ml_linreg_simple", """SELECT ROUND(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
  ROUND(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem""")
def ml_linreg_simple(spark, sf):
    """One feature: the fitted line equals the closed-form least squares."""
    model = M.fit_linear(M.assemble(_lines(spark, sf), ["l_quantity"]), "l_extendedprice")
    return M.model_summary(spark, model).select(
        F.round(F.col("coefficients")[0], 4).alias("slope"),
        F.round("intercept", 4).alias("intercept"))


_TRAIN = f"{S.draw('l_orderkey', 42)} < {threshold(0.8)}"
_FIT = f"""fit AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b,
  COUNT(*) AS n, regr_r2(l_extendedprice, l_quantity) AS r2 FROM lineitem WHERE {_TRAIN})"""


def _split(spark, sf, inputs):
    return split_by_hash(M.assemble(_lines(spark, sf), inputs), "l_orderkey", [0.8, 0.2], salt=42)


@register("ml_linreg", S.with_ctes(f"""SELECT l_orderkey, l_linenumber, l_extendedprice,
  round(a * l_quantity + b, 2) AS prediction FROM lineitem, fit WHERE NOT ({_TRAIN})""", _FIT))
def ml_linreg(spark, sf):
    """Fit one feature on the 80% part, predict the 20% part (one row per
    test line)."""
    train, test = _split(spark, sf, ["l_quantity"])
    model = M.fit_linear(train, "l_extendedprice")
    return model.transform(test).select("l_orderkey", "l_linenumber", "l_extendedprice",
                                        F.round("prediction", 2).alias("prediction"))


@register("ml_linreg_summary", S.with_ctes(f"""SELECT round(any_value(a), 4) AS slope, round(any_value(b), 4) AS intercept,
  round(sqrt(avg(power(l_extendedprice - a * l_quantity - b, 2))), 4) AS rmse, round(any_value(r2), 6) AS r2,
  any_value(n) AS n FROM lineitem, fit WHERE {_TRAIN}""", _FIT))
def ml_linreg_summary(spark, sf):
    train, _ = _split(spark, sf, ["l_quantity"])
    return M.model_summary(spark, M.fit_linear(train, "l_extendedprice")).select(
        F.round(F.col("coefficients")[0], 4).alias("slope"), F.round("intercept", 4).alias("intercept"),
        F.round("rmse", 4).alias("rmse"), F.round("r2", 6).alias("r2"), "n")


@register("ml_linreg_multi", f"""SELECT COUNT(*) AS n_test, TRUE AS near_or_below_mean FROM lineitem WHERE NOT ({_TRAIN})""")
def ml_linreg_multi(spark, sf):
    """Three features: on the held-out lines the squared error is at most a hundredth
    above that of the mean (below it where the features tell anything)."""
    train, test = _split(spark, sf, FEATURES)
    y = F.col("l_extendedprice")
    out = M.fit_linear(train, "l_extendedprice").transform(test)
    return out.agg(F.count(F.lit(1)).alias("n_test"),
                   (F.avg((y - F.col("prediction")) ** 2) <= F.var_pop(y) * 1.01).alias("near_or_below_mean"))
