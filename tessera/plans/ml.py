"""Linear regression on tables with Spark ML (distributed fitting)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def assemble(df: DataFrame, inputs: Sequence[str], output: str = "features") -> DataFrame:
    """Numeric columns -> one vector column (rows with nulls are skipped)."""
    return VectorAssembler(inputCols=list(inputs), outputCol=output,
                           handleInvalid="skip").transform(df)


def fit_linear(train: DataFrame, label: str, features: str = "features",
               solver: str = "normal") -> LinearRegressionModel:
    """Least squares, no regularisation.  ``normal`` solves the normal
    equations from one distributed aggregate of the Gram matrix."""
    return LinearRegression(labelCol=label, featuresCol=features, solver=solver,
                            regParam=0.0).fit(train)


def model_summary(spark: SparkSession, model: LinearRegressionModel) -> DataFrame:
    """Coefficients, intercept and training RMSE as a one-row DataFrame."""
    s = model.summary
    return spark.createDataFrame(
        [(list(map(float, model.coefficients)), float(model.intercept),
          float(s.rootMeanSquaredError), float(s.r2), int(s.numInstances))],
        "coefficients ARRAY<DOUBLE>, intercept DOUBLE, rmse DOUBLE, r2 DOUBLE, n BIGINT")


def features_as_array(df: DataFrame, column: str = "features") -> DataFrame:
    return df.withColumn(column, vector_to_array(F.col(column)))
