"""Small models: line fit by sums, random forest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numeric import round_even
from ledgerloom.operators import forest


def linear_fit(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Intercept ``a`` and slope ``b`` of the least squares line, rounded to 4 digits."""
    return (
        df.groupBy(*keys)
        .agg(F.regr_intercept(y, x).alias("a"), F.regr_slope(y, x).alias("b"))
        .select(*keys, round_even(F.col("a"), 4).alias("a"), round_even(F.col("b"), 4).alias("b"))
    )


def linear_predict(df: DataFrame, fit: DataFrame, x: str, name: str = "predicted") -> DataFrame:
    """``a + b*x`` of a one-row fit, rounded to 3 digits."""
    line = fit.select(F.struct("a", "b").alias("s")).scalar()
    value = F.col("__fit.a") + F.col("__fit.b") * F.col(x)
    return df.withColumn("__fit", line).withColumn(name, round_even(value, 3)).drop("__fit")


def prediction_error(df: DataFrame, y: str, predicted: str) -> DataFrame:
    """Sum of squared errors (each rounded to 3 digits) and root mean squared error."""
    error = F.col(y) - F.col(predicted)
    return df.agg(
        F.sum(round_even(error * error, 3)).alias("squared_errors"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )


def one_hot(column: str, values: Sequence, prefix: str | None = None) -> list[Column]:
    """A 0/1 column per value."""
    prefix = column if prefix is None else prefix
    return [
        F.when(F.col(column) == F.lit(value), 1).otherwise(0).alias(f"{prefix}_{value}")
        for value in values
    ]


def fit_forest(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    trees: int = 100,
    max_depth: int = 30,
    seed: int = 1,
) -> forest.Forest:
    """Random forest on numeric or vector features and a text target.

    Trees grow until their leaves are pure, or to the depth given.
    """
    return forest.fit_forest(df, list(features), target, trees, max_depth, seed)


def forest_predict(model: forest.Forest, df: DataFrame) -> DataFrame:
    """The rows with a ``predicted`` class."""
    return forest.forest_predict(model, df)
