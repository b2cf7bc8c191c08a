"""Derived daily variables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_dtr(df: DataFrame) -> DataFrame:
    """Daily temperature range in K; NULL if either temperature is."""
    return df.withColumn("dtr", F.col("tasmax") - F.col("tasmin"))


def with_tasmin_from_dtr(df: DataFrame) -> DataFrame:
    """Rebuild tasmin after tasmax and dtr were adjusted; ``dtr`` is dropped."""
    return df.withColumn("tasmin", F.col("tasmax") - F.col("dtr")).drop("dtr")


def with_tas(df: DataFrame) -> DataFrame:
    """Mean daily temperature, defined here as the mean of tasmin and tasmax."""
    return df.withColumn("tas", (F.col("tasmin") + F.col("tasmax")) / 2)
