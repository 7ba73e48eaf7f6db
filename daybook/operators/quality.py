"""Checks on the metrics table, as relations; verdicts are drawn in ``plans.validation``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook import schemas
from daybook.constants import UNPRICED
from daybook.functions.numbers import without_nan
from daybook.functions.prices import usd_value
from daybook.operators.volumes import keyed_groups


def _nulls(column: str) -> Column:
    return F.sum(F.when(F.col(column).isNull(), 1).otherwise(0)).cast("bigint")


def row_count(metrics: DataFrame) -> DataFrame:
    return metrics.agg(F.count("*").alias("row_count"))


def profile(metrics: DataFrame) -> DataFrame:
    """Rows, distinct dates and projects, rows without a dollar value (NULL for no rows)."""
    return metrics.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct("date").alias("unique_dates"),
        F.count_distinct("project_id").alias("unique_projects"),
        _nulls("usd_volume").alias("null_volumes"),
    )


def required_nulls(
    metrics: DataFrame, columns: Iterable[str] = schemas.METRICS_REQUIRED
) -> DataFrame:
    """Nulls per required column."""
    return metrics.agg(*[_nulls(name).alias(f"null_{name}") for name in columns])


def count_reconciliation(metrics: DataFrame, transactions: DataFrame) -> DataFrame:
    """Per date, transactions counted in the metrics against those in the source.

    The source side is what the metrics should count: keys present and amount not NaN.
    """
    counted = metrics.groupBy("date").agg(F.sum("num_transactions").alias("metrics_count"))
    # Grouped before keys are looked at, as a filter would parse the records again.
    groups = transactions.groupBy(*schemas.METRICS_KEY).agg(
        F.count(without_nan("amount")).alias("num_transactions")
    )
    expected = (
        keyed_groups(groups, *schemas.METRICS_KEY)
        .groupBy("date")
        .agg(F.sum("num_transactions").alias("source_count"))
    )
    return (
        expected.join(counted, "date", "full_outer")
        .na.fill(0, ["source_count", "metrics_count"])
        .withColumn("matches", F.col("source_count") == F.col("metrics_count"))
    )


def price_coverage(metrics: DataFrame) -> DataFrame:
    """Groups and transactions by how their price was found, with the share of all groups."""
    by_source = metrics.groupBy("price_source").agg(
        F.count("*").alias("groups"),
        F.sum("num_transactions").alias("num_transactions"),
    )
    # The window spans one row per price source, of which there are four.
    share = F.col("groups") / F.sum("groups").over(Window.partitionBy())
    return by_source.withColumn("share", share)


def unpriced_groups(metrics: DataFrame) -> DataFrame:
    """Groups whose price could not be found."""
    return metrics.where(F.col("price_source") == UNPRICED).select(
        *schemas.METRICS_KEY, "num_transactions", "raw_volume"
    )


def usd_mismatches(metrics: DataFrame) -> DataFrame:
    """Rows whose dollar value is not what raw volume and price give."""
    expected = usd_value("currency_symbol", "raw_volume", "price")
    return (
        metrics.withColumn("expected_usd_volume", expected)
        .where(~F.col("usd_volume").eqNullSafe(F.col("expected_usd_volume")))
        .select(*schemas.METRICS_KEY, "usd_volume", "expected_usd_volume")
    )


def duplicate_keys(
    metrics: DataFrame, keys: Iterable[str] = schemas.METRICS_KEY
) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return metrics.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)
