"""New prices for metrics rows that exist already."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook import schemas
from daybook.constants import COIN_IDS
from daybook.functions.prices import usd_value
from daybook.operators.pricing import with_prices

_VALUES = ("price", "price_source", "usd_volume")


def on_dates(metrics: DataFrame, days: DataFrame) -> DataFrame:
    """Metrics rows of the dates in ``days``, a few rows with one column.

    The join is on the partition column, so only the folders of these dates are read: Spark prunes
    them when the days are known. A metrics table has at most one partition per day, which bounds the
    side that is broadcast.
    """
    wanted = days.select("date").where(F.col("date") >= F.lit("0001-01-01").cast("date"))
    return metrics.join(F.broadcast(wanted), "date", "left_semi").select(*metrics.columns)


def updated(metrics: DataFrame, valuations: DataFrame) -> DataFrame:
    """Metrics with price and dollar value taken from ``valuations`` where those have a price.

    Rows without a match, or matched by a group without a price, stay as they are. Every copy
    of a row that was appended twice is updated. Of several valuations of a key the one with
    the lowest price is taken, as for quotes.
    """
    lowest = F.min(F.struct(*_VALUES))
    new = (
        valuations.where(F.col("price").isNotNull())
        .groupBy(*schemas.METRICS_KEY)
        .agg(lowest.alias("new"))
        .select(*schemas.METRICS_KEY, *[F.col(f"new.{name}").alias(f"new_{name}") for name in _VALUES])
    )
    matched = metrics.join(new, list(schemas.METRICS_KEY), "left")
    values = {name: F.coalesce(F.col(f"new_{name}"), F.col(name)) for name in _VALUES}
    return matched.withColumns(values).select(*metrics.columns)


def repriced(
    metrics: DataFrame, quotes: DataFrame, coin_ids: Mapping[str, str] = COIN_IDS
) -> DataFrame:
    """Metrics valued again from their raw volumes; rows without a price stay as they are.

    Same outcome as ``updated`` with fresh valuations, but the rows are not joined to themselves.
    """
    former = metrics.withColumnsRenamed({name: f"former_{name}" for name in _VALUES})
    fresh = with_prices(former, quotes, coin_ids).withColumn(
        "usd_volume", usd_value("currency_symbol", "raw_volume", "price")
    )
    found = F.col("price").isNotNull()
    values = [
        F.when(found, F.col(name)).otherwise(F.col(f"former_{name}")).alias(name)
        for name in _VALUES
    ]
    kept = [name for name in metrics.columns if name not in _VALUES]
    return fresh.select(*kept, *values).select(*metrics.columns)
