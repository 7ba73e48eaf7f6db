"""Which quotes are missing, and adding fetched ones to the stored ones."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.constants import COIN_IDS
from daybook.functions.prices import coin_id, is_pegged, is_quoted, quote_key, request_url, usable


def missing_quotes(
    keys: DataFrame, quotes: DataFrame, coin_ids: Mapping[str, str] = COIN_IDS
) -> DataFrame:
    """Worklist of quotes to fetch: known to the provider, not pegged, no usable quote stored."""
    stored = quotes.where(usable("price").isNotNull()).select(
        F.col("symbol").alias("currency_symbol"), "date"
    )
    wanted = (
        keys.select("currency_symbol", "date")
        .where(is_quoted("currency_symbol", coin_ids) & ~is_pegged("currency_symbol"))
        .distinct()
    )
    return (
        wanted.join(stored, ["currency_symbol", "date"], "left_anti")
        .withColumn("coin_id", coin_id("currency_symbol", coin_ids))
        .select(
            F.col("currency_symbol").alias("symbol"),
            "date",
            "coin_id",
            request_url("coin_id", "date").alias("request_url"),
            quote_key("currency_symbol", "date").alias("quote_key"),
        )
    )


def one_quote_a_day(quotes: DataFrame) -> DataFrame:
    """One quote per symbol and date: of several, the lowest usable one.

    Rows are dealt by symbol, so that windows per symbol need no further shuffle.
    """
    has_price = F.when(usable("price").isNotNull(), 0).otherwise(1)
    return (
        quotes.repartition("symbol")
        .groupBy("symbol", "date")
        .agg(F.min_by("price", F.struct(has_price, "price")).alias("price"))
    )


def merged_quotes(stored: DataFrame, fetched: DataFrame) -> DataFrame:
    """One quote per symbol and date.

    A usable stored quote stays; an unusable one gives way to a usable fetched one; unusable
    fetched quotes are ignored. Of several fetched for one key the lowest is taken, so that
    repeated runs agree.
    """
    has_price = usable("price").isNotNull()
    columns = ("symbol", "date", "price")
    candidates = stored.select(
        *columns, F.when(has_price, 0).otherwise(2).alias("rank")
    ).unionByName(fetched.select(*columns, F.when(has_price, 1).otherwise(3).alias("rank")))
    best = candidates.groupBy("symbol", "date").agg(
        F.min_by("price", F.struct("rank", "price")).alias("price"),
        F.min("rank").alias("rank"),
    )
    # Left over are keys with unusable fetched quotes only. Dropping those quotes earlier would
    # parse each response once more for the filter.
    return best.where(F.col("rank") < 3).drop("rank")
