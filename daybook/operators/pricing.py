"""The price that holds for a currency on a date.

Of several quotes for one symbol and calendar day one is taken, so all rows of one symbol are few.

Volumes find their price by equality joins alone. ``price_by_day`` spreads each quote over the
days until the next quote of its symbol, so "the newest quote before this date" becomes a row
of that date; ``latest_quotes`` covers the open end after a symbol's newest quote. Both depend
on the quotes only and leave the volumes where they are if Spark sees that the quotes are small
enough to broadcast; if not, it shuffles both sides.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.constants import COIN_IDS, EXACT, LAST_KNOWN, PEG, PEG_PRICE, UNPRICED
from daybook.functions.prices import is_pegged, is_quoted, usable, usd_value
from daybook.operators.quote_store import one_quote_a_day


def _spans(quotes: DataFrame) -> DataFrame:
    """Each quote with the price before it and the day of the next one of its symbol."""
    by_date = Window.partitionBy("symbol").orderBy("date")
    return one_quote_a_day(quotes).select(
        F.col("symbol").alias("currency_symbol"),
        F.col("date").alias("quoted_on"),
        "price",
        F.lag("price").over(by_date).alias("price_before"),
        F.lead("date").over(by_date).alias("next_quoted_on"),
    )


def price_by_day(quotes: DataFrame, coin_ids: Mapping[str, str] = COIN_IDS) -> DataFrame:
    """One row per symbol and day: the quote of that day and the newest quote before it.

    Quotes of symbols the provider knows reach to the day before the next quote; others are
    there on their own day only. A newest earlier quote without a usable price stays in place
    and hides older ones.
    """
    spread = is_quoted("currency_symbol", coin_ids) & F.col("next_quoted_on").isNotNull()
    last_day = F.when(spread, F.date_sub("next_quoted_on", 1)).otherwise(F.col("quoted_on"))
    days = _spans(quotes).select("*", F.explode(F.sequence("quoted_on", last_day)).alias("date"))
    on_quoted_day = F.col("date") == F.col("quoted_on")
    return days.select(
        "currency_symbol",
        "date",
        F.when(on_quoted_day, F.col("price")).alias("exact_price"),
        F.when(on_quoted_day, F.col("price_before"))
        .otherwise(F.col("price"))
        .alias("earlier_price"),
    )


def latest_quotes(quotes: DataFrame, coin_ids: Mapping[str, str] = COIN_IDS) -> DataFrame:
    """Newest quote, usable or not, of each symbol the provider knows.

    Taken from the same spans as ``price_by_day`` and filtered after the window only, so that
    both share one shuffle of the quotes.
    """
    newest = F.when(is_quoted("currency_symbol", coin_ids), F.col("next_quoted_on").isNull())
    return (
        _spans(quotes)
        .where(newest)
        .select(
            "currency_symbol",
            F.col("quoted_on").alias("latest_date"),
            F.col("price").alias("latest_price"),
        )
    )


def with_quotes(
    frame: DataFrame, quotes: DataFrame, coin_ids: Mapping[str, str] = COIN_IDS
) -> DataFrame:
    """Adds the usable quote of the same day, and for symbols the provider knows the newest before."""
    # One row at most per entry of ``coin_ids``, hence safe to broadcast.
    latest = F.broadcast(latest_quotes(quotes, coin_ids))
    earlier = F.when(F.col("date") > F.col("latest_date"), F.col("latest_price")).otherwise(
        F.col("earlier_price")
    )
    return (
        frame.join(price_by_day(quotes, coin_ids), ["currency_symbol", "date"], "left")
        .join(latest, "currency_symbol", "left")
        .withColumns({"exact_price": usable("exact_price"), "earlier_price": usable(earlier)})
        .drop("latest_date", "latest_price")
    )


def exact_prices(keys: DataFrame, quotes: DataFrame) -> DataFrame:
    """Adds the usable quote of the same day as ``price``."""
    found = with_quotes(keys, quotes)
    return found.withColumnRenamed("exact_price", "price").drop("earlier_price")


def last_known_prices(
    keys: DataFrame, quotes: DataFrame, coin_ids: Mapping[str, str] = COIN_IDS
) -> DataFrame:
    """Adds the newest quote strictly before the day as ``price``; NULL if that is unusable.

    Only symbols the provider knows have one.
    """
    found = with_quotes(keys, quotes, coin_ids)
    known = F.when(is_quoted("currency_symbol", coin_ids), F.col("earlier_price"))
    return found.withColumn("price", known).drop("exact_price", "earlier_price")


def with_prices(
    frame: DataFrame, quotes: DataFrame, coin_ids: Mapping[str, str] = COIN_IDS
) -> DataFrame:
    """Adds ``price`` and ``price_source`` for each row's currency and date.

    Stablecoins are at par. Otherwise the quote of the day holds, for any symbol; failing
    that, for symbols the provider knows, the newest quote before the day.
    """
    symbol = F.col("currency_symbol")
    quoted = with_quotes(frame, quotes, coin_ids)
    source = (
        F.when(is_pegged(symbol), PEG)
        .when(F.col("exact_price").isNotNull(), EXACT)
        .when(is_quoted(symbol, coin_ids) & F.col("earlier_price").isNotNull(), LAST_KNOWN)
        .otherwise(UNPRICED)
    )
    price = (
        F.when(F.col("price_source") == PEG, F.lit(PEG_PRICE))
        .when(F.col("price_source") == EXACT, F.col("exact_price"))
        .when(F.col("price_source") == LAST_KNOWN, F.col("earlier_price"))
    )
    return (
        quoted.withColumn("price_source", source)
        .withColumn("price", price)
        .drop("exact_price", "earlier_price")
    )


def valued(
    volumes: DataFrame, quotes: DataFrame, coin_ids: Mapping[str, str] = COIN_IDS
) -> DataFrame:
    """Metrics rows: volumes with price, its source and the dollar value; NULL if unpriced."""
    return with_prices(volumes, quotes, coin_ids).select(
        "date",
        "project_id",
        "currency_symbol",
        "num_transactions",
        "raw_volume",
        "price",
        "price_source",
        usd_value("currency_symbol", "raw_volume", "price").alias("usd_volume"),
    )


def priced(metrics: DataFrame) -> DataFrame:
    """Metrics rows that have a price."""
    return metrics.where(F.col("price").isNotNull())
