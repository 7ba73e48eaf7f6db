"""The ``events`` test table seen as transactions, quotes and quote responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.constants import BASE_UNITS_PER_TOKEN
from daybook.functions.json_fields import member_or, with_member
from daybook.functions.numbers import number

# --- fixed values: how event types stand for currencies, and which days have a quote ---
CURRENCY_OF = {
    "purchase": "MATIC",
    "click": "SFL",
    "view": "USDC",
    "signup": "USDC.E",
    "error": "WETH",
}
QUOTED_DAYS = {
    "MATIC": (2, 6, 10, 14, 18, 22, 26, 30),
    "SFL": (2, 5, 8, 11, 14, 17, 20, 23, 26, 29),
}
DAY_WITHOUT_PRICE = {"MATIC": 10, "SFL": 17}
FAILED_RESPONSE_DAYS = (3, 10, 24)
EMPTY_RESPONSE_DAY = 7
# --- end of fixed values ---


def currency() -> Column:
    pairs = [F.lit(text) for pair in CURRENCY_OF.items() for text in pair]
    return F.create_map(*pairs)[F.col("event_type")]


def event_date() -> Column:
    return F.to_date("ts")


def event_transactions(events: DataFrame) -> DataFrame:
    """Extracted transactions: the amount is the event's ``k``, in base units where there are any."""
    rows = with_member(events, "k", "props", "k").select(
        event_date().alias("date"),
        (F.col("user_id") % 10).alias("project_id"),
        currency().alias("currency_symbol"),
        number(member_or("k", "0")).alias("amount"),
    )
    amount = F.col("amount")
    for symbol, units in BASE_UNITS_PER_TOKEN.items():
        amount = amount * F.when(F.col("currency_symbol") == symbol, units).otherwise(1.0)
    return rows.withColumn("amount", amount)


def event_records(events: DataFrame, base_units: bool = True) -> DataFrame:
    """The same transactions as raw records with their JSON cells."""
    amount = F.get_json_object("props", "$.k")
    if base_units:
        amount = F.when(
            currency().isin(*BASE_UNITS_PER_TOKEN), F.concat(amount, F.lit("0" * 18))
        ).otherwise(amount)
    return events.select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"),
        (F.col("user_id") % 10).cast("string").alias("project_id"),
        F.to_json(F.struct(currency().alias("currencySymbol"))).alias("props"),
        F.to_json(F.struct(amount.alias("currencyValueDecimal"))).alias("nums"),
    )


def event_quotes(events: DataFrame) -> DataFrame:
    """A quote on some days only; on one of them without a price."""
    day = F.day("date")
    symbol = F.col("symbol")
    quoted = F.lit(False)
    without_price = F.lit(False)
    for name, days in QUOTED_DAYS.items():
        quoted = quoted | ((symbol == name) & day.isin(*days))
        without_price = without_price | ((symbol == name) & (day == DAY_WITHOUT_PRICE[name]))
    return (
        events.select(currency().alias("symbol"), event_date().alias("date"), "value")
        .where(quoted)
        .groupBy("symbol", "date")
        .agg(F.max("value").alias("highest"))
        .select("symbol", "date", F.when(~without_price, F.col("highest")).alias("price"))
    )


def event_responses(events: DataFrame) -> DataFrame:
    """An answer of the quote provider for every day: some failed, one day's are empty."""
    day = F.day("date")
    price = F.struct(F.col("lowest").alias("usd"))
    body = F.struct(F.struct(price.alias("current_price")).alias("market_data"))
    return (
        events.select(currency().alias("symbol"), event_date().alias("date"), "value")
        .where(F.col("symbol").isin(*QUOTED_DAYS))
        .groupBy("symbol", "date")
        .agg(F.min("value").alias("lowest"))
        .select(
            "symbol",
            "date",
            F.when(day.isin(*FAILED_RESPONSE_DAYS), 404).otherwise(200).alias("status_code"),
            F.when(day == EMPTY_RESPONSE_DAY, F.lit("{}"))
            .otherwise(F.to_json(body))
            .alias("body"),
        )
    )
