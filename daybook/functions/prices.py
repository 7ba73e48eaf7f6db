"""Prices, their keys, and what an amount is worth."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.constants import (
    BASE_UNITS_PER_TOKEN,
    COIN_IDS,
    HISTORY_DATE_FORMAT,
    HISTORY_PARAMS,
    HISTORY_URL,
    QUOTE_DATE_FORMAT,
    QUOTE_KEY,
    STABLECOINS,
    SUCCESS_STATUS,
)
from daybook.functions.dates import date_text


def usable(price: Column | str) -> Column:
    """The price, or NULL where it is zero."""
    price = F.col(price) if isinstance(price, str) else price
    return F.when(price != 0, price)


def is_pegged(symbol: Column | str) -> Column:
    symbol = F.col(symbol) if isinstance(symbol, str) else symbol
    return symbol.isin(*STABLECOINS)


def is_quoted(symbol: Column | str, coin_ids: Mapping[str, str] = COIN_IDS) -> Column:
    """Whether the quote provider knows the symbol."""
    symbol = F.col(symbol) if isinstance(symbol, str) else symbol
    return symbol.isin(*coin_ids)


def coin_id(symbol: Column | str, coin_ids: Mapping[str, str] = COIN_IDS) -> Column:
    """Provider's identifier of a symbol; NULL if it has none."""
    pairs = [F.lit(text) for pair in coin_ids.items() for text in pair]
    return F.try_element_at(F.create_map(*pairs), F.col(symbol) if isinstance(symbol, str) else symbol)


def tokens(symbol: Column, raw_volume: Column) -> Column:
    """Volume in whole tokens where the raw volume is in base units."""
    whole = raw_volume
    for name, units in BASE_UNITS_PER_TOKEN.items():
        whole = F.when(symbol == name, raw_volume / F.lit(units)).otherwise(whole)
    return whole


def usd_value(symbol: Column | str, raw_volume: Column | str, price: Column | str) -> Column:
    """Worth of a raw volume; stablecoins at face value, NULL without a price."""
    symbol = F.col(symbol) if isinstance(symbol, str) else symbol
    raw_volume = F.col(raw_volume) if isinstance(raw_volume, str) else raw_volume
    price = F.col(price) if isinstance(price, str) else price
    return F.when(is_pegged(symbol), raw_volume).otherwise(tokens(symbol, raw_volume) * price)


def response_price(status_code: Column | str, body: Column | str) -> Column:
    """Dollar price in a historical-quote response; NULL unless it succeeded and has one."""
    status_code = F.col(status_code) if isinstance(status_code, str) else status_code
    answer = F.from_json(body, "market_data struct<current_price: struct<usd: string>>")
    price = answer["market_data"]["current_price"]["usd"].try_cast("double")
    return F.when(status_code == SUCCESS_STATUS, price)


def _filled(template: str, **values: Column) -> Column:
    """Template text with each ``{name}`` replaced by a column."""
    text = F.lit(template)
    for name, value in values.items():
        text = F.replace(text, F.lit("{" + name + "}"), value)
    return text


def quote_key(symbol: Column | str, day: Column | str) -> Column:
    """Name under which the quote of a day is stored."""
    symbol = F.col(symbol) if isinstance(symbol, str) else symbol
    return _filled(QUOTE_KEY, date=date_text(day, QUOTE_DATE_FORMAT), symbol=symbol)


def request_url(provider_id: Column | str, day: Column | str) -> Column:
    """Address that answers with the historical quote of a day."""
    provider_id = F.col(provider_id) if isinstance(provider_id, str) else provider_id
    return _filled(
        f"{HISTORY_URL}?{HISTORY_PARAMS}",
        date=date_text(day, HISTORY_DATE_FORMAT),
        coin_id=provider_id,
    )
