"""Which price holds, against a row-by-row statement of the rules."""

from __future__ import annotations

import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook import schemas
from daybook.functions.numbers import plain_cents, with_cents
from daybook.functions.prices import coin_id, response_price, usable, usd_value
from daybook.operators.pricing import exact_prices, last_known_prices, with_prices
from daybook.operators.quote_store import merged_quotes, missing_quotes
from daybook.operators.updates import updated

EPOCH = datetime.date(2024, 1, 1)
SYMBOLS = ["USDC", "USDC.E", "MATIC", "SFL", "WETH", "", "matic"]
symbols = st.sampled_from(SYMBOLS)
days = st.integers(0, 25).map(lambda n: EPOCH + datetime.timedelta(days=n))
prices = st.sampled_from([None, 0.0, 0.5, 1.25, 3.0])
quotes_of_cases = st.dictionaries(st.tuples(symbols, days), prices, max_size=40)
keys_of_cases = st.sets(st.tuples(symbols, days), min_size=1, max_size=40)
relaxed = settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def newest_before(quotes, symbol, day):
    earlier = [d for s, d in quotes if s == symbol and d < day]
    return quotes[symbol, max(earlier)] if earlier else None


def rule(quotes, symbol, day):
    if symbol in ("USDC", "USDC.E"):
        return 1.0, "peg"
    if quotes.get((symbol, day)):
        return quotes[symbol, day], "exact"
    if symbol in ("MATIC", "SFL") and newest_before(quotes, symbol, day):
        return newest_before(quotes, symbol, day), "last_known"
    return None, "unpriced"


def quote_frame(spark, quotes):
    return spark.createDataFrame([(s, d, p) for (s, d), p in quotes.items()], schemas.QUOTES)


def key_frame(spark, keys):
    return spark.createDataFrame(list(keys), "currency_symbol string, date date")


@relaxed
@given(quotes_of_cases, keys_of_cases)
def test_with_prices(spark, quotes, keys):
    rows = with_prices(key_frame(spark, keys), quote_frame(spark, quotes)).collect()
    assert {(r.currency_symbol, r.date): (r.price, r.price_source) for r in rows} == {
        key: rule(quotes, *key) for key in keys
    }
    assert len(rows) == len(keys)


@relaxed
@given(st.lists(st.tuples(symbols, days, prices), max_size=40), keys_of_cases)
def test_with_prices_of_repeated_quotes(spark, quotes, keys):
    """Of several quotes for a symbol and day the lowest usable one counts."""
    first = {}
    for symbol, day, price in sorted(quotes, key=lambda q: (not q[2], q[2] or 0)):
        first.setdefault((symbol, day), price)
    frame = spark.createDataFrame(quotes, schemas.QUOTES)
    rows = with_prices(key_frame(spark, keys), frame).collect()
    assert {(r.currency_symbol, r.date): (r.price, r.price_source) for r in rows} == {
        key: rule(first, *key) for key in keys
    }
    assert len(rows) == len(keys)


def test_two_quotes_of_a_day_do_not_reach_the_day_before(spark):
    day = EPOCH + datetime.timedelta(days=9)
    quotes = spark.createDataFrame([("SFL", day, 0.7), ("SFL", day, 0.5)], schemas.QUOTES)
    keys = key_frame(spark, {("SFL", day), ("SFL", day - datetime.timedelta(days=1))})
    rows = with_prices(keys, quotes).orderBy("date").collect()
    assert [(r.price, r.price_source) for r in rows] == [(None, "unpriced"), (0.5, "exact")]


def test_a_key_valued_twice_is_updated_once(spark):
    row = (7, "SFL", 1, 2.0, None, "unpriced", None, EPOCH)
    metrics = spark.createDataFrame([row], schemas.METRICS)
    twice = [(7, "SFL", 1, 2.0, price, "exact", 2 * price, EPOCH) for price in (0.7, 0.5)]
    rows = updated(metrics, spark.createDataFrame(twice, schemas.METRICS)).collect()
    assert [(r.price, r.usd_volume) for r in rows] == [(0.5, 1.0)]


@relaxed
@given(quotes_of_cases, keys_of_cases)
def test_lookups(spark, quotes, keys):
    keys_, quotes_ = key_frame(spark, keys), quote_frame(spark, quotes)
    exact = {(r.currency_symbol, r.date): r.price for r in exact_prices(keys_, quotes_).collect()}
    assert exact == {key: quotes.get(key) or None for key in keys}
    every = dict.fromkeys(SYMBOLS, "id")
    earlier = last_known_prices(keys_, quotes_, every).collect()
    assert {(r.currency_symbol, r.date): r.price for r in earlier} == {
        key: newest_before(quotes, *key) or None for key in keys
    }
    missing = missing_quotes(keys_, quotes_).collect()
    assert {(r.symbol, r.date) for r in missing} == {
        key for key in keys if key[0] in ("MATIC", "SFL") and not quotes.get(key)
    }


@pytest.mark.parametrize("broadcast_limit", ["10485760", "-1"])
def test_prices_do_not_depend_on_the_join_strategy(spark, broadcast_limit):
    quotes = {("MATIC", EPOCH): 1.25, ("SFL", EPOCH): None, ("WETH", EPOCH): 3.0}
    keys = {(s, EPOCH + datetime.timedelta(days=n)) for s in SYMBOLS for n in range(-1, 3)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast_limit)
    try:
        rows = with_prices(key_frame(spark, keys), quote_frame(spark, quotes)).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {(r.currency_symbol, r.date): (r.price, r.price_source) for r in rows} == {
        key: rule(quotes, *key) for key in keys
    }


def test_other_symbols_of_the_provider(spark):
    quotes = quote_frame(spark, {("WETH", EPOCH): 3000.0})
    keys = key_frame(spark, {("WETH", EPOCH + datetime.timedelta(days=3))})
    assert with_prices(keys, quotes).first().price_source == "unpriced"
    assert with_prices(keys, quotes, {"WETH": "weth"}).first().price == 3000.0


@relaxed
@given(quotes_of_cases, st.lists(st.tuples(symbols, days, prices), max_size=30))
def test_merged_quotes(spark, stored, fetched):
    merged = merged_quotes(
        quote_frame(spark, stored), spark.createDataFrame(fetched, schemas.QUOTES)
    ).collect()
    expected = dict(stored)
    for symbol, day, price in sorted(f for f in fetched if f[2]):
        if not expected.get((symbol, day)):
            expected[symbol, day] = price
    assert {(r.symbol, r.date): r.price for r in merged} == expected
    assert len(merged) == len(expected)


def values(spark, **columns):
    return spark.range(1).select(*[column.alias(name) for name, column in columns.items()]).first()


def test_usd_value(spark):
    def worth(symbol, raw, price):
        return usd_value(F.lit(symbol), F.lit(raw), F.lit(price).cast("double"))

    row = values(
        spark,
        matic=worth("MATIC", 2e18, 0.5),
        peg=worth("USDC.E", 3.25, 1.0),
        other=worth("SFL", 2.0, 0.05),
        none=worth("SFL", 2.0, None),
        zero=usable(F.lit(0.0)),
        known=coin_id(F.lit("SFL")),
        unknown=coin_id(F.lit("sfl")),
    )
    assert tuple(row) == (1.0, 3.25, 0.1, None, None, "sunflower-land", None)


def test_text_of_dollars(spark):
    texts = {
        1234567.375: "1,234,567.38", 0.125: "0.12", 0.135: "0.14", -5.0: "-5.00", 1e15: None,
        0.0: "0.00", None: "nan",
    }
    for value, text in texts.items():
        row = values(
            spark,
            separated=with_cents(F.lit(value).cast("double")),
            plain=plain_cents(F.lit(value).cast("double")),
        )
        expected = "nan" if value is None else f"{value:,.2f}"
        assert text in (None, expected)
        assert tuple(row) == (expected, expected.replace(",", ""))


@pytest.mark.parametrize(
    ("status", "body", "price"),
    [
        (200, '{"market_data":{"current_price":{"usd":0.7213,"eur":0.6}}}', 0.7213),
        (200, '{"market_data":{"current_price":{"usd":"2"}}}', 2.0),
        (200, '{"market_data":{"current_price":{"usd":null}}}', None),
        (200, '{"market_data":{"current_price":{}}}', None),
        (200, '{"market_data":null}', None),
        (200, "{}", None),
        (200, "<html>", None),
        (200, None, None),
        (429, '{"market_data":{"current_price":{"usd":0.7}}}', None),
        (None, '{"market_data":{"current_price":{"usd":0.7}}}', None),
    ],
)
def test_response_price(spark, status, body, price):
    frame = spark.createDataFrame([(status, body)], "status_code int, body string")
    assert frame.select(response_price("status_code", "body").alias("p")).first().p == price
