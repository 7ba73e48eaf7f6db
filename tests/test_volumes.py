"""Hand-made transactions with results written by hand."""

from __future__ import annotations

import datetime
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from fixtures import DAY15, DAY16, DAY17, QUOTES, VALUED

from daybook import schemas
from daybook.operators.extraction import extract
from daybook.operators.pricing import priced, valued
from daybook.operators.quote_store import missing_quotes
from daybook.operators.volumes import (
    all_volumes,
    currency_volumes,
    price_keys,
    project_metrics,
    project_metrics_of,
)
from daybook.sources.transactions import read_transactions


@pytest.fixture(scope="module")
def transactions(spark, deliveries):
    return extract(read_transactions(spark, deliveries)).cache()


PROJECT_METRICS = {
    (DAY15, 1660): (1, 3.25),
    (DAY15, 4974): (3, 2e18),
    (DAY16, 1660): (3, 17.0),
    (DAY16, 4974): (2, 4.0),
    (DAY17, 4974): (1, 1e18),
}


def by_project(frame):
    return {(r.date, r.project_id): (r.num_transactions, r.raw_volume) for r in frame.collect()}


def test_project_metrics(transactions):
    assert by_project(project_metrics(transactions)) == PROJECT_METRICS
    assert by_project(project_metrics_of(all_volumes(transactions))) == PROJECT_METRICS


def test_valued(spark, transactions):
    quotes = spark.createDataFrame(QUOTES, schemas.QUOTES)
    rows = valued(currency_volumes(transactions), quotes).collect()
    assert len(rows) == len(VALUED)
    for r in rows:
        n, raw, price, source, usd = VALUED[(r.date, r.currency_symbol, r.project_id)]
        assert (r.num_transactions, r.raw_volume, r.price, r.price_source) == (n, raw, price, source)
        assert r.usd_volume == (None if usd is None else pytest.approx(usd))
    assert priced(valued(currency_volumes(transactions), quotes)).count() == 5


def test_missing_quotes(spark, transactions):
    quotes = spark.createDataFrame(QUOTES, schemas.QUOTES)
    rows = missing_quotes(price_keys(currency_volumes(transactions)), quotes).collect()
    assert {(r.symbol, r.date) for r in rows} == {("SFL", DAY16), ("MATIC", DAY15), ("MATIC", DAY17)}
    sfl = next(r for r in rows if r.symbol == "SFL")
    assert sfl.coin_id == "sunflower-land"
    assert sfl.quote_key == "prices/SFL/2024-04-16.json"
    assert sfl.request_url.endswith("/sunflower-land/history?date=16-04-2024&localization=false")


def test_nan_amounts_are_skipped(spark):
    frame = spark.createDataFrame(
        [
            (DAY15, 1, "SFL", 1.0),
            (DAY15, 1, "SFL", math.nan),
            (DAY15, 2, "SFL", math.nan),
        ],
        schemas.TRANSACTIONS,
    )
    expected = {(DAY15, 1): (1, 1.0), (DAY15, 2): (0, 0.0)}
    assert by_project(project_metrics(frame)) == expected
    assert by_project(currency_volumes(frame)) == expected


amounts = st.lists(
    st.one_of(
        st.floats(-1e6, 1e6),
        st.integers(0, 10**7).map(lambda n: n * 1e18),
        st.floats(0, 1e-9),
        st.integers(0, 50).map(lambda n: n * 1e-18),
        st.floats(0, 1e-30),
    ),
    min_size=1,
    max_size=60,
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(amounts, st.randoms())
def test_sums_are_exact_in_any_order(spark, values, chance):
    rows = [(DAY15, 1, "SFL", value) for value in values]
    sums = set()
    for partitions in (1, 5):
        chance.shuffle(rows)
        frame = spark.createDataFrame(rows, schemas.TRANSACTIONS).repartition(partitions)
        sums.add(currency_volumes(frame).first().raw_volume)
    (raw_volume,) = sums
    # Relative to the size of the terms, as positive and negative ones may cancel out.
    assert abs(raw_volume - math.fsum(values)) <= 1e-15 * math.fsum(map(abs, values))


@pytest.mark.parametrize(
    "values, expected",
    [
        ([2.0**124, 1.5, -(2.0**124)], 1.5),
        ([1e300, 2.5, -1e300], 2.5),
        ([1.005, 1e27, -1e27], 1.005),
        ([4e-13] * 50 + [0.00499999998], 0.005),
        ([2.0**1000, 5e-324, -(2.0**1000)], 5e-324),
        ([1e308, 1e308], math.inf),
        ([math.inf, 1.0, -math.inf], math.nan),
        ([0.0, -0.0], 0.0),
    ],
)
def test_one_sum_in_every_order(spark, values, expected):
    for rows in (values, values[::-1], values[1:] + values[:1]):
        frame = spark.createDataFrame([(DAY15, 1, "SFL", x) for x in rows], schemas.TRANSACTIONS)
        found = currency_volumes(frame.repartition(3)).first().raw_volume
        assert found == pytest.approx(expected, rel=1e-15, abs=0, nan_ok=True)


def test_a_sum_of_many_equal_amounts(spark):
    """Whole multiples add up far beyond 2**63."""
    frame = spark.range(2000).selectExpr(
        "DATE'2024-04-15' AS date", "1L AS project_id", "'SFL' AS currency_symbol", "9.5e18 AS amount"
    )
    amounts = frame.withColumn("amount", frame.amount.cast("double"))
    assert currency_volumes(amounts).first().raw_volume == 1.9e22


@pytest.mark.parametrize("dust", [1e-18, 3e-18, 1e-25, 7e-40, 5e-324])
def test_dust_is_kept(spark, dust):
    rows = [(DAY15, 1, "SFL", dust)]
    frame = spark.createDataFrame(rows, schemas.TRANSACTIONS)
    assert by_project(currency_volumes(frame)) == {(DAY15, 1): (1, dust)}


@pytest.mark.parametrize("odd", [math.inf, -math.inf, 1e300])
def test_sums_of_very_large_amounts(spark, odd):
    rows = [(DAY15, 1, "SFL", odd), (DAY15, 1, "SFL", 1.5)]
    frame = spark.createDataFrame(rows, schemas.TRANSACTIONS)
    assert by_project(currency_volumes(frame)) == {(DAY15, 1): (2, odd)}


def test_absent_keys_are_left_out(spark):
    frame = spark.createDataFrame(
        [(None, 1, "SFL", 1.0), (DAY15, None, "SFL", 1.0), (DAY15, 1, None, 1.0)],
        schemas.TRANSACTIONS,
    )
    assert by_project(project_metrics(frame)) == {(DAY15, 1): (1, 1.0)}
    assert by_project(project_metrics_of(all_volumes(frame))) == {(DAY15, 1): (1, 1.0)}
    assert currency_volumes(frame).count() == 0


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "app,nums,ts,note,project_id,props\n"
        '7,"{""currencyValueDecimal"":""1.5""}",2024-04-15 01:00:00,"two\nlines",12,'
        '"{""currencySymbol"":""US,DC""}"\n'
    )
    row = extract(read_transactions(spark, str(tmp_path), multi_line=True)).first()
    assert tuple(row) == (datetime.date(2024, 4, 15), 12, "US,DC", 1.5)


def test_csv_with_another_header_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text('ts,project_id,props,nums\n2024-04-15,1,{},{}\n')
    (tmp_path / "b.csv").write_text('project_id,ts,props,nums\n1,2024-04-15,{},{}\n')
    with pytest.raises(Exception, match="header does not conform"):
        extract(read_transactions(spark, str(tmp_path))).collect()


def test_torn_records_do_not_pass(spark, tmp_path):
    from pyspark.errors import PySparkException

    (tmp_path / "a.csv").write_text(
        'ts,project_id,note,props,nums\n2024-04-15,1,"two\nlines",{},{}\n2024-04-15,2,x,{},{}\n'
    )
    assert extract(read_transactions(spark, str(tmp_path), multi_line=True)).count() == 2
    with pytest.raises(PySparkException):
        extract(read_transactions(spark, str(tmp_path))).collect()
