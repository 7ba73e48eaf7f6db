"""Reports, their text and JSON forms, and checks on hand-made metrics."""

from __future__ import annotations

import datetime
import json
import math

from fixtures import DAY15, DAY16

from daybook import schemas
from daybook.operators import quality, reports
from daybook.operators.updates import repriced, updated
from daybook.plans.validation import Validation, validate
from daybook.operators.sinks import as_table, create_empty, replace_partitions

COLUMNS = (
    "date date, project_id bigint, currency_symbol string, num_transactions bigint, "
    "raw_volume double, price double, price_source string, usd_volume double"
)
ROWS = [
    (DAY16, 2, "SFL", 3, 10.0, 0.05, "exact", 0.5),
    (DAY15, 1, "SFL", 2, 20.1, 0.05, "last_known", 1.005),
    (DAY15, 2, "SFL", 1, 2e4, 0.05, "exact", 1000.0),
    (DAY15, 1, "USDC", 4, 1234.5, 1.0, "peg", 1234.5),
    (DAY15, 1, "WETH", 5, 1.0, None, "unpriced", None),
]


def metrics(spark, rows=ROWS):
    return spark.createDataFrame(rows, COLUMNS)


def rows_of(frame):
    return [tuple(row) for row in frame.collect()]


def test_reports(spark):
    assert rows_of(reports.daily_volumes(metrics(spark))) == [
        (DAY15, "SFL", 2, 1001.01),
        (DAY15, "USDC", 1, 1234.5),
        (DAY15, "WETH", 1, None),
        (DAY16, "SFL", 1, 0.5),
    ]
    assert rows_of(reports.project_volumes(metrics(spark))) == [
        (1, "SFL", 1, 1.01),
        (1, "USDC", 1, 1234.5),
        (1, "WETH", 1, None),
        (2, "SFL", 2, 1000.5),
    ]
    assert rows_of(reports.daily_transactions(metrics(spark)))[0] == (DAY15, "SFL", 3, 1001.01)
    assert rows_of(reports.project_totals(metrics(spark))) == [(1, 11, 1235.51), (2, 4, 1000.5)]
    assert rows_of(reports.verify_volumes(metrics(spark)))[0] == (DAY15, "SFL", 2, 1001.005)


def test_texts(spark):
    assert [r.total_usd_volume for r in reports.verify_text(metrics(spark)).collect()] == [
        f"{1001.005:.2f}", "1234.50", "nan", "0.50",
    ]
    assert rows_of(reports.project_text(metrics(spark)))[1] == (
        1, "USDC", "Project 1 - USDC:", "  Transactions: 1", "  Total Volume: $1,234.50",
    )


def test_json_records(spark):
    records = [r.record for r in reports.json_records(reports.daily_volumes(metrics(spark))).collect()]
    assert json.loads(records[0]) == {
        "date": "Mon, 15 Apr 2024 00:00:00 GMT",
        "currency_symbol": "SFL",
        "transactions": 2,
        "total_usd_volume": 1001.01,
    }
    assert list(json.loads(records[0])) == sorted(json.loads(records[0]))
    assert json.loads(records[2])["total_usd_volume"] is None


def test_report_groups_by_day_even_of_timestamps(spark):
    frame = metrics(spark).selectExpr(
        "timestamp_ntz'2024-04-15 01:00:00' + make_dt_interval(0, project_id) AS date", "* EXCEPT (date)"
    )
    assert {r.date for r in reports.daily_volumes(frame).collect()} == {DAY15}
    assert reports.daily_volumes(frame).count() == 3


def test_sums_beyond_decimals(spark):
    for odd in (math.inf, math.nan, 1e30):
        rows = [(*ROWS[0][:-1], odd), (*ROWS[0][:-1], 1.0)]
        total = reports.daily_volumes(metrics(spark, rows)).first().total_usd_volume
        assert total == odd or (math.isnan(odd) and math.isnan(total))


def test_sum_does_not_depend_on_order(spark):
    values = [0.1, 0.2, 0.3, 1e15, -1e15, 1e-7]
    for order in (values, values[::-1], values[3:] + values[:3]):
        rows = [(*ROWS[0][:-1], value) for value in order]
        frame = metrics(spark, rows).coalesce(1)
        assert reports.verify_volumes(frame).first().total_usd_volume == 0.6000001


def test_quality(spark):
    m = metrics(spark)
    assert rows_of(quality.row_count(m)) == [(5,)]
    assert rows_of(quality.profile(m)) == [(5, 2, 2, 1)]
    assert rows_of(quality.required_nulls(m)) == [(0, 0, 0, 1)]
    coverage = {r.price_source: (r.groups, r.num_transactions, r.share) for r in quality.price_coverage(m).collect()}
    assert coverage == {
        "exact": (2, 4, 0.4),
        "last_known": (1, 2, 0.2),
        "peg": (1, 4, 0.2),
        "unpriced": (1, 5, 0.2),
    }
    assert rows_of(quality.unpriced_groups(m)) == [(DAY15, "WETH", 1, 5, 1.0)]
    assert rows_of(quality.duplicate_keys(m)) == []
    assert rows_of(quality.duplicate_keys(m.union(m.limit(1)))) == [(DAY16, "SFL", 2, 2)]
    wrong = [(*ROWS[0][:-1], 0.7), ROWS[3], ROWS[4]]
    assert rows_of(quality.usd_mismatches(metrics(spark, wrong))) == [(DAY16, "SFL", 2, 0.7, 0.5)]


def test_count_reconciliation(spark):
    transactions = spark.createDataFrame(
        [
            (DAY15, 1, "SFL", 1.0),
            (DAY15, 1, "SFL", math.nan),
            (DAY15, 1, None, 1.0),
            (datetime.date(2024, 4, 17), 1, "SFL", 1.0),
        ],
        schemas.TRANSACTIONS,
    )
    rows = quality.count_reconciliation(metrics(spark, [ROWS[0], (DAY15, 1, "SFL", 1, 1.0, 1.0, "exact", 1.0)]), transactions)
    assert {tuple(r) for r in rows.collect()} == {
        (DAY15, 1, 1, True),
        (DAY16, 0, 3, False),
        (datetime.date(2024, 4, 17), 1, 0, False),
    }


def test_update_keeps_rows_without_a_price(spark):
    old = metrics(spark, [(*row[:5], None, None, row[4]) for row in [*ROWS, ROWS[0]]])
    new = updated(old, metrics(spark))
    assert new.columns == old.columns
    expected = [*ROWS[:4], (*ROWS[4][:5], None, None, 1.0), ROWS[0]]
    assert sorted(map(str, rows_of(new))) == sorted(map(str, expected))


def test_repricing_agrees_with_an_update(spark):
    quotes = spark.createDataFrame(
        [("SFL", DAY15, 0.07), ("WETH", DAY16, 3000.0)], schemas.QUOTES
    )
    from daybook.operators.pricing import valued

    fresh = valued(metrics(spark).select("date", "project_id", "currency_symbol", "num_transactions", "raw_volume"), quotes)
    expected = sorted(map(str, rows_of(updated(metrics(spark), fresh))))
    assert sorted(map(str, rows_of(repriced(metrics(spark), quotes)))) == expected


def test_validation(spark, tmp_path):
    def verdict(name, rows):
        path = str(tmp_path / name)
        create_empty(spark, path, schemas.METRICS, "date")
        if rows:
            replace_partitions(as_table(metrics(spark, rows), schemas.METRICS), path, "date")
        return validate(spark, path)

    assert verdict("complete", ROWS[:4]) == Validation(True, True, True)
    assert verdict("complete", ROWS[:4]).ok
    assert verdict("gaps", ROWS) == Validation(True, False, False)
    assert verdict("partly", [*ROWS[:4], (DAY15, 3, "SFL", 1, 1.0, None, "unpriced", None), (DAY16, 3, "SFL", 1, 1.0, 1.0, "exact", 1.0)]) == Validation(True, False, True)
    assert verdict("empty", []) == Validation(True, False, True)
    assert not verdict("empty", []).ok
    assert validate(spark, str(tmp_path / "absent")) == Validation(False, False, False)
