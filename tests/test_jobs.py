"""Whole jobs over files: load, refresh, new quotes, late records, streams."""

from __future__ import annotations

import json

import pytest
from fixtures import DAY14, DAY15, DAY16, DAY17, QUOTES, TRANSACTIONS, VALUED, write_csv

from daybook import schemas
from daybook.operators.pricing import valued
from daybook.operators.quality import duplicate_keys
from daybook.operators.sinks import append_rows, as_table, land, replace_partitions, store_quotes
from daybook.plans.initial_load import initial_load
from daybook.plans.lake import Lake
from daybook.plans.refresh import apply_valuations, refresh, worklist
from daybook.sources.metrics import read_metrics, read_project_metrics
from daybook.sources.transactions import read_landed, read_transactions, stream_transactions
from daybook.streaming.arrivals import refresh_on_arrival


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake.under(str(tmp_path / "lake"))
    lake.create(spark)
    store_quotes(spark.createDataFrame(QUOTES, schemas.QUOTES), lake.quotes)
    return lake


def contents(frame):
    return sorted(map(str, (tuple(row) for row in frame.collect())))


def state(spark, lake):
    """Metrics and project rows, order aside."""
    return (
        contents(read_metrics(spark, lake.metrics)),
        contents(read_project_metrics(spark, lake.project_metrics)),
    )


def by_key(spark, lake):
    rows = read_metrics(spark, lake.metrics).collect()
    return {
        (r.date, r.currency_symbol, r.project_id): (
            r.num_transactions, r.raw_volume, r.price, r.price_source, r.usd_volume
        )
        for r in rows
    }


def response(symbol, day, price, status=200):
    body = json.dumps({"market_data": {"current_price": {"usd": price}}})
    return (symbol, day, status, body)


def test_landing_keeps_records_word_for_word(spark, lake, deliveries):
    land(read_transactions(spark, deliveries), lake.bronze, "a")
    land(read_transactions(spark, deliveries), lake.bronze, "a")
    landed = read_landed(spark, lake.bronze)
    assert contents(landed.select(*schemas.RAW_COLUMNS)) == sorted(map(str, TRANSACTIONS))
    land(spark.createDataFrame([(None, "1", "{}", "{}")], schemas.RAW), lake.bronze, "b")
    assert read_landed(spark, lake.bronze).where("date IS NULL").count() == 1


def test_reading_some_of_the_landed_records(spark, lake, deliveries):
    land(read_transactions(spark, deliveries), lake.bronze, "a")
    land(spark.createDataFrame(TRANSACTIONS[:1], schemas.RAW), lake.bronze, "b-1.x", gather=False)

    def count(**asked):
        return read_landed(spark, lake.bronze, **asked).count()

    assert count() == 11
    assert count(batch="b-1.x") == 1
    assert count(dates=[DAY15]) == 5
    assert count(dates=[DAY15, DAY17, DAY14]) == 6
    assert count(dates=[DAY15], batch="a") == 4
    assert count(dates=[DAY14]) == count(dates=[]) == count(batch="c") == 0
    row = read_landed(spark, lake.bronze, batch="b-1.x").first()
    assert (row.date, row.batch) == (DAY15, "b-1.x")
    with pytest.raises(ValueError, match="batch label"):
        land(read_transactions(spark, deliveries), lake.bronze, "a*")


def test_initial_load(spark, lake, deliveries):
    assert initial_load(spark, deliveries, lake) == 5
    assert read_project_metrics(spark, lake.project_metrics).count() == 5
    assert initial_load(spark, deliveries, lake) == 5
    projects = read_project_metrics(spark, lake.project_metrics)
    assert duplicate_keys(projects, ("date", "project_id")).count() == 5
    refresh(spark, lake)
    assert read_project_metrics(spark, lake.project_metrics).count() == 5


def test_refresh(spark, lake, deliveries):
    initial_load(spark, deliveries, lake)
    refresh(spark, lake)
    first = state(spark, lake)
    seen = by_key(spark, lake)
    assert set(seen) == set(VALUED)
    for key, (*most, usd) in VALUED.items():
        assert list(seen[key][:4]) == most
        assert seen[key][4] == (None if usd is None else pytest.approx(usd))
    refresh(spark, lake)
    assert state(spark, lake) == first
    refresh(spark, lake, dates=[DAY15])
    assert state(spark, lake) == first
    pending = worklist(spark, lake).collect()
    assert {(r.symbol, r.date) for r in pending} == {("SFL", DAY16), ("MATIC", DAY15), ("MATIC", DAY17)}


def test_new_quotes_reach_later_dates(spark, lake, deliveries):
    initial_load(spark, deliveries, lake)
    refresh(spark, lake)
    responses = spark.createDataFrame(
        [
            response("MATIC", DAY16, 0.9),
            response("SFL", DAY15, 99.0),
            response("SFL", DAY14, 98.0, status=500),
            response("WETH", DAY16, 3000.0),
        ],
        schemas.RESPONSES,
    )
    refresh(spark, lake, dates=[DAY15], responses=responses)
    seen = by_key(spark, lake)
    assert seen[DAY17, "MATIC", 4974] == (1, 1e18, 0.9, "last_known", 0.9)
    assert seen[DAY15, "SFL", 4974][2] == 0.05
    assert seen[DAY16, "WETH", 1660][3] == "unpriced"
    partial = state(spark, lake)
    refresh(spark, lake)
    assert state(spark, lake) == partial
    refresh(spark, lake, dates=[], responses=responses)
    assert state(spark, lake) == partial


def test_a_late_quote_rewrites_the_days_up_to_the_next_one(spark, lake):
    from datetime import date

    days = [date(2024, 5, n) for n in range(1, 9)]
    records = [record(str(day), 2, symbol='"SFL"') for day in days]
    records += [record(str(day), 2, symbol='"MATIC"') for day in days[6:]]
    land(spark.createDataFrame(records, schemas.RAW), lake.bronze, "a")
    store_quotes(spark.createDataFrame([("SFL", days[4], 0.5)], schemas.QUOTES), lake.quotes)
    refresh(spark, lake)

    def files():
        rows = read_metrics(spark, lake.metrics).select("date", "_metadata.file_path").collect()
        return {(r.date, r.file_path) for r in rows}

    before = files()
    responses = spark.createDataFrame([response("SFL", days[2], 0.25)], schemas.RESPONSES)
    refresh(spark, lake, dates=[], responses=responses)
    assert {day for day, _ in files() - before} == set(days[2:5])
    seen = by_key(spark, lake)
    assert [seen[day, "SFL", 7][2] for day in days] == [None, None, 0.25, 0.25, 0.5, 0.5, 0.5, 0.5]


def test_late_records_land_in_their_date(spark, lake, deliveries, tmp_path):
    initial_load(spark, deliveries, lake)
    refresh(spark, lake)
    late = write_csv(tmp_path / "late.csv", TRANSACTIONS[:1])
    land(read_transactions(spark, late), lake.bronze, "late")
    refresh(spark, lake, dates=[DAY15])
    assert by_key(spark, lake)[DAY15, "SFL", 4974][:2] == (3, 2.5)
    assert by_key(spark, lake)[DAY16, "USDC.E", 4974] == VALUED[DAY16, "USDC.E", 4974]


def record(day, amount, project="7", symbol='"USDC"'):
    props = '{"currencySymbol": %s}' % symbol
    return (day, project, props, json.dumps({"currencyValueDecimal": str(amount)}))


def volumes_of(spark, lake):
    rows = read_metrics(spark, lake.metrics).collect()
    projects = read_project_metrics(spark, lake.project_metrics).collect()
    return {r.date: r.raw_volume for r in rows}, {r.date: r.raw_volume for r in projects}


def test_a_second_delivery_adds_to_the_first(spark, lake, tmp_path):
    first = write_csv(tmp_path / "a.csv", [record("2024-04-15", 10), record("2024-04-16", 20)])
    second = write_csv(tmp_path / "b.csv", [record("2024-04-15", 5)])
    assert initial_load(spark, first, lake) == 2
    assert initial_load(spark, second, lake) == 1
    assert read_project_metrics(spark, lake.project_metrics).count() == 3
    refresh(spark, lake)
    assert volumes_of(spark, lake) == ({DAY15: 15.0, DAY16: 20.0},) * 2


@pytest.mark.parametrize("whole", [True, False])
def test_a_corrected_date_counts_once(spark, lake, whole):
    def deliver(*rows):
        dates = land(spark.createDataFrame(list(rows), schemas.RAW), lake.bronze, "shop")
        refresh(spark, lake, None if whole else dates)
        return dates

    deliver(record("2024-04-15", 10))
    assert deliver(record("2024-04-16", 10)) == [DAY15, DAY16]
    assert volumes_of(spark, lake) == ({DAY16: 10.0},) * 2
    # without a symbol there is no group per currency any more
    deliver(record("2024-04-16", 10, symbol="null"))
    assert volumes_of(spark, lake) == ({}, {DAY16: 10.0})
    assert deliver(record(None, 10)) == [None, DAY16]
    assert volumes_of(spark, lake) == ({}, {})


def test_landing_does_not_shuffle(spark, tmp_path):
    frame = spark.createDataFrame([record("2024-04-15", 1)], schemas.RAW)
    assert land(frame, str(tmp_path / "t"), "a") == [DAY15]
    assert land(frame, str(tmp_path / "u"), "a", gather=True) == [DAY15]


def test_an_unreadable_date_stops_a_refresh_of_some_dates(spark, lake):
    rows = [record("2024-04-15", 10), record(None, 3)]
    land(spark.createDataFrame(rows, schemas.RAW), lake.bronze, "a")
    refresh(spark, lake, [DAY15])
    assert volumes_of(spark, lake)[0] == {DAY15: 10.0}
    land(spark.createDataFrame([record("yesterday", 99)], schemas.RAW), lake.bronze, "b")
    with pytest.raises(Exception, match="unreadable transaction field: ts"):
        refresh(spark, lake, [DAY15])


def test_keyed_update(spark, lake, deliveries):
    initial_load(spark, deliveries, lake)
    refresh(spark, lake)
    before = by_key(spark, lake)
    rows = read_metrics(spark, lake.metrics).where(f"date = '{DAY16}'")
    quotes = spark.createDataFrame([("WETH", DAY16, 2.0)], schemas.QUOTES)
    new = valued(rows.drop("price", "price_source", "usd_volume"), quotes)
    apply_valuations(spark, lake, new)
    after = by_key(spark, lake)
    assert after.pop((DAY16, "WETH", 1660)) == (1, 1.0, 2.0, "exact", 2.0)
    assert before.pop((DAY16, "WETH", 1660))[4] is None
    assert after == before


def test_tables_in_sql(spark, tmp_path, deliveries):
    lake = Lake.under(str(tmp_path / "shown"), database="shown_in_sql")
    initial_load(spark, deliveries, lake)
    shown = spark.table("shown_in_sql.daily_project_metrics")
    assert shown.count() == 5
    refresh(spark, lake)
    assert spark.sql("SELECT count(*) AS n FROM shown_in_sql.daily_metrics").first().n == 8
    one_day = spark.sql(f"SELECT * FROM shown_in_sql.daily_metrics WHERE date = DATE'{DAY15}'")
    assert one_day.count() == 3
    lake.create(spark)
    assert spark.table("shown_in_sql.daily_metrics").count() == 8


def test_append_refuses_nulls_in_required_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(1, 1, 1.0, DAY15), (None, 1, 1.0, DAY15)]
    frame = spark.createDataFrame(rows, schemas.PROJECT_METRICS)
    required = schemas.PROJECT_METRICS_REQUIRED
    with pytest.raises(Exception, match="required column is null: project_id"):
        append_rows(frame, path, schemas.PROJECT_METRICS, required)
    assert append_rows(frame.where("project_id = 1"), path, schemas.PROJECT_METRICS, required) == 1
    assert read_project_metrics(spark, path).count() == 1


def test_only_the_partitions_written_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")

    def write(*rows):
        frame = spark.createDataFrame(list(rows), schemas.PROJECT_METRICS)
        replace_partitions(as_table(frame, schemas.PROJECT_METRICS), path, "date")

    write((1, 1, 1.0, DAY15), (2, 1, 1.0, DAY15), (1, 1, 1.0, DAY16))
    write((3, 1, 1.0, DAY15))
    rows = read_project_metrics(spark, path).collect()
    assert {(r.project_id, r.date) for r in rows} == {(3, DAY15), (1, DAY16)}


def test_a_large_partition_is_written_by_several_tasks(spark, tmp_path):
    path = tmp_path / "t"
    frame = spark.range(400_000).selectExpr(
        "'2024-04-15' AS ts",
        "md5(cast(id as string)) AS project_id",
        "'{}' AS props",
        "'{}' AS nums",
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        land(frame, str(path), "a")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list(path.rglob("*.parquet"))) > 1


class TestStream:
    def run(self, spark, lake, folder, progress, **options):
        arriving = stream_transactions(spark, str(folder), **options)
        refresh_on_arrival(arriving, lake, "shop", str(progress)).awaitTermination()

    def test_files_as_they_arrive(self, spark, lake, deliveries, tmp_path):
        folder, progress = tmp_path / "in", tmp_path / "progress"
        write_csv(folder / "a.csv", TRANSACTIONS[:3])
        self.run(spark, lake, folder, progress)
        assert {key[0] for key in by_key(spark, lake)} == {DAY15}
        write_csv(folder / "b.csv", TRANSACTIONS[3:6])
        write_csv(folder / "c.csv", TRANSACTIONS[6:])
        self.run(spark, lake, folder, progress, max_files_per_trigger=1)
        self.run(spark, lake, folder, progress)
        streamed = state(spark, lake)

        whole = Lake.under(str(tmp_path / "whole"))
        whole.create(spark)
        store_quotes(spark.createDataFrame(QUOTES, schemas.QUOTES), whole.quotes)
        initial_load(spark, deliveries, whole)
        refresh(spark, whole)
        assert state(spark, whole) == streamed

    def test_a_repeated_batch_replaces_itself(self, spark, lake, tmp_path):
        folder = tmp_path / "in"
        write_csv(folder / "a.csv", TRANSACTIONS)
        self.run(spark, lake, folder, tmp_path / "progress")
        once = state(spark, lake)
        # The same batch number again, as after a failure before it was committed.
        self.run(spark, lake, folder, tmp_path / "other-progress")
        assert state(spark, lake) == once
        assert read_landed(spark, lake.bronze).count() == len(TRANSACTIONS)

    def test_an_unreadable_date_stops_the_stream(self, spark, lake, tmp_path):
        folder = tmp_path / "in"
        write_csv(folder / "a.csv", [record("yesterday", 99)])
        with pytest.raises(Exception, match="unreadable transaction field: ts"):
            self.run(spark, lake, folder, tmp_path / "progress")

    def test_other_columns_and_order(self, spark, lake, tmp_path):
        folder = tmp_path / "in"
        folder.mkdir()
        (folder / "a.csv").write_text(
            'nums,note,ts,project_id,props\n{},x,2024-04-15,7,"{""currencySymbol"":""USDC""}"\n'
        )
        header = "nums string, note string, ts string, project_id bigint, props string"
        self.run(spark, lake, folder, tmp_path / "progress", header=header)
        assert by_key(spark, lake) == {(DAY15, "USDC", 7): (1, 0.0, 1.0, "peg", 0.0)}
