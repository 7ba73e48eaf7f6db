"""Runs that publish at once, that are killed on their way, or that meet another run."""

from __future__ import annotations

import json
import pathlib
import subprocess
import sys
import textwrap

import pytest
from fixtures import DAY14, DAY15, DAY16, DAY17, QUOTES, TRANSACTIONS, write_csv

from daybook import schemas
from daybook.operators import editions, sinks
from daybook.operators.editions import Publication, published
from daybook.operators.quality import duplicate_keys
from daybook.operators.sinks import as_table, land, store_quotes, unland
from daybook.operators.updates import on_dates
from daybook.plans.control import control_totals, published_profile
from daybook.plans.initial_load import initial_load
from daybook.plans.lake import Lake
from daybook.plans.quarantine import land_with_quarantine, quarantined, replay, unrepaired
from daybook.plans.refresh import refresh
from daybook.sources.metrics import read_metrics, read_project_metrics
from daybook.sources.quotes import read_quotes, stream_responses
from daybook.sources.transactions import landed_records, read_landed, stream_transactions
from daybook.streaming import arrivals
from daybook.streaming.arrivals import refresh_on_arrival, reprice_on_arrival
from pyspark.sql import functions as F
from test_jobs import contents, record, response, state

ROOT = pathlib.Path(__file__).resolve().parent.parent


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake.under(str(tmp_path / "lake"))
    lake.create(spark)
    store_quotes(spark.createDataFrame(QUOTES, schemas.QUOTES), lake.quotes)
    return lake


def everything(spark, lake):
    return (*state(spark, lake), contents(read_quotes(spark, lake.quotes)))


class Killed(Exception):
    pass


@pytest.mark.parametrize("writes", [1, 3])
def test_a_run_that_fails_between_tables_changes_nothing(spark, lake, deliveries, monkeypatch, writes):
    initial_load(spark, deliveries, lake)
    refresh(spark, lake)
    before = everything(spark, lake)
    answers = spark.createDataFrame([response("MATIC", DAY16, 0.9), response("SFL", DAY16, 9.0)], schemas.RESPONSES)
    land(spark.createDataFrame([record("2024-04-15", 10), record("2024-04-18", 1)], schemas.RAW), lake.bronze, "b")
    write, done = Publication._write, []

    def failing(*args):
        if len(done) == writes:
            raise Killed
        done.append(write(*args))

    monkeypatch.setattr(Publication, "_write", failing)
    with pytest.raises(Killed):
        refresh(spark, lake, dates=[DAY14, DAY15], responses=answers)
    assert everything(spark, lake) == before
    monkeypatch.undo()
    refresh(spark, lake, dates=[DAY14, DAY15], responses=answers)
    after = everything(spark, lake)
    assert all(new != old for new, old in zip(after, before))
    assert {r.price for r in read_metrics(spark, lake.metrics).where(F.col("date") == DAY17).collect()} == {0.9}


def test_a_killed_process_leaves_the_former_state(spark, lake, deliveries, tmp_path):
    initial_load(spark, deliveries, lake)
    refresh(spark, lake)
    before = everything(spark, lake)
    land(spark.createDataFrame([record("2024-04-15", 10)], schemas.RAW), lake.bronze, "b")
    program = textwrap.dedent(f"""
        import os
        from pyspark.sql import SparkSession
        from daybook.operators.editions import Publication
        from daybook.plans.lake import Lake
        from daybook.plans.refresh import refresh
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.sql.session.timeZone", "UTC").config("spark.sql.shuffle.partitions", "2")
                 .config("spark.checkpoint.dir", {str(tmp_path / "cp")!r}).getOrCreate())
        write = Publication._write
        def killed(self, rows, path, *rest):
            write(self, rows, path, *rest)
            if path.endswith("daily_project_metrics"):
                print("between", flush=True)
                os._exit(9)
        Publication._write = killed
        refresh(spark, Lake.under({lake.bronze.rsplit("/", 1)[0]!r}))
    """)
    ended = subprocess.run(
        [sys.executable, "-c", program], cwd=ROOT, capture_output=True, text=True, timeout=240
    )
    assert (ended.returncode, ended.stdout) == (9, "between\n")
    assert everything(spark, lake) == before
    refresh(spark, lake)
    assert everything(spark, lake) != before


def test_readers_keep_what_they_found_until_it_is_removed(spark, lake, deliveries):
    initial_load(spark, deliveries, lake)
    refresh(spark, lake)
    found = read_metrics(spark, lake.metrics)
    rows = contents(found)
    land(spark.createDataFrame([record("2024-04-15", 10)], schemas.RAW), lake.bronze, "b")
    refresh(spark, lake, [DAY15])
    assert contents(found) == rows != contents(read_metrics(spark, lake.metrics))
    lake.vacuum(spark, keep=2)
    assert contents(found) == rows
    lake.vacuum(spark, keep=1)
    assert len(list(pathlib.Path(lake.catalogue).glob("0*"))) == 1
    named = {e for table in published(spark, lake.catalogue)[1].values() for e in table.values()}
    for path in (lake.metrics, lake.project_metrics, lake.quotes):
        assert {p.name.removeprefix("edition=") for p in pathlib.Path(path).glob("edition=*")} <= named
    assert contents(read_metrics(spark, lake.metrics)) != rows


def test_two_runs_at_once(spark, lake, deliveries):
    initial_load(spark, deliveries, lake)
    one, two = (Publication(spark, lake.catalogue) for _ in range(2))
    rows = spark.createDataFrame([(1, 1, 1.0, DAY14)], schemas.PROJECT_METRICS)
    one.replace(rows, lake.project_metrics)
    two.replace(rows.limit(0), lake.project_metrics)
    one.publish()
    with pytest.raises(FileExistsError):
        two.publish()
    assert [r.date for r in read_project_metrics(spark, lake.project_metrics).collect()] == [DAY14]


def test_dates_without_rows_and_partitions_with_odd_names(spark, lake):
    rows = spark.createDataFrame([(1, 1, 1.0, DAY14), (1, 1, 1.0, DAY15)], schemas.PROJECT_METRICS)
    run = Publication(spark, lake.catalogue)
    run.replace(rows, lake.project_metrics)
    run.replace(rows.where("false"), lake.project_metrics, [DAY15, DAY16])
    assert [r.date for r in run.read(lake.project_metrics, schemas.PROJECT_METRICS).collect()] == [DAY14]
    odd = [("A+B C%2F/x=1", DAY15, 2.0), ("é:*?", DAY15, 3.0)]
    store_quotes(spark.createDataFrame(odd, schemas.QUOTES), lake.quotes, run)
    run.publish()
    assert {tuple(r) for r in read_quotes(spark, lake.quotes).collect()} >= set(odd)
    assert read_quotes(spark, lake.quotes).count() == len(QUOTES) + 2


def test_landing_is_seen_at_once(spark, lake, monkeypatch):
    land(spark.createDataFrame([record("2024-04-15", 10)], schemas.RAW), lake.bronze, "a")
    before = contents(read_landed(spark, lake.bronze))

    def killed(*args, **options):
        raise Killed

    new = spark.createDataFrame([record("2024-04-16", 1), record(None, 2)], schemas.RAW)
    monkeypatch.setattr(sinks, "write_text", killed)
    with pytest.raises(Killed):
        land(new, lake.bronze, "a")
    monkeypatch.undo()
    assert contents(read_landed(spark, lake.bronze)) == before
    assert land(new, lake.bronze, "a") == [None, DAY15, DAY16]
    assert landed_records(spark, lake.bronze) == {DAY16: 1, None: 1}
    assert len(list(pathlib.Path(lake.bronze, "batch=a").iterdir())) == 1
    assert land(new.limit(0), lake.bronze, "a") == [None, DAY16]
    assert read_landed(spark, lake.bronze).count() == 0
    land(new, lake.bronze, "a")
    assert unland(spark, lake.bronze, "a") == [None, DAY16]
    assert unland(spark, lake.bronze, "a") == []
    assert landed_records(spark, lake.bronze) == {}


@pytest.mark.parametrize("most", [sinks.MOST_DATES, 5])
def test_records_are_counted_while_they_are_landed(spark, lake, monkeypatch, most):
    monkeypatch.setattr(sinks, "MOST_DATES", most)
    days = spark.range(3000).selectExpr(
        "cast(date_add(DATE'2024-01-01', cast(pow(id % 29, 2) as int)) as string) AS ts",
        "'1' AS project_id", "'{}' AS props", "'{}' AS nums",
    )
    land(days.repartition(7), lake.bronze, "a")
    truth = {r.date: r["count"] for r in read_landed(spark, lake.bronze).groupBy("date").count().collect()}
    assert landed_records(spark, lake.bronze) == truth
    assert len(truth) == 29


def test_control_totals(spark, lake, deliveries):
    extra = [record("2024-04-15", "nan"), record("2024-04-15", 1, symbol="null"), record("2024-04-20", 1)]
    initial_load(spark, deliveries, lake)
    land(spark.createDataFrame(extra[:2], schemas.RAW), lake.bronze, "odd")
    refresh(spark, lake)
    totals = control_totals(spark, lake)
    assert "FileScan" not in totals._jdf.queryExecution().toString()
    assert [tuple(r)[1:] for r in totals.orderBy("date").collect()] == [
        (6, 6, 4, 4, True), (5, 5, 4, 4, True), (1, 1, 1, 1, True)
    ]
    land(spark.createDataFrame(extra[2:], schemas.RAW), lake.bronze, "late")
    assert [tuple(r)[1:] for r in control_totals(spark, lake).where("not matches").collect()] == [(1, 0, 0, 0, False)]
    refresh(spark, lake, [DAY15.replace(day=20)])
    assert control_totals(spark, lake).where("not matches").isEmpty()
    profile = published_profile(spark, lake).first()
    metrics = read_metrics(spark, lake.metrics)
    assert profile.total_rows == metrics.count()
    assert profile.null_usd_volume == metrics.where("usd_volume is null").count() > 0
    assert profile.unique_dates == 4


def test_only_the_partitions_of_wanted_dates_are_read(spark, lake, deliveries):
    initial_load(spark, deliveries, lake)
    refresh(spark, lake)
    days = spark.createDataFrame([(DAY16,)], "date date").checkpoint()
    rows = on_dates(read_metrics(spark, lake.metrics), days)
    assert {r.date for r in rows.collect()} == {DAY16}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


# --- streams --------------------------------------------------------------------------------


def arrive(spark, lake, folder, progress, **options):
    refresh_on_arrival(stream_transactions(spark, str(folder), **options), lake, "shop", str(progress)).awaitTermination()


def whole(spark, lake, tmp_path, answers=None):
    """The state that one load and refresh over the same files give."""
    other = Lake.under(str(tmp_path / "whole"))
    other.create(spark)
    store_quotes(spark.createDataFrame(QUOTES, schemas.QUOTES), other.quotes)
    initial_load(spark, str(tmp_path / "in"), other)
    refresh(spark, other, responses=answers)
    return everything(spark, other)


def test_a_lost_progress_folder_counts_nothing_twice(spark, lake, tmp_path):
    folder = tmp_path / "in"
    write_csv(folder / "a.csv", TRANSACTIONS[:3])
    write_csv(folder / "b.csv", TRANSACTIONS[3:6])
    arrive(spark, lake, folder, tmp_path / "p1", max_files_per_trigger=1)
    write_csv(folder / "c.csv", TRANSACTIONS[6:])
    arrive(spark, lake, folder, tmp_path / "p2")
    assert everything(spark, lake) == whole(spark, lake, tmp_path)
    arrive(spark, lake, folder, tmp_path / "p3", max_files_per_trigger=2)
    assert everything(spark, lake) == whole(spark, lake, tmp_path)
    assert read_landed(spark, lake.bronze).count() == len(TRANSACTIONS)


@pytest.mark.parametrize("step", ["land", "refresh", "done"])
def test_a_batch_that_failed_is_done_again_however_files_are_dealt(spark, lake, tmp_path, monkeypatch, step):
    folder = tmp_path / "in"
    write_csv(folder / "a.csv", TRANSACTIONS[:3])
    write_csv(folder / "b.csv", TRANSACTIONS[3:6])

    def stopping(function):
        def stopped(*args, **options):
            if step != "done" or options.get("done"):
                raise Killed("stopped here")
            return function(*args, **options)

        return stopped

    name = {"done": "enter_files"}.get(step, step)
    for _ in range(2 if step == "land" else 1):
        monkeypatch.setattr(arrivals, name, stopping(getattr(arrivals, name)))
        with pytest.raises(Exception, match="stopped here"):
            arrive(spark, lake, folder, tmp_path / "p1")
        monkeypatch.undo()
    write_csv(folder / "c.csv", TRANSACTIONS[6:])
    arrive(spark, lake, folder, tmp_path / "p2", max_files_per_trigger=1)
    assert everything(spark, lake) == whole(spark, lake, tmp_path)
    assert read_landed(spark, lake.bronze).count() == len(TRANSACTIONS)


@pytest.mark.parametrize("lost", [False, True])
def test_a_large_file_is_landed_by_several_tasks(spark, lake, tmp_path, lost):
    """No task gets all records of a file, nor those of files that come again after lost progress."""
    folder = tmp_path / "in"
    settings = {"spark.sql.files.maxPartitionBytes": "8k", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    write_csv(folder / "a.csv", TRANSACTIONS * 100)
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        arrive(spark, lake, folder, tmp_path / "p1")
        if lost:
            write_csv(folder / "b.csv", TRANSACTIONS * 100)
            arrive(spark, lake, folder, tmp_path / "p2")
    finally:
        for name in settings:
            spark.conf.unset(name)
    assert read_landed(spark, lake.bronze).count() == len(TRANSACTIONS) * 100 * (1 + lost)
    for batch in pathlib.Path(lake.bronze).glob("batch=*"):
        tasks = {part.name.split("-")[1] for part in batch.rglob("part-*.parquet")}
        assert len(tasks) > 3


@pytest.mark.parametrize("order", ["answers first", "transactions first", "between"])
def test_answers_and_transactions_in_any_order(spark, lake, tmp_path, order):
    folder, answers = tmp_path / "in", tmp_path / "answers"
    given = [response("MATIC", DAY15, 0.9), response("SFL", DAY16, 9.0), response("SFL", DAY15, 7.0), response("MATIC", DAY17, 1, 500)]
    answers.mkdir()

    def answer(name, rows):
        names = ("symbol", "date", "status_code", "body")
        lines = [json.dumps(dict(zip(names, (r[0], str(r[1]), *r[2:])))) for r in rows]
        (answers / name).write_text("\n".join(lines))
        reprice_on_arrival(stream_responses(spark, str(answers)), lake, str(tmp_path / "q")).awaitTermination()

    if order == "answers first":
        answer("a.json", given)
    write_csv(folder / "a.csv", TRANSACTIONS[:5])
    arrive(spark, lake, folder, tmp_path / "p")
    if order == "between":
        answer("a.json", given[:2])
        answer("b.json", given[1:])
    write_csv(folder / "b.csv", TRANSACTIONS[5:])
    arrive(spark, lake, folder, tmp_path / "p")
    if order == "transactions first":
        answer("a.json", given)
    frame = spark.createDataFrame(given, schemas.RESPONSES)
    assert everything(spark, lake) == whole(spark, lake, tmp_path, frame)


# --- lines that do not fit ------------------------------------------------------------------


def test_lines_that_do_not_fit_are_kept_with_their_file(spark, lake, tmp_path):
    good = write_csv(tmp_path / "in" / "a.csv", TRANSACTIONS)
    text = pathlib.Path(good).read_text()
    bad = ['2024-04-15,7,"{""currencySymbol"":""USDC""}"', '2024-04-16,7,"{""currencySymbol"":""USDC""}",{},x']
    (tmp_path / "in" / "b.csv").write_text(text.splitlines()[0] + "\n" + "\n".join(bad) + "\n")
    dates = land_with_quarantine(spark, str(tmp_path / "in"), lake, "shop")
    assert dates == [DAY15, DAY16, DAY17]
    assert read_landed(spark, lake.bronze).count() == len(TRANSACTIONS)
    kept = quarantined(spark, lake).collect()
    assert sorted(r.line for r in kept) == sorted(bad)
    assert {(pathlib.Path(r.file).name, r.block, r.batch) for r in kept} == {("b.csv", 0, "shop")}
    assert sorted(r.cells for r in kept) == [3, 4]

    longer = F.concat("line", F.lit(",{}"))
    assert replay(spark, lake, "shop", longer) == [DAY15]
    assert [r.line for r in unrepaired(spark, lake, "shop", longer).collect()] == bad[1:]
    repaired = F.when(F.col("line").endswith(",x"), F.expr("left(line, length(line) - 2)")).otherwise(longer)
    for _ in range(2):
        assert replay(spark, lake, "shop", repaired) == [DAY15, DAY16]
        assert read_landed(spark, lake.bronze).count() == len(TRANSACTIONS) + 2
    refresh(spark, lake)
    assert read_metrics(spark, lake.metrics).where("project_id = 7").count() == 2

    land_with_quarantine(spark, good, lake, "shop")
    assert quarantined(spark, lake).count() == 0
    assert replay(spark, lake, "shop", repaired) == [DAY15, DAY16]
    assert read_landed(spark, lake.bronze).count() == len(TRANSACTIONS)


def test_a_plain_folder_is_read_as_it_is(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1, 1.0, DAY14)], schemas.PROJECT_METRICS)
    sinks.replace_partitions(as_table(rows, schemas.PROJECT_METRICS), str(tmp_path / "t"), "date")
    assert editions.catalogued(spark, str(tmp_path / "t")) is None
    assert duplicate_keys(read_project_metrics(spark, str(tmp_path / "t")), ("date", "project_id")).isEmpty()
    assert read_project_metrics(spark, str(tmp_path / "t")).count() == 1
