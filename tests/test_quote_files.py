"""Quotes and responses read from files."""

from __future__ import annotations

import datetime
import json

import pyarrow as pa
import pytest

from daybook import schemas
from daybook.operators import quote_objects
from daybook.operators.quote_objects import put_quotes
from daybook.operators.sinks import store_quotes
from daybook.sources.quotes import (
    quotes_of,
    read_quote_objects,
    read_quotes,
    read_responses,
    response_quotes,
)

DAY = datetime.date(2024, 4, 15)
NEXT = datetime.date(2024, 4, 16)


def test_quote_objects(spark, tmp_path):
    bodies = {
        "SFL/2024-04-15": '{"price": 0.05}',
        "SFL/2024-04-16": '{\n  "price": null\n}',
        "SFL/2024-04-17": '{"price"',
        "SFL/2024-04-18": "",
        "SFL/2024-04-19": "{}",
        "SFL/readme": '{"price": 1}',
        "A+B C%2F/2024-04-15": '{"price": "7"}',
        "USDC.E/2024-04-15": '{"price": 1}',
    }
    for name, body in bodies.items():
        path = tmp_path / f"{name}.json"
        path.parent.mkdir(exist_ok=True)
        path.write_text(body)
    (tmp_path / "SFL" / "2024-04-20.txt").write_text('{"price": 9}')
    expected = {
        ("SFL", datetime.date(2024, 4, 15)): 0.05,
        **{("SFL", datetime.date(2024, 4, d)): None for d in (16, 17, 19)},
        ("A+B C%2F", DAY): 7.0,
        ("USDC.E", DAY): 1.0,
    }
    seen = {(r.symbol, r.date): r.price for r in read_quote_objects(spark, str(tmp_path)).collect()}
    assert seen == expected
    only = read_quote_objects(spark, str(tmp_path), "SFL").collect()
    assert {(r.symbol, r.date): r.price for r in only} == {
        key: price for key, price in expected.items() if key[0] == "SFL"
    }


def test_storing_quotes_leaves_other_symbols_alone(spark, tmp_path):
    path = str(tmp_path / "quotes")
    rows = [("SFL", DAY, 0.05), ("123", DAY, 2.0), ("MATIC", NEXT, None)]
    store_quotes(spark.createDataFrame(rows, schemas.QUOTES), path)
    store_quotes(spark.createDataFrame([("SFL", NEXT, 0.06)], schemas.QUOTES), path)
    kept = {tuple(r) for r in read_quotes(spark, path).collect()}
    assert kept == {("SFL", NEXT, 0.06), ("123", DAY, 2.0), ("MATIC", NEXT, None)}
    one = quotes_of(read_quotes(spark, path), "SFL")
    assert [tuple(r) for r in one.collect()] == [("SFL", NEXT, 0.06)]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan


def test_responses(spark, tmp_path):
    price = json.dumps({"market_data": {"current_price": {"usd": 0.7}}})
    answers = [
        {"symbol": "MATIC", "date": "2024-04-15", "status_code": 200, "body": price},
        {"symbol": "MATIC", "date": "2024-04-16", "status_code": 404, "body": price},
        {"symbol": "SFL", "date": "2024-04-16", "status_code": 200, "body": "{}"},
    ]
    (tmp_path / "a.json").write_text("\n".join(json.dumps(a) for a in answers))
    responses = read_responses(spark, str(tmp_path))
    assert {tuple(r) for r in response_quotes(responses).collect()} == {
        ("MATIC", DAY, 0.7),
        ("MATIC", NEXT, None),
        ("SFL", NEXT, None),
    }


def objects(path):
    return {str(p.relative_to(path)): p.read_text() for p in path.rglob("*") if p.is_file()}


def test_putting_quote_objects(spark, tmp_path):
    rows = [("SFL", DAY, 0.05), ("SFL", NEXT, None), ("USDC.E", DAY, 1.0), ("A+B C%2F=é", DAY, float("nan")), ("SFL", DAY, 0.04)]
    path = f"file:{tmp_path}/prices"
    assert put_quotes(spark.createDataFrame(rows, schemas.QUOTES), path) == 4
    assert objects(tmp_path / "prices") == {
        "SFL/2024-04-15.json": '{"price": 0.04}',
        "SFL/2024-04-16.json": '{"price": null}',
        "USDC.E/2024-04-15.json": '{"price": 1.0}',
        "A+B C%2F=é/2024-04-15.json": '{"price": null}',
    }
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "prices").rglob("*.json")}
    assert put_quotes(spark.createDataFrame([("SFL", NEXT, 0.06)], schemas.QUOTES), path) == 1
    changed = [p.name for p, at in untouched.items() if p.stat().st_mtime_ns != at]
    assert changed == ["2024-04-16.json"]
    found = {(r.symbol, r.date): r.price for r in read_quote_objects(spark, path).collect()}
    assert found == {("SFL", DAY): 0.04, ("SFL", NEXT): 0.06, ("USDC.E", DAY): 1.0, ("A+B C%2F=é", DAY): None}
    assert put_quotes(spark.createDataFrame([], schemas.QUOTES), path) == 0


@pytest.mark.parametrize("symbol", [None, "", "a/b", "..", "_hidden", ".x"])
def test_symbols_that_are_no_folder(spark, tmp_path, symbol):
    with pytest.raises(Exception, match="no quote object for"):
        put_quotes(spark.createDataFrame([(symbol, DAY, 1.0)], schemas.QUOTES), str(tmp_path / "p"))
    with pytest.raises(Exception, match="no quote object for"):
        put_quotes(spark.createDataFrame([("SFL", None, 1.0)], schemas.QUOTES), str(tmp_path / "p"))
    assert not (tmp_path / "p").exists()


def test_an_object_is_whole_or_not_there(tmp_path, monkeypatch):
    """A task that stops while it writes leaves the former body."""
    path = str(tmp_path)
    batch = pa.table({"symbol": ["SFL"], "date": ["2024-04-15"], "price": [1.0]}).to_batches()[0]
    assert [b.to_pydict() for b in quote_objects._put([batch], path)] == [{"objects": [1]}]

    def stopped(price):
        raise OSError("stopped")

    monkeypatch.setattr(quote_objects, "body_of", stopped)
    with pytest.raises(OSError):
        list(quote_objects._put([batch], path))
    assert (tmp_path / "SFL" / "2024-04-15.json").read_text() == '{"price": 1.0}'


def test_paths_of_object_stores():
    known = {"s3a://b/p": "s3://b/p", "file:/a/b": "/a/b", "file:///a": "file:///a", "/a": "/a", "hdfs://h/p": "hdfs://h/p"}
    assert {path: quote_objects.known_path(path) for path in known} == known
