"""The commands, in the order a user gives them."""

from __future__ import annotations

import json

from fixtures import DAY15, QUOTES, TRANSACTIONS, write_csv

from daybook import schemas
from daybook.__main__ import main
from daybook.operators.sinks import store_quotes
from daybook.plans.lake import Lake


def test_commands(spark, tmp_path, deliveries, capsys):
    root = str(tmp_path / "lake")

    def run(command, *more):
        status = main([command, root, *more])
        return status, capsys.readouterr().out.splitlines()

    assert run("load", deliveries) == (0, ["5 rows added"])
    store_quotes(spark.createDataFrame(QUOTES, schemas.QUOTES), Lake.under(root).quotes)
    assert run("refresh")[0] == 0
    assert run("refresh", "--dates", str(DAY15))[0] == 0
    status, records = run("daily-volumes")
    assert status == 0
    assert json.loads(records[0]) == {
        "currency_symbol": "MATIC",
        "date": "Mon, 15 Apr 2024 00:00:00 GMT",
        "total_usd_volume": 1.4,
        "transactions": 1,
    }
    assert len(run("project-volumes")[1]) == 6
    assert run("verify")[1][0] == "2024-04-15\tMATIC\t1\t1.40"
    assert len(run("missing")[1]) == 3
    status, lines = run("validate")
    assert status == 1
    assert lines[0] == "8\t3\t2\t3"
    folder = tmp_path / "in"
    write_csv(folder / "more.csv", TRANSACTIONS[:1])
    progress = str(tmp_path / "progress")
    assert run("arrivals", str(folder), "--name", "in", "--progress", progress)[0] == 0
    assert run("verify")[1][1] == f"2024-04-15\tSFL\t1\t{2.5 * 0.05:.2f}"


def test_further_commands(spark, tmp_path, deliveries, capsys, monkeypatch):
    root = str(tmp_path / "lake")

    def run(command, *more):
        status = main([command, root, *more])
        return status, capsys.readouterr().out.splitlines()

    objects = tmp_path / "prices"
    for symbol, day, price in QUOTES:
        (objects / symbol).mkdir(parents=True, exist_ok=True)
        (objects / symbol / f"{day}.json").write_text(json.dumps({"price": price}))
    assert run("quotes-import", str(objects))[0] == 0
    assert run("quotes-export", str(tmp_path / "out")) == (0, [f"{len(QUOTES)} objects"])
    kept = {p.relative_to(objects): json.loads(p.read_text()) for p in objects.rglob("*.json")}
    assert kept == {p.relative_to(tmp_path / "out"): json.loads(p.read_text()) for p in (tmp_path / "out").rglob("*.json")}

    good = write_csv(tmp_path / "in" / "a.csv", TRANSACTIONS)
    with open(good, "a") as more:
        more.write("2024-04-15,7,{}\n")
    assert run("load-checked", good, "--batch", "shop")[0] == 0
    assert [line.split("\t")[0] for line in run("rejects")[1]] == ["2024-04-15,7,{}"]
    assert run("refresh")[0] == 0
    assert [line.split("\t")[-1] for line in run("control")[1]] == ["true"] * 3

    shown = run("daily-volumes")[1]
    assert run("daily-volumes", "--out", str(tmp_path / "report")) == (0, [])
    files = sorted((tmp_path / "report").glob("part-*"))
    assert "".join(p.read_text() for p in files).splitlines() == shown
    monkeypatch.setattr("daybook.__main__.SHOWN", 2)
    assert run("daily-volumes")[1] == shown[:2]

    body = json.dumps({"market_data": {"current_price": {"usd": 0.9}}})
    answer = {"symbol": "MATIC", "date": str(DAY15), "status_code": 200, "body": body}
    (tmp_path / "answers").mkdir()
    (tmp_path / "answers" / "a.json").write_text(json.dumps(answer))
    assert run("answers", str(tmp_path / "answers"), "--progress", str(tmp_path / "p"))[0] == 0
    monkeypatch.setattr("daybook.__main__.SHOWN", 100)
    assert run("verify")[1][0] == "2024-04-15\tMATIC\t1\t1.80"
    assert run("vacuum")[0] == 0
    assert len(run("verify")[1]) == len(shown)
