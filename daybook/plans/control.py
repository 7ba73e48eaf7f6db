"""Checks by counts that the jobs kept, without reading records or metrics again.

Landing counts records per date in the tasks that write them, a refresh counts what it read and what
its metrics rows hold; both are published with the rows they are about.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook import schemas
from daybook.operators.editions import published_facts
from daybook.plans.lake import Lake
from daybook.plans.refresh import SOURCE
from daybook.sources.transactions import landed_records

CONTROL_TOTALS = "date string, landed bigint, read bigint, countable bigint, counted bigint, matches boolean"


def control_totals(spark: SparkSession, lake: Lake) -> DataFrame:
    """Per date: records landed and read by the last refresh, transactions with all keys and an
    amount among them, and transactions in the metrics.

    ``matches`` says that the first two agree and the last two; a date landed since the last refresh does not
    match, and is what the next one must take up. Records without a date are not listed.
    """
    landed = {f"date={day}": n for day, n in landed_records(spark, lake.bronze).items() if day}
    facts = published_facts(spark, lake.catalogue)
    source, metrics = facts.get(SOURCE, {}), facts.get("daily_metrics", {})
    rows = []
    for name in sorted(landed.keys() | source.keys() | metrics.keys()):
        arrived = landed.get(name, 0)
        read, countable = (source.get(name, {}).get(x, 0) for x in ("records", "countable"))
        counted = metrics.get(name, {}).get("transactions", 0)
        matches = arrived == read and countable == counted
        rows.append((name.removeprefix("date="), arrived, read, countable, counted, matches))
    frame = spark.createDataFrame(rows, CONTROL_TOTALS)
    return frame.withColumn("date", frame["date"].cast("date"))


def published_profile(spark: SparkSession, lake: Lake) -> DataFrame:
    """Rows, dates, and nulls of the required columns of the published metrics."""
    facts = published_facts(spark, lake.catalogue).get("daily_metrics", {}).values()
    names = [f"null_{name}" for name in schemas.METRICS_REQUIRED]
    row = [sum(x[name] for x in facts) for name in ("rows", *names)]
    columns = ", ".join(f"{name} bigint" for name in ("total_rows", *names, "unique_dates"))
    return spark.createDataFrame([(*row, len(facts))], columns)
