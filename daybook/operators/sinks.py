"""Writing landed records, quotes and metrics."""

from __future__ import annotations

import datetime
import json
import re
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daybook import schemas
from daybook.functions.dates import wall_clock_date
from daybook.operators.editions import Publication, catalogued
from daybook.operators.quote_store import one_quote_a_day
from daybook.session import children, matching, remove_folder, write_text
from daybook.sources.transactions import DELIVERIES, NO_VALUE, landed_records

#: Dates that a delivery can have before they are counted by a job of their own.
MOST_DATES = 10_000


def _gathered(frame: DataFrame, column: str) -> DataFrame:
    """Rows of a partition brought together, without tying a partition to one task.

    Adaptive execution splits what is too large for one file and merges what is too small.
    """
    return frame.hint("rebalance", column)


def replace_partitions(frame: DataFrame, path: str, *columns: str, gather: bool = True) -> None:
    """Replaces exactly the partitions that occur in ``frame``."""
    rows = _gathered(frame, columns[0]) if gather else frame
    (
        rows.write.partitionBy(*columns)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def replace_table(frame: DataFrame, path: str, *columns: str) -> None:
    """Replaces all partitions; those that do not occur in ``frame`` are gone."""
    rows = _gathered(frame, columns[0])
    (
        rows.write.partitionBy(*columns)
        .mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .parquet(path)
    )


def land(
    transactions: DataFrame, path: str, batch: str, gather: bool = False
) -> list[datetime.date | None]:
    """Keeps raw records word for word, filed under a batch label and their date.

    Landing under a label that exists replaces what was there, on all of its dates and in one step: the
    records are written below a new folder, and a small file per label says which folder holds.
    Records without a date are kept as well, under the date NULL. The same file keeps how many records
    each date has, counted in the writing tasks. Returns the dates that had or have records of this label.

    Rows are sorted by date within each task, not shuffled, so a task leaves a file per date that
    it saw. ``gather`` brings the rows of a date together first.
    """
    if not re.fullmatch(r"[\w.-]+", batch):
        raise ValueError(f"a batch label has letters, digits, '_', '-' and '.' only: {batch!r}")
    spark = transactions.sparkSession
    former = landed_records(spark, path, batch).keys()
    dated = transactions.select(*schemas.RAW_COLUMNS, wall_clock_date("ts").alias("date"))
    rows = _gathered(dated, "date") if gather else dated
    edition = uuid.uuid4().hex
    folder = f"{path}/batch={batch}/edition={edition}"
    dates = _write_counted(rows, folder) if not transactions.isEmpty() else {}
    delivery = {"edition": edition, "records": {NO_VALUE if d is None else str(d): n for d, n in dates.items()}}
    write_text(spark, f"{path}/{DELIVERIES}/{batch}", json.dumps(delivery), replace=True)
    for name in children(spark, f"{path}/batch={batch}"):
        if name != f"edition={edition}":  # named no more, or left by a run that was killed
            remove_folder(spark, f"{path}/batch={batch}/{name}")
    return sorted(former | dates.keys(), key=lambda day: (day is not None, day))


def _write_counted(rows: DataFrame, folder: str) -> dict[datetime.date | None, int]:
    """Writes landed records and returns how many each date has, as counted by the writing tasks."""
    seen = Observation()
    # Bars of one date are the first to be joined, so dates stay apart while there are fewer than bars.
    bars = F.histogram_numeric(F.unix_date("date"), F.lit(MOST_DATES))
    undated = F.count(F.when(F.col("date").isNull(), 1))
    counted = rows.observe(
        seen, bars.alias("bars"), undated.alias("undated"), F.count("*").alias("records")
    )
    counted.write.partitionBy("date").parquet(folder)
    bars, undated, records = (seen.get[name] for name in ("bars", "undated", "records"))
    days: dict[int, int] = {}
    for bar in bars or []:  # tasks' bars stand side by side until there are too many
        days[round(bar["x"])] = days.get(round(bar["x"]), 0) + round(bar["y"])
    if len(days) < MOST_DATES and sum(days.values()) + undated == records:
        first = datetime.date(1970, 1, 1)
        dates = {first + datetime.timedelta(days=day): n for day, n in days.items()}
        return dates | ({None: undated} if undated else {})
    landed = rows.sparkSession.read.schema(f"{schemas.RAW}, date date").parquet(folder)
    return {row.date: row["count"] for row in landed.groupBy("date").count().collect()}


def unland(spark: SparkSession, path: str, batch: str) -> list[datetime.date | None]:
    """Takes back all records of a label; returns their dates."""
    former = landed_records(spark, path, batch).keys()
    remove_folder(spark, f"{path}/{DELIVERIES}/{batch}")
    remove_folder(spark, f"{path}/batch={batch}")
    return sorted(former, key=lambda day: (day is not None, day))


def store_quotes(quotes: DataFrame, path: str, run: Publication | None = None) -> None:
    """Replaces all stored quotes of the symbols in ``quotes``; one is kept per symbol and day.

    As part of ``run``, they are seen by others when it publishes.
    """
    spark = quotes.sparkSession
    single = one_quote_a_day(quotes).select("date", "price", "symbol")
    home = catalogued(spark, path)
    if home is None:
        replace_partitions(single, path, "symbol")
    elif run is not None:
        run.replace_written(single, path, "symbol")
    else:
        run = Publication(spark, home[0])
        run.replace_written(single, path, "symbol")
        run.publish()


def write_lines(lines: DataFrame, path: str, most: int = 1_000_000) -> None:
    """Writes a relation of one text column as files of at most ``most`` lines each.

    An ordered relation is dealt to tasks by ranges, so the files in the order of their names hold the lines
    in order, and no task or driver sees all. An existing path is not written to.
    """
    lines.write.option("maxRecordsPerFile", most).text(path)


def as_table(frame: DataFrame, schema: str) -> DataFrame:
    """Columns of a table, in its order."""
    return frame.select(*StructType.fromDDL(schema).names)


def required(frame: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``frame``, failing when a row without one of the required columns is computed."""
    return frame.withColumns(
        {
            name: F.coalesce(F.col(name), F.raise_error(F.lit(f"required column is null: {name}")))
            for name in columns
        }
    )


def append_rows(frame: DataFrame, path: str, schema: str, columns: Iterable[str]) -> int:
    """Adds rows to a table partitioned by date and returns how many; the count is a by-product.

    Nothing is added if a required column is null. Appending the same rows twice keeps both.
    """
    loaded = Observation()
    rows = _gathered(required(as_table(frame, schema), columns), "date")
    # Counted in the writing tasks, of which Spark takes one result each even after retries.
    counted = rows.observe(loaded, F.count(F.lit(1)).alias("rows"))
    counted.write.partitionBy("date").mode("append").parquet(path)
    return loaded.get["rows"]


def _no_rows(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def create_empty(spark: SparkSession, path: str, schema: str, *columns: str) -> None:
    """Makes sure that a partitioned table exists at ``path``; rows already there stay."""
    if not matching(spark, path):
        _no_rows(spark, schema).write.partitionBy(*columns).mode("append").parquet(path)


def register_table(spark: SparkSession, name: str, path: str, schema: str) -> str:
    """Declares the table at ``path`` under ``database.table``, unless it is, for use in SQL."""
    database = name.rsplit(".", 1)[0]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet "
        f"PARTITIONED BY (date) LOCATION '{_escaped(path)}'"
    )
    return name


def _escaped(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def show_partitions(
    spark: SparkSession, name: str, path: str, partitions: Mapping[str, str | None]
) -> None:
    """Points the partitions of a declared table to their editions; None: the partition is gone.

    Each partition changes in one step, but one after the other; the catalogue is ahead of them.
    """
    shown = {row.partition for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    new = []
    for folder, edition in sorted(partitions.items()):
        part = f"PARTITION (date='{folder.removeprefix('date=')}')"
        location = f"LOCATION '{_escaped(path)}/edition={edition}/{folder}'"
        if edition is None:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {part}")
        elif folder in shown:
            spark.sql(f"ALTER TABLE {name} {part} SET {location}")
        else:
            new.append(f"{part} {location}")
    for start in range(0, len(new), 500):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(new[start : start + 500])}")
    spark.catalog.refreshTable(name)
