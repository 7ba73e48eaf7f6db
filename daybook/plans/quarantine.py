"""CSV lines that are no records: kept aside at landing, put right, and landed after all."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import schemas
from daybook.operators.editions import Publication, read_partitions
from daybook.operators.sinks import land
from daybook.plans.lake import Lake
from daybook.session import settled
from daybook.sources.transactions import from_lines, read_with_rejects


def quarantined(spark: SparkSession, lake: Lake) -> DataFrame:
    """Lines kept aside: ``line``, ``cells`` read of it, ``file``, ``block`` and the ``batch`` they were delivered with."""
    return read_partitions(spark, lake.quarantine, schemas.QUARANTINE)


def land_with_quarantine(
    spark: SparkSession, csv: str | list[str], lake: Lake, batch: str, multi_line: bool = False
) -> list[datetime.date | None]:
    """Lands the records of CSV files; lines with too many or too few cells are kept aside.

    Landing a label again replaces both its records and its lines. Returns the dates touched.
    """
    lake.create(spark)
    good, bad = read_with_rejects(spark, csv, multi_line)
    run = Publication(spark, lake.catalogue)
    run.replace_partition(bad.withColumn("batch", F.lit(batch)), lake.quarantine, "batch", batch)
    dates = land(good, lake.bronze, batch)
    lake.publish(spark, run)
    return dates


def _read_again(
    spark: SparkSession, lake: Lake, batch: str, repaired: Column, header: Sequence[str]
) -> DataFrame:
    lines = quarantined(spark, lake).where(F.col("batch") == batch)
    return from_lines(lines, repaired, list(header))


def replay(
    spark: SparkSession,
    lake: Lake,
    batch: str,
    repaired: Column,
    header: Sequence[str] = schemas.RAW_COLUMNS,
) -> list[datetime.date | None]:
    """Lands the lines kept aside for ``batch``, put right by ``repaired``, an expression of ``line``.

    The records go under the label ``{batch}.replay``. The lines stay aside as they were delivered, so a
    replay with another repair replaces what the former one landed. ``header`` names the cells of a
    repaired line. Returns the dates touched.
    """
    records = settled(_read_again(spark, lake, batch, repaired, header))
    fitting = records.where(F.col("unread").isNull()).select(*schemas.RAW_COLUMNS)
    return land(fitting, lake.bronze, f"{batch}.replay")


def unrepaired(
    spark: SparkSession,
    lake: Lake,
    batch: str,
    repaired: Column,
    header: Sequence[str] = schemas.RAW_COLUMNS,
) -> DataFrame:
    """The lines of ``batch`` that ``repaired`` does not put right, with their file and block."""
    records = _read_again(spark, lake, batch, repaired, header)
    return records.where(F.col("unread").isNotNull()).select("line", "file", "block")
