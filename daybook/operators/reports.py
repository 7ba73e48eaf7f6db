"""Grouped reports over the metrics table, and their text and JSON forms.

``transactions`` counts metrics rows, that is, groups; ``num_transactions`` adds up the
transactions behind them. Reports group by the calendar date, never by a column it shadows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.dates import http_date
from daybook.functions.numbers import plain_cents, with_cents
from daybook.operators.totals import summed


def _by_day(metrics: DataFrame, count: str, counted: Column) -> DataFrame:
    keys = (F.to_date("date").alias("date"), "currency_symbol")
    return summed(metrics, keys, "usd_volume", "total_usd_volume", {count: counted})


def _by_project(metrics: DataFrame, keys: tuple[str, ...], count: str, counted: Column, name: str):
    return summed(metrics, keys, "usd_volume", name, {count: counted})


def _cents(report: DataFrame, name: str) -> DataFrame:
    """The total rounded to two places, halves away from zero."""
    return report.withColumn(name, F.round(name, 2))


def verify_volumes(metrics: DataFrame) -> DataFrame:
    """Groups and unrounded dollar value per date and currency."""
    return _by_day(metrics, "transactions", F.count("*")).orderBy("date", "currency_symbol")


def daily_volumes(metrics: DataFrame) -> DataFrame:
    """Groups and dollar value per date and currency."""
    return _cents(verify_volumes(metrics), "total_usd_volume")


def project_volumes(metrics: DataFrame) -> DataFrame:
    """Groups and dollar value per project and currency."""
    keys = ("project_id", "currency_symbol")
    name = "total_project_volume"
    report = _by_project(metrics, keys, "total_transactions", F.count("*"), name)
    return _cents(report, name).orderBy(*keys)


def daily_transactions(metrics: DataFrame) -> DataFrame:
    """Transactions and dollar value per date and currency."""
    report = _by_day(metrics, "num_transactions", F.sum("num_transactions"))
    return _cents(report, "total_usd_volume").orderBy("date", "currency_symbol")


def project_totals(metrics: DataFrame) -> DataFrame:
    """Transactions and dollar value per project, over all currencies."""
    name, count = "total_usd_volume", F.sum("num_transactions")
    report = _by_project(metrics, ("project_id",), "num_transactions", count, name)
    return _cents(report, name).orderBy("project_id")


def verify_text(metrics: DataFrame) -> DataFrame:
    """``verify_volumes`` with the dollar value as text of two decimals."""
    return verify_volumes(metrics).withColumn("total_usd_volume", plain_cents("total_usd_volume"))


def project_text(metrics: DataFrame) -> DataFrame:
    """Three printable lines per project and currency."""
    return project_volumes(metrics).select(
        "project_id",
        "currency_symbol",
        F.format_string("Project %d - %s:", "project_id", "currency_symbol").alias("heading"),
        F.format_string("  Transactions: %d", "total_transactions").alias("transactions_line"),
        F.concat(F.lit("  Total Volume: $"), with_cents("total_project_volume")).alias(
            "volume_line"
        ),
    )


def json_records(report: DataFrame) -> DataFrame:
    """Each row as one JSON object: keys in alphabetical order, dates as in HTTP headers."""
    columns = [
        http_date(name).alias(name) if type_name == "date" else F.col(name)
        for name, type_name in sorted(report.dtypes)
    ]
    record = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return report.select(record.alias("record"))
