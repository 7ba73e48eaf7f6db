"""Transaction amounts summed per day.

All sums are partial sums per task first, so a key that holds a large share of the rows
reaches the shuffle as one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.numbers import without_nan
from daybook.operators.totals import summed

PROJECT_KEY = ("date", "project_id")
CURRENCY_KEY = ("date", "currency_symbol", "project_id")


def _totals(transactions: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Count and sum of the amounts that are numbers; the sum of none is 0."""
    amount = without_nan("amount")
    counts = {"num_transactions": F.count(amount), "records": F.count("*")}
    totals = summed(transactions, keys, amount, "raw_volume", counts)
    return totals.withColumn("raw_volume", F.coalesce("raw_volume", F.lit(0.0)))


def with_keys(frame: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys are all present."""
    for key in keys:
        frame = frame.where(F.col(key).isNotNull())
    return frame


def keyed_groups(groups: DataFrame, *keys: str) -> DataFrame:
    """Groups whose keys are all present.

    A condition on keys alone would be moved below the aggregation, where it would parse the
    documents a second time and let unreadable records without a key pass. Tied to the count,
    which is never negative, it stays above.
    """
    for key in keys:
        groups = groups.where(F.when(F.col("num_transactions") >= 0, F.col(key).isNotNull()))
    return groups


def project_metrics(transactions: DataFrame) -> DataFrame:
    """Count and raw sum per date and project, over all currencies together."""
    return keyed_groups(_totals(transactions, PROJECT_KEY), *PROJECT_KEY).drop("records")


def all_volumes(transactions: DataFrame) -> DataFrame:
    """Count and raw sum per date, currency and project; absent keys form groups of their own.

    ``records`` counts amounts that are not numbers as well. Both other volume relations follow from this one, so that a job parses its source once.
    """
    return _totals(transactions, CURRENCY_KEY)


def currency_volumes(transactions: DataFrame) -> DataFrame:
    """Count and raw sum per date, currency and project."""
    return keyed_groups(all_volumes(transactions), *CURRENCY_KEY).drop("records")


def project_metrics_of(volumes: DataFrame) -> DataFrame:
    """``project_metrics`` from ``all_volumes``."""
    counts = {"num_transactions": F.sum("num_transactions")}
    return summed(with_keys(volumes, *PROJECT_KEY), PROJECT_KEY, "raw_volume", "raw_volume", counts)


def price_keys(volumes: DataFrame) -> DataFrame:
    """Each currency and date that needs a price, once."""
    return with_keys(
        volumes.select("currency_symbol", "date").distinct(), "currency_symbol", "date"
    )
