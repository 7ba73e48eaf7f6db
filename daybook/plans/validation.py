"""Verdicts on a metrics table."""

from __future__ import annotations

from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.quality import profile, row_count
from daybook.operators.reports import project_volumes
from daybook.sources.metrics import read_metrics


class Validation(NamedTuple):
    """Outcome of the three checks; ``ok`` if all hold."""

    readable: bool
    complete: bool
    displayable: bool

    @property
    def ok(self) -> bool:
        return all(self)


def is_readable(metrics: DataFrame) -> bool:
    """Whether the rows can be counted; an empty table is readable."""
    return row_count(metrics).first() is not None


def is_complete(metrics: DataFrame) -> bool:
    """Whether there are rows and every one has a dollar value."""
    return profile(metrics).first()["null_volumes"] == 0


def is_displayable(metrics: DataFrame) -> bool:
    """Whether every project total is a number; true for no rows."""
    total = F.col("total_project_volume")
    verdict = project_volumes(metrics).agg(
        F.coalesce(F.every(total.isNotNull()), F.lit(True)).alias("displayable")
    )
    return verdict.first()["displayable"]


def _holds(check, spark: SparkSession, path: str) -> bool:
    try:
        return check(read_metrics(spark, path))
    except (PySparkException, Py4JJavaError):
        return False


def validate(spark: SparkSession, path: str) -> Validation:
    """Runs all three checks on the table at ``path``; a check that cannot run does not hold."""
    return Validation(
        *[_holds(check, spark, path) for check in (is_readable, is_complete, is_displayable)]
    )
