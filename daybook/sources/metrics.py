"""Metrics tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook import schemas
from daybook.operators.editions import read_partitions


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Valued volumes per date, currency and project, partitioned by date."""
    return read_partitions(spark, path, schemas.METRICS)


def read_project_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Raw volumes per date and project, partitioned by date."""
    return read_partitions(spark, path, schemas.PROJECT_METRICS)
