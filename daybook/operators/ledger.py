"""Which files were taken up, so that none counts twice.

Files are known by path and size. A batch is entered before its records are landed and marked done
after they are valued. What was entered and never done is a batch that failed on its way: its
records are taken back, and its files count as new. So the outcome depends neither on the stream's
own progress folder nor on how it deals files to batches.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import schemas

FILE = ["file", "size"]


def _entries(spark: SparkSession, path: str) -> DataFrame:
    """One row per file and label: whether its batch was done."""
    entries = spark.read.schema(schemas.ARRIVALS).parquet(path)
    return entries.groupBy(*FILE, "label").agg(F.max("done").alias("done"))


def files_of(rows: DataFrame) -> DataFrame:
    """The files that rows come from; no other column is read."""
    return rows.select(*FILE).distinct()


def new_files(spark: SparkSession, path: str, files: DataFrame) -> DataFrame:
    """Those that no done batch holds."""
    return files.join(_entries(spark, path).where("done").select(*FILE).distinct(), FILE, "left_anti")


def new_label(name: str) -> str:
    """A label for one attempt at a batch."""
    return f"{name}-{uuid.uuid4().hex}"


def enter_files(files: DataFrame, path: str, label: str, done: bool) -> None:
    rows = files.select(*FILE, F.lit(label).alias("label"), F.lit(done).alias("done"))
    rows.coalesce(1).write.mode("append").parquet(path)


def unfinished(spark: SparkSession, path: str, name: str) -> list[str]:
    """Labels under ``name`` that were entered and never done; one at most, unless runs overlapped."""
    labels = _entries(spark, path).groupBy("label").agg(F.max("done").alias("done")).where("not done")
    return [row.label for row in labels.where(F.col("label").startswith(f"{name}-")).collect()]


def forget(spark: SparkSession, path: str, label: str) -> None:
    """Closes a label whose records were taken back; its files are new again."""
    closed = spark.createDataFrame([(None, None, label, True)], schemas.ARRIVALS)
    closed.coalesce(1).write.mode("append").parquet(path)
