"""Rows of documents carried through an operator, whatever other columns they have.

The input's columns travel in one struct, so no column of the input can clash with a working
column. A row is known by its ``doc_id`` (null counts as a value) and a hash of id and text.
Rows that repeat both are the same document twice and get the same result.
"""

from __future__ import annotations

import atexit
from contextlib import suppress

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.session import remove_folder, scratch_dir

#: Working columns by which a row is found again.
KEY = ["doc_id", "key"]
KEY_TYPE = "doc_id long, key long"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _small_batches(spark: SparkSession) -> None:
    """Lets tasks get texts in Arrow batches of 16 MB, unless the session says another size.

    A task holds a few copies of a batch, in the JVM and in Python.
    """
    if not spark._jsparkSession.conf().contains(BATCH_BYTES):
        spark.conf.set(BATCH_BYTES, "16m")


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key`` and ``text`` of each row."""
    _small_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.alias("doc_id"), F.xxhash64(doc_id, text).alias("key"), text.alias("text")
    )


def packed(docs: DataFrame) -> DataFrame:
    """As ``keyed``, and ``row`` with all columns of the input."""
    _small_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.alias("doc_id"),
        F.xxhash64(doc_id, text).alias("key"),
        text.alias("text"),
        F.struct(*[F.col(quoted(name)) for name in docs.columns]).alias("row"),
    )


def unpacked(frame: DataFrame, columns: list[str], results: dict[str, Column]) -> DataFrame:
    """The input's columns again, then the results; a result replaces a column of its name."""
    kept = [F.col("row")[name].alias(name) for name in columns if name not in results]
    return frame.select(*kept, *[value.alias(name) for name, value in results.items()])


def with_lists(left: DataFrame, lists: DataFrame, shuffled: bool = False) -> DataFrame:
    """Left join on the working key, null ids included.

    ``shuffled`` where the lists grow with the documents, so that small tables take the same way as large ones.
    """
    found = lists.withColumnsRenamed({"doc_id": "found_id", "key": "found_key"})
    if shuffled:
        found = found.hint("shuffle_merge")
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("key") == F.col("found_key"))
    return left.join(found, same, "left").drop("found_id", "found_key")


#: A key with more than this share of the rows is hot; so there are fewer hot keys than this.
HOT_SHARE = 1000
SALTS = 64


def salted_join(frame: DataFrame, counted: DataFrame, on: list[str], how: str) -> DataFrame:
    """``frame`` joined with ``counted``, a stored table of one row per key.

    Its ``times`` says about how often the key is in ``frame``. Rows of hot keys, which are fewer than ``HOT_SHARE``
    and broadcast, are spread over ``SALTS`` parts by their document, the row of ``counted`` is given to each.
    """
    total = counted.agg(F.sum("times")).first()[0] or 0
    hot = F.col("times") * HOT_SHARE > total
    keys = F.broadcast(counted.where(hot).select(*on, F.lit(True).alias("hot_key")))
    salt = F.when(F.col("hot_key"), F.pmod(F.xxhash64(*KEY), F.lit(SALTS))).otherwise(0)
    spread = frame.join(keys, on, "left").withColumn("salt", salt.cast("int")).drop("hot_key")
    parts = F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    given = counted.withColumn("salt", F.explode(parts)).drop("times")
    return spread.join(given, [*on, "salt"], how).drop("salt")


#: Folders written by this process and not removed yet.
_written: list[tuple[SparkSession, str]] = []


def stored(frame: DataFrame) -> DataFrame:
    """The frame written once to the shared folder and read from there.

    The folder is removed by ``remove_since`` or when the process ends.
    """
    spark = frame.sparkSession
    folder = scratch_dir(spark)
    if not _written:
        atexit.register(_remove, 0)
    _written.append((spark, folder))
    frame.write.parquet(f"{folder}/stored")
    return spark.read.schema(frame.schema).parquet(f"{folder}/stored")


def mark() -> int:
    """A place in the list of what was stored, for ``remove_since``."""
    return len(_written)


def remove_since(start: int) -> None:
    """Removes what was stored since ``mark`` gave ``start``, all but the last."""
    if len(_written) > start:
        last = _written.pop()
        _remove(start)
        _written.append(last)


def _remove(start: int) -> None:
    while len(_written) > start:
        spark, folder = _written.pop()
        with suppress(Exception):  # a session that is gone, at the end of the process
            remove_folder(spark, folder)
