"""Quotes as objects of their own: ``{symbol}/{date}.json`` with the body ``{"price": 0.72}``.

A quote is stored without touching another: each task puts the objects of its rows, under another name
first, then moved into place, so that a reader finds the old body or the new one. Rows that are put
again by a repeated task have the same outcome. Tasks reach the store through pyarrow's file
systems (local and mounted folders, ``hdfs``, ``s3``, ``gs``), as Spark's writers choose their own file names.
"""

from __future__ import annotations

import json
import math
import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.operators.quote_store import one_quote_a_day

#: Scheme names of Hadoop that pyarrow knows under another one.
_SCHEMES = {"s3a://": "s3://", "s3n://": "s3://"}


def known_path(path: str) -> str:
    """The path as pyarrow writes it."""
    for name, known in _SCHEMES.items():
        if path.startswith(name):
            return known + path.removeprefix(name)
    if path.startswith("file:/") and not path.startswith("file://"):
        return path.removeprefix("file:")
    return path


def body_of(price: float | None) -> bytes:
    """The object's text; a price that JSON cannot write is none."""
    return json.dumps({"price": price if price is not None and math.isfinite(price) else None}).encode()


def _put(batches, path: str):
    store, root = fs.FileSystem.from_uri(known_path(path))
    for batch in batches:
        for symbol, day, price in zip(*(batch.column(k).to_pylist() for k in ("symbol", "date", "price"))):
            folder = f"{root.rstrip('/')}/{symbol}"
            draft = f"{folder}/.{day}-{uuid.uuid4().hex}"
            store.create_dir(folder, recursive=True)
            with store.open_output_stream(draft) as out:
                out.write(body_of(price))
            store.move(draft, f"{folder}/{day}.json")
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["objects"])


def put_quotes(quotes: DataFrame, path: str) -> int:
    """Puts an object for each symbol and date below ``path``, and returns how many.

    Of several quotes for one key the lowest usable one is put. A symbol must be usable as a folder
    that readers see: not empty, without a slash, and not starting with a dot or an underscore.
    """
    usable_key = F.col("symbol").rlike(r"^[^/._\x00][^/\x00]*$") & F.col("date").isNotNull()
    unusable = F.concat(F.lit("no quote object for: "), F.concat_ws(" ", "symbol", F.col("date").cast("string")))
    checked = one_quote_a_day(quotes).select(
        F.when(F.coalesce(usable_key, F.lit(False)), F.col("symbol")).otherwise(F.raise_error(unusable)).alias("symbol"),
        F.col("date").cast("string").alias("date"),
        "price",
    )
    put = checked.mapInArrow(lambda batches: _put(batches, path), "objects long")
    return put.agg(F.coalesce(F.sum("objects"), F.lit(0))).first()[0]
