"""Removal of lines that repeat in runs of three.

Lines are what ``\\n`` separates. Lines of white space only take no part and stay. Every three
consecutive other lines of a text make a window; windows overlap. Of equal windows anywhere
in the table the first stays, by doc_id (null first), then by text, then by place; the lines of
all later ones go. A line that any later window covers goes, so a run of equal lines shrinks to
its first.

Null text: no lines, stays null. Empty text: one line, stays. Fewer than three lines: unchanged.
Rows equal in id and text are one document. Other columns pass unchanged, except those named
like a result (``text``, ``n_lines``, ``n_removed``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import KEY, KEY_TYPE, keyed, packed, stored, unpacked, with_lists
from daybook.llm.text_arrays import RUN_BASES, RunHashes, Words, blocks, hash_runs, trimmed, utf8, window_starts

WINDOW = 3

_WINDOWS = f"{KEY_TYPE}, first long, second long, lines array<int>"


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all lines, and each text's first line."""
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([breaks, offsets[1:]]), kind="stable")
    first = np.searchsorted(breaks, offsets) + np.arange(len(offsets))
    return starts, ends, first


def _windows(batches, size):
    for batch in batches:
        for block in blocks(batch, "text"):
            data, offsets = utf8(block.column("text"))
            starts, ends, first = line_spans(data, offsets)
            words = Words(data, offsets).starts
            full = np.flatnonzero(np.searchsorted(words, ends) > np.searchsorted(words, starts))
            first_full = np.searchsorted(full, first)
            at, counts = window_starts(first_full, size)
            if not len(at):
                continue
            lines = hash_runs(data, starts[full], ends[full])
            hashes = [
                RunHashes(line.view(np.uint64), base).of(at, at + size) for line, base in zip(lines, RUN_BASES)
            ]
            row = np.repeat(np.arange(block.num_rows), counts)
            number = full - first[np.searchsorted(first, full, "right") - 1]
            covered = number[at[:, None] + np.arange(size)].astype(np.int32).ravel()
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id").take(pa.array(row)),
                    block.column("key").take(pa.array(row)),
                    *(pa.array(h.view(np.int64)) for h in hashes),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(at) + 1, dtype=np.int32) * size), pa.array(covered)
                    ),
                ],
                [*KEY, "first", "second", "lines"],
            )


def later_lines(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """Per row (``doc_id``, ``key``) the numbers of the lines that go."""
    windows = stored(keyed(docs).mapInArrow(lambda b: trimmed(_windows(b, size)), _WINDOWS))
    place = F.struct("doc_id", "key", F.col("lines")[0].alias("line"))
    repeated = (
        windows.groupBy("first", "second")
        .agg(F.count(F.lit(1)).alias("times"), F.min(place).alias("earliest"))
        .where("times > 1")
        .drop("times")
    )
    later = windows.join(repeated, ["first", "second"]).where(
        ~place.eqNullSafe(F.col("earliest"))
    )
    return later.groupBy(*KEY).agg(
        F.array_distinct(F.flatten(F.collect_list("lines"))).alias("gone")
    )


def _rebuilt(texts: pd.Series, gone: pd.Series) -> pd.DataFrame:
    rows = []
    for text, numbers in zip(texts, gone):
        if text is None:
            rows.append((None, 0, 0))
        elif numbers is None:
            rows.append((text, text.count("\n") + 1, 0))
        else:
            left_out = set(numbers.tolist())
            lines = text.split("\n")
            kept = [line for number, line in enumerate(lines) if number not in left_out]
            rows.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return pd.DataFrame(rows, columns=["text", "n_lines", "n_removed"])


def line_dedup(docs: DataFrame, size: int = WINDOW) -> DataFrame:
    """The documents without repeated windows, with ``n_lines`` and ``n_removed``."""
    # else a filter on the results makes Spark rebuild each text twice, in two Python workers per task
    rebuilt = F.pandas_udf(_rebuilt, "struct<text string, n_lines long, n_removed long>").asNondeterministic()
    found = with_lists(packed(docs), later_lines(docs, size))
    out = found.withColumn("out", rebuilt("text", "gone"))
    return unpacked(
        out, docs.columns, {name: F.col("out")[name] for name in ("text", "n_lines", "n_removed")}
    )
