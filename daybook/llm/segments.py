"""Windows of a fixed length that occur more than once in a corpus.

Hashing every window would move many times the corpus. Instead each window is dealt to the
run of ``anchor`` symbols in it whose hash is least (the leftmost of equals); equal windows
choose equal anchors at equal offsets. Consecutive windows with the same anchor form a
segment, known by a hash of its symbols. Only segments whose anchor occurs again can hold a
repeated window. A whole segment that occurs again is repeated in all its windows; of the other
segments, windows are compared with those of segments that share the anchor.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import KEY, KEY_TYPE, keyed, salted_join, stored, with_lists
from daybook.llm.text_arrays import (
    BYTE_SYMBOLS,
    WORD_BASE,
    RunHashes,
    Words,
    blocks,
    hash_runs,
    sliding_min,
    trimmed,
    utf8,
    window_starts,
)

#: Turns the texts of a block into symbols and tells where each text's symbols start.
Symbols = Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]

#: Bits that hold a place in a block; the others compare anchors. The same for blocks of every
#: length: else two hashes could be equal in one block and different in another.
_PLACE = np.uint64((1 << 32) - 1)


def word_symbols(block: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    words = Words(*utf8(block.column("text")))
    return words.hashes(), words.first


def byte_symbols(block: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = utf8(block.column("text"))
    return BYTE_SYMBOLS[data], offsets


class Segments(NamedTuple):
    text: np.ndarray  # number of the text in the block
    first: np.ndarray  # first window, counted from the text's start
    n: np.ndarray  # windows
    anchor: np.ndarray
    left: np.ndarray  # two hashes of the segment's symbols
    right: np.ndarray


def segments(symbols: np.ndarray, first: np.ndarray, window: int, anchor: int) -> Segments:
    """All segments of a block; ``first`` has where each text starts, and the end."""
    starts, _ = window_starts(first, window)
    if not len(starts):
        return Segments(*(np.zeros(0, np.int64) for _ in Segments._fields))
    at = np.arange(len(symbols) - anchor + 1)
    grams = RunHashes(symbols, WORD_BASE).of(at, at + anchor)
    least = sliding_min((grams & ~_PLACE) | at.astype(np.uint64), window - anchor + 1)
    chosen = (least[starts] & _PLACE).astype(np.int64)
    change = np.concatenate([[0], np.flatnonzero(chosen[1:] != chosen[:-1]) + 1])
    n = np.diff(change, append=len(starts))
    begins = starts[change]
    ends = begins + n - 1 + window
    text = np.searchsorted(first, begins, "right") - 1
    hashes = hash_runs(symbols, begins, ends)
    return Segments(text, begins - first[text], n, grams[chosen[change]].view(np.int64), *hashes)


def _segments(batches, symbols_of: Symbols, window: int, anchor: int):
    for batch in batches:
        for block in blocks(batch, "text"):
            found = segments(*symbols_of(block), window, anchor)
            row = pa.array(found.text)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id").take(row),
                    block.column("key").take(row),
                    pa.array(found.first.astype(np.int32)),
                    pa.array(found.n.astype(np.int32)),
                    pa.array(found.anchor),
                    pa.array(found.left),
                    pa.array(found.right),
                ],
                [*KEY, "first", "n", "anchor", "left", "right"],
            )


class Repeats(NamedTuple):
    whole: DataFrame  # doc_id, key, first, n: segments that occur again
    open: DataFrame  # one of each segment that shares an anchor with another, and its weight


def repeats(docs: DataFrame, symbols_of: Symbols, window: int, anchor: int) -> Repeats:
    """Segments that occur again, and those whose windows must be compared.

    ``weight`` is 2 for a segment that occurs more than once, else 1; ``kinds`` is the number of
    different segments with the anchor.
    """
    found = keyed(docs).mapInArrow(
        lambda b: trimmed(_segments(b, symbols_of, window, anchor)),
        f"{KEY_TYPE}, first int, n int, anchor long, left long, right long",
    )
    anchors = stored(found.groupBy("anchor").agg(F.count(F.lit(1)).alias("times")).where("times > 1"))
    candidates = stored(salted_join(found, anchors, ["anchor"], "left_semi"))
    kind = ["anchor", "left", "right"]
    kinds = stored(
        candidates.groupBy(*kind).agg(
            F.count(F.lit(1)).alias("times"), F.min(F.struct(*KEY, "first", "n")).alias("one")
        )
    )
    again = kinds.where("times > 1").select(*kind, "times")
    whole = salted_join(candidates, again, kind, "left_semi")
    shared = stored(kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"))
    shared = shared.withColumn("times", F.col("kinds"))
    weight = F.least(F.col("times"), F.lit(2)).cast("int").alias("weight")
    opened = salted_join(kinds.select("anchor", "one.*", weight), shared, ["anchor"], "inner")
    return Repeats(whole.select(*KEY, "first", "n"), opened)


def asked(docs: DataFrame, opened: DataFrame, shuffled: bool = False, also: tuple[str, ...] = ()) -> DataFrame:
    """The texts of open segments, each with the list ``wanted`` of its segments; ``also``: columns to list besides."""
    part = F.struct("first", "n", "weight", "anchor", *also)
    wanted = opened.groupBy(*KEY).agg(F.collect_list(part).alias("wanted"))
    return with_lists(keyed(docs), wanted, shuffled).where("wanted is not null")


def _windows(batches, symbols_of: Symbols, window: int):
    """A row for each window of the listed segments: hashes of its first half and of all of it."""
    half = -(-window // 2)
    for batch in batches:
        for block in blocks(batch, "text"):
            symbols, begins = symbols_of(block)
            lists = block.column("wanted")
            parts = lists.flatten()
            first, n, weight = (parts.field(k).to_numpy() for k in range(3))
            row = np.repeat(np.arange(block.num_rows), lists.value_lengths().to_numpy())
            each = np.repeat(np.arange(len(n)), n)
            place = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n) + first[each]
            at = begins[row[each]] + place
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id").take(pa.array(row[each])),
                    block.column("key").take(pa.array(row[each])),
                    pa.array(place.astype(np.int32)),
                    pa.array(weight[each].astype(np.int32)),
                    pa.array(hash_runs(symbols, at, at + half)[0]),
                    pa.array(hash_runs(symbols, at, at + window)[0]),
                ],
                [*KEY, "first", "weight", "half", "full"],
            )


#: A window's hashes of its first half and of all of it, and the weight of its segment.
WINDOW_TYPE = f"{KEY_TYPE}, first int, weight int, half long, full long"


def compared(docs: DataFrame, opened: DataFrame, symbols_of: Symbols, window: int) -> DataFrame:
    """Windows of the open segments that occur again."""
    found = asked(docs, opened).mapInArrow(lambda b: trimmed(_windows(b, symbols_of, window)), WINDOW_TYPE)
    return recurring(stored(found))


def recurring(windows: DataFrame) -> DataFrame:
    """Of stored windows those that occur again, by their first half, then as a whole."""
    halves = windows.groupBy("half").agg(F.sum("weight").alias("times")).where("times > 1")
    longer = windows.join(halves.select("half"), "half", "left_semi")
    again = longer.groupBy("half", "full").agg(F.sum("weight").alias("times")).where("times > 1")
    return (
        longer.where("weight = 1")
        .join(again.select("half", "full"), ["half", "full"], "left_semi")
        .select(*KEY, "first", F.lit(1).alias("n"))
    )


def covered(n: int, firsts: np.ndarray, counts: np.ndarray, window: int) -> np.ndarray:
    """Which of ``n`` symbols lie in the windows that start at ``first`` .. ``first + count - 1``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, firsts, 1)
    np.add.at(edge, firsts + counts - 1 + window, -1)
    return np.cumsum(edge[:-1]) > 0
