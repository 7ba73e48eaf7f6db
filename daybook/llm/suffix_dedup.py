"""Removal of byte strings that occur more than once, by suffix arrays of shards.

Texts are taken as UTF-8. Every byte covered by ``window`` consecutive bytes of one text that also
start anywhere else goes, in all places; the judgement is on the input, not on what is left.
Runs of the remaining bytes are joined as they are, so a character may be cut.

Which windows can be equal is settled by anchors (see ``segments``): only segments that share
their anchor, without being equal, are compared. They are dealt by anchor, so equal
windows meet in one shard. A shard is the segments' bytes one after the other, each followed by
a separator. Its suffix array comes from induced sorting (see ``suffix_arrays``); where a suffix
and its neighbour have a common prefix of a whole window, both windows are repeated.

An anchor with more than ``HOT`` different segments would make a shard too large for one task.
Its windows are compared one by one instead, by hashes of their first half and of all of them, so
nothing is left out. Both take the segments' bytes from one pass over the texts.

Null and empty texts have no bytes. Texts shorter than the window stay. Rows equal in id and text are
two occurrences of each other. Other columns pass unchanged, except those named like a result
(``kept``, ``n_bytes``, ``n_removed``, ``spans``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import KEY, KEY_TYPE, packed, stored, unpacked, with_lists
from daybook.llm.segments import WINDOW_TYPE, asked, byte_symbols, covered, recurring, repeats
from daybook.llm.suffix_arrays import common_prefixes, suffix_array
from daybook.llm.text_arrays import blocks, hash_runs, trimmed, utf8

WINDOW = 400
ANCHOR = 128
HOT = 4096
SHARD_BYTES = 1 << 20
#: Bytes of segments for each task that builds shards.
TASK_BYTES = 8 << 20
#: Pieces whose windows are listed at a time; a piece has less than twice the bytes of a window.
PIECE_ROWS = 1024

_PIECE = f"{KEY_TYPE}, first int, weight int, anchor long, hot boolean, bytes binary"


def _pieces(batches, window: int):
    """The bytes of the listed segments."""
    for batch in batches:
        for block in blocks(batch, "text"):
            data, offsets = utf8(block.column("text"))
            lists = block.column("wanted")
            parts = lists.flatten()
            first, n, weight = (parts.field(k).to_numpy() for k in range(3))
            row = np.repeat(np.arange(block.num_rows), lists.value_lengths().to_numpy())
            begins = (offsets[row] + first).tolist()
            lengths = (n + window - 1).tolist()
            pieces = [data[at : at + length].tobytes() for at, length in zip(begins, lengths)]
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id").take(pa.array(row)),
                    block.column("key").take(pa.array(row)),
                    pa.array(first.astype(np.int32)),
                    pa.array(weight.astype(np.int32)),
                    parts.field(3),
                    parts.field(4),
                    pa.array(pieces, pa.binary()),
                ],
                [*KEY, "first", "weight", "anchor", "hot", "bytes"],
            )


def _windows(batches, window: int):
    """A row for each window of the pieces: hashes of its first half and of all of it."""
    half = -(-window // 2)
    for batch in batches:
        for at in range(0, batch.num_rows, PIECE_ROWS):
            rows = batch.slice(at, PIECE_ROWS)
            pieces = rows.column("bytes").to_pylist()
            data = np.frombuffer(b"".join(pieces), np.uint8)
            lengths = np.array([len(x) for x in pieces])
            n = lengths - window + 1
            each = np.repeat(np.arange(len(n)), n)
            offset = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
            start = (np.cumsum(lengths) - lengths)[each] + offset
            place = rows.column("first").to_numpy()[each] + offset
            yield pa.RecordBatch.from_arrays(
                [
                    *(rows.column(name).take(pa.array(each)) for name in KEY),
                    pa.array(place.astype(np.int32)),
                    rows.column("weight").take(pa.array(each)),
                    pa.array(hash_runs(data, start, start + half)[0]),
                    pa.array(hash_runs(data, start, start + window)[0]),
                ],
                [*KEY, "first", "weight", "half", "full"],
            )


def _shards(batches) -> Iterator[pa.Table]:
    """Rows, sorted by anchor, in tables of about ``SHARD_BYTES`` that no anchor straddles."""
    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        anchors = batch.column("anchor").to_numpy()
        changes = [0, *(np.flatnonzero(anchors[1:] != anchors[:-1]) + 1).tolist(), len(anchors)]
        last = waiting[-1].column("anchor")[-1].as_py() if waiting else None
        for a, b in zip(changes[:-1], changes[1:]):
            if size >= SHARD_BYTES and anchors[a] != last:
                yield pa.Table.from_batches(waiting)
                waiting, size = [], 0
            part = batch.slice(a, b - a)
            waiting.append(part)
            size += pa.compute.sum(pa.compute.binary_length(part.column("bytes"))).as_py() or 0
            last = anchors[a]
    if size:
        yield pa.Table.from_batches(waiting)


def repeated_in_shard(pieces: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Piece and offset of every window whose bytes also start elsewhere in the pieces."""
    lengths = np.array([len(x) for x in pieces])
    ends = np.cumsum(lengths + 1) - 1  # separators
    text = np.frombuffer(b"\0".join([*pieces, b""]), np.uint8).astype(np.uint16) + 1
    text[ends] = 0
    owner = np.repeat(np.arange(len(pieces)), lengths + 1)
    place = np.arange(len(text))
    order = suffix_array(text, 257)
    before, prefix = common_prefixes(text, order, ends[owner] - place, window)
    found = np.flatnonzero(prefix >= window)
    hit = np.zeros(len(text), bool)
    hit[found] = True
    hit[before[found]] = True
    at = np.flatnonzero(hit)
    return owner[at], at - (ends - lengths)[owner[at]]


def _repeated(batches, window: int):
    for shard in _shards(batches):
        rows = shard.combine_chunks()
        piece, offset = repeated_in_shard(rows.column("bytes").to_pylist(), window)
        single = rows.column("weight").to_numpy()[piece] == 1
        piece, offset = piece[single], offset[single]
        if not len(piece):
            continue
        first = rows.column("first").to_numpy()[piece] + offset
        cut = np.flatnonzero((np.diff(piece) != 0) | (np.diff(first) != 1)) + 1
        starts = np.concatenate([[0], cut])
        n = np.diff(np.append(starts, len(piece)))
        row = pa.array(piece[starts])
        yield pa.RecordBatch.from_arrays(
            [
                *(rows.column(name).combine_chunks().take(row) for name in KEY),
                pa.array(first[starts].astype(np.int32)),
                pa.array(n.astype(np.int32)),
            ],
            [*KEY, "first", "n"],
        )


def repeated_windows(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """``doc_id``, ``key``, ``first``, ``n``: runs of window starts whose windows occur again."""
    found = repeats(docs, byte_symbols, window, min(anchor, window))
    opened = stored(found.open)
    total, crowded = opened.agg(
        F.coalesce(F.sum(F.col("n") + window), F.lit(0)),
        F.coalesce(F.max("kinds"), F.lit(0)),
    ).first()
    marked = opened.withColumn("hot", F.col("kinds") > hot)
    pieces = asked(docs, marked, shuffled=True, also=("hot",)).mapInArrow(
        lambda b: trimmed(_pieces(b, window)), _PIECE
    )
    if crowded > hot:
        pieces = stored(pieces)  # for the shards and for the windows, so that texts are dealt once
    tasks = max(int(total) // TASK_BYTES, 2 * docs.sparkSession.sparkContext.defaultParallelism)
    dealt = pieces.where("not hot").drop("hot").repartition(tasks, "anchor").sortWithinPartitions("anchor")
    runs = found.whole.unionByName(
        dealt.mapInArrow(lambda b: trimmed(_repeated(b, window)), f"{KEY_TYPE}, first int, n int")
    )
    if crowded > hot:
        windows = pieces.where("hot").mapInArrow(lambda b: trimmed(_windows(b, window)), WINDOW_TYPE)
        runs = runs.unionByName(recurring(stored(windows)))
    return runs


def _kept(texts: pd.Series, runs: pd.Series, window: int) -> list[tuple]:
    rows = []
    for text, spans in zip(texts, runs):
        data = (text or "").encode()
        if spans is None or not len(spans):
            rows.append((data, len(data), 0, []))
            continue
        first = np.array([x["first"] for x in spans])
        n = np.array([x["n"] for x in spans])
        gone = covered(len(data), first, n, window)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        cut = [{"start": a, "length": b - a} for a, b in zip(starts.tolist(), ends.tolist())]
        rows.append((kept, len(data), int(gone.sum()), cut))
    return rows


def suffix_dedup(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """The documents with ``kept`` bytes, ``n_bytes``, ``n_removed`` and the removed ``spans``."""
    names = ["kept", "n_bytes", "n_removed", "spans"]

    @F.pandas_udf(
        "struct<kept binary, n_bytes long, n_removed long, spans array<struct<start: long, length: long>>>"
    )
    def rebuilt(texts: pd.Series, runs: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(_kept(texts, runs, window), columns=names)

    runs = repeated_windows(docs, window, anchor, hot)
    lists = runs.groupBy(*KEY).agg(F.collect_list(F.struct("first", "n")).alias("runs"))
    out = with_lists(packed(docs), lists, shuffled=True).withColumn("out", rebuilt("text", "runs"))
    return unpacked(out, docs.columns, {name: F.col("out")[name] for name in names})
