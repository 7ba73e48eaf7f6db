"""Hard negatives: rows of another label that score almost as high as a positive.

A row's score for an anchor is the inner product of their vectors in whole numbers; higher scores come
first, ties by the smaller ``vec_id``. The positives of an anchor are the best other rows of its label.
A positive's window holds the rows of other labels that score at most as high as it and at least
``percent`` of it; the best of each window are returned.

The windows of one anchor overlap. Their upper limits split the scores into disjoint slots, so a row
of another label lies in one slot. Each cell of the grid (see ``cells``) keeps the best few of each
slot, a window function merges cells, and a window is answered by the slots from its own limit down:
its first few rows in descending order, of which those above its lower limit remain.

Rows with a null ``vec_id``, label or vector, or a null or non-finite component, take no part. Of rows with
one ``vec_id`` the least by label, then by vector, counts. Vectors of different length are compared as
if zeros followed the shorter; an empty vector scores 0. Positives below zero have no window. Components
are ``floor(scale * x)`` in 64 bits; scores must fit 64 bits. Columns other than the three are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.cells import Best, against_all, parts_of_rows
from daybook.llm.rows import stored

POSITIVES = 5
NEGATIVES = 5
PERCENT = 80
SCALE = 256
#: Anchors held by one cell, about.
CELL_ANCHORS = 1 << 13
#: Scores computed at once.
BLOCK_SCORES = 1 << 20
#: Doubles hold whole numbers up to here exactly.
EXACT = 1 << 53

_FOUND = "anchor_id long, slot int, vec_id long, score long"


def clean_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """One row per ``vec_id`` with ``label`` and whole-number components ``v``."""
    given = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("int").alias("label"),
        F.col("embedding").cast("array<double>").alias("x"),
    )
    infinity = F.lit(float("inf"))
    unusable = F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinity))
    usable = given.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & ~unusable)
    whole = F.transform("x", lambda x: F.floor(x * F.lit(float(scale))))
    one = usable.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("one"))
    return one.select("vec_id", "one.*").select("vec_id", "label", whole.alias("v"))


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """Vectors as rows, zeros behind the shorter ones."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0))
    if len(flat) == width * len(lengths):
        return flat.reshape(len(lengths), width)
    matrix = np.zeros((len(lengths), width), np.int64)
    matrix[np.arange(width) < lengths[:, None]] = flat
    return matrix


def _most(matrix: np.ndarray) -> int:
    return max(-int(matrix.min(initial=0)), int(matrix.max(initial=0)))


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """All inner products, exact: in doubles where these hold every sum, else in 64-bit integers."""
    width = min(anchors.shape[1], rows.shape[1])
    anchors, rows = anchors[:, :width], rows[:, :width]
    if _most(anchors) * _most(rows) * width < EXACT:
        return (anchors.astype(float) @ rows.T.astype(float)).astype(np.int64)
    return anchors @ rows.T


class _Scores:
    """Blocks of scores of a cell's anchors and the rows that stream by."""

    def __init__(self, anchors: pa.StructArray, k: int, slots: int):
        self.ids = anchors.field("vec_id").to_numpy()
        self.labels = anchors.field("label").to_numpy()
        self.vectors = _matrix(anchors.field("v"))
        self.slots = slots
        self.best = Best(len(self.ids) * slots, k)

    def take(self, rows: pa.StructArray) -> None:
        ids, labels = (rows.field(k).to_numpy() for k in ("vec_id", "label"))
        vectors = _matrix(rows.field("v"))
        step = max(BLOCK_SCORES // len(self.ids), 1)
        start = 0
        while start < len(ids):
            # a small block first: the scores found in it keep most of the others out
            size = step if len(self.best.group) else max(step // 8, 1)
            part = slice(start, start + size)
            self.offer(products(self.vectors, vectors[part]), ids[part], labels[part])
            start += size

    def offer(self, scores, ids, labels) -> None:
        raise NotImplementedError

    def enter(self, slot: int, scores, ids, allowed) -> None:
        groups = np.arange(len(self.ids)) * self.slots + slot
        anchor, row = np.nonzero(allowed & (scores >= self.best.lowest[groups][:, None]))
        self.best.offer(groups[anchor], scores[anchor, row], ids[row])

    def found(self) -> pa.RecordBatch:
        best = self.best
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.ids[best.group // self.slots]),
                pa.array((best.group % self.slots).astype(np.int32)),
                pa.array(best.id),
                pa.array(best.score),
            ],
            ["anchor_id", "slot", "vec_id", "score"],
        )


class _Positives(_Scores):
    def __init__(self, anchors: pa.StructArray, k: int):
        super().__init__(anchors, k, 1)

    def offer(self, scores, ids, labels) -> None:
        same = (labels == self.labels[:, None]) & (ids != self.ids[:, None])
        self.enter(0, scores, ids, same)


class _Slots(_Scores):
    def __init__(self, anchors: pa.StructArray, k: int, percent: int):
        lists = anchors.field("limits").to_pylist()
        slots = max(map(len, lists))
        super().__init__(anchors, k, slots)
        # a slot that an anchor lacks has no scores; the last one ends at the least lower limit
        self.upper = np.full((len(lists), slots), -1)
        self.lower = np.zeros((len(lists), slots), np.int64)
        for number, limits in enumerate(lists):
            self.upper[number, : len(limits)] = limits
            self.lower[number, : len(limits)] = [*(x + 1 for x in limits[1:]), -(-percent * limits[-1] // 100)]

    def offer(self, scores, ids, labels) -> None:
        other = labels != self.labels[:, None]
        for slot in range(self.slots):
            within = (scores <= self.upper[:, slot, None]) & (scores >= self.lower[:, slot, None])
            self.enter(slot, scores, ids, other & within)


def _best(found: DataFrame, groups: list[str], k: int) -> DataFrame:
    """The best ``k`` of each group with their ``rank``; Spark limits groups before the shuffle."""
    order = Window.partitionBy(*groups).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    percent: int = PERCENT,
    scale: int = SCALE,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores.

    ``vectors`` has ``vec_id``, ``label`` and ``embedding``; ``is_anchor`` is a condition on ``vec_id``.
    """
    rows = stored(clean_vectors(vectors, scale))
    anchors = rows.where(is_anchor)
    counts = rows.agg(F.count("*").alias("rows"), F.count(F.when(is_anchor, 1)).alias("anchors")).first()
    grid = {
        "row_key": "vec_id",
        "row_parts": parts_of_rows(rows, counts["rows"]),
        "query_key": "vec_id",
        "query_parts": max(-(-counts["anchors"] // CELL_ANCHORS), 1),
        "order": [F.col("row.vec_id")],
        "schema": _FOUND,
    }
    near = against_all(rows, queries=anchors, make=lambda x: _Positives(x, positives), **grid)
    chosen = stored(_best(near, ["anchor_id"], positives).select("anchor_id", F.col("vec_id").alias("positive_id"), "score"))

    limits = chosen.where("score >= 0").groupBy("anchor_id").agg(
        F.sort_array(F.collect_set("score"), asc=False).alias("limits")
    )
    asking = anchors.join(limits.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    slots = against_all(rows, queries=asking, make=lambda x: _Slots(x, negatives, percent), **grid)
    # at most positives * negatives rows of an anchor, in descending order of score
    entry = F.struct("slot", F.negative("score").alias("down"), F.col("vec_id").alias("negative_id"))
    descending = _best(slots, ["anchor_id", "slot"], negatives).groupBy("anchor_id").agg(
        F.array_sort(F.collect_list(entry)).alias("entries")
    )
    own_slot = (F.array_position("limits", F.col("score")) - 1).alias("own")
    window = F.slice(F.filter("entries", lambda x: x["slot"] >= F.col("own")), 1, negatives)
    asked = chosen.where("score >= 0").join(limits, "anchor_id").select("anchor_id", "positive_id", "score", own_slot)
    return (
        asked.join(descending, "anchor_id")
        .select("anchor_id", "positive_id", F.col("score").alias("positive_score"), F.posexplode(window).alias("place", "entry"))
        .withColumn("negative_score", F.negative("entry.down"))
        .where(F.lit(100) * F.col("negative_score") >= F.lit(percent) * F.col("positive_score"))
        .select(
            "anchor_id",
            "positive_id",
            (F.col("place") + 1).cast("int").alias("rank"),
            F.col("entry.negative_id").alias("negative_id"),
            "positive_score",
            "negative_score",
        )
    )
