"""A set of queries against all rows of a table, in the cells of a grid.

Queries are dealt to parts of bounded size, rows to parts that are streamed. A cell is one part of
each: the task that has it receives the queries first, then the rows in the order asked for,
batch by batch, and keeps a few results per query. Neither side passes the driver or is broadcast;
the queries of a cell are all that is held.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows streamed through one cell, about, and the fewest that are worth a cell of their own.
CELL_ROWS = 1 << 18
LEAST_ROWS = 1 << 11
#: Partitions for each cell: cells are dealt by hash, and few of them share one where there are more.
SPREAD = 8


class Work(Protocol):
    """What one cell does; made with the cell's queries."""

    def take(self, rows: pa.StructArray) -> None: ...

    def found(self) -> pa.RecordBatch: ...


def _pieces(batches) -> Iterator[tuple[int, bool, pa.StructArray]]:
    for batch in batches:
        cell, is_row = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("cell", "is_row"))
        change = np.flatnonzero((cell[1:] != cell[:-1]) | (is_row[1:] != is_row[:-1])) + 1
        bounds = [0, *change.tolist(), len(cell)]
        for start, end in zip(bounds, bounds[1:]):
            if end > start:
                side = "row" if is_row[start] else "query"
                yield int(cell[start]), bool(is_row[start]), batch.column(side).slice(start, end - start)


def _worked(batches, make: Callable[[pa.StructArray], Work]):
    current, queries, work = None, [], None
    for cell, is_row, part in _pieces(batches):
        if cell != current:
            if work is not None:
                yield work.found()
            current, queries, work = cell, [], None
        if not is_row:
            queries.append(part)
        elif queries or work is not None:
            if work is None:
                work, queries = make(pa.concat_arrays(queries)), []
            work.take(part)
    if work is not None:
        yield work.found()


def parts_of_rows(rows: DataFrame, count: int) -> int:
    threads = 2 * rows.sparkSession.sparkContext.defaultParallelism
    return max(-(-count // CELL_ROWS), min(threads, -(-count // LEAST_ROWS)), 1)


def against_all(
    rows: DataFrame,
    row_key: str,
    row_parts: int,
    queries: DataFrame,
    query_key: str,
    query_parts: int,
    order: list[Column],
    make: Callable[[pa.StructArray], Work],
    schema: str,
) -> DataFrame:
    """What ``make``'s work finds in each cell.

    ``order`` sorts the rows of a cell, by columns of ``row``. Each query goes to ``row_parts`` cells
    and each row to ``query_parts`` cells.
    """
    no_row, no_query = (F.lit(None).cast(frame.schema) for frame in (rows, queries))
    row_part = F.pmod(F.xxhash64(row_key), F.lit(row_parts))
    query_part = F.pmod(F.xxhash64(query_key), F.lit(query_parts))
    each_query_part = F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1)))
    each_row_part = F.explode(F.sequence(F.lit(0), F.lit(row_parts - 1)))
    dealt_rows = rows.select(
        F.struct(*rows.columns).alias("row"), row_part.alias("part"), each_query_part.alias("copy")
    ).select((F.col("copy") * row_parts + F.col("part")).alias("cell"), F.lit(True).alias("is_row"), no_query.alias("query"), "row")
    dealt_queries = queries.select(
        F.struct(*queries.columns).alias("query"), query_part.alias("part"), each_row_part.alias("copy")
    ).select((F.col("part") * row_parts + F.col("copy")).alias("cell"), F.lit(False).alias("is_row"), "query", no_row.alias("row"))
    cells = dealt_rows.unionByName(dealt_queries).repartition(SPREAD * row_parts * query_parts, "cell")
    return cells.sortWithinPartitions("cell", "is_row", *order).mapInArrow(
        lambda batches: _worked(batches, make), schema
    )


class Best:
    """The ``k`` best entries of each group, by score, then by the smaller id, then key."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.group, self.score, self.id, self.key = (np.zeros(0, np.int64) for _ in range(4))
        self.lowest = np.full(groups, np.iinfo(np.int64).min)  # below it nothing enters

    def offer(self, group: np.ndarray, score: np.ndarray, ids: np.ndarray, keys: np.ndarray | None = None) -> None:
        if not len(group):
            return
        keys = np.zeros(len(group), np.int64) if keys is None else keys
        held = (self.group, self.score, self.id, self.key)
        group, score, ids, keys = (np.concatenate(x) for x in zip(held, (group, score, ids, keys)))
        order = np.lexsort((keys, ids, -score, group))
        in_order = group[order]
        starts = np.flatnonzero(np.concatenate([[True], in_order[1:] != in_order[:-1]]))
        place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
        kept = order[place < self.k]
        self.group, self.score, self.id, self.key = (x[kept] for x in (group, score, ids, keys))
        last = order[place == self.k - 1]
        self.lowest[group[last]] = score[last]
