"""The best documents for each query, by an integer score of weighted terms.

Terms are runs of ASCII letters and digits and of characters beyond ASCII; only A-Z is lower-cased. A
document is a vector of impacts, a query one of weights (of its terms' rarity, added for repeats),
the score their inner product:

* ``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` with N the documents that have a term,
* ``m = 100 - 75 + (75 * n * N) div L`` with n the document's terms and L those of all documents,
* ``impact = (10**9 * tf) div (1000 * tf + 8 * m)``.

Documents are streamed in order of length (norm) of their vectors, the longest first, a bucket at a
time. A query whose norm times that of the bucket's longest document stays below its score to beat (the
tenth best so far) is through with this bucket and all later ones. Inside a bucket only the query's
heaviest coordinates are looked up first, as many as are needed for the others not to reach half of
the score to beat; the other coordinates are bounded by Cauchy and Schwarz, and by the document's largest
impact. Documents whose bound reaches the score to beat are scored again, exactly, in whole numbers.
Every document is searched: the bounds leave out only what cannot be among the best.

Null and empty texts have no terms. A document without ``doc_id`` counts in N, L and df but is not
ranked. Rows that repeat a document are ranked each; equal scores go by ``doc_id``, then by a hash of the
text. Queries equal in id and text are one; texts that share an id are ranked each on its own.
A query without terms, or whose terms all weigh nothing or occur nowhere, has no rows. Columns other than
``doc_id`` and ``text``, ``item_id`` and ``text`` are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.cells import Best, against_all, parts_of_rows
from daybook.llm.rows import KEY, KEY_TYPE, keyed, stored
from daybook.llm.text_arrays import blocks, trimmed

BEST = 10
#: Terms of all queries of a cell, about.
CELL_TERMS = 1 << 17
#: Documents of a bucket, and the products looked up at once.
BUCKET = 512
PRODUCTS = 1 << 20
#: Text whose terms are counted at once.
COUNTED_BYTES = 1 << 20
#: Room for rounding in bounds, which are compared as doubles.
SLACK = 1 + 1e-9
#: What differences of sums may be short of, as a share of the sum.
ROUNDING = 1e-14

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = {code: code + 32 for code in range(ord("A"), ord("Z") + 1)}

#: Terms hold no space, so one string has them all; it takes less room than a list.
_COUNTED = f"{KEY_TYPE}, n long, terms string, tfs array<int>"
_FOUND = "item_id long, item_key long, doc_id long, doc_key long, score long"


def terms_of(text: str | None) -> list[str]:
    return _TERM.findall(text.translate(_LOWER)) if text else []


def _counted(batches):
    for batch in batches:
        for block in blocks(batch, "text", COUNTED_BYTES):
            counts = [Counter(terms_of(text)) for text in block.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    block.column("key"),
                    pa.array([x.total() for x in counts], pa.int64()),
                    pa.array([" ".join(x) for x in counts], pa.string()),
                    pa.array([list(x.values()) for x in counts], pa.list_(pa.int32())),
                ],
                [*KEY, "n", "terms", "tfs"],
            )


def term_counts(texts: DataFrame) -> DataFrame:
    """``n``, the different ``terms``, joined by spaces, and their ``tfs`` of each row that ``keyed`` gives."""
    return texts.mapInArrow(lambda b: trimmed(_counted(b)), _COUNTED)


def _lists(lists: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """The row of each element, and the elements."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(lists)), lengths), lists.flatten()


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of the range of each element of consecutive ranges, and the elements."""
    number = np.repeat(np.arange(len(sizes)), sizes)
    return number, np.arange(len(number)) - (np.cumsum(sizes) - sizes)[number] + starts[number]


def _exact_sums(groups: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums of whole numbers; each half of their bits is added in doubles, which is exact here."""
    low = np.bincount(groups, values & 0x3FFFFFF, size).astype(np.int64)
    return (np.bincount(groups, values >> 26, size).astype(np.int64) << 26) + low


class _Bucket:
    """The vectors of some documents: impacts by column, then by document."""

    def __init__(self, docs: pa.StructArray, vocabulary: pa.Array):
        doc, terms = _lists(pc.split_pattern(docs.field("terms"), " "))
        found = pc.index_in(terms, vocabulary)
        known = found.is_valid().to_numpy(zero_copy_only=False)
        doc, column = doc[known], found.drop_null().to_numpy().astype(np.int64)
        impact = docs.field("impacts").flatten().to_numpy()[known].astype(np.int64)
        self.n = len(docs)
        self.squares = np.bincount(doc, impact.astype(float) ** 2, self.n)
        self.most = np.zeros(self.n, np.int64)
        np.maximum.at(self.most, doc, impact)
        key = column * self.n + doc
        order = np.argsort(key)
        self.key, self.doc, self.impact = key[order], doc[order], impact[order]
        self.edges = np.searchsorted(self.key, np.arange(len(vocabulary) + 1) * self.n)

    def sizes(self, columns: np.ndarray) -> np.ndarray:
        return self.edges[columns + 1] - self.edges[columns]

    def at(self, columns: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Impacts at the given coordinates, 0 where there is none."""
        key = columns * self.n + docs
        place = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[place] == key, self.impact[place], 0)


class _Search:
    """Queries of a cell, and their best documents among those that stream by."""

    def __init__(self, queries: pa.StructArray, k: int):
        self.ids, self.keys = queries.field("item_id"), queries.field("item_key")
        row, terms = _lists(queries.field("terms"))
        weight = queries.field("weights").flatten().to_numpy()
        self.count = len(queries)
        self.vocabulary = terms.unique()
        column = pc.index_in(terms, self.vocabulary).to_numpy().astype(np.int64)
        order = np.lexsort((-weight, row))  # the heaviest coordinates of a query first
        self.row, self.column, self.weight = row[order], column[order], weight[order]
        self.edges = np.searchsorted(self.row, np.arange(self.count + 1))
        real = self.weight.astype(float)
        self.norm = np.sqrt(np.bincount(self.row, real**2, self.count))
        # what the coordinates of a query from each one on add up to; nothing behind the last
        self.rest, self.rest_norm = self._from_here_on(real), np.sqrt(self._from_here_on(real**2))
        most_terms = int(np.diff(self.edges).max())
        self.bucket_size = max(min(BUCKET, PRODUCTS // most_terms), 1)
        self.best = Best(self.count, k)
        self.done = False

    def _from_here_on(self, values: np.ndarray) -> np.ndarray:
        sums = np.append(np.cumsum(values[::-1])[::-1], 0.0)
        own = sums[:-1] - sums[self.edges[1:]][self.row] + sums[0] * ROUNDING
        return np.append(np.maximum(own, values), 0.0)

    def take(self, rows: pa.StructArray) -> None:
        for start in range(0, len(rows), self.bucket_size):
            if not self.done:
                self.search(rows.slice(start, self.bucket_size))

    def search(self, docs: pa.StructArray) -> None:
        lowest = np.maximum(self.best.lowest, 1).astype(float)
        alive = self.norm * docs.field("norm")[0].as_py() * SLACK >= lowest
        if not alive.any():
            self.done = True  # the documents after these are no longer
            return
        bucket = _Bucket(docs, self.vocabulary)
        if not len(bucket.key):
            return
        # coordinates to look up: until the others cannot reach half of the score to beat
        focus = alive[self.row] & (self.rest[:-1] * bucket.most.max() >= 0.5 * lowest[self.row])
        work = np.bincount(self.row[focus], bucket.sizes(self.column[focus]), self.count) + bucket.n
        batch = (np.cumsum(work) // PRODUCTS).astype(np.int64)
        for number in np.unique(batch[alive]):
            self._search_some(docs, bucket, np.flatnonzero(alive & (batch == number)), focus, lowest)

    def _search_some(self, docs, bucket, queries, focus, lowest) -> None:
        local = np.full(self.count, -1)
        local[queries] = np.arange(len(queries))
        entries = np.flatnonzero(focus & (local[self.row] >= 0))
        owner = local[self.row[entries]]
        columns = self.column[entries]
        number, place = _ranges(bucket.edges[columns], bucket.sizes(columns))
        pair = owner[number] * bucket.n + bucket.doc[place]
        impact = bucket.impact[place].astype(float)
        shape = (len(queries), bucket.n)
        size = shape[0] * shape[1]
        looked_up = np.bincount(pair, impact * self.weight[entries][number], size).reshape(shape)
        squares = np.bincount(pair, impact**2, size).reshape(shape)
        # the first coordinate of each query that was not looked up, if any
        after = self.edges[:-1][queries] + np.bincount(owner, minlength=len(queries))
        after = np.where(after < self.edges[1:][queries], after, len(self.row))
        others = np.sqrt(np.maximum(bucket.squares * (1 + ROUNDING) - squares, 0)) * self.rest_norm[after][:, None]
        others = np.minimum(others, bucket.most * self.rest[after][:, None])
        query, doc = np.nonzero((looked_up + others) * SLACK >= lowest[queries][:, None])
        query = queries[query]
        step = max(PRODUCTS // int(np.diff(self.edges).max()), 1)
        for start in range(0, len(query), step):
            self._rescore(docs, bucket, query[start : start + step], doc[start : start + step])

    def _rescore(self, docs, bucket, query, doc) -> None:
        pair, entry = _ranges(self.edges[query], np.diff(self.edges)[query])
        impact = bucket.at(self.column[entry], doc[pair])
        score = _exact_sums(pair, impact * self.weight[entry], len(query))
        enough = np.flatnonzero((score > 0) & (score >= self.best.lowest[query]))
        ids, keys = (docs.field(x).to_numpy()[doc[enough]] for x in ("doc_id", "doc_key"))
        self.best.offer(query[enough], score[enough], ids, keys)

    def found(self) -> pa.RecordBatch:
        best, group = self.best, pa.array(self.best.group)
        columns = [self.ids.take(group), self.keys.take(group), *map(pa.array, (best.id, best.key, best.score))]
        return pa.RecordBatch.from_arrays(columns, ["item_id", "item_key", "doc_id", "doc_key", "score"])


def _weighted(items: DataFrame, counted: DataFrame, documents: int) -> DataFrame:
    """Queries as vectors: ``item_id``, ``item_key``, ``terms`` and ``weights``, without weights of 0."""
    pairs = F.arrays_zip(F.split("terms", " ").alias("term"), F.col("tfs").alias("times"))
    entries = items.where("n > 0").select(
        F.col("doc_id").alias("item_id"), F.col("key").alias("item_key"), F.inline(pairs).alias("term", "times")
    )
    # counted per term before the join, so no frequent term is shuffled by itself
    spoken = counted.where("n > 0").select(F.explode(F.split("terms", " ")).alias("term"))
    frequencies = spoken.groupBy("term").agg(F.count("*").alias("df"))
    rarity = F.floor(1000 * F.log(F.lit(2.0 * documents + 2) / (2 * F.col("df") + 1)))
    weights = (
        frequencies.join(entries.select("term").distinct(), "term")
        .select("term", rarity.alias("weight"))
        .where("weight > 0")
    )
    entry = F.struct("term", (F.col("times") * F.col("weight")).alias("weight"))
    vectors = entries.join(weights, "term").groupBy("item_id", "item_key").agg(F.collect_list(entry).alias("entries"))
    return vectors.select(
        "item_id", "item_key", F.col("entries.term").alias("terms"), F.col("entries.weight").alias("weights")
    )


def ranked_search(docs: DataFrame, queries: DataFrame, k: int = BEST) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score``: the best ``k`` documents of each query.

    ``docs`` has ``doc_id`` and ``text``, ``queries`` has ``item_id`` and ``text``. ``item_key`` and ``doc_key``
    tell apart rows that share an id.
    """
    counted = stored(term_counts(keyed(docs)))
    totals = counted.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
    documents, terms = totals["docs"], max(totals["terms"] or 0, 1)
    asked = keyed(queries.select(F.col("item_id").alias("doc_id"), "text")).dropDuplicates(KEY)
    vectors = stored(_weighted(term_counts(asked), counted, documents))
    entries = vectors.agg(F.sum(F.size("terms"))).first()[0] or 0

    m = F.expr(f"100 - 75 + (75L * n * {documents}L) div {terms}L")
    impacts = F.expr("transform(tfs, tf -> cast((1000000000L * tf) div (1000L * tf + 8L * m) as int))")
    squares = F.aggregate("impacts", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    rows = (
        counted.where("n > 0 and doc_id is not null")
        .withColumn("m", m)
        .withColumn("impacts", impacts)
        .select("doc_id", F.col("key").alias("doc_key"), "terms", "impacts", F.sqrt(squares).alias("norm"))
    )
    found = against_all(
        rows,
        row_key="doc_key",
        row_parts=parts_of_rows(rows, documents),
        queries=vectors,
        query_key="item_key",
        query_parts=max(-(-entries // CELL_TERMS), 1),
        order=[F.desc("row.norm"), F.col("row.doc_id")],
        make=lambda x: _Search(x, k),
        schema=_FOUND,
    )
    order = Window.partitionBy("item_id", "item_key").orderBy(F.desc("score"), "doc_id", "doc_key")
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score", "item_key", "doc_key")
