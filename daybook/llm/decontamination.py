"""Documents that hold benchmark items, verbatim or paraphrased, by latent semantic retrieval.

Words are runs of ASCII letters and digits and of all non-ASCII characters, A-Z lower-cased.
Passages are ``PASSAGE`` consecutive words of a document, one every ``STRIDE`` words (the last one may
be shorter); benchmark items are the queries. Items of up to ``SHORT_WORDS`` words are too small a part
of a passage for its cosine to show them; they take no part in steps 2 and 3 and are searched exactly.

1. Document frequencies of hashed words are counted over the whole corpus and give each word's weight.
2. A randomised SVD gives the latent space. Every TF-IDF passage of the corpus is added, with a random sign,
   to one of ``SKETCH`` rows, ``GROUP`` consecutive ones to the same; tasks sketch their passages and the sums are added up. The space holds
   the items' own directions, so the items stay apart, and the ``EXTRA_RANK`` first right singular vectors of
   what the sketch has beside them.
3. Every passage of every document is searched. Its squared cosine with any item is at most
   the share of its squared weight that lies in words of items, so passages with less than
   ``LEAST_SHARE`` are passed over; the others are projected, and items whose latent cosine is at
   least ``COSINE`` are candidates.
4. A candidate is confirmed on the words around the passage: the longest common subsequence with
   the item, within a stretch of one and a half times the item's length, must have
   ``VERBATIM`` of the item's words, or ``PARAPHRASE`` of them if the answer, the item's last sentence
   (at most its last ``ANSWER_WORDS`` words), is there in order, too.
5. Short items are confirmed by the same rule in every stretch that can hold them: as few words may be
   missing, one of an item's few rarest words, or the rarest one of its answer, is in each such
   stretch. Stretches around these words are compared with the item.

The result has one row per document and item found: ``doc_id``, ``key``, ``item_id``, ``n_words`` of the
item and ``n_matched``. Null and empty texts and items without words match nothing. Repeated rows of
items count once, repeated documents are found each. Other columns are ignored. More than
``ITEMS`` items are searched block by block; a block's size is bounded, so it may be broadcast.
"""

from __future__ import annotations

import re
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import KEY, KEY_TYPE, keyed, packed, stored, unpacked, with_lists
from daybook.llm.text_arrays import Words, blocks, lowered, mixed, trimmed, utf8

PASSAGE = 32
SHORT_WORDS = PASSAGE // 2
STRIDE = 8
ITEMS = 256
EXTRA_RANK = 24
#: Rows of the sketch, consecutive passages that share one, and passages of a task on average.
SKETCH = 256
GROUP = 64
TASK_PASSAGES = 2_000_000
LEAST_SHARE = 0.15
COSINE = 0.6
VERBATIM = 0.8
PARAPHRASE = 0.6
ANSWER_WORDS = 8
#: Hashed words: for document frequencies, and for the latent space.
COUNT_BITS = 18
LATENT_BITS = 14

_PARTS_WORDS = np.ones(256, dtype=bool)
_PARTS_WORDS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


class Item(NamedTuple):
    item_id: int
    words: np.ndarray  # hashes
    answer: int  # words of the answer, at the end


class Index(NamedTuple):
    items: list[Item]  # long ones first, as in ``queries``
    weights: np.ndarray  # by hashed word
    basis: np.ndarray  # latent directions by hashed word
    queries: np.ndarray  # items in the latent space, of length 1


def _block_words(block: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = utf8(block.column("text"))
    data = lowered(data)
    words = Words(data, offsets, _PARTS_WORDS)
    return words.hashes(data), words.first


def _top(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _passages(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, start and end of all passages."""
    counts = np.diff(first)
    n = np.where(counts > 0, np.maximum(-(-(counts - PASSAGE) // STRIDE), 0) + 1, 0)
    text = np.repeat(np.arange(len(counts)), n)
    number = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    starts = first[text] + number * STRIDE
    return text, starts, np.minimum(starts + PASSAGE, first[text + 1])


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return total[ends] - total[starts]


# --- document frequencies -------------------------------------------------------------------


def _frequencies(batches):
    size = 1 << COUNT_BITS
    counts = np.zeros(size, np.int64)
    texts = passages = 0
    for batch in batches:
        for block in blocks(batch, "text"):
            hashes, first = _block_words(block)
            text = np.repeat(np.arange(block.num_rows), np.diff(first))
            held = np.sort(text * size + _top(hashes, COUNT_BITS))
            held = held[np.flatnonzero(np.diff(held, prepend=-1))]  # each word of a text once
            counts += np.bincount(held % size, minlength=size)
            texts += block.num_rows
            passages += len(_passages(first)[0])
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([[-2, -1], used])),
            pa.array(np.concatenate([[texts, passages], counts[used]])),
        ],
        ["word", "texts"],
    )


def word_weights(texts: DataFrame) -> tuple[np.ndarray, int]:
    """The weight of each hashed word (2**18 values) and the number of passages."""
    rows = texts.select("text").mapInArrow(lambda b: trimmed(_frequencies(b)), "word long, texts long")
    found = rows.groupBy("word").agg(F.sum("texts").alias("texts")).toArrow()
    word, counts = (found.column(k).to_numpy() for k in range(2))
    known = dict(zip(word[word < 0].tolist(), counts[word < 0].tolist()))
    frequency = np.zeros(1 << COUNT_BITS)
    frequency[word[word >= 0]] = counts[word >= 0]
    total = known.get(-2, 0)
    return np.log((total + 1) / (frequency + 1)).clip(0).astype(np.float32), known.get(-1, 0)


# --- latent space ---------------------------------------------------------------------------


def _chosen_passages(batches, share: float):
    """Words of the passages that a hash of document key and passage number draws.

    For looking at some passages of a large corpus; the fit takes all.
    """
    limit = np.uint64(min(int(share * 2**64), 2**64 - 1))
    for batch in batches:
        for block in blocks(batch, "text"):
            hashes, first = _block_words(block)
            text, starts, ends = _passages(first)
            keys = block.column("key").to_numpy().view(np.uint64)[text]
            number = ((starts - first[text]) // STRIDE).astype(np.uint64)
            with np.errstate(over="ignore"):
                drawn = mixed(mixed(keys) + number * np.uint64(0x9E3779B97F4A7C15))
            taken = np.flatnonzero(drawn < limit)
            for part in np.array_split(taken, len(taken) // 20000 + 1):
                if len(part):
                    lists = _word_lists(hashes, starts[part], ends[part])
                    yield lists.append_column("drawn", pa.array(drawn[part].view(np.int64)))


def _word_lists(hashes, starts, ends) -> pa.RecordBatch:
    lengths = ends - starts
    edges = np.concatenate([[0], np.cumsum(lengths)])
    words = hashes[np.arange(edges[-1]) + np.repeat(starts - edges[:-1], lengths)]
    lists = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(words.view(np.int64)))
    return pa.RecordBatch.from_arrays([lists], ["words"])


def _sketched(batches, weights):
    """Passages of length 1, each added with a random sign to a row of a matrix; columns are hashed words.

    ``GROUP`` consecutive passages share a row, so a word is added once for all of them that hold it. Signs
    and rows also depend on the place in the task, so repeated rows do not add up to a long one.
    """
    size = 1 << LATENT_BITS
    sketch = np.zeros(SKETCH * size, np.float32)
    seen = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
    for batch in batches:
        for block in blocks(batch, "text"):
            hashes, first = _block_words(block)
            text, starts, ends = _passages(first)
            if not len(text):
                continue
            value = weights.value[_top(hashes, COUNT_BITS)]
            norms = np.sqrt(np.maximum(_sums(value * value, starts, ends), 1e-12))
            drawn = mixed(mixed(block.column("key").to_numpy().view(np.uint64)[text]) ^ _places(seen, len(text)))
            seen += len(text)
            signed = np.where(drawn >> np.uint64(63), 1.0, -1.0) / norms
            until = np.concatenate([[0.0], np.cumsum(signed)])
            begin = np.searchsorted(text, np.arange(block.num_rows + 1))  # first passage of each text
            number = np.arange(len(text)) - begin[text]
            row = (drawn[begin[text] + number // GROUP * GROUP] % np.uint64(SKETCH)).astype(np.int64) * size
            # of each word the last passage that holds it, the first one, and where the last one's group begins
            counts = np.diff(first)
            stride = (np.arange(len(hashes)) - np.repeat(first[:-1], counts)) // STRIDE
            offset = np.repeat(begin[:-1], counts)
            last = np.minimum(stride, np.repeat(np.diff(begin) - 1, counts))
            least = np.maximum(stride - (PASSAGE // STRIDE - 1), 0)
            cut = last // GROUP * GROUP
            column = _top(hashes, LATENT_BITS)
            share = until[offset + last + 1] - until[offset + np.maximum(least, cut)]
            np.add.at(sketch, row[offset + last] + column, (value * share).astype(np.float32))
            two = np.flatnonzero(least < cut)  # words that passages of the group before hold, too
            offset, least, cut = offset[two], least[two], cut[two]
            share = until[offset + cut] - until[offset + least]
            np.add.at(sketch, row[offset + least] + column[two], (value[two] * share).astype(np.float32))
    for number, part in enumerate(np.split(sketch, 64)):
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([part.tobytes()])], ["part", "sums"])


def _places(start: int, n: int) -> np.ndarray:
    return mixed(np.arange(start, start + n).astype(np.uint64))


def _added(key, table):
    import pyarrow as pa

    sums = 0.0
    for chunk in table.column("sums").chunks:
        for part in chunk:
            sums = sums + np.frombuffer(part.as_buffer(), np.float32).astype(np.float64)
    return pa.table({"part": [key[0].as_py()], "sums": [sums.astype(np.float32).tobytes()]})


def corpus_sketch(texts: DataFrame, weights, passages: int) -> np.ndarray:
    """A random matrix times the weighted passages of all texts: ``SKETCH`` rows, a column per hashed word."""
    tasks = max(texts.sparkSession.sparkContext.defaultParallelism, passages // TASK_PASSAGES)
    # fewer tasks than splits where these are small, as each task hands on a whole sketch
    parts = texts.select("key", "text").coalesce(tasks).mapInArrow(
        lambda b: trimmed(_sketched(b, weights)), "part long, sums binary"
    )
    sketch = np.zeros((64, (SKETCH << LATENT_BITS) // 64), np.float32)
    for row in parts.groupBy("part").applyInArrow(_added, "part long, sums binary").collect():
        sketch[row["part"]] = np.frombuffer(row["sums"], np.float32)
    return sketch.reshape(SKETCH, -1)


def latent_basis(items: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """Directions of the items, then the first right singular vectors of what the sketch has beside them."""
    _, values, own = np.linalg.svd(items, full_matrices=False)
    own = own[values > 1e-6 * values[0]]
    rest = sketch - (sketch @ own.T) @ own
    _, values, others = np.linalg.svd(rest, full_matrices=False)
    others = others[values > 1e-6 * max(values[0], 1e-12)]
    return np.concatenate([own, others[:EXTRA_RANK]]).T.astype(np.float32)


# --- search ---------------------------------------------------------------------------------


def common_subsequence(item: np.ndarray, words: list[int]) -> int:
    """Length of the longest common subsequence; one bit per word of the item."""
    places: dict[int, int] = {}
    for place, word in enumerate(item.tolist()):
        places[word] = places.get(word, 0) | 1 << place
    full = (1 << len(item)) - 1
    state = full
    for word in words:
        match = state & places.get(word, 0)
        state = ((state + match) | (state - match)) & full
    return len(item) - state.bit_count()


def matched(item: Item, words: list[int]) -> int:
    """Words of the item found in order in one stretch, 0 if that is not enough."""
    n = len(item.words)
    if common_subsequence(item.words, words) < PARAPHRASE * n:
        return 0
    stretch = n + -(-n // 2)
    step = n // 4 if n > SHORT_WORDS else 1
    best = 0
    for start in range(0, max(len(words) - stretch, 0) + step, step):
        part = words[start : start + stretch]
        found = common_subsequence(item.words, part)
        if found >= VERBATIM * n or (
            found >= PARAPHRASE * n
            and common_subsequence(item.words[n - item.answer :], part) == item.answer
        ):
            best = max(best, found)
    return best


class Sought:
    """Places of some words in a block."""

    def __init__(self, words: np.ndarray):
        self.words = np.unique(words)
        self.flags = np.zeros(1 << 22, bool)
        self.flags[_top(self.words, 22)] = True

    def places(self, hashes: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.flags[_top(hashes, 22)])
        return at[np.isin(hashes[at], self.words)]


class Short:
    """A short item's words and the words of which each of its matches holds one."""

    def __init__(self, number: int, item: Item, weights: np.ndarray):
        self.number, self.n = number, len(item.words)
        self.stretch = self.n + -(-self.n // 2)
        rarity = weights[_top(item.words, COUNT_BITS)]
        may_lack = self.n - int(np.ceil(VERBATIM * self.n))
        rarest = np.argsort(-rarity, kind="stable")[: may_lack + 1]
        answer = self.n - item.answer + int(np.argmax(rarity[self.n - item.answer :]))
        self.anchors = np.unique(item.words[[*rarest, answer]])
        self.words, place = np.unique(item.words, return_inverse=True)
        bits = np.uint64(1) << np.arange(self.n, dtype=np.uint64)
        self.bits = np.zeros(len(self.words), np.uint64)
        np.bitwise_or.at(self.bits, place, bits)
        self.answer = np.bitwise_or.reduce(bits[self.n - item.answer :])

    def near(self, at: np.ndarray, hashes: np.ndarray, first: np.ndarray):
        """Text, start and end of the surroundings of places that hold enough words of the item."""
        reach = np.arange(1 - self.stretch, self.stretch)
        for part in np.array_split(at, len(at) // 20000 + 1):
            text = np.searchsorted(first, part, "right") - 1
            begin = np.maximum(part - self.stretch + 1, first[text])
            end = np.minimum(part + self.stretch, first[text + 1])
            window = part[:, None] + reach
            inside = (window >= begin[:, None]) & (window < end[:, None])
            words = hashes[np.where(inside, window, 0)]
            place = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
            inside &= self.words[place] == words
            held = np.bitwise_or.reduce(np.where(inside, self.bits[place], np.uint64(0)), axis=1)
            count = np.bitwise_count(held)
            answered = (count >= PARAPHRASE * self.n) & (held & self.answer == self.answer)
            for i in np.flatnonzero((count >= VERBATIM * self.n) | answered).tolist():
                yield int(text[i]), int(begin[i]), int(end[i])


def _short_candidates(shorts: list[Short], sought: Sought, hashes, first):
    """Text, item, start and end of word ranges that may hold a short item."""
    at = sought.places(hashes)
    at = at[np.argsort(hashes[at], kind="stable")]
    anchors = hashes[at]
    for short in shorts:
        starts = np.searchsorted(anchors, short.anchors)
        ends = np.searchsorted(anchors, short.anchors, "right")
        places = np.concatenate([at[a:b] for a, b in zip(starts, ends)])
        for text, begin, end in short.near(places, hashes, first):
            yield text, short.number, begin, end


def _long_candidates(index: Index, sought: Sought, hashes, first):
    """Text, item, start and end of the words around passages that may hold a long item."""
    text, starts, ends = _passages(first)
    square = index.weights[_top(hashes, COUNT_BITS)].astype(np.float64) ** 2
    asked = sought.places(hashes)
    inside = np.zeros(len(hashes))
    inside[asked] = square[asked]
    share = _sums(inside, starts, ends) / np.maximum(_sums(square, starts, ends), 1e-12)
    near = np.flatnonzero(share >= LEAST_SHARE)
    for part in np.array_split(near, len(near) // 1000 + 1):
        for passage, number in _candidates(index, hashes, starts[part], ends[part]):
            reach, row = len(index.items[number].words), int(text[part[passage]])
            begin = max(int(starts[part[passage]]) - reach, int(first[row]))
            yield row, number, begin, min(int(ends[part[passage]]) + reach, int(first[row + 1]))


def _search(batches, shared):
    items, *arrays = shared.value
    index = Index([Item(*each) for each in items], *arrays)
    n_long = len(index.queries)
    shorts = [Short(n, item, index.weights) for n, item in enumerate(index.items) if n >= n_long]
    long_words = Sought(np.concatenate([x.words for x in index.items[:n_long]])) if n_long else None
    anchors = Sought(np.concatenate([short.anchors for short in shorts])) if shorts else None
    for batch in batches:
        for block in blocks(batch, "text"):
            hashes, first = _block_words(block)
            if not len(hashes):
                continue
            found: dict[tuple[int, int], int] = {}
            candidates = chain(
                _long_candidates(index, long_words, hashes, first) if n_long else (),
                _short_candidates(shorts, anchors, hashes, first) if shorts else (),
            )
            for row, number, begin, end in candidates:
                item = index.items[number]
                if found.get((row, number), 0) >= len(item.words):
                    continue
                n = matched(item, hashes[begin:end].tolist())
                if n:
                    found[row, number] = max(n, found.get((row, number), 0))
            rows = pa.array([row for row, _ in found], pa.int64())
            items = [index.items[number] for _, number in found]
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id").take(rows),
                    block.column("key").take(rows),
                    pa.array([item.item_id for item in items], pa.int64()),
                    pa.array([len(item.words) for item in items], pa.int64()),
                    pa.array(list(found.values()), pa.int64()),
                ],
                [*KEY, "item_id", "n_words", "n_matched"],
            )


def _candidates(index: Index, hashes, starts, ends):
    """Passages and items whose latent cosine is large enough.

    Passages overlap: each stride of words is projected once and added to all passages that hold it.
    """
    if not len(starts):
        return []
    begins = starts[:, None] + np.arange(PASSAGE // STRIDE) * STRIDE
    held = begins < ends[:, None]
    strides, place = np.unique(begins[held], return_inverse=True)
    last = np.zeros(len(strides), ends.dtype)
    np.maximum.at(last, place, np.minimum(begins + STRIDE, ends[:, None])[held])
    words = strides[:, None] + np.arange(STRIDE)
    there = words < last[:, None]
    different, number = np.unique(hashes[words[there]], return_inverse=True)
    table = index.basis[_top(different, LATENT_BITS)] * index.weights[_top(different, COUNT_BITS)][:, None]
    latent = _row_sums(_row_sums(table, there, number), held, place)
    latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
    return np.argwhere(latent @ index.queries.T >= COSINE).tolist()


def _row_sums(rows: np.ndarray, there: np.ndarray, number: np.ndarray) -> np.ndarray:
    """For each row of ``there`` the sum of some ``rows``: ``number`` has those of its true cells in turn."""
    with_zeros = np.concatenate([rows, np.zeros((1, rows.shape[1]), rows.dtype)])
    numbers = np.full(there.shape, len(rows))
    numbers[there] = number
    total = with_zeros[numbers[:, 0]]
    for column in numbers.T[1:]:
        total += with_zeros[column]
    return total


def _items(rows: list) -> list[Item]:
    items = []
    for item_id, text in rows:
        block = pa.RecordBatch.from_arrays([pa.array([text], pa.string())], ["text"])
        words, _ = _block_words(block)
        if len(words):
            sentence = re.split(r"[.!?\n]+\s*", text.strip(" .!?\n\t\r"))[-1]
            last = pa.RecordBatch.from_arrays([pa.array([sentence])], ["text"])
            answer = len(_block_words(last)[0])
            items.append(Item(item_id, words, min(max(answer, 1), ANSWER_WORDS)))
    return items


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id``, ``key``, ``item_id``, ``n_words``, ``n_matched`` for each document and item found."""
    spark = docs.sparkSession
    texts = keyed(docs)
    asked = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).where("text is not null").distinct()
    total = asked.count()
    parts = -(-total // ITEMS)
    outcome = None
    if total:
        weights, passages = word_weights(texts)
        shared_weights = spark.sparkContext.broadcast(weights)
        sketch = None
        # a rank by hash deals the items to blocks of at most ITEMS
        ordered = asked.select("*", F.xxhash64("item_id", "text").alias("h")).orderBy("h", "item_id", "text")
        for part in range(parts):
            block = stored(ordered.offset(part * ITEMS).limit(ITEMS).select("item_id", "text"))
            items = _items([(row["item_id"], row["text"]) for row in block.collect()])  # at most ITEMS rows
            if not items:
                continue
            if sketch is None and any(len(x.words) > SHORT_WORDS for x in items):
                sketch = corpus_sketch(texts, shared_weights, passages)
            index = _index(items, weights, sketch)
            plain = [tuple(item) for item in index.items]  # the workers need not know this package
            shared = spark.sparkContext.broadcast((plain, index.weights, index.basis, index.queries))
            found = texts.mapInArrow(
                lambda b, shared=shared: trimmed(_search(b, shared)),
                f"{KEY_TYPE}, item_id long, n_words long, n_matched long",
            )
            outcome = found if outcome is None else outcome.unionByName(found)
    if outcome is None:
        return spark.createDataFrame([], f"{KEY_TYPE}, item_id long, n_words long, n_matched long")
    return outcome


def _index(items: list[Item], weights: np.ndarray, sketch: np.ndarray | None) -> Index:
    items = sorted(items, key=lambda x: len(x.words) <= SHORT_WORDS)
    long = [x for x in items if len(x.words) > SHORT_WORDS]
    if not long:
        none = np.zeros((0, 0), np.float32)
        return Index(items, weights, none, none)
    rows = np.zeros((len(long), 1 << LATENT_BITS))
    for row, item in zip(rows, long):
        np.add.at(row, _top(item.words, LATENT_BITS), weights[_top(item.words, COUNT_BITS)])
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    basis = latent_basis(rows, sketch)
    queries = np.array(
        [
            (basis[_top(x.words, LATENT_BITS)] * weights[_top(x.words, COUNT_BITS)][:, None]).sum(axis=0)
            for x in long
        ]
    )
    queries /= np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-9)
    return Index(items, weights, basis, queries.astype(np.float32))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item is found."""
    gone = leaks(docs, benchmark).select(*KEY, F.lit(True).alias("gone")).distinct()
    left = with_lists(packed(docs), gone).where("gone is null")
    return unpacked(left, docs.columns, {})
