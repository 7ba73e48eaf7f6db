"""Quality rules: fixed counts and limits, and a trained verdict.

The verdict is a logistic regression on hashed word and character n-grams: single words, pairs
of consecutive words (a word twice in a row is one feature, whatever the word), and runs
of three characters. Features are shares of the text's n-grams, so a text's score is the mean weight of
its n-grams. The model is fitted to labelled rows and its scores are turned into probabilities by a
second regression (Platt scaling) on labelled rows that the fit has not seen. A text is kept
where the probability of quality 1 is at least 0.5 and no base rule rejects it.

The fit uses at most ``TRAINING_ROWS`` labelled rows, chosen by a hash of doc_id; with the others
everything is scored. Labels other than 0 and 1 are ignored. Without labels of both kinds every text
gets probability 1. Null and empty texts have no words; the base rules reject them. Repeated rows
are judged each on its own, as nothing depends on other rows. Other columns pass unchanged, except
those named like a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import packed, unpacked
from daybook.llm.text_arrays import RUN_BASES, RunHashes, Words, blocks, mixed, trimmed, utf8, window_starts

TRAINING_ROWS = 4000
BUCKET_BITS = 14
THRESHOLD = 0.5
#: Text whose features are built at once for the fit.
FIT_BLOCK_BYTES = 1 << 18
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"

BUCKETS = 1 << BUCKET_BITS
#: Words, then pairs of words, then runs of characters.
FEATURES = 3 * BUCKETS

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_MODEL = "weights array<double>, bias double, slope double, shift double"

_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True
_SPACES = " \t\n\x0b\x0c\r"


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _per_text(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[edges[1:]] - sums[edges[:-1]]


class Block:
    """The n-grams and counts of a block of texts."""

    def __init__(self, block: pa.RecordBatch):
        self.data, self.offsets = utf8(block.column("text"))
        self.texts = ["" if x is None else x for x in block.column("text").to_pylist()]
        self.words = Words(self.data, self.offsets)
        self.hashes = self.words.hashes()

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Feature numbers of each kind of n-gram, and where each text's begin."""
        first, hashes = self.words.first, self.hashes
        yield _bucket(mixed(hashes)), first
        at, counts = window_starts(first, 2)
        with np.errstate(over="ignore"):
            pairs = mixed(hashes[at] * np.uint64(3) + hashes[at + 1])
        pairs[hashes[at] == hashes[at + 1]] = 0
        yield BUCKETS + _bucket(pairs), np.concatenate([[0], np.cumsum(counts)])
        chars = np.frombuffer("".join(self.texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = np.concatenate([[0], np.cumsum([len(x) for x in self.texts])])
        at, counts = window_starts(starts, 3)
        with np.errstate(over="ignore"):
            wide = chars.astype(np.uint64)
            runs = (wide[at] * np.uint64(RUN_BASES[0]) + wide[at + 1]) * np.uint64(RUN_BASES[1])
            runs = mixed(runs + wide[at + 2])
        yield 2 * BUCKETS + _bucket(runs), np.concatenate([[0], np.cumsum(counts)])

    def scores(self, weights: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.texts))
        for numbers, edges in self.features():
            sums = np.concatenate([[0.0], np.cumsum(weights[numbers])])
            total += (sums[edges[1:]] - sums[edges[:-1]]) / np.maximum(np.diff(edges), 1)
        return total

    def counts(self) -> dict[str, np.ndarray]:
        words, data = self.words, self.data
        covers = np.zeros(len(data) + 1, np.int8)
        covers[words.starts] += 1
        covers[words.ends] -= 1
        inside = np.cumsum(covers[:-1], dtype=np.int8).astype(bool)
        lines = [
            [line for line in text.split("\n") if line.strip(_SPACES)] if "\n" in text else ()
            for text in self.texts
        ]
        return {
            "n_words": words.counts(),
            "word_chars": _per_text(inside & ((data & 0xC0) != 0x80), self.offsets),
            "n_symbols": _per_text(_IS_SYMBOL[data], self.offsets),
            "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
            "n_repeat_words": self._repeated(),
        }

    def _repeated(self) -> np.ndarray:
        """Words in three-word windows that their text holds twice or more."""
        first = self.words.first
        at, counts = window_starts(first, 3)
        text = np.repeat(np.arange(len(counts)), counts).astype(np.uint64)
        with np.errstate(over="ignore"):
            runs = RunHashes(self.hashes, RUN_BASES[0]).of(at, at + 3)
            runs = mixed(runs + text * np.uint64(RUN_BASES[1]))
        ordered = np.sort(runs)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        edge = np.zeros(len(self.hashes) + 1, np.int64)
        if len(twice):
            hit = at[np.isin(runs, twice)]
            np.add.at(edge, hit, 1)
            np.add.at(edge, hit + 3, -1)
        return _per_text(np.cumsum(edge[:-1]) > 0, first)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _adam(gradient, size: int, steps: int, rate: float) -> np.ndarray:
    """Minimises by steps scaled per coordinate, the rate falling to zero."""
    x, mean, square = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, steps + 1):
        g = gradient(x)
        mean += 0.1 * (g - mean)
        square += 0.01 * (g * g - square)
        ahead = (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        x -= rate * (1 - step / (steps + 1)) * ahead
    return x


def _balance(labels: np.ndarray) -> np.ndarray:
    share = np.clip(labels.mean(), 1e-6, 1 - 1e-6)
    return np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) / len(labels)


class _Table:
    """The features of many rows, kept as blocks of row, feature, and its share of the row's n-grams.

    Ten bytes an entry are held; what a step computes is as large as one block.
    """

    def __init__(self, texts: pa.RecordBatch):
        self.size = texts.num_rows
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        done = 0
        for rows in blocks(texts, "text", FIT_BLOCK_BYTES):
            for number, edges in Block(rows).features():
                n = np.diff(edges)
                row = np.repeat(np.arange(len(n)), n)
                pair, times = np.unique(row * FEATURES + number, return_counts=True)
                row = pair // FEATURES
                share = (times / n[row]).astype(np.float32)
                self.parts.append(((row + done).astype(np.int32), (pair % FEATURES).astype(np.uint16), share))
            done += rows.num_rows

    def scores(self, weights: np.ndarray) -> np.ndarray:
        total = np.zeros(self.size)
        for row, number, share in self.parts:
            total += np.bincount(row, weights[number] * share, self.size)
        return total

    def slopes(self, errors: np.ndarray) -> np.ndarray:
        """Each feature's sum of the rows' errors; rows without an error count nothing."""
        total = np.zeros(FEATURES)
        for row, number, share in self.parts:
            total += np.bincount(number, errors[row] * share, FEATURES)
        return total


def fitted(texts: pa.RecordBatch, labels: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, float, float, float]:
    """Weights and bias from the ``seen`` rows, slope and shift of the probability from the others."""
    table = _Table(texts)
    weight = np.zeros(len(labels))
    weight[seen] = _balance(labels[seen])

    def gradient(x):
        error = weight * (_logistic(table.scores(x[:-1]) + x[-1]) - labels)
        return np.append(table.slopes(error) + 1e-7 * x[:-1], error.sum())

    model = _adam(gradient, FEATURES + 1, 120, 1.0)
    score = table.scores(model[:-1]) + model[-1]
    other = ~seen if len(set(labels[~seen])) == 2 else np.ones(len(labels), bool)

    def platt(x):
        error = (_logistic(x[0] * score[other] + x[1]) - labels[other]) / other.sum()
        return np.array([(error * score[other]).sum(), error.sum()])

    slope, shift = _adam(platt, 2, 300, 0.2)
    return model[:-1], float(model[-1]), max(float(slope), 1e-3), float(shift)


def _fit(batches):
    # at most TRAINING_ROWS rows, in a task of its own
    rows = pa.Table.from_batches(list(batches))
    rows = rows.take(pa.compute.sort_indices(rows, [("doc_id", "ascending"), ("quality", "ascending")]))
    labels = rows.column("quality").to_numpy().astype(float)
    if len(set(labels)) == 2:
        texts = rows.select(["text"]).combine_chunks().to_batches()[0]
        seen = np.arange(len(labels)) % 4 != 3
        if len(set(labels[seen])) == 2:
            weights, bias, slope, shift = fitted(texts, labels, seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([weights.tolist()]), *(pa.array([x]) for x in (bias, slope, shift))],
                ["weights", "bias", "slope", "shift"],
            )


def trained(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS):
    """The model (weights, bias, slope, shift), or None without labels of both kinds."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where("doc_id is not null and quality in (0, 1)")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # at most ``rows`` rows of two numbers; of texts that share an id the least is taken
    known = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    model = known.repartition(1).mapInArrow(lambda b: trimmed(_fit(b)), _MODEL).first()
    return model and (np.array(model["weights"]), model["bias"], model["slope"], model["shift"])


_TYPES = {name: pa.int64() for name in COUNTS} | {
    "base_failed": pa.bool_(), "probability": pa.float64(), "kept": pa.bool_()
}
_RESULT = (
    "struct<" + ", ".join(f"{name}: long" for name in COUNTS)
    + ", base_failed: boolean, probability: double, kept: boolean>"
)


def judged(docs: DataFrame, model) -> DataFrame:
    """The documents with the counts, ``base_failed``, ``probability`` and ``kept``."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(_RESULT)
    def judge(texts: pa.Array) -> pa.Array:
        model = shared.value
        parts = []
        for rows in blocks(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
            block = Block(rows)
            out = block.counts()
            failed = (out["n_words"] < MIN_WORDS) | (
                100 * out["n_repeat_words"] > MAX_REPEATED_PERCENT * out["n_words"]
            )
            if model is None:
                chance = np.ones(len(failed))
            else:
                weights, bias, slope, shift = model
                chance = _logistic(slope * (block.scores(weights) + bias) + shift)
            out |= {"base_failed": failed, "probability": chance, "kept": ~failed & (chance >= THRESHOLD)}
            columns = [pa.array(out[name], kind) for name, kind in _TYPES.items()]
            parts.append(pa.StructArray.from_arrays(columns, names=list(_TYPES)))
        return pa.chunked_array(parts, pa.struct(_TYPES)).combine_chunks()

    out = packed(docs).withColumn("out", judge("text"))
    return unpacked(out, docs.columns, {name: F.col("out")[name] for name in _TYPES})


def quality_rules(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """Fits the verdict to the labelled rows among ``docs`` and judges all of them."""
    return judged(docs, trained(docs, labels, rows))
