"""Near-duplicate documents by MinHash bands and odd sketches, confirmed on full shingle sets.

A document's set: distinct runs of five words (A-Z lower-cased); with fewer words all of them as
one; without words empty. Documents link where the sets' similarity is 75 % or more.

1. Documents with the same set form one class, known by its least doc_id.
2. 128 MinHash samples per class make 32 bands of four. Classes that share a band are
   candidates; a pair at the threshold shares none with a probability of 5e-6.
3. For classes that share a band, 1024 samples are folded into 4096 parity bits (an odd sketch). The
   bits in which two sketches differ tell the similarity with a deviation of 0.018; pairs
   estimated below ``LEAST_ESTIMATE`` (4.5 deviations under the threshold) are left out.
4. Each class is compared with the least class of each of its bands: first the one with which it shares
   most bands, then those of other components.
5. Bands of three or more classes that still lie in different components are gone through
   in blocks, and all pairs from different components whose sketches admit a link are compared. So
   a group of near copies never yields all its pairs, and no pair that could join two
   components is left out.

Every link is confirmed on the full sets. Rows without words or with a null doc_id link with nothing.
Rows that share a doc_id are one document that has all their links. Rows equal in id and text
get the same result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.components import components
from daybook.llm.rows import KEY, KEY_TYPE, keyed, packed, stored, unpacked, with_lists
from daybook.llm.text_arrays import (
    RUN_BASES,
    RunHashes,
    Words,
    blocks,
    lowered,
    mixed,
    trimmed,
    utf8,
    window_starts,
)

SHINGLE = 5
PERCENT = 75
BANDS = 32
ROWS = 4
SAMPLES = 1024
SKETCH_BITS = 4096
LEAST_ESTIMATE = 0.667
BLOCK_CLASSES = 256

_FACTORS = np.random.default_rng(7).integers(1, 2**63, SAMPLES).astype(np.uint64) * np.uint64(2)
_FACTORS += np.uint64(1)
_PROFILE = f"{KEY_TYPE}, n_shingles long, left long, right long, bands array<long>"
_SET = "id long, shingles array<long>, bands array<int>, sketch array<long>"


def shingle_sets(block: pa.RecordBatch) -> list[np.ndarray]:
    """The sorted hashed shingles of each text."""
    data, offsets = utf8(block.column("text"))
    words = Words(data, offsets)
    counts = words.counts()
    hashes = RunHashes(words.hashes(lowered(data)), RUN_BASES[0])
    starts, windows = window_starts(words.first, SHINGLE)
    values = hashes.of(starts, starts + SHINGLE)
    ends = np.cumsum(windows)
    short = hashes.of(words.first[:-1], words.first[1:])
    return [
        np.unique(values[end - n : end]) if n else short[i : i + 1] if counts[i] else values[:0]
        for i, (n, end) in enumerate(zip(windows.tolist(), ends.tolist()))
    ]


def _samples(shingles: np.ndarray, count: int) -> np.ndarray:
    least = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for start in range(0, len(shingles), 512):
            part = shingles[start : start + 512, None] * _FACTORS[:count]
            np.minimum(least, part.min(axis=0), out=least)
    return least


def sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bits of the sets {(i, sample i)}, one row of 64-bit words per row of samples."""
    n, k = samples.shape
    with np.errstate(over="ignore"):
        places = mixed(samples + np.arange(1, k + 1, dtype=np.uint64) * np.uint64(RUN_BASES[1]))
    bits = (places & np.uint64(SKETCH_BITS - 1)).astype(np.int64) + np.arange(n)[:, None] * SKETCH_BITS
    parity = (np.bincount(bits.ravel(), minlength=n * SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(parity.reshape(n, SKETCH_BITS), axis=1).view(np.int64)


def _bands(sets: list[np.ndarray]) -> np.ndarray:
    n = len(sets)
    samples = np.array([_samples(x, BANDS * ROWS) for x in sets]).reshape(n, BANDS, ROWS)
    band = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :].repeat(n, 0)
    with np.errstate(over="ignore"):
        for row in range(ROWS):
            band = mixed(band * np.uint64(RUN_BASES[0]) + samples[:, :, row])
    return band.view(np.int64)


def _rows_of(matrix: np.ndarray) -> pa.Array:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel()))


def _profiles(batches):
    for batch in batches:
        for block in blocks(batch, "text"):
            sets = shingle_sets(block)
            with np.errstate(over="ignore"):
                left = [int(mixed(x).sum().view(np.int64)) for x in sets]
                right = [int(mixed(x ^ np.uint64(RUN_BASES[1])).sum().view(np.int64)) for x in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    block.column("key"),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array(left, pa.int64()),
                    pa.array(right, pa.int64()),
                    _rows_of(_bands(sets)),
                ],
                [*KEY, "n_shingles", "left", "right", "bands"],
            )


def _sets(batches):
    """Shingles, shortened bands and the sketch of each text."""
    for batch in batches:
        for block in blocks(batch, "text"):
            sets = shingle_sets(block)
            ends = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
            values = np.concatenate([*sets, np.zeros(0, np.uint64)]).view(np.int64)
            samples = np.array([_samples(x, SAMPLES) for x in sets]).reshape(len(sets), SAMPLES)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
                    _rows_of(_bands(sets).astype(np.int32)),
                    _rows_of(sketches(samples)),
                ],
                ["id", "shingles", "bands", "sketch"],
            )


#: Sketches that differ in more bits are estimated below ``LEAST_ESTIMATE``.
SKETCH_LIMIT = int(SKETCH_BITS / 2 * (1 - np.exp(-4 * SAMPLES * (1 - LEAST_ESTIMATE) / SKETCH_BITS)))


def _different_bits(a: Column, b: Column) -> Column:
    each = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(each, F.lit(0), lambda total, x: total + x)


def _estimated(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that the sketches admit, with ``bits``."""
    one = sets.select(F.col("id").alias("a"), F.col("sketch").alias("x"))
    two = sets.select(F.col("id").alias("b"), F.col("sketch").alias("y"))
    bits = _different_bits(F.col("x"), F.col("y"))
    found = pairs.join(one, "a").join(two, "b").select("a", "b", bits.alias("bits"))
    return found.where(F.col("bits") <= SKETCH_LIMIT).groupBy("a", "b").agg(F.min("bits").alias("bits"))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    either = F.size("x") + F.size("y") - both
    near = pairs.select("a", "b").join(one, "a").join(two, "b")
    return near.where(both * 100 >= either * PERCENT).select("a", "b").distinct()


def _block_pairs(batches):
    """Pairs from two blocks of a band that differ in component and whose sketches admit a link.

    A pair is given in the first band that it shares.
    """
    for batch in batches:
        for row in batch.to_pylist():
            one, two = (_block(row[side]) for side in ("one", "two"))
            found = []
            for i in range(len(one["id"])):
                other = np.flatnonzero(two["component"] > one["component"][i])
                shared = one["bands"][i] == two["bands"][other]
                other = other[shared.argmax(axis=1) == row["place"]]
                differing = (one["sketch"][i] ^ two["sketch"][other]).view(np.uint64)
                bits = np.bitwise_count(differing).sum(axis=1)
                found += [(one["id"][i], x) for x in two["id"][other[bits <= SKETCH_LIMIT]]]
            if found:
                pairs = np.sort(np.array(found, np.int64), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _block(rows: list[dict]) -> dict[str, np.ndarray]:
    return {name: np.array([row[name] for row in rows]) for name in rows[0]}


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``key``, ``n_shingles``, ``component_id``, ``kept`` for each row."""
    texts = keyed(docs)
    profiles = stored(texts.mapInArrow(lambda b: trimmed(_profiles(b)), _PROFILE))
    kind = ["left", "right", "n_shingles"]
    able = profiles.where("n_shingles > 0 and doc_id is not null")
    classes = stored(
        able.groupBy(*kind).agg(F.min("doc_id").alias("id"), F.first("bands").alias("bands"))
    )
    every = classes.select("id", F.posexplode("bands").alias("place", "band"))
    sizes = every.groupBy("band").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("size"))
    buckets = stored(every.join(stored(sizes.where("size > 1")), "band"))

    involved = buckets.select(F.col("id").alias("doc_id")).distinct()
    asked = texts.join(involved, "doc_id", "left_semi").select("doc_id", "text")
    sets = stored(asked.mapInArrow(lambda b: trimmed(_sets(b)), _SET))

    stars = stored(
        buckets.where("id <> a").groupBy("a", F.col("id").alias("b")).agg(F.count("*").alias("shared"))
    )
    most = F.max_by("a", F.struct("shared", F.negative("a"))).alias("a")
    best = stars.groupBy("b").agg(most).select("a", "b")
    links = stored(_confirmed(_estimated(best, sets), sets))
    labels = components(links)
    apart = _labelled(stars.withColumnRenamed("a", "id"), labels).withColumnsRenamed(
        {"id": "a", "component": "other", "b": "id"}
    )
    apart = _labelled(apart, labels).where("component <> other").select("a", F.col("id").alias("b"))
    links = stored(links.unionByName(_confirmed(_estimated(apart, sets), sets)))
    labels = components(links)

    placed = _labelled(buckets.where("size > 2"), labels)
    mixed_bands = (
        placed.groupBy("band")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("band")
    )
    member = F.struct("id", "component", "bands", "sketch")
    block = F.pmod(F.xxhash64("id"), F.ceil(F.col("size") / BLOCK_CLASSES))
    grouped = stored(
        placed.join(stored(mixed_bands), "band")
        .join(sets.select("id", "bands", "sketch"), "id")
        .withColumn("block", block)
        .groupBy("band", "place", "block")
        .agg(F.collect_list(member).alias("one"))
    )
    other = grouped.select("band", F.col("one").alias("two"))
    rest = grouped.join(other, "band").select("place", "one", "two")
    rest = stored(rest.mapInArrow(lambda b: trimmed(_block_pairs(b)), "a long, b long").distinct())
    if not rest.isEmpty():
        labels = components(links.unionByName(_confirmed(rest, sets)))

    placed = _labelled(profiles.join(classes.select(*kind, "id"), kind, "left"), labels)
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component"))
    return placed.select(
        *KEY,
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _labelled(frame: DataFrame, labels: DataFrame) -> DataFrame:
    found = frame.join(labels.withColumnRenamed("component", "root"), "id", "left")
    return found.withColumn("component", F.coalesce("root", "id")).drop("root")


def near_dedup(docs: DataFrame) -> DataFrame:
    """The documents that stay: one of each group, by least doc_id."""
    gone = near_duplicates(docs).where(~F.col("kept")).select(*KEY, F.lit(True).alias("gone")).distinct()
    left = with_lists(packed(docs), gone).where("gone is null")
    return unpacked(left, docs.columns, {})
