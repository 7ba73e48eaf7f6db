"""Text columns as numpy arrays: bytes, words, and hashes of runs of symbols.

Arrow keeps a string column as one UTF-8 buffer with offsets, so a block of documents is
looked at as a whole. Space is ``\\x20`` and ``\\x09``-``\\x0D``; these bytes never occur inside
another UTF-8 character, so words found in bytes are the words of the text. A null text has
no bytes.

Words are hashed from their bytes and length, eight bytes at a time, and whole runs of symbols by
a 128-bit hash of their memory; equality of words, lines and windows rests on these. ``RunHashes`` is
for short runs only, and to choose anchors: it takes prefix sums of ``symbol * B**position`` modulo 2**64,
whose difference, divided by a power of ``B``, does not depend on where the run stands. Sequences
of a thousand symbols and more can be made to collide there under every base.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from xxhash import xxh3_64_intdigest, xxh3_128_digest

BLOCK_BYTES = 2 << 20

WORD_BASE = 0x9E3779B97F4A7C15
RUN_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: A random-looking 64-bit value for each byte.
BYTE_SYMBOLS = np.random.default_rng(20240229).integers(1, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)

_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def give_back() -> None:
    """Returns freed memory to the system, as a worker that waits for its next task keeps it else."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def trimmed(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches a task makes; at its end freed memory is given back."""
    yield from found
    give_back()


def blocks(batch: pa.RecordBatch, column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each, and one row at least."""
    if not batch.num_rows:
        return
    _, offsets = utf8(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets at which texts start and end."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z, all else unchanged."""
    return _LOWER[data]


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return values ^ (values >> np.uint64(31))


def _power_table(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    table = _powers.get(base)
    if table is None or len(table[0]) < size:
        length = max(size, 1 << 16)
        bases = (base, pow(base, -1, 1 << 64))
        steps = [np.full(length, x, np.uint64) for x in bases]
        for step in steps:
            step[0] = 1
        with np.errstate(over="ignore"):
            table = tuple(np.multiply.accumulate(step) for step in steps)
        if size <= BLOCK_BYTES + 1:  # the table of a longer text is not kept
            _powers[base] = table
    return table


def hash_runs(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each run of symbols, of whatever length."""
    size = symbols.itemsize
    memory = memoryview(np.ascontiguousarray(symbols)).cast("B") if len(symbols) else memoryview(b"")
    spans = zip((starts * size).tolist(), (ends * size).tolist())
    digests = b"".join([xxh3_128_digest(memory[start:end]) for start, end in spans])
    pairs = np.frombuffer(digests, np.int64).reshape(-1, 2)
    return pairs[:, 0].copy(), pairs[:, 1].copy()


class RunHashes:
    """Hashes of short runs of a sequence of symbols."""

    def __init__(self, symbols: np.ndarray, base: int):
        up, self.down = _power_table(base, len(symbols) + 1)
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(symbols) + 1, np.uint64)
            np.cumsum(symbols * up[: len(symbols)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            value = (self.sums[ends] - self.sums[starts]) * self.down[starts]
            return mixed(value + (ends - starts).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))


def _first_bytes(lengths: np.ndarray) -> np.ndarray:
    """Masks for the first 0 to 8 of eight bytes."""
    return _MASKS[np.clip(lengths, 0, 8)]


class Words:
    """The words of a block: byte starts and ends, and the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE):
        self.data, self.offsets = data, offsets
        inside = ~between[data]
        before = np.empty(len(data) + 1, bool)
        before[0] = False
        before[1:] = inside
        after = np.empty(len(data) + 1, bool)
        after[-1] = False
        after[:-1] = inside
        before[offsets] = False  # a text's end parts words, too
        after[offsets] = False
        self.starts = np.flatnonzero(inside & ~before[:-1])
        self.ends = np.flatnonzero(inside & ~after[1:]) + 1
        self.first = np.searchsorted(self.starts, offsets)  # len(texts) + 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, data: np.ndarray | None = None) -> np.ndarray:
        """From the first and second eight bytes and the length; longer words by a string hash."""
        data = self.data if data is None else data
        padded = np.concatenate([data, np.zeros(16, np.uint8)])
        eight = np.ndarray(len(data) + 9, "<u8", padded, strides=(1,))  # the eight bytes from each place on
        lengths = self.ends - self.starts
        with np.errstate(over="ignore"):
            value = mixed((eight[self.starts] & _first_bytes(lengths)) + lengths.astype(np.uint64) * np.uint64(WORD_BASE))
            second = eight[np.minimum(self.starts + 8, len(data))] & _first_bytes(lengths - 8)
            value = mixed(value + second * np.uint64(RUN_BASES[0]))
        for at in np.flatnonzero(lengths > 16).tolist():
            value[at] = xxh3_64_intdigest(data[self.starts[at] : self.ends[at]].tobytes())
        return value


def window_starts(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The starts of all windows of ``size`` symbols inside one text, and how many each text has."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    total = int(counts.sum())
    skipped = np.repeat(first[:-1] - (np.cumsum(counts) - counts), counts)
    return np.arange(total) + skipped, counts


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, from minima of blocks in both directions."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    tiles = padded.reshape(-1, width)
    left = np.minimum.accumulate(tiles, axis=1).ravel()
    right = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])
