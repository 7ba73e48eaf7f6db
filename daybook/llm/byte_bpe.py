"""Byte-level BPE by recursive DuckDB queries inside each task.

A text is cut by the tokenizer's pattern; each piece is encoded on its own, without special
tokens. A piece that is a token as a whole is that token. The others become rows of (piece,
position, token), at first one per byte. A recursive query joins neighbouring tokens with the table
of merges, contracts the leftmost pair of least rank of every piece, and goes on with the
pieces that changed until none does. In pieces of more than ``LONG`` bytes all pairs of the least
rank are contracted in one round, of overlapping ones every second from the left; the tokens
are the same. Decoding takes the bytes of all ids of a block from the vocabulary, in order, as one Arrow array.

A Python worker remembers the pieces it encoded for all its tasks of one call: the last ``REMEMBERED`` ones
that were used, twice as many at most. Ids are
little-endian unsigned 32-bit integers in a binary column. Null and empty texts have no tokens.
Nothing depends on other rows, so repeated rows give equal results. Other columns pass unchanged,
except those named like a result.

The vocabulary (lines of base64 token and rank) and the pattern are parameters; the driver reads
the file and broadcasts its content, whose size does not depend on the data.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.llm.rows import quoted
from daybook.llm.text_arrays import blocks, trimmed

REMEMBERED = 150_000
BLOCK_BYTES = 1 << 19
LONG = 64
#: Bytes of pieces encoded by one query.
QUERY_BYTES = 1 << 17
DECODED_ROWS = 500
RESULTS = ["ids", "n_tokens", "decoded"]

# ``best`` holds, from high to low bits: rank, and 7 bits each for where the left token of the pair
# starts, where the right one starts and where it stops.
_SHORT_ROUND = """
SELECT word, pos, CASE WHEN pos = (best >> 14) & 127 THEN (best & 127)::INT ELSE stop END,
       CASE WHEN pos = (best >> 14) & 127 THEN (best >> 21)::INT ELSE tok END, round + 1
FROM state JOIN (
  SELECT a.word, min((m << 21) | (a.pos << 14) | (b.pos << 7) | b.stop) AS best
  FROM state a JOIN state b ON b.word = a.word AND b.pos = a.stop
  JOIN merges ON pair = (a.tok::BIGINT << 20) | b.tok
  GROUP BY a.word
) USING (word)
WHERE pos <> (best >> 7) & 127
"""

_LONG_ROUND = """
SELECT word, pos, CASE WHEN taken THEN next_stop ELSE stop END,
       CASE WHEN taken THEN best::INT ELSE tok END, round + 1
FROM (
  SELECT *, lag(taken) OVER (PARTITION BY word ORDER BY pos) AS absorbed
  FROM (
    SELECT *, hit AND row_number() OVER (PARTITION BY word, run, hit ORDER BY pos) % 2 = 1 AS taken
    FROM (
      SELECT *, sum((NOT hit)::INT) OVER (PARTITION BY word ORDER BY pos) AS run
      FROM (
        SELECT *, min(m) OVER (PARTITION BY word) AS best,
               coalesce(m = min(m) OVER (PARTITION BY word), false) AS hit
        FROM (
          SELECT *, lead(tok) OVER near AS next_tok, lead(stop) OVER near AS next_stop
          FROM state WINDOW near AS (PARTITION BY word ORDER BY pos)
        ) LEFT JOIN merges ON pair = (tok::BIGINT << 20) | next_tok
      )
      WHERE best IS NOT NULL
    )
  )
)
WHERE absorbed IS NOT TRUE
"""

_ENCODE = """
WITH RECURSIVE state(word, pos, stop, tok, round) AS (
  SELECT word, pos, stop, tok, 0 FROM start UNION ALL {round}
),
final AS (SELECT word, max(round) AS round FROM state GROUP BY word)
SELECT word, tok FROM state JOIN final USING (word, round) ORDER BY word, pos
"""


def vocabulary(content: bytes) -> dict[bytes, int]:
    rows = (line.split() for line in content.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in rows}


def merges(ranks: dict[bytes, int]) -> pa.Table:
    """Every two tokens that together are a token, and its rank."""
    found = array("q")  # no objects, whose memory a worker would keep
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                found.extend((left, right, rank))
    left, right, rank = np.array(found, np.int64).reshape(-1, 3).T
    return pa.table({"pair": (left << 20) | right, "m": rank})


def _database() -> duckdb.DuckDBPyConnection:
    # what does not fit fails instead of going to a folder of the machine
    return duckdb.connect(
        config={"threads": 1, "memory_limit": "300MB", "temp_directory": "", "max_temp_directory_size": "0MB"}
    )


class Encoder:
    def __init__(self, content: bytes, pattern: str):
        self.ranks = vocabulary(content)
        self.pattern = regex.compile(pattern)
        self.single = np.array([self.ranks[bytes([byte])] for byte in range(256)], np.int32)
        # pieces used since the younger memory was begun, and those used before
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.database = _database()
        table = merges(self.ranks)
        self.database.register("given", table)
        self.database.execute("CREATE TABLE merges AS FROM given")
        self.database.unregister("given")

    def encoded(self, texts: list[str]) -> list[bytes]:
        pieces = [self.pattern.findall(text) for text in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        fresh = set(chain.from_iterable(pieces)).difference(known)
        again = [piece for piece in fresh if piece in older]
        known.update((piece, older[piece]) for piece in again)
        fresh.difference_update(again)
        parted: dict[str, bytes] = {}
        for piece in fresh:
            raw = piece.encode()
            rank = self.ranks.get(raw)
            if rank is None:
                parted[piece] = raw
            else:
                known[piece] = rank.to_bytes(4, "little")
        for rule, chosen in (
            (_SHORT_ROUND, [x for x, raw in parted.items() if len(raw) <= LONG]),
            (_LONG_ROUND, [x for x, raw in parted.items() if len(raw) > LONG]),
        ):
            for group in _grouped(chosen, parted):
                known.update(zip(group, self._contracted([parted[x] for x in group], rule)))
        return [b"".join(map(known.__getitem__, each)) for each in pieces]

    def _contracted(self, words: list[bytes], rule: str) -> list[bytes]:
        lengths = np.array([len(x) for x in words])
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        begins = np.repeat(np.cumsum(lengths) - lengths, lengths)
        pos = (np.arange(len(word)) - begins).astype(np.int32)
        self.database.register(
            "start",
            pa.table(
                {
                    "word": word,
                    "pos": pos,
                    "stop": pos + 1,
                    "tok": self.single[np.frombuffer(b"".join(words), np.uint8)],
                }
            ),
        )
        found = self.database.execute(_ENCODE.format(round=rule)).fetchnumpy()
        ids = found["tok"].astype("<u4").tobytes()
        cuts = 4 * np.searchsorted(found["word"], np.arange(len(words) + 1))
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def _grouped(pieces: list[str], raw: dict[str, bytes]) -> Iterator[list[str]]:
    group, size = [], 0
    for piece in pieces:
        if group and size + len(raw[piece]) > QUERY_BYTES:
            yield group
            group, size = [], 0
        group.append(piece)
        size += len(raw[piece])
    if group:
        yield group


class Decoder:
    def __init__(self, content: bytes, encoder: Encoder | None = None):
        ranks = encoder.ranks if encoder else vocabulary(content)
        # where the bytes of each id are, -1 for an id between that no token has
        self.place = np.full(max(ranks.values(), default=-1) + 1, -1, np.int32)
        self.place[list(ranks.values())] = np.arange(len(ranks))
        self.tokens = pa.array(list(ranks), pa.large_binary())

    def decoded(self, encoded: list[bytes]) -> list[bytes]:
        counts = np.array([len(x) // 4 for x in encoded], np.int64)
        ids = np.frombuffer(b"".join(encoded), "<u4")
        if not len(ids):
            return [b""] * len(encoded)
        if ids.max() >= len(self.place) or (places := self.place[ids]).min() < 0:
            raise ValueError("an id is not in the vocabulary")
        found = self.tokens.take(pa.array(places))
        edges = np.frombuffer(found.buffers()[1], np.int64, len(found) + 1)
        ends = np.cumsum(counts)
        data = memoryview(found.buffers()[2])
        return [bytes(data[a:b]) for a, b in zip(edges[ends - counts].tolist(), edges[ends].tolist())]


def _kept(content, name: str, make):
    """What a task made of the broadcast vocabulary, kept beside it for the worker's next tasks.

    It goes when the broadcast does, which is at the latest when the driver no longer uses it.
    """
    if not hasattr(content, name):
        setattr(content, name, make())
    return getattr(content, name)


def _coded(batches, column: str, content, pattern: str, decoded: bool):
    encoder = _kept(content, "encoder", lambda: Encoder(content.value, pattern))
    decoder = _kept(content, "both", lambda: Decoder(content.value, encoder)) if decoded else None
    for batch in batches:
        for block in blocks(batch, column, BLOCK_BYTES):
            ids = encoder.encoded(["" if x is None else x for x in block.column(column).to_pylist()])
            columns = [pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]
            if decoder:
                columns.append(pa.array(decoder.decoded(ids), pa.binary()))
            names = [*block.schema.names, *RESULTS[: len(columns)]]
            yield pa.RecordBatch.from_arrays([*block.columns, *columns], names)


def _decoded(batches, column: str, content):
    decoder = _kept(content, "decoder", lambda: Decoder(content.value))
    for batch in batches:
        for at in range(0, batch.num_rows, DECODED_ROWS):
            rows = batch.slice(at, DECODED_ROWS)
            texts = decoder.decoded([x or b"" for x in rows.column(column).to_pylist()])
            names = [*rows.schema.names, "decoded"]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.binary())], names)


def _content(frame: DataFrame, path: str):
    with open(path, "rb") as file:
        return frame.sparkSession.sparkContext.broadcast(file.read())


def _without(frame: DataFrame, names: list[str]) -> DataFrame:
    return frame.select(*[F.col(quoted(name)) for name in frame.columns if name not in names])


def _mapped(frame: DataFrame, column: str, function, results: dict[str, T.DataType]) -> DataFrame:
    """Applies a function of batches and a column's name; columns of any name pass through it."""
    names = frame.columns
    plain = frame.toDF(*[f"c{i}" for i in range(len(names))])
    asked = f"c{names.index(column)}"
    fields = [*plain.schema.fields, *[T.StructField(name, kind) for name, kind in results.items()]]
    return plain.mapInArrow(lambda b: function(b, asked), T.StructType(fields)).toDF(*names, *results)


def encode(docs: DataFrame, path: str, pattern: str, decoded: bool = False) -> DataFrame:
    """The documents with ``ids`` and ``n_tokens``, and ``decoded``, the ids' bytes, if asked for."""
    content = _content(docs, path)
    results = dict(zip(RESULTS[: 2 + decoded], [T.BinaryType(), T.LongType(), T.BinaryType()]))
    given = _without(docs, list(results)).withColumn("text", F.col("text").cast("string"))
    return _mapped(given, "text", lambda b, text: trimmed(_coded(b, text, content, pattern, decoded)), results)


def decode(frame: DataFrame, path: str) -> DataFrame:
    """The rows with ``decoded``, the bytes of ``ids``."""
    content = _content(frame, path)
    results = {"decoded": T.BinaryType()}
    given = _without(frame, list(results))
    return _mapped(given, "ids", lambda b, ids: trimmed(_decoded(b, ids, content)), results)
