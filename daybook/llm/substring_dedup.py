"""Removal of word sequences that occur more than once.

A word is a run of characters other than ``\\x20`` and ``\\x09``-``\\x0D``. Every word covered by
``window`` consecutive words of one text that also start anywhere else goes, in all places;
the judgement is on the input, not on what is left. Kept words are joined by one space.

Lengths double from level to level, and only what is repeated at one length is looked at at
the next: runs of a quarter of the window (one per segment of windows, see ``segments``),
then of half of it, then whole windows, where the search ends.

Null and empty texts have no words, nothing is removed, and the text becomes empty. Texts
shorter than the window stay. Rows equal in id and text are two occurrences of each other.
Other columns pass unchanged, except those named like a result (``text``, ``n_words``,
``n_removed``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.rows import KEY, packed, unpacked, with_lists
from daybook.llm.segments import compared, covered, repeats, word_symbols
from daybook.llm.text_arrays import Words

WINDOW = 35


def repeated_windows(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id``, ``key``, ``first``, ``n``: runs of window starts whose windows occur again."""
    found = repeats(docs, word_symbols, window, -(-window // 4))
    return found.whole.unionByName(compared(docs, found.open, word_symbols, window))


def _kept(texts, runs, window):
    rows = []
    for text, spans in zip(texts, runs):
        data = (text or "").encode()
        words = Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
        pieces = [data[a:b] for a, b in zip(words.starts.tolist(), words.ends.tolist())]
        gone = 0
        if spans is not None and len(spans):
            first = np.array([x["first"] for x in spans])
            n = np.array([x["n"] for x in spans])
            out = covered(len(pieces), first, n, window)
            gone = int(out.sum())
            kept = [piece for piece, removed in zip(pieces, out.tolist()) if not removed]
        else:
            kept = pieces
        rows.append((b" ".join(kept).decode(), len(pieces), gone))
    return rows


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without repeated windows, with ``n_words`` and ``n_removed``."""

    @F.pandas_udf("struct<text string, n_words long, n_removed long>")
    def rebuilt(texts: pd.Series, runs: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(_kept(texts, runs, window), columns=["text", "n_words", "n_removed"])

    runs = repeated_windows(docs, window)
    lists = runs.groupBy(*KEY).agg(F.collect_list(F.struct("first", "n")).alias("runs"))
    out = with_lists(packed(docs), lists).withColumn("out", rebuilt("text", "runs"))
    return unpacked(
        out, docs.columns, {name: F.col("out")[name] for name in ("text", "n_words", "n_removed")}
    )
