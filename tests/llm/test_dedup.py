"""Line, word, byte and near-duplicate removal against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

import daybook.llm.suffix_dedup as suffix_dedup_module
from daybook.llm import segments
from daybook.llm.components import components
from daybook.llm.line_dedup import line_dedup
from daybook.llm.minhash_dedup import near_dedup, near_duplicates
from daybook.llm.substring_dedup import substring_dedup
from daybook.llm.suffix_dedup import suffix_dedup


def corpus(seed: int, n: int = 60) -> list[tuple[int, str]]:
    """Texts with shared passages, exact and near copies."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 6)))
    shared = [[word() for _ in range(draw.randint(10, 60))] for _ in range(4)]
    texts = []
    for _ in range(n):
        kind = draw.random()
        if texts and kind < 0.15:
            texts.append(draw.choice(texts))
            continue
        if texts and kind < 0.35:
            words = draw.choice(texts).split(" ")
            for _ in range(draw.randint(1, 4)):
                words[draw.randrange(len(words))] = word()
            texts.append(" ".join(words))
            continue
        words = [word() + ("\n" if draw.random() < 0.1 else "") for _ in range(draw.randint(1, 120))]
        if kind < 0.7:
            at = draw.randrange(len(words))
            words[at:at] = draw.choice(shared)
        texts.append(" ".join(words))
    return list(enumerate(texts))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def repeated(sequences: list[list], window: int) -> list[list[bool]]:
    """Which symbols are covered by a window that also starts elsewhere."""
    runs = [[tuple(s[i : i + window]) for i in range(len(s) - window + 1)] for s in sequences]
    times = Counter(run for each in runs for run in each)
    covered = []
    for symbols, each in zip(sequences, runs):
        gone = [False] * len(symbols)
        for start, run in enumerate(each):
            if times[run] > 1:
                gone[start : start + window] = [True] * window
        covered.append(gone)
    return covered


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_substrings(spark):
    rows = [*corpus(1), (100, None), (101, ""), (102, "a " * 90)]
    found = {r.doc_id: r for r in substring_dedup(frame(spark, rows), 12).collect()}
    lists = [words_of(text) for _, text in rows]
    for (doc_id, _), words, gone in zip(rows, lists, repeated(lists, 12)):
        kept = " ".join(w for w, out in zip(words, gone) if not out)
        assert (found[doc_id].n_words, found[doc_id].n_removed, found[doc_id].text) == (
            len(words),
            sum(gone),
            kept,
        )


@pytest.mark.parametrize("hot", [4096, 1])
def test_byte_strings(spark, hot):
    rows = [*corpus(2), (100, None), (101, ""), (102, "ab" * 200)]
    found = {r.doc_id: r for r in suffix_dedup(frame(spark, rows), 50, 12, hot).collect()}
    lists = [list((text or "").encode()) for _, text in rows]
    for (doc_id, _), data, gone in zip(rows, lists, repeated(lists, 50)):
        row = found[doc_id]
        assert bytes(row.kept) == bytes(b for b, out in zip(data, gone) if not out)
        assert (row.n_bytes, row.n_removed) == (len(data), sum(gone))
        assert sum(x.length for x in row.spans) == sum(gone)
        assert len(row.spans) == sum(out and not before for before, out in zip([False, *gone], gone))


def test_hot_anchors_take_their_bytes_from_the_same_pass(spark, monkeypatch):
    passes = []

    def counted(docs, *rest, **named):
        passes.append(rest)
        return asked(docs, *rest, **named)

    asked = segments.asked
    for module in (segments, suffix_dedup_module):
        monkeypatch.setattr(module, "asked", counted)
    # one anchor with many different segments, some windows of which are repeated without the rest
    draw = random.Random(8)
    letters = lambda n: "".join(draw.choice("abcdefghé") for _ in range(n))
    anchor, ends = letters(90), [letters(30) for _ in range(6)]
    rows = [(i, letters(30) + anchor + draw.choice(ends) + letters(30)) for i in range(40)]
    found = {r.doc_id: r for r in suffix_dedup(frame(spark, [*rows, (50, None)]), 50, 12, 4).collect()}
    lists = [list(text.encode()) for _, text in rows]
    for (doc_id, _), data, gone in zip(rows, lists, repeated(lists, 50)):
        assert any(gone)
        assert bytes(found[doc_id].kept) == bytes(b for b, out in zip(data, gone) if not out)
    assert found[50].n_bytes == 0
    assert len(passes) == 1  # the texts are dealt once for the shards and for the hot anchors' windows


def test_lines(spark):
    rows = [
        (1, "a\nb\nc\nd"),
        (2, "x\na\n\nb\nc\ny"),
        (3, "a\na\na\na"),
        (4, "q\nr"),
        (5, "\n\n\n\n"),
        (6, None),
    ]
    found = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in line_dedup(frame(spark, rows)).collect()}
    assert found == {
        1: ("a\nb\nc\nd", 4, 0),
        2: ("x\n\ny", 6, 3),  # the blank line takes no part and stays
        3: ("a", 4, 3),
        4: ("q\nr", 2, 0),
        5: ("\n\n\n\n", 5, 0),
        6: (None, 0, 0),
    }


def shingles(text):
    words = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def test_near_duplicates(spark):
    rows = [*corpus(3, 80), (100, None), (101, ""), (102, "one two"), (103, "ONE  two"), (104, "one")]
    sets = {doc_id: shingles(text) for doc_id, text in rows}
    root = {doc_id: doc_id for doc_id in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    found = {r.doc_id: r for r in near_duplicates(frame(spark, rows)).collect()}
    for doc_id in sets:
        row = found[doc_id]
        assert (row.n_shingles, row.component_id) == (len(sets[doc_id]), find(doc_id))
        assert row.kept == (find(doc_id) == doc_id)
    kept = {r.doc_id for r in near_dedup(frame(spark, rows)).collect()}
    assert kept == {x for x in sets if find(x) == x}


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (5, 5)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {tuple(r) for r in found} == {(2, 1), (3, 1), (7, 1), (8, 1), (9, 1), (21, 20)}


OPERATORS = [line_dedup, substring_dedup, suffix_dedup, near_dedup]


@pytest.mark.parametrize("operator", OPERATORS, ids=lambda f: f.__name__)
def test_odd_rows(spark, odd_docs, no_docs, operator):
    found = operator(odd_docs)
    rows = found.collect()
    assert {"key", "first", "row", "out", "odd.name"} <= set(found.columns)
    ids = Counter(row.doc_id for row in rows)
    if operator is near_dedup:  # the repeated id is one document, kept by its least id: itself
        assert set(ids) == {None, 1, 2, 3, 4, 5, 6, 7} and ids[None] == 2
    else:
        assert ids == Counter(row.doc_id for row in odd_docs.collect())
        assert all(row.n_removed >= 0 for row in rows)
    assert operator(no_docs).count() == 0



def thue_morse(n: int) -> tuple[str, str]:
    """A word and its complement that every polynomial hash modulo 2**64 takes for equal."""
    word = "".join("ab"[bin(i).count("1") & 1] for i in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("size", [1024, 4096])
def test_words_that_polynomials_take_for_equal(spark, size):
    one, two = thue_morse(size)
    before, after = " ".join(f"x{i}" for i in range(17)), " ".join(f"y{i}" for i in range(17))
    docs = frame(spark, [(1, f"{before} {one} {after}"), (2, f"{before} {two} {after}")])
    assert [r.n_removed for r in substring_dedup(docs).collect()] == [0, 0]
    assert [r.n_removed for r in substring_dedup(docs, window=17).collect()] == [34, 34]
    docs = frame(spark, [(1, f"first\n{one}\nlast"), (2, f"first\n{two}\nlast")])
    assert [r.n_removed for r in line_dedup(docs).collect()] == [0, 0]
    docs = frame(spark, [(1, f"p q r s {one}"), (2, f"p q r s {two}")])
    assert sorted(r.component_id for r in near_duplicates(docs).collect()) == [1, 2]
    docs = frame(spark, [(1, one), (2, two), (3, one)])
    assert [r.n_removed for r in sorted(suffix_dedup(docs, window=size).collect())] == [size, 0, size]
