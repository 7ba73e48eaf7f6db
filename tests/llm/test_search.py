"""Hard negatives and ranked search against plain brute force."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daybook.llm import cells, hard_negatives as hn, ranked_search

VECTORS = "vec_id long, label int, embedding array<float>, `row` string, rank int, cell int"


def expected_negatives(rows, is_anchor, k=5, n=5, percent=80):
    usable = {}
    for vec_id, label, x, *_ in rows:
        if vec_id is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        one = (label, [float(np.float32(c)) for c in x])
        usable[vec_id] = min(usable.get(vec_id, one), one)
    whole = {i: (label, [math.floor(256 * c) for c in x]) for i, (label, x) in usable.items()}
    out = []
    for a, (label, v) in whole.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w)), i, other) for i, (other, w) in whole.items() if i != a)
        for down, positive, _ in [x for x in scored if x[2] == label][:k]:
            inside = [(s, i) for s, i, other in scored if other != label and down <= s and 80 * -down <= 100 * -s]
            out += [(a, positive, r + 1, i, -down, -s) for r, (s, i) in enumerate(inside[:n])]
    return sorted(out)


def vector_rows(seed, n, width=6, labels=3):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        x = [draw.choice([-0.5, 0.0, 0.004, 0.25, 1.0, 1.5]) for _ in range(width)]
        rows.append((i, draw.randrange(labels), x, "r", 1, 2))
    same = rows[3][2]
    rows = [(i, label, same if i % 3 == 0 else x, *rest) for i, label, x, *rest in rows]  # a hot vector
    odd = [
        (None, 1, [1.0] * width), (1000, None, [1.0] * width), (1001, 1, None), (1002, 1, [1.0, None]),
        (1003, 1, [float("nan")] * width), (1004, 1, [float("inf")] * width), (1005, 1, []),
        (1006, 1, [2.0]), (1007, 2, [2.0] * (width + 3)), (7, 0, [1.0] * width), (-10, 1, [1.0] * width),
    ]
    return rows + [(*x, None, None, None) for x in odd] + rows[:2]


@pytest.mark.parametrize("seed", range(3))
def test_hard_negatives(spark, seed, monkeypatch):
    monkeypatch.setattr(cells, "LEAST_ROWS", 64)
    monkeypatch.setattr(hn, "CELL_ANCHORS", 8)
    rows = vector_rows(seed, 240)
    frame = spark.createDataFrame(rows, VECTORS)
    found = hn.hard_negatives(frame, F.col("vec_id") % 10 == 0)
    expected = expected_negatives(rows, lambda i: i % 10 == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect())) == expected
    assert len(expected) > 200


def test_hard_negatives_without_rows(spark):
    rows = vector_rows(1, 30)
    frame = spark.createDataFrame(rows, VECTORS)
    assert hn.hard_negatives(frame.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hn.hard_negatives(frame, F.col("vec_id") > 10_000).count() == 0
    one_label = frame.withColumn("label", F.lit(4))
    assert hn.hard_negatives(one_label, F.col("vec_id") % 10 == 0).count() == 0


def test_products_are_exact():
    draw = np.random.default_rng(1)
    for most in (1 << 8, 1 << 29):
        a, b = draw.integers(-most, most, (5, 7)), draw.integers(-most, most, (4, 7))
        truth = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in b] for p in a]
        assert hn.products(a, b).tolist() == truth


def test_hard_negatives_plan(spark):
    """No cross join and no broadcast of rows or anchors."""
    frame = spark.createDataFrame(vector_rows(1, 60), VECTORS)
    plan = hn.hard_negatives(frame, F.col("vec_id") % 10 == 0)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "WindowGroupLimit" in plan


# --- ranked search --------------------------------------------------------------------------


def plain_terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    term = lambda c: c.isascii() and c.isalnum() or not c.isascii()
    return "".join(c if term(c) else " " for c in lowered).split(" ")


def expected_ranks(docs, items, k=10):
    texts = [(i, [t for t in plain_terms(text) if t]) for i, text in docs]
    spoken = [x for x in texts if x[1]]
    n_docs, length = len(spoken), sum(len(t) for _, t in spoken)
    df = Counter(t for _, terms in spoken for t in set(terms))
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item_id, text in set(items):
        asked = Counter(t for t in plain_terms(text) if t)
        scores = []
        for doc_id, terms in spoken:
            tf, m = Counter(terms), 25 + 75 * len(terms) * n_docs // length
            score = sum(n * weight.get(t, 0) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m)) for t, n in asked.items())
            if score > 0 and doc_id is not None:
                scores.append((-score, doc_id))
        out += [(item_id, rank + 1, doc_id, -down) for rank, (down, doc_id) in enumerate(sorted(scores)[:k])]
    return out


def search_texts(seed, n):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["É", "été", "漢字", "Zoo", "zoo"]
    rare = [f"rare{i}" for i in range(200)]

    def text(size):
        return draw.choice([" ", ", ", "\n"]).join(
            draw.choice(rare) if draw.random() < 0.1 else words[min(int(draw.expovariate(0.1)), 64)] for _ in range(size)
        )

    docs = [(i, text(draw.choice([1, 5, 30, 200]))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, " \t.,_"), (n + 3, "x" * 30_000), (n + 4, "w1 " * 30_000)]
    docs += [(None, text(40)), docs[3], docs[3], (5, text(30))]  # no id, repeated rows, two texts of one id
    items = [(i, text(draw.choice([1, 3, 20]))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "nowhere"), (103, text(400)), (104, docs[7][1]), items[2], (None, "w1 w2")]
    return docs, items


@pytest.mark.parametrize("seed", range(3))
def test_ranked_search(spark, seed, monkeypatch):
    monkeypatch.setattr(cells, "LEAST_ROWS", 64)
    monkeypatch.setattr(ranked_search, "CELL_TERMS", 100)
    docs, items = search_texts(seed, 400)
    frame = spark.createDataFrame([(*x, 1, "t") for x in docs], "doc_id long, text string, rank int, terms string")
    asked = spark.createDataFrame([(*x, 2) for x in items], "item_id long, text string, score int")
    found = ranked_search.ranked_search(frame, asked).select("item_id", "rank", "doc_id", "score").collect()
    order = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(map(tuple, found), key=order) == sorted(expected_ranks(docs, items), key=order)


def test_ranked_search_leaves_documents_out(monkeypatch):
    """Small buckets: few pairs are scored exactly, and long lists stop at a short document."""
    monkeypatch.setattr(ranked_search, "BUCKET", 8)
    draw = np.random.default_rng(3)
    n, width = 4000, 300
    docs = []
    for i in range(n):
        picked = draw.choice(width, draw.integers(3, 40), replace=False)
        docs.append((i, {f"t{x}": int(draw.integers(1, 1000)) for x in picked}))
    queries = [{f"t{x}": int(draw.integers(1, 50)) for x in draw.choice(width, 6, replace=False)} for _ in range(20)]
    docs.sort(key=lambda x: -sum(v * v for v in x[1].values()))
    rows = pa.array(
        [
            {"doc_id": i, "doc_key": 0, "terms": " ".join(v), "impacts": list(v.values()), "norm": math.sqrt(sum(x * x for x in v.values()))}
            for i, v in docs
        ],
        pa.struct({"doc_id": pa.int64(), "doc_key": pa.int64(), "terms": pa.string(), "impacts": pa.list_(pa.int32()), "norm": pa.float64()}),
    )
    asked = pa.array(
        [{"item_id": i, "item_key": 0, "terms": list(q), "weights": list(q.values())} for i, q in enumerate(queries)],
        pa.struct({"item_id": pa.int64(), "item_key": pa.int64(), "terms": pa.list_(pa.string()), "weights": pa.list_(pa.int64())}),
    )
    search = ranked_search._Search(asked, 10)
    scored = []
    rescore = search._rescore
    monkeypatch.setattr(search, "_rescore", lambda docs, bucket, query, doc: (scored.append(len(query)), rescore(docs, bucket, query, doc)))
    search.take(rows)
    for number, query in enumerate(queries):
        truth = sorted((-sum(w * v.get(t, 0) for t, w in query.items()), i) for i, v in docs)[:10]
        mine = search.best.group == number
        assert sorted(zip(-search.best.score[mine], search.best.id[mine])) == truth
    assert sum(scored) < 0.2 * n * len(queries)
