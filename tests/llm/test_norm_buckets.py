"""Ranked lexical search next to scores of every document."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from nomina.llm import normbuckets
from tests.llm.test_decontaminate import terms
from tests.llm.test_llm import SCHEMA


def _tables(spark):
    r = random.Random(7)
    pool = ["".join(r.choice("abcdefgéß9") for _ in range(r.randint(1, 4))) for _ in range(300)]
    some = lambda n: " ".join(pool[min(int(r.expovariate(0.03)), 299)] for _ in range(n))
    rows = [(i, some(r.randint(1, 120))) for i in range(200)]
    rows += [(200 + i, rows[3][1]) for i in range(30)]  # more copies than places
    rows += [(300, None), (301, ""), (302, " ;"), (303, some(4000)), rows[5], (None, rows[3][1]), (304, "UNIQUE-Word unique")]
    documents = spark.createDataFrame([(i, t, "en", "s", 1, "x", 1, 2, 3) for i, t in r.sample(rows, len(rows))], SCHEMA)
    items = [(i, some(r.randint(1, 30))) for i in range(25)] + [(30, rows[3][1]), (31, "unique unique"), (32, "nowhere"), (33, ""), (34, None), (None, "word"), (35, rows[3][1])]
    return documents, rows, spark.createDataFrame([(i, t, 1, 2.0, "c") for i, t in items], "item_id long, text string, rank int, length double, item string"), items


def _expected(rows, items, k=10):
    docs = [(i, terms(t)) for i, t in rows]
    n_docs, n_terms = sum(bool(w) for _, w in docs), sum(len(w) for _, w in docs)
    df = Counter(t for _, w in docs for t in set(w))
    out = []
    for item, text in items:
        scored = []
        for i, w in docs:
            tf, score = Counter(w), 0
            m = 25 + 75 * len(w) * n_docs // n_terms if w else 0
            for t in terms(text):
                if tf[t]:
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("limits", [{}, {"BUCKET": 7}, {"FIRST_SHARE": 0.3, "BUCKET": 16}, {"BLOCK_BYTES": 400}])
def test_top_documents(spark, monkeypatch, limits):
    documents, rows, benchmark, items = _tables(spark)
    for name, value in limits.items():
        monkeypatch.setattr(normbuckets, name, value)
    result = normbuckets.top_documents(documents, benchmark)
    assert Counter(tuple(r) for r in result.collect()) == _expected(rows, items)


def test_empty_tables(spark):
    documents, _, benchmark, _ = _tables(spark)
    assert normbuckets.top_documents(documents.limit(0), benchmark).collect() == []
    assert normbuckets.top_documents(documents, benchmark.limit(0)).collect() == []
    assert normbuckets.top_documents(documents.filter("text is null"), benchmark).collect() == []


def test_buckets_out_of_reach_are_not_opened():
    items = normbuckets.Items(np.arange(3, dtype=np.uint64), [np.array([0, 1])], [np.array([1, 1])])
    weight = np.array([100, 400, 900])
    at = np.arange(5) * 2
    long = normbuckets.Bucket(np.arange(4), np.zeros(4, bool), np.full(4, np.sqrt(500.0) * 1000), np.array([0, 1] * 4), np.full(8, 1000), at)
    searcher = normbuckets.Searcher(items, weight, np.array([1]), 2)
    searcher.look(long)
    assert searcher.best[0].scores.tolist() == [500_000, 500_000] and searcher.best[0].ids.tolist() == [0, 1]
    short = normbuckets.Bucket(np.arange(4), np.zeros(4, bool), np.full(4, np.sqrt(500.0) * 10), np.array([0, 1] * 4), np.full(8, 10), at)
    searcher.look(short)
    assert short._columns is None


def test_a_wide_product_does_not_overflow():
    n = np.array([10**9, 3])
    expected = [10**9 * 5 // (5000 + 8 * (25 + 75 * x * 10**11 // 10**13)) for x in n.tolist()]
    assert normbuckets.impacts(np.array([5, 5]), n, 10**11, 10**13).tolist() == expected
