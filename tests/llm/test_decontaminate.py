"""Benchmark windows in documents next to brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from nomina.llm import decontaminate
from tests.llm.test_llm import LOWER, SCHEMA

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").encode().translate(LOWER).decode())


def _tables(spark):
    r = random.Random(11)
    pool = ["".join(r.choice("abcdefgéß9") for _ in range(r.randint(1, 5))) for _ in range(60)]
    some = lambda n: [r.choice(pool) for _ in range(n)]
    items = [some(r.randint(10, 40)) for _ in range(12)]
    items += [items[0], items[1][3:] + some(5), some(4), some(1) + ["zzz"], ["loop"] * 25, ["Only"] + some(9), items[2][:12] + items[3][:12]]
    benchmark = [(i, " ".join(w)) for i, w in enumerate(items)] + [(100, None), (101, ""), (102, " ... "), (None, "no id for this item of ten words or some more"), (5, "zzz yyy")]
    rows = []
    for i in range(60):
        item = r.choice(items)
        a, n = r.randint(0, max(0, len(item) - 5)), r.randint(1, 30)
        text = some(r.randint(0, 50)) + item[a : a + n] + some(r.randint(0, 20)) + r.choice(items)
        rows.append((i, "".join((w.upper() if r.random() < 0.2 and w.isascii() else w) + r.choice([" ", "\n", ", ", "-"]) for w in text)))
    rows += [(60, None), (61, ""), (62, " ;"), (63, "loop " * 200), (64, "no ID for this item of ten-words or some MORE."), (65, " ".join(some(3000)) + " " + benchmark[0][1])]
    rows += [rows[0], (None, rows[1][1])]
    documents = spark.createDataFrame([(i, t, "en", "s", 1, "x", 1, 2, 3) for i, t in rows], SCHEMA)
    return documents, rows, spark.createDataFrame([(i, t, "clash", 7) for i, t in benchmark], "item_id long, text string, row string, name long"), benchmark


def _expected(rows, benchmark, window=10):
    wanted = {}
    for i, t in benchmark:
        w = terms(t)
        size = min(window, len(w))
        for j in range(len(w) - size + 1 if size else 0):
            wanted.setdefault(tuple(w[j : j + size]), set()).add("" if i is None else str(i))
    sizes = {len(w) for w in wanted}
    out = []
    for i, t in rows:
        w = terms(t)
        hit, items = [False] * len(w), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                found = wanted.get(tuple(w[p : p + n]))
                if found:
                    hit[p : p + n] = [True] * n
                    items |= found
        out.append((i, len(w), sum(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), any(hit)))
    return out


@pytest.mark.parametrize("limits", [{}, {"SHARD_BYTES": 300}, {"PIECE_WORDS": 37}, {"BLOCK_BYTES": 200}])
def test_contamination(spark, monkeypatch, limits):
    documents, rows, benchmark, items = _tables(spark)
    for name, value in limits.items():
        monkeypatch.setattr(decontaminate, name, value)
    result = decontaminate.contamination(documents, benchmark).collect()
    expected = _expected(rows, items)
    assert Counter(tuple(r)[:6] for r in result) == Counter(expected)
    for r in result:
        assert sum(b - a for a, b in zip(r["spans"][::2], r["spans"][1::2], strict=True)) == r["n_hit"]
    kept = decontaminate.clean(documents, benchmark)
    assert kept.columns == documents.columns
    clean = Counter(i for i, *_, contaminated in expected if not contaminated)
    assert Counter(r["doc_id"] for r in kept.collect()) == clean
    assert clean


def test_empty_tables(spark):
    documents, rows, benchmark, _ = _tables(spark)
    assert decontaminate.contamination(documents.limit(0), benchmark).collect() == []
    result = decontaminate.contamination(documents, benchmark.limit(0)).collect()
    assert Counter(tuple(r)[:6] for r in result) == Counter(_expected(rows, []))
    assert decontaminate.longest_matches(documents, benchmark.limit(0)).collect() == []


def test_longest_matches(spark):
    documents, rows, benchmark, items = _tables(spark)
    expected = {}
    for i, t in items:
        w = terms(t)
        for j in range(len(w)):
            best = None
            for d, text in rows:
                v = terms(text)
                for p in range(len(v)):
                    n = 0
                    while j + n < len(w) and p + n < len(v) and w[j + n] == v[p + n]:
                        n += 1
                    best = min(best or (0,), (-n, d is None, d, p))
            if best and -best[0] >= min(10, len(w)) and (len(w) - j >= 10 or j == 0):
                expected[i, t, j] = (-best[0], best[2], best[3])
    result = decontaminate.longest_matches(documents, benchmark.select("item_id", "text")).collect()
    ids = Counter(i for i, _, _ in expected)
    assert Counter(r["item_id"] for r in result) == ids
    for r in result:
        assert any((r["n_words"], r["doc_id"], r["doc_word"]) == v for (i, _, j), v in expected.items() if (i, j) == (r["item_id"], r["item_word"]))


def test_suffixes_are_in_order():
    r = np.random.default_rng(4)
    numbers = r.integers(0, 6, 400)
    numbers[-1] = 0
    array = decontaminate.SuffixArray(numbers, 3, 500)

    def run(p):
        return numbers[p : p + int(np.flatnonzero(numbers[p:] == 0)[0])].tolist()

    runs = [run(p) for p in array.suffixes.tolist()]
    assert runs == sorted(runs)
    assert sorted(array.suffixes.tolist()) == [p for p in range(400) if numbers[p] and len(run(p)) >= 3]
