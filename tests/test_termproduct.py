import random

import numpy as np
import pytest

from nomina.operators import fuzzyterms, search, termproduct
from nomina.operators.ranking import first_per_group
from nomina.sources.index import build_index
from pyspark.sql import functions as F

ROW = "{key} {kind}, group_no int, rare_terms array<long>, rare_values array<double>, hot_terms array<long>, hot_values array<double>"


def _rows(n, seed, key):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        rare, hot = rng.sample(range(30), rng.randint(0, 5)), rng.sample(range(100, 106), rng.randint(0, 4))
        rows.append((key(i), 1 + i % 2, rare, [rng.choice([0.5, 1.0, 2.0]) for _ in rare], hot, [rng.choice([0.25, 4.0]) for _ in hot]))
    return rows


def _brute_force(queries, texts, most):
    found = set()
    for q, group, *lists in queries:
        rare, hot = dict(zip(lists[0], lists[1])), dict(zip(lists[2], lists[3]))
        scored = []
        for t, other, *of_text in texts:
            shared = [rare[x] * v for x, v in zip(of_text[0], of_text[1]) if x in rare]
            if other == group and shared:
                scored.append((-sum(shared) - sum(hot[x] * v for x, v in zip(of_text[2], of_text[3]) if x in hot), t))
        found |= {(q, group, t, -s) for s, t in sorted(scored)[:most]}
    return found


@pytest.mark.parametrize("most_terms", [termproduct.MOST_TERMS, 40])
def test_best_texts_match_brute_force_in_one_and_many_blocks(spark, monkeypatch, most_terms):
    monkeypatch.setattr(termproduct, "MOST_TERMS", most_terms)
    queries, texts = _rows(60, 1, lambda i: f"q{i}"), _rows(200, 2, lambda i: i)
    left = spark.createDataFrame(queries, ROW.format(key="query_no", kind="string"))
    right = spark.createDataFrame(texts, ROW.format(key="text_id", kind="long"))
    best = first_per_group(termproduct.best_texts(left, right, 5, 9), ["query_no", "group_no"], [F.desc("engine_score"), F.col("text_id")], 5)
    assert {tuple(row) for row in best.collect()} == _brute_force(queries, texts, 5)


def test_rows_with_one_id_are_one_text_or_stay_apart(spark):
    queries = spark.createDataFrame([(1, 1, [7, 8], [1.0, 1.0], [9], [1.0])], ROW.format(key="query_no", kind="long"))
    rows = [(5, 1, [7], [1.0], [9], [2.0]), (5, 1, [8], [2.0], [9], [1.0]), (None, 1, [8], [1.0], [], [])]
    texts = spark.createDataFrame(rows, ROW.format(key="text_id", kind="long"))
    merged = termproduct.best_texts(queries, texts, 9, 9).collect()
    assert [(row.text_id, row.engine_score) for row in merged] == [(5, 5.0), (None, 1.0)]
    apart = termproduct.best_texts(queries, texts, 9, 9, one_per_id=False).collect()
    assert [(row.text_id, row.engine_score) for row in apart] == [(5, 3.0), (5, 3.0), (None, 1.0)]


def _operators(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_single_matches_never_become_rows(spark):
    rows = [(i, f"Common word{i}", "", "", f"common word{i}") for i in range(40)]
    companies = spark.createDataFrame(rows, "doc_id long, company_name string, company_url string, query_string string, normalized_name string")
    queries = spark.createDataFrame([(i, f"common word{i + 1}") for i in range(40)], "query_no long, query string")
    index = build_index(companies, hot_texts=10)
    profiles = search._profiles(index, queries, 0).localCheckpoint()
    heads = profiles.filter(F.size("hot") > 0).select("segment", "field", F.col("query_no").alias("head_no"), "hot")
    assert "Join" not in _operators(search._by_rare_terms(index, profiles))
    by_hot = search._by_hot_terms(index, heads)
    assert "Join" not in _operators(by_hot)
    # Every query's ten best share only the common word with it; equal scores go by id.
    assert {tuple(row) for row in by_hot.groupBy("field").agg(F.count("*"), F.max("text_id")).collect()} == {("company_name", 400, 9), ("normalized_name", 400, 9)}


def test_variants_of_terms_are_shuffled_not_broadcast(spark):
    words = spark.createDataFrame([(f"word{i}",) for i in range(50)], "token string")
    near = fuzzyterms._short_candidates(words, words.withColumnRenamed("token", "term"), 2)
    assert "Broadcast" not in _operators(near) and "SortMergeJoin" in _operators(near)


def test_profiles_are_dealt_by_query_once(spark):
    rows = [(i, f"Common word{i}", "", "", f"common word{i}") for i in range(40)]
    companies = spark.createDataFrame(rows, "doc_id long, company_name string, company_url string, query_string string, normalized_name string")
    queries = spark.createDataFrame([(i, f"common word{i + 1}") for i in range(40)], "query_no long, query string")
    plan = _operators(search._profiles(build_index(companies), queries, 0))
    assert plan.count("Exchange hashpartitioning(query_no") == 1


def test_sums_of_few_matches_are_those_of_all_rows(monkeypatch):
    """A query with few matches does not go through all texts of a block; its sums are the same to the last bit."""
    r = np.random.default_rng(4)
    row, gain = r.integers(0, 5000, 200), r.random(200)
    counted, bincount = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda x, w, n: counted.append(n) or bincount(x, w, n))
    few = termproduct._sums(row, gain, 5000)
    assert max(counted) <= 200
    monkeypatch.setattr(termproduct, "FEW", 0)
    every = termproduct._sums(row, gain, 5000)
    assert all(np.array_equal(x, y) for x, y in zip(few, every))
    assert [len(x) for x in termproduct._sums(row[:0], gain[:0], 9)] == [0, 0]
