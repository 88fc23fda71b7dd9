import bisect
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from nomina.operators import evaluate, pairs, ranking, tune

SCHEMA = "pair_id long, name_1 string, name_2 string, is_duplicate int"
ROWS = [
    (0, "big pharma", "big pharma llc", 1),
    (1, "roga i kopyta", "kopyta i roga", 1),
    (2, "yandex", "yandx", 1),
    (3, "Pirelli Neumaticos S.A.I.C.", "asjh ajhsf iajshf has", 0),
    (4, "", "", 0),
]


@pytest.fixture
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def labelled(spark, labels):
    return spark.createDataFrame([(i, f"a{i}", f"b{i}", y) for i, y in enumerate(labels)], SCHEMA)


def test_scores_are_scaled_over_rows_and_features(table):
    features = {r.pair_id: r for r in pairs.pair_features(table, blended=False).collect()}
    order = sorted(features)
    matrix = np.array([[(features[i][c] or 0) * 0.2 for c in pairs.SCORED] for i in order], dtype=float)
    want = ((matrix - matrix.min()) / (matrix.max() - matrix.min())).mean(axis=1)
    scored = {r.pair_id: r for r in pairs.FuzzyPairClassifier(threshold=0.6).predict(table).collect()}
    assert np.allclose([scored[i].score for i in order], want)
    assert [scored[i].prediction for i in order] == [int(s > 0.6) for s in want]


def test_scores_depend_on_the_batch_unless_frozen(table):
    classifier = pairs.FuzzyPairClassifier()
    alone = classifier.predict(table.filter("pair_id = 2")).first().score
    together = classifier.predict(table).filter("pair_id = 2").first().score
    assert alone != together
    frozen = classifier.fit(table).predict(table.filter("pair_id = 2")).first().score
    assert frozen == pytest.approx(together)


def test_equal_values_everywhere_predict_nothing(spark):
    features = spark.createDataFrame([(1, 50.0, 50.0, 50.0, 50.0, 50.0)], ["pair_id", *pairs.SCORED])
    row = pairs.FuzzyPairClassifier(threshold=0.2).predict(features).first()
    assert (row.score, row.prediction) == (0.0, 0)


def test_verdict(spark):
    rows = spark.createDataFrame([(0.99,), (0.991,)], "s double").select(pairs.verdict(F.col("s")).alias("v"))
    assert [r.v for r in rows.collect()] == ["Другое название", "Одинаковое название"]


def test_set_operations(table):
    assert pairs.distinct_names(table).count() == 9
    assert pairs.symmetric(table.select("name_1", "name_2")).count() == 9  # ("", "") is its own mirror image


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_positions_of_ids(spark, parts):
    rng = random.Random(1)
    ids = rng.sample(range(-50, 1000), 80) + [1 << 60, -(1 << 61)]
    rows = [(i, rng.choice("ab") if i % 7 else None) for i in ids]
    frame = spark.createDataFrame(rows, "id long, k string").repartition(parts)
    got = {r.id: r.position for r in ranking.with_position(frame, "id", ["k"]).collect()}
    want = {}
    for k in ("a", "b", None):
        want |= {i: n for n, i in enumerate(sorted(i for i, x in rows if x == k), 1)}
    assert got == want
    assert [r.id for r in ranking.take_slice(frame, "id", 5, 9).orderBy("id").collect()] == sorted(ids)[5:9]


def test_positions_of_any_key(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["", "é", "b", "aa", None]), [rng.randint(0, 2)], rng.choice([0.5, float("nan")]), i % 40, {"m": 1}) for i in range(200)]
    rows += [("b", [1], 0.5, 7, {"m": 1})] * 100  # a third of all rows is one row
    frame = spark.createDataFrame(rows, "part string, place array<int>, n double, any int, row map<string,int>")
    by_text = ranking.with_position(frame, ["part", "place"], name="p")
    assert by_text.columns == [*frame.columns, "p"]
    got = sorted(by_text.collect(), key=lambda r: r.p)
    assert [r.p for r in got] == list(range(1, 301))
    key = lambda r: ((r[0] is not None, (r[0] or "").encode()), r[1], (r[2] != r[2], r[2] if r[2] == r[2] else 0), r[3])
    assert [key(r) for r in got] == sorted(map(key, rows))
    inside = ranking.with_position(frame, "n", ["part"]).collect()
    for part in ("", "é", "b", "aa", None):
        assert sorted(r.position for r in inside if r.part == part) == list(range(1, 1 + sum(r[0] == part for r in rows)))


def test_no_part_of_a_ranking_holds_a_hot_key(spark, monkeypatch):
    seen = []
    store = ranking.materialize
    monkeypatch.setattr(ranking, "materialize", lambda df, label: seen.append(store(df, label)) or seen[-1])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        frame = spark.range(4000).select(F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id")).alias("key"))
        ranking.with_position(frame, "key").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [r["count"] for r in seen[0].groupBy("part").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 1500


def test_positions_of_nothing(spark):
    assert ranking.with_position(spark.createDataFrame([], "a string, b int"), "a", ["b"]).collect() == []


def test_balanced_split(spark):
    rng = random.Random(2)
    labels = [int(rng.random() < 0.3) for _ in range(101)]
    got = {r.pair_id: r.split for r in pairs.balanced_split(labelled(spark, labels)).collect()}
    positives = [i for i, y in enumerate(labels) if y]
    negatives = [i for i, y in enumerate(labels) if not y]
    n = round(0.2 * len(positives))
    assert {i for i, s in got.items() if s == "test"} == set(positives[:n] + negatives[:n])
    assert {i for i, s in got.items() if s == "train_balanced"} == set(positives[n:] + negatives[n : len(positives)])


@pytest.mark.parametrize("k", [2, 5])
def test_stratified_folds(spark, k):
    rng = random.Random(k)
    labels = [int(rng.random() < 0.4) for _ in range(37)]
    got = {r.pair_id: r.fold for r in pairs.stratified_folds(labelled(spark, labels), k).collect()}
    classes = list(dict.fromkeys(labels))
    dealt = sorted(classes.index(y) for y in labels)
    for c, label in enumerate(classes):
        sizes = [dealt[f::k].count(c) for f in range(k)]
        want = [f for f, n in enumerate(sizes) for _ in range(n)]
        assert [got[i] for i, y in enumerate(labels) if y == label] == want


def test_random_split_is_reproducible(spark):
    frame = labelled(spark, [0, 1] * 500)
    first, again = (
        {r.pair_id: r.split for r in pairs.random_split(f).collect()} for f in (frame, frame.repartition(3))
    )
    assert first == again
    assert 250 < list(first.values()).count("test") < 410


def test_company_frame(spark):
    rows = [(0, "ООО Рога 1", "x", 0), (1, "ООО Рога 1", "Big Pharma, LTD", 0), (2, "secret", "pair", 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.company_name, r.normalized_name, r.company_url, r.query_string) for r in pairs.company_frame(frame).collect())
    assert got == [("Big pharma", "big pharma", "", "Big Pharma, LTD"), ("Ooo roga", "ooo roga", "", "ООО Рога 1")]
    assert pairs.company_frame(frame, chunk=1).count() == 3
    assert pairs.company_frame(frame, start=1).count() == 2


def scored(spark, rows):
    return spark.createDataFrame(rows, "is_duplicate int, score double").withColumn("prediction", (F.col("score") > 0.5).cast("int"))


def test_metrics(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 1), round(rng.random(), 2)) for _ in range(300)]
    frame = scored(spark, rows)
    for r in evaluate.threshold_sweep(frame).collect():
        predicted = [s > r.threshold for _, s in rows]
        tp = sum(p and y for p, (y, _) in zip(predicted, rows))
        fp = sum(p and not y for p, (y, _) in zip(predicted, rows))
        fn = sum((not p) and y for p, (y, _) in zip(predicted, rows))
        assert (r.tp, r.fp, r.fn) == (tp, fp, fn)
        assert r.f1 == pytest.approx(2 * tp / (2 * tp + fp + fn) if tp else 0.0)
    positive = [s for y, s in rows if y]
    negative = [s for y, s in rows if not y]
    wins = sum((p > n) + (p == n) / 2 for p in positive for n in negative)
    assert evaluate.roc_auc(frame).first().roc_auc == pytest.approx(wins / len(positive) / len(negative))


def test_threshold_modes(spark):
    sweep = evaluate.threshold_sweep(scored(spark, [(1, 0.9), (1, 0.4), (0, 0.3), (0, 0.2)]))
    assert evaluate.best_threshold(sweep).first().asDict() == {"threshold": 0.3, "f1": 1.0}
    assert evaluate.best_threshold(sweep, "last_positive").first().threshold == 0.89


def test_no_positive_prediction_scores_zero(spark):
    frame = scored(spark, [(1, 0.1), (0, 0.2)])
    assert evaluate.summary(frame).first().asDict() == {"accuracy": 0.5, "f1": 0.0, "roc_auc_labels": 0.5}
    report = {r.entry: r for r in evaluate.classification_report(frame).collect()}
    assert (report["1"].precision, report["1"].recall, report["0"].recall) == (0.0, 0.0, 1.0)


def test_trials_match_scoring_fold_by_fold(spark):
    rng = random.Random(4)
    rows = [(i, *(float(rng.randint(0, 100)) for _ in range(4)), round(rng.random(), 3), rng.randint(0, 1)) for i in range(40)]
    features = spark.createDataFrame(rows, ["pair_id", *pairs.SCORED, "is_duplicate"])
    folded = pairs.stratified_folds(features, 4)
    trials = tune.random_trials(6, seed=1)
    got = {r.trial_id: r.objective for r in tune.evaluate_trials(tune.feature_counts(folded), trials).collect()}
    table = [r.asDict() for r in folded.collect()]
    for trial in trials:
        accuracies = []
        for fold in range(4):
            part = [r for r in table if r["fold"] == fold]
            matrix = np.array([[r[c] * trial[f"w_{c}"] for c in pairs.SCORED] for r in part])
            score = ((matrix - matrix.min()) / (matrix.max() - matrix.min())).mean(axis=1)
            accuracies.append(np.mean((score > trial["threshold"]) == np.array([r["is_duplicate"] == 1 for r in part])))
        assert got[trial["trial_id"]] == pytest.approx(1 - np.mean(accuracies))


def test_tune_reports(spark):
    rng = random.Random(5)
    rows = [(i, *(float(rng.randint(0, 100)) for _ in range(5)), rng.randint(0, 1)) for i in range(30)]
    features = spark.createDataFrame(rows, ["pair_id", *pairs.SCORED, "is_duplicate"])
    classifier, log = tune.tune(features, n_trials=10, n_points_iter=4, k=3, seed=2)
    best = tune.best_trial(log).first()
    assert classifier.threshold == best.threshold and classifier.weights["ratio"] == best.w_ratio
    assert log.count() == 10
    history = [r.best_so_far for r in tune.optimisation_history(log).orderBy("trial_id").collect()]
    assert history == sorted(history, reverse=True) and history[-1] == best.objective
    assert tune.parameter_evaluations(log).count() == 60
    assert tune.objective_histogram(log).agg(F.sum("n")).first()[0] == 10
    assert max(r.share for r in tune.empirical_distribution(log).collect()) == 1.0
    assert all(0.2 <= r.threshold <= 1 for r in log.collect())


def test_roc_auc_of_scores_close_together(spark):
    rng = random.Random(5)
    rows = [(rng.random() * 1e-6 if i % 3 else float(i % 2), rng.randrange(2)) for i in range(6_000)]
    rows += [(None, 1), (None, 0)]
    frame = spark.createDataFrame(rows, "score double, is_duplicate int").repartition(4)
    positive = sorted(s for s, y in rows if y and s is not None)
    negative = sorted(s for s, y in rows if not y and s is not None)
    wins = sum(bisect.bisect_left(negative, p) + (bisect.bisect_right(negative, p) - bisect.bisect_left(negative, p)) / 2 for p in positive)
    got = evaluate.roc_auc(frame).first()
    assert got.roc_auc == pytest.approx(wins / len(positive) / len(negative))
    assert (got.positives, got.negatives) == (len(positive), len(negative))
    assert evaluate.roc_auc(frame.limit(0)).first().roc_auc == 0
