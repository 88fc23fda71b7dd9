import random

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from nomina.operators import network


def test_gradient_by_finite_differences():
    rng = np.random.default_rng(1)
    weights = network.Weights.drawn((5, 4, 3), seed=2)
    weights.vector += rng.normal(0, 0.1, len(weights.vector))
    x, y = rng.normal(size=(12, 5)), (rng.random(12) > 0.5).astype(float)
    kept = (rng.random((12, 3)) >= 0.1) / 0.9
    found, _, _, _ = network.gradient(weights, x, y, kept)

    def loss(vector):
        return network.gradient(network.Weights(weights.sizes, vector), x, y, kept)[1]

    for i in range(len(weights.vector)):
        nudge = np.zeros_like(weights.vector)
        nudge[i] = 1e-6
        assert found[i] == pytest.approx((loss(weights.vector + nudge) - loss(weights.vector - nudge)) / 2e-6, abs=1e-5)


def frame(spark, n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rng.uniform(-1, 1) for _ in range(6)]
        rows.append((i, x, int(x[0] * x[1] > 0)))
    return spark.createDataFrame(rows, "pair_id long, x array<double>, is_duplicate int").withColumn("features", array_to_vector("x"))


def test_a_rule_that_no_line_can_draw(spark):
    model = network.train_network(frame(spark, 2000, 1), inputs=6, hidden=(16, 16), epochs=12, steps=6, learning_rate=0.02)
    log = model.epochs.orderBy("epoch").collect()
    assert [r.epoch for r in log] == list(range(1, 13))
    assert log[-1].loss < log[0].loss and log[-1].accuracy > 0.8
    held = model.transform(frame(spark, 500, 2)).select(((F.col("score") > 0.5).cast("int") == F.col("is_duplicate")).alias("right"))
    assert held.filter("right").count() > 0.8 * 500


def test_a_step_is_the_same_however_rows_are_parted(spark, monkeypatch):
    monkeypatch.setattr(network, "FEWEST_SUMS", 2)  # sums are added up in tasks as well
    monkeypatch.setattr(network, "ROWS", 1)  # every row is normalised alone, so the cut does not matter
    rows = frame(spark, 60, 3)
    args = dict(inputs=6, hidden=(4,), epochs=2, steps=1, dropout=0.0)
    one = network.train_network(rows.coalesce(1), **args)
    many = network.train_network(rows.repartition(7), **args)
    assert one.weights.vector == pytest.approx(many.weights.vector)


def test_rows_without_features_or_label_and_no_rows_at_all(spark):
    rows = frame(spark, 20, 4)
    gaps = rows.withColumn("features", F.when(F.col("pair_id") > 3, F.col("features")))
    gaps = gaps.withColumn("is_duplicate", F.when(F.col("pair_id") > 5, F.col("is_duplicate")))
    model = network.train_network(gaps, inputs=6, hidden=(4,), epochs=1, steps=2)
    assert model.transform(gaps).filter("score is null").count() == 4
    none = network.train_network(rows.filter("false"), inputs=6, hidden=(4,), epochs=2)
    assert none.epochs.count() == 0 and none.transform(rows).filter("score between 0 and 1").count() == 20


def test_batches_are_stored_without_a_sort(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("rows of a task would be sorted by batch")

    monkeypatch.setattr(DataFrameWriter, "partitionBy", refuse)
    model = network.train_network(frame(spark, 40, 1), inputs=6, hidden=(3, 3), epochs=2, steps=3)
    assert model.epochs.count() == 2
