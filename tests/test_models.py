import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from nomina.functions.encoding import Encoder, build_vocabulary, max_length
from nomina.operators import models
from nomina.sources import tables

SCHEMA = "pair_id long, name_1 string, name_2 string, is_duplicate int"


@pytest.fixture
def table(spark):
    rows = [(i, f"Name {i % 5}", f"name {(i + j) % 5}", int(j == 0)) for i in range(20) for j in (0, 2)]
    return spark.createDataFrame([(k, *r[1:]) for k, r in enumerate(rows)], SCHEMA)


def test_vocabulary_round_trip(spark, table, tmp_path):
    vocabulary = build_vocabulary(table, ["name_1", "name_2"])
    assert {r.ch: r.id for r in vocabulary.collect()} == {c: i for i, c in enumerate(sorted(" 01234amen"))}
    tables.write_vocabulary(vocabulary, str(tmp_path / "v"))
    encoder = Encoder(tables.read_vocabulary(spark, str(tmp_path / "v")), length=8)
    row = spark.createDataFrame([("Name 3",)], "n string").select(encoder.encode(F.col("n")).alias("c"))
    assert row.first().c == [9, 6, 8, 7, 0, 4, 10, 10]
    assert row.select(encoder.decode(F.col("c")).alias("d")).first().d == "name 3"
    assert max_length(table, ["name_1", "name_2"]).first().max_length == 6


def test_encoding_policies(spark, table):
    vocabulary = build_vocabulary(table, ["name_1", "name_2"])
    odd = spark.createDataFrame([("nameЖ",)], "n string")
    with pytest.raises(PySparkException):
        odd.select(Encoder(vocabulary).encode(F.col("n"))).collect()
    assert odd.select(Encoder(vocabulary, unknown_id=99).encode(F.col("n")).alias("c")).first().c[4] == 99
    long = spark.createDataFrame([("name name",)], "n string")
    with pytest.raises(PySparkException):
        long.select(Encoder(vocabulary, length=4).encode(F.col("n"))).collect()
    short = Encoder(vocabulary, length=4, on_long="truncate")
    assert len(long.select(short.encode(F.col("n")).alias("c")).first().c) == 4


def test_pair_encoding_has_both_names(spark, table):
    encoder = Encoder(build_vocabulary(table, ["name_1", "name_2"]))
    codes = table.select(encoder.encode_pair(F.col("name_1"), F.col("name_2")).alias("c")).first().c
    assert len(codes) == 510 and codes[254] == codes[509] == encoder.padding_id


def test_boosted_trees_learn_a_clear_rule(spark):
    rows = [(i, *([90 if i % 2 else 10] * 6), i % 2, i % 5 == 0) for i in range(60)]
    columns = ["pair_id", *models.TREE_FEATURES, "is_duplicate", "check"]
    frame = spark.createDataFrame(rows, columns)
    model = models.boosted_trees(frame, validation="check", rounds=5, max_depth=2)
    scored = models.compare_names(model, frame).collect()
    assert all((r.score > 0.5) == (r.is_duplicate == 1) for r in scored)
    assert {r.verdict for r in scored} <= {"Одинаковое название", "Другое название"}


def test_boosting_goes_on_while_the_error_falls(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        x = [rng.random() * 100 for _ in models.TREE_FEATURES]
        rows.append((i, *x, int(x[0] + x[1] + rng.gauss(0, 10) > 100), i % 4 == 0))
    frame = spark.createDataFrame(rows, ["pair_id", *models.TREE_FEATURES, "is_duplicate", "check"])
    model = models.boosted_trees(frame, validation="check", rounds=40, max_depth=2, patience=6)
    longer = models.boosted_trees(frame.filter("not check"), rounds=model.stages[-1].getNumTrees + 6, max_depth=2)
    held = longer.stages[0].transform(frame.filter("check"))
    errors = longer.stages[-1].evaluateEachIteration(held, "squared")
    assert model.stages[-1].getNumTrees == errors.index(min(errors)) + 1 > 1
    own = [r.score for r in models.compare_names(model, frame).orderBy("pair_id").collect()]
    same = models.boosted_trees(frame.filter("not check"), rounds=model.stages[-1].getNumTrees, max_depth=2)
    assert own == pytest.approx([r.score for r in models.compare_names(same, frame).orderBy("pair_id").collect()])


def test_boosting_on_character_codes(spark):
    rows = [(i, "abc" if i % 2 else "xyz", f"n{i % 7}", i % 2) for i in range(80)]
    pairs = spark.createDataFrame(rows, SCHEMA)
    encoded = models.encoded_pairs(pairs, Encoder(build_vocabulary(pairs, ["name_1", "name_2"]), length=4))
    encoded = encoded.withColumn("check", F.col("pair_id") % 10 == 0)
    model = models.boosted_trees(encoded, features=None, validation="check", rounds=3, max_depth=2)
    assert all((r.score > 0.5) == (r.is_duplicate == 1) for r in models.compare_names(model, encoded).collect())


def test_patience():
    assert models.stopped_at([5, 4, 6, 3, 7, 7, 7, 1], 3) == 4
    assert models.stopped_at([5, 4, 6, 3, 7, 7, 1, 2], 3) == 7
    assert models.stopped_at([5], 3) == 1


def test_perceptron_runs_on_encoded_pairs(spark, table):
    encoder = Encoder(build_vocabulary(table, ["name_1", "name_2"]), length=8)
    encoded = models.encoded_pairs(table, encoder)
    model = models.perceptron(encoded, inputs=16, hidden=(4,), epochs=3)
    assert models.compare_names(model, encoded).filter("score between 0 and 1").count() == table.count()
    assert models.training_history(model, spark).count() >= 1


def test_perceptron_trains_inputs_that_never_vary_as_one(spark, table, tmp_path, monkeypatch):
    """The whole network's losses and scores, from a fit of the inputs that vary and one more."""
    encoded = models.encoded_pairs(table, Encoder(build_vocabulary(table, ["name_1", "name_2"]), length=30)).coalesce(1)
    whole = models.MultilayerPerceptronClassifier(labelCol="is_duplicate", layers=[60, 5, 4, 2], maxIter=8, seed=69).fit(encoded)
    layers = []
    fit = models.MultilayerPerceptronClassifier._fit
    monkeypatch.setattr(models.MultilayerPerceptronClassifier, "_fit", lambda self, rows: layers.append((self.getLayers()[0], self.getMaxIter())) or fit(self, rows))
    model = models.perceptron(encoded, inputs=60, hidden=(5, 4), epochs=8)
    assert max(n for n, steps in layers if steps) < 20
    assert [r.loss for r in models.training_history(model, spark).orderBy("step").collect()] == pytest.approx(whole.summary().objectiveHistory)
    assert list(model.stages[-1].weights) == pytest.approx(list(whole.weights), rel=1e-6, abs=1e-8)
    longer = spark.createDataFrame([(1, "name " * 4, "Name 1", 1)], SCHEMA)  # inputs that never vary in training do here
    longer = models.encoded_pairs(longer, Encoder(build_vocabulary(table, ["name_1", "name_2"]), length=30))
    want = [r.probability[1] for r in whole.transform(longer).collect()]
    assert [r.score for r in models.compare_names(model, longer).collect()] == pytest.approx(want)


def test_trees_after_the_best_are_cut_off_without_a_fit(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i, *(rng.random() for _ in models.TREE_FEATURES), rng.randint(0, 1)) for i in range(200)]
    frame = spark.createDataFrame(rows, ["pair_id", *models.TREE_FEATURES, "is_duplicate"])
    long, short = (models.boosted_trees(frame, rounds=n, max_depth=2) for n in (5, 3))
    cut = models.PipelineModel([long.stages[0], models.first_trees(long.stages[-1], 3)])
    assert cut.stages[-1].getNumTrees == 3 and cut.stages[-1].getPredictionCol() == "score"
    cut.write().overwrite().save(str(tmp_path / "m"))
    want = [r.score for r in models.compare_names(short, frame).orderBy("pair_id").collect()]
    for model in (cut, models.PipelineModel.load(str(tmp_path / "m"))):
        assert [r.score for r in models.compare_names(model, frame).orderBy("pair_id").collect()] == pytest.approx(want)
