"""Learned pair classifiers on MLlib."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomina.functions.encoding import Encoder
from nomina.functions.similarity import RATIO_FIELDS
from nomina.operators.pairs import verdict
from nomina.session import materialize

FIRST_ROUNDS = 14  # beyond the patience, before rounds are doubled
TREE_FEATURES = ("levenshtein", *RATIO_FIELDS)


def encoded_pairs(pairs: DataFrame, encoder: Encoder) -> DataFrame:
    """Add ``features``: the character ids of both names as one vector."""
    return pairs.withColumn("features", array_to_vector(encoder.encode_pair(F.col("name_1"), F.col("name_2"))))


def boosted_trees(
    train: DataFrame,
    features: Sequence[str] | None = TREE_FEATURES,
    validation: str | None = None,
    rounds: int = 1000,
    max_depth: int = 6,
    step: float = 0.3,
    seed: int = 69,
    patience: int = 50,
) -> PipelineModel:
    """Regression on the 0/1 label, used as a score; stops early on the rows marked by ``validation``.

    Those rows are not trained on. Of all rounds up to the one that ``patience`` rounds have not
    bettered, the best stays. MLlib can neither wait nor go on from a fitted model, but a shorter
    fit of the same rows and seed is the beginning of a longer one: the number of rounds doubles
    until the best lies far enough back, and the trees after it are cut off.
    ``features=None`` takes an existing ``features`` vector such as encoded characters.
    """
    stages = [] if features is None else [VectorAssembler(inputCols=list(features), outputCol="features")]
    trees = GBTRegressor(
        labelCol="is_duplicate", featuresCol="features", predictionCol="score", maxDepth=max_depth, stepSize=step, seed=seed
    )

    def fitted(rows: DataFrame, n: int) -> PipelineModel:
        return Pipeline(stages=[*stages, trees.copy({trees.maxIter: n})]).fit(rows)

    if not validation:
        return fitted(train, rounds)
    kept, held = materialize(train.filter(~F.col(validation)), "boosting"), materialize(train.filter(validation), "boosting-validation")
    n = min(rounds, patience + FIRST_ROUNDS)
    while True:
        model = fitted(kept, n)
        ready = model.stages[0].transform(held) if stages else held
        errors = model.stages[-1].evaluateEachIteration(ready, "squared")
        best = stopped_at(errors, patience)
        if n >= rounds or best + patience <= n:
            return model if best == n else PipelineModel([*model.stages[:-1], first_trees(model.stages[-1], best)])
        n = min(rounds, 2 * n)


def first_trees(model: GBTRegressionModel, n: int) -> GBTRegressionModel:
    """The boosted trees up to the n-th: those that a fit of n rounds gives, without another fit."""
    gateway, made = SparkContext._active_spark_context._gateway, model._java_obj
    ml = gateway.jvm.org.apache.spark.ml.regression
    trees, weights = gateway.new_array(ml.DecisionTreeRegressionModel, n), gateway.new_array(gateway.jvm.double, n)
    for i, (tree, weight) in enumerate(zip(list(made.trees())[:n], list(made.treeWeights())[:n], strict=True)):
        trees[i], weights[i] = tree, weight
    short = GBTRegressionModel(ml.GBTRegressionModel(model.uid, trees, weights))
    short._resetUid(model.uid)
    return model._copyValues(short)


def stopped_at(errors: Sequence[float], patience: int) -> int:
    """Rounds of the best error, of those before ``patience`` rounds without a better one."""
    best = 0
    for i, error in enumerate(errors):
        if error < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def perceptron(
    train: DataFrame, inputs: int, hidden: Sequence[int] = (64, 64), epochs: int = 20, seed: int = 69
) -> PipelineModel:
    """Binary multilayer perceptron over the ``features`` vector."""
    layers = [inputs, *hidden, 2]
    network = MultilayerPerceptronClassifier(labelCol="is_duplicate", featuresCol="features", layers=layers, maxIter=epochs, seed=seed)
    low, high = _bounds(train)
    same = low == high
    if len(low) != inputs or same.sum() < 2:
        return Pipeline(stages=[network]).fit(train)
    # Inputs that never vary move their weights along one line, the direction of their values c: weights across it have
    # no gradient. One input of value |c| stands for all of them, and each step is the one of the whole network.
    start = np.array(_weighted(train, network).weights)
    first = start[: inputs * layers[1]].reshape(inputs, layers[1])
    fixed, norm = low[same], float(np.linalg.norm(low[same]))
    line = fixed / norm if norm else fixed
    begin = line @ first[same]
    narrow_start = np.concatenate((first[~same].reshape(-1), begin, start[inputs * layers[1] :]))
    varying = np.flatnonzero(~same).tolist()
    sliced = train.withColumn("_norm", F.lit(norm))
    stages = [VectorAssembler(inputCols=["_norm"], outputCol="_fixed")]
    if varying:
        stages = [VectorSlicer(inputCol="features", outputCol="_varying", indices=varying)]
        stages.append(VectorAssembler(inputCols=["_varying", "_norm"], outputCol="_fixed"))
    narrow = network.copy({network.layers: [len(varying) + 1, *layers[1:]], network.featuresCol: "_fixed", network.initialWeights: Vectors.dense(narrow_start)})
    trained = Pipeline(stages=[*stages, narrow]).fit(sliced).stages[-1]
    end = np.array(trained.weights)
    moved, at = first.copy(), len(varying) * layers[1]
    moved[~same] = end[:at].reshape(-1, layers[1])
    moved[same] += np.outer(line, end[at : at + layers[1]] - begin)
    whole = np.concatenate((moved.reshape(-1), end[at + layers[1] :]))
    model = _weighted(train, network.copy({network.initialWeights: Vectors.dense(whole)}))
    model.summary = trained.summary  # of the training, not of the fit without steps that made the model
    return PipelineModel([model])


def _bounds(train: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest value of each input."""
    found = train.select(Summarizer.metrics("min", "max").summary(F.col("features")).alias("s")).select("s.min", "s.max").first()
    return found["min"].toArray(), found["max"].toArray()


def _weighted(train: DataFrame, network: MultilayerPerceptronClassifier):
    """The network with the weights that its training starts from: a fit of no steps on two empty rows."""
    empty = Vectors.sparse(network.getLayers()[0], {})
    rows = train.sparkSession.createDataFrame([(0.0, empty), (1.0, empty)], ["is_duplicate", "features"])
    return network.copy({network.maxIter: 0}).fit(rows)


def training_history(model: PipelineModel, spark) -> DataFrame:
    """Loss after each optimiser step of a fitted perceptron."""
    losses = model.stages[-1].summary().objectiveHistory
    return spark.createDataFrame([(i, float(x)) for i, x in enumerate(losses)], "step int, loss double")


def compare_names(model: PipelineModel, pairs: DataFrame) -> DataFrame:
    """Add ``score`` and the ``verdict`` text to pairs that carry the model's inputs."""
    scored = model.transform(pairs)
    if "score" not in scored.columns:
        scored = scored.withColumn("score", vector_to_array("probability")[1])
    return scored.withColumn("verdict", verdict(F.col("score")))
