"""Search for the weights and threshold of the fuzzy pair classifier."""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nomina.operators.pairs import SCORED, FuzzyPairClassifier, pair_features, stratified_folds
from nomina.session import materialize

PARAMETERS = ("threshold", *(f"w_{name}" for name in SCORED))
LOWEST_THRESHOLD = 0.2  # fixed value: the threshold is searched in [0.2, 1], weights in [0, 1]

Trial = dict[str, float]


def random_trials(n: int, seed: int = 0, first_id: int = 0) -> list[Trial]:
    rng = random.Random(seed)
    return [
        {"trial_id": first_id + i, "threshold": rng.uniform(LOWEST_THRESHOLD, 1.0)}
        | {f"w_{name}": rng.random() for name in SCORED}
        for i in range(n)
    ]


def trials_near(best: Trial, n: int, spread: float, seed: int, first_id: int) -> list[Trial]:
    """Trials drawn around a good one, kept inside the search space."""
    rng = random.Random(seed)

    def draw(name: str) -> float:
        low = LOWEST_THRESHOLD if name == "threshold" else 0.0
        return min(1.0, max(low, rng.gauss(best[name], spread)))

    return [{"trial_id": first_id + i} | {name: draw(name) for name in PARAMETERS} for i in range(n)]


def _trial_array(trials: Sequence[Trial]) -> Column:
    """All trials as one constant; there are as many as the caller asks for, whatever the data."""
    schema = "array<struct<trial_id:int," + ",".join(f"{p}:double" for p in PARAMETERS) + ">>"
    text = ",".join("{" + ",".join(f'"{k}":{t[k]!r}' for k in ("trial_id", *PARAMETERS)) + "}" for t in trials)
    return F.from_json(F.lit(f"[{text}]"), schema)


def feature_counts(folded: DataFrame) -> DataFrame:
    """Rows counted by fold, label and feature values: what trials are evaluated on.

    Four features take 101 values and the fifth few more, so this shrinks large tables
    before the trials multiply them.
    """
    values = [F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(name) for name in SCORED]
    return folded.groupBy("fold", "is_duplicate", *values).agg(F.count("*").alias("n"))


def evaluate_trials(counts: DataFrame, trials: Sequence[Trial]) -> DataFrame:
    """``(trial_id, parameters, objective)`` with objective = 1 - mean accuracy over the folds.

    Each fold is scored as a batch of its own. Weights are not negative, so the scale of
    a trial in a fold follows from the smallest and largest value of each feature there.
    """
    bounds = counts.groupBy("fold").agg(
        F.array(*(F.min(name) for name in SCORED)).alias("lows"),
        F.array(*(F.max(name) for name in SCORED)).alias("highs"),
    )
    rows = counts.join(F.broadcast(bounds), "fold")  # one row per fold
    tried = rows.withColumn("t", F.explode(_trial_array(trials)))
    weights = [F.col(f"t.w_{name}") for name in SCORED]
    low = F.least(*(w * F.col("lows")[i] for i, w in enumerate(weights)))
    high = F.greatest(*(w * F.col("highs")[i] for i, w in enumerate(weights)))
    mean = sum(w * F.col(name) for w, name in zip(weights, SCORED)) / F.lit(float(len(SCORED)))
    predicted = F.coalesce(F.try_divide(mean - low, high - low), F.lit(0.0)) > F.col("t.threshold")
    correct = predicted == (F.col("is_duplicate") == 1)
    folds = tried.groupBy("t", "fold").agg(
        (F.sum(F.when(correct, F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy")
    )
    return folds.groupBy("t").agg((1 - F.avg("accuracy")).alias("objective")).select("t.*", "objective")


def best_trial(results: DataFrame) -> DataFrame:
    """The trial with the lowest objective, the earliest of equals."""
    row = F.struct(*(F.col(c) for c in results.columns))
    return results.agg(F.min_by(row, F.struct("objective", "trial_id")).alias("best")).select("best.*")


def tune(
    pairs: DataFrame, n_trials: int = 100, n_points_iter: int | None = None, k: int = 5, seed: int = 0
) -> tuple[FuzzyPairClassifier, DataFrame]:
    """Best classifier and the log of all trials.

    Features are computed once. Trials run ``n_points_iter`` at a time (all together by
    default): a first batch over the whole space, then half of each batch around the
    best trial so far.
    """
    features = pairs if set(SCORED) <= set(pairs.columns) else pair_features(pairs, blended=False)
    counts = materialize(feature_counts(stratified_folds(materialize(features, "tune-features"), k)), "tune-counts")
    step = n_points_iter or n_trials
    log: list[Trial] = []
    for start in range(0, n_trials, step):
        size = min(step, n_trials - start)
        near = size // 2 if log else 0
        trials = random_trials(size - near, seed + start, start)
        if near:
            best = min(log, key=lambda t: (t["objective"], t["trial_id"]))
            trials += trials_near(best, near, 0.1, seed + start, start + size - near)
        log += [row.asDict() for row in evaluate_trials(counts, trials).collect()]
    results = pairs.sparkSession.createDataFrame(log, f"trial_id int, {', '.join(f'{p} double' for p in PARAMETERS)}, objective double")
    best = min(log, key=lambda t: (t["objective"], t["trial_id"]))
    return FuzzyPairClassifier(best["threshold"], {name: best[f"w_{name}"] for name in SCORED}), results


# --- Reports over the trial log (as many rows as trials) -----------------------------------


def optimisation_history(results: DataFrame) -> DataFrame:
    so_far = Window.orderBy("trial_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return results.select("trial_id", "objective", F.min("objective").over(so_far).alias("best_so_far"))


def empirical_distribution(results: DataFrame) -> DataFrame:
    return results.select("trial_id", "objective", F.cume_dist().over(Window.orderBy("objective")).alias("share"))


def objective_histogram(results: DataFrame, bins: int = 10) -> DataFrame:
    """Trials per bin of equal width between 0 and 1; an objective of 1 counts in the last bin."""
    bin_of = F.least(F.floor(F.col("objective") * bins), F.lit(bins - 1)).cast("int")
    return results.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"))


def parameter_evaluations(results: DataFrame) -> DataFrame:
    """One row per trial and parameter, for per-parameter plots and parallel coordinates."""
    return results.unpivot(["trial_id", "objective"], list(PARAMETERS), "parameter", "value")
