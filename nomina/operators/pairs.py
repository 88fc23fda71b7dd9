"""Operators on tables of name pairs ``(pair_id, name_1, name_2, is_duplicate)``."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nomina.functions import similarity
from nomina.functions.text import capitalize, normalize, words
from nomina.operators.ranking import take_slice, with_position
from nomina.session import materialize

# The scored features and their default weight and threshold.
SCORED = ("ratio", "partial_ratio", "token_sort_ratio", "token_set_ratio", "subs_ratio")
DEFAULT_WEIGHT = 0.2
DEFAULT_THRESHOLD = 0.8
SAME_NAME = "Одинаковое название"
OTHER_NAME = "Другое название"
SAME_NAME_FROM = 0.99


# --- Set operations -----------------------------------------------------------------


def stacked_names(pairs: DataFrame) -> DataFrame:
    """Both name columns as one, from a single scan."""
    return pairs.select(F.explode(F.array("name_1", "name_2")).alias("name"))


def distinct_names(pairs: DataFrame) -> DataFrame:
    return stacked_names(pairs).distinct()


def swapped(pairs: DataFrame) -> DataFrame:
    swap = {"name_1": "name_2", "name_2": "name_1"}
    return pairs.select(*(F.col(swap.get(c, c)).alias(c) for c in pairs.columns))


def symmetric(pairs: DataFrame) -> DataFrame:
    """Pairs in both directions, without repeats."""
    return pairs.unionByName(swapped(pairs)).distinct()


# --- Bulk-load frame ------------------------------------------------------------------


def company_frame(
    pairs: DataFrame, start: int = 0, stop: int | None = None, chunk: int | None = None, min_length: int = 2
) -> DataFrame:
    """Company records of all names in non-duplicate pairs.

    Names are distinct over everything, or, with ``chunk``, within runs of that many
    pairs only, so that a name can come back in a later run.
    """
    negatives = pairs.filter(F.col("is_duplicate") == 0)
    if start or stop is not None:
        negatives = take_slice(negatives, "pair_id", start, stop)
    keys = ["name"]
    if chunk:
        negatives = with_position(negatives, "pair_id").withColumn("chunk_id", F.floor((F.col("position") - 1) / chunk))
        keys = ["chunk_id", "name"]
        names = negatives.select("chunk_id", F.explode(F.array("name_1", "name_2")).alias("name"))
    else:
        names = stacked_names(negatives)
    kept = names.filter(F.length("name") >= min_length).dropDuplicates(keys)
    normalized = kept.withColumn("normalized_name", normalize(F.col("name")))
    return normalized.select(
        *keys[:-1],
        capitalize(F.col("normalized_name")).alias("company_name"),
        "normalized_name",
        F.lit("").alias("company_url"),
        F.col("name").alias("query_string"),
    )


# --- Features and scores ----------------------------------------------------------------


def pair_features(pairs: DataFrame, matcher: str = "indel", blended: bool = True) -> DataFrame:
    """All similarity features of each pair."""
    a, b = F.col("name_1"), F.col("name_2")
    scored = similarity.with_ratios(pairs, a, b, matcher, blended)
    split = scored.withColumns({"_w1": words(a), "_w2": words(b)})
    shared = similarity.shared_share(F.col("_w1"), F.col("_w2"))
    return split.withColumns({"levenshtein": similarity.levenshtein(a, b), "subs_ratio": shared}).drop("_w1", "_w2")


def _weighted(weights: Mapping[str, float]) -> list[Column]:
    return [F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * F.lit(float(weights[name])) for name in SCORED]


@dataclass(frozen=True)
class FuzzyPairClassifier:
    """Weighted mean of five similarities, scaled by the smallest and largest weighted value of the batch.

    The scale is taken over all rows and all features together, so a score depends on
    the batch it is computed in. ``fit`` freezes the scale of a batch for later use on
    single rows or streams.
    """

    threshold: float = DEFAULT_THRESHOLD
    weights: Mapping[str, float] = field(default_factory=lambda: dict.fromkeys(SCORED, DEFAULT_WEIGHT))
    bounds: tuple[float, float] | None = None
    matcher: str = "indel"

    def _features(self, pairs: DataFrame) -> DataFrame:
        return pairs if set(SCORED) <= set(pairs.columns) else pair_features(pairs, self.matcher, blended=False)

    def _bounds(self, features: DataFrame) -> DataFrame:
        weighted = _weighted(self.weights)
        return features.agg(F.min(F.least(*weighted)).alias("lowest"), F.max(F.greatest(*weighted)).alias("highest"))

    def fit(self, pairs: DataFrame) -> FuzzyPairClassifier:
        row = self._bounds(self._features(pairs)).first()
        return FuzzyPairClassifier(self.threshold, self.weights, (row.lowest, row.highest), self.matcher)

    def predict(self, pairs: DataFrame) -> DataFrame:
        """Add ``score`` and ``prediction`` (1 when the score is above the threshold)."""
        features = self._features(pairs)
        if self.bounds is None:
            if features is not pairs:
                # Two passes need the features, and computing them is the expensive part.
                features = materialize(features, "pair-features")
            bounds = self._bounds(features)
            low, high = (bounds.select(c).scalar() for c in ("lowest", "highest"))
        else:
            low, high = (F.lit(v) for v in self.bounds)
        mean = sum(_weighted(self.weights)) / F.lit(float(len(SCORED)))
        # All values equal leaves no scale: the score is then 0 and nothing is predicted.
        score = F.coalesce(F.try_divide(mean - low, high - low), F.lit(0.0))
        return features.withColumn("score", score).withColumn(
            "prediction", (F.col("score") > self.threshold).cast("int")
        )


def verdict(score: Column, above: float = SAME_NAME_FROM) -> Column:
    return F.when(score > above, SAME_NAME).otherwise(OTHER_NAME)


# --- Splits ---------------------------------------------------------------------------------


def random_split(pairs: DataFrame, test_percent: int = 33, seed: int = 69, key: str = "pair_id") -> DataFrame:
    """Add ``split`` from a hash of seed and key: a row lands in the same part in every run and every engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100
    return pairs.withColumn("split", F.when(bucket < test_percent, "test").otherwise("train"))


def balanced_split(pairs: DataFrame, share: float = 0.2) -> DataFrame:
    """Add ``split``: as many negatives as positives for testing, the rest for training.

    ``test``: the first ``share`` of the positives and as many negatives.
    ``train_balanced``: rows of the remaining training data that also make up the
    balanced training set; ``train``: those only in the full one.
    """
    positives = pairs.filter(F.col("is_duplicate") == 1).agg(F.count("*").alias("n"))
    test = F.bround(positives.select("n").scalar() * F.lit(share), 0)
    balanced = positives.select("n").scalar()
    ranked = with_position(pairs, "pair_id", ["is_duplicate"])
    in_balanced = (F.col("is_duplicate") == 1) | (F.col("position") <= balanced)
    return ranked.withColumn(
        "split",
        F.when(F.col("position") <= test, "test").when(in_balanced, "train_balanced").otherwise("train"),
    ).drop("position")


def stratified_folds(pairs: DataFrame, k: int = 5) -> DataFrame:
    """Add ``fold``: contiguous blocks within each class, sized as an unshuffled stratified k-fold does.

    Sorting all rows by class and dealing them out one by one gives each fold its number
    of rows per class; classes are ordered by their first row.
    """
    from pyspark.sql import Window

    classes = pairs.groupBy("is_duplicate").agg(F.count("*").alias("n"), F.min("pair_id").alias("first"))
    # One row per class.
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    classes = classes.select("is_duplicate", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("s"))

    def dealt(upto: Column, fold: int) -> Column:
        """Rows among the first ``upto`` that go to ``fold``."""
        return F.floor((upto + (k - 1 - fold)) / k)

    ends, total = [], F.lit(0)
    for fold in range(k):
        total = total + dealt(F.col("s") + F.col("n"), fold) - dealt(F.col("s"), fold)
        ends.append(total)
    classes = classes.select("is_duplicate", F.array(*ends).alias("ends"))
    ranked = with_position(pairs, "pair_id", ["is_duplicate"])
    joined = ranked.join(F.broadcast(classes), "is_duplicate")  # one row per class
    fold = F.size(F.filter("ends", lambda end: end < F.col("position")))
    return joined.select(*pairs.columns, fold.alias("fold"))
