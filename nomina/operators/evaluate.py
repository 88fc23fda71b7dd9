"""Quality of predictions, each from one aggregation over the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nomina.session import materialize

THRESHOLDS = 100  # fixed value: 0.00, 0.01 ... 0.99


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion(df: DataFrame, label: str = "is_duplicate", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count("*").alias("n"))


def _counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    return _ratio(2 * tp, 2 * tp + fp + fn)


def classification_report(df: DataFrame, label: str = "is_duplicate", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted means."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def line(name: str, *values: Column) -> Column:
        fields = ("precision", "recall", "f1", "support")
        return F.struct(F.lit(name).alias("entry"), *(v.cast("double").alias(f) for f, v in zip(fields, values)))

    def scores(hit: Column, wrong: Column, missed: Column) -> tuple[Column, ...]:
        return _ratio(hit, hit + wrong), _ratio(hit, hit + missed), f1(hit, wrong, missed), hit + missed

    negative, positive = scores(tn, fn, fp), scores(tp, fp, fn)
    total = tp + fp + fn + tn
    accuracy = _ratio(tp + tn, total)
    macro = [(n + p) / 2 for n, p in zip(negative[:3], positive[:3])]
    weighted = [_ratio(n * negative[3] + p * positive[3], total) for n, p in zip(negative[:3], positive[:3])]
    lines = F.array(
        line("0", *negative),
        line("1", *positive),
        line("accuracy", accuracy, accuracy, accuracy, total),
        line("macro avg", *macro, total),
        line("weighted avg", *weighted, total),
    )
    return _counts(df, label, prediction).select(F.inline(lines))


def summary(df: DataFrame, label: str = "is_duplicate", prediction: str = "prediction") -> DataFrame:
    """Accuracy, positive-class F1 and the ROC area of hard labels, (TPR + TNR) / 2."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return _counts(df, label, prediction).select(
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        f1(tp, fp, fn).alias("f1"),
        ((_ratio(tp, tp + fn) + _ratio(tn, tn + fp)) / 2).alias("roc_auc_labels"),
    )


def threshold_sweep(df: DataFrame, label: str = "is_duplicate", score: str = "score") -> DataFrame:
    """F1 at every threshold, predicting 1 strictly above it.

    Rows are first counted by the number of thresholds they pass, at most 101 values per
    class, so trying all thresholds never multiplies the rows.
    """
    s = F.col(score)
    guess = F.ceil(s * THRESHOLDS)
    # The product can be off by one unit in the last place: compare with the thresholds themselves.
    exact = guess + (s > guess / THRESHOLDS).cast("int") - (s <= (guess - 1) / THRESHOLDS).cast("int")
    passed = F.least(F.greatest(exact, F.lit(0)), F.lit(THRESHOLDS))
    counts = df.groupBy((F.col(label) == 1).alias("y"), passed.alias("passed")).agg(F.count("*").alias("n"))
    tried = counts.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(THRESHOLDS - 1))))
    above = F.col("passed") > F.col("t")
    per_threshold = tried.groupBy("t").agg(
        F.sum(F.when(above & F.col("y"), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(above & ~F.col("y"), F.col("n")).otherwise(0)).alias("fp"),
        F.sum(F.when(~above & F.col("y"), F.col("n")).otherwise(0)).alias("fn"),
    )
    return per_threshold.select(
        (F.col("t") / THRESHOLDS).alias("threshold"), "tp", "fp", "fn",
        f1(F.col("tp"), F.col("fp"), F.col("fn")).alias("f1"),
    )


def best_threshold(sweep: DataFrame, mode: str = "best") -> DataFrame:
    """``best``: the first threshold with the highest F1. ``last_positive``: the last one with any F1 above 0, else 0."""
    if mode == "best":
        return sweep.agg(
            F.max_by("threshold", F.struct("f1", -F.col("threshold"))).alias("threshold"), F.max("f1").alias("f1")
        )
    if mode != "last_positive":
        raise ValueError("mode must be 'best' or 'last_positive'")
    useful = F.when(F.col("f1") > 0, F.col("threshold"))
    return sweep.agg(
        F.coalesce(F.max(useful), F.lit(0.0)).alias("threshold"),
        F.coalesce(F.max_by("f1", useful), F.lit(0.0)).alias("f1"),
    )


def roc_auc(df: DataFrame, label: str = "is_duplicate", score: str = "score") -> DataFrame:
    """Area under the ROC curve of the scores, ties counted half; rows without a score are left out, 0 with one class only.

    Equal scores are counted together first. The different scores are cut into cells of about
    as many each, by sampled bounds, however close together they lie. The running count of
    negatives is taken inside the cells and completed from one row per cell.
    """
    y = F.col(label) == 1
    scores = df.filter(F.col(score).isNotNull()).groupBy(F.col(score).alias("s"))
    counts = scores.agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    # Bounds are a sample's, so the cells are stored: read twice, they must be the same.
    celled = materialize(counts.repartitionByRange("s").withColumn("cell", F.spark_partition_id()), "score-cells")
    cells = celled.groupBy("cell").agg(F.sum("neg").alias("cell_neg"))
    earlier = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # one row per cell
    offsets = cells.select("cell", F.coalesce(F.sum("cell_neg").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("cell").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ranked = celled.withColumn("lower", F.coalesce(F.sum("neg").over(inside), F.lit(0))).join(F.broadcast(offsets), "cell")
    wins = F.col("pos") * (F.col("before") + F.col("lower") + F.col("neg") / 2)
    return ranked.agg(
        _ratio(F.sum(wins), F.sum("pos") * F.sum("neg")).alias("roc_auc"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
    )


def learned_report(scored: DataFrame, label: str = "is_duplicate") -> DataFrame:
    """The classification report of a model's scores at the threshold of the best F1, with that threshold and the area under the ROC curve.

    ``scored`` is read several times. Rows without a score are left out by the caller.
    """
    best = best_threshold(threshold_sweep(scored, label)).select("threshold")
    area = roc_auc(scored, label).select("roc_auc")
    at_best = scored.join(F.broadcast(best)).withColumn("prediction", (F.col("score") > F.col("threshold")).cast("int"))  # one row
    report = classification_report(at_best, label)
    return report.join(F.broadcast(best)).join(F.broadcast(area))  # one row each
