"""Mixing sources to target weights by subset-sum budget fitting.

A source is taken whole as often as its target holds its size; what is left of the target
is a budget smaller than the source. The budget is fitted on the counts of documents by
exact size: first the same share of every size, then one document more of sizes with the
largest remainders, and the last ``FIT`` words by a bounded-knapsack dynamic program over
the copies still free. Which documents of a size are taken is decided by a seeded hash.

Only counts by source and size come together in a group, never documents: the program's
input grows with the number of distinct sizes. Documents of one size are ranked in hash
buckets of bounded size, so a size that holds a third of all rows is no hot group.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nomina.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_TIMES = 3
FIT = 1 << 16  # words left to the dynamic program: the length of its table
BUCKET = 1024  # documents ranked together

PLAN = "source string, size long, n long, whole long, extra long"


def sized(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size)``: words of the text, 0 for null."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", words.alias("size"))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_TIMES) -> DataFrame:
    """``(source, source_size, target)``: one row per source, so its windows are as small as that.

    Sources by code point, null last, weigh ``weights`` in turn and share the size of all
    rows; a target stops at ``most`` times its source's size and the excess is shared by
    weight among the others. With the sources ordered by how soon they stop, that is the
    share at the first source that does not stop.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = per.withColumn("_w", weight).withColumn("_cap", (F.lit(most) * F.col("source_size")).cast("double"))
    everything = Window.partitionBy()
    soonest = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").isNull(), "source")
    before, after = soonest.rowsBetween(Window.unboundedPreceding, -1), soonest.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    rate = weighed.withColumn("_rate", left / F.sum("_w").over(after))
    going = F.when(F.col("_cap") >= F.col("_rate") * F.col("_w"), F.col("_rate"))
    level = rate.withColumn("_level", F.max(going).over(everything))  # the first: later ones are lower
    target = F.least("_cap", F.coalesce(F.col("_level") * F.col("_w"), F.col("_cap")))
    return level.select("source", "source_size", target.alias("target"))


def fit(sizes: np.ndarray, free: np.ndarray, budget: int) -> np.ndarray:
    """How many of each size to take (at most ``free``) so that their sum comes nearest to ``budget``.

    Bounded knapsack: counts are cut into powers of two, and a table keeps the first piece
    that reaches each sum. Sums above the budget are left out.
    """
    taken = np.zeros(len(sizes), dtype=np.int64)
    if budget <= 0:
        return taken
    first = np.full(budget + 1, -1, dtype=np.int64)
    reached = np.zeros(budget + 1, dtype=bool)
    reached[0] = True
    pieces: list[tuple[int, int]] = []
    for k, (size, copies) in enumerate(zip(sizes.tolist(), free.tolist(), strict=True)):
        if size <= 0:
            continue
        copies, part = min(copies, budget // size), 1
        while copies > 0 and not reached[budget]:
            part = min(part, copies)
            step = part * size
            new = reached[: budget + 1 - step] & ~reached[step:]
            first[step:][new] = len(pieces)
            reached[step:] |= new
            pieces.append((k, part))
            copies -= part
            part *= 2
        if reached[budget]:
            break
    at = int(np.flatnonzero(reached)[-1])
    while at > 0:
        k, part = pieces[first[at]]
        taken[k] += part
        at -= part * int(sizes[k])
    return taken


def plan_source(rows: pd.DataFrame, most: int = MOST_TIMES) -> pd.DataFrame:
    """For one source's counts by size: how often all are taken, and how many once more."""
    rows = rows.sort_values("size", ignore_index=True)
    sizes, n = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    total, target = int((sizes * n).sum()), int(round(float(rows["target"].iloc[0])))
    whole = min(target // total, most) if total else 0
    budget = min(target - whole * total, total) if total and whole < most else 0
    extra = n * budget // total if total else np.zeros(len(n), dtype=np.int64)
    left = budget - int((extra * sizes).sum())
    remainder = (n * budget % total) if total else extra
    for k in np.argsort(-remainder, kind="stable"):
        if left <= FIT:
            break
        if extra[k] < n[k] and sizes[k] <= left:
            extra[k] += 1
            left -= int(sizes[k])
    while left > FIT:  # sizes so uneven that shares alone leave much: fill from the longest
        fits = np.flatnonzero((extra < n) & (sizes <= left) & (sizes > 0))
        if len(fits) == 0:
            break
        more = min(int(n[fits[-1]] - extra[fits[-1]]), left // int(sizes[fits[-1]]))
        extra[fits[-1]] += more
        left -= more * int(sizes[fits[-1]])
    extra = extra + fit(sizes, n - extra, min(left, FIT))
    return pd.DataFrame({"source": rows["source"], "size": sizes, "n": n, "whole": whole, "extra": extra})


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_TIMES, seed: int = 42) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, one row per row of ``docs(doc_id, text, source)``.

    ``taken`` is the words the mix takes of the document, a multiple of its size of at
    most ``most``. A null text has size 0 and takes 0; null sources are one source, the
    last. Which documents are taken depends on ``seed``, ids and sizes alone; rows that
    agree in all of them can stand for each other. An empty table gives an empty result.
    """
    sizes = materialize(sized(docs), "sizes")
    per_source = targets(sizes, weights, most)
    counts = sizes.groupBy("source", "size").agg(F.count("*").alias("n")).withColumnRenamed("source", "_s")
    histogram = counts.join(per_source, F.col("_s").eqNullSafe(F.col("source"))).select("source", "size", "n", "target")
    plan = histogram.groupBy("source").applyInPandas(lambda rows: plan_source(rows, most), PLAN)
    plan = plan.withColumn("_buckets", F.ceil(F.col("n") / BUCKET))
    per_size = plan.join(per_source.withColumnRenamed("source", "_s"), F.col("_s").eqNullSafe(F.col("source"))).select(
        F.col("source").alias("_source"), F.col("size").alias("_size"), "whole", "extra", "_buckets", "source_size", "target"
    )
    per_size = materialize(per_size, "mixing-plan")
    hashed = F.xxhash64("doc_id", "size", F.lit(seed))
    placed = (
        sizes.join(per_size, F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size")))
        .withColumn("_hash", hashed)
        .withColumn("_bucket", F.pmod("_hash", "_buckets"))
    )
    buckets = placed.groupBy("_source", "_size", "_bucket").agg(F.count("*").alias("_n"), F.first("extra").alias("_extra"))
    earlier = Window.partitionBy("_source", "_size").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    quota = buckets.select(
        F.col("_source").alias("_qs"),
        F.col("_size").alias("_qz"),
        F.col("_bucket").alias("_qb"),
        F.greatest(F.lit(0), F.least("_n", F.col("_extra") - F.coalesce(F.sum("_n").over(earlier), F.lit(0)))).alias("_quota"),
    )
    inside = Window.partitionBy("_source", "_size", "_bucket").orderBy("_hash", "doc_id")
    ranked = placed.withColumn("_rank", F.row_number().over(inside))
    same = F.col("_source").eqNullSafe(F.col("_qs")) & (F.col("_size") == F.col("_qz")) & (F.col("_bucket") == F.col("_qb"))
    times = F.col("whole") + F.when(F.col("_rank") <= F.col("_quota"), 1).otherwise(0)
    return ranked.join(quota, same).select("doc_id", "size", "source_size", "target", (F.col("size") * times).alias("taken"))
