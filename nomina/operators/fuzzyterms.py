"""Join of tokens with the terms of a vocabulary that lie within a few edits.

Spark cannot turn an edit-distance predicate into an equi-join, so both sides emit keys
that any pair within the limit must share. Short terms use deletion variants. Long ones are cut
into ``2 * limit + 1`` segments: an edit touches at most two (a transposition; the others fewer),
so one is left whole and shifted by no more than the edits before it. Terms of which a segment is
in more than ``MOST_OF_SEGMENT`` terms of their length use their rarest grams with their places instead:
an edit touches at most ``GRAM + 1`` grams, so ``limit`` edits leave one of the ``(GRAM + 1) * limit + 1``
rarest grams of both strings in common. Terms that share a long tail or head therefore meet only
through what tells them apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nomina.functions.similarity import damerau_within

LONGEST_FOR_VARIANTS = 24
GRAM = 3
MOST_OF_SEGMENT = 64  # terms that a token meets by one segment
RARITY_BUCKETS = 1 << 16  # counts of grams are kept by hash: a bound on what is broadcast


def _deletions(s: Column) -> Column:
    places = F.when(F.length(s) > 1, F.sequence(F.lit(1), F.length(s))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s))))


def deletion_variants(s: Column, limit: int) -> Column:
    """The string and everything up to ``limit`` deletions away, never empty."""
    reached = F.array(s)
    for _ in range(limit):
        reached = F.array_distinct(F.concat(reached, F.flatten(F.transform(reached, _deletions))))
    return reached


def _with_grams(strings: DataFrame, name: str) -> DataFrame:
    """``(name, size, gram, at)``: one row per place of a gram."""
    letters = strings.select(name, F.length(name).alias("size"), F.split(name, "").alias("_letters"))
    places = F.sequence(F.lit(0), F.col("size") - GRAM)
    gram = F.transform(places, lambda i: F.concat(*(F.get("_letters", i + j) for j in range(GRAM))))
    return letters.select(name, "size", F.posexplode(gram).alias("at", "gram"))


def _bucket() -> Column:
    return F.pmod(F.hash("gram"), F.lit(RARITY_BUCKETS))


def _rarest_grams(grams: DataFrame, name: str, counts: DataFrame, limit: int) -> DataFrame:
    """The grams of each string that a string within ``limit`` edits must share one of.

    Any order of grams serves as long as both sides use the same; that of the vocabulary's
    counts makes the keys selective. Equal grams are ordered by place.
    """
    counted = grams.withColumn("bucket", _bucket()).join(F.broadcast(counts), "bucket", "left")
    entry = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram", "at")
    ordered = counted.groupBy(name, "size").agg(F.sort_array(F.collect_list(entry)).alias("grams"))
    return ordered.select(name, "size", F.inline(F.slice("grams", 1, (GRAM + 1) * limit + 1))).drop("n")


def _short_candidates(tokens: DataFrame, vocabulary: DataFrame, limit: int) -> DataFrame:
    """Tokens and short terms that have a string in common after at most ``limit`` deletions each."""
    left = tokens.filter(F.length("token") <= LONGEST_FOR_VARIANTS + limit)
    left = left.select("token", F.explode(deletion_variants(F.col("token"), limit)).alias("variant"))
    right = vocabulary.filter(F.length("term") <= LONGEST_FOR_VARIANTS)
    right = right.select("term", F.explode(deletion_variants(F.col("term"), limit)).alias("variant"))
    # Length and weight are cheap to check before the distance.
    near = F.abs(F.length("token") - F.length("term")) <= limit
    weighs = (F.col("token") == F.col("term")) | (F.least(F.length("token"), F.length("term")) > 1)
    # Spark goes by the size of the terms, which are few: it would broadcast their variants to a task with all tokens.
    return left.join(right.hint("merge"), "variant").filter(near & weighs).select("token", "term")


def _moves(limit: int) -> list[tuple[int, int]]:
    """Differences in length and place: a shift and the rest of the difference in length are edits before and after it."""
    drift = range(-limit, limit + 1)
    return [(size, at) for size in drift for at in drift if abs(at) + abs(size - at) <= limit]


def _with_segments(sized: DataFrame, name: str, limit: int) -> DataFrame:
    """``(name, size, part, segment)`` of strings whose ``size`` is the length that is cut; ``moved`` is where they begin."""
    parts = 2 * limit + 1
    cut = sized.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    start, end = (F.floor((F.col("part") + i) * F.col("size") / parts).cast("int") for i in (0, 1))
    at = start - F.col("moved")
    inside = (at >= 0) & (at + end - start <= F.length(name))
    return cut.filter(inside).select(name, "size", "part", F.substring(name, at + 1, end - start).alias("segment"))


def long_candidates(tokens: DataFrame, vocabulary: DataFrame, limit: int) -> DataFrame:
    """Tokens and long terms that share a segment, or one of their rarest grams, at places ``limit`` edits can explain."""
    longer = vocabulary.filter(F.length("term") > LONGEST_FOR_VARIANTS)
    long_tokens = tokens.filter(F.length("token") + limit > LONGEST_FOR_VARIANTS)
    keys = ["size", "part", "segment"]
    segments = _with_segments(longer.select("term", F.length("term").alias("size"), F.lit(0).alias("moved")), "term", limit)
    often = segments.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > MOST_OF_SEGMENT)
    crowded = segments.join(often, keys).select("term").distinct()
    right = segments.join(crowded, "term", "left_anti")
    moves = F.array(*(F.struct(F.lit(size).alias("more"), F.lit(at).alias("moved")) for size, at in _moves(limit)))
    left = long_tokens.select("token", F.inline(moves)).withColumn("size", F.length("token") + F.col("more"))
    left = _with_segments(left.filter(F.col("size") > LONGEST_FOR_VARIANTS), "token", limit)
    by_segment = left.join(right, keys).select("token", "term")
    return by_segment.unionByName(_by_rarest_grams(long_tokens, crowded, limit))


def _by_rarest_grams(tokens: DataFrame, terms: DataFrame, limit: int) -> DataFrame:
    grams = _with_grams(terms, "term")
    counts = grams.groupBy(_bucket().alias("bucket")).agg(F.count("*").alias("n"))
    right = _rarest_grams(grams, "term", counts, limit)
    left = _rarest_grams(_with_grams(tokens, "token"), "token", counts, limit)
    moved = F.array(*(F.struct((F.col("size") + size).alias("size"), (F.col("at") + at).alias("at")) for size, at in _moves(limit)))
    # A few lengths at most; often there are no such terms.
    sizes = F.broadcast(terms.select(F.length("term").alias("size")).distinct())
    left = left.select("token", "gram", F.inline(moved)).join(sizes, "size")
    return left.join(right, ["gram", "size", "at"]).select("token", "term")


def similar_terms(tokens: DataFrame, vocabulary: DataFrame, limit: int) -> DataFrame:
    """``(token, term, distance, weight)`` for distinct ``tokens(token)`` and ``vocabulary(term)``.

    The weight is 1 - distance / length of the shorter string; pairs of weight 0 are left out.
    """
    if limit == 0:
        same = tokens.join(vocabulary, tokens["token"] == vocabulary["term"])
        return same.select("token", "term", F.lit(0).alias("distance"), F.lit(1.0).alias("weight"))
    candidates = _short_candidates(tokens, vocabulary, limit).unionByName(long_candidates(tokens, vocabulary, limit)).distinct()
    checked = candidates.withColumn("distance", damerau_within(F.col("token"), F.col("term"), limit))
    weight = 1 - F.col("distance") / F.least(F.length("token"), F.length("term"))
    return checked.filter(F.col("distance").isNotNull()).withColumn("weight", weight).filter(F.col("weight") > 0)
