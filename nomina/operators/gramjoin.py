"""Join of names with names whose character grams largely agree, whatever their words are.

The grams of a name are the distinct runs of letters in it and the blanks around it. Blocks of
names meet blocks of names, each pair of blocks in one group, and what they share is added up
there: half of the grams in common is so low a bar that the pairs which only come near it are
hundreds for each name, so none of them becomes a row. The additions grow with the product of the
names, but a frequent gram is added to all names of a block at once, a byte for each.

Grams travel as 64 bits. Only numpy and pyarrow are needed by executors for this step.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nomina.functions.similarity import with_token_set_ratio
from nomina.operators.ranking import first_per_group
from nomina.operators.termproduct import FEWEST_TERMS, MOST_TERMS, SPREAD, _offsets
from nomina.session import materialize, spread

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRAM = 2
LEAST_PERCENT = 50
SPARSE = 32  # a gram is frequent if more than one name in that many of a block holds it


def _cleaned(name: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(name, r"\s+", " ")))


def _grams(name: Column, gram: int) -> Column:
    """The distinct grams of a name. Its letters are bound once: Spark would split it again for every gram."""

    def of(letters: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.size(letters) - gram, F.lit(0)))
        return F.array_distinct(F.transform(places, lambda i: F.concat_ws("", *(F.get(letters, i + j) for j in range(gram)))))

    blanks = F.lit(" " * (gram - 1))
    return F.transform(F.array(F.split(F.concat(blanks, name, blanks), "")), of)[0]


def _similar(percent: int):
    """Cogrouped function: the pairs of two blocks of names that share enough grams."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("left_name", pa.string()), ("right_name", pa.string()), ("shared", pa.int32()), ("in_either", pa.int32())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        grams, sizes = _lists(right)
        vocabulary, number = np.unique(grams, return_inverse=True)
        rows = np.repeat(np.arange(len(sizes)), sizes)[np.argsort(number, kind="stable")]
        starts = _offsets(np.sort(number), len(vocabulary))
        held = np.diff(starts)
        # A frequent gram is a row of a byte for each name: at most SPARSE times the grams of a name on average.
        frequent = np.flatnonzero(held * SPARSE >= len(sizes))
        dense = np.zeros((len(frequent), len(sizes)), dtype=np.uint8)
        for i, term in enumerate(frequent.tolist()):
            dense[i, rows[starts[term] : starts[term + 1]]] = 1
        dense_no = np.full(len(vocabulary), -1)
        dense_no[frequent] = np.arange(len(frequent))
        asked, asked_sizes = _lists(left)
        at = np.minimum(np.searchsorted(vocabulary, asked), len(vocabulary) - 1)
        known, ends = vocabulary[at] == asked, np.cumsum(asked_sizes)
        found = []
        for name, (end, size) in enumerate(zip(ends.tolist(), asked_sizes.tolist(), strict=True)):
            part = slice(end - size, end)
            terms = at[part][known[part]]
            least = -(-size * percent // 100)  # shared with the smallest partner, all of whose grams it has
            if len(terms) < least:
                continue
            shared = np.zeros(len(sizes), dtype=np.uint8 if size < 256 else np.int32)
            for term, i in zip(terms.tolist(), dense_no[terms].tolist(), strict=True):
                if i >= 0:
                    shared += dense[i]
                else:
                    shared[rows[starts[term] : starts[term + 1]]] += 1  # a name once at most
            near = np.flatnonzero(shared >= least)
            shared = shared[near].astype(np.int64)
            in_either = size + sizes[near] - shared
            good = 100 * shared >= percent * in_either
            found.append((np.full(good.sum(), name), near[good], shared[good], in_either[good]))
        if not found:
            return schema.empty_table()
        one, other, shared, in_either = (np.concatenate(parts) for parts in zip(*found))
        columns = [left.column("name").take(pa.array(one)), right.column("name").take(pa.array(other)), pa.array(shared, pa.int32()), pa.array(in_either, pa.int32())]
        return pa.Table.from_arrays(columns, schema=schema)

    return run


def _lists(names: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The grams of all names one after the other, and how many each has."""
    grams = names.column("grams").combine_chunks()
    return grams.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(grams).to_numpy(zero_copy_only=False).astype(np.int64)


def similar_names(left: DataFrame, right: DataFrame, percent: int = LEAST_PERCENT, gram: int = GRAM) -> DataFrame:
    """``(left_name, right_name, shared, in_either)`` of all pairs that share ``percent`` of the grams in either.

    ``left(name)`` and ``right(name)`` are compared in lower case with single blanks; copies
    count once. Empty and missing names meet nothing. The share must be above a third.
    """
    if not 34 <= percent <= 100 or gram < 2:
        raise ValueError("percent must be between 34 and 100, grams at least 2 letters")
    sides = []
    for df in (left, right):
        names = df.select(_cleaned(F.col("name")).alias("name")).filter("name <> ''").distinct()
        hashed = F.transform(_grams(F.col("name"), gram), lambda g: F.xxhash64(g))
        sides.append(materialize(names.select("name", hashed.alias("grams")), "name-grams"))
    in_left, in_right = (df.agg(F.sum(F.size("grams"))).first()[0] or 0 for df in sides)
    blocks = max(math.ceil(in_left / MOST_TERMS), min(SPREAD, math.ceil(in_left / FEWEST_TERMS)), 1)
    shards = max(math.ceil(in_right / MOST_TERMS), 1)
    block, shard = (F.pmod(F.xxhash64("name"), F.lit(n)).cast("int") for n in (blocks, shards))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    one = sides[0].withColumn("block", block).withColumn("shard", every(shards))
    other = sides[1].withColumn("shard", shard).withColumn("block", every(blocks))
    group = (F.col("block") * shards + F.col("shard")).alias("group")
    # A group is much work for few bytes, so they are dealt to many tasks.
    one, other = (spread(df.select("name", "grams", group), "group").groupBy("group") for df in (one, other))
    return one.cogroup(other).applyInArrow(_similar(percent), "left_name string, right_name string, shared int, in_either int")


def nearest_names(
    queries: DataFrame, companies: DataFrame, percent: int = LEAST_PERCENT, gram: int = GRAM, matcher: str = "indel"
) -> DataFrame:
    """The company whose name is nearest to each of ``queries(query_id, query)``, also without a common word.

    ``companies(doc_id, name)``. Among the names that share enough grams the best has the
    highest token-set ratio, then the largest share of grams, then comes first by name; it is
    known by the smallest id that bears it. Returns ``(query_id, query, doc_id, name, score,
    shared, in_either, exists)``, one row per query, null ones included.
    """
    asked = queries.select("query_id", "query", _cleaned(F.col("query")).alias("_asked"))
    named = companies.select("doc_id", _cleaned(F.col("name")).alias("name"))
    pairs = similar_names(asked.select(F.col("_asked").alias("name")), named, percent, gram)
    rated = with_token_set_ratio(pairs, F.col("left_name"), F.col("right_name"), matcher=matcher)
    order = [F.desc("token_set_ratio"), F.desc(F.col("shared") / F.col("in_either")), F.col("right_name")]
    best = first_per_group(rated, ["left_name"], order, 1)
    ids = named.groupBy("name").agg(F.min("doc_id").alias("doc_id"))
    found = best.withColumnRenamed("right_name", "name").join(ids, "name").select(
        F.col("left_name").alias("_asked"), "doc_id", "name", (F.col("token_set_ratio") / 100).alias("score"), "shared", "in_either"
    )
    joined = asked.join(found, "_asked", "left").drop("_asked")
    return joined.withColumn("exists", F.col("doc_id").isNotNull())
