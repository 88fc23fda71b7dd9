"""The best texts of each query by the terms they share: a product of two sparse tables in blocks.

A query is a list of weighted terms, a text a list of terms with what each of them adds. Both are
dealt to blocks of a bounded number of terms, and each block of queries meets each block of texts
in one group. A group adds up what its queries and texts share and keeps the best few texts of
each query, so single matches, thousands for a query of frequent syllables, never become rows.

Terms travel as 64 bits. Only numpy and pyarrow are needed by executors.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MOST_TERMS = 1 << 21  # in a block: 16 bytes each, and some copies while a group is worked on
FEWEST_TERMS = 1 << 15  # smaller blocks of queries are not worth a group
FEW = 16  # times as many texts as matches of a query: matches are sorted, not counted among all texts
SPREAD = 8  # blocks of queries at least, if there are enough

_NO_ID = np.iinfo(np.int64).min  # null ids come first


class _Entries:
    """A column of term lists and one of their numbers, flat: ``row``, ``term`` and ``value``."""

    def __init__(self, table: pa.Table, kind: str):
        terms = table.column(f"{kind}_terms").combine_chunks()
        size = pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False)
        self.row = np.repeat(np.arange(table.num_rows), size)
        self.term = terms.flatten().to_numpy(zero_copy_only=False)
        self.value = table.column(f"{kind}_values").combine_chunks().flatten().to_numpy(zero_copy_only=False)

    def take(self, order: np.ndarray) -> _Entries:
        self.row, self.term, self.value = self.row[order], self.term[order], self.value[order]
        return self


def _offsets(sorted_numbers: np.ndarray, n: int) -> np.ndarray:
    """Where the runs of the numbers 0 to n - 1 start, and the end."""
    return np.searchsorted(sorted_numbers, np.arange(n + 1))


def _places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All places of runs, one run after the other."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(size.sum())


def _sums(row: np.ndarray, gain: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows below n with a gain, ascending, and the sum of each."""
    if len(row) * FEW < n:  # a count of all rows would cost more than the rows met
        met, row = np.unique(row, return_inverse=True)
        sums = np.bincount(row, gain, len(met))
        return met[sums != 0], sums[sums != 0]
    sums = np.bincount(row, gain, n)
    met = np.flatnonzero(sums)
    return met, sums[met]


class _Wanted:
    """Weighted terms by query, as numbers into the vocabulary of a block of texts; others add nothing."""

    def __init__(self, table: pa.Table, kind: str, number: np.ndarray, n: int, vocabulary: np.ndarray):
        entries = _Entries(table, kind)
        at = np.searchsorted(vocabulary, entries.term)
        known = np.flatnonzero(vocabulary[np.minimum(at, len(vocabulary) - 1)] == entries.term) if len(vocabulary) else np.array([], dtype=np.int64)
        query = number[entries.row[known]]
        order = np.argsort(query, kind="stable")
        self.term, self.weight = at[known][order], entries.value[known][order]
        self.offsets = _offsets(query[order], n)

    def of(self, query: int) -> tuple[np.ndarray, np.ndarray]:
        run = slice(self.offsets[query], self.offsets[query + 1])
        return self.term[run], self.weight[run]


def _best_texts(most: int, digits: int, one_per_id: bool):
    """Cogrouped function: the ``most`` best texts of the block for each of the queries."""

    def run(queries: pa.Table, texts: pa.Table) -> pa.Table:
        schema = pa.schema([queries.schema.field("query_no"), ("group_no", pa.int32()), ("text_id", pa.int64()), ("engine_score", pa.float64())])
        if not queries.num_rows or not texts.num_rows:
            return schema.empty_table()
        ids, first_row, id_no = np.unique(pc.fill_null(texts.column("text_id"), _NO_ID).to_numpy(), return_index=True, return_inverse=True)
        repeated = one_per_id and len(ids) < len(id_no)

        rare = _Entries(texts, "rare")
        rare.take(np.argsort(rare.term, kind="stable"))
        rare_terms, starts = np.unique(rare.term, return_index=True)
        sizes = np.diff(np.append(starts, len(rare.term)))
        hot = _Entries(texts, "hot")
        hot_terms, hot_no = np.unique(hot.term, return_inverse=True)
        hot_offsets = _offsets(hot.row, texts.num_rows)
        hot_sizes = np.diff(hot_offsets)

        numbered = queries.column("query_no").combine_chunks().dictionary_encode(null_encoding="encode")
        number, n = numbered.indices.to_numpy(), len(numbered.dictionary)
        wanted = _Wanted(queries, "rare", number, n, rare_terms)
        wanted_hot = _Wanted(queries, "hot", number, n, hot_terms)
        weights = np.zeros(len(hot_terms))

        found = []
        for query in np.flatnonzero(np.diff(wanted.offsets)).tolist():
            term, weight = wanted.of(query)
            size = sizes[term]
            places = _places(starts[term], size)
            hit, score = _sums(rare.row[places], rare.value[places] * np.repeat(weight, size), texts.num_rows)
            extra = np.zeros(len(hit))
            term, weight = wanted_hot.of(query)
            if len(term):
                weights[term] = weight
                size = hot_sizes[hit]
                places = _places(hot_offsets[hit], size)
                extra = np.bincount(np.repeat(np.arange(len(hit)), size), weights[hot_no[places]] * hot.value[places], len(hit))
                weights[term] = 0
            hit = id_no[hit]
            if repeated:  # rows with one id are one text; what frequent terms add is that of its best row
                hit, row = np.unique(hit, return_inverse=True)
                score, of_rows = np.bincount(row, score), extra
                extra = np.zeros(len(hit))
                np.maximum.at(extra, row, of_rows)
            score = np.round(score + extra, digits)
            if len(hit) > most:
                near = np.flatnonzero(score >= np.partition(score, len(hit) - most)[len(hit) - most])
                hit, score = hit[near], score[near]
            order = np.lexsort((hit, -score))[:most]
            found.append((np.full(len(order), query), hit[order], score[order]))
        if not found:
            return schema.empty_table()
        query, hit, score = (np.concatenate(parts) for parts in zip(*found))
        columns = [
            numbered.dictionary.take(pa.array(query)),
            pa.array(np.full(len(query), queries.column("group_no")[0].as_py(), dtype=np.int32)),
            texts.column("text_id").combine_chunks().take(pa.array(first_row[hit])),
            pa.array(score),
        ]
        return pa.Table.from_arrays(columns, schema=schema)

    return run


def _most_terms(df: DataFrame) -> int:
    """Terms of the group that has most."""
    sums = df.groupBy("group_no").agg(F.sum(F.size("rare_terms") + F.size("hot_terms")).alias("n"))
    return sums.agg(F.max("n")).first()[0] or 0


def best_texts(queries: DataFrame, texts: DataFrame, most: int, digits: int, one_per_id: bool = True) -> DataFrame:
    """``(query_no, group_no, text_id, engine_score)``: best texts by the sum of weight times value over shared terms.

    ``queries(query_no, group_no, rare_terms, rare_values, hot_terms, hot_values)`` and
    ``texts(text_id, group_no, ...)`` with the same lists: 64-bit terms, positive numbers. They
    meet within a group. Only texts that share a rare term with a query are found; hot terms add
    to their scores. Up to ``most`` texts of each block of texts are returned, by score rounded to
    ``digits``, then id: the best ``most`` of all blocks are among them. Texts with one id are
    added up unless ``one_per_id`` is false.
    """
    in_queries, in_texts = _most_terms(queries), _most_terms(texts)
    blocks = max(math.ceil(in_queries / MOST_TERMS), min(SPREAD, math.ceil(in_queries / FEWEST_TERMS)), 1)
    shards = max(math.ceil(in_texts / MOST_TERMS), 1)

    def dealt(df: DataFrame, key: str, own: str, n: int, other: str, times: int) -> DataFrame:
        numbered = df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))  # equal types, or keys would not meet
        return numbered.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(times - 1))))

    keys = ["group_no", "block", "shard"]
    left = dealt(queries, "query_no", "block", blocks, "shard", shards)
    right = dealt(texts, "text_id", "shard", shards, "block", blocks)
    schema = StructType(
        [
            StructField("query_no", queries.schema["query_no"].dataType),
            StructField("group_no", IntegerType()),
            StructField("text_id", LongType()),
            StructField("engine_score", DoubleType()),
        ]
    )
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_best_texts(most, digits, one_per_id), schema)
