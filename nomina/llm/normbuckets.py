"""Ranked lexical search: exact inner products over buckets of impact vectors of like length (LEMP).

A document's impact vector has one coordinate per query term that it holds. Scaled by the
root of the term's weight on both sides, a score is the inner product of a document's and an
item's vector. Documents are ordered by the length of their vectors, longest first, and cut
into buckets. For an item whose tenth score so far is t

* a bucket is skipped when its longest vector times the item's falls short of t
  (Cauchy-Schwarz);
* inside a bucket, the item's coordinates are taken from the largest on until the rest of
  them, times the bucket's length, falls short of t: only documents with one of the taken
  coordinates can place. What these add up to is a lower bound, and with the lengths of both
  remainders an upper one; documents whose upper bound falls short of t go;
* the scores of all others are computed anew in 64-bit integers.

The longest vectors of the whole table go first, and the tenth scores found among them start
the search in all the rest. Every task searches its own documents, sorted where they are: no
vector is shuffled, and a task returns ten rows an item at most.

Items go to the tasks in blocks of whole texts of a bounded size, equal texts once.

Defined results: a null or empty text has no terms and neither scores nor counts as a
document. Every benchmark row with terms is an item, so repeated rows repeat their results;
documents with equal rows or ids rank each, a null doc_id behind equal scores. Empty tables
give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nomina.llm import textbytes as tb
from nomina.llm.common import ragged_binary
from nomina.llm.terms import fetched, term_hashes, text_blocks, word_numbers
from nomina.session import materialize

K = 10
BUCKET = 8192  # documents
BLOCK_BYTES = 4 << 20  # of item texts searched at once
FIRST_SHARE = 1 / 64  # of the documents, by length, whose scores start the search in the others
SLACK = 1 + 1e-9  # for what rounding may take off a bound

# Fixed values of the score.
IDF_SCALE, IMPACT_SCALE, TF_SCALE, NORM_SCALE = 1000, 1_000_000_000, 1000, 8
BASE, SLOPE = 25, 75

VECTOR = "doc_id long, n long, terms binary, tfs binary"
WEIGHED = "doc_id long, length double, terms binary, impacts binary"
FOUND = "item int, doc_id long, score long"


@dataclass(frozen=True)
class Items:
    """A block's items as sparse vectors over its own vocabulary (sorted term hashes)."""

    vocabulary: np.ndarray
    terms: list[np.ndarray]
    counts: list[np.ndarray]


def items_of(texts: pa.Array) -> Items:
    data, offsets = tb.as_bytes(texts)
    hashes, at = term_hashes(data, offsets)
    vocabulary, number = np.unique(hashes, return_inverse=True)
    each = [np.unique(number[a:b], return_counts=True) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    return Items(vocabulary, [t for t, _ in each], [c for _, c in each])


def _vectors(vocabulary: np.ndarray):
    """Length and term frequencies of each document, of query terms only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tb.chunks(batch.column("text")):
                hashes, at = term_hashes(data, offsets)
                owner = np.repeat(np.arange(b - a), np.diff(at))
                number = word_numbers(hashes, vocabulary)
                known = number > 0
                pair, tf = np.unique(owner[known] * len(vocabulary) + number[known] - 1, return_counts=True)
                rows, terms = np.divmod(pair, max(len(vocabulary), 1))
                ends = np.searchsorted(rows, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(np.diff(at)), ragged_binary(terms.astype("<i4"), ends), ragged_binary(tf.astype("<i4"), ends)],
                    names=["doc_id", "n", "terms", "tfs"],
                )

    return run


def _ints(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """32-bit values of binaries one after the other, and where each row's begin (rows + 1)."""
    data, offsets = tb.as_bytes(column)
    return np.frombuffer(data.tobytes(), dtype="<i4"), offsets // 4


def _frequencies(n_terms: int):
    """Documents per term that a task has seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            counts += np.bincount(_ints(batch.column("terms"))[0], minlength=n_terms)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(counts[seen])], names=["term", "df"])

    return run


def weights(df: np.ndarray, n_documents: int) -> np.ndarray:
    """Integer weight of each term."""
    return np.floor(IDF_SCALE * np.log((2 * n_documents + 2) / (2 * df + 1))).astype(np.int64)


def impacts(tf: np.ndarray, n: np.ndarray, n_documents: int, n_terms: int) -> np.ndarray:
    """What an occurrence count adds to a score before its weight, in documents of ``n`` terms."""
    if int(n.max(initial=0)) * SLOPE * n_documents >= 1 << 63:
        share = np.array([SLOPE * x * n_documents // n_terms for x in n.tolist()], dtype=np.int64)
    else:
        share = SLOPE * n * n_documents // max(n_terms, 1)
    return IMPACT_SCALE * tf // (TF_SCALE * tf + NORM_SCALE * (BASE + share))


def _weigh(weight: np.ndarray, n_documents: int, n_terms: int):
    """Impact vectors with their lengths; coordinates of weight 0 and vectors without any go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms, at = _ints(batch.column("terms"))
            tf, _ = _ints(batch.column("tfs"))
            owner = np.repeat(np.arange(batch.num_rows), np.diff(at))
            n = batch.column("n").to_numpy(zero_copy_only=False)
            impact = impacts(tf.astype(np.int64), n[owner], n_documents, n_terms)
            counts = (weight[terms] > 0) & (impact > 0)
            terms, impact, owner = terms[counts], impact[counts], owner[counts]
            squared = np.bincount(owner, weights=weight[terms] * impact.astype(np.float64) ** 2, minlength=batch.num_rows)
            ends = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            columns = [batch.column("doc_id"), pa.array(np.sqrt(squared)), ragged_binary(terms, ends), ragged_binary(impact.astype("<i4"), ends)]
            weighed = pa.RecordBatch.from_arrays(columns, names=["doc_id", "length", "terms", "impacts"])
            yield weighed.filter(pa.array(squared > 0))

    return run


@dataclass
class Best:
    """The best documents of one item so far, best first."""

    scores: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    no_id: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=bool))

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray, k: int) -> None:
        scores, ids, no_id = (np.concatenate(x) for x in ((self.scores, scores), (self.ids, ids), (self.no_id, no_id)))
        order = np.lexsort((ids, no_id, -scores))[:k]
        self.scores, self.ids, self.no_id = scores[order], ids[order], no_id[order]

    def least(self, k: int) -> int:
        return int(self.scores[-1]) if len(self.scores) >= k else 1


class Bucket:
    """Impact vectors by document and by coordinate."""

    def __init__(self, ids: np.ndarray, no_id: np.ndarray, length: np.ndarray, terms: np.ndarray, impact: np.ndarray, at: np.ndarray):
        self.ids, self.no_id, self.length, self.terms, self.impact, self.at = ids, no_id, length, terms, impact, at
        self.longest = float(length.max())
        self._columns: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def columns(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Coordinates in order, with their documents and impacts; made when an item first looks inside."""
        if self._columns is None:
            order = np.argsort(self.terms, kind="stable")
            owner = np.repeat(np.arange(len(self.ids)), np.diff(self.at))
            self._columns = self.terms[order], owner[order], self.impact[order]
        return self._columns

    def exact(self, rows: np.ndarray, weighted: np.ndarray) -> np.ndarray:
        """Integer scores of some documents; ``weighted`` has the item's weight of every coordinate."""
        size = self.at[rows + 1] - self.at[rows]  # at least 1
        ends = np.cumsum(size)
        inside = np.repeat(self.at[rows] - (ends - size), size) + np.arange(ends[-1])
        return np.add.reduceat(weighted[self.terms[inside]] * self.impact[inside].astype(np.int64), ends - size)


class Searcher:
    """A block's items against buckets, with the best documents so far."""

    def __init__(self, items: Items, weight: np.ndarray, least: np.ndarray, k: int):
        self.k, self.weight, self.least = k, weight, least.copy()
        self.best = [Best() for _ in items.terms]
        self.weighted = np.zeros(len(weight), dtype=np.int64)
        self.terms, self.gains, self.rest = [], [], []
        for terms, counts in zip(items.terms, items.counts, strict=True):
            size = counts * np.sqrt(weight[terms])
            order = np.argsort(-size, kind="stable")
            order = order[size[order] > 0]
            self.terms.append(terms[order])
            self.gains.append(counts[order] * weight[terms[order]])
            tail = np.cumsum((size[order] ** 2)[::-1])[::-1]
            self.rest.append(np.sqrt(np.concatenate((tail, [0.0]))))  # length of the coordinates from each on
        self.lengths = np.array([r[0] for r in self.rest])

    def look(self, bucket: Bucket) -> None:
        """Search one bucket for every item that its longest vector could serve."""
        for i in np.flatnonzero(self.lengths * bucket.longest * SLACK >= self.least).tolist():
            self._look(i, bucket)

    def _look(self, i: int, bucket: Bucket) -> None:
        least, rest = int(self.least[i]), self.rest[i]
        taken = int(np.searchsorted(-(rest * bucket.longest * SLACK), -least, "right"))  # rest falls: the first below least
        taken = min(taken, len(self.terms[i]))
        column, owner, impact = bucket.columns()
        terms, gains = self.terms[i][:taken], self.gains[i][:taken]
        low, high = np.searchsorted(column, terms, "left"), np.searchsorted(column, terms, "right")
        size = high - low
        if size.sum() == 0:
            return
        inside = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())
        rows, there = owner[inside], impact[inside].astype(np.float64)
        partial = np.bincount(rows, weights=np.repeat(gains, size) * there, minlength=len(bucket.ids))
        if taken < len(self.terms[i]):
            covered = np.bincount(rows, weights=np.repeat(self.weight[terms], size) * there**2, minlength=len(bucket.ids))
            reach = partial + rest[taken] * np.sqrt(np.maximum(bucket.length**2 * SLACK - covered, 0))
        else:
            reach = partial
        rows = np.flatnonzero(partial)
        if len(rows) > self.k:  # what is counted so far is a lower bound
            sure = np.partition(partial[rows], len(rows) - self.k)[len(rows) - self.k] / SLACK
            least = max(least, int(sure))
        rows = rows[reach[rows] * SLACK >= least]
        if len(rows) == 0:
            return
        self.weighted[self.terms[i]] = self.gains[i]
        scores = bucket.exact(rows, self.weighted)
        self.weighted[self.terms[i]] = 0
        good = scores >= least
        self.best[i].add(scores[good], bucket.ids[rows[good]], bucket.no_id[rows[good]], self.k)
        self.least[i] = max(self.least[i], self.best[i].least(self.k))


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[Bucket]:
    for batch in batches:
        for first in range(0, batch.num_rows, BUCKET):
            part = batch.slice(first, BUCKET)
            terms, at = _ints(part.column("terms"))
            impact, _ = _ints(part.column("impacts"))
            ids = part.column("doc_id")
            yield Bucket(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), part.column("length").to_numpy(), terms, impact, at)


def _search(items: Items, weight: np.ndarray, least: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(items, weight, least, k)
        for bucket in _buckets(batches):
            searcher.look(bucket)
        found = searcher.best
        numbers = np.repeat(np.arange(len(found), dtype=np.int32), [len(b.ids) for b in found])
        ids, no_id, scores = (np.concatenate([getattr(b, c) for b in found] or [np.zeros(0, dtype=t)]) for c, t in (("ids", "i8"), ("no_id", "?"), ("scores", "i8")))
        yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(ids, mask=no_id), pa.array(scores)], names=["item", "doc_id", "score"])

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order: list[Column] = [F.desc("score"), F.asc_nulls_last("doc_id")]
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def top_documents(documents: DataFrame, benchmark: DataFrame, k: int = K) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``k`` best documents."""
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    results = []
    for block in text_blocks(benchmark, BLOCK_BYTES):
        texts = fetched(block)
        items = items_of(texts)
        vectors = materialize(rows.mapInArrow(_vectors(items.vocabulary), VECTOR), "vectors")
        totals = vectors.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        found = spark.createDataFrame([], FOUND + ", rank int")
        if len(items.vocabulary) and totals["documents"]:
            found = _best_of_block(vectors, items, totals["documents"], totals["terms"], k)
        numbered = spark.createDataFrame(pa.table({"item": pa.array(np.arange(len(texts), dtype=np.int32)), "text": texts}))
        results.append(found.join(numbered, "item").drop("item"))
    result = results[0]
    for other in results[1:]:
        result = result.unionByName(other)
    return benchmark.select("item_id", "text").join(result, "text").select("item_id", "rank", "doc_id", "score")


def _best_of_block(vectors: DataFrame, items: Items, n_documents: int, n_terms: int, k: int) -> DataFrame:
    size = len(items.vocabulary)
    frequency = np.zeros(size, dtype=np.int64)
    counted = vectors.select("terms").mapInArrow(_frequencies(size), "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for row in counted.collect():  # one row per term of the block
        frequency[row["term"]] = row["df"]
    weight = np.where(frequency > 0, weights(frequency, n_documents), 0)
    weighed = vectors.mapInArrow(_weigh(weight, n_documents, n_terms), WEIGHED)
    weighed = materialize(weighed.sortWithinPartitions(F.desc("length")), "weighed")
    bound = weighed.agg(F.percentile_approx("length", 1 - FIRST_SHARE).alias("b")).first()["b"] or 0.0
    none = np.ones(len(items.terms), dtype=np.int64)
    first = materialize(_ranked(weighed.filter(F.col("length") >= bound).mapInArrow(_search(items, weight, none, k), FOUND), k), "first")
    least = none.copy()
    for row in first.filter(F.col("rank") == k).collect():  # one row per item of the block
        least[row["item"]] = row["score"]
    others = weighed.filter(F.col("length") < bound).mapInArrow(_search(items, weight, least, k), FOUND)
    return _ranked(first.drop("rank").unionByName(others), k)
