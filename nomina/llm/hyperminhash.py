"""Near-duplicate documents by HyperMinHash sketches (Yu and Weber).

A document's distinct word shingles are hashed once; the leading bits choose one of 128
buckets, and a bucket keeps the smallest of its hashes as a register of 16 bits: the
count of leading zeros and ten mantissa bits. Empty registers borrow from full ones by a
fixed random order (optimal densification), so short documents can be compared as well.
Registers are banded, band mates form clusters, and inside a cluster a pair whose
collision-corrected estimate comes near the threshold is confirmed on the full sets.

Documents with equal shingle sets are one class from the start. A band or cluster is never
paired out in rows: clusters are cut into blocks of bounded size, two blocks meet in one
group, and a group returns a spanning forest of its confirmed links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomina.llm import textbytes as tb
from nomina.llm.common import binary_matrix, block_pairs, dealt, forest, groups, ragged_binary, text_key, with_possible
from nomina.operators.cluster import components
from nomina.session import materialize

REGISTERS = 128
MANTISSA = 10
BANDS, ROWS = 25, 5  # a pair at 0.85 shares no band with probability 4e-7
TRIES = 256
BLOCK_CLASSES = 128  # classes of a block
BLOCK_SHINGLES = 1 << 19  # shingles of a block, on average
COLLISION = 0.169919487159739  # share of 2^-MANTISSA by which unrelated registers agree (Yu and Weber, section 3)

_order = np.random.default_rng(20240501).integers(0, REGISTERS, size=(TRIES, REGISTERS))

SKETCH = "doc_id long, n_shingles long, key binary, registers binary"


def registers(distinct: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(texts, REGISTERS) of uint16 from sorted distinct hashes per text; rows of empty texts are 0."""
    n = len(at) - 1
    out = np.zeros((n, REGISTERS), dtype=np.uint16)
    if len(distinct) == 0:
        return out
    owner = np.repeat(np.arange(n), np.diff(at))
    bucket = (distinct >> np.uint64(57)).astype(np.int64)
    slot = owner * REGISTERS + bucket
    first = np.concatenate(([True], slot[1:] != slot[:-1]))  # sorted, so the first of a bucket is its smallest
    rest = (distinct[first] << np.uint64(7)) | np.uint64(1)
    exponent = np.frexp((rest >> np.uint64(11)).astype(np.float64))[1]  # 53 bits: exact
    zeros = 53 - exponent
    mantissa = ((rest << np.minimum(zeros, 62).astype(np.uint64)) << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    out.reshape(-1)[slot[first]] = (zeros.astype(np.uint16) << np.uint16(MANTISSA)) | mantissa.astype(np.uint16)
    full = np.zeros(out.shape, dtype=bool)
    full.reshape(-1)[slot[first]] = True
    row, col = np.nonzero(~full & (np.diff(at) > 0)[:, None])
    for t in range(TRIES):
        if len(row) == 0:
            break
        source = _order[t][col]
        hit = full[row, source]
        out[row[hit], col[hit]] = out[row[hit], source[hit]]
        row, col = row[~hit], col[~hit]
    if len(row):
        nearest = np.argmax(full, axis=1)
        out[row, col] = out[row, nearest[row]]
    return out


def distinct_shingles(column: pa.Array, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, sorted distinct shingle hashes, row offsets) by chunks of texts."""
    for first, last, data, offsets in tb.chunks(column):
        words, at = tb.word_hashes(data, offsets)
        shingles, at = tb.shingle_hashes(words, at, k)
        owner = np.repeat(np.arange(last - first), np.diff(at))
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            shingles[a:b].sort()
        new = np.ones(len(shingles), dtype=bool)
        new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
        counts = np.bincount(owner[new], minlength=last - first)
        yield first, last, shingles[new], np.concatenate(([0], np.cumsum(counts)))


def set_keys(distinct: np.ndarray, at: np.ndarray) -> np.ndarray:
    """16 bytes that name each set; equal sets have equal names."""
    out = np.zeros((len(at) - 1, 2), dtype=np.uint64)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        for i, key in enumerate((0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)):
            out[full, i] = np.add.reduceat(tb.mix(distinct ^ np.uint64(key)), at[full])
    return out.byteswap()  # big-endian bytes, so that names sort as numbers


def _sketch(k: int, carried: tuple[str, ...] = ()):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, distinct, at in distinct_shingles(batch.column("text"), k):
                n = last - first
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, n),
                        pa.array(np.diff(at)),
                        ragged_binary(set_keys(distinct, at).reshape(-1), np.arange(n + 1) * 2),
                        ragged_binary(registers(distinct, at).reshape(-1), np.arange(n + 1) * REGISTERS),
                        *(batch.column(c).slice(first, n) for c in carried),
                    ],
                    names=["doc_id", "n_shingles", "key", "registers", *carried],
                )

    return run


def sketch(docs: DataFrame, k: int = 3) -> DataFrame:
    """``(doc_id, n_shingles, key, registers)``; ``key`` names the set, registers are 128 x uint16."""
    return docs.select("doc_id", "text").mapInArrow(_sketch(k), SKETCH)


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys = tb.mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)
    for batch in batches:
        if batch.num_rows == 0:
            continue
        values = np.stack(binary_matrix(batch.column("registers"), "<u2"))[:, : BANDS * ROWS].astype(np.uint64)
        hashed = tb.mix((values + np.uint64(1)) * keys).reshape(len(values), BANDS, ROWS).sum(axis=2, dtype=np.uint64)
        hashed = tb.mix(hashed + np.arange(BANDS, dtype=np.uint64))
        take = pa.array(np.repeat(np.arange(len(values)), BANDS))
        yield pa.RecordBatch.from_arrays([pa.array(hashed.reshape(-1).view(np.int64)), batch.column("key").take(take)], names=["band", "key"])


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard of rows of registers, less the agreement that unrelated registers have by chance."""
    share = (a == b).mean(axis=-1)
    total = (n_a + n_b).astype(np.float64)
    chance = COLLISION / (1 << MANTISSA) * 4.0 * n_a * n_b / (total * total)
    return (share - chance) / (1 - chance)


def confirmed(sketches: np.ndarray, sizes: np.ndarray, sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs whose sets have 100 * intersection >= percent * union, among those the estimate leaves."""
    n = len(sizes)
    a_all, b_all = [], []
    t = percent / 100
    for i in range(n - 1):
        smaller = np.minimum(sizes[i], sizes[i + 1 :])
        larger = np.maximum(sizes[i], sizes[i + 1 :])
        # five standard deviations; a borrowed register adds no information, so few shingles widen it
        margin = 5 * np.sqrt(t * (1 - t) / np.minimum(smaller, REGISTERS))
        near = estimate(sketches[i], sketches[i + 1 :], sizes[i], sizes[i + 1 :]) >= t - margin
        b = np.flatnonzero(near & (100 * smaller >= percent * larger)) + i + 1
        a_all.append(np.full(len(b), i))
        b_all.append(b)
    a, b = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (a_all, b_all))
    if len(a) == 0:
        return a, b
    if len(a) <= 2 * n:
        common = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a, b, strict=True)])
    else:
        common = _common(sets)[a, b]
    good = 100 * common >= percent * (sizes[a] + sizes[b] - common)
    return a[good], b[good]


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, from the incidence of shingles that more than one set holds."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    names = np.concatenate(([0], np.cumsum(np.diff(column) > 0))) if len(column) else column
    out = np.zeros((n, n), dtype=np.float32)
    width = 4096
    for at in range(0, int(names[-1]) + 1 if len(names) else 0, width):
        lo, hi = np.searchsorted(names, (at, at + width))
        part = np.zeros((n, width), dtype=np.float32)
        part[owner[lo:hi], names[lo:hi] - at] = 1
        out += part @ part.T
    return out.astype(np.int64)


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[bytes, bytes]] = []
        for group in groups(batches, ("cluster", "i", "j")):
            if group.num_rows < 2:
                continue
            names = group.column("key").to_pylist()
            sizes = group.column("n_shingles").to_numpy().astype(np.int64)
            sketches = np.stack(binary_matrix(group.column("registers"), "<u2"))
            sets = binary_matrix(group.column("shingles"), "<u8")
            a, b = confirmed(sketches, sizes, sets, percent)
            found += [(names[x], names[y]) for x, y in forest(len(names), a, b)]
            if len(found) >= 4096:
                yield _edges(found)
                found = []
        yield _edges(found)

    return run


def _edges(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    columns = [pa.array([x[i] for x in found], type=pa.binary()) for i in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, names=["name_1", "name_2"])


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, distinct, at in distinct_shingles(batch.column("text"), k):
                n = last - first
                yield pa.RecordBatch.from_arrays(
                    [
                        ragged_binary(set_keys(distinct, at).reshape(-1), np.arange(n + 1) * 2),
                        batch.column("key").slice(first, n),
                        ragged_binary(distinct, at),
                    ],
                    names=["found", "key", "shingles"],
                )

    return run


def links(docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """Confirmed links ``(name_1, name_2)`` between classes, enough to connect what is connected."""
    bands = classes.select("key", "registers").mapInArrow(_bands, "band long, key binary")
    hubs = bands.groupBy("band").agg(F.min("key").alias("hub"), F.count("*").alias("_n")).filter("_n > 1")
    mates = bands.join(hubs, "band").filter("key != hub").select(F.col("key").alias("name_1"), F.col("hub").alias("name_2"))
    clusters = components(materialize(mates.distinct(), "band-mates")).select(F.col("name").alias("key"), F.col("cluster_id").alias("cluster"))
    members = materialize(clusters.join(classes, "key"), "cluster-members")
    sizes = members.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_CLASSES), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).alias("_blocks")
    )
    # Each class stands for its first document; a text with another set under the same id is dropped below.
    wanted = members.select(F.col("rep").alias("_rep"), "key")
    texts = with_possible(docs.select(F.col("doc_id").alias("_rep"), "text"), wanted, "_rep").filter("_possible").drop("_possible")
    pairs = texts.join(wanted.withColumnRenamed("_rep", "_r"), F.col("_rep").eqNullSafe(F.col("_r"))).select("key", "text")
    sets = pairs.mapInArrow(_sets(k), "found binary, key binary, shingles binary").filter("found = key")
    sets = sets.dropDuplicates(["key"]).drop("found")
    placed = block_pairs(members.join(sets, "key").join(sizes, "cluster"), "cluster", F.col("_blocks"), "key")
    placed = placed.select("cluster", "i", "j", "key", "n_shingles", "registers", "shingles")
    return dealt(placed, "cluster", "i", "j").mapInArrow(_verify(percent), "name_1 binary, name_2 binary")


def _clusters(source: DataFrame, full: DataFrame, k: int, percent: int) -> DataFrame:
    """``(key, rep, cluster)``: the component of each class of equal shingle sets."""
    classes = materialize(
        full.groupBy("key").agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers")
        ),
        "classes",
    )
    found = materialize(links(source, classes, k, percent), "confirmed-links")
    members = components(found).select(F.col("name").alias("key"), F.col("cluster_id").alias("cluster"))
    return classes.select("key", "rep").join(members, "key", "left").withColumn("cluster", F.coalesce("cluster", "key"))


def near_duplicates(docs: DataFrame, k: int = 3, percent: int = 85) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs(doc_id, text)``.

    Two documents are linked when 100 * intersection >= ``percent`` * union of their
    distinct k-word shingles; fewer words make one shingle of all of them. A text without
    words, or null, is linked with nothing, not even with another such text. The
    component's id is its smallest doc_id; ``kept`` marks the document that stays. Repeated
    rows are linked with each other and share their id; null ids are never the smallest,
    and a component with null ids only has a null id and keeps its rows. Other columns
    are not looked at. An empty table gives an empty result.
    """
    source = docs.select("doc_id", "text")
    sketches = materialize(sketch(source, k), "hyperminhash")
    full = sketches.filter("n_shingles > 0")
    placed = _clusters(source, full, k, percent)
    lowest = placed.groupBy("cluster").agg(F.min("rep").alias("component_id"))
    named = placed.join(lowest, "cluster").select("key", "component_id")
    linked = full.select("doc_id", "n_shingles", "key").join(named, "key").select("doc_id", "n_shingles", "component_id")
    alone = sketches.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def repeats(docs: DataFrame, k: int = 3, percent: int = 85) -> DataFrame:
    """``(doc_id, text_key)`` of the documents that are linked as in ``near_duplicates`` with one that stays.

    Id and text name a document, so texts that share an id, or have none, are told apart.
    The smallest id of a component stays, null last, and the smallest key where it repeats.
    """
    source = docs.select("doc_id", "text", text_key().alias("text_key"))
    sketches = source.mapInArrow(_sketch(k, ("text_key",)), f"{SKETCH}, text_key binary")
    full = materialize(sketches.filter("n_shingles > 0"), "hyperminhash")
    here = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    firsts = full.groupBy("key").agg(F.min(here).alias("first"))
    placed = materialize(_clusters(source.drop("text_key"), full, k, percent).join(firsts, "key").select("key", "cluster", "first"), "placed")
    stays = placed.groupBy("cluster").agg(F.min("first").alias("stays"))
    named = placed.join(stays, "cluster").select("key", "stays")
    return full.join(named, "key").filter(~here.eqNullSafe(F.col("stays"))).select("doc_id", "text_key").distinct()
