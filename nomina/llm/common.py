"""What several operators of this subpackage share on the Spark side."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILTER_BITS = 1 << 22  # of a key filter: 65,536 words of 64 bits, so at most about 1 MB is broadcast


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: str = "text") -> Column:
    """128 bits of a text as binary(16); equal texts, and null and the empty text, have equal keys."""
    value = F.coalesce(F.col(text), F.lit(""))
    return F.unhex(F.md5(value))


def crc_mod(column: str, modulus: int) -> Column:
    """crc32 of a value as text, modulo; null for null."""
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(modulus))


def key_filter(needed: DataFrame, *keys: str) -> DataFrame:
    """A bit set of the hashed keys: at most FILTER_BITS / 64 rows, whatever the input."""
    bit = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))
    words = needed.select(bit.alias("_bit")).select(
        F.shiftright("_bit", 6).alias("_word"), F.expr("shiftleft(1L, cast(_bit & 63 as int))").alias("_mask")
    )
    return words.groupBy("_word").agg(F.bit_or("_mask").alias("_mask"))


def with_possible(rows: DataFrame, needed: DataFrame, *keys: str) -> DataFrame:
    """Add ``_possible``: false only for rows whose keys are not among those of ``needed``.

    Keeps rows that a join would throw away out of its shuffle. The broadcast side is a
    bit set of fixed size; a full one lets every row pass and the join decides.
    """
    bit = F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))
    bits = F.broadcast(key_filter(needed, *keys))
    marked = rows.withColumn("_bit", bit).withColumn("_word", F.shiftright("_bit", 6))
    hit = F.expr("coalesce((_mask & shiftleft(1L, cast(_bit & 63 as int))) != 0, false)")
    return marked.join(bits, "_word", "left").withColumn("_possible", hit).drop("_bit", "_word", "_mask")


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of one key together and in a row, for ``groups``."""
    return df.repartition(*keys).sortWithinPartitions(*keys)


def groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """The groups of consecutive equal keys in a task's rows, one table each."""
    pending: list[pa.RecordBatch] = []
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        change = np.zeros(n - 1, dtype=bool)
        for key in keys:
            column = batch.column(key)
            differs = pc.not_equal(column.slice(1), column.slice(0, n - 1))
            change |= differs.to_numpy(zero_copy_only=False).astype(bool)
        starts = np.concatenate(([0], np.flatnonzero(change) + 1, [n]))
        if pending and any(pending[-1].column(k)[-1].as_py() != batch.column(k)[0].as_py() for k in keys):
            yield pa.Table.from_batches(pending)
            pending = []
        for a, b in zip(starts[:-2], starts[1:-1], strict=True):
            yield pa.Table.from_batches([*pending, batch.slice(a, b - a)])
            pending = []
        pending.append(batch.slice(starts[-2]))
    if pending:
        yield pa.Table.from_batches(pending)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """A task's rows in tables that end where a group of consecutive equal keys ends, and each group's first row (groups + 1)."""
    rest: pa.Table | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        part = pa.Table.from_batches([batch])
        part = part if rest is None else pa.concat_tables([rest, part])
        starts = _starts(part, keys)
        rest = part.slice(int(starts[-1]))
        if len(starts) > 1:
            yield part.slice(0, int(starts[-1])), starts
    if rest is not None:
        yield rest, np.array([0, rest.num_rows])


def _starts(rows: pa.Table, keys: Sequence[str]) -> np.ndarray:
    change = np.zeros(rows.num_rows - 1, dtype=bool)
    for key in keys:
        column = rows.column(key).combine_chunks()
        change |= pc.not_equal(column.slice(1), column.slice(0, len(column) - 1)).to_numpy(zero_copy_only=False).astype(bool)
    return np.concatenate(([0], np.flatnonzero(change) + 1))


def binary_matrix(column: pa.ChunkedArray | pa.Array, dtype: str) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), dtype=dtype) for v in column]


def binaries(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, type=pa.binary())


def ragged_binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """One binary per row from flat values and row offsets, without a copy per row."""
    width = values.dtype.itemsize
    at = pa.py_buffer(np.ascontiguousarray(offsets * width, dtype=np.int64))
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, at, pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def block_pairs(rows: DataFrame, group: str, n_blocks: Column, salt: str) -> DataFrame:
    """Cut each group into blocks and send every row to all pairs of its block.

    Adds ``i``, ``j`` with i < j (both 0 in a group of one block): each two rows of a
    group meet in at least one pair, and no pair holds more than two blocks.
    """
    blocked = rows.withColumn("_n", n_blocks.cast("int")).withColumn("_b", F.pmod(F.xxhash64(salt), F.col("_n")).cast("int"))
    others = F.when(F.col("_n") < 2, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("_n") - 1), lambda x: x != F.col("_b")))
    met = blocked.withColumn("_o", F.explode(others))
    return met.withColumn("i", F.least("_b", "_o")).withColumn("j", F.greatest("_b", "_o")).drop("_n", "_b", "_o")


def forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of n nodes: (member, root) for each node that is not a root."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
    return [(x, r) for x in range(n) if (r := root(x)) != x]
