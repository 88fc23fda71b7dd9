"""Positions in a global order without one task seeing all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from nomina.session import materialize

_IN_PART = (1 << 33) - 1  # bits of a generated id that count rows inside a part


def _sortable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_sortable(f.dataType) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return _sortable(kind.elementType)
    return not isinstance(kind, MapType | VariantType)


def with_position(df: DataFrame, order_by: str | Sequence[str], partition_by: Sequence[str] = (), name: str = "position") -> DataFrame:
    """Add the 1-based position by columns of any sortable type, within the given columns.

    Rows are dealt to parts by sampled bounds of the whole row, group columns first, so that
    neither a group, nor a range of sparse ids, nor a value that a third of the rows have
    ends up in one task. The position is the place inside the part plus the rows of earlier
    parts: a running sum over one small row per part. Equal values are ordered by the other
    columns; nulls come first. The sorted rows are stored, so their places stay as they are.
    """
    groups, order = list(partition_by), [order_by] if isinstance(order_by, str) else list(order_by)
    rest = [f.name for f in df.schema.fields if f.name not in {*groups, *order} and _sortable(f.dataType)]
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")
    # Equal rows are dealt by their place in the input: which of them is first does not show.
    keyed = df.select(row, F.monotonically_increasing_id().alias("any"))
    by = [F.col(f"row.`{c}`") for c in [*groups, *order, *rest]] + [F.col("any")]
    placed = keyed.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = placed.select("row", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND(_IN_PART).alias("place"))
    placed = materialize(placed, "sorted")
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = placed.join(F.broadcast(offsets), "part").select("row", (F.col("before") + F.col("place") + 1).alias("at"))
    if not groups:
        return numbered.select("row.*", F.col("at").alias(name))
    key = F.struct(*(F.col(f"row.`{c}`").alias(f"k{i}") for i, c in enumerate(groups)))
    starts = numbered.groupBy(key.alias("group")).agg(F.min("at").alias("start"))
    joined = numbered.join(starts, key.eqNullSafe(F.col("group")))
    return joined.select("row.*", (F.col("at") - F.col("start") + 1).alias(name))


def take_slice(df: DataFrame, order_by: str | Sequence[str], start: int = 0, stop: int | None = None) -> DataFrame:
    """Rows at positions ``start`` (inclusive) to ``stop`` (exclusive) by ``order_by``."""
    ranked = with_position(df, order_by, name="_position")
    keep: Column = F.col("_position") > start
    if stop is not None:
        keep = keep & (F.col("_position") <= stop)
    return ranked.filter(keep).drop("_position")


def first_per_group(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group; Spark keeps only ``n`` per group and task before the shuffle."""
    window = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")
