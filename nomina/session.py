"""Where multi-pass operators keep the tables they read again.

A pass that is read more than once is written as Parquet below the folder named
by ``spark.checkpoint.dir``: it survives lost executors, cuts lineage and is read
back with column pruning.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_scratch: str | None = None


def scratch_dir(spark: SparkSession) -> str:
    """Shared scratch folder; a temporary one only in local mode without a setting."""
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="nomina-")
    return _local_scratch


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame, by: str) -> DataFrame:
    """``df`` in as many parts as there are shuffle partitions, by a column; Spark would join the parts of a small table."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), by)


def spread_rows(df: DataFrame, label: str, rows: int) -> DataFrame:
    """``df`` in parts of about ``rows`` rows if it has fewer parts than that, else as it is.

    For short rows that each cost much work: Spark cuts and joins parts by their bytes, so a
    task would get hundreds of thousands of them while other cores have none.
    """
    stored = materialize(df, label)
    parts = -(-stored.count() // rows)
    return stored.repartition(parts) if parts > stored.rdd.getNumPartitions() else df


def materialize(df: DataFrame, label: str, spread_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the scratch folder and return the stored table.

    ``spread_by`` keeps as many parts as there are shuffle partitions, for small tables
    whose rows the next step multiplies.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if spread_by is not None:
        df = spread(df, spread_by)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
