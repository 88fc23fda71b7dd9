"""Readers and writers for pairs, pages, vocabularies and index dumps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAIR_COLUMNS = "name_1 string, name_2 string, is_duplicate int"


def read_pairs(spark: SparkSession, path: str, index_col: bool = True) -> DataFrame:
    """Labelled pairs from CSV, with the leading index column as ``pair_id``; without one the file order numbers them."""
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", False).option("enforceSchema", True)
    if index_col:
        return reader.schema(f"pair_id long, {PAIR_COLUMNS}").csv(path)
    rows = reader.schema(PAIR_COLUMNS).csv(path)
    return rows.select(F.monotonically_increasing_id().alias("pair_id"), *rows.columns)


def write_pairs(pairs: DataFrame, path: str, index: bool = False, format: str = "csv") -> None:
    """Labelled pairs as CSV (or Parquet), with or without the index column."""
    out = pairs if index else pairs.drop("pair_id")
    writer = out.write.option("header", True).option("escape", '"')
    # Spark's CSV writer trims values unless told not to.
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.format(format).save(path)


def read_pages(spark: SparkSession, path: str, only_fetched: bool = True) -> DataFrame:
    """Stored raw pages; a table without a status column holds fetched pages only."""
    pages = spark.read.parquet(path)
    if "status" not in pages.columns:
        return pages.withColumn("status", F.lit(200))
    return pages.filter(F.col("status") == 200) if only_fetched else pages


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """Company records of an index dump: one JSON document per line, the record under ``_source``.

    A malformed line, or a document without a field, has nulls in their place: no line is
    left out, and ``line`` has each as it was read.
    """
    record = "company_name string, company_url string, query_string string, normalized_name string"
    lines = spark.read.text(path).select(F.col("value").alias("line")).filter(F.trim("line") != "")
    document = F.from_json("line", f"_source struct<{record.replace(' string', ':string')}>")
    return lines.select("line", document.alias("document")).select("document._source.*", "line")


def write_vocabulary(vocabulary: DataFrame, path: str) -> None:
    vocabulary.write.parquet(path)


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("ch string, id int").parquet(path)
