"""Documents to packed training sequences; each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nomina.llm import fuzzylines, hyperminhash, mixing, packing, toxicity
from nomina.llm.common import table, text_key, with_possible
from nomina.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.scored(docs.select(*COLUMNS), model)
    return scored.filter(F.col("score") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier line repeats, exactly or nearly."""
    cleaned = fuzzylines.dedup_lines(docs.select(*COLUMNS))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words a shingle, Jaccard 0.8 or more.

    Rows that repeat id and text are one document; one of them stays. A document is removed
    by its id and text, so other texts under its id, or without an id, are not touched.
    """
    gone = hyperminhash.repeats(docs, k=5, percent=80).toDF("_id", "_key")
    keyed = docs.select(*COLUMNS, F.col("doc_id").alias("_id"), text_key().alias("_key"))
    repeated = keyed.groupBy("_id", "_key").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    marked = with_possible(keyed, gone.unionByName(repeated), "_id", "_key")
    touched = marked.filter("_possible").select(*COLUMNS, "_key")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_gone"))
    touched = touched.join(gone.withColumnRenamed("_key", "_gone"), same, "left_anti").dropDuplicates(["doc_id", "text"])
    return marked.filter("not _possible").select(*COLUMNS).unionByName(touched.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, null ids and texts included; a document without words is not taken.

    The mix sees each row under a key of all its columns, so rows that share an id keep their
    own numbers. Rows that agree in everything stand for each other: one of them is given as
    often as all of them are taken.
    """
    key = F.struct("doc_id", "lang", "source", "n_chars", F.col("text").isNull().alias("no_text"), text_key().alias("text_key"))
    docs = docs.select(*COLUMNS)
    mixed = mixing.mix(docs.select(key.alias("doc_id"), "text", "source")).filter("taken > 0")
    times = mixed.groupBy(F.col("doc_id").alias("_taken")).agg(F.sum(F.col("taken") / F.col("size")).cast("int").alias("_times"))
    keyed = docs.withColumn("_key", key).join(times, F.col("_key").eqNullSafe(F.col("_taken")))
    repeated = docs.select(key.alias("_taken")).groupBy("_taken").agg(F.count("*").alias("n")).filter("n > 1").select("_taken")
    again = F.col("_taken").eqNullSafe(F.col("_again"))
    repeated = repeated.withColumnRenamed("_taken", "_again")
    once = keyed.join(repeated, again, "left_anti")
    several = keyed.join(repeated, again, "left_semi").dropDuplicates(["_key"])
    return once.unionByName(several).withColumn("_copy", F.explode(F.sequence(F.lit(1), "_times"))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in sequences of 1,024 tokens."""
    return packing.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("minhash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # trained models, sketches and packing are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each one's rows are written to the scratch folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
