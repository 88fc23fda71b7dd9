"""One query per operator, over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from nomina.llm import balltree, chaining, decontaminate, filteraudit, flatgraph, fuzzylines, hyperminhash, mixing, ngramtrie, normbuckets, packing, suffix, toxicity
from nomina.llm.common import table


def op1_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.top_k(table(spark, sf_dir, "embeddings"))


def op2_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatgraph.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.passages(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op6_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fuzzylines.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "text")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


def op9_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramtrie.score(table(spark, sf_dir, "documents"))


def op10_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normbuckets.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_ball_tree, op2_flat_graph, op3_chaining, op4_mixing, op5_packing, op6_fuzzy_lines, op7_toxicity, op8_suffix_array, op9_ngram_trie, op10_hyperminhash, op11_decontaminate, op12_filter_audit, op13_norm_buckets, pipeline)}
