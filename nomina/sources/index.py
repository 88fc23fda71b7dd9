"""A search index in segments: each load adds one, small ones are merged, none is rebuilt.

A segment has tables of its own below the index folder and its own totals; what a search needs
to know about all documents is added up from those. Totals are written last, so a segment that
was not finished is not seen; a load that is indexed again replaces its segment. Merged segments
name those that they replace, whose tables stay until the index is made anew. There is one
writer at a time; searches need not wait for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from nomina.operators.ranking import first_per_group, with_position
from nomina.operators.search import (
    FIELDS,
    PAGE_SIZE,
    SearchIndex,
    add_up,
    as_rows,
    check_fields,
    distinct_texts,
    field_totals,
    term_totals,
)
from nomina.session import materialize, scratch_path

HOT_TEXTS = 1024  # a term in more texts of a field has no postings of its own
FAN_OUT = 32  # blocks in a block
MOST_SEGMENTS = 8
_ID_BITS = 40  # of a document's place in its segment; the rest is the segment's number
MOST_BROADCAST_TERMS = 100_000

_ENTRY = "struct<term:string,tf:int>"
_SCHEMAS = {
    "documents": "doc_id long, " + ", ".join(f"{f} string" for f in FIELDS),
    "texts": f"field string, text_id long, length int, rare array<{_ENTRY}>, hot array<struct<n_texts:long,term:string,tf:int>>, hot_tf map<string,int>",
    "terms": "field string, term string, df long, n_texts long, is_hot boolean, max_tf int, min_length int",
    "text_documents": "field string, text_id long, doc_id long",
    "nodes": "level int, field string, parent long, node long, term string, max_tf int, min_length int, least_id long",
    "members": "field string, node long, text_id long, length int, hot_tf map<string,int>",
}
_TOTALS = "segment int, load string, replaces array<int>, level int, size long, fields array<struct<field:string,n_docs:long,total_length:long>>"


class SegmentedIndex:
    """Segments below one folder."""

    def __init__(self, spark: SparkSession, path: str, fields: Sequence[str] = FIELDS, hot_texts: int = HOT_TEXTS):
        check_fields(fields)
        self.spark, self.path, self.fields, self.hot_texts = spark, path, tuple(fields), hot_texts

    def _totals(self) -> list[Row]:
        try:
            rows = self.spark.read.schema(_TOTALS).parquet(f"{self.path}/totals").collect()  # one row per segment ever made
        except AnalysisException:
            return []
        return rows

    def segments(self) -> list[Row]:
        """The segments that a search reads, in the order of their numbers."""
        totals = self._totals()
        gone = {s for row in totals for s in row["replaces"]}
        return sorted((row for row in totals if row["segment"] not in gone), key=lambda row: row["segment"])

    def loads(self) -> set[str]:
        """All loads that are indexed, on their own or merged."""
        return {row["load"] for row in self._totals() if row["load"]}

    def add(self, documents: DataFrame, load: str) -> None:
        """Index the documents of a load; the segment of an earlier load of that name is replaced.

        Documents without ``doc_id`` are numbered in the order of their fields, so the same
        load gets the same numbers. A load that has been merged cannot be replaced.
        """
        totals = self._totals()
        live = {row["segment"] for row in self.segments()}
        known = [row["segment"] for row in totals if row["load"] == load]
        if known and known[0] not in live:
            raise ValueError(f"load {load!r} has been merged with others")
        number = known[0] if known else 1 + max((row["segment"] for row in totals), default=0)
        if "doc_id" not in documents.columns:
            placed = with_position(documents.select(*FIELDS), list(FIELDS), name="place")
            documents = placed.select((F.lit(number << _ID_BITS) + F.col("place")).alias("doc_id"), *FIELDS)
        self._write(documents, number, load, [])

    def compact(self, most: int = MOST_SEGMENTS, keep: str | None = None) -> None:
        """Merge the smallest segments into one when there are more than ``most``, so that half of them remain.

        The segment of the load ``keep`` is left out, so that the load can still be replaced.
        """
        live = [row for row in self.segments() if keep is None or row["load"] != keep]
        if len(live) <= most:
            return
        smallest = sorted(live, key=lambda row: (row["size"], row["segment"]))[: len(live) - (most + 1) // 2 + 1]
        numbers = [row["segment"] for row in smallest]
        documents = self._read("documents", numbers).drop("segment")
        self._write(documents, 1 + max(row["segment"] for row in self._totals()), "", numbers)

    def open(self, without: str | None = None) -> SearchIndex:
        """The index as it is now, or as it is without one load."""
        live = [row for row in self.segments() if without is None or row["load"] != without]
        numbers = [row["segment"] for row in live]
        with_blocks = [row["segment"] for row in live if row["level"] >= 0]
        return SearchIndex(
            **{table: self._read(table, with_blocks if table in ("nodes", "members") else numbers) for table in _SCHEMAS},
            fields=self.fields,
            statistics=add_up([field for row in live for field in row["fields"]]),
            segments=tuple(numbers),
            levels={row["segment"]: row["level"] for row in live if row["level"] >= 0},
        )

    def _read(self, table: str, segments: list[int]) -> DataFrame:
        schema = f"{_SCHEMAS[table]}, segment int"
        if not segments:
            return self.spark.createDataFrame([], schema)
        folders = [f"{self.path}/{table}/segment={s}" for s in segments]
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{table}").parquet(*folders)

    def _store(self, df: DataFrame, table: str, number: int) -> DataFrame:
        typed = df.select(*self.spark.createDataFrame([], _SCHEMAS[table]).columns)
        typed.write.mode("overwrite").parquet(f"{self.path}/{table}/segment={number}")
        return self.spark.read.schema(_SCHEMAS[table]).parquet(f"{self.path}/{table}/segment={number}")

    def _write(self, documents: DataFrame, number: int, load: str, replaces: list[int]) -> None:
        documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), *FIELDS)
        documents = self._store(documents, "documents", number)
        texts = materialize(distinct_texts(documents, self.fields), "texts")
        counted = self._store(term_totals(texts).withColumn("is_hot", F.col("n_texts") > self.hot_texts), "terms", number)
        n_hot = counted.filter("is_hot").count()
        bags = self._store(self._bags(texts, counted, n_hot), "texts", number)
        first = first_per_group(as_rows(documents, self.fields), ["field", "text"], [F.col("doc_id")], PAGE_SIZE)
        ids = first.groupBy("field", "text").agg(F.min("doc_id").alias("text_id"), F.collect_list("doc_id").alias("ids"))
        self._store(ids.select("field", "text_id", F.explode("ids").alias("doc_id")), "text_documents", number)
        level = self._write_blocks(bags, number) if n_hot else -1
        fields = [tuple(row) for row in field_totals(texts).select("field", "n_docs", "total_length").collect()]  # one row per field
        done = self.spark.createDataFrame([(load, replaces, level, documents.count(), fields)], _TOTALS.partition(", ")[2])
        done.write.mode("overwrite").parquet(f"{self.path}/totals/segment={number}")

    def _bags(self, texts: DataFrame, counted: DataFrame, n_hot: int) -> DataFrame:
        """Texts with their terms parted: ``rare`` with postings, ``hot`` as ``(n_texts, term, tf)``, the rarest first."""
        entry = F.struct("term", "tf")
        if n_hot == 0:
            none = F.array().cast("array<struct<n_texts:bigint,term:string,tf:int>>")
            bags = texts.select("field", "text_id", "length", none.alias("hot"), F.col("counts").alias("rare"))
        else:
            hot = counted.filter("is_hot").select("field", "term", "n_texts")
            if n_hot <= MOST_BROADCAST_TERMS:  # counted just now; beyond that both sides are shuffled
                hot = F.broadcast(hot)
            occurrences = texts.select("field", "text_id", "length", F.inline("counts")).join(hot, ["field", "term"], "left")
            is_hot = F.col("n_texts").isNotNull()
            bags = occurrences.groupBy("field", "text_id").agg(
                F.first("length").alias("length"),
                F.sort_array(F.collect_list(F.when(is_hot, F.struct("n_texts", "term", "tf")))).alias("hot"),
                F.collect_list(F.when(~is_hot, entry)).alias("rare"),
            )
        # Frequencies of hot terms are a map: built in a join, it would be built once per match.
        return bags.withColumn("hot_tf", F.map_from_arrays("hot.term", "hot.tf"))

    def _write_blocks(self, bags: DataFrame, number: int) -> int:
        """Groups of texts with equal hot terms, in blocks of blocks; returns the top level."""
        members = first_per_group(
            bags.filter(F.size("hot") > 0).select("field", "hot", "text_id", "length"), ["field", "hot"], [F.col("length"), F.col("text_id")], PAGE_SIZE
        )
        groups = members.groupBy("field", "hot").agg(
            F.min("length").alias("min_length"),
            F.min("text_id").alias("least_id"),
            F.collect_list(F.struct("text_id", "length")).alias("members"),
        )
        placed = with_position(groups, ["hot"], ["field"], name="place").withColumn("node", F.col("place") - 1)
        placed = materialize(placed.drop("place"), "groups")
        hot_tf = F.map_from_arrays("hot.term", "hot.tf").alias("hot_tf")
        self._store(placed.select("field", "node", hot_tf, F.inline("members")), "members", number)
        last = placed.agg(F.max("node").alias("n")).first()["n"]
        top = 0
        while last // FAN_OUT ** (top + 1):
            top += 1
        lowest = placed.select("field", "node", "min_length", "least_id", F.inline("hot"))
        levels = None
        for level in range(top + 1):
            node = F.floor(F.col("node") / FAN_OUT**level).cast("long")
            blocks = lowest.groupBy("field", node.alias("node"), "term").agg(
                F.max("tf").alias("max_tf"), F.min("min_length").alias("min_length"), F.min("least_id").alias("least_id")
            )
            blocks = blocks.withColumns({"level": F.lit(level), "parent": F.floor(F.col("node") / FAN_OUT).cast("long")})
            levels = blocks if levels is None else levels.unionByName(blocks)
        self._store(levels, "nodes", number)
        return top


def build_index(documents: DataFrame, fields: Sequence[str] = FIELDS, hot_texts: int | None = None) -> SearchIndex:
    """An index of one segment in the scratch folder."""
    spark = documents.sparkSession
    index = SegmentedIndex(spark, scratch_path(spark, "index"), fields, HOT_TEXTS if hot_texts is None else hot_texts)
    index.add(documents, "all")
    return index.open()
