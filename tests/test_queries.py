"""Every registered query next to its SQL, on the smallest tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from nomina.operators import search
from nomina.plans import inputs
from nomina.sources.index import build_index
from tools.check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, db, name):
    df = queries()[name](spark, SF)
    got, columns = rows_of(df.columns, df.collect())
    if name not in oracle_sql():
        assert got
        return
    result = db.execute(oracle_sql()[name])
    want, want_columns = rows_of([d[0] for d in result.description], result.fetchall())
    assert columns == want_columns
    assert got == want


def test_entry_returns_matches(spark):
    assert not entry(spark).isEmpty()


def test_every_misspelt_title_hits_its_company(spark):
    index = build_index(inputs.company(spark, SF))
    titles = inputs.titles(spark, SF).select("page_id", F.lower("title").alias("title"))
    queries = inputs.query_names(spark, SF).join(titles.withColumnRenamed("page_id", "query_id"), "query_id")
    distinct = queries.groupBy("query", "title").agg(F.min("query_id").alias("query_no"))
    hits = search.field_hits(index, distinct.select("query_no", "query")).join(index.documents, "doc_id")
    found = hits.join(distinct, "query_no").filter(F.col("normalized_name") == F.col("title"))
    assert found.select("query_no").distinct().count() == distinct.count()


def test_names_with_two_typos_in_every_word_find_their_company(spark):
    own = {r.doc_id: r.normalized_name.strip() for r in inputs.company(spark, SF).collect()}
    rows = [r for r in queries()["nearest_name_by_grams"](spark, SF).collect() if r.query_id % 2 == 0]
    assert len(rows) == len(own)
    assert sum(r.name == own[r.query_id // 2] for r in rows) >= 0.9 * len(rows)


@pytest.mark.parametrize("parts", [None, 3])
def test_streams_read_pages_in_one_file_or_in_parts(spark, tmp_path, parts):
    rows = [(i, f"http://h.example/{i}", f"<title>Name {'abcdefg'[i]}</title><h1>Head {i}</h1>") for i in range(7)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    if parts:
        pages.repartition(parts).write.parquet(f"{tmp_path}/pages.parquet")
    else:
        pages.toPandas().to_parquet(f"{tmp_path}/pages.parquet", index=False)
    spark.createDataFrame([(1, "Supplier")], "s_suppkey long, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    values = [tuple(r) for r in queries()["stream_values"](spark, str(tmp_path)).collect()]
    assert sorted(values) == sorted((url, v) for i, url, _ in rows for v in (f"Name {'abcdefg'[i]}", f"Head {i}"))
    assert queries()["stream_insert"](spark, str(tmp_path)).count() == len(rows) + 1
