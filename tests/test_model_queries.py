"""The registered model queries train what the library trains by default."""

import pytest

from nomina.operators import models
from nomina.plans import inputs, queries
from nomina.session import spread_rows

SCHEMA = "pair_id long, name_1 string, name_2 string, is_duplicate int"


@pytest.fixture
def table(spark):
    rows = [(i, f"Name {i % 5}", f"name {(i + j) % 5}", int(j == 0)) for i in range(20) for j in (0, 2)]
    return spark.createDataFrame([(k, *r[1:]) for k, r in enumerate(rows)], SCHEMA)


def test_registered_queries_train_whole_models(spark, table, monkeypatch):
    given = {}

    def watch(name):
        def fit(*args, **kwargs):
            given[name] = kwargs
            raise StopIteration

        monkeypatch.setattr(models, name, fit)

    watch("boosted_trees")
    watch("perceptron")
    monkeypatch.setattr(inputs, "name_pairs", lambda spark, sf_dir: table)
    for query in (queries.gbt_pairs, queries.mlp_pairs):
        with pytest.raises(StopIteration):
            query(spark, "")
    assert given["boosted_trees"] == {"validation": "is_validation"}
    assert set(given["perceptron"]) == {"inputs"}


def test_many_short_rows_are_dealt_to_many_tasks(spark, table, monkeypatch):
    """Rows to learn from are small files: by their bytes one task would get them all."""
    parts = []

    def fit(rows, *args, **kwargs):
        parts.append(rows.rdd.getNumPartitions())
        assert rows.count() > 0
        raise StopIteration

    for owner, name in ((models, "boosted_trees"), (models, "perceptron"), (queries.network, "train_network")):
        monkeypatch.setattr(owner, name, fit)
    monkeypatch.setattr(inputs, "name_pairs", lambda spark, sf_dir: table.coalesce(1))
    monkeypatch.setattr(queries, "MODEL_ROWS", 5)
    for query in (queries.gbt_pairs, queries.mlp_pairs, queries.network_epochs):
        with pytest.raises(StopIteration):
            query(spark, "")
    assert min(parts) > 1, parts


def test_few_rows_stay_in_their_parts(spark, table):
    assert spread_rows(table.coalesce(1), "few", 40).rdd.getNumPartitions() == 1
    spread = spread_rows(table.coalesce(1), "many", 10)
    assert spread.rdd.getNumPartitions() == 4
    assert sorted(spread.collect()) == sorted(table.collect())
