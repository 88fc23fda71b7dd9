import random

import pytest

from nomina.operators import cluster


def expected(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {x: find(x) for x in parent}


def chain(n):
    return [(f"n{i:03}", f"n{i + 1:03}") for i in range(n)]


def star(n):
    return [("m", f"{'a' if i % 2 else 'z'}{i:03}") for i in range(n)]


def scattered(seed):
    rng = random.Random(seed)
    return [(f"x{rng.randrange(60)}", f"x{rng.randrange(60)}") for _ in range(45)]


@pytest.mark.parametrize("edges", [chain(40), star(60), chain(10) + star(10), scattered(1), scattered(2), [("a", "a")]])
def test_components(spark, edges):
    got = {r.name: r.cluster_id for r in cluster.components(spark.createDataFrame(edges, "name_1 string, name_2 string")).collect()}
    assert got == expected(edges)


def test_name_clusters_keep_singletons(spark):
    rows = [("a", "b", 1), ("b", "c", 1), ("d", "e", 0), ("a", "e", 0)]
    clusters = cluster.name_clusters(spark.createDataFrame(rows, "name_1 string, name_2 string, is_duplicate int"))
    assert {r.name: r.cluster_id for r in clusters.collect()} == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "e"}
    assert cluster.uniqueness(clusters).first().asDict() == {"members": 5, "distinct_members": 5}
    assert [r.asDict() for r in cluster.large_clusters(clusters, larger_than=2).collect()] == [{"cluster_id": "a", "size": 3}]


def test_neighbours(spark):
    table = spark.createDataFrame([("a", "b"), ("c", "d"), ("a", "e")], "name_1 string, name_2 string")
    frontier = spark.createDataFrame([("a",), ("a",)], "name_1 string")
    assert sorted(r.name_2 for r in cluster.neighbours(table, frontier).collect()) == ["b", "e"]
