"""Dense groups of near-equal vectors in one label, next to brute force."""

import numpy as np

from nomina.llm import flatgraph


def _groups(sizes=(400, 300, 5)):
    r = np.random.default_rng(12)
    centres = np.linalg.qr(r.normal(size=(16, 3)))[0].T
    x = np.concatenate([c + r.normal(size=(n, 16)) * 0.03 for c, n in zip(centres, sizes, strict=False)])
    x = x[r.permutation(len(x))]
    return x / np.linalg.norm(x, axis=1)[:, None]


def test_two_dense_groups_in_one_label(spark):
    u = _groups()
    rows = [(i, [float(v) for v in x], 1) for i, x in enumerate(u)]
    embeddings = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: r for r in flatgraph.near_duplicates(embeddings).collect()}
    close = u @ u.T >= flatgraph.THRESHOLD
    np.fill_diagonal(close, False)
    assert close.sum(axis=1).min() >= 4
    for i in range(len(u)):
        reach, new = {i}, [i]
        while new:
            new = sorted({int(y) for x in new for y in np.flatnonzero(close[x])} - reach)
            reach.update(new)
        assert (found[i]["n_links"], found[i]["component_id"]) == (close[i].sum(), min(reach))


def test_spanning_edges_connect_the_graph():
    u = _groups((400, 300))
    near = flatgraph.robust_graph(u)
    edges = [(i, int(j)) for i, row in enumerate(near) for j in row if j >= 0]
    parts = lambda e: len(u) - len(flatgraph.forest(len(u), *np.array(e).T))
    assert parts(edges) > 1
    assert parts(edges + flatgraph.spanning_edges(u, near)) == 1
