"""Near-duplicate embeddings on a robust-pruned flat graph.

Vectors of one label that are equal are one class. Labels are cut into overlapping cluster
shards of bounded size (centres from bounded samples, each vector in its two nearest
clusters). A shard builds a graph whose neighbour lists are pruned robustly (Vamana,
Subramanya et al.) and whose parts are joined by spanning edges; the lists a vector gets in
its shards are united. Each shard is then searched for every member, from the member itself
and from the medoid: a greedy walk first, then all neighbours of every vector inside the
range until none is new. Whatever the walk has not met is compared at the end, so no link
inside a shard (of bounded size) depends on how the graph hangs together. Links are
confirmed in doubles.

A shard that no cut makes smaller (a dense group) is cut into blocks, and each two blocks
are one shard, so no pair of such a group is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nomina.llm.common import block_pairs, dealt, forest, groups
from nomina.llm.vectors import finite, matrix
from nomina.operators.cluster import components
from nomina.session import materialize

THRESHOLD = 0.93
SHARD = 1024  # most vectors of a shard that is not cut further
WAYS = 16  # most clusters of one cut
ROUNDS = 4
SAMPLE = 1024  # vectors by which a cluster is cut
DEGREE, POOL, ALPHA = 32, 96, 1.2
BEAM, STEP = 24, 4
OVERLAP = 0.2  # a second cluster is joined unless its centre is less similar by more than this


def _centres(rows: pd.DataFrame) -> pd.DataFrame:
    """Spherical k-means on a cluster's sample."""
    x = np.stack(rows["u"].to_numpy())
    k = int(min(WAYS, max(2, -(-int(rows["_n"].iloc[0]) // (SHARD // 2))), len(x)))
    centre = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(8):
        nearest = np.argmax(x @ centre.T, axis=1)
        for i in range(k):
            if (nearest == i).any():
                mean = x[nearest == i].mean(axis=0)
                centre[i] = mean / max(np.linalg.norm(mean), 1e-12)
    return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "centres": [centre.reshape(-1).tolist()], "k": [k]})


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each vector to its nearest cluster, and to the second nearest where that is about as near."""
    for batch in batches:
        rows, child = [], []
        shards = batch.column("shard").to_pylist()
        for i in range(batch.num_rows):
            u = batch.column("u")[i].values.to_numpy()
            centres = batch.column("centres")[i].values.to_numpy().reshape(batch.column("k")[i].as_py(), -1)
            near = centres @ u
            order = np.argsort(-near, kind="stable")[:2]
            for c in order[near[order] >= near[order[0]] - OVERLAP]:
                rows.append(i)
                child.append(f"{shards[i]}.{c}")
        kept = batch.select(["id", "copies", "u"]).take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(child, pa.string()), *kept.columns], names=["shard", "id", "copies", "u"])


def shards(classes: DataFrame) -> DataFrame:
    """``(shard, id, copies, u)`` from ``classes(label, id, copies, u)``."""
    rows = classes.select(F.concat(F.col("label").cast("string"), F.lit("/"), F.size("u").cast("string")).alias("shard"), "id", "copies", "u")
    done = None
    for _ in range(ROUNDS):
        rows = materialize(rows, "cluster-shards")
        sizes = rows.groupBy("shard").agg(F.count("*").alias("_n"))
        large = materialize(sizes.filter(F.col("_n") > SHARD), "large-shards")
        small = rows.join(large, "shard", "left_anti")
        done = small if done is None else done.unionByName(small)
        rows = rows.join(large, "shard")
        if large.isEmpty():
            break
        drawn = Window.partitionBy("shard").orderBy(F.xxhash64("id"))
        sample = rows.withColumn("_r", F.row_number().over(drawn)).filter(F.col("_r") <= SAMPLE).drop("_r")
        centres = sample.groupBy("shard").applyInPandas(_centres, "shard string, centres array<double>, k int")
        rows = rows.join(materialize(centres, "centres"), "shard").mapInArrow(_deal, "shard string, id long, copies long, u array<double>")
    else:
        rows = materialize(rows, "dense-shards")
        sizes = rows.groupBy("shard").agg(F.ceil(F.count("*") / (SHARD // 2)).alias("_blocks"))
        paired = block_pairs(rows.join(sizes, "shard"), "shard", F.col("_blocks"), "id")
        rows = paired.select(F.concat_ws(":", "shard", "i", "j").alias("shard"), "id", "copies", "u")
        done = done.unionByName(rows)
    return materialize(done, "shards")


def robust_graph(u: np.ndarray) -> np.ndarray:
    """(n, DEGREE) neighbours, -1 where there are fewer: a near one hides those much nearer to it than to the vector."""
    n = len(u)
    pool = min(POOL, n - 1)
    out = np.full((n, DEGREE), -1, dtype=np.int64)
    if pool <= 0:
        return out
    similar = u @ u.T
    np.fill_diagonal(similar, -3)
    near = np.argpartition(-similar, pool - 1, axis=1)[:, :pool]
    near = np.take_along_axis(near, np.argsort(-np.take_along_axis(similar, near, axis=1), axis=1, kind="stable"), axis=1)
    away = 1 - np.take_along_axis(similar, near, axis=1)
    alive = np.ones((n, pool), dtype=bool)
    rows = np.arange(n)
    for d in range(DEGREE):
        any_left = alive.any(axis=1)
        if not any_left.any():
            break
        first = np.argmax(alive, axis=1)
        pick = near[rows, first]
        out[any_left, d] = pick[any_left]
        alive &= ALPHA * (1 - similar[pick[:, None], near]) > away
        alive[rows, first] = False
    return out


def spanning_edges(u: np.ndarray, near: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect the graph's parts: from each part's first vector to the most similar one of the parts before it."""
    part = np.arange(len(u))
    x, y = np.nonzero(near >= 0)
    for member, root in forest(len(u), x, near[x, y]):
        part[member] = root
    heads = np.unique(part)
    out = []
    for head in heads[1:].tolist():
        before = np.flatnonzero(part < head)
        out.append((head, int(before[np.argmax(u[before] @ u[head])])))
    return out


def range_search(u: np.ndarray, adjacent: list[np.ndarray], queries: np.ndarray, threshold: float) -> np.ndarray:
    """All pairs (query, row) with similarity >= threshold: a walk from the query and the medoid, then the rows it has not met."""
    n = len(u)
    degree = max(1, max((len(a) for a in adjacent), default=1))
    table = np.full((n, degree), -1, dtype=np.int64)
    for i, a in enumerate(adjacent):
        table[i, : len(a)] = a
    mean = u.mean(axis=0)
    medoid = int(np.argmax(u @ mean))
    beam = min(BEAM, n)
    pairs = []
    for a in range(0, len(queries), 128):
        q = u[queries[a : a + 128]]
        b = len(q)
        score = np.full((b, n), -2.0)
        score[:, medoid] = q @ u[medoid]
        score[np.arange(b), queries[a : a + 128]] = np.einsum("ij,ij->i", q, q)
        expanded = np.zeros((b, n), dtype=bool)
        active = np.arange(b)
        while len(active):
            own = score[active]
            least = np.partition(own, n - beam, axis=1)[:, n - beam]
            open_ = ~expanded[active] & (own > -2)
            walk = open_ & (own >= least[:, None])
            # the best open ones of the beam, and whatever lies in the range
            best = np.where(walk, own, -2.0)
            cut = np.partition(best, n - min(STEP, n), axis=1)[:, n - min(STEP, n)]
            chosen = (walk & (best >= cut[:, None])) | (open_ & (own >= threshold))
            r, c = np.nonzero(chosen)
            if len(r) == 0:
                break
            r = active[r]
            expanded[r, c] = True
            to = table[c]
            rr = np.repeat(r, degree)
            to = to.reshape(-1)
            new = (to >= 0) & (score[rr, np.maximum(to, 0)] <= -2)
            rr, to = rr[new], to[new]
            for s in range(0, len(rr), 1 << 16):
                x, y = rr[s : s + (1 << 16)], to[s : s + (1 << 16)]
                score[x, y] = np.einsum("ij,ij->i", q[x], u[y])
            active = np.unique(r)
        score = np.where(score > -2, score, q @ u.T)
        x, y = np.nonzero(score >= threshold)
        keep = queries[a + x] != y
        pairs.append(np.c_[queries[a + x[keep]], y[keep]])
    return np.concatenate(pairs) if pairs else np.zeros((0, 2), dtype=np.int64)


def _graph(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in groups(batches, ("shard",)):
        ids = group.column("id").to_numpy()
        u = matrix(group.column("u"))
        near = robust_graph(u)
        lists = [ids[row[row >= 0]] for row in near]
        for x, y in spanning_edges(u, near):
            lists[x] = np.append(lists[x], ids[y])
        yield pa.RecordBatch.from_arrays([group.column("id").combine_chunks(), pa.array(lists, pa.list_(pa.int64()))], names=["id", "near"])


def _search(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ("shard",)):
            ids, copies = group.column("id").to_numpy(), group.column("copies").to_numpy()
            u = matrix(group.column("u"))
            order = np.argsort(ids)
            adjacent = []
            for value in group.column("near"):
                near = value.values.to_numpy() if value.is_valid else np.zeros(0, dtype=np.int64)
                at = np.minimum(np.searchsorted(ids[order], near), len(ids) - 1)
                adjacent.append(np.unique(order[at[ids[order][at] == near]]))
            # edges both ways, so that a walk can leave any vector it can reach
            back: list[list[int]] = [[] for _ in ids]
            for i, near in enumerate(adjacent):
                for j in near.tolist():
                    back[j].append(i)
            adjacent = [np.union1d(near, np.array(more[: 2 * DEGREE], dtype=np.int64)) for near, more in zip(adjacent, back, strict=True)]
            found = range_search(u, adjacent, np.arange(len(ids)), threshold)
            both = np.unique(np.concatenate((found, found[:, ::-1])), axis=0)
            cuts = np.searchsorted(both[:, 0], np.arange(len(ids) + 1))
            root = ids.copy()
            for x, r in forest(len(ids), both[:, 0], both[:, 1]):
                root[x] = ids[r]
            links = pa.StructArray.from_arrays([pa.array(ids[both[:, 1]]), pa.array(copies[both[:, 1]])], names=["id", "copies"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(root), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), links)], names=["id", "root", "links"]
            )

    return run


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``embeddings(vec_id, embedding, label)``.

    Vectors of one label are linked when their cosine in doubles is at least ``threshold``.
    Vectors that are null, zero or hold null or non-finite components, and those without a
    label, are linked with nothing. Equal vectors of a label are linked with each other;
    repeated rows too. The component's id is its smallest vec_id.
    """
    rows = embeddings.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"), "label")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    good = F.col("label").isNotNull() & finite("v") & (norm > 0) & ~F.isnan(norm) & (norm < float("inf"))
    marked = rows.withColumn("_good", F.coalesce(good, F.lit(False)))
    unit = marked.filter("_good").withColumn("u", F.transform("v", lambda x: x / norm))
    unit = unit.withColumn("_h", F.xxhash64("u")).withColumn("_g", F.xxhash64("u", F.lit(1)))
    classes = unit.groupBy("label", "_h", "_g").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.first("u").alias("u"))
    # an id for each class that no other class has, also where vec_ids repeat
    classes = materialize(classes.withColumn("id", F.xxhash64("label", "_h", "_g")), "vector-classes")
    members = shards(classes)
    graph = dealt(members, "shard").mapInArrow(_graph, "id long, near array<long>")
    united = graph.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    searched = dealt(members.join(materialize(united, "adjacency"), "id"), "shard").select("shard", "id", "copies", "u", "near")
    found = materialize(searched.mapInArrow(_search(threshold), "id long, root long, links array<struct<id:long,copies:long>>"), "links")
    degree = found.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("links"))).alias("l"))
    degree = degree.select("id", F.aggregate("l", F.lit(0).cast("long"), lambda s, x: s + x["copies"]).alias("others"))
    edges = found.filter("id != root").select(F.col("id").alias("name_1"), F.col("root").alias("name_2"))
    linked = components(edges).select(F.col("name").alias("id"), F.col("cluster_id").alias("cluster"))
    named = classes.join(degree, "id").join(linked, "id", "left").withColumn("cluster", F.coalesce("cluster", "id"))
    lowest = named.groupBy("cluster").agg(F.min("first").alias("component_id"))
    named = named.join(lowest, "cluster").select("label", "_h", "_g", (F.col("others") + F.col("copies") - 1).alias("n_links"), "component_id")
    inside = unit.select("vec_id", "label", "_h", "_g").join(named, ["label", "_h", "_g"]).select("vec_id", "n_links", "component_id")
    outside = marked.filter("not _good").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return inside.unionByName(outside).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def recall(embeddings: DataFrame, result: DataFrame, queries: int = 256, threshold: float = THRESHOLD) -> float:
    """Share of brute-force links of a bounded number of vectors that ``result`` counts."""
    rows = embeddings.filter(finite("embedding") & F.col("label").isNotNull()).select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    asked = rows.orderBy(F.xxhash64("vec_id", F.lit(11))).limit(queries).select(F.col("vec_id").alias("q"), "label", F.col("v").alias("w"))
    dot = F.aggregate(F.zip_with("v", "w", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    size = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x))
    true = rows.join(F.broadcast(asked), "label").filter((F.col("q") != F.col("vec_id")) & (dot >= threshold * size("v") * size("w")))
    counts = true.groupBy("q").agg(F.count("*").alias("true"))
    sums = counts.join(result, F.col("q") == F.col("vec_id")).agg(F.sum(F.least("true", "n_links")), F.sum("true")).first()
    return float(sums[0] / sums[1]) if sums[1] else 1.0
