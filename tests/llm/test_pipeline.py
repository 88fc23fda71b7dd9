"""Stages of the pipeline on small awkward tables, next to brute force."""

import random
from collections import Counter

import corpus_pipeline
from nomina.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _rows():
    r = random.Random(11)
    some = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    edited = lambda t: " ".join(["other", *t.split()[1:]])
    a, b, c, d = (some(100) for _ in range(4))
    rows = [(1, a), (None, edited(a)), (None, some(80)), (None, some(80)), (2, b), (7, edited(b)), (7, some(90))]
    rows += [(8, c), (8, edited(c)), (9, d), (9, d), (10, None), (11, ""), (None, ""), (12, some(3)), (13, some(70))]
    return [(i, t, "en", "s", len(t or "")) for i, t in rows]


def _kept(rows):
    """Documents by id and text, one of each connected group: smallest id, null last."""
    docs = list(dict.fromkeys(rows))
    sets = []
    for _, text, *_ in docs:
        w = (text or "").split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 4 else {tuple(w)} if w else set())
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                group = [group[i] if g == group[j] else g for g in group]
    return docs, group


def test_near_copies_are_removed_by_id_and_text(spark):
    rows = _rows()
    found = [tuple(r) for r in corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, SCHEMA), "").collect()]
    docs, group = _kept(rows)
    assert max(Counter(found).values()) == 1 and set(found) <= set(docs)
    for g in set(group):
        members = [d for d, own in zip(docs, group, strict=True) if own == g]
        stays = [d for d in members if d in found]
        assert len(stays) == 1
        assert stays[0][0] == min((d[0] for d in members if d[0] is not None), default=None)


def test_near_copies_of_nothing(spark):
    assert corpus_pipeline.drop_near_copies(spark, spark.createDataFrame([], SCHEMA), "").collect() == []


def test_mixing_emits_what_the_mix_takes(spark):
    r = random.Random(5)
    rows = [(None if i % 6 == 0 else i % 40, " ".join(["w"] * r.choice([0, 3, 3, 50, 90])) + r.choice(["", " x", " y"]), "en", r.choice(["a", "b", "b", "b", None]), 1) for i in range(240)]
    rows += [(1, None, "en", "a", 0), (None, None, None, None, None), *rows[:20], *rows[:5]]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = [tuple(x) for x in corpus_pipeline.mix_sources(spark, docs, "").collect()]
    size = lambda text: len((text or "").split())
    planned, total = Counter(), Counter()
    for x in mixing.mix(docs).collect():
        planned[x["target"], x["size"]] += x["taken"]
        total[x["target"]] += x["taken"]
    by_source, emitted = {}, Counter()
    for x in mixing.mix(docs.select("source", "text", docs["source"].alias("doc_id"))).collect():
        by_source[x["doc_id"]] = x["target"]
    for i, text, _, source, _ in found:
        emitted[by_source[source], size(text)] += size(text)
    assert emitted == Counter({k: n for k, n in planned.items() if n})
    held, got = Counter(rows), Counter(found)
    assert set(got) <= set(held) and all(n <= 3 * held[row] for row, n in got.items())
    for source in by_source:
        words = sum(size(t) for _, t, _, s, _ in found if s == source)
        assert abs(words - by_source[source]) <= 3


def test_mixing_nothing(spark):
    assert corpus_pipeline.mix_sources(spark, spark.createDataFrame([], SCHEMA), "").collect() == []


def test_whole_pipeline_on_small_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = corpus_pipeline.run(spark, sf)
    places = {}
    for x in rows.collect():
        places.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    assert places
