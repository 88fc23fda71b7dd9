import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from nomina.operators import search as R
from nomina.sources import index as I
from nomina.sources.index import SegmentedIndex, build_index
from tests.test_similarity import expected_ratio, osa

FIELDS = list(R.FIELDS)


def analyzed(text):
    return re.findall(r"[^\W]+(?:[.'][^\W]+)*", text.lower())


def token_set(a, b):
    def clean(s):
        return re.sub(r"\W", " ", "".join(c for c in s if not 128 <= ord(c) < 256)).lower().split()

    x, y = set(clean(a)), set(clean(b))
    if not x or not y:
        return 0
    common = " ".join(sorted(x & y))
    left, right = ((common + " " + " ".join(sorted(s))).strip() for s in (x - y, y - x))
    return max(expected_ratio(common, left), expected_ratio(common, right), expected_ratio(left, right))


def engine(docs, query, field, fuzziness):
    """Every document scored against the query, best ten."""
    fields = {i: analyzed(d[field]) for i, d in docs.items() if analyzed(d[field])}
    if not fields:
        return []
    mean = sum(map(len, fields.values())) / len(fields)
    df = Counter(t for terms in fields.values() for t in set(terms))
    scores = {}
    for i, terms in fields.items():
        total = 0.0
        for token in analyzed(query):
            for term, tf in Counter(terms).items():
                d = osa(token, term)
                weight = 1 - d / min(len(token), len(term))
                if d <= fuzziness and weight > 0:
                    idf = math.log(1 + (len(fields) - df[term] + 0.5) / (df[term] + 0.5))
                    total += weight * idf * 2.2 * tf / (tf + 1.2 * (0.25 + 0.75 * len(terms) / mean))
        if total > 0:
            scores[i] = round(total, 9)
    return sorted(scores, key=lambda i: (-scores[i], i))[:10], scores


def searched(docs, query, fuzziness):
    merged = {}
    for field in FIELDS:
        hits = engine(docs, query, field, fuzziness)
        if not hits:
            continue
        ranked, scores = hits
        found = {}
        for i in ranked:
            d = docs[i]
            key = min((v for v in (d[f] for f in FIELDS) if v), key=len)
            score = token_set(query, key) / 100
            if scores[i] > 0.01 and score > 0.3:
                found[key] = (score, d["company_name"], d["company_url"], d["normalized_name"])
        for key, value in found.items():
            merged.setdefault(key, value)
    return sorted(merged.items(), key=lambda kv: -kv[1][0])


def fixture_documents(seed, n=60):
    """Names over few common words and some rare ones; a third of the records are copies of one."""
    rng = random.Random(seed)
    common = ["group", "the", "of", "llc", "bank", "trade"]
    rare = ["yandex", "pirelli", "kopyta", "roga", "acme", "ёжик", "münchen", "global", "nord", "sud"]
    docs = {}
    for i in range(n):
        if i % 3 == 0:
            name, url = "the group of bank", "https://bank.example.com/"
        else:
            name = " ".join(rng.sample(common, rng.randint(1, 4)) + rng.sample(rare, rng.randint(0, 2)))
            url = rng.choice(["", f"https://{rng.choice(rare)}.example.com/{rng.randint(1, 3)}"])
        docs[i] = {
            "company_name": name.capitalize(), "company_url": url,
            "normalized_name": name, "query_string": rng.choice(["", name[::-1][:12]]),
        }
    return docs


QUERIES = ["yandx group", "the bank of", "group", "pireli llc trade", "ёжк", "zzz", "gruop llc the bank of trade", "münchen nord", "the of", ""]


@pytest.mark.parametrize(("hot_texts", "fuzziness"), [(None, 1), (0, 1), (3, 0), (6, 2)])
def test_search_matches_brute_force(spark, monkeypatch, hot_texts, fuzziness):
    monkeypatch.setattr(I, "FAN_OUT", 3)
    docs = fixture_documents(seed=fuzziness)
    frame = spark.createDataFrame([(i, *(d[f] for f in FIELDS)) for i, d in docs.items()], ["doc_id", *FIELDS])
    queries = spark.createDataFrame([(i, q) for i, q in enumerate(QUERIES + QUERIES[:2])], "query_id long, query string")
    index = build_index(frame, hot_texts=hot_texts)
    got = {}
    for r in R.search(index, queries, fuzziness).orderBy("query_id", "position").collect():
        got.setdefault(r.query_id, []).append((r.match_key, (r.score, r.company_name, r.company_url, r.normalized_name)))
    for i, query in enumerate(QUERIES + QUERIES[:2]):
        assert got.get(i, []) == searched(docs, query, fuzziness), query


def test_nearest_and_misses(spark):
    docs = [(1, "Yandex", "https://yandex.ru/", "yandex", ""), (2, "Big pharma", "", "big pharma", "")]
    frame = spark.createDataFrame(docs, "doc_id long, company_name string, company_url string, normalized_name string, query_string string")
    queries = spark.createDataFrame([(7, "yandx"), (8, "unknown thing")], "query_id long, query string")
    found = {r.query_id: r for r in R.nearest(build_index(frame), queries).collect()}
    assert (found[7].exists, found[7].match_key, found[7].score) == (True, "Yandex", 0.91)
    assert (found[8].exists, found[8].match_key) == (False, None)


def test_empty_index_finds_nothing(spark):
    frame = spark.createDataFrame([], "doc_id long, company_name string, company_url string, normalized_name string, query_string string")
    queries = spark.createDataFrame([(1, "a b")], "query_id long, query string")
    assert R.search(build_index(frame), queries).collect() == []


def test_arguments_are_checked(spark):
    frame = spark.createDataFrame([(1, "a", "b", "c", "d")], "doc_id long, company_name string, company_url string, normalized_name string, query_string string")
    with pytest.raises(ValueError):
        build_index(frame, fields=["name"])
    with pytest.raises(ValueError):
        R.search(build_index(frame), spark.createDataFrame([(1, "a")], "query_id long, query string"), "AUTO")


def test_shortest_value_ties_follow_field_order(spark):
    row = spark.createDataFrame([("Ab c", "", "ab c", "longer")], "company_name string, company_url string, normalized_name string, query_string string")
    first = row.select(R.shortest_value(R.FIELDS).alias("k")).first().k
    other = row.select(R.shortest_value(["normalized_name", "company_name"]).alias("k")).first().k
    assert (first, other) == ("Ab c", "ab c")


def test_response_round_trip(spark):
    rows = [(1, "q", 1, "K", 0.5, "N", "U", "n"), (1, "q", 2, "L", 0.4, "M", "", "m")]
    matches = spark.createDataFrame(rows, "query_id long, query string, position int, match_key string, score double, company_name string, company_url string, normalized_name string")
    back = R.rows_from_response(R.response(matches)).orderBy(F.desc("score")).collect()
    assert [(r.match_key, r.score, r.company_name, r.score_text) for r in back] == [("K", 0.5, "N", "0.50"), ("L", 0.4, "M", "0.40")]


def _frame(spark, docs):
    return spark.createDataFrame([(i, *(d[f] for f in FIELDS)) for i, d in docs.items()], "doc_id long, " + ", ".join(f"{f} string" for f in FIELDS))


def test_segments_find_what_one_index_finds(spark, tmp_path, monkeypatch):
    docs = fixture_documents(seed=9, n=40)
    queries = spark.createDataFrame(list(enumerate(QUERIES)), "query_id long, query string")
    index = SegmentedIndex(spark, str(tmp_path / "index"), hot_texts=3)
    assert R.search(index.open(), queries).collect() == []
    loads = {f"load {n}": {i: d for i, d in docs.items() if i % 4 == n} for n in range(4)}
    for name, part in loads.items():
        index.add(_frame(spark, part), name)

    def found():
        got = {}
        for r in R.search(index.open(), queries).orderBy("query_id", "position").collect():
            got.setdefault(r.query_id, []).append((r.match_key, (r.score, r.company_name, r.company_url, r.normalized_name)))
        return [got.get(i, []) for i in range(len(QUERIES))]

    want = [searched(docs, query, 1) for query in QUERIES]
    assert len(index.segments()) == 4 and found() == want
    index.add(_frame(spark, loads["load 2"]), "load 2")  # once more: replaced, not added
    assert [row["segment"] for row in index.segments()] == [1, 2, 3, 4] and index.open().documents.count() == 40
    index.compact(most=3)
    assert [row["segment"] for row in index.segments()] == [4, 5] and index.loads() == set(loads)
    assert found() == want
    with pytest.raises(ValueError, match="merged"):
        index.add(_frame(spark, loads["load 0"]), "load 0")
    left = {i: d for i, d in docs.items() if i % 4 != 3}
    names = R.search(index.open(without="load 3").only(["normalized_name"]), queries.filter("query_id = 2"), 0)
    ranked, scores = engine(left, QUERIES[2], "normalized_name", 0)
    assert {r.normalized_name for r in names.collect()} <= {left[i]["normalized_name"] for i in ranked}


def test_numbers_of_documents_do_not_depend_on_the_run(spark, tmp_path):
    rows = _frame(spark, fixture_documents(seed=3, n=30)).drop("doc_id")
    numbered = []
    for run, parts in enumerate((1, 7)):
        index = SegmentedIndex(spark, str(tmp_path / str(run)))
        index.add(rows.repartition(parts), "a")
        numbered.append(sorted(map(tuple, index.open().documents.collect())))
    assert numbered[0] == numbered[1]
    assert len({r[0] for r in numbered[0]}) == 30


def test_blocks_out_of_reach_are_not_opened(spark, monkeypatch):
    """Rows met in the lowest level grow with the queries, not with the texts."""
    def met(n):
        names = [f"bank of {i:05d}x trade" for i in range(n)] + ["bank trade"] * 3 + [f"bank trade z{i}" for i in range(12)]
        frame = spark.createDataFrame([(i, t, "", t, "") for i, t in enumerate(names)], "doc_id long, company_name string, company_url string, normalized_name string, query_string string")
        index = build_index(frame, ["normalized_name"], hot_texts=20)
        seen = []
        scored = R._scored
        monkeypatch.setattr(R, "_scored", lambda index, groups: seen.append(groups.count()) or scored(index, groups))
        queries = spark.createDataFrame([(1, "bank trade")], "query_no long, query string")
        best = [r.doc_id for r in R.field_hits(index, queries, 0).orderBy("hit_rank").collect()]
        monkeypatch.setattr(R, "_scored", scored)
        assert best == list(range(n, n + 10))
        return sum(seen)

    assert met(2000) <= met(200) + 20


@pytest.mark.parametrize("most_members", [0, 1 << 20])
def test_hot_terms_are_exact_with_the_descent_and_without(spark, monkeypatch, most_members):
    """A query with fewer than ten texts by rare terms meets all groups, whether it descends first or not."""
    monkeypatch.setattr(R, "MOST_MEMBERS", most_members)
    descents, descend = [], R._descend
    monkeypatch.setattr(R, "_descend", lambda *a: descents.append(1) or descend(*a))
    names = [f"bank of {i:05d}x trade" for i in range(400)] + ["bank trade"] * 3 + [f"bank trade z{i}" for i in range(12)]
    index = build_index(spark.createDataFrame([(i, t, "", t, "") for i, t in enumerate(names)], "doc_id long, company_name string, company_url string, normalized_name string, query_string string"), ["normalized_name"], hot_texts=20)
    queries = spark.createDataFrame([(1, "bank trade"), (2, "bank z7"), (3, "of 00012x bank")], "query_no long, query string")
    best = {}
    for r in R.field_hits(index, queries, 0).orderBy("query_no", "hit_rank").collect():
        best.setdefault(r.query_no, []).append(r.doc_id)
    assert best[1] == list(range(400, 410))
    assert best[2] == [410, *range(400, 409)]
    assert best[3] == [12, *(i for i in range(10) if i != 12)][:10]
    assert len(descents) == (most_members == 0)
