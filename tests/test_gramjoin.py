import random

import pytest

from nomina.operators import gramjoin
from nomina.operators.gramjoin import nearest_names, similar_names


def grams(name, gram):
    padded = " " * (gram - 1) + name + " " * (gram - 1)
    return {padded[i : i + gram] for i in range(len(padded) - gram + 1)}


def names(rng, n):
    """Short names, copies with typos, and long ones on both sides of where the keys change."""
    out = ["".join(rng.choices("abcdeé ж", k=rng.randint(1, 12))) for _ in range(n)]
    letters = "abcdefghijklmnopqrstuvwxyz"
    long = ["".join(rng.choices(letters, k=k)) for k in (50, 62, 64, 70, 118, 124, 140, 300)]
    for name in [*out[: n // 2], *long * 4]:
        edited = list(name)
        for _ in range(rng.randint(1, max(2, len(edited) // 10))):
            edited[rng.randrange(len(edited))] = rng.choice(letters)
        out.append("".join(edited))
    return [" ".join(x.split()) for x in out + long]


@pytest.mark.parametrize(("percent", "gram"), [(34, 2), (50, 2), (80, 2), (50, 3)])
def test_similar_names_match_brute_force(spark, percent, gram):
    rng = random.Random(percent + gram)
    left, right = names(rng, 80), names(rng, 80)
    right += left[::3] + ["", None, "b", "b"]
    left += ["", None, "b", "  B "]
    frames = [spark.createDataFrame([(x, 1) for x in side], "name string, shared int") for side in (left, right)]
    got = similar_names(*frames, percent, gram).collect()
    want = set()
    for a in {" ".join((x or "").split()).lower() for x in left} - {""}:
        for b in {" ".join((x or "").split()).lower() for x in right} - {""}:
            x, y = grams(a, gram), grams(b, gram)
            if 100 * len(x & y) >= percent * len(x | y):
                want.add((a, b, len(x & y), len(x | y)))
    assert len(got) == len(want)
    assert {tuple(r) for r in got} == want
    assert any(len(grams(a, gram)) > 130 and a != b for a, b, _, _ in want)


def test_nearest_names_cases(spark):
    companies = spark.createDataFrame(
        [(7, "Alphabet Holdings"), (3, "alphabet  holdings"), (4, "Beta Trading"), (5, None), (6, "")], "doc_id long, name string"
    )
    queries = spark.createDataFrame([(1, "Aplhabet Hodlings"), (2, None), (3, ""), (4, "zzzz"), (5, "Aplhabet Hodlings")], "query_id long, query string")
    got = {r.query_id: (r.doc_id, r.name, r.exists) for r in nearest_names(queries, companies).collect()}
    none = (None, None, False)
    assert got == {1: (3, "alphabet holdings", True), 2: none, 3: none, 4: none, 5: (3, "alphabet holdings", True)}
    assert [r.exists for r in nearest_names(queries, companies.limit(0)).collect()] == [False] * 5
    assert nearest_names(queries.limit(0), companies).isEmpty()


def test_shares_below_a_third_are_refused(spark):
    empty = spark.createDataFrame([], "name string")
    with pytest.raises(ValueError, match="percent"):
        similar_names(empty, empty, 33)


def test_many_blocks_find_the_same_pairs(spark, monkeypatch):
    """Names in several blocks on both sides, among them those that share half of their grams and no more with all others."""
    monkeypatch.setattr(gramjoin, "MOST_TERMS", 400)
    rng = random.Random(5)
    alike = ["common part " + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=12)) for _ in range(60)]
    left, right = [" ".join(x.split()) for x in names(rng, 40) + alike], [" ".join(x.split()) for x in names(rng, 40) + alike[::2]]
    frames = [spark.createDataFrame([(x,) for x in side], "name string") for side in (left, right)]
    want = set()
    for a in set(left) - {""}:
        for b in set(right) - {""}:
            x, y = grams(a, 2), grams(b, 2)
            if 2 * len(x & y) >= len(x | y):
                want.add((a, b, len(x & y), len(x | y)))
    got = [tuple(r) for r in similar_names(*frames).collect()]
    assert len(got) == len(want) and set(got) == want
