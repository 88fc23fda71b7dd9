import difflib
import random

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nomina.functions import similarity as S
from nomina.operators import fuzzyterms
from nomina.operators.fuzzyterms import long_candidates, similar_terms

# ratio, partial, token sort, token set by indel and by difflib, and the shared share.
KNOWN = [
    ("Pirelli Neumaticos S.A.I.C.", "Pirelli Tyre Co., Ltd.", (49, 55, 53, 54), (45, 50, 49, 54), 0.2857),
    ("Pirelli Neumaticos S.A.I.C.", "asjh ajhsf iajshf has", (21, 24, 34, 34), (17, 17, 26, 26), 0.0),
    ("big pharma", "big pharma llc", (83, 100, 83, 100), (83, 100, 83, 100), 0.8),
    ("roga i kopyta", "kopyta i roga", (54, 54, 100, 100), (46, 46, 100, 100), 1.0),
    ("yandex", "yandx", (91, 80, 91, 91), (91, 80, 91, 91), 0.0),
]


@pytest.mark.parametrize("matcher", S.MATCHERS)
def test_known_values(spark, matcher):
    pairs = spark.createDataFrame([(i, a, b) for i, (a, b, *_) in enumerate(KNOWN)], "i int, a string, b string")
    scored = S.with_ratios(pairs, F.col("a"), F.col("b"), matcher).withColumn("subs", S.subs_ratio(F.col("a"), F.col("b")))
    for row, (_, _, indel, by_difflib, subs) in zip(scored.orderBy("i").collect(), KNOWN):
        got = (row.ratio, row.partial_ratio, row.token_sort_ratio, row.token_set_ratio)
        assert got == (indel if matcher == "indel" else by_difflib)
        assert round(row.subs, 4) == subs


def test_empty_equal_and_null(spark):
    rows = [(0, "", ""), (1, "a", ""), (2, "?!", "?!"), (3, "é", "é"), (4, None, "a")]
    pairs = spark.createDataFrame(rows, "i int, a string, b string")
    got = S.with_ratios(pairs, F.col("a"), F.col("b")).orderBy("i").collect()
    assert [r.ratio for r in got] == [100, 0, 100, 100, 0]
    # Nothing is left of these texts once processed.
    assert [r.token_set_ratio for r in got] == [0, 0, 0, 0, 0]
    assert [r.wratio for r in got] == [0, 0, 0, 0, 0]
    assert pairs.select(S.subs_ratio(F.lit(""), F.lit("")).alias("s")).first().s is None


def test_processed(column):
    assert column(S.processed, ["Éclair, Ёж & Co. ", "a_b"]) == ["clair  ёж   co", "a_b"]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        previous, row = row, [0]
        for j, y in enumerate(b):
            row.append(previous[j] + 1 if x == y else max(previous[j + 1], row[j]))
    return row[-1]


def expected_ratio(a, b):
    if a == b:
        return 100
    return round(100 * (2 * lcs(a, b) / (len(a) + len(b)))) if a and b else 0


def expected_partial(a, b):
    if a == b:
        return 100
    short, long = sorted((a, b), key=len)
    if not short:
        return 0
    best = max(lcs(short, long[i : i + len(short)]) for i in range(len(long) - len(short) + 1))
    return round(100 * best / len(short))


texts = st.text(alphabet="abcЖé😀 ", max_size=20)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(texts, texts), min_size=1, max_size=8))
def test_batches_match_brute_force(pairs):
    a, b = (pa.array([p[i] for p in pairs], pa.string()) for i in (0, 1))
    assert S._ratios(a, b).tolist() == [expected_ratio(x, y) for x, y in pairs]
    assert S._partial_ratios(a, b).tolist() == [expected_partial(x, y) for x, y in pairs]
    assert S._ratios(b, a).tolist() == S._ratios(a, b).tolist()


def test_long_strings_use_several_words():
    rng = random.Random(5)
    pairs = [tuple("".join(rng.choices("abcd", k=rng.randint(50, 200))) for _ in range(2)) for _ in range(30)]
    a, b = (pa.array([p[i] for p in pairs]) for i in (0, 1))
    assert S._ratios(a, b).tolist() == [expected_ratio(x, y) for x, y in pairs]


def test_small_chunks_change_nothing(monkeypatch):
    rng = random.Random(6)
    pairs = [tuple("".join(rng.choices("abcdef", k=rng.randint(0, 80))) for _ in range(2)) for _ in range(40)]
    a, b = (pa.array([p[i] for p in pairs]) for i in (0, 1))
    ratios, partials = S._ratios(a, b).tolist(), S._partial_ratios(a, b).tolist()
    monkeypatch.setattr(S, "_TABLE_CELLS", 20)
    monkeypatch.setattr(S, "_COMPARISONS", 7)
    assert S._ratios(a, b).tolist() == ratios
    assert S._partial_ratios(a, b).tolist() == partials


def test_difflib_matcher_is_difflib():
    assert S._difflib_ratio("abcd", "bcde") == round(100 * difflib.SequenceMatcher(None, "abcd", "bcde").ratio())


def osa(a, b):
    d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            if not i or not j:
                d[i][j] = i + j
                continue
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def edited(rng, word, edits):
    letters = list(word)
    for _ in range(edits):
        i = rng.randrange(len(letters) + 1)
        kind = rng.choice("idst")
        if kind == "i":
            letters.insert(i, rng.choice("abé"))
        elif kind == "d" and len(letters) > 1:
            letters.pop(i - 1)
        elif kind == "s":
            letters[i - 1] = rng.choice("abé")
        elif kind == "t" and 0 < i < len(letters):
            letters[i - 1], letters[i] = letters[i], letters[i - 1]
    return "".join(letters)


@pytest.mark.parametrize("limit", [0, 1, 2])
def test_similar_terms_match_brute_force(spark, limit):
    rng = random.Random(limit)
    # Short words, words around the length where the keys change, and long ones.
    words = ["".join(rng.choices("abé", k=k)) for k in [*range(1, 8)] * 3 + [*range(22, 28)] * 2 + [60, 200]]
    vocabulary = sorted({edited(rng, w, rng.randint(0, 3)) or "a" for w in words * 6} | set(words))
    tokens = sorted({edited(rng, w, rng.randint(0, 3)) or "b" for w in words * 3})
    got = similar_terms(
        spark.createDataFrame([(t,) for t in tokens], "token string"),
        spark.createDataFrame([(t,) for t in vocabulary], "term string"),
        limit,
    ).collect()
    want = {
        (t, v, d, round(1 - d / min(len(t), len(v)), 9))
        for t in tokens
        for v in vocabulary
        if abs(len(t) - len(v)) <= limit and (d := osa(t, v)) <= limit and (d == 0 or d < min(len(t), len(v)))
    }
    assert {(r.token, r.term, r.distance, round(r.weight, 9)) for r in got} == want
    assert len(got) == len(want)


@pytest.mark.parametrize("limit", [1, 2])
def test_terms_with_a_common_tail_meet_through_what_differs(spark, limit):
    rng = random.Random(limit)
    hosts = sorted({"".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) + ".shops.of.the.same.company.example.com" for _ in range(10_000)})
    typed = {edited(rng, h, limit): h for h in rng.sample(hosts, 300)}
    tokens = spark.createDataFrame([(t,) for t in typed], "token string")
    terms = spark.createDataFrame([(h,) for h in hosts], "term string")
    assert long_candidates(tokens, terms, limit).count() < 100 * len(typed)  # of 10,000 each that share the tail
    found = {(r.token, r.term) for r in similar_terms(tokens, terms, limit).collect()}
    assert found >= {(t, h) for t, h in typed.items() if osa(t, h) <= limit}


def test_long_terms_empty_tables_nulls_and_repeated_grams(spark):
    none = spark.createDataFrame([], "token string")
    terms = spark.createDataFrame([("a" * 30,), ("a" * 31,), ("ab" * 15,), (None,), ("",)], "term string")
    assert similar_terms(none, terms, 2).isEmpty()
    tokens = spark.createDataFrame([("a" * 29,), ("a" * 32,), ("ab" * 14 + "ba",), (None,)], "token string")
    got = {(len(r.token), len(r.term), r.distance) for r in similar_terms(tokens, terms, 2).collect()}
    assert got == {(29, 30, 1), (29, 31, 2), (32, 30, 2), (32, 31, 1), (30, 30, 1)}
    assert similar_terms(tokens, terms.limit(0), 2).isEmpty()


@pytest.mark.parametrize("limit", [1, 2])
def test_long_terms_of_few_syllables_meet_by_segments(spark, limit):
    """Three letters at a place tell little where a few syllables make up all terms; a fifth of the term tells much."""
    r = random.Random(limit)
    words = ["".join(r.choice(("the", "ing", "ion", "ent", "rea", "oun")) for _ in range(12)) for _ in range(500)]
    typed = [w[:7] + w[8:] if i % 2 else w[:20] + "x" + w[20:] for i, w in enumerate(words[:50])]
    terms, tokens = (spark.createDataFrame([(w,) for w in sorted(set(x))], f"{c} string") for x, c in ((words, "term"), (typed, "token")))
    assert long_candidates(tokens, terms, limit).count() * 4 < fuzzyterms._by_rarest_grams(tokens, terms, limit).count()
    found = {(x.token, x.term) for x in similar_terms(tokens, terms, limit).collect()}
    assert {(t, w) for t, w in zip(typed, words)} <= found
