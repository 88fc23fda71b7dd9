"""The audit of filter orders next to filters applied one after the other."""

from collections import Counter
from itertools import permutations

import pytest

from nomina.llm import filteraudit
from tests.llm.test_llm import SCHEMA, WORD, documents, nothing  # noqa: F401

LABELS = "doc_id long, quality int, toxic int, part string, n long"


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, int(i % 5 == 0), "x", 1) for i in range(0, 25)] + [(3, 0, 1, "y", 2), (3, None, None, None, None), (None, 1, 1, "", 0)]
    return spark.createDataFrame(rows, LABELS)


def _failing(rows):
    for doc_id, text, source in rows:
        text = text or ""
        words = WORD.findall(text.encode())
        tests = (
            len(words) < 50,
            100 * len(set(words)) < 65 * len(words),
            100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            any(c in "#$%&*|" for c in text),
            doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows),
        )
        yield doc_id, source or "", {f for f, x in zip("ABCDE", tests, strict=True) if x}


def _expected(rows, good, toxic):
    out = []
    marked = list(_failing(rows))
    for part in {p for _, p, _ in marked}:
        removals, mine = Counter(), [(i, f) for i, p, f in marked if p == part]
        table = []
        for order in permutations("ABCDE"):
            left = mine
            for step, letter in enumerate(order, 1):
                gone = [x for x in left if letter in x[1]]
                redundant = sum(letter in f for _, f in mine) - len(gone)
                left = [x for x in left if letter not in x[1]]
                unique = sum(f == {letter} for _, f in mine)
                removals[letter] += len(gone)
                lost = [sum(i in which for i, _ in gone) for which in (good, toxic)]
                table.append((part, "".join(order), step, len(left), len(gone), redundant, unique, *lost, letter))
        out += [(*row[:-1], removals[row[-1]]) for row in table]
    return Counter(out)


def test_audit(spark, documents, nothing, labels):  # noqa: F811
    odd = [(900, "money $ and | more " * 20, "en", "s1", 1, "x", 1, 2, 3), (901, "MANY CAPITALS " * 30, "en", "s1", 1, "x", 1, 2, 3)]
    table = documents.unionByName(spark.createDataFrame(odd, SCHEMA))
    rows = [(r["doc_id"], r["text"], r["source"]) for r in table.collect()]
    told = [r for r in labels.collect() if r["doc_id"] is not None]
    good, toxic = {r["doc_id"] for r in told if r["quality"] == 1}, {r["doc_id"] for r in told if r["toxic"] == 1}
    assert any(len(f) > 1 for *_, f in _failing(rows)) and len(set().union(*(f for *_, f in _failing(rows)))) == 5
    result = filteraudit.audit(table, labels)
    assert Counter(tuple(r) for r in result.collect()) == _expected(rows, good, toxic)
    assert Counter(tuple(r) for r in filteraudit.audit(table, labels.limit(0)).collect()) == _expected(rows, set(), set())
    assert filteraudit.audit(nothing, labels).collect() == []


def test_fields_do_not_run_over():
    large = (1 << 62) - 1
    total = large * filteraudit.packed(0b10101, True, False) + large * filteraudit.packed(0, False, False)
    fields = dict(zip(filteraudit.MEASURES, filteraudit.unpacked(total), strict=True))
    assert set(fields["kept"].tolist()) <= {0, large, 2 * large}
    own, before = filteraudit.steps()
    expected = [large if 0b10101 >> int(f) & 1 and not 0b10101 & int(b) else 0 for f, b in zip(own, before, strict=True)]
    assert fields["removed"].tolist() == expected == fields["good_lost"].tolist()
    assert fields["toxic_lost"].tolist() == [0] * 600
