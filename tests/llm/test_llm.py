"""Each operator on a small awkward table, next to brute force, and on an empty one."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from nomina.llm import balltree, chaining, flatgraph, fuzzylines, hyperminhash, mixing, ngramtrie, packing, suffix, textbytes, toxicity

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, cluster int, h int, n long"


def words(text):
    return [w for w in WORD.findall((text or "").encode().translate(LOWER))]


def texts():
    r = random.Random(3)
    pool = ["".join(r.choice("abcdefgéß") for _ in range(r.randint(2, 7))) for _ in range(400)]
    some = lambda n: " ".join(r.choice(pool) for _ in range(n))
    base, passage = some(300), some(70)
    edited = base.split()
    edited[40] = "other"
    rows = [base, base, " ".join(edited), "".join(c.upper() if c.isascii() else c for c in base), None, "", "  \n ", "one", "one two", "Two  lines\ntwo lines\n\nthree"]
    rows += [some(60) + " " + passage + " " + some(50), some(30) + " " + passage + "\n" + some(80), some(5000), "a" * 900, "word " * 500]
    rows += [some(r.randint(1, 200)) + "\nRead more 12\n" + some(20) + "\nread  MORE 34!" for _ in range(15)]
    return rows


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, t, "en", None if i % 7 == 0 else f"s{i % 4}", 1, "x", 1, 2, 3) for i, t in enumerate(texts())]
    rows.append(rows[0])  # a repeated row
    rows.append((None, "no id here at all", None, "", None, None, None, None, None))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def listed(df):
    return [tuple(r) for r in df.collect()]


def test_hyperminhash(documents, nothing):
    result = listed(hyperminhash.near_duplicates(documents))
    rows = documents.select("doc_id", "text").collect()
    sets = []
    for r in rows:
        w = words(r["text"])
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                a, b = parent[i], parent[j]
                parent = [a if p == b else p for p in parent]
    expected = []
    for i, r in enumerate(rows):
        same = [rows[j]["doc_id"] for j in range(len(rows)) if parent[j] == parent[i] and rows[j]["doc_id"] is not None]
        component = min(same) if same else None
        expected.append((r["doc_id"], len(sets[i]), component, r["doc_id"] == component))
    assert Counter(result) == Counter(expected)
    assert listed(hyperminhash.near_duplicates(nothing)) == []


def test_estimate_is_near_the_truth():
    r = np.random.default_rng(5)
    universe = r.integers(0, 2**63, 4000).astype(np.uint64)
    a, b = np.sort(universe[:3000]), np.sort(universe[500:])
    two = hyperminhash.registers(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]))
    found = hyperminhash.estimate(two[0], two[1], np.int64(len(a)), np.int64(len(b)))
    assert abs(found - 2500 / 4000) < 0.15


def test_suffix(documents, nothing):
    rows = [(r["doc_id"], (r["text"] or "").encode()) for r in documents.collect()]
    count = Counter(t[i : i + 200] for _, t in rows for i in range(len(t) - 199))
    expected = []
    for i, t in rows:
        gone = bytearray(len(t))
        for s in range(len(t) - 199):
            if count[t[s : s + 200]] > 1:
                gone[s : s + 200] = b"\1" * 200
        runs = sum(1 for k in range(len(t)) if gone[k] and not (k and gone[k - 1]))
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        expected.append((i, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    assert Counter(listed(suffix.remove_repeats(documents))) == Counter(expected)
    assert listed(suffix.remove_repeats(nothing)) == []


def test_ngram_trie(documents, nothing):
    rows = [(r["doc_id"], [*words(r["text"]), None]) for r in documents.collect()]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    count = Counter(w for (_, t), h in zip(rows, held, strict=True) if not h for w in t)
    pairs = defaultdict(Counter)
    for (_, t), h in zip(rows, held, strict=True):
        for a, b in zip(["^", *t], t, strict=False):
            pairs[a][b] += not h
    total, vocabulary = sum(count.values()), len(count)
    result = sorted(listed(ngramtrie.score(documents)), key=lambda x: (x[0] is None, x[0] or 0, x[2]))
    expected = []
    for (i, t), h in zip(rows, held, strict=True):
        base = [(count[w] + 1) / (total + vocabulary + 1) for w in t]
        p = []
        for a, b, low in zip(["^", *t], t, base, strict=False):
            kinds, seen = sum(1 for c in pairs[a].values() if c), sum(pairs[a].values())
            p.append((pairs[a][b] + kinds * low) / (seen + kinds) if seen else low)
        expected.append((i, h, len(t), sum(count[w] > 0 for w in t), total, sum(map(math.log10, base)), sum(map(math.log10, p))))
    expected.sort(key=lambda x: (x[0] is None, x[0] or 0, x[2]))
    assert [r[:5] for r in result] == [e[:5] for e in expected]
    assert np.allclose([r[5] for r in result], [e[5] for e in expected], rtol=1e-9)
    for r, e in zip(result, expected, strict=True):  # probabilities are stored in steps of 1/2048 of a decade
        assert abs(r[6] - e[6]) <= e[2] / 2048
    assert listed(ngramtrie.score(nothing)) == []


def test_elias_fano():
    r = np.random.default_rng(1)
    for n, top in ((1, 5), (1000, 2**40), (5000, 6000), (300, 2**63)):
        values = np.unique(r.integers(0, top, n).astype(np.uint64))
        room = ngramtrie.Mapped()
        sequence = ngramtrie.EliasFano(values, room)
        asked = np.concatenate((values, r.integers(0, top, 500).astype(np.uint64)))
        assert (sequence.successor(asked) == np.searchsorted(values, asked)).all()
        assert (sequence.value(np.arange(len(values))) == values).all()


def test_packing_round_trip(documents, nothing):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    result = packing.packed(documents, with_ids=True).collect()
    whole, room = defaultdict(list), defaultdict(list)
    for r in result:
        whole[r["doc_id"]].append(r)
        room[r["sequence_id"]].append((r["offset"], r["length"]))
        assert zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
    for parts in room.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    for r in documents.collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2]
        parts = sorted(whole[r["doc_id"]], key=lambda p: (p["piece"], p["start"]))
        for p in parts:
            assert list(p["ids"]) == ids[p["start"] : p["start"] + p["length"]]
        assert all(p["length"] == 1024 for p in parts if p["piece"] > 0)
    assert listed(packing.packed(nothing)) == []


def test_cuts_do_not_change_tokens():
    import public_tokenizers
    import pyarrow as pa
    from nomina.llm import textbytes as tb
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    awkward = ["", " ", "  two  blanks ", "a b c", "x   y", "it's 'll 12 34!? \n\n q", "é è\u0085 ü", "日本 語 テ", "<|endoftext|> a <|endoftext|>", " lead", "trail "]
    for data, offsets in [tb.as_bytes(pa.array(awkward))]:
        ids, at = packing.token_ids(path, data, offsets, None)
    for i, text in enumerate(awkward):
        assert ids[at[i] : at[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_best_fit_respects_every_capacity(rule):
    lengths = np.random.default_rng(2).integers(1, 1025, 3000)
    sequence, offset = packing.best_fit(lengths, 1024, most_documents=3, most_attention=700_000 + 1024 * 400, rule=rule)
    for s in np.unique(sequence):
        mine = lengths[sequence == s]
        assert mine.sum() <= 1024 and len(mine) <= 3 and (mine**2).sum() <= 700_000 + 1024 * 400
    free, _ = packing.best_fit(lengths)
    assert free.max() + 1 <= math.ceil(lengths.sum() / 1024) * 1.02 + 1


def test_mixing(documents, nothing):
    result = listed(mixing.mix(documents))
    assert Counter(result) == Counter(listed(mixing.mix(documents)))
    assert len(result) == documents.count()
    size = {r["doc_id"]: len(WORD.findall((r["text"] or "").encode())) for r in documents.collect()}
    for doc_id, n, _, _, taken in result:
        assert n == size[doc_id] and taken in (0, n, 2 * n, 3 * n)
    assert abs(sum(dict((r[2], r[3]) for r in result).values()) - sum(r[1] for r in result)) < 1e-6
    assert listed(mixing.mix(nothing)) == []


def test_fit_reaches_the_best_sum():
    r = random.Random(4)
    for _ in range(30):
        sizes = np.array(sorted(r.sample(range(3, 60), 5)))
        free, budget = np.array([r.randint(0, 4) for _ in sizes]), r.randint(0, 200)
        sums = {0}
        for s, c in zip(sizes.tolist(), free.tolist(), strict=True):
            sums = {x + k * s for x in sums for k in range(c + 1)}
        taken = mixing.fit(sizes, free, budget)
        assert (taken <= free).all() and (taken * sizes).sum() == max(x for x in sums if x <= budget)


def test_fuzzy_lines(documents, nothing):
    rows = {(r["doc_id"], r["n_removed"], r["text"]) for r in fuzzylines.dedup_lines(documents).collect()}
    by = {r[0]: r for r in rows}
    assert by[4][2] is None and by[5][2] == "" and by[9][2] == "Two  lines\n\nthree"
    assert by[0][1] == 0 and by[1][2] == "" and by[3][2] == ""  # copies, also in other case
    assert by[2][2] == ""  # one word of 300 differs
    assert by[15][1] == 1 and all(by[i][1] == 2 for i in range(16, 30))  # the repeated closing lines
    assert listed(fuzzylines.dedup_lines(nothing)) == []


def test_edit_within():
    r = random.Random(9)
    for _ in range(300):
        a = bytes(r.choice(b"abc") for _ in range(r.randint(0, 14)))
        b = bytes(r.choice(b"abc") for _ in range(r.randint(0, 14)))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            new = [i + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
            row = new
        for most in range(8):
            assert fuzzylines.edit_within(a, b, most) == (row[-1] <= most), (a, b, most)


def test_chaining(documents, nothing):
    found = listed(chaining.passages(documents))
    pairs = {(r[0], r[3]) for r in found}
    assert {(1, 0), (2, 0), (3, 0), (11, 10)} <= pairs
    assert not {r[0] for r in found} & {4, 5, 6, 7, 8, 12}
    shared = next(r for r in found if (r[0], r[3]) == (11, 10))
    assert shared[2] - shared[1] >= 60 and shared[6] >= 0.9
    assert listed(chaining.passages(nothing)) == []


VECTORS = "vec_id long, embedding array<float>, label int, key string, shard int, u int"


@pytest.fixture(scope="module")
def embeddings(spark):
    r = np.random.default_rng(8)
    centres = r.normal(size=(12, 8))
    rows = [(i, [float(x) for x in centres[i % 12] + r.normal(size=8) * 0.15 * (i % 3)], i % 12 % 3 if i % 11 else None, "k", 1, 2) for i in range(240)]
    rows += [(240, None, 1, "k", 1, 2), (241, [0.0] * 8, 1, "k", 1, 2), (242, [float("nan")] + [1.0] * 7, 1, "k", 1, 2), (243, [1.0] * 7 + [None], 1, "k", 1, 2)]
    rows += [(244 + i, rows[5][1], rows[5][2], None, None, None) for i in range(30)]
    return spark.createDataFrame(rows, VECTORS)


def test_ball_tree(embeddings, spark):
    good = [(r["vec_id"], np.floor(64 * np.array(r["embedding"], dtype=np.float64))) for r in embeddings.collect() if r["embedding"] and None not in r["embedding"]]
    good = [(i, v) for i, v in good if np.isfinite(v).all()]
    expected = []
    for q, v in good:
        if q % 20 == 0:
            scores = sorted((-int(v @ w), i) for i, w in good if i != q)[:20]
            expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    assert Counter(listed(balltree.top_k(embeddings))) == Counter(expected)
    assert listed(balltree.top_k(spark.createDataFrame([], VECTORS))) == []


def test_flat_graph(embeddings, spark):
    rows = embeddings.collect()
    good = {}
    for r in rows:
        if r["label"] is not None and r["embedding"] and None not in r["embedding"] and np.isfinite(r["embedding"]).all() and np.any(r["embedding"]):
            v = np.array(r["embedding"], dtype=np.float64)
            good[r["vec_id"]] = (r["label"], v / np.linalg.norm(v))
    links = {i: [j for j in good if j != i and good[j][0] == good[i][0] and good[i][1] @ good[j][1] >= 0.93] for i in good}
    result = flatgraph.near_duplicates(embeddings)
    found = {r["vec_id"]: r for r in result.collect()}
    assert len(found) == len(rows)
    for r in rows:
        i = r["vec_id"]
        reach, new = {i}, [i]
        while new:
            new = [j for x in new for j in links.get(x, []) if j not in reach]
            reach |= set(new)
        assert (found[i]["n_links"], found[i]["component_id"]) == (len(links.get(i, [])), min(reach))
    assert flatgraph.recall(embeddings.limit(200), result) >= 0.9
    assert listed(flatgraph.near_duplicates(spark.createDataFrame([], VECTORS))) == []


def test_toxicity(documents, nothing, spark):
    r = random.Random(6)
    ordinary = ["".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
    rows, labels = [], []
    for i in range(400):
        text = [r.choice(ordinary) for _ in range(80)]
        if i % 4 == 0:
            for w in ("zzyzzyva", "quixotry"):
                text.insert(r.randrange(80), w)
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(i % 4 == 0)))
    docs = spark.createDataFrame([*rows, (None, None), (1000, "")], "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    result = {x["doc_id"]: x for x in toxicity.toxicity(docs, marks).collect()}
    assert len(result) == 402 and all(0 <= x["score"] <= 1 for x in result.values())
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(result[i]["held_out"] for i in held) and not result[None]["held_out"]
    assert np.mean([result[i]["predicted"] == (i % 4 == 0) for i in held]) > 0.8
    assert listed(toxicity.toxicity(nothing, marks)) == []
    assert {x["score"] for x in toxicity.toxicity(documents, marks.filter("toxic = 0")).collect()} == {0.0}


def _edit_distance(a: bytes, b: bytes) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_limit_by_diagonals_and_by_columns():
    draw = np.random.default_rng(5)
    for _ in range(300):
        a = draw.choice(list(b"abcd "), draw.integers(0, 70)).astype(np.uint8).tobytes()
        b = bytearray(a)
        for _ in range(draw.integers(0, 40)):
            i, kind = int(draw.integers(0, len(b) + 1)), draw.integers(0, 3)
            b[i : i + (kind > 0)] = b"" if kind == 1 else bytes([draw.choice(list(b"abcd "))])
        b = bytes(b)
        d = _edit_distance(a, b)
        for most in {0, max(0, d - 1), d, d + 1, fuzzylines.FEW_EDITS + 1}:
            assert fuzzylines.edit_within(a, b, most) == (d <= most)


def test_simhash_counts_bits_of_long_and_short_lines():
    draw = np.random.default_rng(6)
    sizes = [1, 0, 126, 127, 128, 5000, 2]
    words = draw.integers(0, 1 << 63, sum(sizes)).astype(np.uint64)
    at = np.concatenate(([0], np.cumsum(sizes)))
    _, simhash = fuzzylines.line_features(words, at)
    for a, b, value in zip(at[:-1], at[1:], simhash, strict=True):
        if a == b:
            assert value == 0
            continue
        w = words[a:b]
        pair = np.append(w[:1], textbytes.mix(w[1:] * np.uint64(0xD1B54A32D192ED03) + w[:-1]))
        bits = [np.unpackbits(textbytes.mix(x).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(int) for x in (w, pair)]
        majority = (bits[0] + bits[1]).sum(axis=0) > len(w)
        assert np.packbits(majority, bitorder="little").view(np.uint64)[0] == value


def test_close_values_across_batches():
    rng = np.random.default_rng(5)
    band = np.sort(rng.integers(0, 40, 600))
    band[:60] = 0  # more than FEW values
    band.sort()
    value = rng.integers(0, 6, 600).astype(np.uint64) << np.uint64(20)
    flat = pa.record_batch({"band": band, "i": np.zeros(600, np.int32), "j": np.zeros(600, np.int32), "simhash": value.view(np.int64)})
    batches = [flat.slice(a, 7) for a in range(0, 600, 7)]
    found = pa.Table.from_batches(list(fuzzylines._close(iter(batches)))).to_pylist()
    linked = {frozenset((x["name_1"], x["name_2"])) for x in found}
    near = {frozenset((int(a), int(b))) for g in np.unique(band) for a in value[band == g] for b in value[band == g] if np.bitwise_count(a ^ b) <= fuzzylines.BITS}
    assert linked <= near
    reach = {int(v): {int(v)} for v in np.unique(value)}
    for pair in linked:
        whole = set().union(*(reach[v] for v in pair))
        for v in whole:
            reach[v] = whole
    assert all(reach[min(pair)] == reach[max(pair)] for pair in near)
    assert list(fuzzylines._close(iter([flat.slice(0, 0)]))) == []


def test_toxic_dictionary_ends_in_telling_spans():
    rng = np.random.default_rng(3)
    plain = [" ".join(rng.choice(["the", "of", "house", "river", "stone", "green", "walk"], 200)).encode() for _ in range(80)]
    toxic = [" ".join(rng.choice(["the", "of", "house", "river", "stone", "green", "walk", "zorgblat", "quixnop"], 200)).encode() for _ in range(40)]
    samples = [toxicity.windows(t) for t in plain + toxic]
    bad, good = toxicity.train(samples, [0] * 80 + [1] * 40)
    assert b"orgblat" in bad and b"uixnop" in bad
    assert b"orgblat" not in good and b"uixnop" not in good
    one, other = (toxicity.compressor(x) for x in (bad, good))
    assert toxicity.features(b"the house zorgblat of quixnop river", one, other)[0] > toxicity.features(b"the house of green stone river", one, other)[0]
    assert toxicity.train([[]], [1]) == (b"", b"")


def test_values_three_bits_apart_share_a_band_at_any_number_of_blocks():
    rng = np.random.default_rng(3)
    assert [fuzzylines.n_blocks(n) for n in (0, 1, 10**5, 10**6, 10**8, 10**15)] == [5, 5, 6, 6, 7, 12]
    for blocks in (5, 6, 8, 12):
        for _ in range(50):
            value = int(rng.integers(0, 2**63))
            other = value
            for bit in rng.choice(64, fuzzylines.BITS, replace=False).tolist():
                other ^= 1 << bit
            rows = pa.RecordBatch.from_arrays([pa.array(np.array([value, other], dtype=np.uint64).view(np.int64))], names=["simhash"])
            (out,) = fuzzylines._block_keys(blocks)(iter([rows]))
            bands = out.column("band").to_numpy().reshape(-1, 2)
            assert (bands[:, 0] == bands[:, 1]).any()


def test_line_dedup_takes_any_extra_column(spark):
    names = ["doc_id", "text", "k", "gone", "_bit", "_word", "_mask", "_possible", "rest", "line", "a.b"]
    rows = [(i, f"the same line\nown {'abcde'[i] * 5}", *range(9)) for i in range(3)]
    got = fuzzylines.dedup_lines(spark.createDataFrame(rows, names))
    assert got.columns == ["doc_id", *names[2:], "text", "n_lines", "n_removed"]
    assert sorted(tuple(r) for r in got.collect()) == [
        (i, *range(9), f"the same line\nown {'abcde'[i] * 5}" if i == 0 else f"own {'abcde'[i] * 5}", 2, int(i > 0)) for i in range(3)
    ]


def _words(name, n):
    return [f"{name}{i}" for i in range(n)]


def _linked(spark, texts):
    """Pairs that ``passages`` links, of texts given as lists of words."""
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    return {(r.other_id, r.doc_id) for r in chaining.passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}


def test_passages_link_texts_whose_seeds_smaller_ids_hold_too(spark):
    shared = _words("s", 70)
    around = lambda i, part: _words(f"x{i}v", 60) + part + _words(f"y{i}v", 60)
    texts = [around(0, shared[:38]), around(1, shared[32:]), around(2, shared), around(3, shared)]
    assert _linked(spark, texts) == {(2, 3)}


def test_every_two_texts_with_a_common_passage_are_linked(spark):
    texts = [_words(f"x{i}v", 50) + _words("s", 60) + _words(f"y{i}v", 50) for i in range(6)]
    assert _linked(spark, texts) == {(i, j) for j in range(6) for i in range(j)}


def test_passages_of_seeds_in_many_texts(spark, monkeypatch):
    """All seeds of the 70 words are in more texts than meet pairwise; the 70 words are in two only."""
    monkeypatch.setattr(chaining, "MOST_PAIRED", 3)
    shared = _words("s", 70)
    around = lambda i, part: _words(f"x{i}v", 60) + part + _words(f"y{i}v", 60)
    texts = [around(i, shared[:38] if i % 2 else shared[32:]) for i in range(10)] + [around(i, shared) for i in (10, 11)]
    assert _linked(spark, texts) == {(10, 11)}
    many = [around(i, shared[:50]) for i in range(9)]
    assert {(0, j) for j in range(1, 9)} <= _linked(spark, many)
