from collections import Counter

import numpy as np
import pyarrow as pa
from nomina.llm import fuzzylines


def test_repeated_keys_are_counted_over_batches():
    rng = np.random.default_rng(4)
    for size in (1, 2, 7, 100):
        keys = np.sort(np.concatenate((rng.integers(-40, 40, 60), np.full(25, 3), [-(1 << 63), (1 << 63) - 1, (1 << 63) - 1])))
        parts = [keys[a : a + size] for a in range(0, len(keys), size)]
        batches = [pa.RecordBatch.from_arrays([pa.array(p, pa.int64())], names=["band"]) for p in [*parts, keys[:0]]]
        got = pa.Table.from_batches(list(fuzzylines._repeated(iter(batches)))).to_pylist()
        want = {k: n for k, n in Counter(keys.tolist()).items() if n > 1}
        assert len(got) == len(want) and {r["band"]: r["n"] for r in got} == want
    assert list(fuzzylines._repeated(iter([]))) == []


def test_keys_travel_as_arrays_and_are_counted_whole():
    rng = np.random.default_rng(6)
    value = rng.integers(0, 1 << 63, 4000, dtype=np.uint64)
    value = np.concatenate((value, value[:900] ^ np.uint64(1), value[:30] ^ np.uint64(6 << 40)))
    every = fuzzylines._block_keys(6)
    batches = [pa.RecordBatch.from_arrays([pa.array(v.view(np.int64))], names=["simhash"]) for v in np.array_split(value, 5)]
    want = {k: n for k, n in Counter(np.concatenate([b.column("band").to_numpy() for b in every(iter(batches))]).tolist()).items() if n > 1}
    rows = pa.Table.from_batches(list(fuzzylines._key_parts(6, 7)(iter(batches))))
    assert rows.num_rows <= 7 and set(rows.column("part").to_pylist()) <= set(range(7))
    twice = pa.concat_tables([rows, rows]).sort_by("part")
    for table, times in ((rows.sort_by("part"), 1), (twice, 2)):
        got = pa.Table.from_batches(list(fuzzylines._repeated_in_parts(iter(table.to_batches(max_chunksize=3))))).to_pylist()
        counts = {r["band"]: r["n"] for r in got}
        assert len(got) == len(counts) and all(counts[k] == times * n for k, n in want.items())
        assert times == 2 or len(counts) == len(want)


def test_band_keys_are_shuffled_in_few_rows(spark, monkeypatch):
    monkeypatch.setattr(fuzzylines, "PART_KEYS", 1 << 10)
    rows = [(i, f"line {i % 40} of the many words that tell one text from another text again {i % 40}\nown line {i} alone") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in fuzzylines.dedup_lines(docs).collect()}
    assert all(got[i] >= 1 for i in range(40, 300)) and got[0] == 0
