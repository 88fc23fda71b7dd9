import numpy as np
import pyarrow as pa
from nomina.llm import ngramtrie
from nomina.llm import textbytes as tb


def test_select_finds_the_kth_one_of_a_word():
    rng = np.random.default_rng(3)
    words = [*rng.integers(0, 1 << 63, 50, dtype=np.uint64), np.uint64(1), np.uint64(1 << 63), np.uint64((1 << 64) - 1)]
    for word in words:
        ones = [i for i in range(64) if int(word) >> i & 1]
        got = ngramtrie._select(np.full(len(ones), word, dtype=np.uint64), np.arange(len(ones)))
        assert got.tolist() == ones


def test_blocks_of_a_shard_ask_for_each_ngram_once(monkeypatch):
    texts = ["a b a c", "a b c a b", "", "c a b a c"]
    blocks = []
    for number, text in enumerate(texts):
        rows = pa.RecordBatch.from_pydict({"doc_id": [number], "text": [text], "held": [number == 1]})
        blocks.append(ngramtrie._block(rows, *tb.as_bytes(rows.column("text")), number, 2, 1, False))
    asked = []

    def counting(method):
        def run(self, *keys):
            asked.append(len(keys[0]))
            assert len(set(zip(*(k.tolist() for k in keys), strict=True))) == len(keys[0])
            return method(self, *keys)

        return run

    monkeypatch.setattr(ngramtrie.Words, "count", counting(ngramtrie.Words.count))
    monkeypatch.setattr(ngramtrie.Successors, "look_up", counting(ngramtrie.Successors.look_up))
    table = pa.Table.from_batches(blocks).sort_by([("kind", "ascending"), ("shard", "ascending"), ("block", "ascending")])
    answers = pa.Table.from_batches(list(ngramtrie._answers(iter(table.combine_chunks().to_batches())))).to_pylist()
    words = {t: set(x.split()) for t, x in enumerate(texts)}
    pairs = {(a, b) for x in texts for a, b in zip(["<s>", *x.split()], [*x.split(), "</s>"], strict=True)}
    assert asked == [len(set().union(*words.values())) + 1, len(pairs)]
    learnt = " ".join(t for i, t in enumerate(texts) if i != 1).split()
    for r in answers:
        if r["kind"] == "1":
            counts = sorted(ngramtrie._array(r["result"], np.int64).tolist())
            assert counts == sorted([3, *(learnt.count(w) for w in words[r["block"]])])
