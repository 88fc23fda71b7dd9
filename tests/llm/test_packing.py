import numpy as np
import public_tokenizers
import pyarrow as pa
from nomina.llm import packing
from nomina.llm import textbytes as tb
from tokenizers import Tokenizer


def test_known_chunks_keep_their_ids():
    rng = np.random.default_rng(7)
    known, want = packing._Known(), {}
    for _ in range(20):
        hashes = np.unique(rng.integers(0, 200, 30, dtype=np.uint64) << np.uint64(56))
        new = known.missing(hashes)
        assert set(hashes[new].tolist()) == set(hashes.tolist()) - set(want)
        size = rng.integers(0, 4, len(new))
        ids = rng.integers(0, 50_000, size.sum()).astype("<u4")
        for h, part in zip(hashes[new].tolist(), np.split(ids, np.cumsum(size)[:-1]), strict=len(new) > 0):
            want[h] = part.tolist()
        known.add(hashes[new], ids, size)
        at = known.places(hashes)
        for h, a, n in zip(hashes.tolist(), known.first[at].tolist(), known.size[at].tolist(), strict=True):
            assert known.ids[a : a + n].tolist() == want[h]


def test_only_new_chunks_are_tokenised_and_ids_stay_those_of_whole_texts(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    texts = ["one two three four", "two three five", "", "four one  six", "é two ü three", "one two three four"]
    for cache in (packing.CACHE, 3):
        monkeypatch.setattr(packing, "CACHE", cache)
        monkeypatch.setattr(packing, "_known", {})
        for text in [*texts, *texts]:
            ids, at = packing.token_ids(path, *tb.as_bytes(pa.array([text])), None)
            assert ids.tolist() == whole.encode(text, add_special_tokens=False).ids and at.tolist() == [0, len(ids)]
        if cache > 3:
            assert len(packing._known[path].hashes) == len(np.unique(packing._known[path].hashes)) < 20
