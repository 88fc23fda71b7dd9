"""Language-model scoring with a sharded Elias-Fano n-gram trie.

Documents are cut into blocks; a block counts its own training n-grams once and sends each
distinct n-gram to the shard of its context. A shard adds up what all blocks counted and
builds its part of the trie: contexts and their successors as monotone sequences in
Elias-Fano form, pointers from a context to its successors, and quantised smoothed
log-probabilities, in memory-mapped files. Each block's n-grams are then looked up: the
context first, then the word by a successor search inside the context's range. Results go
back to the block, which adds up its documents.

Words are named by 64 bits of their hash at the first level and by 32 in longer n-grams.
Smoothing is Witten-Bell: p(w | h) = (c(hw) + T(h) p(w)) / (c(h) + T(h)).

A block's n-grams are aggregated before the shuffle, and a frequent context or word is one
entry per block, however often it occurs. Blocks and shards have bounded sizes.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomina.llm import textbytes as tb
from nomina.llm.common import crc_mod, dealt, groups
from nomina.session import materialize

HELD_OUT = (7, 2)
BLOCK = 8 << 20  # bytes of text of a block
SHARD = 32 << 20  # bytes of text for each shard of the trie
STEP = 1 / 2048  # of quantised log10 probabilities, in 16 bits: down to -32
NONE = np.uint16(65535)  # quantised probability 0
END = tb.mix(np.array([0x3C2F733E], dtype=np.uint64))[0]  # the token after the last word
START = np.uint32(0x3C733E)  # context of the first word

# One bit in each byte of a word, and the place of the k-th one in each byte value.
_LOWEST = np.uint64(0x0101010101010101)
_TOP = np.uint64(0x8080808080808080)
_PLACE = np.argsort(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little") == 0, axis=1, kind="stable").astype(np.int64)


def _select(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Place of the k-th one (from 0) in 64-bit words that have as many: first its byte, by counts of all eight at once."""
    n = words - ((words >> np.uint64(1)) & np.uint64(0x5555555555555555))
    n = (n & np.uint64(0x3333333333333333)) + ((n >> np.uint64(2)) & np.uint64(0x3333333333333333))
    up_to = ((n + (n >> np.uint64(4))) & np.uint64(0x0F0F0F0F0F0F0F0F)) * _LOWEST
    k = k.astype(np.uint64)
    shift = np.bitwise_count(((k * _LOWEST) | _TOP) - up_to & _TOP).astype(np.uint64) << np.uint64(3)
    before = ((up_to << np.uint64(8)) >> shift) & np.uint64(255)
    value = (words >> shift) & np.uint64(255)
    return shift.astype(np.int64) + _PLACE[value.astype(np.int64), (k - before).astype(np.int64)]


class EliasFano:
    """A non-decreasing sequence: packed low bits, and the high parts in unary.

    ``buffers`` puts all arrays into one memory-mapped file.
    """

    def __init__(self, values: np.ndarray, room: Mapped):
        n = len(values)
        self.n = n
        top = int(values[-1]) if n else 0
        self.low_bits = max(0, min(56, int(math.floor(math.log2(max(1, top // max(1, n)))) if top > n else 0)))
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        low = values & np.uint64((1 << self.low_bits) - 1)
        self.top_high = int(high[-1]) if n else 0
        self._low = room.put(_pack_bits(low, self.low_bits))
        bits = np.zeros(n + self.top_high + 2, dtype=np.uint8)
        bits[high + np.arange(n)] = 1
        words = np.packbits(bits, bitorder="little")
        words = np.concatenate((words, np.zeros(-len(words) % 8, dtype=np.uint8)))
        self._high = room.put(words)
        zeros = 64 - np.bitwise_count(words.view(np.uint64)).astype(np.int64)
        self._rank = room.put(np.concatenate(([0], np.cumsum(zeros))).view(np.uint8), np.int64)

    def low(self, i: np.ndarray) -> np.ndarray:
        return _unpack_bits(self._low, i, self.low_bits)

    def select0(self, k: np.ndarray) -> np.ndarray:
        """Position of the k-th zero (from 0) in the unary part."""
        word = np.searchsorted(self._rank, k, side="right") - 1
        word = np.minimum(word, len(self._rank) - 2)
        return word * 64 + _select(~self._high.view("<u8")[word], k - self._rank[word])

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first value >= x (n if there is none)."""
        out = np.empty(len(x), dtype=np.int64)
        for a in range(0, len(x), 1 << 15):
            out[a : a + (1 << 15)] = self._successor(x[a : a + (1 << 15)])
        return out

    def _successor(self, x: np.ndarray) -> np.ndarray:
        if self.n == 0:
            return np.zeros(len(x), dtype=np.int64)
        high = np.minimum(x >> np.uint64(self.low_bits), np.uint64(self.top_high + 1)).astype(np.int64)
        beyond = high > self.top_high
        h = np.minimum(high, self.top_high)
        first = np.where(h > 0, self.select0(np.maximum(h - 1, 0)) - (h - 1), 0)
        last = self.select0(h) - h
        want = x & np.uint64((1 << self.low_bits) - 1)
        lo, hi = first.copy(), last.copy()
        while (open_ := lo < hi).any():
            middle = (lo + hi) // 2
            less = open_ & (self.low(np.minimum(middle, self.n - 1)) < want)
            lo = np.where(less, middle + 1, lo)
            hi = np.where(open_ & ~less, middle, hi)
        return np.where(beyond, self.n, lo)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Index of x in a strictly increasing sequence, or -1."""
        at = self.successor(x)
        there = np.minimum(at, max(self.n - 1, 0))
        return np.where((at < self.n) & (self.value(there) == x), there, -1) if self.n else np.full(len(x), -1)

    def value(self, i: np.ndarray) -> np.ndarray:
        """Values at positions: the high part is the number of zeros before the i-th one."""
        out = np.empty(len(i), dtype=np.uint64)
        ones = 64 * np.arange(len(self._rank)) - self._rank
        for a in range(0, len(i), 1 << 15):
            k = i[a : a + (1 << 15)]
            word = np.minimum(np.searchsorted(ones, k, side="right") - 1, len(self._rank) - 2)
            place = _select(self._high.view("<u8")[word], k - ones[word])
            high = (word * 64 + place - k).astype(np.uint64)
            out[a : a + (1 << 15)] = (high << np.uint64(self.low_bits)) | self.low(k)
        return out


def _pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    if width == 0 or len(values) == 0:
        return np.zeros(16, dtype=np.uint8)
    parts = []
    for a in range(0, len(values), 1 << 15):  # a multiple of 8, so that parts end at bytes
        bits = np.unpackbits(values[a : a + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :width]
        parts.append(np.packbits(bits.reshape(-1), bitorder="little"))
    return np.concatenate([*parts, np.zeros(16, dtype=np.uint8)])


def _unpack_bits(packed: np.ndarray, i: np.ndarray, width: int) -> np.ndarray:
    if width == 0:
        return np.zeros(len(i), dtype=np.uint64)
    bit = i * width
    at_byte = np.ndarray((len(packed) - 7,), dtype="<u8", buffer=packed, strides=(1,))  # the eight bytes from each one on
    return (at_byte[bit >> 3] >> (bit & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)


class Mapped:
    """Arrays in one unnamed temporary file that is memory-mapped and vanishes with the object."""

    def __init__(self):
        self._file = tempfile.TemporaryFile()

    def put(self, values: np.ndarray, dtype: type = np.uint8) -> np.ndarray:
        at = self._file.seek(0, 2)
        at += self._file.write(b"\0" * (-at % 16))
        self._file.write(np.ascontiguousarray(values).view(np.uint8).tobytes())
        self._file.flush()
        n = values.nbytes // np.dtype(dtype).itemsize
        return np.asarray(np.memmap(self._file, dtype=dtype, mode="r", offset=at, shape=(n,))) if n else np.zeros(0, dtype=dtype)


def quantise(p: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(p > 0, np.minimum(np.round(-np.log10(p) / STEP), 65534), 65535).astype(np.uint16)


def restore(q: np.ndarray) -> np.ndarray:
    return np.where(q == NONE, 0.0, 10.0 ** (-STEP * q.astype(np.float64)))


class Words:
    """First level: words, with counts."""

    def __init__(self, names: np.ndarray, counts: np.ndarray):
        room = Mapped()
        order = np.argsort(names)
        first = np.flatnonzero(np.concatenate(([True], np.diff(names[order]) > 0))) if len(order) else order
        total = np.add.reduceat(counts[order], first) if len(order) else counts
        keep = total > 0
        self.names = EliasFano(names[order][first][keep], room)
        self.counts = room.put(total[keep].astype(np.int64).view(np.uint8), np.int64)

    def count(self, names: np.ndarray) -> np.ndarray:
        at = self.names.find(names)
        return np.where(at >= 0, self.counts[np.maximum(at, 0)] if len(self.counts) else 0, 0)


class Successors:
    """A deeper level: contexts, pointers to their successors, and quantised probabilities."""

    def __init__(self, contexts: np.ndarray, words: np.ndarray, counts: np.ndarray):
        room = Mapped()
        order = np.lexsort((words, contexts))
        contexts, words, counts = contexts[order], words[order], counts[order]
        new = np.ones(len(words), dtype=bool)
        new[1:] = (contexts[1:] != contexts[:-1]) | (words[1:] != words[:-1])
        first = np.flatnonzero(new)
        total = np.add.reduceat(counts, first) if len(first) else counts
        contexts, words = contexts[first][total > 0], words[first][total > 0]
        total = total[total > 0].astype(np.float64)
        begin = np.flatnonzero(np.concatenate(([True], contexts[1:] != contexts[:-1]))) if len(contexts) else np.zeros(0, dtype=np.int64)
        kinds = np.diff(np.append(begin, len(contexts))).astype(np.float64)
        seen = np.add.reduceat(total, begin) if len(begin) else total
        rank = np.repeat(np.arange(len(begin)), kinds.astype(np.int64))
        self.contexts = EliasFano(contexts[begin], room)
        self.pointers = EliasFano(np.append(begin, len(contexts)).astype(np.uint64), room)
        # successors relative to their context: each context's range lies above the one before
        self.words = EliasFano((rank.astype(np.uint64) << np.uint64(32)) | words.astype(np.uint64), room)
        self.own = room.put(quantise(total / np.repeat(seen + kinds, kinds.astype(np.int64))).view(np.uint8), np.uint16)
        self.rest = room.put(quantise(kinds / (seen + kinds)).view(np.uint8), np.uint16)

    def look_up(self, contexts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Quantised own part and weight of the lower order for each n-gram."""
        own, rest = np.full(len(contexts), NONE), np.zeros(len(contexts), dtype=np.uint16)
        at = self.contexts.find(contexts)
        known = np.flatnonzero(at >= 0)
        if len(known):
            rest[known] = self.rest[at[known]]
            place = self.words.successor((at[known].astype(np.uint64) << np.uint64(32)) | words[known].astype(np.uint64))
            inside = place < self.pointers.value(at[known] + 1).astype(np.int64)
            known, place, rank = known[inside], place[inside], at[known][inside]
            same = self.words.value(place) == ((rank.astype(np.uint64) << np.uint64(32)) | words[known].astype(np.uint64)) if len(place) else inside[:0]
            own[known[same]] = self.own[place[same]]
        return own, rest


BLOCKS = "kind string, block long, shard int, a binary, b binary, c binary, d binary"


def _count(order: int, n_shards: int, own: bool):
    """Per block: its tokens (``own``), or its distinct n-grams by shard, with training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, last, data, offsets in tb.chunks(batch.column("text"), BLOCK):
                yield _block(batch.slice(first, last - first), data, offsets, block, order, n_shards, own)
                block += 1

    return run


def _raw(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x).tobytes(), 3)


def _array(raw: bytes, dtype: type) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw), dtype)


def _block(rows: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, block: int, order: int, n_shards: int, own: bool) -> pa.RecordBatch:
    """Distinct n-grams are numbered by shard, context and word, so answers put together by shard need no index."""
    words, at = tb.word_hashes(data, offsets)
    tokens = np.insert(words, at[1:], END)
    bounds = at + np.arange(len(at))
    n = np.diff(bounds)
    names, local = np.unique(tokens, return_inverse=True)
    shard = ((names >> np.uint64(33)) % np.uint64(n_shards)).astype(np.int64)
    by = np.argsort(shard, kind="stable")
    number = np.empty(len(by), dtype=np.uint32)
    number[by] = np.arange(len(by))
    names, shard, local = names[by], shard[by], number[local]
    train = ~rows.column("held").to_numpy(zero_copy_only=False)
    learnt = np.repeat(train, n)
    out = []
    if own:
        ids = rows.column("doc_id")
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        flags = np.c_[train, known].astype(np.uint8)
        out.append(("tokens", block, -1, _raw(local), _raw(bounds), _raw(ids.fill_null(0).to_numpy()), _raw(flags)))
    else:
        counts = np.bincount(local[learnt], minlength=len(names)).astype(np.uint32)
        for s, a, b in _shards(shard):
            out.append(("1", block, s, _raw(names[a:b]), b"", _raw(counts[a:b]), b""))
    short = (tokens >> np.uint64(32)).astype(np.uint32)
    context = np.zeros(len(tokens), dtype=np.uint64)
    place = np.arange(len(tokens)) - np.repeat(bounds[:-1], n)
    for k in range(2, order + 1):
        shifted = np.full(len(tokens), START, dtype=np.uint32)
        shifted[k - 1 :] = short[: max(0, len(short) - k + 1)]
        shifted[place < k - 1] = START
        context = shifted.astype(np.uint64) if k == 2 else tb.mix(context * np.uint64(0x9E3779B97F4A7C15) + shifted) >> np.uint64(16)
        shard = (tb.mix(context) % np.uint64(n_shards)).astype(np.int64)
        by = np.lexsort((short, context, shard))
        new = np.ones(len(by), dtype=bool)
        new[1:] = (context[by][1:] != context[by][:-1]) | (short[by][1:] != short[by][:-1])
        if own:
            gram = np.empty(len(by), dtype=np.uint32)
            gram[by] = np.cumsum(new) - 1
            out.append((f"{k}-local", block, -1, _raw(gram), b"", b"", b""))
            continue
        first = np.flatnonzero(new)
        total = np.add.reduceat(learnt[by].astype(np.int64), first).astype(np.uint32)
        contexts, ends = context[by][first], short[by][first]
        for s, a, b in _shards(shard[by][first]):
            head = np.ones(b - a, dtype=bool)
            head[1:] = contexts[a + 1 : b] != contexts[a : b - 1]
            run = np.diff(np.append(np.flatnonzero(head), b - a)).astype(np.uint32)
            out.append((str(k), block, s, _raw(contexts[a:b][head]), _raw(ends[a:b]), _raw(total[a:b]), _raw(run)))
    columns = [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int32(), *[pa.binary()] * 4))]
    return pa.RecordBatch.from_arrays(columns, names=["kind", "block", "shard", "a", "b", "c", "d"])


def _shards(shard: np.ndarray) -> Iterator[tuple[int, int, int]]:
    first = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1])))
    yield from zip(shard[first].tolist(), first.tolist(), [*first[1:].tolist(), len(shard)], strict=True)


def _distinct(grams: list[tuple[np.ndarray, np.ndarray]], counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct n-grams in order, the number of each given one among them, and what they count; empties the list."""
    contexts, words = (np.concatenate(parts) for parts in zip(*grams, strict=True))
    grams.clear()  # the largest arrays of a shard: each is let go before the next is made
    order = np.lexsort((words, contexts))
    contexts = contexts[order]
    words = words[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (contexts[1:] != contexts[:-1]) | (words[1:] != words[:-1])
    first = np.flatnonzero(new)
    contexts, words = contexts[first], words[first]
    total = np.add.reduceat(counts[order], first, dtype=np.int64)
    number = np.empty(len(order), dtype=np.int32)
    number[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return contexts, words, number, total


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Build each shard of the trie and look up what each block asks of it."""
    for group in groups(batches, ("kind", "shard")):
        kind = group.column("kind")[0].as_py()
        a, c = ([v.as_py() for v in group.column(x)] for x in ("a", "c"))
        counts = np.concatenate([_array(x, np.uint32) for x in c])
        learnt = counts.sum(dtype=np.int64)
        if kind == "1":
            names = [_array(x, np.uint64) for x in a]
            asked = [len(x) for x in names]
            names, number = np.unique(np.concatenate(names), return_inverse=True)
            level = Words(names, np.bincount(number, counts, len(names)).astype(np.int64))
            found = level.count(names)
            size = level.names.n
        else:
            b, d = ([v.as_py() for v in group.column(x)] for x in ("b", "d"))
            grams = [
                (np.repeat(_array(heads, np.uint64), _array(run, np.uint32)), _array(ends, np.uint32))
                for heads, ends, run in zip(a, b, d, strict=True)
            ]
            asked = [len(ends) for _, ends in grams]
            del a, b, c, d
            contexts, words, number, total = _distinct(grams, counts)
            del counts
            level = Successors(contexts, words, total)
            found = np.stack(level.look_up(contexts, words))
            size = level.words.n
        # Blocks share most of what they ask, so each n-gram is looked up once.
        result = [_raw(found[..., of_block]) for of_block in np.split(number, np.cumsum(asked)[:-1])]
        n = len(result)
        yield pa.RecordBatch.from_arrays(
            [
                *(group.column(x).combine_chunks() for x in ("kind", "block", "shard")),
                pa.array(np.full(n, size)),
                pa.array(np.full(n, learnt)),
                pa.array(result, pa.binary()),
            ],
            names=["kind", "block", "shard", "size", "learnt", "result"],
        )


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _add_up(order: int, total: int, vocabulary: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ("block",)):
            rows = group.to_pylist()
            own = next((r for r in rows if r["kind"] == "tokens"), None)
            local = _array(own["a"], np.uint32)
            bounds, ids = _array(own["b"], np.int64), _array(own["c"], np.int64)
            flags = _array(own["d"], np.uint8).reshape(-1, 2).astype(bool)
            answers = sorted((r for r in rows if r["result"] is not None), key=lambda r: r["shard"])
            counts = np.concatenate([_array(r["result"], np.int64) for r in answers if r["kind"] == "1"])
            n = counts[local]
            base = (n + 1) / (total + vocabulary + 1)
            p = base
            for k in range(2, order + 1):
                gram = _array(next(r["a"] for r in rows if r["kind"] == f"{k}-local"), np.uint32)
                found = np.concatenate([_array(r["result"], np.uint16).reshape(2, -1) for r in answers if r["kind"] == str(k)], axis=1)
                p = restore(found[0])[gram] + restore(found[1])[gram] * p
            at = bounds[:-1]
            columns = [
                pa.array(ids, mask=~flags[:, 1]),
                pa.array(~flags[:, 0]),
                pa.array(np.diff(bounds)),
                pa.array(np.add.reduceat((n > 0).astype(np.int64), at)),
                pa.array(np.full(len(ids), total)),
                pa.array(np.add.reduceat(np.log10(base), at)),
                pa.array(np.add.reduceat(np.log10(p), at)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SCORES.split(", ")])

    return run


def score(docs: DataFrame, order: int = 2) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of ``docs(doc_id, text)``.

    Learns from rows whose crc32(doc_id as text) mod 7 is not 2; rows with a null id are
    learnt from. A null text is empty and has one token, its end. ``base_score`` is the
    add-one unigram log10 probability, ``score`` the model's. Repeated rows are counted
    and scored each. An empty table gives an empty result.
    """
    held = F.coalesce(crc_mod("doc_id", HELD_OUT[0]) == HELD_OUT[1], F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held.alias("held"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_shards = max(1, math.ceil(size / SHARD))
    # Counted twice, for the shards and for the blocks, rather than stored: a block is the
    # same rows of the same partition of the input each time.
    asked = rows.mapInArrow(_count(order, n_shards, False), BLOCKS)
    answers = materialize(
        dealt(asked, "kind", "shard").mapInArrow(_answers, "kind string, block long, shard int, size long, learnt long, result binary"), "ngram-answers"
    )
    per_shard = answers.filter("kind = '1'").groupBy("shard").agg(F.max("size").alias("size"), F.max("learnt").alias("learnt"))
    vocabulary, learnt = per_shard.agg(F.sum("size"), F.sum("learnt")).first()
    own = rows.mapInArrow(_count(order, n_shards, True), BLOCKS).withColumn("result", F.lit(None).cast("binary"))
    empty = F.lit(None).cast("binary")
    back = answers.select("kind", "block", "shard", empty.alias("a"), empty.alias("b"), empty.alias("c"), empty.alias("d"), "result")
    return dealt(own.unionByName(back), "block").mapInArrow(_add_up(order, int(learnt or 0), int(vocabulary or 0)), SCORES)
