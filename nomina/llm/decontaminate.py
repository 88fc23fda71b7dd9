"""Benchmark passages in training documents, by suffix arrays of the training words.

A shard is a run of whole documents of a few megabytes inside a task. Its words get numbers
from the vocabulary of the benchmark; a word that no item has ends a run, since no match can
go across it, and runs too short for a window are left out. All other suffixes are sorted by
rank tripling (ranks of 3, 9, 27, .. words, as deep as the longest item), and every suffix of
every item is binary-searched in every shard: first the suffixes that share a whole window
with it, then the longest verbatim match and where it is. Each place of a window is a hit.

The benchmark goes to the tasks in blocks of whole item texts of a bounded size (equal texts
once); rows pass one block after the other without a shuffle. Documents that are hit carry
the names of their windows; equal sets of windows are one row when they are joined with the
items, so copies of a contaminated document are looked up once.

Defined results: a null or empty text has no words. An item without words is in no document;
benchmark rows with one item_id are one item, a null item_id is listed as the empty string.
Repeated documents give a row each. Words and windows are named by 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from nomina.llm import textbytes as tb
from nomina.llm.common import ragged_binary
from nomina.llm.terms import fetched, term_hashes, text_blocks, word_numbers
from nomina.session import materialize

WINDOW = 10
SHARD_BYTES = 2 << 20  # of text; a longer document is a shard of its own
PIECE_WORDS = 1 << 20  # suffixes sorted at once: a longer document is cut into overlapping pieces
LONGEST = 1 << 19  # words of a match that are told apart: a longer one is reported with this length
BLOCK_BYTES = 4 << 20  # of item texts sent to the tasks at once

_BITS = np.uint64(21)  # of a word number or rank, three of which make one sort key
_key = tb.mix(np.arange(1, 4096, dtype=np.uint64))


@dataclass(frozen=True)
class Block:
    """Items as one array of word numbers and their suffixes that can hold a window."""

    vocabulary: np.ndarray  # sorted word hashes; a word's number is its place + 1
    numbers: np.ndarray  # of the words, 0 after each item
    triples: np.ndarray
    starts: np.ndarray  # of suffixes, in ``numbers``
    lengths: np.ndarray
    items: np.ndarray  # row of the suffix's item
    places: np.ndarray  # word of the item where the suffix starts
    windows: np.ndarray  # name of the window at its start
    needed: np.ndarray  # words of that window

    @property
    def deepest(self) -> int:
        return int(self.lengths.max(initial=0))

    @property
    def shortest(self) -> int:
        return int(self.needed.min(initial=0))


def window_names(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit name for the words from each start on, whose number is part of the name."""
    value = sizes.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    for i in range(int(sizes.max(initial=0))):
        inside = sizes > i
        value[inside] += words[starts[inside] + i] * (_key[i] | np.uint64(1))
    return tb.mix(value)


def item_windows(words: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Item, place, start in ``words`` and size of every window; a shorter item is one window."""
    n = np.diff(at)
    count = np.where(n >= window, n - window + 1, (n > 0).astype(np.int64))
    items = np.repeat(np.arange(len(n)), count)
    places = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return items, places, at[items] + places, np.minimum(n, window)[items]


def blocks_of(texts: pa.Array, window: int = WINDOW) -> list[Block]:
    """Items ready to be searched: one block, or more for items of very many words."""
    data, offsets = tb.as_bytes(texts)
    hashes, at = term_hashes(data, offsets)
    owner = np.repeat(np.arange(len(texts)), np.diff(at))
    items, places, starts, needed = item_windows(hashes, at, window)
    lengths = np.minimum(at[items + 1] - starts, LONGEST)
    names = window_names(hashes, starts, needed)
    blocks = []
    for some in (slice(i, i + PIECE_WORDS) for i in range(0, len(starts), PIECE_WORDS)):
        low, high = starts[some][0], (starts[some] + lengths[some]).max()
        vocabulary = np.unique(hashes[low:high])
        numbers = np.zeros(high - low + owner[high - 1] - owner[low] + 4, dtype=np.int64)
        shift = owner[low:high] - owner[low] - low
        numbers[np.arange(low, high) + shift] = np.searchsorted(vocabulary, hashes[low:high]) + 1
        begin = starts[some] + shift[starts[some] - low]
        blocks.append(Block(vocabulary, numbers.astype(np.uint64), _triples(numbers, 1), begin, lengths[some], items[some], places[some], names[some], needed[some]))
    return blocks


def _triples(values: np.ndarray, step: int) -> np.ndarray:
    """Three values, ``step`` apart, in one number; nothing follows a zero."""
    a, b, c = (values[i * step : len(values) - (2 - i) * step].astype(np.uint64) for i in range(3))
    b = np.where(a == 0, 0, b)
    c = np.where(b == 0, 0, c)
    return (a << (_BITS + _BITS)) | (b << _BITS) | c


class SuffixArray:
    """Sorted suffixes of a shard's runs of benchmark words; ``numbers`` has a 0 after each document."""

    def __init__(self, numbers: np.ndarray, shortest: int, deepest: int):
        foreign = np.concatenate(([-1], np.flatnonzero(numbers == 0)))
        run = np.diff(np.concatenate((foreign, [len(numbers)])))  # a foreign word and the run after it
        left = (np.repeat(foreign + run, run) - np.arange(-1, len(numbers)))[1:]
        at = np.flatnonzero(np.repeat(run - 1 >= shortest, run)[1:] & (numbers > 0))
        left = left[at]
        padded = np.concatenate((numbers, np.zeros(3, dtype=np.int64)))
        self.triples = _triples(padded, 1)
        self.numbers = padded.astype(np.uint64)
        rank = np.zeros(len(numbers), dtype=np.int64)
        depth, keys = 3, self.triples[at]
        while True:
            order = np.argsort(keys, kind="stable")
            ordered = keys[order]
            new = _first_of(ordered)
            if depth >= deepest or new.all():
                break
            rank[at[order]] = np.cumsum(new)
            keys = _triples(np.concatenate((rank, np.zeros(2 * depth, dtype=np.int64))), depth)[at]
            depth *= 3
        # A suffix shorter than every window stays out of the search: only its rank was needed.
        order = order[left[order] >= shortest]
        self.suffixes = at[order]
        self.first = self.triples[self.suffixes]

    def _bound(self, keys: np.ndarray, step: int, low: np.ndarray, high: np.ndarray, wanted: np.ndarray, right: bool) -> np.ndarray:
        """Binary search of all wanted keys at once, each between its own bounds."""
        low, high = low.copy(), high.copy()
        while (open_ := low < high).any():
            middle = (low[open_] + high[open_]) >> 1
            there = keys[np.minimum(self.suffixes[middle] + step, len(keys) - 1)]
            below = there <= wanted[open_] if right else there < wanted[open_]
            at = np.flatnonzero(open_)
            low[at[below]] = middle[below] + 1
            high[at[~below]] = middle[~below]
        return low

    def _narrow(self, block: Block, which: np.ndarray, depth: np.ndarray, low: np.ndarray, high: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the suffixes that share ``width`` more words with the suffixes ``which`` of the block."""
        keys, wanted = (self.triples, block.triples) if width == 3 else (self.numbers, block.numbers)
        new_low, new_high = low.copy(), high.copy()
        for d in np.unique(depth).tolist():
            same = depth == d
            key = wanted[block.starts[which[same]] + d]
            if d == 0 and width == 3:
                new_low[same], new_high[same] = np.searchsorted(self.first, key, "left"), np.searchsorted(self.first, key, "right")
            else:
                new_low[same] = self._bound(keys, d, low[same], high[same], key, False)
                new_high[same] = self._bound(keys, d, new_low[same], high[same], key, True)
        return new_low, new_high

    def search(
        self, block: Block, limits: np.ndarray, which: np.ndarray, depth: np.ndarray, low: np.ndarray, high: np.ndarray, longest: bool
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Go on with suffixes ``which`` that agree in ``depth`` words with rows ``low`` to ``high``, up to ``limits``.

        Returns depth and bounds of the agreement of each; where it ends before its limit, the
        depth is exact only for ``longest``.
        """
        depth, low, high = depth.copy(), low.copy(), high.copy()
        width = np.full(len(which), 3)
        active = np.arange(len(which))
        while True:
            width[active] = np.where(depth[active] + width[active] <= limits[active], width[active], 1)
            active = active[depth[active] < limits[active]]
            if len(active) == 0:
                return depth, low, high
            for w in (3, 1):
                some = active[width[active] == w]
                if len(some) == 0:
                    continue
                a, b = self._narrow(block, which[some], depth[some], low[some], high[some], w)
                found = a < b
                good = some[found]
                low[good], high[good], depth[good] = a[found], b[found], depth[good] + w
                # Where three more words disagree, one or two of them may still agree.
                if w == 3 and longest:
                    width[some[~found]] = 1
                else:
                    active = np.setdiff1d(active, some[~found], assume_unique=True)


@dataclass
class Shard:
    """Where a run of documents agrees with a block: ``places`` of windows, and each suffix's longest match."""

    places: np.ndarray  # words of the shard where a window starts
    windows: np.ndarray  # row in the block of that window's suffix
    found: np.ndarray  # suffixes of the block with at least their window
    depth: np.ndarray
    first: np.ndarray  # the first word of the shard with the longest match


def search_shard(hashes: np.ndarray, at: np.ndarray, block: Block, longest: bool = False) -> Shard:
    """All places of the block's windows in documents given as word hashes and first words (rows + 1)."""
    documents = np.repeat(np.arange(len(at) - 1), np.diff(at))
    numbers = np.zeros(len(hashes) + len(at) - 1, dtype=np.int64)
    numbers[np.arange(len(hashes)) + documents] = word_numbers(hashes, block.vocabulary)
    parts = []
    for begin in range(0, max(len(numbers), 1), PIECE_WORDS):
        end = min(begin + PIECE_WORDS, len(numbers))
        parts.append(_search_piece(numbers[begin : min(end + block.deepest, len(numbers))], end - begin, begin, block, longest))
    places, windows, found, depth, first = (np.concatenate(x) for x in zip(*parts, strict=True))
    if len(parts) > 1:
        best = np.lexsort((first, -depth, found))
        best = best[_first_of(found[best])]
        found, depth, first = found[best], depth[best], first[best]
    # Back from places among words and separators to places among words.
    ends = at[1:] + np.arange(1, len(at))
    return Shard(places - np.searchsorted(ends, places, "right"), windows, found, depth, first - np.searchsorted(ends, first, "right"))


def _first_of(ordered: np.ndarray) -> np.ndarray:
    """True where a value differs from the one before it."""
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return new


def _search_piece(numbers: np.ndarray, own: int, begin: int, block: Block, longest: bool) -> tuple[np.ndarray, ...]:
    """One suffix array; of its places only those before ``own`` belong to it, the rest is overlap."""
    none = np.zeros(0, dtype=np.int64)
    if len(block.starts) == 0:
        return none, none, none, none, none
    array = SuffixArray(np.concatenate((numbers, [0])), block.shortest, block.deepest)
    n = len(array.suffixes)
    if n == 0:
        return none, none, none, none, none
    every = np.arange(len(block.starts))
    zeros = np.zeros(len(every), dtype=np.int64)
    depth, low, high = array.search(block, block.needed, every, zeros, zeros, np.full(len(every), n), False)
    found = np.flatnonzero(depth >= block.needed)
    low, high = low[found], high[found]
    _, head = np.unique(block.windows[found], return_index=True)  # equal windows have the same places
    count = (high - low)[head]
    rows = np.repeat(low[head] - (np.cumsum(count) - count), count) + np.arange(count.sum())
    places, windows = array.suffixes[rows], np.repeat(found[head], count)
    mine = places < own
    if not longest:
        return places[mine] + begin, windows[mine], none, none, none
    depth, low, high = array.search(block, block.lengths[found], found, depth[found], low, high, True)
    first = np.array([array.suffixes[a:b].min() for a, b in zip(low.tolist(), high.tolist(), strict=True)], dtype=np.int64)
    return places[mine] + begin, windows[mine], found, depth, first + begin


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ranges, as ranges that neither overlap nor touch."""
    if len(starts) == 0:
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate(([True], starts[1:] > reach[:-1]))
    return starts[first], reach[np.concatenate((np.flatnonzero(first)[1:] - 1, [len(reach) - 1]))]


def _scan(block: Block, first: bool):
    """Add what a block finds to each document: its words, hit ranges of words and names of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tb.chunks(batch.column("text"), SHARD_BYTES):
                hashes, at = term_hashes(data, offsets)
                shard = search_shard(hashes, at, block)
                owner = np.searchsorted(at, shard.places, "right") - 1
                starts, ends, names = shard.places, shard.places + block.needed[shard.windows], block.windows[shard.windows]
                if not first:
                    earlier, owner_of = _longs(batch.column("spans").slice(a, b - a))
                    earlier = earlier + at[owner_of]
                    starts, ends = np.concatenate((starts, earlier[0::2])), np.concatenate((ends, earlier[1::2]))
                    old, old_owner = _longs(batch.column("windows").slice(a, b - a))
                    owner, names = np.concatenate((owner, old_owner)), np.concatenate((names, old.view(np.uint64)))
                starts, ends = _cut(starts, ends, at)
                span_owner = np.searchsorted(at, starts, "right") - 1
                pairs = np.stack((starts - at[span_owner], ends - at[span_owner]), axis=1).reshape(-1)
                spans = ragged_binary(pairs, 2 * np.searchsorted(span_owner, np.arange(b - a + 1)))
                order = np.lexsort((names, owner))
                owner, names = owner[order], names[order]
                new = _first_of(owner) | _first_of(names)
                kept = ragged_binary(names[new], np.searchsorted(owner[new], np.arange(b - a + 1)))
                rows = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([rows.column("row"), rows.column("text"), pa.array(np.diff(at)), spans, kept], names=_SCANNED)

    return run


def _cut(starts: np.ndarray, ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merged ranges inside documents: ranges of neighbours may touch, but are not one."""
    owner = np.searchsorted(at, starts, "right") - 1
    shifted_starts, shifted_ends = _merged(starts + owner, ends + owner)  # a gap of one between documents
    owner = np.searchsorted(at + np.arange(len(at)), shifted_starts, "right") - 1
    return shifted_starts - owner, shifted_ends - owner


def _longs(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All 64-bit values of binaries, and the row of each."""
    data, offsets = tb.as_bytes(column)
    return np.frombuffer(data.tobytes(), dtype=np.int64), np.repeat(np.arange(len(column)), np.diff(offsets) // 8)


_SCANNED = ["row", "text", "n_words", "spans", "windows"]


def scan(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, carried: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``(row, text, n_words, spans, windows)``: the carried columns, merged ranges of words that are hit, and names of the windows.

    Ranges (first word, last word + 1) and names are 64-bit values in binaries.
    """
    rows = documents.select(F.struct(*(F.col(f"`{c}`") for c in carried)).alias("row"), "text")
    schema = StructType([*rows.schema.fields]).add("n_words", "long").add("spans", "binary").add("windows", "binary")
    blocks = [b for items in text_blocks(benchmark, BLOCK_BYTES) for b in blocks_of(fetched(items), window)]
    if not blocks:  # nothing to look for: words are counted all the same
        blocks = [Block(*(np.zeros(0, dtype=t) for t in ("u8", "u8", "u8", "i8", "i8", "i8", "i8", "u8", "i8")))]
    for i, block in enumerate(blocks):
        rows = rows.mapInArrow(_scan(block, i == 0), schema)
    return rows


def _places(block: Block, texts: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tb.chunks(batch.column("text"), SHARD_BYTES):
                hashes, at = term_hashes(data, offsets)
                shard = search_shard(hashes, at, block, longest=True)
                owner = np.searchsorted(at, shard.first, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([texts[i] for i in block.items[shard.found]], type=pa.string()),
                        pa.array(block.places[shard.found]),
                        pa.array(shard.depth),
                        batch.column("doc_id").slice(a, b - a).take(pa.array(owner)),
                        pa.array(shard.first - at[owner]),
                    ],
                    names=["text", "item_word", "n_words", "doc_id", "doc_word"],
                )

    return run


def longest_matches(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(item_id, item_word, n_words, doc_id, doc_word)``: the longest verbatim match of every suffix of every item.

    ``item_word`` and ``doc_word`` are where it starts, counted in words; of equally long
    matches the smallest doc_id's first stays. Matches shorter than a window have no row.
    """
    rows = documents.select("doc_id", "text")
    id_type = dict(rows.dtypes)["doc_id"]
    schema = f"text string, item_word long, n_words long, doc_id {id_type}, doc_word long"
    found = rows.sparkSession.createDataFrame([], schema)
    for items in text_blocks(benchmark, BLOCK_BYTES):
        texts = fetched(items)
        for block in blocks_of(texts, window):
            found = found.unionByName(rows.mapInArrow(_places(block, texts.to_pylist()), schema))
    order = F.struct((-F.col("n_words")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "doc_word")
    best = found.groupBy("text", "item_word").agg(F.min(order).alias("m"))
    best = best.select("text", "item_word", (-F.col("m.n")).alias("n_words"), "m.doc_id", "m.doc_word")
    return benchmark.select("item_id", "text").distinct().join(best, "text").drop("text")


def _named_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in tb.chunks(batch.column("text")):
                hashes, at = term_hashes(data, offsets)
                items, _, starts, needed = item_windows(hashes, at, window)
                names = window_names(hashes, starts, needed).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column("item").slice(a, b - a).take(pa.array(items)), pa.array(names)], names=["item", "name"])

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A set of windows, by its bytes, to one row per window."""
    for batch in batches:
        names, owner = _longs(batch.column("windows"))
        yield pa.RecordBatch.from_arrays([batch.column("key").take(pa.array(owner)), pa.array(names)], names=["key", "name"])


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans)`` per document.

    ``spans`` holds the hit ranges, first word and last word + 1, one after the other.
    """
    scanned = materialize(_measured(scan(documents, benchmark, window)).select("row.*", "n_words", "n_hit", "spans", "windows"), "scanned")
    hit = scanned.filter("n_hit > 0").withColumn("key", F.md5("windows"))
    sets = hit.groupBy("key").agg(F.first("windows").alias("windows")).mapInArrow(_sets, "key string, name long")
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    named = items.mapInArrow(_named_windows(window), "item string, name long").distinct()
    listed = sets.join(named, "name").groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    digest = F.sha2(F.concat_ws(",", F.coalesce("items", F.array().cast("array<string>"))), 256)
    columns = ["doc_id", "n_words", "n_hit", F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "spans"]
    clean = scanned.filter("n_hit = 0").withColumn("items", F.array().cast("array<string>"))
    return hit.join(listed, "key", "left").select(*columns).unionAll(clean.select(*columns))


def _measured(scanned: DataFrame) -> DataFrame:
    """Ranges as a list of longs and the words that they cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, owner = _longs(batch.column("spans"))
            n_hit = np.bincount(owner[0::2], weights=values[1::2] - values[0::2], minlength=batch.num_rows).astype(np.int64)
            at = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
            spans = pa.ListArray.from_arrays(pa.array(at), pa.array(values))
            kept = [batch.column(c) for c in ("row", "text", "n_words", "windows")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n_hit), spans], names=["row", "text", "n_words", "windows", "n_hit", "spans"])

    schema = StructType([*scanned.select("row", "text", "n_words", "windows").schema.fields])
    return scanned.mapInArrow(run, schema.add("n_hit", "long").add("spans", ArrayType(LongType())))


def clean(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without a benchmark window, all their columns as they were."""
    others = [c for c in documents.columns if c != "text"]
    kept = scan(documents, benchmark, window, others).filter(F.octet_length("spans") == 0)
    return kept.select(*(F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in documents.columns))
