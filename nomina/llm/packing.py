"""Best-fit packing of tokenised documents into sequences: vector bins.

A sequence has three capacities: tokens, documents and attention cost (the sum of squared
piece lengths). Pieces are placed longest first; among the open sequences that hold a
piece under every capacity, the one is chosen whose weighted residual norm after placing
is smallest (or whose weighted dot product with the piece is largest). Sequences of equal
residuals are one state and pieces of equal length are placed together.

Pieces are dealt to groups of bounded size by hash; a group is packed by itself, which
costs at most one sequence that is not full for each group.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomina.llm import textbytes as tb
from nomina.llm.common import dealt, groups
from nomina.session import materialize

LONGEST = 1024
END = 2
GROUP = 16384  # pieces packed together
CACHE = 1_000_000  # chunks a worker remembers, by their hashes: about 50 MB

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, slot long"

# Bytes next to a blank that cannot be part of white space: printable ASCII,
# or a character of two bytes whose first is C3 to DF.
_PLAIN = np.zeros(256, dtype=bool)
_PLAIN[0x21:0x7F] = True
_LEAD = np.zeros(256, dtype=bool)
_LEAD[0xC3:0xE0] = True

_tokenizers: dict[str, object] = {}
_known: dict[str, _Known] = {}


def _cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of chunks that are tokenised independently, and each text's first chunk.

    The pre-tokenizer puts a single blank between two non-blanks at the start of a token,
    so a text can be cut in front of it without changing any token.
    """
    n = len(data)
    cut = np.zeros(n + 1, dtype=bool)
    if n > 2:
        before = _PLAIN[data[:-2]]
        before[1:] |= (data[1:-2] >= 0x80) & _LEAD[data[:-3]]
        cut[1 : n - 1] = (data[1:-1] == 0x20) & before & (_PLAIN[data[2:]] | _LEAD[data[2:]])
    full = offsets[:-1][offsets[1:] > offsets[:-1]]
    # a blank at the edge of a text is no cut, nor one whose neighbours belong to another text
    for edge in (full, full - 1, full + 1):
        cut[edge[(edge >= 0) & (edge < n)]] = False
    cut[full] = True
    starts = np.flatnonzero(cut)
    return starts, np.searchsorted(starts, offsets)


class _Known:
    """Chunks a worker has tokenised: their hashes in order, and where the ids of each are among all ids."""

    def __init__(self):
        self.hashes, self.first, self.size = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype="<u4")

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Where each hash is; past the end, or at another one, if it is not known."""
        return np.searchsorted(self.hashes, hashes)

    def missing(self, hashes: np.ndarray) -> np.ndarray:
        at = self.places(hashes)
        there = np.minimum(at, max(len(self.hashes) - 1, 0))
        return np.flatnonzero((at == len(self.hashes)) | (self.hashes[there] != hashes)) if len(self.hashes) else np.arange(len(hashes))

    def add(self, hashes: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        at = self.places(hashes)
        self.first = np.insert(self.first, at, len(self.ids) + np.cumsum(size) - size)
        self.size, self.hashes = np.insert(self.size, at, size), np.insert(self.hashes, at, hashes)
        self.ids = np.concatenate((self.ids, ids))


def _encode(path: str, hashes: np.ndarray, parts: Callable[[np.ndarray], list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all chunks a worker knows, and the first place and number of those of each chunk; ``parts`` gives the text of some."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    if path not in _tokenizers:
        _tokenizers[path] = Tokenizer.from_file(path)
    if path not in _known or len(_known[path].hashes) > CACHE:
        _known[path] = _Known()
    known = _known[path]
    new = known.missing(hashes)
    if len(new):
        encoded = _tokenizers[path].encode_batch_fast([p.decode("utf-8") for p in parts(new)], add_special_tokens=False)
        size = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
        ids = chain.from_iterable(map(attrgetter("ids"), encoded))
        known.add(hashes[new], np.fromiter(ids, dtype="<u4", count=int(size.sum())), size)
    at = known.places(hashes)
    return known.ids, known.first[at], known.size[at]


def token_ids(path: str, data: np.ndarray, offsets: np.ndarray, end: int | None = END) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts one after the other, ``end`` after each, and where each begins."""
    starts, at = _cuts(data, offsets)
    n = len(offsets) - 1
    if len(starts):
        ends = np.append(starts[1:], len(data))
        hashes, index, code = np.unique(tb.spans(tb.prefix_hashes(data), starts, ends), return_index=True, return_inverse=True)
        raw = data.tobytes()
        parts = lambda new: [raw[a:b] for a, b in zip(starts[index[new]].tolist(), ends[index[new]].tolist(), strict=True)]
        flat, first, size = _encode(path, hashes, parts)
        length = size[code]
        total = np.concatenate(([0], np.cumsum(length)))
        ids = flat[np.repeat(first[code] - total[:-1], length) + np.arange(total[-1])]
        bounds = total[at]
    else:
        ids, bounds = np.zeros(0, dtype="<u4"), np.zeros(n + 1, dtype=np.int64)
    if end is not None:
        ids = np.insert(ids, bounds[1:], np.uint32(end))
        bounds = bounds + np.arange(n + 1)
    return ids, bounds


def cut_lengths(n: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Owner, number, start and length of the pieces: whole ones, and a shorter one in front."""
    pieces = -(-n // longest)
    owner = np.repeat(np.arange(len(n)), pieces)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    front = n - (pieces - 1) * longest
    start = np.where(number == 0, 0, front[owner] + (number - 1) * longest)
    return owner, number, start, np.where(number == 0, front[owner], longest)


def _pieces(path: str, longest: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = 0
        for batch in batches:
            for first, last, data, offsets in tb.chunks(batch.column("text")):
                ids, at = token_ids(path, data, offsets)
                owner, number, start, length = cut_lengths(np.diff(at), longest)
                a = at[owner] + start
                raw = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
                parts = [raw[4 * x : 4 * (x + y)] for x, y in zip(a.tolist(), length.tolist(), strict=True)]
                columns = [
                    batch.column("doc_id").slice(first, last - first).take(pa.array(owner)),
                    pa.array(number.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    pa.array([zlib.crc32(p) for p in parts], type=pa.int64()),
                    pa.array(np.arange(slot, slot + len(owner))),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "slot"]
                slot += len(owner)
                if with_ids:
                    columns.append(pa.array([np.frombuffer(p, dtype="<i4") for p in parts], type=pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def pieces(docs: DataFrame, tokenizer: str, longest: int = LONGEST, with_ids: bool = False) -> DataFrame:
    """Token pieces of whole texts; ``ids`` only if asked for. ``tokenizer`` is a file every executor has."""
    schema = PIECES + (", ids array<int>" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(_pieces(tokenizer, longest, with_ids), schema)


def best_fit(
    lengths: np.ndarray,
    longest: int = LONGEST,
    most_documents: int | None = None,
    most_attention: int | None = None,
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05),
    rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece.

    Capacities left out do not bind. ``rule``: ``norm`` takes the open sequence with the
    smallest weighted residual norm after placing, ``dot`` the one with the largest
    weighted dot product of residual and piece.
    """
    cap = np.array([longest, most_documents or longest, most_attention or longest * longest], dtype=np.int64)
    scale = np.array(weights) / cap.astype(np.float64) ** 2
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    state = np.zeros((1024, 3), dtype=np.int64)  # residuals that at least one open sequence has
    held = np.zeros(1024, dtype=np.int64)  # how many have them
    bins: list[list[int]] = []
    index: dict[tuple[int, ...], int] = {}
    n_bins = 0

    def put(residual: np.ndarray, members: list[int]) -> None:
        nonlocal state, held, bins, index
        if (residual <= 0).any():
            return  # nothing more fits
        key = tuple(residual.tolist())
        if key not in index:
            if len(bins) == len(state):
                alive = np.flatnonzero(held[: len(bins)])
                room = max(1024, 2 * len(alive))
                grown, counts = np.zeros((room, 3), dtype=np.int64), np.zeros(room, dtype=np.int64)
                grown[: len(alive)], counts[: len(alive)] = state[alive], held[alive]
                state, held, bins = grown, counts, [bins[k] for k in alive]
                index = {tuple(r): k for k, r in enumerate(state[: len(alive)].tolist())}
            index[key] = len(bins)
            state[len(bins)] = residual
            bins.append([])
        bins[index[key]].extend(members)
        held[index[key]] += len(members)

    a = 0
    while a < len(order):
        length = int(lengths[order[a]])
        b = a + int(np.searchsorted(-lengths[order[a:]], -length, side="right"))
        need = np.array([length, 1, length * length], dtype=np.int64)
        if (need > cap).any():
            raise ValueError("a piece is larger than a sequence's capacity")
        while a < b:
            left = state[: len(bins)]
            fits = np.flatnonzero((held[: len(bins)] > 0) & (left[:, 0] >= length) & (left[:, 1] >= 1) & (left[:, 2] >= need[2]))
            if len(fits) == 0:
                room = min(b - a, int((cap // need).min()))
                target, members = cap, list(range(n_bins, n_bins + (b - a) // room))
                n_bins += len(members)
            else:
                left = left[fits]
                score = ((left - need) ** 2 * scale).sum(axis=1) if rule == "norm" else -(left * need * scale).sum(axis=1)
                k = int(fits[int(np.argmin(score))])
                target = state[k].copy()
                room = min(b - a, int((target // need).min()))
                m = min(len(bins[k]), (b - a) // room)
                members, bins[k] = bins[k][:m], bins[k][m:]
                held[k] -= m
            rows = order[a : a + room * len(members)]
            sequence[rows] = np.repeat(members, room)
            offset[rows] = longest - int(target[0]) + np.tile(np.arange(room) * length, len(members))
            a += len(rows)
            put(target - need * room, members)
    return sequence, offset


def _pack(longest: int, limits: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ("_group",)):
            table = group.combine_chunks()
            table = table.take(pc.sort_indices(table, [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending"), ("slot", "ascending")]))
            sequence, offset = best_fit(table.column("length").to_numpy(), longest, **limits)
            first = table.column("_group")[0].as_py() << 24
            yield from (
                table.drop_columns(["_group", "slot"])
                .append_column("sequence_id", pa.array(sequence + first))
                .append_column("offset", pa.array(offset))
                .to_batches()
            )

    return run


def pack(found: DataFrame, longest: int = LONGEST, group: int = GROUP, **limits) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces; ``limits`` as in ``best_fit``."""
    n = found.count()
    spread = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "slot"), F.lit(max(1, -(-n // group))))
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.schema if f.name != "slot")
    return dealt(found.withColumn("_group", spread), "_group").mapInArrow(
        _pack(longest, limits), columns + ", sequence_id long, offset long"
    )


def packed(docs: DataFrame, tokenizer: str | None = None, longest: int = LONGEST, with_ids: bool = False, **limits) -> DataFrame:
    """Pieces of ``docs(doc_id, text)`` in sequences of at most ``longest`` tokens.

    A document is its ids and the end id; only a longer one is cut, into pieces of
    ``longest`` ids with the shorter one in front. A null text counts as empty and is a
    piece of the end id alone. Rows that repeat an id are documents of their own. Returns
    doc_id, piece, start, length, ids_crc32 (of the ids as little-endian unsigned 32-bit
    numbers), with ``with_ids`` the ids, sequence_id and offset.
    """
    found = pieces(docs, tokenizer or public_tokenizers.path("byte_bpe_50k.json"), longest, with_ids)
    return pack(materialize(found, "pieces"), longest, **limits)
