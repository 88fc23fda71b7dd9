"""Repeated substrings by hashed anchors, in place of bucket-pointer refinement.

Buckets are hash values without an order, whole runs of strings are compared by one hash,
and there is one step of refinement, not a recursion; results are exact up to collisions
of 64-bit hashes. A 200-byte string is two 100-byte grams, the second at a later offset. Buckets of
100-byte grams are formed first, then refined by the bucket of the gram 100 bytes on:
a name of 200 bytes is made of two names of 100, which are reused and never recomputed.

Not every offset needs a bucket at first. Each 200-byte string holds 101 grams, and the
smallest of them (leftmost among equals) depends on the string alone, so equal strings
have their smallest gram at the same place. Only such anchors are put into buckets, about
one offset in fifty. Where an anchor's bucket has one member, none of its strings is
repeated. Otherwise the whole run of strings that share the anchor is named at once: equal
runs settle all their strings, and what is left is refined string by string.

Only buckets' names are counted, with partial counts before the shuffle, and joined back;
no bucket's members are ever gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomina.llm import textbytes as tb
from nomina.llm.common import with_possible
from nomina.session import materialize

LENGTH = 200
GRAM = LENGTH // 2
GRAMS = LENGTH - GRAM + 1  # in one string
_PLACE = np.uint64((1 << 28) - 1)  # a chunk has fewer offsets


def names(prefix: np.ndarray, n: int) -> np.ndarray:
    """Names of the ``GRAM`` bytes at each offset that has as many left."""
    starts = np.arange(max(0, n - GRAM + 1))
    return tb.spans(prefix, starts, starts + GRAM)


def refine(gram: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Names of ``LENGTH`` bytes: the bucket of a gram and the bucket ``GRAM`` bytes later."""
    return tb.mix(gram[starts] * np.uint64(0x9FB21C651E98DF25) + gram[starts + GRAM])


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=values.dtype)
    pad = -len(values) % width
    table = np.concatenate((values, np.full(pad, np.iinfo(values.dtype).max, dtype=values.dtype))).reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Grams' names, and of each anchor: text, offset in the chunk, first string, strings."""
    gram = names(tb.prefix_hashes(data), len(data))
    none = np.zeros(0, dtype=np.int64)
    if len(gram) < GRAMS:
        return gram, none, none, none, none
    at = (smallest((gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64), GRAMS) & _PLACE).astype(np.int64)
    string = np.arange(len(at))
    owner = np.searchsorted(offsets, string, side="right") - 1
    good = string + LENGTH <= offsets[owner + 1]
    string, at, owner = string[good], at[good], owner[good]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    return gram, owner[first], at[first], string[first], np.diff(np.append(first, len(at)))


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in tb.chunks(batch.column("text")):
            gram, owner, at, _, _ = anchors(data, offsets)
            keys = batch.column("k").slice(first, last - first).take(pa.array(owner))
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array((at - offsets[owner]).astype(np.int32)), pa.array(gram[at].view(np.int64))], names=["k", "at", "h"]
            )


def _listed(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    at = column.offsets.to_numpy()
    return at, column.flatten()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The run of strings of each anchor in a bucket of several: its name, first string and length."""
    for batch in batches:
        for first, last, data, offsets in tb.chunks(batch.column("text")):
            gram, owner, at, start, n = anchors(data, offsets)
            listed = batch.column("at").slice(first, last - first)
            ends = np.concatenate(([0], np.cumsum(listed.value_lengths().to_numpy(zero_copy_only=False))))
            wanted = listed.flatten().to_numpy().astype(np.int64) + np.repeat(offsets[:-1], np.diff(ends))
            keep = np.isin(at, wanted)
            owner, at, start, n = owner[keep], at[keep], start[keep], n[keep]
            name = tb.spans(tb.prefix_hashes(data), start, start + n - 1 + LENGTH) + (at - start).astype(np.uint64)
            rows = pa.array(owner + first)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("k").take(rows),
                    batch.column("doc_id").take(rows),
                    pa.array((start - offsets[owner]).astype(np.int32)),
                    pa.array(n.astype(np.int32)),
                    pa.array(gram[at].view(np.int64)),
                    pa.array(tb.mix(name).view(np.int64)),
                ],
                names=["k", "doc_id", "start", "n", "h", "run"],
            )


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names of all strings of the runs listed with a text."""
    for batch in batches:
        for first, last, data, offsets in tb.chunks(batch.column("text")):
            gram = names(tb.prefix_hashes(data), len(data))
            listed = batch.column("runs").slice(first, last - first)
            count = listed.value_lengths().to_numpy(zero_copy_only=False)
            flat = listed.flatten()
            start, n = (flat.field(i).to_numpy().astype(np.int64) for i in (0, 1))
            owner = np.repeat(np.arange(last - first), count)
            total = np.concatenate(([0], np.cumsum(n)))
            string = np.repeat(start + offsets[owner] - total[:-1], n) + np.arange(total[-1])
            rows = pa.array(np.repeat(owner, n) + first)
            single = flat.field(2).take(pa.array(np.repeat(np.arange(len(n)), n)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("k").take(rows),
                    batch.column("doc_id").take(rows),
                    pa.array((string - offsets[np.repeat(owner, n)]).astype(np.int32)),
                    single,
                    pa.array(refine(gram, string).view(np.int64) if len(string) else np.zeros(0, dtype=np.int64)),
                ],
                names=["k", "doc_id", "start", "single", "name"],
            )


def _cut(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = tb.as_bytes(batch.column("text"))
            listed = batch.column("removed")
            removed, spans, digest, kept = [], [], [], []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                text = data[a:b]
                ranges = listed[i].values if listed[i].is_valid else None
                gone, parts = 0, 0
                if ranges is not None and len(ranges):
                    edge = np.zeros(b - a + 1, dtype=np.int64)
                    np.add.at(edge, ranges.field(0).to_numpy(), 1)
                    np.add.at(edge, ranges.field(1).to_numpy(), -1)
                    inside = np.cumsum(edge[:-1]) > 0
                    gone, parts = int(inside.sum()), int(inside[0]) + int((inside[1:] & ~inside[:-1]).sum())
                    text = text[~inside]
                raw = text.tobytes()
                removed.append(gone)
                spans.append(parts)
                digest.append(hashlib.sha256(raw).hexdigest())
                kept.append(raw)
            columns = [batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string())]
            fields = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                columns.append(pa.array(kept, pa.binary()))
                fields.append("kept")
            yield pa.RecordBatch.from_arrays(columns, names=fields)

    return run


def _again(names_: DataFrame, key: str) -> DataFrame:
    """Names that occur more than once."""
    return names_.groupBy(key).agg(F.count("*").alias("c")).filter("c > 1").select(key)


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """``(k, doc_id, start, end)``: byte ranges covered by repeated strings, of ``docs(k, doc_id, text)``."""
    found = materialize(docs.select("k", "text").mapInArrow(_anchors, "k long, at int, h long"), "anchors")
    marked = found.join(_again(found, "h"), "h").groupBy("k").agg(F.collect_list("at").alias("at"))
    marked = materialize(marked, "marked")
    possible = with_possible(docs, marked, "k").filter("_possible").drop("_possible")
    runs = possible.join(marked, "k").select("k", "doc_id", "text", "at")
    runs = materialize(runs.mapInArrow(_runs, "k long, doc_id long, start int, n int, h long, run long"), "runs")
    # one member stands for each different run; runs alone in their anchor's bucket need no refining
    kinds = runs.groupBy("h", "run").agg(F.count("*").alias("c"), F.min(F.struct("k", "doc_id", "start", "n")).alias("one"))
    kinds = materialize(kinds, "run-kinds")
    mixed = kinds.groupBy("h").agg(F.count("*").alias("m")).filter("m > 1").select("h")
    open_runs = kinds.join(mixed, "h").select("one.*", (F.col("c") == 1).alias("single"))
    listed = materialize(open_runs.groupBy("k", "doc_id").agg(F.collect_list(F.struct("start", "n", "single")).alias("runs")), "open-runs")
    keyed = listed.select("k", F.col("doc_id").alias("_doc"), "runs")
    texts = with_possible(docs, listed, "k").filter("_possible").drop("_possible").dropDuplicates(["k", "doc_id"])
    strings = texts.join(keyed, "k").filter(F.col("doc_id").eqNullSafe(F.col("_doc"))).select("k", "doc_id", "text", "runs")
    strings = materialize(strings.mapInArrow(_strings, "k long, doc_id long, start int, single boolean, name long"), "strings")
    partial = strings.filter("single").join(_again(strings, "name"), "name").select("k", "doc_id", "start", F.lit(1).alias("n"))
    whole = runs.join(kinds.filter("c > 1").select("h", "run"), ["h", "run"], "left_semi").select("k", "doc_id", "start", "n")
    both = whole.unionByName(partial)
    return both.select("k", "doc_id", "start", (F.col("start") + F.col("n") - 1 + LENGTH).alias("end"))


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """One row per row of ``docs(doc_id, text)`` with what is left after removing repeats.

    A byte goes when a 200-byte string that also starts anywhere else, in the same or any
    other document, covers it; strings are judged on the input. Returns doc_id, n_bytes,
    n_removed, n_spans (maximal removed runs), kept_sha256 (lowercase hex), and with
    ``with_text`` the bytes that stay, which need not be valid UTF-8. A null text counts as
    empty. Repeated rows repeat each other's strings. Names are 64-bit hashes.
    """
    source = docs.select(F.xxhash64("doc_id", "text").alias("k"), "doc_id", "text")
    ranges = repeated_ranges(source)
    listed = ranges.groupBy("k", "doc_id").agg(F.collect_set(F.struct("start", "end")).alias("removed"))
    listed = materialize(listed, "removed")
    marked = with_possible(source, listed, "k")
    keyed = listed.select("k", F.col("doc_id").alias("_doc"), "removed")
    same = (marked["k"] == keyed["k"]) & F.col("doc_id").eqNullSafe(F.col("_doc"))
    hit = marked.filter("_possible").join(keyed, same, "left").select("doc_id", "text", "removed")
    none = marked.filter("not _possible").select("doc_id", "text", F.lit(None).cast(listed.schema["removed"].dataType).alias("removed"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")
    return hit.unionByName(none).mapInArrow(_cut(with_text), schema)
