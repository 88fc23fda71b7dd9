"""Fuzzy line dedup: SimHash, pigeonhole blocks, edit similarity, one line of each group.

Lines are normalised (lower case, digits as 0, no punctuation, single blanks) and hashed;
equal ones are one class. A class has a 64-bit SimHash of its words and word pairs. Two
values at most three bits apart agree in all but three of any number of blocks, so values
are joined on all such choices of blocks: two of five, three of six, as many as it takes for
the bits of a choice to outnumber those that number the values by eight. Band mates at most three bits apart form clusters, clusters are cut
into blocks that meet pairwise, and inside two blocks edit similarity decides.

The first occurrence (smallest doc_id, then line) of a connected group stays in its
document; all others go, exact copies included.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from nomina.llm import textbytes as tb
from nomina.llm.common import block_pairs, dealt, forest, groups, ragged_binary, whole_groups, with_possible
from nomina.operators.cluster import components
from nomina.session import materialize

BITS = 3  # most bits that the SimHashes of linked lines differ in
SIMILARITY = 0.9  # least 1 - edits / length of the longer normalised line
SPARE_BITS = 8  # of a band key, beyond the bits that number the values: unlike values then hardly meet
BLOCK = 128  # lines, or SimHash values, of a block
FEW = 16  # values of a band up to which groups are compared together
FEW_EDITS = 16  # edits up to which the walk along diagonals is tried
PART_KEYS = 1 << 19  # band keys that are sorted together, about
HELD_KEYS = 1 << 18  # band keys that a task gathers before it deals them to parts

# What normalising makes of each byte; multi-byte characters stay as they are.
_NORMAL = tb.LOWER.copy()
_NORMAL[ord("0") : ord("9") + 1] = ord("0")
_NORMAL[tb.SPACE] = 0x20
_NORMAL[[b for b in range(0x21, 0x7F) if not chr(b).isalnum()]] = 0x20
_BLANK = np.zeros(256, dtype=bool)
_BLANK[0x20] = True
_NEWLINE = np.zeros(256, dtype=bool)
_NEWLINE[0x0A] = True
# The eight bits of each byte value as eight one-byte counters, and how many words' two values such counters hold.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).reshape(-1)
_MOST_ADDED = 127


def split_lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all lines (split at line feeds), and each text's first line (rows + 1)."""
    feeds = np.flatnonzero(data == 0x0A)
    starts = np.sort(np.concatenate((offsets[:-1], feeds + 1)), kind="stable")
    ends = np.sort(np.concatenate((offsets[1:], feeds)), kind="stable")
    count = np.searchsorted(feeds, offsets[1:]) - np.searchsorted(feeds, offsets[:-1]) + 1
    return starts, ends, np.concatenate(([0], np.cumsum(count)))


def _words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of the normalised lines, and each line's first word (lines + 1)."""
    normal = _NORMAL[data]
    normal[data == 0x0A] = 0x20
    begin, end, _ = tb.runs(normal, np.append(starts, len(data)), _BLANK)
    at = np.searchsorted(begin, np.append(starts, len(data) + 1))
    return tb.spans(tb.prefix_hashes(normal), begin, end), at


def line_features(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lines, 2) names of the word sequences and the SimHash of each line; lines without words are 0."""
    n = len(at) - 1
    names, simhash = np.zeros((n, 2), dtype=np.uint64), np.zeros(n, dtype=np.uint64)
    full = np.flatnonzero(np.diff(at))
    if len(full) == 0:
        return names, simhash
    place = (np.arange(len(words)) - np.repeat(at[:-1], np.diff(at))).astype(np.uint64)
    for i, key in enumerate((0xA24BAED4963EE407, 0x9FB21C651E98DF25)):
        value = tb.mix(words + tb.mix(place + np.uint64(1)) * np.uint64(key))
        names[full, i] = tb.mix(np.add.reduceat(value, at[full]))
    pair = words.copy()
    pair[1:] = tb.mix(words[1:] * np.uint64(0xD1B54A32D192ED03) + words[:-1])
    pair[at[full]] = words[at[full]]
    step = 1 << 17
    votes = np.zeros((len(full), 64), dtype=np.int64)
    lengths = np.diff(np.append(at[full], len(words)))
    line = np.repeat(np.arange(len(full)), lengths)
    part_of = place.astype(np.int64) // _MOST_ADDED
    for a in range(0, len(words), step):
        owner, part = line[a : a + step], part_of[a : a + step]
        first = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (part[1:] != part[:-1]))))
        lanes = _LANES[tb.mix(words[a : a + step]).view(np.uint8)] + _LANES[tb.mix(pair[a : a + step]).view(np.uint8)]
        sums = np.add.reduceat(lanes.reshape(-1, 8), first, axis=0).view(np.uint8).reshape(-1, 64)
        begin = np.flatnonzero(np.concatenate(([True], np.diff(owner[first]) != 0)))
        votes[owner[first[begin]]] += np.add.reduceat(sums, begin, axis=0, dtype=np.int64)
    majority = votes > lengths[:, None]
    simhash[full] = np.packbits(majority, axis=1, bitorder="little").view(np.uint64).reshape(-1)
    return names, simhash


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in tb.chunks(batch.column("text")):
            starts, ends, at = split_lines(data, offsets)
            words, word_at = _words(data, starts, ends)
            names, simhash = line_features(words, word_at)
            full = np.flatnonzero(np.diff(word_at))
            owner = np.repeat(np.arange(last - first), np.diff(at))
            rows = pa.array(owner[full] + first)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("k").take(rows),
                    batch.column("doc_id").take(rows),
                    pa.array((full - at[owner[full]]).astype(np.int32)),
                    ragged_binary(names[full].reshape(-1), np.arange(len(full) + 1) * 2),
                    pa.array(simhash[full].view(np.int64)),
                ],
                names=["k", "doc_id", "line", "name", "simhash"],
            )


def n_blocks(n_values: int) -> int:
    """Blocks that 64 bits are cut into; all but BITS of them are the bits of a key."""
    needed = n_values.bit_length() + SPARE_BITS
    return next((b for b in range(BITS + 2, 4 * BITS) if 64 // b * (b - BITS) >= needed), 4 * BITS)


def _block_keys(blocks: int):
    """Task that gives a value's bits in each choice of all but BITS blocks, with the choice's number, and the value."""
    keys_of = _keys_of(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = batch.column("simhash").to_numpy().view(np.uint64)
            keys = keys_of(value)
            yield pa.RecordBatch.from_pydict(
                {"band": pa.array(keys.reshape(-1).view(np.int64)), "simhash": pa.array(np.tile(value.view(np.int64), len(keys)))}
            )

    return run


def _keys_of(blocks: int):
    """Function that gives the band keys (choices, values) of values."""
    cuts = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    choices = [np.uint64(sum(chosen)) for chosen in combinations(masks, blocks - BITS)]
    marks = [np.uint64((i + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) for i in range(len(choices))]
    return lambda value: np.stack([tb.mix((value & m) + mark) for m, mark in zip(choices, marks, strict=True)])


def _key_parts(blocks: int, parts: int):
    """Task that gives all band keys of its values as arrays: those of one part of the key space in a row."""
    keys_of = _keys_of(blocks)
    bounds = np.array([((i << 64) // parts - (1 << 63)) for i in range(1, parts)], dtype=np.int64)

    def dealt_keys(held: list[np.ndarray]) -> pa.RecordBatch:
        keys = np.sort(np.concatenate(held).view(np.int64))
        at = np.concatenate(([0], np.searchsorted(keys, bounds), [len(keys)]))
        some = np.flatnonzero(np.diff(at))
        rows = ragged_binary(keys, np.append(at[some], len(keys)))
        return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), rows], names=["part", "keys"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(keys_of(batch.column("simhash").to_numpy().view(np.uint64)).reshape(-1))
            n += len(held[-1])
            if n >= HELD_KEYS:
                yield dealt_keys(held)
                held, n = [], 0
        if n:
            yield dealt_keys(held)

    return run


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of a task's parts, each part's sorted."""
    for part in groups(batches, ("part",)):
        keys = np.sort(np.concatenate([np.frombuffer(row.as_buffer(), np.int64) for row in part.column("keys")]))
        yield pa.RecordBatch.from_arrays([pa.array(keys)], names=["band"])


def _repeated_in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _repeated(_in_order(batches))


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys that come more than once, and how often, of a task's keys in order."""
    last, held = 0, 0
    for batch in batches:
        band = batch.column("band").to_numpy()
        if not len(band):
            continue
        first = np.flatnonzero(np.concatenate(([True], band[1:] != band[:-1])))
        keys, n = band[first], np.diff(np.append(first, len(band)))
        if held and keys[0] == last:
            n[0] += held
        elif held:
            keys, n = np.append(last, keys), np.append(held, n)
        last, held = int(keys[-1]), int(n[-1])  # may go on in the next batch
        several = np.flatnonzero(n[:-1] > 1)
        yield pa.RecordBatch.from_arrays([pa.array(keys[several]), pa.array(n[several])], names=["band", "n"])
    if held > 1:
        yield pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array([held], pa.int64())], names=["band", "n"])


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links that connect the values of each two blocks that differ in at most BITS bits.

    Groups of up to FEW values are compared together, each value with those that follow it;
    a larger group gives a spanning forest.
    """
    for part, first in whole_groups(batches, ("band", "i", "j")):
        value = part.column("simhash").to_numpy().view(np.uint64)
        size = np.diff(first)
        few = np.repeat(np.where(size <= FEW, np.arange(len(size)), -1), size)
        links = []
        for d in range(1, min(FEW, int(size.max(initial=0)))):
            a = np.flatnonzero((few[d:] == few[:-d]) & (few[d:] >= 0))
            a = a[np.bitwise_count(value[a] ^ value[a + d]) <= BITS]
            links.append(np.c_[a, a + d])
        for g in np.flatnonzero(size > FEW).tolist():
            own = value[first[g] : first[g + 1]]
            a, b = np.nonzero(np.triu(np.bitwise_count(own[:, None] ^ own[None, :]) <= BITS, 1))
            links.append(np.array(forest(len(own), a, b), dtype=np.int64).reshape(-1, 2) + first[g])
        ends = value[np.concatenate(links)].view(np.int64) if links else np.zeros((0, 2), dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0].copy()), pa.array(ends[:, 1].copy())], names=["name_1", "name_2"])


def _grouped_edges(batches, keys, linked, kind):
    found: list[tuple] = []
    for group in groups(batches, keys):
        if group.num_rows > 1:
            names, a, b = linked(group)
            found += [(names[x], names[y]) for x, y in forest(len(names), a, b)]
        if len(found) > 4096:
            yield _edges(found, kind)
            found = []
    yield _edges(found, kind)


def _edges(found: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], type=kind) for i in (0, 1)], names=["name_1", "name_2"])


def edit_within(a: bytes, b: bytes, most: int) -> bool:
    """True if at most ``most`` byte insertions, deletions and substitutions turn a into b.

    Bytes that one has more often need an edit each; common ends are cut off; then come
    furthest-reaching diagonals (Ukkonen), whose work grows with the square of the edits, for
    up to FEW_EDITS, and bit-parallel columns (Myers) beyond that.
    """
    if abs(len(a) - len(b)) > most:
        return False
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    more = np.bincount(x, minlength=256) - np.bincount(y, minlength=256)
    if max(int(more[more > 0].sum()), -int(more[more < 0].sum())) > most:
        return False
    n = min(len(x), len(y))
    head = np.flatnonzero(x[:n] != y[:n])
    cut = int(head[0]) if len(head) else n
    x, y = x[cut:], y[cut:]
    n = min(len(x), len(y))
    tail = np.flatnonzero(x[len(x) - n :][::-1] != y[len(y) - n :][::-1])
    cut = int(tail[0]) if len(tail) else n
    a, b = x[: len(x) - cut].tobytes(), y[: len(y) - cut].tobytes()
    if not a or not b:
        return len(a) + len(b) <= most
    goal = len(b) - len(a)
    reach = {0: _slide(a, b, 0, 0)}
    for edits in range(min(most, FEW_EDITS) + 1):
        if edits:
            wider = {}
            for d in range(-edits, edits + 1):
                i = max(reach.get(d, -2) + 1, reach.get(d + 1, -2) + 1, reach.get(d - 1, -2))
                if i < 0 or i > len(a) or i + d > len(b) or i + d < 0:
                    i = min(i, len(a), len(b) - d)
                    if i < 0 or i + d < 0:
                        continue
                wider[d] = _slide(a, b, i, i + d)
            reach = wider
        if reach.get(goal, -1) >= len(a):
            return True
    return most > FEW_EDITS and _columns(a, b, most)


def _columns(a: bytes, b: bytes, most: int) -> bool:
    """edit_within by columns of the distance table: their steps down are the bits of two whole numbers."""
    every, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    letters = np.frombuffer(a, np.uint8)
    places = {int(c): int.from_bytes(np.packbits(letters == c, bitorder="little").tobytes(), "little") for c in np.unique(letters)}
    up, down, distance = every, 0, len(a)
    for left, c in zip(range(len(b) - 1, -1, -1), b, strict=True):
        equal = places.get(c, 0)
        across = (((equal & up) + up) ^ up) | equal
        plus, minus = (down | ~(across | up)) & every, up & across
        distance += bool(plus & top) - bool(minus & top)
        if distance - left > most:
            return False
        plus, minus = (plus << 1 | 1) & every, minus << 1 & every
        keep = equal | down
        up, down = (minus | ~(keep | plus)) & every, plus & keep
    return distance <= most


def _slide(a: bytes, b: bytes, i: int, j: int) -> int:
    """The end in a of the run of equal bytes from a[i], b[j] on."""
    step = 16
    while i < len(a) and j < len(b):
        if a[i : i + step] == b[j : j + step]:
            run = min(step, len(a) - i, len(b) - j)
            i, j = i + run, j + run
            step = min(step * 2, 4096)
        elif step > 1:
            step //= 2
        else:
            break
    return i


def _similar(group: pa.Table) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    names, lines = group.column("name").to_pylist(), group.column("normal").to_pylist()
    value = group.column("simhash").to_numpy().view(np.uint64)
    a, b = np.nonzero(np.triu(np.bitwise_count(value[:, None] ^ value[None, :]) <= BITS, 1))
    parent = np.arange(len(names))
    keep = np.zeros(len(a), dtype=bool)
    # links of lines that differ least come first: once connected, the others need no look
    order = np.argsort(np.bitwise_count(value[a] ^ value[b]), kind="stable")
    a, b = a[order], b[order]
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        if parent[x] == parent[y]:
            continue  # already connected
        most = int((1 - SIMILARITY) * max(len(lines[x]), len(lines[y])) + 1e-9)
        if edit_within(lines[x], lines[y], most):
            keep[i] = True
            parent[parent == parent[y]] = parent[x]
    return names, a[keep], b[keep]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from _grouped_edges(batches, ("cluster", "i", "j"), _similar, pa.binary())


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The normalised texts of the lines asked for."""
    for batch in batches:
        data, offsets = tb.as_bytes(batch.column("text"))
        out = []
        for i, line in enumerate(batch.column("line").to_pylist()):
            raw = data[offsets[i] : offsets[i + 1]].tobytes().split(b"\n")[line]
            out.append(b" ".join(_NORMAL[np.frombuffer(raw, np.uint8)].tobytes().split(b" ")))
        clean = [b" ".join(x.split()) for x in out]
        yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(clean, pa.binary())], names=["name", "normal"])


def _drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, gone = batch.column("text").to_pylist(), batch.column("gone").to_pylist()
        kept, total, removed = [], [], []
        for text, out in zip(texts, gone, strict=True):
            lines = [] if text is None else text.split("\n")
            total.append(len(lines))
            out = set(out or ())
            removed.append(len(out))
            kept.append(text if not out else "\n".join(x for i, x in enumerate(lines) if i not in out))
        rest = [batch.column(c) for c in batch.schema.names if c not in ("text", "gone")]
        names = [c for c in batch.schema.names if c not in ("text", "gone")]
        yield pa.RecordBatch.from_arrays(
            [*rest, pa.array(kept, pa.string()), pa.array(total, pa.int64()), pa.array(removed, pa.int64())], names=[*names, "text", "n_lines", "n_removed"]
        )


def line_classes(lines: DataFrame) -> DataFrame:
    """``(name, first, simhash, c)``: equal normalised lines, the first of them and their number."""
    first = F.min(F.struct("doc_id", "k", "line")).alias("first")
    return lines.groupBy("name").agg(first, F.first("simhash").alias("simhash"), F.count("*").alias("c"))


def line_groups(source: DataFrame, classes: DataFrame) -> DataFrame:
    """``(name, group)`` of the classes of lines that are linked with another class."""
    classes = classes.drop("c")
    values = classes.groupBy("simhash").agg(F.count("*").alias("c"))
    # The count of stored classes, at least that of values, comes from the files' footers.
    n_classes = classes.count()
    blocks = n_blocks(n_classes)
    bands = values.select("simhash").mapInArrow(_block_keys(blocks), "band long, simhash long")
    # Nearly all keys differ: they are shuffled as arrays, a row for a part of them, and sorted and counted as such.
    parts = max(int(source.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_classes * comb(blocks, BITS) // PART_KEYS + 1)
    keys = values.select("simhash").mapInArrow(_key_parts(blocks, parts), "part int, keys binary")
    in_parts = keys.repartition(parts, "part").sortWithinPartitions("part")
    several = materialize(in_parts.mapInArrow(_repeated_in_parts, "band long, n long"), "line-bands")
    shared_bands = with_possible(bands, several, "band").filter("_possible").select("band", "simhash")
    met = block_pairs(shared_bands.join(several, "band"), "band", F.ceil(F.col("n") / BLOCK), "simhash").select("band", "i", "j", "simhash")
    close = materialize(dealt(met, "band", "i", "j").mapInArrow(_close, "name_1 long, name_2 long").distinct(), "close-simhashes")
    clusters = components(close).select(F.col("name").alias("simhash"), F.col("cluster_id").alias("cluster"))
    shared = values.filter("c > 1").select("simhash")
    candidates = clusters.join(shared.withColumnRenamed("simhash", "s"), F.col("simhash") == F.col("s"), "full")
    candidates = candidates.select(F.coalesce("simhash", "s").alias("simhash"), F.coalesce("cluster", "simhash", "s").alias("cluster"))
    members = materialize(classes.join(candidates, "simhash"), "line-candidates")
    wanted = members.select("name", "first.k", F.col("first.line").alias("line"))
    texts = with_possible(source.select("k", "text"), wanted, "k").filter("_possible").select("k", "text").join(wanted, "k")
    normal = texts.select("name", "text", "line").mapInArrow(_texts, "name binary, normal binary").dropDuplicates(["name"])
    sizes = members.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).alias("n"))
    placed = block_pairs(members.join(normal, "name").join(sizes, "cluster"), "cluster", F.col("n"), "name")
    placed = placed.select("cluster", "i", "j", "name", "simhash", "normal")
    edges = materialize(dealt(placed, "cluster", "i", "j").mapInArrow(_verify, "name_1 binary, name_2 binary"), "similar-lines")
    return components(edges).select("name", F.col("cluster_id").alias("group"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, and columns n_lines and n_removed.

    Lines without a letter or digit are never removed. A null text stays null with no
    lines; a text all of whose lines are removed becomes empty. Of rows that repeat id and
    text, lines count as those of one document, and each such row loses the same lines.
    Among lines of one document id the smaller line number is first. Other columns pass
    through; n_lines and n_removed replace columns of that name.
    """
    others = [c for c in docs.columns if c not in ("text", "n_lines", "n_removed")]
    # In one struct, so that no name of theirs meets one of the steps below.
    rest = F.struct(*(F.col(f"`{c}`") for c in others)).alias("rest")
    source = docs.select(rest, "doc_id", "text", F.xxhash64("doc_id", "text").alias("k"))
    lines = materialize(
        source.select("k", "doc_id", "text").mapInArrow(_lines, "k long, doc_id long, line int, name binary, simhash long"), "lines"
    )
    classes = materialize(line_classes(lines), "line-classes")
    grouped = line_groups(source, classes)
    # Groups of several classes get the group's name; the other lines keep their own.
    named = classes.select("name", "first", "c").join(grouped, "name", "left").withColumn("group", F.coalesce("group", "name"))
    firsts = named.groupBy("group").agg(F.min("first").alias("stays"), F.sum("c").alias("c")).filter("c > 1")
    stays = materialize(named.join(firsts.drop("c"), "group").select("name", "stays"), "repeated-lines")
    here = F.struct("doc_id", "k", "line")
    repeated = with_possible(lines.select("k", "doc_id", "line", "name"), stays, "name").filter("_possible")
    gone = repeated.join(stays, "name").filter(~here.eqNullSafe(F.col("stays"))).groupBy("k").agg(F.collect_set("line").alias("gone"))
    gone = materialize(gone, "lines-to-remove")
    marked = with_possible(source, gone, "k")
    hit = marked.filter("_possible").join(gone, "k", "left").select("rest", "text", "gone")
    clean = marked.filter("not _possible").select("rest", "text", F.lit(None).cast("array<int>").alias("gone"))
    added = [StructField("text", StringType()), StructField("n_lines", LongType()), StructField("n_removed", LongType())]
    dropped = hit.unionByName(clean).mapInArrow(_drop, StructType([source.schema["rest"], *added]))
    return dropped.select("rest.*", "text", "n_lines", "n_removed")
