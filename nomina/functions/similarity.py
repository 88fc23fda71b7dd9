"""String similarities on a 0-100 scale.

Everything that is set or sort work on tokens is native. Only the longest common
subsequence (LCS) needs code Spark does not have: one Arrow function per batch that
advances the bit-parallel recurrence for all comparisons of the batch together.
"""

from __future__ import annotations

import difflib
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nomina.functions.text import WORD, strip, words

# Executors then need numpy and pyarrow only, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Scales of the blended ratio.
TOKEN_SCALE = 0.95
PARTIAL_SCALE = 0.90
FAR_PARTIAL_SCALE = 0.60
PARTIAL_FROM = 1.5
FAR_FROM = 8.0

MATCHERS = ("indel", "difflib")
RATIO_FIELDS = ("ratio", "partial_ratio", "token_sort_ratio", "token_set_ratio", "wratio")

_TABLE_CELLS = 1 << 21  # cells of one chunk's pattern table: 16 MiB
_COMPARISONS = 1 << 16  # comparisons advanced together

# --- LCS over batches of strings ------------------------------------------------


class _Texts:
    """Code points of a column of strings in one flat buffer."""

    def __init__(self, column: pa.Array):
        column = pc.fill_null(column, "").cast(pa.large_string())
        self.size = pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
        self.start = np.cumsum(self.size) - self.size
        joined = "".join(column.to_pylist())
        self.codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)

    def __len__(self) -> int:
        return len(self.size)


def _advance(table, pattern_row, symbols, start, size, words_per_row):
    """LCS of each pattern row with its slice ``symbols[start:start + size]``."""
    order = np.argsort(-size, kind="stable")
    pattern_row, start, size = pattern_row[order], start[order], size[order]
    state = np.full((words_per_row, len(order)), ~np.uint64(0))
    longest = int(size[0]) if len(size) else 0
    live_at = np.searchsorted(-size, -np.arange(longest), side="left")
    for j in range(longest):
        live = int(live_at[j])
        hits = table[pattern_row[:live], symbols[start[:live] + j]]
        carry = np.zeros(live, dtype=np.uint64)
        for w in range(words_per_row):
            v = state[w, :live]
            u = v & hits[:, w]
            total = v + u
            overflow = total < v
            total += carry
            overflow |= total < carry
            state[w, :live] = total | (v - u)
            carry = overflow.astype(np.uint64)
    matched = np.bitwise_count(~state).sum(axis=0, dtype=np.int64)
    out = np.empty(len(order), dtype=np.int64)
    out[order] = matched
    return out


def _lcs(patterns: _Texts, row: np.ndarray, texts: _Texts, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """LCS of ``patterns[row]`` with slices of the text buffer, for all comparisons."""
    result = np.zeros(len(row), dtype=np.int64)
    if not len(row) or not len(patterns.codes) or not len(texts.codes):
        return result
    alphabet, ids = np.unique(np.concatenate([patterns.codes, texts.codes]), return_inverse=True)
    pattern_ids, symbols = ids[: len(patterns.codes)], ids[len(patterns.codes) :]
    row_words = np.maximum((patterns.size[row] + 63) // 64, 1)
    for words_per_row in np.unique(row_words):
        members = np.flatnonzero(row_words == words_per_row)
        members = members[np.argsort(row[members], kind="stable")]
        rows_per_table = max(1, _TABLE_CELLS // (len(alphabet) * int(words_per_row)))
        used, local = np.unique(row[members], return_inverse=True)
        for first in range(0, len(used), rows_per_table):
            chunk = used[first : first + rows_per_table]
            table = np.zeros((len(chunk), len(alphabet), words_per_row), dtype=np.uint64)
            lengths, offsets = patterns.size[chunk], patterns.start[chunk]
            for i in range(int(lengths.max())):
                on = np.flatnonzero(lengths > i)
                # Every row is touched once per position, so plain indexing cannot lose a bit.
                table[on, pattern_ids[offsets[on] + i], i // 64] |= np.uint64(1) << np.uint64(i % 64)
            lo, hi = np.searchsorted(local, [first, first + len(chunk)])
            for at in range(lo, hi, _COMPARISONS):
                part = slice(at, min(at + _COMPARISONS, hi))
                pick = members[part]
                result[pick] = _advance(table, local[part] - first, symbols, start[pick], size[pick], int(words_per_row))
    return result


def _percent(matched, total):
    return np.rint(100.0 * (2.0 * matched / total)).astype(np.int64)


def _equal(a: _Texts, b: _Texts, same: np.ndarray, score: np.ndarray) -> np.ndarray:
    score = np.where((a.size == 0) | (b.size == 0), 0, score)
    return np.where(same, 100, score)


def _same(a: pa.Array, b: pa.Array) -> np.ndarray:
    return pc.equal(pc.fill_null(a, ""), pc.fill_null(b, "")).to_numpy(zero_copy_only=False)


def _ratios(a: pa.Array, b: pa.Array) -> np.ndarray:
    left, right = _Texts(a), _Texts(b)
    matched = _lcs(left, np.arange(len(left)), right, right.start, right.size)
    return _equal(left, right, _same(a, b), _percent(matched, np.maximum(left.size + right.size, 1)))


def _partial_ratios(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Best ratio of the shorter string with any equally long window of the longer one."""
    a, b = pc.fill_null(a, ""), pc.fill_null(b, "")
    swap = pc.greater(pc.utf8_length(a), pc.utf8_length(b))
    short, long = pc.if_else(swap, b, a), pc.if_else(swap, a, b)
    needle, hay = _Texts(short), _Texts(long)
    windows = np.where(needle.size > 0, hay.size - needle.size + 1, 0)
    row = np.repeat(np.arange(len(needle)), windows)
    shift = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    matched = _lcs(needle, row, hay, hay.start[row] + shift, needle.size[row])
    best = np.zeros(len(needle), dtype=np.int64)
    np.maximum.at(best, row, matched)
    return _equal(needle, hay, _same(a, b), _percent(best, np.maximum(2 * needle.size, 1)))


def _difflib_ratio(a: str, b: str) -> int:
    if a == b:
        return 100
    return int(round(100 * difflib.SequenceMatcher(None, a, b).ratio())) if a and b else 0


def _difflib_partial(a: str, b: str) -> int:
    if a == b:
        return 100
    if not a or not b:
        return 0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    anchors = {max(j - i, 0) for i, j, _ in difflib.SequenceMatcher(None, short, long).get_matching_blocks()}
    scores = [difflib.SequenceMatcher(None, short, long[s : s + len(short)]).ratio() for s in anchors]
    best = max(scores)
    return 100 if best > 0.995 else int(round(100 * best))


def _by_pair(score):
    def run(a: pa.Array, b: pa.Array) -> np.ndarray:
        pairs = zip(pc.fill_null(a, "").to_pylist(), pc.fill_null(b, "").to_pylist())
        return np.fromiter((score(x, y) for x, y in pairs), dtype=np.int64, count=len(a))

    return run


def _matcher(name: str):
    if name not in MATCHERS:
        raise ValueError(f"matcher must be one of {MATCHERS}, not {name!r}")
    if name == "indel":
        return _ratios, _partial_ratios
    return _by_pair(_difflib_ratio), _by_pair(_difflib_partial)


def _token_set(ratio, common, left, right) -> np.ndarray:
    scores = [ratio(common, left), ratio(common, right), ratio(left, right)]
    return np.maximum.reduce(scores)


def _length(column: pa.Array) -> np.ndarray:
    return pc.utf8_length(pc.fill_null(column, "")).to_numpy(zero_copy_only=False).astype(np.int64)


def _wratios(ratio, partial, p1, p2, sorted1, sorted2, common, left, right, token_sort, token_set) -> np.ndarray:
    n1, n2 = _length(p1), _length(p2)
    spread = np.maximum(n1, n2) / np.maximum(np.minimum(n1, n2), 1)
    base = ratio(p1, p2).astype(float)
    score = np.maximum(base, np.maximum(token_sort, token_set) * TOKEN_SCALE)
    far = np.flatnonzero((spread >= PARTIAL_FROM) & (np.minimum(n1, n2) > 0))
    if len(far):
        pick = pa.array(far)
        q1, q2, s1, s2, c, l, r = (x.take(pick) for x in (p1, p2, sorted1, sorted2, common, left, right))
        scale = np.where(spread[far] > FAR_FROM, FAR_PARTIAL_SCALE, PARTIAL_SCALE)
        score[far] = np.maximum.reduce(
            [
                base[far],
                partial(q1, q2) * scale,
                partial(s1, s2) * TOKEN_SCALE * scale,
                _token_set(partial, c, l, r) * TOKEN_SCALE * scale,
            ]
        )
    return np.where((n1 == 0) | (n2 == 0), 0, np.rint(score)).astype(np.int64)


def _ints(values: np.ndarray) -> pa.Array:
    return pa.array(values, type=pa.int32())


def _arrow(function, returns: str):
    # Marked nondeterministic so that a filter on the result does not run the function a second time.
    return F.arrow_udf(function, returns).asNondeterministic()


def _ratio_function(matcher: str):
    ratio, _ = _matcher(matcher)

    def ratio_of(a: pa.Array, b: pa.Array) -> pa.Array:
        return _ints(ratio(a, b))

    return _arrow(ratio_of, "int")


def _partial_function(matcher: str):
    _, partial = _matcher(matcher)

    def partial_of(a: pa.Array, b: pa.Array) -> pa.Array:
        return _ints(partial(a, b))

    return _arrow(partial_of, "int")


def _token_set_function(matcher: str):
    ratio, _ = _matcher(matcher)

    def token_set_of(p1: pa.Array, p2: pa.Array, common: pa.Array, left: pa.Array, right: pa.Array) -> pa.Array:
        empty = (_length(p1) == 0) | (_length(p2) == 0)
        return _ints(np.where(empty, 0, _token_set(ratio, common, left, right)))

    return _arrow(token_set_of, "int")


def _all_function(matcher: str, blended: bool):
    ratio, partial = _matcher(matcher)
    fields = RATIO_FIELDS if blended else RATIO_FIELDS[:-1]

    def ratios_of(
        a: pa.Array, b: pa.Array, p1: pa.Array, p2: pa.Array, sorted1: pa.Array, sorted2: pa.Array,
        common: pa.Array, left: pa.Array, right: pa.Array,
    ) -> pa.Array:
        empty = (_length(p1) == 0) | (_length(p2) == 0)
        token_sort = ratio(sorted1, sorted2)
        token_set = np.where(empty, 0, _token_set(ratio, common, left, right))
        columns = [ratio(a, b), partial(a, b), token_sort, token_set]
        if blended:
            columns.append(
                _wratios(ratio, partial, p1, p2, sorted1, sorted2, common, left, right, token_sort, token_set)
            )
        return pa.StructArray.from_arrays([_ints(c) for c in columns], names=list(fields))

    return _arrow(ratios_of, ", ".join(f"{name} int" for name in fields))


# --- Native preparation ----------------------------------------------------------

_LATIN_1_UPPER_HALF = "".join(map(chr, range(128, 256)))


def processed(c: Column) -> Column:
    """Default clean-up before token scores: U+0080-U+00FF dropped, non-words blank, lower case, stripped."""
    kept = F.translate(c, _LATIN_1_UPPER_HALF, "")
    return strip(F.lower(F.regexp_replace(kept, f"[^{WORD}]", " ")))


def _processed_words(p: Column) -> Column:
    """Tokens of a processed text, which has no white space but blanks."""
    return F.array_remove(F.split(p, " "), "")


def _joined(tokens: Column) -> Column:
    return F.array_join(F.sort_array(tokens), " ")


def _with_token_parts(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """Add the strings token scores compare, under names starting with ``_``.

    Step by step: each intermediate value has a column of its own, so Spark computes it
    once instead of once per use.
    """
    df = df.withColumns({"_p1": processed(a), "_p2": processed(b)})
    df = df.withColumns({"_w1": _processed_words(F.col("_p1")), "_w2": _processed_words(F.col("_p2"))})
    df = df.withColumns(
        {
            "_common": _joined(F.array_intersect("_w1", "_w2")),
            "_only1": _joined(F.array_except("_w1", "_w2")),
            "_only2": _joined(F.array_except("_w2", "_w1")),
        }
    )
    return df.withColumns({side: F.btrim(F.concat_ws(" ", "_common", only)) for side, only in (("_left", "_only1"), ("_right", "_only2"))})


# --- Public similarities ----------------------------------------------------------


def levenshtein(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b)


def ratio(a: Column, b: Column, matcher: str = "indel") -> Column:
    return _ratio_function(matcher)(a, b)


def partial_ratio(a: Column, b: Column, matcher: str = "indel") -> Column:
    return _partial_function(matcher)(a, b)


def token_sort_ratio(a: Column, b: Column, matcher: str = "indel") -> Column:
    return _ratio_function(matcher)(_joined(_processed_words(processed(a))), _joined(_processed_words(processed(b))))


def with_token_set_ratio(df: DataFrame, a: Column, b: Column, name: str = "token_set_ratio", matcher: str = "indel") -> DataFrame:
    """Add the token-set ratio; 0 when either side has no word characters."""
    parts = _with_token_parts(df, a, b)
    score = _token_set_function(matcher)("_p1", "_p2", "_common", "_left", "_right")
    return parts.select(*df.columns, score.alias(name))


def with_ratios(df: DataFrame, a: Column, b: Column, matcher: str = "indel", blended: bool = True) -> DataFrame:
    """Add all ratios; the strings cross to Python once. The blended one can be left out."""
    parts = _with_token_parts(df, a, b).withColumns({"_s1": _joined(F.col("_w1")), "_s2": _joined(F.col("_w2"))})
    call = _all_function(matcher, blended)
    scores = call(a, b, *(F.col(c) for c in ("_p1", "_p2", "_s1", "_s2", "_common", "_left", "_right")))
    names = RATIO_FIELDS if blended else RATIO_FIELDS[:-1]
    return parts.select(*df.columns, scores.alias("_ratios")).select(
        *df.columns, *(F.col(f"_ratios.{name}").alias(name) for name in names)
    )


def shared_share(w1: Column, w2: Column) -> Column:
    """Share of tokens found on the other side, both ways, repeats counted; NULL without any token."""

    def found(own: Column, other: Column) -> Column:
        return F.size(F.filter(own, lambda t: F.array_contains(other, t)))

    return F.try_divide((found(w1, w2) + found(w2, w1)).cast("double"), (F.size(w1) + F.size(w2)).cast("double"))


def subs_ratio(a: Column, b: Column) -> Column:
    """Share of tokens of two texts found on the other side, 0 to 1."""
    return shared_share(words(a), words(b))


def damerau_within(a: Column, b: Column, limit: int) -> Column:
    """Edit distance with adjacent transpositions (each place edited once) when at most ``limit``, else NULL."""
    if limit == 0:
        return F.when(a == b, 0)
    swaps = F.sequence(F.lit(1), F.greatest(F.length(a) - 1, F.lit(1)))

    def part(s: Column, start, size) -> Column:
        return F.substring(s, start, size)

    def rest(s: Column, start) -> Column:
        return F.substring(s, start, F.length(s))

    def crossed(i: Column, j: Column) -> Column:
        return (part(a, i, F.lit(1)) == part(b, j + 1, F.lit(1))) & (part(a, i + 1, F.lit(1)) == part(b, j, F.lit(1)))

    def one_swap(x: Column, y: Column) -> Column:
        return (F.length(x) == F.length(y)) & F.exists(
            F.sequence(F.lit(1), F.greatest(F.length(x) - 1, F.lit(1))),
            lambda i: F.concat(part(x, F.lit(1), i - 1), part(x, i + 1, F.lit(1)), part(x, i, F.lit(1)), rest(x, i + 2)) == y,
        )

    plain = F.levenshtein(a, b)
    if limit == 1:
        return F.when(a == b, 0).when((plain == 1) | ((plain == 2) & one_swap(a, b)), 1)

    def swap_and_edit(i: Column) -> Column:
        """A transposition at ``i`` and at most one more edit before or after it."""
        cases = []
        for drift in (-1, 0, 1):
            j = i + drift
            before = F.levenshtein(part(a, F.lit(1), i - 1), part(b, F.lit(1), j - 1))
            tail_a, tail_b = rest(a, i + 2), rest(b, j + 2)
            after = F.levenshtein(tail_a, tail_b)
            inside = (j >= 1) & (j + 1 <= F.length(b)) & (i + 1 <= F.length(a))
            fits = (before + after <= 1) | ((before == 0) & one_swap(tail_a, tail_b))
            cases.append(inside & crossed(i, j) & fits)
        return cases[0] | cases[1] | cases[2]

    return (
        F.when(a == b, 0)
        .when((plain == 1) | ((plain == 2) & one_swap(a, b)), 1)
        .when(plain == 2, 2)
        .when((plain <= 4) & F.exists(swaps, swap_and_edit), 2)
    )
