"""Letters-and-digits words, which decontamination and lexical search share, on UTF-8 bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomina.llm import textbytes as tb
from nomina.session import materialize

# A word consists of 0-9, A-Z, a-z and whatever is not ASCII; A-Z are lower-cased.
SEPARATOR = np.ones(256, dtype=bool)
SEPARATOR[ord("0") : ord("9") + 1] = False
SEPARATOR[ord("A") : ord("Z") + 1] = False
SEPARATOR[ord("a") : ord("z") + 1] = False
SEPARATOR[0x80:] = False


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit names of all words, and each text's first word (rows + 1)."""
    starts, ends, at = tb.runs(data, offsets, SEPARATOR)
    return tb.spans(tb.prefix_hashes(tb.LOWER[data]), starts, ends), at


def word_numbers(hashes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """A word's number in the vocabulary, 0 for other words."""
    if len(vocabulary) == 0:
        return np.zeros(len(hashes), dtype=np.int64)
    found = np.searchsorted(vocabulary, hashes)
    found[found == len(vocabulary)] = 0
    return np.where(vocabulary[found] == hashes, found + 1, 0)


def text_blocks(items: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The distinct texts of the items in blocks of about ``block_bytes``, which bounds what is sent to tasks at once."""
    texts = materialize(items.select("text").filter(F.length("text") > 0).distinct(), "items")
    size = texts.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    n_blocks = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("text"), F.lit(n_blocks))
    return [texts.filter(block == i) for i in range(n_blocks)]


def fetched(block: DataFrame) -> pa.Array:
    """The texts of one block, in their order."""
    return block.orderBy("text").toArrow().column("text").combine_chunks()
