"""How filters interact: every order of five filters audited at once by wide packed counters.

A document is a mask of the filters that it fails. For each mask one big integer holds, in
fields of 64 bits, the outcome of all 600 steps (120 orders of five filters): kept, removed,
redundant, fails this filter only, and the removal again for good and for toxic documents.
Documents of a part with equal mask and labels are counted first (128 rows a part at most,
by partial aggregation), the integers are multiplied by those counts and summed per part, and
the sum is unpacked. A field counts documents of a part, so it cannot run over into the next
one below 2^63 documents; ``sum_fields`` refuses more.

Defined results: a null text is the empty text; a null source is the part "". A null doc_id
has no label, is smaller than none and has none smaller; repeated rows count each, and none
of them is smaller than the other. Several label rows of one document count as one that has
quality 1 or toxic 1 if any of them has. Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nomina.llm.common import text_key
from nomina.session import materialize

# Fixed values of the audit: filters in bit order, and the limits of A, B and C.
FILTERS = "ABCDE"
LEAST_WORDS = 50
LEAST_DISTINCT = 65
MOST_CAPITALS = 5
ODD = "[#$%&*|]"
GAP = r"[\x20\x09-\x0D]+"

ORDERS = ["".join(p) for p in permutations(FILTERS)]
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
FIELD_BYTES = 8
AUDIT = "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES) + ", shapley long"


def steps() -> tuple[np.ndarray, np.ndarray]:
    """The filter of each of the 600 steps, and the mask of the filters before it in its order."""
    order = np.array([[FILTERS.index(f) for f in o] for o in ORDERS])
    bits = 1 << order
    return order.reshape(-1), (np.cumsum(bits, axis=1) - bits).reshape(-1)


@lru_cache(maxsize=4 << len(FILTERS))
def packed(mask: int, good: bool, toxic: bool) -> int:
    """The outcome of every step for one document, one field per measure and step."""
    own, before = steps()
    bit = 1 << own
    fails, gone = (mask & bit) != 0, (mask & before) != 0
    removed = fails & ~gone
    outcome = (~fails & ~gone, removed, fails & gone, mask == bit, removed & good, removed & toxic)
    return int.from_bytes(np.concatenate(outcome).astype("<i8").tobytes(), "little")


def unpacked(total: int) -> np.ndarray:
    """(measures, steps) of a sum of packed outcomes."""
    size = len(MEASURES) * len(ORDERS) * len(FILTERS)
    return np.frombuffer(total.to_bytes(size * FIELD_BYTES, "little"), dtype="<i8").reshape(len(MEASURES), -1)


def sum_fields(counted: pa.Table) -> pa.Table:
    """One part's counts per mask and labels to its 600 rows."""
    rows = list(zip(*(counted.column(c).to_pylist() for c in ("mask", "good", "toxic", "n")), strict=True))
    if sum(n for *_, n in rows) >= 1 << (8 * FIELD_BYTES - 1):
        raise OverflowError("a part has more documents than a field can count")
    fields = unpacked(sum(n * packed(mask, good, toxic) for mask, good, toxic, n in rows))
    own, _ = steps()
    removed = np.zeros(len(FILTERS), dtype=np.int64)
    np.add.at(removed, own, fields[MEASURES.index("removed")])
    n = len(own)
    columns = [
        pa.array([counted.column("part")[0].as_py()] * n),
        pa.array(np.repeat(ORDERS, len(FILTERS)).tolist()),
        pa.array(np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS))),
        *(pa.array(f) for f in fields),
        pa.array(removed[own]),
    ]
    return pa.table(columns, names=["part", "filter_order", "step", *MEASURES, "shapley"])


def text_mask(text: Column) -> Column:
    """Bits of the filters that look at one text only: A to D."""
    words = F.array_remove(F.split(text, GAP), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    failing = (
        n < LEAST_WORDS,
        100 * distinct.cast("long") < LEAST_DISTINCT * n.cast("long"),
        100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > MOST_CAPITALS * F.length(text).cast("long"),
        text.rlike(ODD),
    )
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failing)), F.lit(0))


def masks(documents: DataFrame) -> DataFrame:
    """``(doc_id, part, mask)`` of every document, E included."""
    text = F.coalesce("text", F.lit(""))
    looked = documents.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text_mask(text).alias("alone"), text_key().alias("key"))
    looked = materialize(looked, "audited")  # texts are read once; from here on a row is some fifty bytes
    first = looked.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")).filter("copies > 1").drop("copies")
    repeats = F.when(F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)), 1 << FILTERS.index("E")).otherwise(0)
    return looked.join(first, "key", "left").select("doc_id", "part", (F.col("alone") + repeats).alias("mask"))


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """600 rows per source: what each step of each order of the filters keeps and removes."""
    told = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    told = told.filter("good or toxic")
    labelled = masks(documents).join(told, "doc_id", "left")
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")]
    counted = labelled.select("part", "mask", *flags).groupBy("part", "mask", "good", "toxic").agg(F.count("*").alias("n"))
    return counted.groupBy("part").applyInArrow(sum_fields, AUDIT)
