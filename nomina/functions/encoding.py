"""Character vocabularies and fixed-length encodings."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ENCODED_LENGTH = 255  # fixed value: ids per name


def characters(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), ""), lambda ch: ch != "")


def build_vocabulary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct lower-cased characters of the columns with dense ids in code point order.

    Characters are made distinct per task before the shuffle; what is ranked in one
    place is bounded by the number of Unicode characters, never by the rows.
    """
    chars = (
        df.select(F.explode(F.array(*columns)).alias("name"))
        .select(F.explode(F.array_distinct(characters(F.col("name")))).alias("ch"))
        .distinct()
        .withColumn("cp", F.ascii("ch"))
    )
    return chars.select("ch", (F.row_number().over(Window.orderBy("cp")) - 1).alias("id"))


def max_length(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(F.max(F.greatest(*(F.length(c) for c in columns))).alias("max_length"))


class Encoder:
    """Maps names to arrays of character ids; the padding id is the largest id plus one.

    The vocabulary is small (distinct characters), so it travels as one literal array
    indexed by code point: one array access per character.
    """

    def __init__(self, vocabulary: DataFrame, length: int = ENCODED_LENGTH, on_long: str = "error", unknown_id: int | None = None):
        if on_long not in ("error", "truncate"):
            raise ValueError("on_long must be 'error' or 'truncate'")
        self.ids = {row.ch: row.id for row in vocabulary.collect()}
        self.length = length
        self.on_long = on_long
        self.unknown_id = unknown_id
        self.padding_id = max(self.ids.values(), default=-1) + 1
        by_code_point = ["-1"] * (max((ord(ch) for ch in self.ids), default=0) + 1)
        for ch, i in self.ids.items():
            by_code_point[ord(ch)] = str(i)
        self._by_code_point = ",".join(by_code_point)

    def _id(self, ch: Column) -> Column:
        table = F.split(F.lit(self._by_code_point), ",").cast("array<int>")  # folds to one constant
        known = F.nullif(F.get(table, F.ascii(ch)), F.lit(-1))
        if self.unknown_id is not None:
            return F.coalesce(known, F.lit(self.unknown_id))
        return F.coalesce(known, F.raise_error(F.concat(F.lit("character not in the vocabulary: "), ch)).cast("int"))

    def encode(self, name: Column) -> Column:
        ids = F.transform(characters(name), self._id)
        padded = F.slice(F.concat(ids, F.array_repeat(F.lit(self.padding_id), self.length)), 1, self.length)
        if self.on_long == "truncate":
            return padded
        return F.when(F.length(name) <= self.length, padded).otherwise(
            F.raise_error(F.lit(f"name longer than {self.length} characters")).cast("array<int>")
        )

    def encode_pair(self, name_1: Column, name_2: Column) -> Column:
        return F.concat(self.encode(name_1), self.encode(name_2))

    def inverse(self) -> Column:
        """Map from id back to character."""
        forward = F.from_json(F.lit(_json(self.ids)), "map<string,int>")
        return F.map_from_arrays(F.map_values(forward), F.map_keys(forward))

    def decode(self, ids: Column) -> Column:
        table = self.inverse()
        return F.array_join(F.transform(F.filter(ids, lambda i: i != self.padding_id), lambda i: F.element_at(table, i)), "")


def _json(ids: dict[str, int]) -> str:
    return json.dumps(ids)
