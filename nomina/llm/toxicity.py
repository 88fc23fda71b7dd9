"""Toxicity by compression distance: two zstandard dictionaries, one kind of text each.

Whole texts are cut into short windows. A window is compressed with a dictionary trained on
ordinary text and with one trained on toxic text; both share a base, so that the two
lengths differ only by what the kinds do not share. The largest and mean gains of a
document's windows are calibrated to a probability by a logistic regression.

Fitting uses bounded samples of the labelled rows (``SAMPLE``); scoring reads every window.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nomina.llm import textbytes as tb
from nomina.llm.common import crc_mod
from nomina.session import materialize

WINDOW = 64  # bytes, cut at a blank in the second half if there is one
LEVEL = 3
BASE_KB, OWN_KB = 32, 2
SAMPLE = {1: 4000, 0: 10000}  # most labelled documents of each kind that are used for fitting
SAMPLE_WINDOWS = 400  # most windows of a sampled document, evenly spaced, for dictionaries
TRAINING_WINDOWS = 80000  # most ordinary windows, drawn from the sample, that dictionaries are trained on
GRAM = 5  # bytes of the grams by which toxic training text is chosen
LEAST_ODDS = 3.0  # natural logarithm of how much more frequent in toxic documents a telling gram is
LEAST_SHARE = 0.01  # of the toxic documents that hold a telling gram
THRESHOLD = 0.3
HELD_OUT = (4, 2)  # rows whose crc32 has this remainder are never learnt from


def windows(text: bytes) -> list[bytes]:
    """The whole text in windows of at most WINDOW bytes."""
    out, at, n = [], 0, len(text)
    while at < n:
        end = min(n, at + WINDOW)
        if end < n:
            blank = text.rfind(b" ", at + WINDOW // 2, end)
            end = blank if blank > 0 else end
        out.append(text[at:end])
        at = end
    return out


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        dict_data=dictionary, level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
    )


def _grams(text: bytes) -> np.ndarray:
    """The GRAM bytes from each place on as numbers; 0 where a word ends inside them."""
    b = np.frombuffer(text, dtype=np.uint8)
    n = max(0, len(b) - GRAM + 1)
    out, whole = np.zeros(n, dtype=np.uint64), np.ones(n, dtype=bool)
    for i in range(GRAM if n else 0):
        out = (out << np.uint64(8)) | b[i : n + i]
        whole &= (i == 0) | ~tb.SPACE[b[i : n + i]]
    return np.where(whole, out, np.uint64(0))


def _frequencies(documents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Grams and the number of different documents that hold them."""
    found = [np.unique(_grams(d)) for d in sorted(set(documents))]
    return np.unique(np.concatenate(found) if found else np.zeros(0, dtype=np.uint64), return_counts=True)


def _telling_spans(document: bytes, telling: np.ndarray) -> bytes:
    """The bytes that telling grams cover, one after the other."""
    hit = np.isin(_grams(document), telling)
    covered = np.zeros(len(document), dtype=bool)
    for i in range(GRAM):
        covered[i : i + len(hit)] |= hit
    return np.frombuffer(document, dtype=np.uint8)[covered].tobytes()


def train(samples: list[list[bytes]], toxic: list[int], seed: int = 1) -> tuple[bytes, bytes]:
    """Contents of the toxic and the ordinary dictionary.

    Both begin with a base trained on ordinary windows, so that matches of ordinary text
    cost the same with either. The toxic one ends in what is trained on the bytes of toxic
    documents covered by grams far more frequent in them, the ordinary one in what is
    trained on other ordinary windows.
    """
    bad, good = ([b"".join(d) for d, y in zip(samples, toxic, strict=True) if y == k] for k in (1, 0))
    grams, n = _frequencies(bad)
    other, m = _frequencies(good)
    if len(other):
        at = np.minimum(np.searchsorted(other, grams), len(other) - 1)
        seen = np.where(other[at] == grams, m[at], 0)
    else:
        seen = np.zeros(len(grams))
    odds = np.log((n + 0.5) / (len(bad) + 1)) - np.log((seen + 0.5) / (len(good) + 1))
    telling = grams[(grams > 0) & (odds >= LEAST_ODDS) & (n >= max(8, LEAST_SHARE * len(bad)))]
    spans = [_telling_spans(d, telling) for d in bad]
    every = [w for d, y in zip(samples, toxic, strict=True) if y == 0 for w in d]
    rng = np.random.default_rng(seed)
    ordinary = [every[i] for i in rng.permutation(len(every))[:TRAINING_WINDOWS]]
    half = len(ordinary) // 2
    base = _dictionary(ordinary[:half], BASE_KB)
    return base + _dictionary(spans, OWN_KB, k=32, d=6), base + _dictionary(ordinary[half:], OWN_KB)


def _dictionary(samples: list[bytes], kb: int, **options: int) -> bytes:
    """Trained content; too few samples to train on are the content themselves."""
    samples = [s for s in samples if len(s) >= 8]
    try:
        return zstandard.train_dictionary(kb << 10, samples, **options).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-(kb << 10) :]


N_FEATURES = 11


def features(text: bytes, toxic: zstandard.ZstdCompressor, ordinary: zstandard.ZstdCompressor) -> list[float]:
    """What a document's windows gain from the toxic dictionary."""
    parts = windows(text)
    if not parts:
        return [0.0] * N_FEATURES
    gain = np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in parts], dtype=np.float64)
    top = -np.sort(-gain)
    large = [float((gain >= k).sum()) for k in (3, 4, 5, 6)]
    return [top[0], top[:2].mean(), top[:3].mean(), top[:5].mean(), gain.mean(), float(np.log1p(len(gain))), *large, large[2] ** 0.5]


@dataclass(frozen=True)
class Model:
    """Two dictionaries and a calibration: at most about 80 KB, whatever the input."""

    toxic: bytes
    ordinary: bytes
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def probability(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.centre) / self.spread, -8, 8)
        return 1 / (1 + np.exp(-np.clip(z @ self.weights[:-1] + self.weights[-1], -30, 30)))


def calibrate(rows: np.ndarray, toxic: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logistic regression by Newton steps, with the kinds weighted to their share among labels."""
    centre, spread = rows.mean(axis=0), rows.std(axis=0) + 1e-6
    x = np.c_[np.clip((rows - centre) / spread, -8, 8), np.ones(len(rows))]
    own = toxic.mean()
    weight = np.where(toxic == 1, share / own, (1 - share) / (1 - own))
    w = np.zeros(x.shape[1])
    ridge = np.diag([1.0] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - toxic)) + ridge @ w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian + 1e-9 * np.eye(len(w)), gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return centre, spread, w


def _lower(column: pa.Array) -> Iterator[bytes]:
    data, at = tb.as_bytes(column)
    raw = tb.LOWER[data].tobytes()
    return (raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True))


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    samples, toxic = [], []
    for batch in batches:
        for value, y in zip(batch.column("windows").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            samples.append(value)
            toxic.append(y)
    a, b = train(samples, toxic)
    yield pa.RecordBatch.from_arrays([pa.array([a], pa.binary()), pa.array([b], pa.binary())], names=["toxic", "ordinary"])


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text in _lower(batch.column("text")):
            parts = windows(text)
            out.append([parts[i] for i in np.unique(np.linspace(0, len(parts) - 1, SAMPLE_WINDOWS).astype(int))] if len(parts) > SAMPLE_WINDOWS else parts)
        yield pa.RecordBatch.from_arrays([batch.column("h"), batch.column("toxic"), pa.array(out, pa.list_(pa.binary()))], names=["h", "toxic", "windows"])


def _features(toxic: bytes, ordinary: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = compressor(toxic), compressor(ordinary)
        for batch in batches:
            rows = [features(text, a, b) for text in _lower(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(rows, pa.list_(pa.float64()))], names=["toxic", "features"])

    return run


def learn(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Fit on labelled rows outside the held-out part; None when a kind has no labelled document.

    The sample is drawn from the labels by a hash of the id before any text is read, so
    its size is bounded by SAMPLE; two thirds train the dictionaries, one third, other
    documents, calibrates. A document with contradictory labels counts as toxic.
    """
    usable = labels.filter((F.col("toxic").isin(0, 1)) & (crc_mod("doc_id", HELD_OUT[0]) != HELD_OUT[1]))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    drawn = None
    for kind, most in SAMPLE.items():
        part = usable.filter(F.col("toxic") == kind).withColumn("h", F.xxhash64("doc_id", F.lit(7))).orderBy("h", "doc_id").limit(most)
        drawn = part if drawn is None else drawn.unionByName(part)
    texts = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").select("doc_id", "h", "toxic", "text")
    texts = materialize(texts, "toxicity-sample")
    training, calibration = texts.filter("pmod(h, 3) > 0"), texts.filter("pmod(h, 3) = 0")
    kinds = {r["toxic"] for r in calibration.select("toxic").distinct().collect()}
    if kinds != {0, 1} or {r["toxic"] for r in training.select("toxic").distinct().collect()} != {0, 1}:
        return None
    cut = training.select("h", "toxic", "text").mapInArrow(_sample, "h long, toxic int, windows array<binary>")
    model = cut.repartition(1).sortWithinPartitions("h").mapInArrow(_train, "toxic binary, ordinary binary").collect()[0]
    rows = calibration.select("toxic", "text").mapInArrow(_features(bytes(model["toxic"]), bytes(model["ordinary"])), "toxic int, features array<double>")
    rows = rows.toPandas()
    fitted = calibrate(np.array(rows["features"].tolist()), rows["toxic"].to_numpy(), n[1] / (n[0] + n[1]))
    return Model(bytes(model["toxic"]), bytes(model["ordinary"]), *fitted)


def _score(model: Model | None, prior: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = (compressor(model.toxic), compressor(model.ordinary)) if model else (None, None)
        for batch in batches:
            if model:
                rows = np.array([features(text, a, b) for text in _lower(batch.column("text"))]).reshape(-1, N_FEATURES)
                scores = model.probability(rows)
            else:
                scores = np.full(batch.num_rows, prior)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names), pa.array(scores)], names=[*batch.schema.names, "score"])

    return run


def scored(docs: DataFrame, model: Model | None, prior: float = 0.0) -> DataFrame:
    """``docs`` with a column ``score`` from its ``text`` alone; a null text counts as empty."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(_score(model, prior), f"{schema}, score double")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per row of ``docs(doc_id, text)``.

    Only texts enter a score, and only rows that are not held out are learnt from. Null
    and empty texts get the score of a document without windows. Without labelled
    documents of both kinds every score is 0. A null id is not held out.
    """
    rows = scored(docs.select("doc_id", "text"), learn(docs, labels))
    held = F.coalesce(crc_mod("doc_id", HELD_OUT[0]) == HELD_OUT[1], F.lit(False))
    return rows.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
