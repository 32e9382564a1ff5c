"""Toxicity by compression distance: what a dictionary of toxic wording saves on each window.

Two zstandard dictionaries are trained, on ordinary windows and on toxic wording (words of toxic texts
whose beginnings are rare in ordinary ones, so that the few bytes of the dictionary go to what tells
the classes apart). A window is compressed with the ordinary dictionary, and with the toxic one before
it; the difference in length is what toxic wording explains and ordinary wording does not. A document
is scored from its windows by a logistic curve, calibrated on documents held out of the dictionaries.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import pieces

WINDOW = 64  # bytes
LEVEL = 9
ORDINARY_BYTES, TOXIC_BYTES = 32 << 10, 2 << 10
SAMPLE_ROWS = 4000  # labelled documents of each class that a model is fitted on
SAMPLE_CHARS = 50_000  # longer documents are left out of that sample (never out of scoring)
SAMPLE_TOTAL = 16_000_000  # characters of each class in that sample: whole documents in the order of the same hash
SAMPLE_WINDOWS = 30_000  # ordinary windows of that sample, by crc32, that the ordinary dictionary is trained on
BEGINNINGS = (4, 5, 6, 7, 8, 9, 10)
FOLDS = 3
THRESHOLD = 0.7


def windows(text: str | bytes | None) -> list[bytes]:
    """The whole text, A-Z in lower case and single-spaced, in runs of words of about ``WINDOW`` bytes."""
    data = text.encode() if isinstance(text, str) else text or b""
    data = b" " + b" ".join(data.lower().split())
    out, start = [], 0
    while len(data) - start > WINDOW:
        stop = data.rfind(b" ", start + 1, start + WINDOW + 1)
        stop = stop if stop > start else start + WINDOW
        out.append(data[start:stop])
        start = stop
    return [*out, data[start:]]


def _trained(size: int, samples: list[bytes]) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on
        return b"".join(samples)[-size:]


def _telling(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Words of toxic texts with a beginning that is much more frequent there, as often as they occur."""
    found = [Counter(), Counter()]
    for counts, texts in zip(found, (ordinary, toxic)):
        for text in texts:
            counts.update({word[:k] for word in text.split() for k in BEGINNINGS})
    tells = set()
    for start, n in found[1].items():
        odds = (n + 0.5) / (len(toxic) + 1) * (len(ordinary) + 1) / (found[0][start] + 0.5)
        if n >= 3 and odds > 12:
            tells.add(start)
    return [word for text in toxic for word in text.split() if any(word[:k] in tells for k in BEGINNINGS)]


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...] = ()
    _compressors: tuple | None = None

    def __getstate__(self):
        return {**self.__dict__, "_compressors": None}

    @staticmethod
    def of(toxic: list[str], ordinary: list[str]) -> Model:
        toxic = [b" ".join(t.encode().lower().split()) for t in toxic]
        ordinary = [b" ".join(t.encode().lower().split()) for t in ordinary]
        spread = [w for t in ordinary for w in windows(t)]
        spread = sorted(spread, key=zlib.crc32)[:SAMPLE_WINDOWS]
        return Model(_trained(ORDINARY_BYTES, spread), _trained(TOXIC_BYTES, [b" " + w for w in _telling(toxic, ordinary)]))

    def features(self, text) -> list[float]:
        if self._compressors is None:
            self._compressors = tuple(
                zstandard.ZstdCompressor(
                    dict_data=zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                    level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False,
                ).compress if data else zstandard.ZstdCompressor(level=LEVEL, write_content_size=False).compress
                for data in (self.ordinary, self.toxic + self.ordinary)
            )
        plain, with_toxic = self._compressors
        saved = np.array([len(plain(w)) - len(with_toxic(w)) for w in windows(text)], float)
        saved[::-1].sort()
        top = saved[:3]
        return [1.0, saved[0], top.sum() / 3, saved.mean(), float((saved > 2).mean()), math.log1p(len(saved)),
                float(np.maximum(saved - 2, 0).sum() / math.sqrt(len(saved)))]

    def score(self, text) -> float:
        z = float(np.dot(self.features(text), self.weights))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def _logistic(x: np.ndarray, y: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Ridge-penalised logistic weights by Newton steps, on standardised features; a sample row stands for ``rows`` rows."""
    mean, scale = x[:, 1:].mean(axis=0), x[:, 1:].std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x[:, 1:] - mean) / scale])
    w = np.zeros(z.shape[1])
    ridge = np.diag([1e-6] + [1.0] * (z.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (rows * p * (1 - p) + 1e-9)[:, None]) + ridge, z.T @ (rows * (y - p)) - ridge @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    plain = w[1:] / scale
    return np.array([w[0] - plain @ mean, *plain])


def fit(rows: list[tuple[int, str, int]], totals: dict[int, int] | None = None) -> Model:
    """A model from labelled (doc_id, text, toxic) rows, a sample of as many of each class as ``totals`` (default: all).

    Every fold's documents get features from dictionaries of the other folds; the curve is fitted on
    these, and shifted so that ``THRESHOLD`` lies where the F1 of these documents is best. In both a
    document counts as many times as its class has documents for each of the sample. Without documents of both classes the score is the constant share of toxic ones.
    """
    rows = sorted(rows)
    fold = [zlib.crc32(f"fold {doc_id}".encode()) % FOLDS for doc_id, *_ in rows]
    kinds = [[t for _, t, x in rows if x == kind] for kind in (1, 0)]
    counts = {kind: (totals or {}).get(kind, len(texts)) for kind, texts in zip((1, 0), kinds)}
    if min(map(len, kinds)) < 6:
        share = (counts[1] + 0.5) / (counts[0] + counts[1] + 2)
        return Model(b"", b"", (math.log(share / (1 - share)), 0, 0, 0, 0, 0, 0))
    features = [[0.0]] * len(rows)
    for k in range(FOLDS):
        rest = [r for r, f in zip(rows, fold) if f != k]
        model = Model.of([t for _, t, x in rest if x == 1], [t for _, t, x in rest if x == 0])
        for i, (_, text, _) in enumerate(rows):
            if fold[i] == k:
                features[i] = model.features(text)
    x, y = np.array(features), np.array([t for *_, t in rows], float)
    each = np.where(y == 1, counts[1] / len(kinds[0]), counts[0] / len(kinds[1]))
    weights = _logistic(x, y, each)
    z = x @ weights
    order = np.argsort(-z, kind="stable")
    hits = np.cumsum((each * y)[order])
    f1 = 2 * hits / (np.cumsum(each[order]) + counts[1])
    best = int(np.argmax(f1))
    edge = (z[order[best]] + z[order[min(best + 1, len(y) - 1)]]) / 2
    weights[0] += math.log(THRESHOLD / (1 - THRESHOLD)) - edge
    final = Model.of(*kinds)
    final.weights = tuple(float(w) for w in weights)
    return final


def held_out(doc_id):
    """Whether a document's label is never learned from: crc32 of its id as text has remainder 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_total: int = SAMPLE_TOTAL
) -> Model:
    """A model from at most ``sample_rows`` labelled documents of each class, taken by a hash of the id.

    Those of a class hold at most ``sample_total`` characters together: the rows in the order of that hash
    up to this sum. Rows with a null id or label, held-out ids, and documents without text or of more than
    ``SAMPLE_CHARS`` are not learned from; the ordinary dictionary is trained on ``SAMPLE_WINDOWS`` windows. Of several labels of a document the largest counts. Documents
    of a class stand for all of that class that can be learned from, so the shares are those of the whole table.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    usable = usable.groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").alias("__toxic"))
    texts = docs.where(F.length("text").between(1, SAMPLE_CHARS)).select("doc_id", "text")
    ids = texts.select(F.col("doc_id").alias("__id")).distinct().join(usable, "__id")
    totals = {int(r["__toxic"]): r["count"] for r in ids.groupBy("__toxic").count().collect()}
    chosen = None
    for kind in (0, 1):
        part = ids.where(F.col("__toxic") == kind).orderBy(F.xxhash64("__id"), "__id").limit(sample_rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most 2 x sample_rows ids are broadcast and ordered; of their texts 2 x sample_total characters are collected.
    sample = texts.join(F.broadcast(chosen), texts["doc_id"] == F.col("__id"))
    sample = sample.groupBy("__id").agg(F.min("text").alias("text"), F.max("__toxic").alias("toxic"))
    so_far = Window.partitionBy("toxic").orderBy(F.xxhash64("__id"), "__id")
    within = sample.select("__id", F.sum(F.length("text")).over(so_far).alias("__sum")).where(F.col("__sum") <= sample_total)
    sample = sample.join(F.broadcast(within.select("__id")), "__id")
    return fit([(r["__id"], r["text"], int(r["toxic"])) for r in sample.collect()], totals)


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) of every whole text.

    Null and empty texts are scored as one empty window. The score depends on the text alone, so
    repeated rows score alike. Other columns are kept (one named ``score`` is replaced); an empty
    table stays empty.
    """
    columns = [f for f in docs.schema.fields if f.name != "score"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in columns] + ["score double"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            scores = pa.array([model.score(t) for t in texts], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, "score"])

    return docs.select(*[F.col(f"`{f.name}`") for f in columns]).mapInArrow(score, schema)


def predicted(score):
    return (score >= THRESHOLD).cast("int")
