"""Quality classifier from compression: zstandard dictionaries of good and of bad text.

A text is compressed, in pieces of ``PIECE`` bytes, with the dictionary built from good texts,
with the one from bad texts and with none. The normalised difference of the first two sizes,
with the two rates of compression and the length, goes through a logistic calibration that
weights the classes of the sample as often as they occur among the labels.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdeck.llm.text import buffers, column, doc_texts

PIECE = 1024


def pieces_of(raw: bytes) -> list[bytes]:
    return [raw[i:i + PIECE] for i in range(0, len(raw), PIECE)] or [b""]


class CompressionModel:
    """Dictionaries and calibration; plain bytes and arrays, so that tasks can be sent it."""

    def __init__(self, good: list[bytes], bad: list[bytes], dictionary_bytes: int):
        self.dictionaries = [self.dictionary(x, dictionary_bytes) for x in (good, bad)]
        self.mean = self.scale = self.weights = None

    @staticmethod
    def dictionary(texts: list[bytes], size: int) -> bytes:
        samples = [p for t in texts for p in pieces_of(t)]
        try:
            return zstandard.train_dictionary(size, samples).as_bytes()
        except zstandard.ZstdError:  # too little text to choose from: all of it
            return b" ".join(samples)[-size:] or b" "

    def codecs(self):
        return [*(zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d))
                  for d in self.dictionaries), zstandard.ZstdCompressor(level=3)]

    @staticmethod
    def features(codecs, texts) -> np.ndarray:
        rows = np.empty((len(texts), 4))
        for k, raw in enumerate(texts):
            parts = pieces_of(bytes(raw))
            rows[k, :3] = [sum(len(c.compress(p)) for p in parts) for c in codecs]
            rows[k, 3] = len(raw)
        good, bad, plain, size = rows.T
        x = np.stack(((good - bad) / (good + bad), good / np.maximum(size, 1),
                      plain / np.maximum(size, 1), np.log(size + 50)), axis=1)
        pairs = [x[:, [i]] * x[:, [j]] for i in range(4) for j in range(i, 4)]
        return np.concatenate([x, *pairs], axis=1)

    def calibrate(self, texts: list[bytes], label: np.ndarray, weight: np.ndarray):
        """Weighted ridge-logistic regression by Newton's method."""
        x = self.features(self.codecs(), texts)
        self.mean, self.scale = x.mean(0), np.maximum(x.std(0), 1e-9)
        x = np.c_[np.ones(len(x)), (x - self.mean) / self.scale]
        w, weight = np.zeros(x.shape[1]), weight / weight.mean()
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            hessian = (x.T * (weight * p * (1 - p))) @ x + 0.01 * np.eye(len(w))
            step = np.linalg.solve(hessian, x.T @ (weight * (label - p)) - 0.01 * w)
            w += step
            if np.abs(step).max() < 1e-6:
                break
        self.weights = w

    def score(self, codecs, texts) -> np.ndarray:
        x = (self.features(codecs, texts) - self.mean) / self.scale
        z = np.c_[np.ones(len(x)), np.clip(x, -50, 50)] @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, dictionary_rows: int = 500,
        calibration_rows: int = 3000, longest: int = 20_000,
        dictionary_bytes: int = 65_536) -> CompressionModel | None:
    """A model from a bounded sample of labelled rows, or None if a class has no usable row.

    Per class, the ``dictionary_rows`` documents smallest by hash of their doc_id build the
    dictionary and the next ``calibration_rows`` the calibration (with fewer rows, half of
    them); only texts of at most ``longest`` characters are used, so the sample is at most
    2 * (dictionary_rows + calibration_rows) * longest characters. Labels that are null or
    neither 0 nor 1 are ignored. Nothing but text and label is read.
    """
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.col("quality").cast("int").alias("quality"))
             .where("doc_id is not null and quality in (0, 1)").distinct())
    total = {r["quality"]: r["n"] for r in
             marks.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    size = dictionary_rows + calibration_rows
    order = F.xxhash64("doc_id", F.lit("sample"))
    sample = [marks.where(F.col("quality") == q).orderBy(order, "doc_id").limit(size)
              for q in (1, 0)]
    chosen = F.broadcast(sample[0].union(sample[1]))
    rows = (doc_texts(docs).where(F.length("text") <= longest).join(chosen, "doc_id")
            .withColumn("at", order).collect())
    classes = [[r["text"].encode() for r in sorted(rows, key=lambda r: (r["at"], r["doc_id"]))
                if r["quality"] == q] for q in (1, 0)]
    if not all(classes):
        return None
    cut = [min(dictionary_rows, -(-len(c) // 2)) for c in classes]
    model = CompressionModel(classes[0][:cut[0]], classes[1][:cut[1]], dictionary_bytes)
    rest = [c[k:] or c for c, k in zip(classes, cut, strict=True)]
    model.calibrate(rest[0] + rest[1],
                    np.repeat([1.0, 0.0], [len(r) for r in rest]),
                    np.repeat([total[q] / len(r) for q, r in zip((1, 0), rest, strict=True)],
                              [len(r) for r in rest]))
    return model


def quality_scores(docs: DataFrame, model: CompressionModel | None) -> DataFrame:
    """(doc_id, score): the model's score in 0..1 of every whole text, higher is better.

    Null text counts as empty; with no model every score is 0.5. Rows with a null doc_id are left
    out, repeated rows are scored each; extra columns are ignored.
    """
    def run(batches):
        codecs = model.codecs() if model else None
        for batch in batches:
            data, off = buffers(column(batch, "text"))
            texts = [data[a:b] for a, b in zip(off[:-1], off[1:], strict=True)]
            score = model.score(codecs, texts) if model and texts else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(score)],
                                             ["doc_id", "score"])
    return doc_texts(docs).mapInArrow(run, "doc_id long, score double")
