"""Language identification by multilingual mixture inference.

Letter trigrams within words (their ends included) have a probability in each language, learnt
from all labelled texts. Each word of a document comes from one of the languages; expectation-
maximisation estimates the document's language proportions from the words' likelihoods. The set
of languages is the one with the best likelihood less a penalty for each further language.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripdeck.llm.stages import small_batches
from tripdeck.llm.text import Words, alnum_words, buffers, column, frugal, lowered, slices

BUCKETS = 1 << 16
UNKNOWN = "und"
SLICE = 1 << 19          # bytes of text worked on together: each word has a row of all languages


def letter_words() -> np.ndarray:
    """Byte table: ASCII letters and all non-ASCII bytes."""
    table = alnum_words()
    table[0x30:0x3A] = False
    return table


class Grams:
    """Words of a slice and, for each letter byte, the hash bucket of its trigram."""

    def __init__(self, data, off):
        self.words = words = Words(data, off, letter_words(), lowered())
        inside = letter_words()[data]
        f = np.where(inside, words.data, 0x20).astype(np.uint32)
        left, right = np.full(len(f), 0x20, np.uint32), np.full(len(f), 0x20, np.uint32)
        left[1:], right[:-1] = f[:-1], f[1:]
        left[words.start] = right[words.end - 1] = 0x20
        code = (left << np.uint32(16) | f << np.uint32(8) | right)[inside]
        self.bucket = (code * np.uint32(2654435761) >> np.uint32(16)).astype(np.int32)
        size = words.end - words.start
        self.first = np.concatenate(([0], np.cumsum(size)[:-1])).astype(np.int64)

    def per_doc(self):
        """(documents with words, index of each one's first word)."""
        full = np.flatnonzero(self.words.counts)
        return full, self.words.off[:-1][full]


class LanguageModel:
    """log P(trigram | language), a row per language in ascending order of name."""

    def __init__(self, names: list[str], counts: np.ndarray, smoothing: float = 0.5):
        self.names = names
        total = counts + smoothing
        self.logp = np.log(total / total.sum(axis=1, keepdims=True)).astype(np.float32)


def fit(labelled: DataFrame, max_languages: int = 64) -> LanguageModel:
    """A model from every row of ``labelled`` (lang, text); null lang or text is ignored.

    Raises if there are more than ``max_languages`` (the model is sent to every task).
    """
    def count(batches):
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            lang = np.array(column(batch, "lang").to_pylist(), object)
            data, off = buffers(column(batch, "text"))
            for i, j in slices(off, SLICE):
                grams = Grams(data[off[i]:off[j]], off[i:j + 1] - off[i])
                if not len(grams.words):
                    continue
                words = grams.words
                letters = np.add.reduceat(words.end - words.start, grams.per_doc()[1])
                names, code = np.unique(lang[i:j].astype(str), return_inverse=True)
                code = np.repeat(code[grams.per_doc()[0]], letters)
                table = np.bincount(code * BUCKETS + grams.bucket,
                                    minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
                for name, row in zip(names, table, strict=True):
                    found[name] = found[name] + row if name in found else row
        for name, row in found.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                 pa.array(row[at])], ["lang", "bucket", "n"])

    small_batches(labelled.sparkSession)
    rows = labelled.select(F.col("lang").cast("string").alias("lang"),
                           F.col("text").cast("string").alias("text"))
    counts = (rows.where("lang is not null and text is not null")
              .mapInArrow(frugal(count), "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    # one row per language, of at most BUCKETS entries
    tables = (counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("t"))
              .limit(max_languages + 1).collect())
    if len(tables) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    names = sorted(r["lang"] for r in tables)
    table = np.zeros((len(names), BUCKETS))
    for r in tables:
        at = np.array([(x["bucket"], x["n"]) for x in r["t"]], np.int64)
        table[names.index(r["lang"]), at[:, 0]] = at[:, 1]
    return LanguageModel(names, table)


def expect_maximise(lik: np.ndarray, first: np.ndarray, doc: np.ndarray, share: np.ndarray,
                    rounds: int) -> np.ndarray:
    """Language shares (documents x languages) after ``rounds`` of EM from ``share``."""
    size = np.diff(np.append(first, len(lik)))[:, None].astype(np.float32)
    for _ in range(rounds):
        r = lik * share[doc]
        r /= np.maximum(r.sum(axis=1, keepdims=True), 1e-30)
        share = np.add.reduceat(r, first, axis=0) / size
    return share


def mixtures(model: LanguageModel, grams: Grams, rounds: int, least_share: float,
             penalty: float):
    """(documents with words, shares in the full mixture, shares in the selected set)."""
    full, first = grams.per_doc()
    ll = np.stack([np.add.reduceat(row[grams.bucket], grams.first) for row in model.logp], axis=1)
    top = ll.max(axis=1, keepdims=True)
    lik = np.exp(np.maximum(ll - top, -60))
    count, langs = np.diff(np.append(first, len(ll))), len(model.names)
    doc = np.repeat(np.arange(len(full)), count)
    share = expect_maximise(lik, first, doc,
                            np.full((len(full), langs), 1 / langs, np.float32), rounds)
    # the best single language, and sets of the strongest ones where several have a fair share
    single = np.add.reduceat(ll.astype(np.float64), first, axis=0)
    best = single.argmax(axis=1)
    chosen = np.zeros_like(share)
    chosen[np.arange(len(full)), best] = 1
    value = single[np.arange(len(full)), best]
    order = np.argsort(-share, axis=1, kind="stable")
    fair = (share >= least_share).sum(axis=1)
    for size in range(2, int(fair.max(initial=0)) + 1):
        some = np.flatnonzero(fair >= size)
        word = np.flatnonzero(np.isin(doc, some))
        sub = np.searchsorted(some, doc[word])
        start = np.concatenate(([0], np.cumsum(count[some])[:-1]))
        init = np.zeros((len(some), langs), np.float32)
        np.put_along_axis(init, order[some, :size], 1 / size, axis=1)
        fitted = expect_maximise(lik[word], start, sub, init, rounds)
        mixed = np.maximum((lik[word] * fitted[sub]).sum(axis=1, dtype=np.float64), 1e-60)
        gain = np.add.reduceat(np.log(mixed) + top[word, 0], start)
        gain -= penalty * (size - 1) * np.log(count[some] + 1.0)
        better = gain > value[some]
        value[some[better]] = gain[better]
        chosen[some[better]] = fitted[better]
    return full, share, chosen


def languages(docs: DataFrame, model: LanguageModel, rounds: int = 8, least_share: float = 0.02,
              penalty: float = 2.0) -> DataFrame:
    """Adds to ``docs`` (any columns; text is read whole) lang_pred, score, lang_set, lang_shares.

    lang_set holds the languages of the selected set, strongest first, and lang_shares their
    proportions; lang_pred is the strongest, score its proportion when all languages may take
    part. Null text, text without a letter, and any text if no language was learnt: ``und``
    with score 0 and an empty set. Rows are kept as they are, repeated ones too; columns that
    already have one of the four names are replaced.
    """
    small_batches(docs.sparkSession)
    added = ["lang_pred", "score", "lang_set", "lang_shares"]
    kept = docs.drop(*added)
    names = kept.columns

    def run(batches):
        label = np.array(model.names, object)
        for batch in batches:
            texts = column(batch, "text")
            data, off = buffers(texts)
            pred = np.full(batch.num_rows, UNKNOWN, object)
            score = np.zeros(batch.num_rows)
            sets, shares = [[] for _ in pred], [[] for _ in pred]
            for i, j in slices(off, SLICE) if len(label) else ():
                part = data[off[i]:off[j]]
                grams = Grams(part, off[i:j + 1] - off[i])
                words = grams.words
                if not len(words):
                    continue
                full, share, chosen = mixtures(model, grams, rounds, least_share, penalty)
                plain = np.concatenate(([0], np.cumsum((part < 128) & letter_words()[part])))
                ascii_letters = np.diff(plain[off[i:j + 1] - off[i]])
                for k, d in enumerate(full):
                    if not ascii_letters[d] and not any(map(str.isalpha, texts[i + int(d)].as_py())):
                        continue
                    at = np.argsort(-chosen[k], kind="stable")
                    at = at[chosen[k][at] > 0]
                    pred[i + d], score[i + d] = label[at[0]], share[k, at[0]]
                    sets[i + d], shares[i + d] = label[at].tolist(), chosen[k, at].tolist()
            yield pa.RecordBatch.from_arrays(
                [*(column(batch, c) for c in names), pa.array(pred, pa.string()),
                 pa.array(np.clip(score, 0, 1)), pa.array(sets, pa.list_(pa.string())),
                 pa.array(shares, pa.list_(pa.float64()))], [*names, *added])
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("lang_set", T.ArrayType(T.StringType())),
                           T.StructField("lang_shares", T.ArrayType(T.DoubleType()))])
    return kept.mapInArrow(frugal(run), schema)
