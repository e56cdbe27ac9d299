"""Stupid-backoff language-model scores over n-gram count tables partitioned by hash.

Documents are dealt to blocks of a bounded size. Each block explodes its texts into n-grams and
sends every distinct one, with its number, once to the partition of the count table that its hash
names, so a frequent n-gram costs one entry a block. The partitions add up the counts and answer
each block's entries in their order; joined with these answers, the block scores its documents
and sums per document. Keys travel sorted and by byte planes, which compress.

S(w | context) is c(context w) / c(context) where c(context w) >= ``min_count``, otherwise
``alpha`` times S(w | shorter context); for a single word it is c(w) / number of words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdeck.llm.text import (Words, buffers, column, compact, doc_texts, lowered, ngrams,
                               slices, spaced_words, unpack)

BLOCK_BYTES = 8 << 20        # text of a block
PARTITION_BYTES = 48 << 20   # entries of a count-table partition, at 24 bytes each


def planes(x: np.ndarray) -> bytes:
    """uint64 values by byte planes, compressed."""
    raw = np.ascontiguousarray(x, "<u8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def from_planes(blob: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").ravel()


class Block:
    """The n-grams of a block's documents: ``keys`` ascending and distinct, and for each order
    the index of the n-gram that ends at a word (-1: it would begin before the document)."""

    def __init__(self, table: pa.Table, order: int):
        data, off = unpack(table["z"].combine_chunks())
        self.words = words = Words(data, off, spaced_words(), lowered())
        h = words.hashes()
        place = np.arange(len(h)) - np.repeat(words.off[:-1], words.counts)
        grams, where = [], []
        for n in range(1, order + 1):
            end = np.flatnonzero(place >= n - 1)
            grams.append(ngrams(h, n)[end - n + 1])
            where.append(end)
        self.keys, inverse, self.counts = np.unique(
            np.concatenate(grams), return_inverse=True, return_counts=True)
        self.at, done = [], 0
        for end in where:
            at = np.full(len(h), -1, np.int64)
            at[end] = inverse[done:done + len(end)]
            self.at.append(at)
            done += len(end)

    def bounds(self, parts: int) -> np.ndarray:
        """Where each partition's keys begin and end: hash ranges of equal width."""
        part = ((self.keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        return np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))

    def scores(self, total: np.ndarray, corpus_words: int, alpha: float, min_count: int):
        """Per document: words, log score, words scored by a shorter n-gram than there is."""
        size = len(self.words)
        score, fallen = np.zeros(size), np.zeros(size, bool)
        waiting, longest = np.ones(size, bool), np.zeros(size, np.int64)
        for n, at in enumerate(self.at, 1):
            longest[at >= 0] = n
        for n in range(len(self.at), 0, -1):
            own = np.flatnonzero(waiting & (longest >= n))
            count = total[self.at[n - 1][own]].astype(np.float64)
            if n > 1:
                seen = count >= min_count
                fell = own[~seen]
                score[fell] += np.log(alpha)
                fallen[fell] = True
                own, count = own[seen], count[seen]
                base = total[self.at[n - 2][own - 1]].astype(np.float64)
            else:
                base = float(corpus_words)
            score[own] += np.log(count / base)
            waiting[own] = False
        upto = [np.concatenate(([0], np.cumsum(x))) for x in (score, fallen)]
        ends = self.words.off
        log_score = np.array([score[a:b].sum() for a, b in zip(ends[:-1], ends[1:], strict=True)])
        return self.words.counts.astype(np.int64), log_score, np.diff(upto[1][ends])


def corpus_size(docs: DataFrame) -> tuple[int, int]:
    """(bytes, words) of all texts."""
    def run(batches):
        for batch in batches:
            data, off = buffers(column(batch, "text"))
            words = sum(len(Words(data[off[i]:off[j]], off[i:j + 1] - off[i], spaced_words()))
                        for i, j in slices(off))
            yield pa.RecordBatch.from_arrays([pa.array([len(data)]), pa.array([words])],
                                             ["bytes", "words"])
    row = (doc_texts(docs).select("text").mapInArrow(run, "bytes long, words long")
           .agg(F.sum("bytes").alias("b"), F.sum("words").alias("w")).first())
    return row["b"] or 0, row["w"] or 0


def stupid_backoff(docs: DataFrame, order: int = 2, alpha: float = 0.4,
                   min_count: int = 2) -> DataFrame:
    """(doc_id, n_words, log_score, n_backoff) of every document, by a model of all of them.

    Words are runs of non-white-space with A-Z lower-cased; log_score is the sum of natural
    logarithms over the words, n_backoff the number of words whose longest n-gram was too rare.
    Null or wordless text gives 0, 0.0 and 0. Rows with a null doc_id are left out of the model
    and the result; repeated rows count and are scored each; extra columns are ignored.
    """
    size, corpus_words = corpus_size(docs)
    n_blocks = max(1, -(-size // BLOCK_BYTES))
    parts = max(1, -(-corpus_words * order * 24 // PARTITION_BYTES))
    blocks = (compact(docs).withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)))
              .repartition(int(n_blocks), "block"))

    def ask(key, table):
        block = Block(table, order)
        ends = block.bounds(parts)
        rows = [(key[0].as_py(), p, planes(block.keys[a:b]), planes(block.counts[a:b]))
                for p, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)) if b > a]
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        cols = zip(*rows, strict=True) if rows else [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                        names=["block", "part", "keys", "counts"])

    def answer(table):
        keys = [from_planes(v) for v in table["keys"].to_pylist()]
        counts = np.concatenate([from_planes(v) for v in table["counts"].to_pylist()])
        every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(every), np.uint64)
        np.add.at(total, inverse, counts)
        ends = np.cumsum([0, *map(len, keys)])
        totals = [planes(total[inverse[a:b]]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return pa.table({"block": table["block"], "part": table["part"],
                         "totals": pa.array(totals, pa.binary())})

    def score(table, answers):
        block = Block(table, order)
        answers = answers.sort_by("part")
        total = np.concatenate([from_planes(v) for v in answers["totals"].to_pylist()]
                               or [np.zeros(0, np.uint64)])
        words, log_score, back = block.scores(total, corpus_words, alpha, min_count)
        return pa.table({"doc_id": table["doc_id"], "n_words": pa.array(words),
                         "log_score": pa.array(log_score), "n_backoff": pa.array(back)})

    asked = blocks.groupBy("block").applyInArrow(
        ask, "block long, part long, keys binary, counts binary")
    answers = (asked.repartition(int(parts), "part").groupBy("part").applyInArrow(
        answer, "block long, part long, totals binary")).repartition(int(n_blocks), "block")
    return (blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score, "doc_id long, n_words long, log_score double, n_backoff long"))
