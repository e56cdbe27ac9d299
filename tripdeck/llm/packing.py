"""Best-fit-decreasing packing of tokenised documents into sequences of bounded length.

Token lengths are integers up to the sequence length, so documents of one length are
interchangeable to the packer. Best-fit decreasing is therefore run on the histogram of lengths,
at most ``max_tokens`` rows however large the corpus is: a segment tree over the remaining
capacities finds the tightest open sequences in logarithmic time, and a run of equal documents is
placed at once. The result is the very packing that best-fit decreasing gives document by
document, as a plan of a bounded number of intervals: documents ranked lo..hi among those of
their length go to consecutive sequences. Ranking and applying the plan are distributed.
"""

from __future__ import annotations

import os
import sys
import types
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tripdeck.llm.stages import written
from tripdeck.llm.text import (Words, buffers, column, doc_texts, frugal, give_back, lowered,
                               slices, spaced_words)

SLICE = 1 << 20          # bytes of text tokenised together
CACHED_WORDS = 500_000   # words a Python worker remembers the ids of
RANK_BUCKETS = 64         # parts into which the ranking of one length is split


class WordIds:
    """Token ids of distinct words: a bounded cache in front of the tokenizer.

    Words are looked up by 64-bit hash in a sorted array; only unknown ones are encoded.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.last = np.zeros(max(vocab.values()) + 1, bool)
        self.last[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.forget()
        del vocab
        give_back()

    def forget(self):
        self.keys = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, words: list[bytes]) -> list:
        """Ids of each word. Words are encoded in joined lines; where a line's word ends don't
        show which ids belong to which word, word by word."""
        out = []
        for i in range(0, len(words), 256):
            part = [w.decode("utf-8", "replace") for w in words[i:i + 256]]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids,
                           np.uint32)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(part) and (len(ids) == 0 or ends[-1] == len(ids)) \
                    and all(w.isalpha() for w in part):
                out += np.split(ids, ends[:-1])
            else:
                out += [np.array(e.ids, np.uint32) for e in
                        self.tokenizer.encode_batch(part, add_special_tokens=False)]
        return out

    def lookup(self, keys: np.ndarray, word_of) -> np.ndarray:
        """Positions in the cache of distinct ascending ``keys``; ``word_of`` gives their bytes."""
        if len(self.keys) + len(keys) > CACHED_WORDS:
            self.forget()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        if len(self.keys):
            known = self.keys[np.minimum(at, len(self.keys) - 1)] == keys
        fresh = np.flatnonzero(~known)
        if len(fresh):
            # alphabetic words first: their lines need no second encoding
            words = [word_of(k) for k in fresh]
            order = sorted(range(len(words)),
                           key=lambda k: not words[k].decode("utf-8", "replace").isalpha())
            ids = [None] * len(words)
            for k, v in zip(order, self.encode([words[k] for k in order]), strict=True):
                ids[k] = v
            size = np.array([len(v) for v in ids], np.int64)
            begin = len(self.ids) + np.concatenate(([0], np.cumsum(size)[:-1]))
            self.keys = np.insert(self.keys, at[fresh], keys[fresh])
            self.start = np.insert(self.start, at[fresh], begin)
            self.size = np.insert(self.size, at[fresh], size)
            self.ids = np.concatenate((self.ids, *ids))
        return np.searchsorted(self.keys, keys)


def worker_ids(path: str) -> WordIds:
    """The cache of this Python worker (kept across tasks)."""
    home = sys.modules.setdefault("_word_ids_of_worker", types.ModuleType("_word_ids_of_worker"))
    if path not in home.__dict__:
        home.__dict__[path] = WordIds(path)
    return home.__dict__[path]


def split_points() -> np.ndarray:
    """256 x 256 table: the tokenizer never joins byte a and byte b of one word.

    The tokenizer splits ASCII letters from ASCII punctuation (but for apostrophes, which may
    start a contraction) and takes ASCII digits one by one.
    """
    kind = np.zeros(256, np.int8)  # 0: not ASCII, apostrophe
    kind[0x21:0x7F] = 3
    kind[0x27] = 0
    for lo, hi, k in ((0x30, 0x3A, 2), (0x41, 0x5B, 1), (0x61, 0x7B, 1)):
        kind[lo:hi] = k
    a, b = kind[:, None], kind[None, :]
    return (a > 0) & (b > 0) & ((a != b) | (a == 2))


def token_slices(data, off, ids: WordIds, split: np.ndarray):
    """(first row, tokens, token offsets) of consecutive slices of documents."""
    for i, j in slices(off, SLICE):
        part, at = data[off[i]:off[j]], off[i:j + 1] - off[i]
        special = np.flatnonzero((part[:-1] == 0x3C) & (part[1:] == 0x7C))
        words = Words(part, at, spaced_words())
        cut = np.zeros(len(part), bool)
        cut[1:] = split[part[:-1], part[1:]]
        fold = lowered()[part]
        for d in np.unique(np.searchsorted(at, special, "right") - 1):
            # "<|" may begin a special token: such texts are cut at white space only
            cut[at[d]:at[d + 1]] = False
            fold[at[d]:at[d + 1]] = part[at[d]:at[d + 1]]
        words.data = fold
        # a cut begins a further word where it falls inside one
        inside = np.zeros(len(part) + 1, np.int8)
        inside[words.start] += 1
        inside[words.end] -= 1
        begin = cut & (np.cumsum(inside[:-1], dtype=np.int8) > 0)
        begin[words.start] = True
        ends = np.zeros(len(part) + 1, bool)
        ends[words.end] = True
        ends[:-1] |= begin & cut
        words.start, words.end = np.flatnonzero(begin), np.flatnonzero(ends)
        words.off = np.searchsorted(words.start, at)
        keys, first, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
        place = ids.lookup(keys, lambda k, f=first, w=words: w.text(f[k]))[inverse]
        size = ids.size[place]
        total = np.concatenate(([0], np.cumsum(size)))
        tokens = ids.ids[np.repeat(ids.start[place] - total[:-1], size) + np.arange(total[-1])]
        yield i, tokens, total[words.off]


def pieces(docs: DataFrame, tokenizer: str, max_tokens: int = 4096, end_id: int = 1,
           with_ids: bool = False) -> DataFrame:
    """Tokenised pieces of every document: (doc_id, piece, start, length, ids_crc32[, ids]).

    A document's ids (those of the tokenizer file, without special tokens, then ``end_id``) are
    cut every ``max_tokens``. Null or empty text gives the single token ``end_id``. Rows with a
    null doc_id are left out; repeated rows are pieces of their own; extra columns are ignored.
    """
    def run(batches):
        ids, split = worker_ids(tokenizer), split_points()
        stop = np.array([end_id], np.uint32)
        for batch in batches:
            doc = column(batch, "doc_id").to_numpy(zero_copy_only=False)
            data, off = buffers(column(batch, "text"))
            for i, tokens, at in token_slices(data, off, ids, split):
                rows, lists = [], []
                for k in range(len(at) - 1):
                    own = np.concatenate((tokens[at[k]:at[k + 1]], stop))
                    for p, s in enumerate(range(0, len(own), max_tokens)):
                        v = own[s:s + max_tokens].astype("<u4")
                        rows.append((doc[i + k], p, s, len(v), zlib.crc32(v)))
                        if with_ids:
                            lists.append(v.astype(np.int32))
                if rows:
                    cols = list(zip(*rows, strict=True))
                    types_ = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                    arrays = [pa.array(c, t) for c, t in zip(cols, types_, strict=True)]
                    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                    if with_ids:
                        arrays.append(pa.array(lists, pa.list_(pa.int32())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(arrays, names)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return doc_texts(docs).mapInArrow(frugal(run), schema + (", ids array<int>" if with_ids else ""))


class Capacities:
    """Segment tree over remaining capacities 0..size: which have an open sequence."""

    def __init__(self, size: int):
        self.leaves = 1 << (size + 1).bit_length()
        self.any = np.zeros(2 * self.leaves, bool)

    def put(self, capacity: int, is_open: bool):
        k = capacity + self.leaves
        self.any[k] = is_open
        while k > 1:
            k //= 2
            self.any[k] = self.any[2 * k] or self.any[2 * k + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest open capacity of at least ``least``."""
        k = least + self.leaves
        if self.any[k]:
            return least
        while k > 1:
            if k % 2 == 0 and self.any[k + 1]:
                k += 1
                while k < self.leaves:
                    k = 2 * k if self.any[2 * k] else 2 * k + 1
                return k - self.leaves
            k //= 2
        return None


def packing_plan(histogram: dict[int, int], max_tokens: int) -> list[tuple]:
    """Best-fit decreasing over {length: count}: rows (length, lo, hi, sequence, per, offset).

    Items ranked lo..hi - 1 of a length go, ``per`` to each, to the sequences from ``sequence``
    on, the first at ``offset`` of its sequence. The number of rows depends on ``max_tokens``
    only, not on the counts.
    """
    tree = Capacities(max_tokens)
    open_: dict[int, list[tuple[int, int]]] = {}  # capacity -> runs (first sequence, number)
    plan, made = [], 0

    def put(capacity, first, number):
        if capacity and number:
            if capacity not in open_:
                open_[capacity] = []
                tree.put(capacity, True)
            open_[capacity].append((first, number))

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            capacity = tree.tightest(length)
            if capacity is None:  # new sequences, as full of this length as they get
                per = max_tokens // length
                first, number, capacity = made, -(-left // per), max_tokens
                made += number
            else:
                first, number = open_[capacity].pop()
                if not open_[capacity]:
                    del open_[capacity]
                    tree.put(capacity, False)
                per = capacity // length
            full, rest = divmod(left, per)
            used = min(number, full)
            if used:
                plan.append((length, rank, rank + used * per, first, per, max_tokens - capacity))
                rank, left = rank + used * per, left - used * per
                put(capacity - per * length, first, used)
            if used < number and left and full == used:
                plan.append((length, rank, rank + rest, first + used, rest, max_tokens - capacity))
                rank, left = rank + rest, 0
                put(capacity - rest * length, first + used, 1)
                used += 1
            put(capacity, first + used, number - used)
    return plan


def pack(items: DataFrame, max_tokens: int = 4096) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` (both long) to rows with doc_id, piece and ``length``.

    Each sequence holds at most ``max_tokens``, gapless from offset 0. Ties (equal lengths) are
    ranked by hash bucket, doc_id and piece. Lengths must lie in 1..max_tokens. An empty input
    gives an empty result.
    """
    items = written(items, "pieces")
    names = items.columns
    bucketed = items.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"),
                                                 F.lit(RANK_BUCKETS)).cast("int"))
    sizes = bucketed.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    histogram = {r["length"]: r["n"] for r in
                 items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if histogram and not 1 <= min(histogram) <= max(histogram) <= max_tokens:
        raise ValueError(f"lengths must lie in 1..{max_tokens}")
    plan = np.array(packing_plan(histogram, max_tokens) or np.zeros((0, 6)), np.int64)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]

    def place(batches):
        for batch in batches:
            length = column(batch, "length").to_numpy(zero_copy_only=False)
            rank = column(batch, "rank").to_numpy(zero_copy_only=False)
            row = np.empty(len(length), np.int64)
            for v in np.unique(length):
                lo, hi = np.searchsorted(plan[:, 0], [v, v + 1])
                own = length == v
                row[own] = lo + np.searchsorted(plan[lo:hi, 1], rank[own], "right") - 1
            _, first, _, sequence, per, offset = plan[row].T
            k = rank - first
            yield pa.RecordBatch.from_arrays(
                [*(column(batch, c) for c in names), pa.array(sequence + k // per),
                 pa.array(offset + k % per * length)], [*names, "sequence_id", "offset"])

    rank = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")
    ranked = (bucketed.withColumn("at", F.row_number().over(rank).cast("long"))
              .join(sizes.drop("n"), ["length", "bucket"])
              .withColumn("rank", F.col("before") + F.col("at") - 1)
              .select(*names, "rank"))
    schema = T.StructType([*items.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, max_tokens: int = 4096, end_id: int = 1,
                   with_ids: bool = False) -> DataFrame:
    """Tokenises and packs whole documents: the columns of ``pieces`` and of ``pack``."""
    return pack(pieces(docs, tokenizer, max_tokens, end_id, with_ids), max_tokens)
