"""Benchmark decontamination with spaced seeds.

A seed is the hash of the words at the fixed positions of a mask, so a substituted word at an
ignored position doesn't change it. The seeds of all benchmark items are joined with those of
every document position; around each hit the two texts are compared word by word along the
diagonal, and a pair is reported if any region passes. Words are runs of letters and digits (any
non-ASCII byte counts as a letter) with A-Z lower-cased, so punctuation and case don't matter.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdeck.llm.stages import small_batches
from tripdeck.llm.text import (Words, alnum_words, buffers, column, frugal, lowered, mix, slices)

# Together these have a hit in every region of 12 or more matches of which at least 80 % match,
# wherever the substitutions lie (tests/llm/test_decontam.py tries all up to 20 words).
MASKS = ("110100111", "111001011", "1100110011", "111111", "100000011111")
MISMATCH = -2        # score of a substituted word; a match scores 1
FILTER_BITS = 20
BENCHMARK_BYTES = 16 << 20  # benchmark text that one pass sends to the tasks


def spaced(h: np.ndarray, mask: str) -> np.ndarray:
    """Seed of ``mask`` at each position where it fits."""
    size = len(h) - len(mask) + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    acc = np.full(size, sum(1 << k for k, c in enumerate(mask) if c == "1"), np.uint64)
    for k, c in enumerate(mask):
        if c == "1":
            acc = acc * np.uint64(0x2545F4914F6CDD1D) + h[k:size + k]
    return mix(acc)


class Seeds:
    """Word hashes of benchmark items and the sorted seeds of all their positions.

    Items shorter than a mask have one seed, of all their words; items of fewer than
    ``min_words`` words have none.
    """

    def __init__(self, items: list[tuple[int, str]], min_words: int):
        self.items = []
        data, off = buffers(pa.array([t for _, t in items], pa.string()))
        words = Words(data, off, alnum_words(), lowered())
        h = words.hashes()
        keys, owner, place, masks = [], [], [], set()
        for k, (item_id, _) in enumerate(items):
            own = h[words.off[k]:words.off[k + 1]]
            if len(own) < min_words:
                continue
            for mask in MASKS if len(own) >= max(map(len, MASKS)) else ("1" * len(own),):
                seeds = spaced(own, mask)
                masks.add(mask)
                keys.append(seeds)
                owner.append(np.full(len(seeds), len(self.items)))
                place.append(np.arange(len(seeds)))
            self.items.append((item_id, own))
        self.masks = sorted(masks)
        keys = np.concatenate([*keys, np.zeros(0, np.uint64)])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.owner = np.concatenate([*owner, np.zeros(0, np.int64)])[order]
        self.place = np.concatenate([*place, np.zeros(0, np.int64)])[order]
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[self.keys >> np.uint64(64 - FILTER_BITS)] = True

    def hits(self, h: np.ndarray):
        """(position, first, last): where a seed of ``h`` equals the seeds first..last - 1."""
        for mask in self.masks:
            seeds = spaced(h, mask)
            at = np.flatnonzero(self.filter[seeds >> np.uint64(64 - FILTER_BITS)])
            lo = np.searchsorted(self.keys, seeds[at], "left")
            hi = np.searchsorted(self.keys, seeds[at], "right")
            found = hi > lo
            yield at[found], lo[found], hi[found]


def best_region(equal: np.ndarray) -> tuple[int, int]:
    """First and end of the region with the highest sum of matches and ``MISMATCH``es."""
    total = np.concatenate(([0], np.cumsum(np.where(equal, 1, MISMATCH))))
    low = np.minimum.accumulate(total)
    end = int(np.argmax(total - low))
    return int(np.argmin(total[:end + 1])), end


def widest_region(equal: np.ndarray, identity: float) -> tuple[int, int]:
    """First and end of the region with the most matches among all in which the share
    ``identity`` of the words match; it starts and ends with a match unless it is empty."""
    matches = np.concatenate(([0], np.cumsum(equal)))
    over = matches - identity * np.arange(len(matches))
    # for each end the first start from which the share is reached
    start = np.searchsorted(-np.minimum.accumulate(over), -over - 1e-9, "left")
    end = int(np.argmax(matches - matches[start]))
    first = int(start[end])
    return first + int(np.argmax(equal[first:end])) if end > first else end, end


def overlaps_of(seeds: Seeds, words: Words, h: np.ndarray, min_words: int, identity: float):
    """Verified overlaps of a slice: {document row: [(item_id, start, length, matches)]}."""
    diagonals = set()
    for at, lo, hi in seeds.hits(h):
        doc = np.searchsorted(words.off, at, "right") - 1
        count = hi - lo
        entry = np.repeat(lo - np.concatenate(([0], np.cumsum(count)[:-1])), count) \
            + np.arange(count.sum())
        diagonals.update(zip(np.repeat(doc, count).tolist(), seeds.owner[entry].tolist(),
                             (np.repeat(at, count) - seeds.place[entry]).tolist(), strict=True))
    best: dict[tuple[int, int], tuple] = {}
    for doc, owner, diagonal in diagonals:
        item_id, own = seeds.items[owner]
        first, end = words.off[doc], words.off[doc + 1]
        lo, hi = max(first, diagonal), min(end, diagonal + len(own))
        if hi - lo <= 0:
            continue
        equal = h[lo:hi] == own[lo - diagonal:hi - diagonal]
        a, b = best_region(equal)
        matches, least = int(equal[a:b].sum()), min(min_words, len(own))
        if matches < least or matches < identity * (b - a):
            a, b = widest_region(equal, identity)  # a part of it or a wider one may pass
            matches = int(equal[a:b].sum())
        if matches >= least:
            new = (-matches, int(lo + a - first), b - a)
            key = (doc, item_id)
            best[key] = min(best.get(key, new), new)
    out = defaultdict(list)
    for (doc, item_id), (matches, start, length) in sorted(best.items()):
        out[doc].append((item_id, start, length, -matches))
    return out


def find_overlaps(docs: DataFrame, benchmark: DataFrame, min_words: int = 12,
                  identity: float = 0.8, shortest: int = 5) -> DataFrame:
    """Adds ``leaks`` to ``docs``: array of (item_id, start, length, matches), by item.

    An overlap is a gapless region of a document and an item in which at least ``min_words``
    words (all, for shorter items) and the share ``identity`` of the region match. Of a diagonal
    the region with the best score is taken if it passes, else the one with the most
    matches of those that pass; of several diagonals the one with the most matches; start and
    length count words. With the default ``min_words`` and ``identity`` no overlap is missed: some
    mask meets every one. Whole texts and all items of at least ``shortest`` words are searched
    (a few words in common are no leak); a null text or a document without words has no leaks. Benchmark rows with a null id
    or text are left out. Rows of ``docs`` are kept as they are, repeated ones too; a column
    named ``leaks`` is replaced. A benchmark larger than ``BENCHMARK_BYTES`` is searched in
    several passes, each with a part of its items that is proven to fit.
    """
    small_batches(docs.sparkSession)
    items = (benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                              F.col("text").cast("string").alias("text"))
             .where("item_id is not null and text is not null"))
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    passes = max(1, -(-size // BENCHMARK_BYTES))
    out = docs.drop("leaks").withColumn(
        "leaks", F.expr("cast(array() as array<struct<item_id:long,start:int,length:int,"
                        "matches:int>>)"))
    names = out.columns[:-1]
    schema = out.schema
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()),
                               ("length", pa.int32()), ("matches", pa.int32())]))
    for k in range(passes):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k)
        seeds = Seeds([(r["item_id"], r["text"]) for r in part.collect()], shortest)

        def run(batches, seeds=seeds):
            for batch in batches:
                leaks = column(batch, "leaks").to_pylist()
                data, off = buffers(column(batch, "text"))
                for i, j in slices(off):
                    words = Words(data[off[i]:off[j]], off[i:j + 1] - off[i], alnum_words(),
                                  lowered())
                    found = overlaps_of(seeds, words, words.hashes(), min_words, identity)
                    for d, rows in found.items():
                        leaks[i + d] = leaks[i + d] + [
                            dict(zip(("item_id", "start", "length", "matches"), r, strict=True))
                            for r in rows]
                yield pa.RecordBatch.from_arrays(
                    [*(column(batch, c) for c in names), pa.array(leaks, kind)],
                    [*names, "leaks"])
        out = out.mapInArrow(frugal(run), schema)
    return out
