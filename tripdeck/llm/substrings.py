"""Removal of repeated word windows with prefix-partitioned suffix trees.

Every window of ``window`` words holds an anchor: the position of its smallest hashed gram of
``gram`` words. Equal windows have their anchors at the same place, so only suffixes that start
at anchors are kept, about one in fifteen, and of these only the ones whose gram, the suffix's
first prefix, occurs again. The prefix decides the partition of a suffix. Where more than
``group_rows`` suffixes share a prefix, it is lengthened to the whole windows around the anchor:
suffixes with the same ones are one, and the windows of the distinct ones are counted by a
distributed aggregation, so no group outgrows a task. In all other groups the
subtree is built in memory: suffixes sorted by the words that follow, with the lengths of common
prefixes of neighbours, and likewise by the words before. A window that starts o words before an
anchor is repeated exactly if another suffix shares the node of depth ``window - o`` on the right
and of depth o on the left; those deep internal nodes are the maximal repeats.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripdeck.llm.stages import small, written
from tripdeck.llm.text import (Words, buffers, column, compact, doc_texts, frugal, mix, ngrams,
                               slices, spaced_words, unpack)

CONTEXTS = 1 << 14          # suffixes that a task holds at a time to group equal contexts
PARTITION_BYTES = 48 << 20  # context bytes of suffixes that a task reads, a group at a time


def sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) of each ``width`` neighbours from a position on."""
    done = 1
    while done < width:
        step = min(done, width - done)
        x = pick(x[:-step], x[step:])
        done += step
    return x


def anchors_of(words: Words, window: int, gram: int):
    """Word positions of anchors in a slice, and their gram hashes."""
    count = len(words)
    if count < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g = ngrams(words.hashes(), gram)
    least = sliding(g, window - gram + 1, np.minimum)
    starts = np.arange(len(least))
    least[starts + window > words.doc_end()[:len(least)]] = 0
    # a gram is an anchor if it is the smallest of some whole window around it
    span = window - gram
    padded = np.concatenate((np.zeros(span, np.uint64), least, np.zeros(span, np.uint64)))
    reach = sliding(padded, span + 1, np.maximum)
    at = np.flatnonzero((reach == g) & (g > 0))
    return at, g[at]


def anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(key, doc, pos): the anchors of all documents (doc, text) with at least one window."""
    def run(batches):
        for batch in batches:
            ids = column(batch, "doc").to_numpy(zero_copy_only=False)
            data, off = buffers(column(batch, "text"))
            for i, j in slices(off):
                words = Words(data[off[i]:off[j]], off[i:j + 1] - off[i], spaced_words())
                at, key = anchors_of(words, window, gram)
                if len(at):
                    doc = np.searchsorted(words.off, at, "right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(ids[i + doc]),
                         pa.array((at - words.off[doc]).astype(np.int32))],
                        ["key", "doc", "pos"])
    return docs.select("doc", "text").mapInArrow(frugal(run), "key long, doc long, pos int")


def _documents(batch):
    """Word hashes of each document of a batch with a ``z`` column, a block at a time."""
    z = column(batch, "z")
    for a in range(0, batch.num_rows, 256):
        data, off = unpack(z.slice(a, 256))
        for i, j in slices(off):
            words = Words(data[off[i]:off[j]], off[i:j + 1] - off[i], spaced_words())
            h = words.hashes()
            for k in range(j - i):
                yield a + i + k, h[words.off[k]:words.off[k + 1]]


def contexts(placed: DataFrame, window: int, gram: int) -> DataFrame:
    """(key, doc, pos, context): the words before (nearest first) and after each suffix, as
    64-bit hashes; zero where the document has none."""
    before, after = window - gram, window

    def run(batches):
        for batch in batches:
            ids = column(batch, "doc").to_numpy(zero_copy_only=False)
            spots, keys = column(batch, "pos"), column(batch, "keys")
            for k, h in _documents(batch):
                at = np.array(spots[k].as_py(), np.int64)
                at_key = np.array(keys[k].as_py(), np.int64)
                ok = at < len(h)
                at, at_key = at[ok], at_key[ok]
                padded = np.concatenate((np.zeros(before, np.uint64), h | np.uint64(1),
                                         np.zeros(after, np.uint64)))
                cols = np.concatenate((before - 1 - np.arange(before), before + np.arange(after)))
                rows = padded[at[:, None] + cols[None, :]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(at_key), pa.array(np.full(len(at), ids[k])),
                     pa.array(at.astype(np.int32)),
                     pa.array([r.tobytes() for r in rows], pa.binary())],
                    ["key", "doc", "pos", "context"])
    return placed.mapInArrow(frugal(run), "key long, doc long, pos int, context binary")


def common_depth(key: np.ndarray, rows: np.ndarray):
    """Sorted order of ``rows`` of words below each key, and for each sorted row how many words
    it shares with the one before it (-1: another key)."""
    width = rows.shape[1]
    flat = np.concatenate((key[:, None], rows), axis=1).astype(">u8")
    order = np.argsort(np.ascontiguousarray(flat).view(f"S{8 * (width + 1)}").ravel(),
                       kind="stable")
    k, r = key[order], rows[order]
    same = (r[1:] == r[:-1]) & (r[1:] != 0)
    depth = np.logical_and.accumulate(same, axis=1).sum(axis=1)
    depth[k[1:] != k[:-1]] = -1
    return order, np.concatenate(([-1], depth))


def repeated_offsets(key: np.ndarray, context: np.ndarray, window: int, gram: int) -> np.ndarray:
    """For each suffix a bit set: bit o is set if the window o words before it is repeated."""
    before, n = window - gram, len(key)
    left, right = context[:, :before], context[:, before:]
    by_right, right_depth = common_depth(key, right)
    by_left, left_depth = common_depth(key, left)
    out = np.zeros(n, np.int64)
    node_r, node_l = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(before + 1):
        node_r[by_right] = np.cumsum(right_depth < window - o)
        node_l[by_left] = np.cumsum(left_depth < o)
        node = node_r * (n + 1) + node_l
        order = np.argsort(node)
        equal = node[order][1:] == node[order][:-1]
        hit = np.zeros(n, bool)
        hit[order[1:][equal]] = True
        hit[order[:-1][equal]] = True
        whole = right[:, window - o - 1] != 0
        if o:
            whole = whole & (left[:, o - 1] != 0)
        out[hit & whole] |= 1 << o
    return out


def subtree_marks(suffixes: DataFrame, window: int, gram: int) -> DataFrame:
    """(doc, pos, mask) of the suffixes that repeated windows hold. Suffixes come ordered by key;
    whole prefix groups are worked through as they arrive, a batch or a group at a time."""
    width = 2 * window - gram

    def solve(parts):
        key = np.concatenate([column(b, "key").to_numpy() for b in parts]).view(np.uint64)
        context = np.concatenate([buffers(column(b, "context"))[0] for b in parts])
        mask = repeated_offsets(key, context.view(np.uint64).reshape(-1, width), window, gram)
        hit = np.flatnonzero(mask)
        doc, pos = (np.concatenate([column(b, c).to_numpy() for b in parts])[hit]
                    for c in ("doc", "pos"))
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(pos), pa.array(mask[hit])],
                                          ["doc", "pos", "mask"])

    def run(batches):
        held = []                      # rows of the last key seen
        for batch in batches:
            if not batch.num_rows:
                continue
            key = column(batch, "key").to_numpy()
            cut = int(np.searchsorted(key, key[-1]))      # where the last group begins
            if cut or (held and column(held[0], "key")[0].as_py() != key[0]):
                yield solve([*held, batch.slice(0, cut)] if cut else held)
                held = []
            held.append(batch.slice(cut))
        if held:
            yield solve(held)
    return suffixes.mapInArrow(frugal(run), "doc long, pos int, mask long")


def crowded_contexts(placed: DataFrame, window: int, gram: int) -> DataFrame:
    """Suffixes of crowded groups, ``CONTEXTS`` of them at a time. Rows with ``at``: (doc, at), the
    places and masks of a document's suffixes whose context occurs again among them, so that each of
    its windows is repeated. Rows without: (c1, c2, n, windows, doc, pos), a distinct context, how
    often it occurs among them, and its place if it is the only one.

    A context is the 128-bit hashes of the windows whose first smallest gram the anchor is, by the
    anchor's place in them (zero: none). Equal windows have it at the same place."""
    width = window - gram + 1
    salts = mix(np.arange(1, 4 * width + 1, dtype=np.uint64)).reshape(2, 2 * width)
    schema = ("c1 long, c2 long, n long, windows binary, doc long, pos int, "
              "at array<struct<pos: int, mask: long>>")
    names = ["c1", "c2", "n", "windows", "doc", "pos", "at"]
    kind = pa.list_(pa.struct([("pos", pa.int32()), ("mask", pa.int64())]))

    def grouped(found):
        rows, docs, spots = map(np.concatenate, found)
        c1, c2 = (mix(rows ^ salt).sum(1, dtype=np.uint64) for salt in salts)
        order = np.lexsort((c2, c1))
        k1, k2 = c1[order], c2[order]
        new = np.flatnonzero(np.concatenate(([True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))))
        times = np.diff(np.append(new, len(order)))
        first = order[new]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c1[first].view(np.int64)), pa.array(c2[first].view(np.int64)),
             pa.array(times), pa.array([r.tobytes() for r in rows[first]], pa.binary()),
             pa.array(docs[first], mask=times > 1), pa.array(spots[first], mask=times > 1),
             pa.nulls(len(first), kind)], names)
        again = np.sort(order[np.repeat(times > 1, times)])
        if not len(again):
            return
        again = again[np.argsort(docs[again], kind="stable")]
        mask = (rows[again, :width] != 0) @ (1 << np.arange(width))
        begin = np.flatnonzero(np.concatenate(([True], np.diff(docs[again]) != 0)))
        places = pa.StructArray.from_arrays([pa.array(spots[again]), pa.array(mask)],
                                            fields=list(kind.value_type))
        at = pa.ListArray.from_arrays(pa.array(np.append(begin, len(again)).astype(np.int32)),
                                      places)
        yield pa.RecordBatch.from_arrays(
            [*(pa.nulls(len(begin), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())),
             pa.array(docs[again][begin]), pa.nulls(len(begin), pa.int32()), at.cast(kind)], names)

    def run(batches):
        found, size = [[], [], []], 0
        for batch in batches:
            ids = column(batch, "doc").to_numpy(zero_copy_only=False)
            places = column(batch, "pos")
            for k, h in _documents(batch):
                count = len(h) - window + 1
                if count <= 0:
                    continue
                at = np.unique(np.array(places[k].as_py(), np.int64))
                g = ngrams(h, gram)
                least = sliding(g, width, np.minimum)
                order = np.argsort(g, kind="stable")
                before = np.full(len(g), -1)           # the last place with the same gram
                same = g[order[1:]] == g[order[:-1]]
                before[order[1:][same]] = order[:-1][same]
                start = at[:, None] - np.arange(width)[None, :]
                whole = (start >= 0) & (start < count)
                start = np.clip(start, 0, count - 1)
                whole &= (least[start] == g[at][:, None]) & (before[at][:, None] < start)
                rows = np.concatenate([np.where(whole, ngrams(h, window, seed)[start]
                                                | np.uint64(1), np.uint64(0))
                                       for seed in (11, 12)], axis=1)
                some = whole.any(1)
                for out, x in zip(found, (rows[some], np.full(some.sum(), ids[k], np.int64),
                                          at[some].astype(np.int32)), strict=True):
                    out.append(x)
                size += int(some.sum())
                if size >= CONTEXTS:
                    yield from grouped(found)
                    found, size = [[], [], []], 0
        if size:
            yield from grouped(found)
    return placed.mapInArrow(frugal(run), schema)


def crowded_marks(contexts: DataFrame, window: int, gram: int) -> DataFrame:
    """(doc, pos, mask) of the suffixes that repeated windows hold, from distinct contexts: the
    windows of each count as often as it occurs, and are matched by their place at the anchor.
    Suffixes that ``crowded_contexts`` has marked are left out."""
    width = window - gram + 1

    def each(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.frombuffer(b"".join(column(batch, "windows").to_pylist()), np.int64)
            rows = rows.reshape(batch.num_rows, 2, width)
            k, o = np.nonzero(rows[:, 0])
            take = pa.array(k)
            yield pa.RecordBatch.from_arrays(
                [*(column(batch, c).take(take) for c in ("c1", "c2", "n")),
                 pa.array(o.astype(np.int32)), pa.array(rows[k, 0, o]), pa.array(rows[k, 1, o])],
                ["c1", "c2", "n", "o", "w1", "w2"])
    distinct = contexts.groupBy("c1", "c2").agg(F.sum("n").alias("n"),
                                                F.first("windows").alias("windows"))
    windows = written(distinct.mapInArrow(
        frugal(each), "c1 long, c2 long, n long, o int, w1 long, w2 long"), "crowded-windows")
    again = windows.groupBy("o", "w1", "w2").agg(F.sum("n").alias("times")).where("times > 1")
    masks = (windows.join(again, ["o", "w1", "w2"]).groupBy("c1", "c2")
             .agg(F.expr("bit_or(shiftleft(1L, o))").alias("mask")))
    masks = written(masks, "crowded-masks")
    return (contexts.where("doc is not null").select("c1", "c2", "doc", "pos")
            .join(masks, ["c1", "c2"]).select("doc", "pos", "mask"))


def remove_marked(marked: DataFrame, window: int) -> DataFrame:
    """(doc_id, n_words, n_removed, text): texts of (doc_id, z, marks) without the words that marked windows cover;
    kept words are joined by one space."""
    def run(batches):
        for batch in batches:
            ids, z, marks = (column(batch, c) for c in ("doc_id", "z", "marks"))
            count = pc.fill_null(pc.list_value_length(marks), 0).to_numpy()
            upto = np.concatenate(([0], np.cumsum(count)))
            flat = marks.flatten()
            pos, mask = (flat.field(c).to_numpy().astype(np.int64) for c in (0, 1))
            for a in range(0, batch.num_rows, 256):
                data, off = unpack(z.slice(a, 256))
                for i, j in slices(off):
                    part, at = data[off[i]:off[j]], off[i:j + 1] - off[i]
                    words = Words(part, at, spaced_words())
                    own = slice(upto[a + i], upto[a + j])
                    doc = np.repeat(np.arange(j - i), count[a + i:a + j])
                    gone = np.zeros(len(words) + 1, np.int64)
                    for o in range(int(mask[own].max(initial=0)).bit_length()):
                        s = pos[own] - o
                        ok = (mask[own] >> o & 1 == 1) & (s >= 0) & (s + window <= words.counts[doc])
                        s = words.off[doc[ok]] + s[ok]
                        np.add.at(gone, s, 1)
                        np.add.at(gone, s + window, -1)
                    kept = np.cumsum(gone[:-1]) == 0
                    seen = np.concatenate(([0], np.cumsum(kept)))
                    edge = np.zeros(len(part) + 1, np.int8)
                    edge[words.start[kept]] += 1
                    edge[words.end[kept]] -= 1
                    inside = np.cumsum(edge[:-1], dtype=np.int8) > 0
                    # one space after each kept word but the last of its document
                    follows = kept & (seen[1:] < seen[words.doc_end()])
                    gap = words.end[follows]
                    inside[gap] = True
                    part = part.copy()
                    part[gap] = 0x20
                    size = np.concatenate(([0], np.cumsum(inside)))[at]
                    text = pa.Array.from_buffers(
                        pa.binary(), j - i,
                        [None, pa.py_buffer(size.astype(np.int32)), pa.py_buffer(part[inside])])
                    total = words.counts.astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(a + i, j - i), pa.array(total),
                         pa.array(total - np.diff(seen[words.off])), text.cast(pa.string())],
                        ["doc_id", "n_words", "n_removed", "text"])
    return marked.mapInArrow(frugal(run), "doc_id long, n_words long, n_removed long, text string")


def remove_repeats(docs: DataFrame, window: int = 35, gram: int = 8,
                   group_rows: int = 4096) -> DataFrame:
    """(doc_id, n_words, n_removed, text): every word that lies in a window of ``window`` words
    whose word sequence also starts anywhere else (same document included) is removed.

    Words are runs of non-white-space, unchanged; windows are judged on the input. Null text has
    no words; documents shorter than a window stay whole. Rows with a null doc_id are left out.
    Every row is a document of its own: repeated rows repeat each other, rows that share a doc_id
    but not the text are told apart by a 64-bit hash of both. Extra columns are ignored; an empty
    table gives an empty result.
    """
    if not 0 < gram <= window < gram + 62:
        raise ValueError("the gram must be shorter than the window, by 61 words at most")
    docs = doc_texts(docs).withColumn("doc", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    found = written(anchors(docs, window, gram), "anchors")
    again = found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    twice = written(found.join(again, "key"), "repeated-anchors")

    def placed(own):
        """Anchors per document, at most one for each of its words however often a row repeats."""
        lists = written(own.groupBy("doc").agg(F.collect_set(F.struct("pos", "key"))
                                               .alias("at")), "anchor-lists")
        some = docs.join(small(lists.select("doc")), "doc", "left_semi")
        return (compact(some, ["doc"]).join(lists, "doc")
                .select("doc", "z", F.col("at.pos").alias("pos"), F.col("at.key").alias("keys")))

    # an average suffix has 2 * window - gram words of context
    rows = twice.where(F.col("n") <= group_rows).count()
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                -(-rows * 8 * (2 * window - gram) // PARTITION_BYTES))
    suffixes = contexts(placed(twice.where(F.col("n") <= group_rows)), window, gram)
    marks = subtree_marks(suffixes.repartition(parts, "key").sortWithinPartitions("key"), window,
                          gram)
    crowded = written(crowded_contexts(placed(twice.where(F.col("n") > group_rows)), window, gram),
                      "crowded-contexts")
    marks = marks.union(crowded_marks(crowded.where("at is null"), window, gram))
    marks = (marks.select("doc", F.array(F.struct("pos", "mask")).alias("at"))
             .union(crowded.where("at is not null").select("doc", "at")))
    per_doc = marks.groupBy("doc").agg(F.flatten(F.collect_set("at")).alias("marks"))
    return remove_marked(compact(docs, ["doc_id", "doc"]).join(per_doc, "doc", "left"), window)
