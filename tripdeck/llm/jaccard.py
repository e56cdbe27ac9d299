"""N-gram Jaccard self-join by vertical partitioning, and the classes its links form.

The 64-bit shingle hashes in ascending order are the global n-gram order. For documents of a
size class that order is cut at fixed points into fragments, so each document becomes a row of
segments, one per fragment. Two sets that link differ in at most D elements (D follows from
their sizes), each of which spoils one segment; with more than D fragments some segment must be
identical in both. Equal segments are therefore complete candidates, found by an equality join
on (class, fragment, segment). Partial overlaps of a candidate pair are then counted per coarse
vertical partition and summed per pair, which decides the link exactly.

A group of near copies is never expanded into all its pairs. Documents that share a segment are
first compared with the smallest document there (their leader), which decides all pairs of a segment
that only two documents have. Where more have one, their differences from the leader, less
those that most of them share, are their differences from a consensus set c. If x lacks r(x) of
its elements and has p(x) others, w(x) = 100 r(x) + percent p(x), and x and y share s elements of
their differences, then x and y link exactly if

    (100 + percent) s >= w(x) + w(y) - (100 - percent) |c|.

Where the right side is not positive, both link with the group's member of least w, which gives
one link per document. All other links need shared differences, and as w(y) >= percent s, at
least (w(x) - (100 - percent) |c|) / 100 of them. Differences that no two members of different
classes have can't be shared; of the others, the rarest first, a short prefix must meet. Such
pairs, if not connected yet, are compared. No link between different classes is lost, so the
components are exact. Equal sets are joined first, by a 128-bit digest.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripdeck.llm.stages import SMALL_ROWS, components, small, written
from tripdeck.llm.text import (Words, buffers, column, compact, doc_texts, frugal, lowered, mix,
                               ngrams, slices, spaced_words, unpack)

GROWTH = 1.5  # ratio of neighbouring size classes
SAMPLE = 1024   # members of a group that vote on its consensus set
# weights of members, as multiples of the consensus set's size, where a new band begins
WEIGHT_BANDS = (*range(0, 64, 4), *range(64, 128, 8), 128, 144)
PARTS = 8     # vertical partitions in which a pair's overlaps are counted
KEY_BITS = 48       # of a segment's key; keys that collide only add pairs that are then compared
BUCKET = 64         # members of a group for each of the buckets its differences are dealt over
ELEMENT_BITS = 40   # of a difference when shared ones are looked for; the same holds for these


def shingle_sets(data, off, n: int):
    """Yields each document's ascending distinct shingle hashes (an empty array: no words)."""
    words = Words(data, off, spaced_words(), lowered())
    h = words.hashes()
    grams = ngrams(h, n)
    for a, count in zip(words.off[:-1], words.counts, strict=True):
        if count >= n:
            yield np.unique(grams[a:a + count - n + 1])
        elif count:
            yield ngrams(h[a:a + count], int(count), seed=1)
        else:
            yield np.zeros(0, np.uint64)


def packed_sets(z, n: int):
    """Yields the shingle sets of a ``z`` column's texts, a slice of texts in memory at a time."""
    data, off = unpack(z)
    for i, j in slices(off):
        yield from shingle_sets(data[off[i]:off[j]], off[i:j + 1] - off[i], n)


def digest(u: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set, as two signed 64-bit sums."""
    return tuple(int(mix(x).sum(dtype=np.uint64).view(np.int64))
                 for x in (u, u ^ np.uint64(0xA5A5A5A5A5A5A5A5)))


def size_classes(limit: int) -> list[int]:
    """Smallest sizes of the classes up to the one that holds ``limit``."""
    lows = [1]
    while lows[-1] <= limit:
        lows.append(max(lows[-1] + 1, int(lows[-1] * GROWTH)))
    return lows


def segment_keys(u: np.ndarray, percent: int) -> np.ndarray:
    """Keys of the segments under which a set can meet each set it may link with.

    A set takes part in its own size class and in each above that a larger partner can be in.
    Of its segments only the first D + 1 are given, in a global order that puts large segments
    first and empty ones last: two sequences of equally many segments that differ in at most D
    share one among the first D + 1 of each.
    """
    n = len(u)
    largest = n * 100 // percent
    lows = size_classes(largest + 1)
    own, last = (int(k) - 1 for k in np.searchsorted(lows, (n, largest), "right"))
    keys = []
    for c in range(own, last + 1):
        top = lows[c + 1] - 1
        fragments = 2 * top * (100 - percent) // (100 + percent) + top // 50 + 3
        partner = max(n, min(largest, top))
        spoilt = (100 - percent) * (n + partner) // (100 + percent)
        frag = ((u >> np.uint64(32)) * np.uint64(fragments)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate(([True], frag[1:] != frag[:-1])))
        sizes = np.diff(np.append(first, n))
        tag = mix(np.uint64(c << 40) + frag[first])
        key = mix(np.add.reduceat(mix(u), first) + tag + sizes.astype(np.uint64))
        order = np.lexsort((key, -sizes))[:spoilt + 1]
        keys.append(key[order])
        if len(key) <= spoilt:
            none = np.setdiff1d(np.arange(fragments, dtype=np.uint64), frag[first])
            none = mix(mix(np.uint64(c << 40) + none) ^ np.uint64(7))
            keys.append(np.sort(none)[:spoilt + 1 - len(key)])
    return np.concatenate(keys) >> np.uint64(64 - KEY_BITS)


def set_digests(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, n_shingles, d1, d2): size and 128-bit digest of each document's set."""
    def run(batches):
        for batch in batches:
            data, off = buffers(column(batch, "text"))
            size, d1, d2 = [], [], []
            for i, j in slices(off):
                for u in shingle_sets(data[off[i]:off[j]], off[i:j + 1] - off[i], n):
                    size.append(len(u))
                    x, y = digest(u)
                    d1.append(x)
                    d2.append(y)
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), pa.array(size, pa.int64()), pa.array(d1, pa.int64()),
                 pa.array(d2, pa.int64())], ["doc_id", "n_shingles", "d1", "d2"])
    return doc_texts(docs).mapInArrow(frugal(run), "doc_id long, n_shingles long, d1 long, d2 long")


def segments(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(key, doc_id): segment keys of the documents; of equal sets in one task, only the
    first document's (the digests join equal sets), which keeps hot copies from the shuffle."""
    def run(batches):
        seen = set()
        for batch in batches:
            ids = column(batch, "doc_id").to_numpy(zero_copy_only=False)
            data, off = buffers(column(batch, "text"))
            for i, j in slices(off):
                keys, owner = [], []
                for k, u in enumerate(shingle_sets(data[off[i]:off[j]], off[i:j + 1] - off[i], n)):
                    mark = digest(u)
                    if len(u) == 0 or mark in seen:
                        continue
                    seen.add(mark)
                    keys.append(segment_keys(u, percent))
                    owner.append(np.full(len(keys[-1]), ids[i + k], np.int64))
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys).view(np.int64)),
                         pa.array(np.concatenate(owner))], ["key", "doc_id"])
    return doc_texts(docs).mapInArrow(frugal(run), "key long, doc_id long")


def overlaps(pairs: DataFrame, texts: DataFrame, n: int,
             differences: bool = False) -> DataFrame:
    """Sizes and exact overlap of pairs (a, b) of doc_ids: (a, b, na, nb, both[, lack, extra]).

    Partial overlaps are counted per vertical partition of the hash order, then summed. ``lack``
    and ``extra`` are the elements of a that b lacks and those that only b has, given with
    ``differences`` where the pairs' column ``grouped`` is true.
    """
    def run(batches):
        last_a, last = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                a, b = (column(part, c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
                new = np.flatnonzero(np.concatenate(([a[0] != last_a], a[1:] != a[:-1])))
                lefts = packed_sets(column(part, "za").take(pa.array(new)), n)
                fresh = set(new.tolist())
                rows, parts, lack, extra = [], [], [], []
                wanted = column(part, "grouped").to_pylist()
                for k, v in enumerate(packed_sets(column(part, "zb"), n)):
                    if k in fresh:
                        last_a, last = a[k], next(lefts)
                    spot = np.minimum(np.searchsorted(last, v), max(len(last) - 1, 0))
                    common = v[last[spot] == v] if len(last) and len(v) else v[:0]
                    rows.append((a[k], b[k], len(last), len(v)))
                    parts.append(np.bincount((common >> np.uint64(61)).astype(np.int64),
                                             minlength=PARTS))
                    for out, own in ((lack, last), (extra, v)):
                        out.append(np.setdiff1d(own, common, assume_unique=True).view(np.int64)
                                   if wanted[k] else None)
                cols = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*cols, *(pa.array(x, pa.list_(pa.int64())) for x in (parts, lack, extra))],
                    ["a", "b", "na", "nb", "parts", "lack", "extra"])
    if not differences:
        pairs = pairs.select("a", "b", F.lit(False).alias("grouped"))
    left = texts.select(F.col("doc_id").alias("a"), F.col("z").alias("za"))
    heads = pairs.select("a").distinct()
    if heads.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS:  # only texts of an a are shuffled then
        left = left.join(F.broadcast(heads), "a", "left_semi")
    right = texts.select(F.col("doc_id").alias("b"), F.col("z").alias("zb"))
    found = (right.join(small(pairs), "b").join(left, "a")
             .select("a", "za", "b", "zb", "grouped")
             .mapInArrow(frugal(run), "a long, b long, na long, nb long, parts array<long>, "
                              "lack array<long>, extra array<long>"))
    return found.select("a", "b", "na", "nb", F.aggregate("parts", F.lit(0).cast("long"),
                                                          lambda x, y: x + y).alias("both"),
                        *(["lack", "extra"] if differences else []))


def around_consensus(near: DataFrame, percent: int) -> DataFrame:
    """Differences of each group's members from the group's consensus, for groups of two or more
    members around a leader: (l, x, c, w, lack, extra).

    c is the consensus set's size. It comes from about ``SAMPLE`` members a group, which decide
    only how short prefixes are: any consensus gives the same links.
    """
    size = written(near.groupBy("a").agg(F.count(F.lit(1)).alias("m")).where("m > 1"), "groups")
    near = near.join(small(size), "a").withColumn("close", F.expr("2 * both >= na + nb - both"))
    some = near.where("close").where(F.pmod(F.xxhash64("b"), F.col("m")) < SAMPLE)
    voters = some.groupBy("a").agg(F.count(F.lit(1)).alias("voters"))
    votes = (some.select("a", F.explode("lack").alias("e"), F.lit(True).alias("held"))
             .union(some.select("a", F.explode("extra"), F.lit(False)))
             .groupBy("a", "e", "held")
             .agg(F.count(F.lit(1)).alias("near"))
             .join(voters, "a").where("2 * near > voters"))
    lists = votes.groupBy("a").agg(F.expr("collect_list(e) filter (where held)").alias("off"),
                                   F.expr("collect_list(e) filter (where not held)").alias("on"))
    none = F.expr("cast(array() as array<long>)")
    off, on = (F.coalesce(F.col(c), none) for c in ("off", "on"))
    return (near.join(lists, "a", "left")
            .select(F.col("a").alias("l"), F.col("b").alias("x"),
                    (F.col("na") - F.size(off) + F.size(on)).alias("c"),
                    F.concat(F.array_except("lack", off), F.array_except(on, "extra"))
                    .alias("lack"),
                    F.concat(F.array_except("extra", on), F.array_except(off, "lack"))
                    .alias("extra"))
            .withColumn("w", 100 * F.size("lack") + percent * F.size("extra")))


def shared_differences(at: DataFrame) -> DataFrame:
    """(l, x, d): of the members (l, x, cx, buckets, lack, extra) the differences that members of
    two components cx of group l have, as only these can connect them; each is one number, the
    rarest of a group first.

    Differences travel as lists, one for each of a group's buckets, of which there are as many as
    its size asks for: a small group is in one task, and a large one in many.
    """
    def run(batches):
        for batch in batches:
            l, x, cx, buckets = (column(batch, c).to_numpy(zero_copy_only=False)
                                 for c in ("l", "x", "cx", "buckets"))
            lack, extra = (column(batch, c) for c in ("lack", "extra"))
            row, bucket, lists = [], [], []
            for k, n in enumerate(buckets):
                e = np.concatenate([lack[k].values.to_numpy(), extra[k].values.to_numpy()])
                e &= (1 << ELEMENT_BITS) - 1
                part = e % n
                order = np.argsort(part, kind="stable")
                there, first = np.unique(part[order], return_index=True)
                row.append(np.full(len(there), k))
                bucket.append(there)
                lists += np.split(e[order], first[1:]) if len(there) else []
            if lists:
                row = np.concatenate(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(l[row]), pa.array(np.concatenate(bucket)), pa.array(x[row]),
                     pa.array(cx[row]), pa.array(lists, pa.list_(pa.int64()))],
                    ["l", "bucket", "x", "cx", "e"])
    holders = Window.partitionBy("l", "bucket", "e")
    rank = F.expr(f"shiftleft(least(v, {(1 << 63 - ELEMENT_BITS) - 1}), {ELEMENT_BITS}) | e")
    return (at.mapInArrow(frugal(run), "l long, bucket long, x long, cx long, e array<long>")
            .repartition("l", "bucket")
            .select("l", "bucket", "x", "cx", F.explode("e").alias("e"))
            .select("l", "bucket", "x", "e", F.count(F.lit(1)).over(holders).alias("v"),
                    F.min("cx").over(holders).alias("least"),
                    F.max("cx").over(holders).alias("most"))
            .where("least <> most")
            .groupBy("l", "bucket", "x").agg(F.collect_list(rank).alias("d"))
            .groupBy("l", "x").agg(F.sort_array(F.flatten(F.collect_list("d"))).alias("d")))


def jaccard_links(docs: DataFrame, n: int = 5, percent: int = 80):
    """Returns (sets, links): per document (doc_id, n_shingles, rep) and exact links (a, b)
    between representatives, enough of them to connect each class.

    ``n`` words make a shingle; two sets link when 100 * overlap >= percent * union. Words are
    runs of non-white-space with A-Z lower-cased; with fewer than ``n`` words the whole sequence
    is one shingle. Null or wordless texts have an empty set (rep null) and no links. Rows with a
    null doc_id are left out; rows that share a doc_id are one node with the links of any of its
    texts. Extra columns are ignored; an empty table gives empty results.
    """
    sets = written(set_digests(docs, n), "set-digests")
    reps = (sets.where("n_shingles > 0").groupBy("d1", "d2")
            .agg(F.min("doc_id").alias("rep")))
    sets = written(sets.join(reps, ["d1", "d2"], "left")
                   .select("doc_id", "n_shingles", "rep"), "set-representatives")
    # rows of one doc_id with different texts, or of one set with different ids
    same = sets.where("rep <> doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    key = Window.partitionBy("key").orderBy("doc_id")
    # grouped: a third document has the segment, so there are pairs without the leader
    third = (F.row_number().over(key) > 2) | F.lead("doc_id").over(key).isNotNull()
    met = (segments(docs, n, percent).withColumn("leader", F.first("doc_id").over(key))
           .withColumn("grouped", third).where("leader <> doc_id").groupBy("leader", "doc_id")
           .agg(F.max("grouped").alias("grouped")))
    rep = sets.where("rep is not null").select("doc_id", "rep").distinct()
    stars = written(met.join(rep, "doc_id").select("leader", F.col("rep").alias("b"), "grouped")
                    .join(rep.select(F.col("doc_id").alias("leader"), F.col("rep").alias("a")),
                          "leader")
                    .where("a <> b").groupBy("a", "b").agg(F.max("grouped").alias("grouped")),
                    "stars")
    nodes = stars.select(F.col("a").alias("doc_id")).union(stars.select("b")).distinct()
    texts = written(compact(docs).join(small(written(nodes, "candidates")), "doc_id",
                                       "left_semi"), "candidate-texts")
    linked = F.expr(f"100 * both >= {percent} * (na + nb - both)")
    near = written(overlaps(stars, texts, n, differences=True), "star-overlaps")
    links = near.where(linked).select("a", "b")
    at = written(around_consensus(near.where("lack is not null"), percent),
                 "consensus-differences")
    central = at.groupBy("l").agg(F.min_by("x", "w").alias("a"), F.min("w").alias("least_w"))
    sure = (at.join(central, "l").where(f"x <> a and w + least_w <= {100 - percent} * c")
            .select("a", F.col("x").alias("b")))
    links = written(links.union(sure).distinct(), "first-links")
    comp = written(components(links.union(same)), "components")

    # pairs that are not connected yet and share enough differences from the consensus
    mine = comp.select(F.col("node").alias("x"), F.col("component").alias("cx"))
    placed = written(at.select("l", "x").distinct().join(small(mine), "x", "left")
                     .select("l", "x", F.coalesce("cx", "x").alias("cx")), "placed")
    split = placed.groupBy("l").agg(F.min("cx").alias("least"), F.max("cx").alias("most"),
                                    F.ceil(F.count(F.lit(1)) / BUCKET).alias("buckets"))
    split = small(written(split.where("least <> most").select("l", "buckets"), "split-groups"))
    placed = small(written(placed.join(split, "l"), "split-members"))
    shared = shared_differences(at.select("l", "x", "lack", "extra").join(placed, ["l", "x"]))
    low = F.lit([float(x) for x in WEIGHT_BANDS])
    spare = 100 - percent
    at = (at.select("l", "x", "w", "c", F.size("lack").alias("r"), F.size("extra").alias("p"))
          .join(placed.drop("buckets"), ["l", "x"]).join(shared, ["l", "x"])
          .where(f"100 * size(d) >= w - {spare} * c")
          .withColumn("band", F.size(F.filter(low, lambda t: t * F.col("c") <= F.col("w")))))
    at = written(at, "shared-lists")
    # a prefix for partners of each weight band there is that can share enough differences
    bands = at.groupBy("l").agg(F.collect_set("band").alias("partners"))
    at = (at.join(small(bands), "l").withColumn("partner", F.explode("partners"))
          .withColumn("from", F.get(low, F.col("partner") - 1) * F.col("c"))
          .withColumn("to", F.coalesce(F.get(low, F.col("partner")), F.lit(1e9)) * F.col("c"))
          .withColumn("need", F.greatest(
              F.lit(1), F.ceil((F.col("w") - spare * F.col("c")) / 100),
              F.ceil((F.col("w") + F.col("from") - spare * F.col("c")) / (100 + percent))))
          .where((F.col("need") <= F.size("d")) & (percent * F.col("need") <= F.col("to")))
          .select("l", "band", "partner", "x", "cx", "c", "r", "p", F.size("d").alias("n"),
                  F.posexplode(F.slice(
                      "d", F.lit(1), (F.size("d") - F.col("need") + 1).cast("int")))
                  .alias("at", "e")))
    at = written(at, "difference-prefixes")
    other = at.select("l", "e", F.col("band").alias("partner"), F.col("partner").alias("band"),
                      *[F.col(c).alias(f"{c}2") for c in ("x", "cx", "c", "r", "p", "n", "at")])
    # the first element that two members share leaves only those behind it in both to share
    more = (at.join(other, ["l", "e", "band", "partner"]).where("x < x2 and cx <> cx2")
            .where(f"{100 + percent} * least(n - at, n2 - at2, least(r, r2) + least(p, p2))"
                   f" >= 100 * (r + r2) + {percent} * (p + p2) - {spare} * greatest(c, c2)")
            .select(F.col("x").alias("a"), F.col("x2").alias("b")).distinct())
    more = written(overlaps(written(more, "more-pairs"), texts, n).where(linked), "more-links")
    return sets, links.union(more.select("a", "b"))


def near_duplicate_classes(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links): one row per row of ``docs`` with a doc_id.

    component_id is the smallest doc_id reachable by links, the document's own if it has none;
    n_links counts the verified links of its set that connect the class (equal sets apart).
    Defined results for odd input: see ``jaccard_links``.
    """
    sets, links = jaccard_links(docs, n, percent)
    same = sets.where("rep <> doc_id").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    comp = components(links.union(same))
    ends = links.select(F.col("a").alias("rep")).union(links.select("b"))
    count = ends.groupBy("rep").agg(F.count(F.lit(1)).alias("n_links"))
    return (sets.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left")
            .join(count, "rep", "left")
            .select("doc_id", "n_shingles",
                    F.coalesce("component", "doc_id").alias("component_id"),
                    F.coalesce("n_links", F.lit(0)).alias("n_links")))
