"""The trie of conversation prefixes by the splitter skeleton of a range partition.

A conversation is the path of its turns, every distinct prefix a node. A node's key is the xor of
a hash of each turn and its place, 128 bits, so prefixes of any length are found by running xors
over blocks of turns. Nodes with the same members lie on one unbranched chain, told by their
smallest member and number of members; paths are written as the chains they pass that more than
one conversation shares. A path that meets k chains needs k other conversations of lengths from 1
to k, so with N turns in all it has at most sqrt(2 N) entries, however long a conversation is.

The paths, with the conversations' ids to part equal ones, are sorted in shards between splitters
taken from a sample. Chains on the splitters' paths, the skeleton, can lie in several shards and
are broadcast as a trie; every other chain lies in one shard, which finishes it in one run over
its sorted paths with a stack as deep as the path. Of skeleton chains the shards give partial
counts, which are summed per chain and completed with what the skeleton's own chains add.
"""

from __future__ import annotations

import bisect
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripdeck.llm.stages import small, written
from tripdeck.llm.text import column

TURN_BLOCK = 4096        # turns of a conversation that one window takes in
SHARD_ROWS = 100_000     # conversations of a shard, about
CHUNK_BYTES = 1 << 16    # ids of a skeleton chain's ends that travel in one row
NO_ENDS = hashlib.sha256(b"").hexdigest()


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, t1, t2, bytes): the turns of each conversation, numbered from 1 by ``turn``,
    nulls first, then role, then a hash of role and text; as 128-bit hashes of role and text and
    UTF-8 lengths of text. Null roles and texts count as empty; rows without conv_id are left out.

    Turns are sorted over the whole table, so a conversation may take any number of tasks.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = (conversations.where("conv_id is not null")
             .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"),
                     F.xxhash64(role, text).alias("t1"), F.xxhash64(F.lit(1), role, text).alias("t2"),
                     F.octet_length(text).cast("long").alias("bytes"),
                     F.monotonically_increasing_id().alias("row")))
    rows = written(turns.repartitionByRange("conv_id", "turn", "role", "t1", "row")
                   .withColumn("block", F.spark_partition_id()), "sorted-turns")
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    # at most one conversation goes on into each block
    before = (rows.groupBy("conv_id", "block").count()
              .withColumn("before", F.sum("count").over(earlier)).where("before > 0")
              .select("conv_id", "block", "before"))
    own = Window.partitionBy("conv_id", "block").orderBy(F.asc_nulls_first("turn"), "role", "t1",
                                                         "row")
    return (rows.withColumn("at", F.row_number().over(own))
            .join(F.broadcast(before), ["conv_id", "block"], "left")
            .select("conv_id", (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos"), "t1",
                    "t2", "bytes"))


def forked(turns: DataFrame, forks: DataFrame, longest: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are another one's: (paths, lengths).

    ``forks`` (conv_id, base, head) names every conversation: its first ``head`` (at most
    ``longest``) turns are those of ``base`` as far as there are any, its own turns follow from
    number head + 1 on. paths: (conv_id, depth, last, t1, t2, bytes); lengths: (conv_id, len).
    """
    sizes = written(turns.groupBy("conv_id").agg(F.max("pos").alias("n")), "turn-counts")
    forks = (forks.join(sizes, "conv_id", "left")
             .join(sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")),
                   "base", "left")
             .withColumn("taken", F.least("head", F.coalesce("base_n", F.lit(0))))
             .withColumn("len", F.col("taken") + F.greatest(
                 F.coalesce("n", F.lit(0)) - F.col("head"), F.lit(0))))
    forks = written(forks.select("conv_id", "base", "head", "taken", "len"), "forks")
    some = small(forks)
    heads = (turns.where(F.col("pos") <= longest).withColumnRenamed("conv_id", "base")
             .join(some, "base").where("pos <= head")
             .select("conv_id", F.col("pos").alias("depth"), "len", "t1", "t2", "bytes"))
    rest = (turns.join(some, "conv_id").where("pos > head")
            .select("conv_id", (F.col("pos") - F.col("head") + F.col("taken")).alias("depth"),
                    "len", "t1", "t2", "bytes"))
    paths = heads.union(rest).withColumn("last", F.expr("depth = len")).drop("len")
    return written(paths, "paths"), forks.select("conv_id", "len")


def keyed(paths: DataFrame) -> DataFrame:
    """``paths`` with the node's key (k1, k2), its parent's (p1, p2) and ``total``, the bytes of
    all turns up to it: running values in blocks of turns, and what the blocks before them add."""
    paths = (paths.withColumn("block", F.floor((F.col("depth") - 1) / TURN_BLOCK))
             .withColumn("h1", F.xxhash64("t1", "depth")).withColumn("h2", F.xxhash64("t2", "depth")))
    run = (Window.partitionBy("conv_id", "block").orderBy("depth")
           .rowsBetween(Window.unboundedPreceding, 0))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)
    long = paths.where(F.col("depth") > TURN_BLOCK).select("conv_id").distinct()
    before = (paths.join(small(written(long, "long-conversations")), "conv_id", "left_semi")
              .groupBy("conv_id", "block")
              .agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2"),
                   F.sum("bytes").alias("s"))
              .select("conv_id", "block", F.bit_xor("x1").over(earlier).alias("b1"),
                      F.bit_xor("x2").over(earlier).alias("b2"), F.sum("s").over(earlier).alias("bs"))
              .where("block > 0"))
    zero = F.lit(0).cast("long")
    return (paths.withColumn("r1", F.bit_xor("h1").over(run))
            .withColumn("r2", F.bit_xor("h2").over(run)).withColumn("rs", F.sum("bytes").over(run))
            .join(before, ["conv_id", "block"], "left")
            .withColumn("k1", F.col("r1").bitwiseXOR(F.coalesce("b1", zero)))
            .withColumn("k2", F.col("r2").bitwiseXOR(F.coalesce("b2", zero)))
            .select("conv_id", "depth", "last", "bytes", "k1", "k2",
                    F.col("k1").bitwiseXOR(F.col("h1")).alias("p1"),
                    F.col("k2").bitwiseXOR(F.col("h2")).alias("p2"),
                    (F.col("rs") + F.coalesce("bs", zero)).alias("total")))


class Skeleton:
    """The trie of the splitters' paths: node 0 is the root, ``child`` maps (node, step) to a node
    and ``weight`` holds each node's own savings."""

    def __init__(self, splitters):
        self.child, self.parent, self.weight = {}, [-1], [0]
        for key, _, weights in splitters:
            node = 0
            for k, w in enumerate(weights):
                step = key[16 * k:16 * k + 16]
                if (node, step) not in self.child:
                    self.child[node, step] = len(self.parent)
                    self.parent.append(node)
                    self.weight.append(w)
                node = self.child[node, step]


class Open:
    """A chain on the stack of a shard."""

    __slots__ = ("children", "digest", "ends", "first", "id", "leaves", "least", "n", "saved",
                 "weight")

    def __init__(self, id_: int, weight: int):
        self.id, self.weight = id_, weight       # id: place in the skeleton, or -1
        self.n = self.children = self.leaves = self.saved = 0
        self.least = self.digest = None
        self.ends, self.first = [], None


def shard_results(rows, skeleton: Skeleton):
    """One run over sorted (shard, key, conv_id, weights, tail) rows. Yields ("chain", least, n,
    children, leaves, saved, digest) for finished chains, ("part", id, least, n, children, leaves,
    saved) for skeleton chains and ("ends", id, first, ids) for the ends of these, in order."""
    stack, steps, shard = [], [], None

    def flush(c):
        chunk = ",".join(map(str, c.ends)).encode()
        c.ends = []
        if c.id < 0:
            if c.digest is None:
                c.digest = hashlib.sha256(chunk)
            else:
                c.digest.update(b"," + chunk)
            return None
        return ("ends", c.id, c.first, chunk)

    def close(depth):
        while len(stack) > depth:
            c = stack.pop()
            steps.pop()
            if c.ends:
                out = flush(c)
                if out:
                    yield out
            if c.id >= 0:
                yield ("part", c.id, c.least, c.n, c.children, c.leaves, c.saved)
                add = (0, c.leaves, c.saved)   # its own share is added to the skeleton later
            else:
                leaves, saved = c.leaves if c.children else 1, c.saved + c.weight
                digest = c.digest.hexdigest() if c.digest else NO_ENDS
                yield ("chain", c.least, c.n, c.children, leaves, saved, digest)
                add = (1, leaves, saved)
            if stack:
                top = stack[-1]
                top.children += add[0]
                top.leaves += add[1]
                top.saved += add[2]
                top.n += c.n
                top.least = c.least if top.least is None else min(top.least, c.least)

    for own, key, conv, weights, tail in rows:
        if own != shard:
            yield from close(0)
            stack.append(Open(0, 0))
            steps.append(b"")
            shard = own
        path = [key[k:k + 16] for k in range(0, len(key), 16)]
        same = 0
        while same < len(path) and same + 1 < len(stack) and steps[same + 1] == path[same]:
            same += 1
        yield from close(same + 1)
        for k in range(same, len(path)):
            up = stack[-1].id
            stack.append(Open(skeleton.child.get((up, path[k]), -1) if up >= 0 else -1,
                              weights[k]))
            steps.append(path[k])
        c = stack[-1]
        c.n += 1
        c.least = conv if c.least is None else min(c.least, conv)
        if tail:
            c.children += 1
            c.leaves += 1
        else:
            if not c.ends:
                c.first = conv
            c.ends.append(conv)
            if len(c.ends) * 12 >= CHUNK_BYTES:
                out = flush(c)
                if out:
                    yield out
    yield from close(0)


SHARD_KIND = ("kind string, id long, least long, n long, children long, leaves long, saved long, "
              "digest string, ids binary")


def shard_rows(results):
    """Arrow batches of ``shard_results``, in the columns of ``SHARD_KIND``."""
    def row(r):
        if r[0] == "chain":
            return (r[0], None, *r[1:6], r[6], None)
        if r[0] == "part":
            return (*r, None, None)
        return (r[0], r[1], r[2], None, None, None, None, None, r[3])
    kinds = [pa.string(), *[pa.int64()] * 6, pa.string(), pa.binary()]
    names = [c.split()[0] for c in SHARD_KIND.split(", ")]
    rows = []

    def batch():
        cols = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)
    for r in results:
        rows.append(row(r))
        if len(rows) >= 10_000:
            yield batch()
            rows.clear()
    if rows:
        yield batch()


def shards_done(members: DataFrame, shard_size: int):
    """The shards' results over ``members`` (conv_id, key, weights, tail), and the skeleton."""
    spark = members.sparkSession
    count = members.count()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-count // shard_size))
    sample = sorted((bytes(r["key"]), r["conv_id"], r["weights"]) for r in
                    members.orderBy(F.xxhash64("conv_id"), "conv_id").limit(16 * shards)
                    .select("key", "conv_id", "weights").collect())
    splitters = [sample[k * len(sample) // shards] for k in range(1, shards)] if sample else []
    bounds = sorted({s[:2] for s in splitters})
    skeleton = Skeleton(splitters)

    def deal(batches):
        for batch in batches:
            spot = [bisect.bisect_right(bounds, pair) for pair in
                    zip(column(batch, "key").to_pylist(), column(batch, "conv_id").to_pylist(),
                        strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(spot, pa.int32()), *(column(batch, c) for c in names)],
                ["shard", *names])
    names = ["conv_id", "key", "weights", "tail"]

    def solve(batches):
        def each():
            for batch in batches:
                yield from zip(*(column(batch, c).to_pylist() for c in
                                 ("shard", "key", "conv_id", "weights", "tail")), strict=True)
        yield from shard_rows(shard_results(each(), skeleton))
    dealt = members.select(*names).mapInArrow(
        deal, "shard int, conv_id long, key binary, weights array<long>, tail boolean")
    done = (dealt.repartition(shards, "shard").sortWithinPartitions("shard", "key", "conv_id")
            .mapInArrow(solve, SHARD_KIND))
    return written(done, "shards"), skeleton


def skeleton_results(done: DataFrame, skeleton: Skeleton):
    """(least, n, children, leaves, saved, digest) of each skeleton chain, the root first. The
    shards' parts are reduced by Spark to a row per chain."""
    parts = {r["id"]: r for r in done.where("kind = 'part'").groupBy("id").agg(
        F.min("least").alias("least"), *[F.sum(c).alias(c) for c in
                                         ("n", "children", "leaves", "saved")]).collect()}
    chunks = done.where("kind = 'ends'").select("id", F.col("least").alias("first"), "ids")

    def digest(batches):
        """The chunks come in order, whole chains to a task: one digest is open at a time."""
        last, open_ = None, None
        for batch in batches:
            for i, ids in zip(column(batch, "id").to_pylist(), column(batch, "ids").to_pylist(),
                              strict=True):
                if i != last:
                    if last is not None:
                        yield out(last, open_)
                    last, open_ = i, hashlib.sha256(ids)
                else:
                    open_.update(b"," + ids)
        if last is not None:
            yield out(last, open_)

    def out(i, h):
        return pa.RecordBatch.from_pydict({"id": [i], "digest": [h.hexdigest()]})
    ends = {r["id"]: r["digest"] for r in
            chunks.repartition("id").sortWithinPartitions("id", "first")
            .mapInArrow(digest, "id long, digest string").collect()}
    size = len(skeleton.parent)
    children = np.array([parts[k]["children"] for k in range(size)], object)
    for p in skeleton.parent[1:]:
        children[p] += 1
    # what the skeleton's own chains add to the chains above them; parents precede children
    leaves = [int(children[k] == 0) for k in range(size)]
    saved = list(skeleton.weight)
    for k in range(size - 1, 0, -1):
        leaves[skeleton.parent[k]] += leaves[k]
        saved[skeleton.parent[k]] += saved[k]
    return [(parts[k]["least"], parts[k]["n"], int(children[k]), parts[k]["leaves"] + leaves[k],
             parts[k]["saved"] + saved[k], ends.get(k, NO_ENDS)) for k in range(size)]


def prefix_trie(paths: DataFrame, lengths: DataFrame, shard_size: int = SHARD_ROWS) -> DataFrame:
    """The nodes of the trie of all conversations' prefixes, a row each: (conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_bytes, ends_sha256).

    ``paths`` (conv_id, depth, last, t1, t2, bytes) holds every turn of every conversation once,
    ``lengths`` (conv_id, len) all conversations, those without turns too (see ``forked``).

    A node is the first ``depth`` turns of ``conv_id``, its smallest member; the root has depth 0
    and no parent. n_convs: members; n_children; n_leaves: childless nodes in its subtree, itself
    included; saved_bytes: over its subtree, bytes of a node's last text times n_convs - 1;
    ends_sha256: SHA-256 of the ids of conversations that end there, ascending, joined by commas.
    Equal conversations end in one node. Without conversations there are no nodes.

    A digest needs its ids in order, so the ids (only these) of one node's ends pass through one
    task, as a stream.
    """
    spark = paths.sparkSession
    paths = written(keyed(paths), "keyed-paths")
    nodes = written(paths.groupBy("k1", "k2").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"),
        *[F.max(c).alias(c) for c in ("depth", "last", "bytes", "total", "p1", "p2")]), "nodes")
    shared = nodes.where("n > 1")
    chains = written(shared.groupBy("conv_id", "n").agg(
        F.max("depth").alias("bottom"), F.sum("bytes").alias("size"),
        F.min_by(F.struct("k1", "k2"), "depth").alias("top"),
        F.min(F.col("total") - F.col("bytes")).alias("before")), "chains")
    steps = chains.select("top.k1", "top.k2", "bottom",
                          ((F.col("n") - 1) * F.col("size")).alias("weight"))
    met = (paths.select("conv_id", "depth", "k1", "k2").join(small(steps), ["k1", "k2"])
           .groupBy("conv_id").agg(F.max("bottom").alias("bottom"), F.sort_array(F.collect_list(
               F.struct("depth", "k1", "k2", "weight"))).alias("met")))

    def word(c):
        return F.lpad(F.hex(c), 16, "0")
    key = F.unhex(F.array_join(F.transform("met", lambda m: F.concat(word(m["k1"]),
                                                                     word(m["k2"]))), ""))
    members = written(lengths.join(met, "conv_id", "left").select(
        "conv_id", F.coalesce(key, F.lit(b"")).alias("key"),
        F.coalesce(F.col("met.weight"), F.expr("cast(array() as array<long>)")).alias("weights"),
        (F.col("len") > F.coalesce("bottom", F.lit(0))).alias("tail")), "members")
    kind = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
            "n_leaves long, saved_bytes long, ends_sha256 string")
    if members.limit(1).count() == 0:
        return spark.createDataFrame([], kind)

    done, skeleton = shards_done(members, shard_size)
    root, *known = skeleton_results(done, skeleton)
    names = ["least", "n", "children", "leaves", "saved", "digest"]
    known = spark.createDataFrame([(int(a), int(b), int(c), int(d), int(e), f) for a, b, c, d, e, f
                                   in known], "least long, n long, children long, leaves long, "
                                              "saved long, digest string")
    done = done.where("kind = 'chain'").select(*names).union(known)
    done = written(done.withColumnRenamed("least", "conv_id").join(
        chains.select("conv_id", "n", "bottom", "before"), ["conv_id", "n"]), "chain-results")

    above = shared.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                          F.col("conv_id").alias("above"))
    nodes = nodes.join(small(above), ["p1", "p2"], "left").withColumn(
        "parent", F.expr(f"if(depth = 1, {int(root[0])}L, coalesce(above, conv_id))"))
    one = nodes.where("n = 1").select(
        "conv_id", "depth", "parent", "n", F.expr("if(last, 0L, 1L)"), F.lit(1).cast("long"),
        F.lit(0).cast("long"), F.when(F.col("last"), F.sha2(F.col("conv_id").cast("string"), 256))
        .otherwise(NO_ENDS))
    more = nodes.where("n > 1").join(small(done), ["conv_id", "n"]).select(
        "conv_id", "depth", "parent", "n", F.expr("if(depth = bottom, children, 1L)"), "leaves",
        F.expr("saved - (n - 1) * (total - bytes - before)"),
        F.when(F.col("depth") == F.col("bottom"), F.col("digest")).otherwise(NO_ENDS))
    least, n, *rest = root
    top = spark.createDataFrame([(int(least), 0, None, int(n), *map(int, rest[:3]), rest[3])], kind)
    return top.union(one.union(more)).toDF(*[c.split()[0] for c in kind.split(", ")])
