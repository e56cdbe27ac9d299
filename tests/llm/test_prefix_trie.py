import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tripdeck.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, depth int, block int, n int"
NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
         "saved_bytes", "ends_sha256")


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)


def trie(spark, rows, heads=None, every=5, size=7):
    turns = pt.conversation_turns(table(spark, rows))
    forks = table(spark, rows).where("conv_id is not null").select("conv_id").distinct()
    head = F.crc32(F.col("conv_id").cast("string")) % 9 if heads is None else F.lit(heads)
    forks = forks.withColumn("base", F.col("conv_id") - F.col("conv_id") % every).withColumn(
        "head", head.cast("long"))
    out = pt.prefix_trie(*pt.forked(turns, forks, 8), shard_size=size).collect()
    got = sorted(tuple(r[c] for c in NAMES) for r in out)
    return sorted(got, key=str)


def brute(rows, heads=None, every=5):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    paths = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9 if heads is None else heads
        base = c - int(c - every * int(c / every))
        paths[c] = tuple(own.get(base, [])[:h] + ts[h:])
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    out = []
    for p, cs in members.items():
        below = [q for q in members if q[:len(p)] == p]
        kids = [q for q in members if len(q) == len(p) + 1 and q[:len(p)] == p]
        leaves = [q for q in below if not any(x[:len(q)] == q and len(x) == len(q) + 1
                                              for x in members)]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = ",".join(map(str, sorted(c for c in cs if paths[c] == p)))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(kids),
                    len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed, size=60):
    rng = random.Random(seed)
    words = ["yes", "no", "é", "why", "", None]
    rows, done = [], []
    for c in rng.sample(range(-20, 200), size):
        turns = [(rng.choice(["user", "assistant", None]), rng.choice(words))
                 for _ in range(rng.randint(1, 12))]
        if done and rng.random() < 0.6:
            turns = rng.choice(done)[:rng.randint(1, 12)] + turns[:rng.randint(0, 2)]
        done.append(turns)
        numbers = rng.sample(range(100), len(turns))
        numbers = sorted(numbers) if rng.random() < 0.9 else [None, *sorted(numbers)[1:]]
        rows += [(c, n, *t) for n, t in zip(numbers, turns, strict=True)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,heads,block", [(0, None, 4096), (1, 0, 3), (2, 2, 2)])
def test_matches_brute_force(spark, monkeypatch, seed, heads, block):
    monkeypatch.setattr(pt, "TURN_BLOCK", block)
    rows = conversations(seed)
    assert trie(spark, rows, heads) == brute(rows, heads)


def test_one_hot_path_one_long_conversation_and_turnless_ones(spark, monkeypatch):
    monkeypatch.setattr(pt, "TURN_BLOCK", 16)
    monkeypatch.setattr(pt, "CHUNK_BYTES", 60)
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 400, 5) for t in range(4)]
    rows += [(c, t, "user", f"turn {t}") for c in (1001, 2001) for t in range(60)]
    rows += [(c, 0, "user", "alone") for c in (3004, 3009, 3014)]   # base absent, head longer
    assert trie(spark, rows, 3) == brute(rows, 3)


def test_repeated_rows_null_ids_and_an_empty_table(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, None, None), (None, 0, "user", "a"),
            (2, None, "", ""), (2, 5, "user", "a")]
    assert trie(spark, rows, 0) == brute(rows, 0)
    assert trie(spark, []) == []


def test_equal_turns_with_other_roles_are_other_nodes(spark):
    rows = [(1, 0, "user", "a"), (2, 0, "assistant", "a"), (3, 0, "usera", "")]
    assert [r[:4] for r in trie(spark, rows, 0)] == [(1, 0, None, 3), (1, 1, 1, 1), (2, 1, 1, 1),
                                                     (3, 1, 1, 1)]
