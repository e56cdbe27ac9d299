import re

import numpy as np
import pyarrow as pa

from tripdeck.llm import text as tx

TEXTS = ["", None, "a", " a\tb ", "éa b c d", "x" * 5000, "A b", "a\x0bb\x0cc", "end"]


def test_words_match_the_pattern_and_hash_by_content():
    data, off = tx.buffers(pa.array(TEXTS))
    w = tx.Words(data, off, tx.spaced_words())
    exp = [re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode()) for t in TEXTS]
    assert w.counts.tolist() == [len(e) for e in exp]
    flat = [x for e in exp for x in e]
    assert [w.text(k) for k in range(len(w))] == flat
    seen = {}
    for x, h in zip(flat, w.hashes().tolist(), strict=True):
        assert seen.setdefault(x, h) == h
    assert len(set(seen.values())) == len(seen)


def test_slices_cover_all_rows_and_long_words_hash_alike(monkeypatch):
    data, off = tx.buffers(pa.array(TEXTS * 3))
    whole = tx.Words(data, off, tx.spaced_words()).hashes()
    monkeypatch.setattr(tx, "SLICE_BYTES", 7)
    assert (tx.Words(data, off, tx.spaced_words()).hashes() == whole).all()
    ranges = list(tx.slices(off, 7))
    assert [a for a, _ in ranges[1:]] == [b for _, b in ranges[:-1]]
    assert ranges[0][0] == 0 and ranges[-1][1] == len(off) - 1


def test_ngrams_depend_on_order_and_length():
    h = np.array([1, 2, 1, 2, 3], np.uint64)
    two = tx.ngrams(h, 2)
    assert two[0] == two[2] and len(set(two.tolist())) == 3
    assert len(tx.ngrams(h, 6)) == 0
    assert not set(two.tolist()) & set(tx.ngrams(h, 3).tolist())


def test_compact_round_trip(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = {r.doc_id: bytes(r.z) for r in tx.compact(df).collect()}
    data, off = tx.unpack(pa.array([rows[k] for k in range(len(TEXTS))], pa.binary()))
    got = [data[a:b].tobytes().decode() for a, b in zip(off[:-1], off[1:], strict=True)]
    assert got == [t or "" for t in TEXTS]


def test_texts_come_in_batches_of_a_few_megabytes(spark):
    from tripdeck.llm.stages import BATCH_BYTES, BATCH_CONF
    from tripdeck.llm.text import doc_texts
    before = spark.conf.get(BATCH_CONF, None)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])],
                                             ["n", "size"])

    def met():
        docs = spark.range(4000, numPartitions=1).selectExpr(
            "id as doc_id", "repeat('abcdefghij', 500) as text")
        return doc_texts(docs).mapInArrow(sizes, "n long, size long").collect()
    try:
        spark.conf.unset(BATCH_CONF)
        out = met()
        assert sum(r.n for r in out) == 4000
        assert max(r["size"] for r in out) < 1.1 * BATCH_BYTES
        spark.conf.set(BATCH_CONF, "64m")      # the session's own limit holds
        assert max(r["size"] for r in met()) > 10 << 20
    finally:
        spark.conf.unset(BATCH_CONF)
        if before is not None:
            spark.conf.set(BATCH_CONF, before)
