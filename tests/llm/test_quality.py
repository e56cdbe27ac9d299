import zlib

import numpy as np
from conftest import SF_ORACLE
from fixtures import frame

from tripdeck.llm import quality as ql
from tripdeck.llm.queries import REGISTRY


def test_held_out_accuracy_and_fold(spark):
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet").select("doc_id", "quality")
    out = REGISTRY["op5_quality_classifier"](spark, SF_ORACLE)
    rows = out.join(labels, "doc_id", "left").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out and r.quality is not None]
    assert len(held) > 50
    assert np.mean([r.predicted for r in held if r.quality == 1]) > 0.97
    assert np.mean([1 - r.predicted for r in held if r.quality == 0]) > 0.9


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, score int")


def test_odd_rows_and_missing_classes(spark):
    good, bad = "a plain and simple sentence number ", "%%% *** ### $$$ buy buy buy "
    rows = [(k, (good if k % 2 else bad) * (1 + k % 5) + str(k)) for k in range(60)]
    docs = frame(spark, [*rows, (100, None), (101, ""), (102, good * 9000), (3, rows[3][1]),
                         (None, good)])
    marks = labelled(spark, [(k, k % 2, 0) for k in range(60)] + [
        (100, 1, 0), (7, None, 0), (8, 5, 0), (None, 1, 0), (999, 0, 0)])
    model = ql.fit(docs, marks)
    out = [(r.doc_id, r.score) for r in ql.quality_scores(docs, model).collect()]
    assert len(out) == 64 and all(0 <= s <= 1 for _, s in out)
    assert np.mean([(s > 0.5) == (k % 2 == 1) for k, s in out if k < 60]) > 0.95
    assert ql.fit(docs, labelled(spark, [(1, 1, 0)])) is None
    assert [r.score for r in ql.quality_scores(docs.limit(1), None).collect()] == [0.5]
    assert ql.quality_scores(docs.where("false"), model).collect() == []


def test_sizes_are_those_of_the_codecs():
    model = ql.CompressionModel([b"good words " * 300], [b"bad ### " * 300], 2000)
    text = b"good words and bad ### " * 100
    x = ql.CompressionModel.features(model.codecs(), [text])[0]
    a, b, c = (sum(len(k.compress(p)) for p in ql.pieces_of(text)) for k in model.codecs())
    assert np.allclose(x[:4], [(a - b) / (a + b), a / len(text), c / len(text), np.log(len(text) + 50)])
