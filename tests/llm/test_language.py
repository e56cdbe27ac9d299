import numpy as np
import pytest
from conftest import SF_ORACLE
from fixtures import frame
from pyspark.sql import functions as F

from tripdeck.llm import language as lg
from tripdeck.llm.queries import REGISTRY


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select("doc_id", "lang")
    out = REGISTRY["op9_language_id"](spark, SF_ORACLE)
    rows = out.join(docs, "doc_id").where("held_out and lang is not null").collect()
    assert len(rows) > 150
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


ES, DE = "el perro come la carne con los amigos", "der hund und die katze gehen schlafen"


@pytest.fixture(scope="module")
def model(spark):
    rows = [("es", ES)] * 4 + [("de", DE)] * 4 + [(None, "zzz"), ("es", None), ("de", "")]
    return lg.fit(spark.createDataFrame(rows, "lang string, text string"))


def test_mixtures_and_odd_texts(spark, model):
    assert model.names == ["de", "es"]
    texts = [ES, DE, f"{ES} {ES} {DE} {ES}", f"{DE} {DE} {ES}", None, "", "123 !? —", "perro", "日本"]
    out = {r.doc_id: r for r in lg.languages(frame(spark, enumerate(texts)), model).collect()}
    assert [out[k].lang_pred for k in range(9)][:8] == ["es", "de", "es", "de", "und", "und", "und",
                                                        "es"]
    assert out[8].lang_pred in model.names
    assert out[0].lang_set == ["es"] and out[1].lang_set == ["de"]
    assert out[2].lang_set == ["es", "de"] and out[3].lang_set == ["de", "es"]
    assert abs(out[2].lang_shares[0] - 24 / 31) < 0.1 and abs(sum(out[2].lang_shares) - 1) < 1e-5
    assert out[4].score == 0 and out[4].lang_set == [] and out[4].source == "s"


def test_counts_and_em_match_plain_python(model):
    data = np.frombuffer(f"{ES} {DE}".encode(), np.uint8)
    grams = lg.Grams(data, np.array([0, len(data)]))
    full, share, chosen = lg.mixtures(model, grams, 5, 0.02, 2.0)
    ll = np.array([[model.logp[k, grams.bucket[a:b]].sum() for k in range(2)]
                   for a, b in zip(grams.first, [*grams.first[1:], len(grams.bucket)], strict=True)])
    lik, pi = np.exp(ll - ll.max(1, keepdims=True)), np.full(2, 0.5)
    for _ in range(5):
        r = lik * pi
        pi = (r / r.sum(1, keepdims=True)).mean(0)
    assert np.allclose(share[0], pi, atol=1e-4) and full.tolist() == [0]


def test_nothing_learnt_empty_table_and_too_many_languages(spark):
    docs = frame(spark, [(1, "abc"), (1, "abc")])
    none = lg.fit(docs.where("false"))
    assert [r.lang_pred for r in lg.languages(docs, none).collect()] == ["und", "und"]
    assert lg.languages(docs.where("false"), none).collect() == []
    with pytest.raises(ValueError):
        lg.fit(docs.withColumn("lang", F.monotonically_increasing_id()), max_languages=1)
