"""The pipeline's stages against plain Python, and the operators' queries against their SQL."""

import os
import re

import pytest
from conftest import SF_ORACLE, SF_SMALL
from oracle_harness import compare, duck
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline as cp
from tripdeck.llm import queries as lq


def test_registered_queries():
    names = entry.queries()
    assert set(lq.REGISTRY) | {"pipeline"} <= set(names)
    assert [min(n for n in names if n.startswith(f"op{k}_")) for k in range(1, 11)]


@pytest.mark.parametrize("name", sorted(lq.ORACLE))
def test_query_matches_oracle(spark, name):
    got = lq.REGISTRY[name](spark, SF_SMALL).toPandas()
    res = compare(got, duck(SF_SMALL).sql(lq.ORACLE[name]).df())
    assert res["cols"] and res["rows"][0] == res["rows"][1] and res["approx"], res


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """The smallest documents with odd rows and columns that clash with the operators' own."""
    path = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    first = docs.orderBy("doc_id").limit(1).collect()[0]
    odd = [(90_001, None, None, None, None), (90_002, "", "en", None, 0),
           (90_003, "12 34 !", None, "s", 7), (None, first.text, "en", "s", 1),
           (90_004, first.text, None, None, None),
           (90_005, first.text + " mail zed@example.org now", "en", "s", 3)]
    more = spark.createDataFrame(odd, docs.schema)
    (docs.union(more).withColumn("score", F.lit("x")).withColumn("leaks", F.lit(1))
     .withColumn("a b.c", F.lit(None).cast("int")).withColumn("z", F.lit(2))
     .write.parquet(f"{path}/documents.parquet"))
    os.symlink(f"{SF_SMALL}/benchmark.parquet", f"{path}/benchmark.parquet")
    return path


def test_stages(spark, table):
    docs = spark.read.parquet(f"{table}/documents.parquet")
    seen = [docs]
    for name, stage in cp.STAGES:
        seen.append(cp.written(stage(spark, seen[-1], table), f"test-{name}"))
    assert all(s.schema == docs.schema for s in seen[1:-1])
    ids = [{r.doc_id for r in s.select("doc_id").collect()} for s in seen]
    assert all(b <= a for a, b in zip(ids, ids[1:], strict=False))
    # language: only rows without id or letters go here
    assert ids[0] - ids[1] == {None, 90_001, 90_002, 90_003}
    # near duplicates: the copies of the first document go, one of each class stays
    assert 90_004 in ids[1] - ids[2]
    assert seen[2].count() == len(ids[2])
    # decontamination: a document that holds a whole item goes
    items = [" ".join(re.findall(r"\w+", r.text.lower())) for r in
             spark.read.parquet(f"{table}/benchmark.parquet").collect()]
    for r in seen[2].collect():
        text = " ".join(re.findall(r"\w+", r.text.lower()))
        assert (r.doc_id not in ids[3]) == any(i in text for i in items)
    # personal data: no address is left, texts without any are unchanged
    before = {r.doc_id: r.text for r in seen[3].collect()}
    for r in seen[4].collect():
        assert not re.search(r"[\w.]+@\w+\.\w+", r.text) and r.n_chars == len(r.text)
        if not re.search("[0-9@]", before[r.doc_id]):
            assert r.text == before[r.doc_id] or "[TERM]" in r.text
    assert ids[5] == ids[4] == ids[3]


def test_run_and_empty_table(spark, table, tmp_path):
    out = cp.run(spark, SF_ORACLE)
    assert out.columns[:2] == ["doc_id", "piece"] and out.count() > 500
    spark.read.parquet(f"{table}/documents.parquet").where("false").write.parquet(
        f"{tmp_path}/documents.parquet")
    os.symlink(f"{SF_SMALL}/benchmark.parquet", f"{tmp_path}/benchmark.parquet")
    assert cp.run(spark, str(tmp_path)).collect() == []


def test_language_stage_without_labels(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, "12 34", None), (None, "abc", None),
                                  (3, None, None), (4, "日本", None)],
                                 "doc_id long, text string, lang string")
    for table in (docs, docs.drop("lang")):
        out = cp.identify_language(spark, table, "")
        assert out.schema == table.schema
        assert sorted(r.doc_id for r in out.collect()) == [1, 4]
