"""Costly steps that a write, an ingest or a comparison needs once are made once."""

from __future__ import annotations

from conftest import SF_SMALL
from pyspark.sql import functions as F

from tripdeck.operators import models as md
from tripdeck.operators.partitions import PartitionSet, PartitionSpec
from tripdeck.plans import queries
from tripdeck.session import scratch_path
from tripdeck.sinks import tables
from tripdeck.sources import files, testdata
from tripdeck.sources.schemas import PARTITION_KEYS
from tripdeck.streaming import monthly_ingest


def _counted(spark):
    """An accumulator and a predicate, true for every row, that counts its calls."""
    calls = spark.sparkContext.accumulator(0)

    def seen(_):
        calls.add(1)
        return True
    return calls, F.udf(seen, "boolean")


def test_replace_evaluates_the_spec_once_a_row(spark):
    calls, seen = _counted(spark)

    class Spec(PartitionSpec):
        def predicate(self):
            return seen(F.col("source_year"))
    db = f"once_{abs(hash(scratch_path(spark, 'x'))) % 10**8}"
    tables.ensure_database(spark, db, scratch_path(spark, db))
    rows = spark.createDataFrame([(i, "yellow", 2020, 1 + i % 2) for i in range(30)],
                                 "n int, service_type string, source_year int, source_month int")
    obs = tables.replace_partitions(rows, f"{db}.t", Spec(2020, 2020), "R")
    assert obs.get["rows"] == 30 and calls.value == 30
    assert sorted(tuple(p) for p in obs.get["partitions"]) == [("yellow", 2020, 1),
                                                               ("yellow", 2020, 2)]
    assert spark.table(f"{db}.t").columns == ["n", *PARTITION_KEYS]


def test_monthly_files_make_each_row_once(spark):
    calls, seen = _counted(spark)
    rows = (testdata.raw_trips(spark, SF_SMALL, "yellow").withColumn("service_type",
                                                                     F.lit("yellow")))
    root = scratch_path(spark, "once")
    files.write_monthly_files(rows.where(seen("trip_distance")), root)
    n = rows.count()
    assert calls.value == n
    spec = PartitionSpec(1995, 2001)
    read = files.read_monthly_files(spark, root, "yellow", spec)
    want = rows.groupBy(*PARTITION_KEYS).count()
    got = read.groupBy(*PARTITION_KEYS).count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_drifted_layouts_join_the_lines_once(spark, monkeypatch):
    calls, seen = _counted(spark)
    made = testdata.raw_trips
    monkeypatch.setattr(testdata, "raw_trips",
                        lambda *a: made(*a).where(seen("trip_distance")))
    rows = queries.REGISTRY["ingest_drifted_types"](spark, SF_SMALL).collect()
    assert calls.value == sum(made(spark, SF_SMALL, s).count() for s in ("yellow", "green"))
    assert sum(r["rows"] for r in rows) == calls.value


def test_a_set_of_partitions_is_tested_by_numbers(spark):
    keys = (("green", 2020, 1), ("yellow", 2019, 12), ("yellow", 2020, 101))
    rows = spark.createDataFrame([*keys, ("yellow", 2020, 1), ("yellow", 2021, 1),
                                  ("green", 2019, 12), (None, 2020, 1), ("green", None, 1)],
                                 "service_type string, source_year int, source_month int")
    kept = rows.where(PartitionSet(keys).predicate())
    assert sorted(map(tuple, kept.collect())) == sorted(keys)
    assert "struct" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert rows.where(PartitionSet(()).predicate()).count() == 0


def test_keys_are_cut_from_paths_of_any_layout(spark):
    paths = ["/l/yellow_tripdata_2020-01.parquet/part-0.parquet", "/l/yellow_tripdata_2019-12.parquet"]
    odd = ["/l/yellow_tripdata_2020-02.parquet/x_tripdata_y.parquet"]
    want = [("yellow", 2020, 1), ("yellow", 2019, 12), ("yellow", 2020, 2)]
    df = spark.createDataFrame([(p,) for p in paths + odd], "path string")
    for given, some, keys in ((paths, paths, want[:2]), (paths + odd, paths + odd, want)):
        got = df.where(F.col("path").isin(some)).select(
            *[c.alias(k) for k, c in files.keys_of_paths(F.col("path"), "yellow", given).items()])
        assert sorted(map(tuple, got.collect())) == sorted(keys)
    none = spark.createDataFrame([("/l/other.parquet",)], "path string").select(
        *[c.alias(k) for k, c in files.keys_from_path(F.col("path")).items()]).first()
    assert tuple(none) == ("", None, None)


def test_a_batch_parses_each_path_once(spark):
    batch = spark.createDataFrame(
        [("/l/yellow_tripdata_2020-01.parquet/p",)] * 3 + [("/l/green_tripdata_2020-02.parquet",)],
        "path string")
    assert monthly_ingest.touched_partitions(batch, "yellow").keys == (("yellow", 2020, 1),)


def test_settings_with_l1_share_one_pass(spark, monkeypatch):
    passes = []
    whole = md.moments_by_key
    monkeypatch.setattr(md, "moments_by_key", lambda rows: passes.append(1) or whole(rows))
    df = md.assemble(spark.range(60).selectExpr("cast(id as double) a", "sin(id) b",
                                                "3.0 * id + cos(id) y"), ["a", "b"])
    df = df.select("y", "features")
    lasso, net = md.Setting("lasso", 0.1, 1.0), md.Setting("elasticnet", 0.1, 0.5)
    grids = [([lasso, net], "reference", "r"), ([lasso], "library", "l")]
    got = md.grid_searches(spark, df, df, grids).collect()
    assert len(passes) == 1
    single = [r for g in grids for r in md.grid_search(spark, df, df, *g).collect()]
    assert [r[:12] for r in got] == [r[:12] for r in single]
