"""Partition replace (idempotent, empty source clears), truncate-reload, round trip, export,
and partition pruning on the stored table."""

import uuid

import pytest

from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import raw_rows, zones_df
from tripdeck.operators.obt import obt_from_raw
from tripdeck.operators.partitions import PartitionSpec
from tripdeck.plans import obt_job, testbed
from tripdeck.session import scratch_path
from tripdeck.sinks import tables


def _table(spark, name="obt"):
    db = f"t_{uuid.uuid4().hex[:8]}"
    tables.ensure_database(spark, db, scratch_path(spark, "testdb"))
    return f"{db}.{name}"


def _content(spark, table):
    return sorted(tuple(r) for r in spark.table(table).groupBy(
        "service_type", "source_year", "source_month", "run_id").count().collect())


def test_replace_twice_equals_once(spark):
    table = _table(spark)
    spec = PartitionSpec(1995, 2001)
    obt = testbed.obt(spark, SF_SMALL, "run-1")
    tables.replace_partitions(obt, table, spec, "run-1")
    first = _content(spark, table)
    tables.replace_partitions(testbed.obt(spark, SF_SMALL, "run-1"), table, spec, "run-1")
    assert _content(spark, table) == first
    # a second run id replaces every partition, no rows duplicated
    obs = tables.replace_partitions(testbed.obt(spark, SF_SMALL, "run-2"), table, spec, "run-2")
    after = _content(spark, table)
    assert {r[3] for r in after} == {"run-2"}
    assert sum(r[4] for r in after) == sum(r[4] for r in first) == obs.get["rows"]


def test_empty_source_clears_its_partition(spark):
    table = _table(spark)
    z = zones_df(spark)
    a = obt_from_raw(raw_rows(spark, "yellow", [{"source_month": 1}, {"source_month": 2}]), z, "A")
    tables.replace_partitions(a, table, PartitionSpec(2020, 2020, (1, 2), ("yellow",)), "A")
    empty = obt_from_raw(raw_rows(spark, "yellow", [{"source_month": 1}]), z, "B").where("false")
    tables.replace_partitions(empty, table, PartitionSpec(2020, 2020, (2,), ("yellow",)), "B")
    assert _content(spark, table) == [("yellow", 2020, 1, "A", 1)]


def test_truncate_reload_replaces_whole_table(spark):
    table = _table(spark)
    z = zones_df(spark)
    tables.replace_partitions(obt_from_raw(raw_rows(spark, "yellow", [{"source_month": 1}]), z, "A"),
                              table, PartitionSpec(2020, 2020, (1,), ("yellow",)), "A")
    spec = PartitionSpec.resolve(mode="full", defaults=(2020, 2020))
    tables.write_obt(obt_from_raw(raw_rows(spark, "green", [{"source_month": 5}]), z, "B"),
                     table, spec, "B")
    assert _content(spark, table) == [("green", 2020, 5, "B", 1)]


def test_stored_table_is_pruned_by_partition_predicate(spark):
    table = _table(spark)
    spec = PartitionSpec(1995, 2001)
    res = obt_job.run(spark, testbed.raw_tables(spark, SF_SMALL), testbed.testdata.zones(
        spark, SF_SMALL), table, spec, "run-x")
    tot = res.totals.first()
    assert tot["partitions"] == 168 and tot["rows"] == 3185 == res.rows_written
    probe = spark.table(table).where(PartitionSpec(1998, 1998, (6,), ("yellow",)).predicate())
    plan = probe._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(service_type" in plan or "PartitionFilters" in plan
    files = probe.inputFiles()
    assert files and all("source_year=1998" in f and "source_month=6" in f for f in files)


def test_round_trip_and_csv_export(spark):
    rows = spark.createDataFrame([(2, "b"), (1, "a")], "id long, status string").withColumn(
        "ts_utc", F.current_timestamp())
    back = tables.round_trip(rows, scratch_path(spark, "rt"), "id").collect()
    assert [r["id"] for r in back] == [1, 2] and back[0]["status"] == "a"
    path = scratch_path(spark, "csv")
    tables.export_csv(rows.select("id", "status"), path)
    got = spark.read.option("header", True).csv(path)
    assert sorted(r["status"] for r in got.collect()) == ["a", "b"]
    assert len(got.inputFiles()) == 1
    with pytest.raises(ValueError, match="number of files"):
        tables.export_csv(rows.select("id"), path + "-many", max_rows=1)
    tables.export_csv(rows.select("id"), path + "-many", files=2, max_rows=1)
    assert len(spark.read.option("header", True).csv(path + "-many").inputFiles()) == 2


def test_empty_source_clears_even_under_the_same_run_id(spark):
    table = _table(spark)
    z = zones_df(spark)
    spec = PartitionSpec(2020, 2020, (1, 2), ("yellow",))
    rows = raw_rows(spark, "yellow", [{"source_month": 1}, {"source_month": 2}])
    tables.replace_partitions(obt_from_raw(rows, z, "R"), table, spec, "R")
    only_jan = raw_rows(spark, "yellow", [{"source_month": 1}])
    obs = tables.replace_partitions(obt_from_raw(only_jan, z, "R"), table, spec, "R")
    assert _content(spark, table) == [("yellow", 2020, 1, "R", 1)]
    assert obs.get["rows"] == 1 and len(obs.get["partitions"]) == 1


def test_rows_outside_the_spec_are_counted_or_fail_the_write(spark):
    table = _table(spark)
    z = zones_df(spark)
    spec = PartitionSpec(2020, 2020, (1,), ("yellow",))
    rows = obt_from_raw(raw_rows(spark, "yellow", [
        {"source_month": 1}, {"source_month": 2}, {"source_year": 2002}, {"source_year": None}]),
        z, "R")
    obs = tables.replace_partitions(rows, table, spec, "R")
    assert (obs.get["rows"], obs.get["outside"]) == (1, 3)
    with pytest.raises(Exception, match="outside the run"):
        tables.replace_partitions(rows, table, spec, "S", fail_outside=True)
    assert _content(spark, table) == [("yellow", 2020, 1, "R", 1)]


def test_a_month_with_a_third_of_the_rows_is_written_by_several_tasks(spark):
    """REBALANCE splits what is large and joins what is small, whatever the input's tasks are."""
    rows = spark.range(0, 60_000, 1, 24).selectExpr(
        "id", "sha2(string(id), 256) as x", "'yellow' as service_type", "2020 as source_year",
        "cast(if(id % 3 = 0, 1, 2 + id % 11) as int) as source_month")
    table = _table(spark)
    with tables.session_conf(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k"):
        tables.append(rows, table)
    files = {}
    for f in spark.table(table).inputFiles():
        month = f.split("source_month=")[1].split("/")[0]
        files[month] = files.get(month, 0) + 1
    assert files["1"] >= 4
    assert len(files) == 12 and sum(files.values()) < 144   # 288 by 24 tasks otherwise
    assert spark.table(table).count() == 60_000


def test_report_has_all_levels_in_one_aggregate(spark):
    from tripdeck.operators.partitions import run_report, run_summary_by_year, run_totals
    spec = PartitionSpec(2019, 2020)
    counts = spark.createDataFrame([("yellow", 2020, 1, 5), ("green", 2019, 2, 7)],
                                   "service_type string, source_year int, source_month int, "
                                   "rows long")
    from tripdeck.operators.partitions import ledger
    led = ledger(spec.manifest(spark), counts)
    rep = run_report(led)
    plan = rep._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1
    total = rep.where("level = 3").drop("service_type", "source_year", "level").collect()
    assert total == run_totals(led).collect()
    years = rep.where("level = 0").drop("level")
    assert sorted(map(tuple, years.collect())) == sorted(map(tuple, run_summary_by_year(led).collect()))
    assert sorted(r["rows"] for r in rep.where("level = 1").collect()) == [5, 7]


def test_the_ledger_counts_rows_from_metadata_alone(spark, monkeypatch):
    table = _table(spark)
    z = zones_df(spark)
    spec = PartitionSpec(2020, 2020, (1, 2, 3))
    rows = [{"source_month": m} for m in (1, 1, 1, 2)]
    tables.append(obt_from_raw(raw_rows(spark, "yellow", rows), z, "A"), table)
    tables.append(obt_from_raw(raw_rows(spark, "yellow", rows[:2]), z, "A"), table)
    plans, count = [], tables.partition_counts

    def watched(df):
        out = count(df)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out
    monkeypatch.setattr(tables, "partition_counts", watched)
    got = {(r[0], r[2]): r["rows"] for r in tables.post_write_ledger(spark, table, spec).collect()}
    assert got == {("yellow", 1): 5, ("yellow", 2): 1, ("yellow", 3): 0,
                   ("green", 1): 0, ("green", 2): 0, ("green", 3): 0}
    assert "PushedAggregation: [COUNT(*)]" in plans[0] and "PushedGroupBy" in plans[0]
    empty = PartitionSpec(2021, 2021, (1,))
    assert {r["rows"] for r in tables.post_write_ledger(spark, table, empty).collect()} == {0}


def test_a_killed_replace_leaves_the_old_state_or_is_finished_to_the_new_one(spark, monkeypatch):
    z = zones_df(spark)
    spec = PartitionSpec(2020, 2020, (1, 2, 3, 4), ("yellow",))

    def build(months, run):
        return obt_from_raw(raw_rows(spark, "yellow", [{"source_month": m} for m in months]), z, run)
    old = [("yellow", 2020, m, "A", 1) for m in (1, 2, 3)]
    new = [("yellow", 2020, 1, "B", 2), ("yellow", 2020, 4, "B", 1)]

    class Killed(Exception):
        pass

    def killed(*args, **kwargs):
        raise Killed
    # before the plan stands: the old state; while it is carried out: the rest is made up for
    for step in ("finish_replace", "_partition_folder", "drop_partitions"):
        table = _table(spark)
        tables.replace_partitions(build((1, 2, 3), "A"), table, spec, "A")
        assert _content(spark, table) == old
        with monkeypatch.context() as m:
            if step == "finish_replace":
                m.setattr(tables, "json", type("J", (), {"dumps": killed}))
            elif step == "_partition_folder":     # the second of two partitions is not moved
                names, folder = [], tables._partition_folder

                def once(key, names=names, folder=folder):
                    names.append(key)
                    return killed() if len(names) > 2 else folder(key)
                m.setattr(tables, step, once)
            else:
                m.setattr(tables, step, killed)
            with pytest.raises(Killed):
                tables.replace_partitions(build((1, 1, 4), "B"), table, spec, "B")
        spark.catalog.refreshTable(table)
        if step == "finish_replace":
            assert _content(spark, table) == old and not tables.finish_replace(spark, table)
            tables.replace_partitions(build((1, 1, 4), "B"), table, spec, "B")
        else:
            assert tables.finish_replace(spark, table)
        assert _content(spark, table) == new and not tables.finish_replace(spark, table)
        counts = {r[2]: r["rows"] for r in tables.post_write_ledger(spark, table, spec).collect()}
        assert counts == {1: 2, 2: 0, 3: 0, 4: 1}
    # the next replace of a table finishes what a killed one left
    table = _table(spark)
    tables.replace_partitions(build((1, 2, 3), "A"), table, spec, "A")
    with monkeypatch.context() as m:
        m.setattr(tables, "drop_partitions", killed)
        with pytest.raises(Killed):
            tables.replace_partitions(build((1, 1, 4), "B"), table, spec, "B")
    only = PartitionSpec(2020, 2020, (4,), ("yellow",))
    tables.replace_partitions(build((4, 4), "C"), table, only, "C")
    assert _content(spark, table) == [new[0], ("yellow", 2020, 4, "C", 2)]
