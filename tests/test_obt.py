"""OBT build rules, unit rows for each semantic rule, and the shape of the physical plan."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import plan_text, raw_rows, zones_df
from tripdeck.operators.obt import obt_from_raw, union_services
from tripdeck.sources.schemas import OBT_COLUMNS, OBT_SCHEMA


def _build(spark, service, rows, zones=None, run_id="obt-t"):
    return obt_from_raw(raw_rows(spark, service, rows), zones or zones_df(spark), run_id)


def test_schema_is_the_39_declared_columns(spark):
    obt = _build(spark, "yellow", [{}])
    assert obt.columns == OBT_COLUMNS and len(OBT_COLUMNS) == 39
    assert obt.schema == OBT_SCHEMA or [f.dataType for f in obt.schema] == \
        [f.dataType for f in OBT_SCHEMA]


def test_zero_duration_kept_negative_dropped_speed_null(spark):
    t = datetime(2020, 3, 1, 8, 0, 0)
    rows = [{"dropoff_datetime": t, "pickup_datetime": t},
            {"dropoff_datetime": datetime(2020, 3, 1, 7, 0, 0), "pickup_datetime": t},
            {"dropoff_datetime": None}]
    out = _build(spark, "yellow", rows).collect()
    assert len(out) == 1
    assert out[0]["trip_duration_min"] == 0.0 and out[0]["avg_speed_mph"] is None


def test_null_codes_decode_to_other_and_zero_fare_has_no_tip_pct(spark):
    r = _build(spark, "yellow", [{"VendorID": None, "RatecodeID": None, "payment_type": None,
                                  "fare_amount": 0.0}]).first()
    assert (r["vendor_name"], r["rate_code_desc"], r["payment_type_desc"]) == ("Other",) * 3
    assert r["vendor_id"] is None and r["tip_pct"] is None


def test_rate_code_decoded_from_raw_value_payment_from_cast(spark):
    r = _build(spark, "yellow", [{"RatecodeID": 1.5, "payment_type": 2}]).first()
    assert r["rate_code_id"] == 1 and r["rate_code_desc"] == "Other"
    assert r["payment_type_desc"] == "Cash"


def test_unmatched_zone_gives_null_names_and_keeps_row(spark):
    rows = [{"PULocationID": 999, "DOLocationID": 3}, {}]
    out = _build(spark, "green", rows).orderBy("pu_location_id").collect()
    assert len(out) == 2
    assert out[0]["pu_zone"] == "Alphabet City" and out[0]["do_borough"] == "Queens"
    assert out[1]["pu_zone"] is None and out[1]["pu_borough"] is None
    assert out[1]["do_borough"] == "N/A"


def test_duplicate_zone_key_raises(spark):
    z = zones_df(spark, [(1, "A", "a", None), (1, "B", "b", None)])
    with pytest.raises(ValueError, match="not unique"):
        _build(spark, "yellow", [{}], zones=z)


def test_missing_service_columns_are_typed_nulls(spark):
    y = raw_rows(spark, "yellow", [{"airport_fee": 1.25}])
    g = raw_rows(spark, "green", [{"trip_type": 2.0}])
    out = obt_from_raw(union_services(y, g), zones_df(spark), "r").orderBy("service_type").collect()
    green, yellow = out
    assert green["airport_fee"] is None and green["trip_type"] == 2
    assert yellow["trip_type"] is None and yellow["airport_fee"] == 1.25


def test_case_blind_airport_fee_is_aligned_not_lost(spark):
    y = raw_rows(spark, "yellow", [{"airport_fee": 1.75}]).withColumnRenamed(
        "airport_fee", "Airport_fee")
    assert obt_from_raw(y, zones_df(spark), "r").first()["airport_fee"] == 1.75


def test_month_year_from_file_keys_not_timestamp(spark):
    r = _build(spark, "yellow", [{"source_year": 2019, "source_month": 12}]).first()
    assert (r["year"], r["month"]) == (2019, 12)
    assert r["run_id"] == "obt-t"


def test_left_join_keeps_row_count_and_plan_is_narrow(spark):
    raw = raw_rows(spark, "yellow", [{"PULocationID": i % 5} for i in range(50)])
    obt = obt_from_raw(raw, zones_df(spark), "r")
    assert obt.count() == 50
    plan = plan_text(obt)
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
        assert python_node not in plan


def test_obt_over_test_tables_has_expected_counts(spark):
    from conftest import SF_SMALL
    from tripdeck.plans import testbed
    obt = testbed.obt(spark, SF_SMALL)
    agg = obt.agg(F.count(F.lit(1)).alias("n"),
                  F.count(F.when(F.col("trip_duration_min") == 0, 1)).alias("zero"),
                  F.count(F.when(F.col("rate_code_desc") == "Other", 1)).alias("other")).first()
    # FIXTURES.md: 3,185 valid-duration trips at sf0.001, 2 of zero duration
    assert agg["n"] == 3185 and agg["zero"] == 2


def test_zone_table_that_gains_a_duplicate_is_noticed(spark):
    import uuid

    from tripdeck.operators.joins import dimension_for_join
    from tripdeck.session import scratch_path
    path = scratch_path(spark, f"zones-{uuid.uuid4().hex[:6]}")
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").write.parquet(path)
    facts = spark.createDataFrame([(1,), (2,)], "k int")
    dim, small = dimension_for_join(spark.read.parquet(path), "k")
    planned = facts.join(dim, "k", "left")
    assert small and planned.count() == 2
    spark.createDataFrame([(2, "c")], "k int, v string").write.mode("append").parquet(path)
    # the rows that were checked are the rows that are joined
    assert sorted(map(tuple, planned.collect())) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        dimension_for_join(spark.read.parquet(path), "k")
    # a dimension above the bound is asserted in the join's own plan
    large, small = dimension_for_join(spark.read.parquet(path), "k", max_rows=2)
    assert not small
    with pytest.raises(Exception, match="not unique"):
        facts.join(large, "k", "left").collect()


def test_one_pass_gives_the_union_of_both_raw_tables(spark):
    from conftest import SF_SMALL
    from tripdeck.operators.obt import union_services
    from tripdeck.plans import testbed
    from tripdeck.sources.schemas import SERVICES
    one = testbed.raw_tables(spark, SF_SMALL)
    two = union_services(*[testbed.raw_table(spark, SF_SMALL, s) for s in SERVICES])
    assert [(f.name, f.dataType) for f in one.schema] == [(f.name, f.dataType) for f in two.schema]
    assert one.exceptAll(two).count() == 0 == two.exceptAll(one).count()


def test_a_large_zone_table_with_a_hot_key_joins_like_a_small_one(spark):
    from conftest import SF_SMALL
    from tripdeck.operators.joins import hot_keys, skew_join
    from tripdeck.operators.obt import join_zones
    from tripdeck.sources import testdata
    base = (testdata.raw_trips(spark, SF_SMALL, "green")
            .selectExpr("PULocationID", "DOLocationID", "trip_distance"))
    facts = base.selectExpr(
        "case when trip_distance < 18 then 3 when trip_distance > 48 then null "
        "else cast(PULocationID as int) end as pu_location_id",
        "cast(DOLocationID as int) + if(trip_distance = 20, 900, 0) as do_location_id",
        "trip_distance")
    zones = testdata.zones(spark, SF_SMALL)
    assert hot_keys(facts, "pu_location_id", share=0.2) == [3]
    small, large = join_zones(facts, zones), join_zones(facts, zones, max_broadcast_rows=5)
    order = sorted(small.columns)
    assert order == sorted(large.columns)
    rows = [sorted(map(str, f.select(*order).collect())) for f in (small, large)]
    assert rows[0] == rows[1]
    # the hot key's rows meet the dimension in many parts, none far above the others
    skewed = skew_join(facts.withColumn("n", F.monotonically_increasing_id()),
                       zones.select(F.col("LocationID").alias("k"), "Zone"),
                       "pu_location_id", "k", salts=16)
    assert skewed.count() == facts.count()
    spread = facts.withColumn("n", F.monotonically_increasing_id()).where("pu_location_id = 3")
    parts = spread.groupBy(F.pmod(F.xxhash64(*spread.columns), F.lit(16))).count().collect()
    assert len(parts) == 16 and max(r["count"] for r in parts) < 3 * spread.count() / 16


def test_only_a_local_master_gets_a_local_folder():
    from types import SimpleNamespace

    from tripdeck.session import ensure_checkpoint_dir, is_local
    assert is_local("local") and is_local("local[8]") and not is_local("local-cluster[2,1,512]")
    cluster = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(cluster)


def test_a_rewritten_test_table_is_read_anew(spark):
    import shutil
    import tempfile

    import pyarrow.parquet as pq

    from conftest import SF_SMALL
    from tripdeck.plans import testbed
    root = tempfile.mkdtemp(prefix="tripdeck-tables-")
    for name in testbed.testdata.TRIP_TABLES:
        shutil.copy(f"{SF_SMALL}/{name}.parquet", f"{root}/{name}.parquet")
    before = testbed.obt(spark, root).count()
    lines = pq.read_table(f"{SF_SMALL}/lineitem.parquet")
    pq.write_table(lines.slice(0, lines.num_rows // 2), f"{root}/lineitem.parquet")
    assert 0 < testbed.obt(spark, root).count() < before
