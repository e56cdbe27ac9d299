"""Registered queries: name → ``(spark, sf_dir) -> DataFrame`` over the whole test tables.

Each query exercises one or more operators of the inventory (ids in the docstrings). Values
computed from aggregates are rounded to 6 decimals in reports, because sums taken in a
different order differ in the last bits between engines.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdeck.functions import measures
from tripdeck.functions.hashing import row_hash
from tripdeck.operators import evaluation as ev
from tripdeck.operators import features as fe
from tripdeck.operators import models as md
from tripdeck.operators import partitions as pt
from tripdeck.operators.ingest import ingest, with_run_id
from tripdeck.operators.obt import obt_from_raw, union_services
from tripdeck.plans import regression as rg
from tripdeck.plans import testbed
from tripdeck.session import scratch_path
from tripdeck.sinks import tables as sk
from tripdeck.sources import files, testdata
from tripdeck.sources.schemas import PARTITION_KEYS, SERVICES
from tripdeck.streaming import monthly_ingest

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

SPLIT = fe.TESTDATA_SPLIT
DIGITS = 6
# Money in the fixture has at most 7 decimals, so sums are exact on an 8-decimal grid: rounding
# there removes summation-order noise without ever meeting a rounding tie.
MONEY_DIGITS = 8
# Fixed parameters of the registered queries.
ANALYTIC_YEARS = (1996, 2000)
ANALYTIC_FRACTION = 0.005
HASH_FRACTION = 0.05
FIXED_SAMPLE_ROWS = 5000
MOMENT_ALPHAS = (0.0, 1e-5, 1e-3, 1e-1, 1.0, 10.0)
PARTITION_PROBE = ("yellow", 1998, 6)


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _r(col, digits: int = DIGITS):
    return F.round(col if not isinstance(col, str) else F.col(col), digits)


def full_spec(spark: SparkSession, sf_dir: str) -> pt.PartitionSpec:
    """All months of the years that the raw trips have (at least one year)."""
    first, last = testdata.trip_years(spark, sf_dir)
    return pt.PartitionSpec(first, last)


def _round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    return df.select(*[_r(c.name, digits).alias(c.name) if c.dataType.typeName() == "double"
                       else F.col(c.name) for c in df.schema.fields])


def _database(spark: SparkSession, name: str) -> str:
    db = f"tripdeck_{name}_{uuid.uuid4().hex[:10]}"
    sk.ensure_database(spark, db, scratch_path(spark, f"db-{name}"))
    return db


# ================================================================ OBT build

@register("obt_build")
def obt_build(spark, sf_dir):
    """Both services' raw tables → the 39-column OBT."""
    return testbed.obt(spark, sf_dir)


@register("obt_by_service_month")
def obt_by_service_month(spark, sf_dir):
    """A1 flagship report: OBT rows and money per (service, year, month)."""
    return (testbed.obt(spark, sf_dir)
            .groupBy(*PARTITION_KEYS)
            .agg(F.count(F.lit(1)).alias("trips"),
                 F.round(F.sum("total_amount"), MONEY_DIGITS).alias("total_amount"),
                 _r(F.avg("trip_distance")).alias("avg_distance"),
                 _r(F.avg("trip_duration_min")).alias("avg_duration_min"),
                 _r(F.avg("tip_pct")).alias("avg_tip_pct")))


@register("obt_month_partition")
def obt_month_partition(spark, sf_dir):
    """K1 F1 S3: raw tables appended to a partitioned table, one partition read back by a
    pruned predicate scan and built into OBT rows."""
    db = _database(spark, "raw")
    for service in SERVICES:
        sk.append(testbed.raw_table(spark, sf_dir, service), f"{db}.{service}_taxi_trip")
    svc, year, month = PARTITION_PROBE
    spec = pt.PartitionSpec(year, year, (month,), (svc,))
    raw = spark.table(f"{db}.{svc}_taxi_trip").where(spec.predicate())
    return obt_from_raw(raw, testdata.zones(spark, sf_dir), testbed.OBT_RUN_ID)


# ================================================================ scalar operators

@register("time_parts")
def time_parts(spark, sf_dir):
    """Hour, day of week (1 = Sunday), month/year from the file keys."""
    ev_ = testdata.event_trips(spark, sf_dir)
    return ev_.select("event_id",
                      measures.pickup_hour("pickup_datetime").alias("pickup_hour"),
                      measures.pickup_dow("pickup_datetime").alias("pickup_dow"),
                      measures.key_part("source_month").alias("month"),
                      measures.key_part("source_year").alias("year"))


def _decode_counts(spark, sf_dir, code: str, label: str):
    return (testbed.obt(spark, sf_dir).groupBy(code, label)
            .agg(F.count(F.lit(1)).alias("trips")))


@register("decode_vendor")
def decode_vendor(spark, sf_dir):
    """Vendor code → name, NULL and unknown codes → Other."""
    return _decode_counts(spark, sf_dir, "vendor_id", "vendor_name")


@register("decode_rate_code")
def decode_rate_code(spark, sf_dir):
    """P10: rate code → description."""
    return _decode_counts(spark, sf_dir, "rate_code_id", "rate_code_desc")


@register("decode_payment")
def decode_payment(spark, sf_dir):
    """Payment type (already cast) → description."""
    return _decode_counts(spark, sf_dir, "payment_type", "payment_type_desc")


@register("code_casts")
def code_casts(spark, sf_dir):
    """Codes and counts to int (doubles truncate, misfits → NULL), every raw row."""
    raw = testbed.raw_tables(spark, sf_dir)
    return raw.select("service_type",
                      measures.code_int("PULocationID").alias("pu_location_id"),
                      measures.code_int("DOLocationID").alias("do_location_id"),
                      measures.code_int("VendorID").alias("vendor_id"),
                      measures.code_int("RatecodeID").alias("rate_code_id"),
                      measures.code_int("payment_type").alias("payment_type"),
                      measures.code_int("passenger_count").alias("passenger_count"),
                      measures.code_int("trip_type").alias("trip_type"))


@register("trip_duration")
def trip_duration(spark, sf_dir):
    """Minutes between whole-second epochs (sub-second pickups)."""
    ev_ = testdata.event_trips(spark, sf_dir)
    return ev_.select("event_id", measures.trip_duration_min("pickup_datetime", "dropoff_datetime")
                      .alias("trip_duration_min"))


@register("avg_speed")
def avg_speed(spark, sf_dir):
    """Distance / hours when distance and duration are positive, else NULL."""
    ev_ = testdata.event_trips(spark, sf_dir)
    dur = measures.trip_duration_min("pickup_datetime", "dropoff_datetime")
    return ev_.select("event_id", dur.alias("trip_duration_min"),
                      measures.avg_speed_mph("trip_distance", dur).alias("avg_speed_mph"))


@register("tip_pct")
def tip_pct(spark, sf_dir):
    """Tip / fare · 100 when the fare is positive, every raw row."""
    raw = testbed.raw_tables(spark, sf_dir)
    return raw.select("service_type", "fare_amount", "tip_amount",
                      measures.tip_pct("tip_amount", "fare_amount").alias("tip_pct"))


@register("missing_columns_union")
def missing_columns_union(spark, sf_dir):
    """Services with different columns in one frame, missing columns typed NULL."""
    raw = testbed.raw_tables(spark, sf_dir)
    return (raw.groupBy("service_type", "airport_fee", "trip_type")
            .agg(F.count(F.lit(1)).alias("rows")))


@register("zone_role_join")
def zone_role_join(spark, sf_dir):
    """The zone dimension joined in pickup and dropoff roles."""
    return (testbed.obt(spark, sf_dir)
            .groupBy("pu_location_id", "pu_zone", "pu_borough",
                     "do_location_id", "do_zone", "do_borough")
            .agg(F.count(F.lit(1)).alias("trips")))


@register("valid_duration_filter")
def valid_duration_filter(spark, sf_dir):
    """rows kept by dropoff >= pickup (equal kept), per service."""
    raw = testbed.raw_tables(spark, sf_dir)
    valid = F.col("dropoff_datetime") >= F.col("pickup_datetime")
    return (raw.groupBy("service_type")
            .agg(F.count(F.lit(1)).alias("trips"),
                 F.count(F.when(valid, 1)).alias("valid_trips"),
                 F.count(F.when(F.col("dropoff_datetime") == F.col("pickup_datetime"), 1))
                 .alias("zero_duration_trips")))


# ================================================================ partitions and ledgers

def _ledger(spark, sf_dir):
    spec = full_spec(spark, sf_dir)
    counts = pt.partition_counts(testbed.obt(spark, sf_dir).where(spec.predicate()))
    return pt.ledger(spec.manifest(spark), counts)


@register("partition_manifest")
def partition_manifest(spark, sf_dir):
    """Every partition of the spec with its row count (0 when empty)."""
    return _ledger(spark, sf_dir)


@register("run_totals")
def run_totals(spark, sf_dir):
    """A2: partitions processed, partitions with rows, rows."""
    return pt.run_totals(_ledger(spark, sf_dir))


@register("run_summary_by_year")
def run_summary_by_year(spark, sf_dir):
    """A3: per service and year."""
    return pt.run_summary_by_year(_ledger(spark, sf_dir))


@register("run_report")
def run_report(spark, sf_dir):
    """A2 A3: totals, services and years of the run from one aggregate (``rollup``)."""
    return pt.run_report(_ledger(spark, sf_dir))


# ================================================================ ingest and sources

@register("ingest_lineage")
def ingest_lineage(spark, sf_dir):
    """Renamed times, lineage columns, and the builder's run id."""
    return with_run_id(testbed.raw_tables(spark, sf_dir), testbed.OBT_RUN_ID)


@register("ingest_monthly_files")
def ingest_monthly_files(spark, sf_dir):
    """Rows laid out as monthly files (one write), all files read back in one scan
    with keys and source path from the file name, ingested, counted per file."""
    root = scratch_path(spark, "landing")
    for service in SERVICES:
        rows = testdata.raw_trips(spark, sf_dir, service).withColumn("service_type",
                                                                     F.lit(service))
        files.write_monthly_files(rows, root)
    parts, spec = [], full_spec(spark, sf_dir)
    for service in SERVICES:
        scanned = files.read_monthly_files(spark, root, service, spec, with_source_path=True)
        ingested = ingest(scanned, service, testbed.RAW_RUN_ID, testbed.INGESTED_AT,
                          keep=("source_path",))
        parts.append(ingested.withColumn(
            "source_file", F.regexp_extract("source_path", files.FILE_PATTERN, 0)))
    return (union_services(*parts)
            .groupBy("source_file", *PARTITION_KEYS)
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.round(F.sum("total_amount"), MONEY_DIGITS).alias("total_amount")))


@register("ingest_job")
def ingest_job(spark, sf_dir):
    """The batch ingest — monthly files of the spec into partitioned raw
    tables by partition replace — and its ledger (rows per partition, 0 where nothing landed)."""
    from tripdeck.plans import ingest_job as job
    root = scratch_path(spark, "landing-batch")
    for service in SERVICES:
        files.write_monthly_files(
            testdata.raw_trips(spark, sf_dir, service).withColumn("service_type", F.lit(service)),
            root)
    db = _database(spark, "rawjob")
    raw = {s: f"{db}.{s}_taxi_trip" for s in SERVICES}
    return job.run(spark, root, raw, full_spec(spark, sf_dir), testbed.RAW_RUN_ID,
                   testbed.INGESTED_AT)


def _land(spark, sf_dir, root, choose=None, mode="append"):
    """Both services' rows (those that ``choose`` keeps) as monthly files below ``root``."""
    for service in SERVICES:
        rows = testdata.raw_trips(spark, sf_dir, service).withColumn("service_type", F.lit(service))
        files.write_monthly_files(rows if choose is None else rows.where(choose), root, mode)


@register("ingest_job_partial_landing")
def ingest_job_partial_landing(spark, sf_dir):
    """All months are ingested, then a folder that holds some rows of 1998 only: its
    months are replaced, months without a file keep their rows and are reported absent."""
    from tripdeck.plans import ingest_job as job
    whole, part = scratch_path(spark, "landing-whole"), scratch_path(spark, "landing-part")
    _land(spark, sf_dir, whole)
    _land(spark, sf_dir, part, "source_year = 1998 and PULocationID % 2 = 1")
    db = _database(spark, "rawpart")
    raw = {s: f"{db}.{s}_taxi_trip" for s in SERVICES}
    spec = full_spec(spark, sf_dir)
    job.run(spark, whole, raw, spec, testbed.RAW_RUN_ID, testbed.INGESTED_AT)
    return job.run(spark, part, raw, spec, testbed.RAW_RUN_ID, testbed.INGESTED_AT)


@register("ingest_drifted_types")
def ingest_drifted_types(spark, sf_dir):
    """Monthly files whose code columns are stored as INT32, INT64 or DOUBLE by year, one
    of them with a differently spelt name, read into the declared types."""
    root = scratch_path(spark, "landing-drift")
    drifts = ({"PULocationID": "long", "DOLocationID": "long", "passenger_count": "long",
               "RatecodeID": "long"},
              {"VendorID": "int", "payment_type": "double", "passenger_count": "int"}, {})
    for service in SERVICES:
        rows = testdata.raw_trips(spark, sf_dir, service).withColumn("service_type", F.lit(service))
        # joined once, not once for each of the three layouts
        joined = scratch_path(spark, f"drift-{service}")
        rows.write.parquet(joined)
        rows = spark.read.schema(rows.schema).parquet(joined)
        for k, drift in enumerate(drifts):
            some = rows.where(F.col("source_year") % len(drifts) == k).withColumns(
                {c: F.col(c).cast(t) for c, t in drift.items()})
            if k == 1:
                some = some.withColumnRenamed("airport_fee", "Airport_fee")
            files.write_monthly_files(some, root)
    spec = full_spec(spark, sf_dir)
    parts = [ingest(files.read_monthly_files(spark, root, service, spec), service,
                    testbed.RAW_RUN_ID, testbed.INGESTED_AT) for service in SERVICES]
    codes = ("VendorID", "RatecodeID", "PULocationID", "DOLocationID", "passenger_count",
             "payment_type", "airport_fee")
    return (union_services(*parts).groupBy(*PARTITION_KEYS)
            .agg(F.count(F.lit(1)).alias("rows"),
                 *[F.sum(c).cast("double").alias(f"sum_{c}") for c in codes]))


@register("lookup_csv")
def lookup_csv(spark, sf_dir):
    """Zone lookup written as CSV, read back with a declared schema, overwritten into
    a small table."""
    path = scratch_path(spark, "zones-csv")
    (testdata.zones(spark, sf_dir).coalesce(1).write.mode("overwrite")
     .option("header", True).csv(path))
    db = _database(spark, "zones")
    sk.overwrite(files.read_zone_csv(spark, path), f"{db}.taxi_zone_lookup")
    return spark.table(f"{db}.taxi_zone_lookup")


# ================================================================ sinks

def _stored(spark, table):
    return (spark.table(table).groupBy(*PARTITION_KEYS, "run_id")
            .agg(F.count(F.lit(1)).alias("rows")))


@register("replace_partitions")
def replace_partitions(spark, sf_dir):
    """K3 K6: full build under run A, then yellow 1998-01..06 rebuilt under run B."""
    table = f"{_database(spark, 'obt')}.obt_trips"
    sk.replace_partitions(testbed.obt(spark, sf_dir, "obt-A"), table, full_spec(spark, sf_dir),
                          "obt-A")
    spec = pt.PartitionSpec(1998, 1998, (1, 2, 3, 4, 5, 6), ("yellow",))
    sk.replace_partitions(testbed.obt(spark, sf_dir, "obt-B"), table, spec, "obt-B")
    return _stored(spark, table)


@register("replace_empty_partition")
def replace_empty_partition(spark, sf_dir):
    """K3: a rerun of 1997 whose green source has no rows clears the green 1997 partitions."""
    table = f"{_database(spark, 'obt')}.obt_trips"
    sk.replace_partitions(testbed.obt(spark, sf_dir, "obt-A"), table, full_spec(spark, sf_dir),
                          "obt-A")
    spec = pt.PartitionSpec(1997, 1997)
    yellow_only = obt_from_raw(testbed.raw_tables(spark, sf_dir, ("yellow",)),
                            testdata.zones(spark, sf_dir), "obt-B")
    sk.replace_partitions(yellow_only, table, spec, "obt-B")
    return _stored(spark, table)


@register("truncate_reload")
def truncate_reload(spark, sf_dir):
    """K4: an overwrite run replaces the whole table with its spec's rows."""
    table = f"{_database(spark, 'obt')}.obt_trips"
    sk.replace_partitions(testbed.obt(spark, sf_dir, "obt-A"), table, full_spec(spark, sf_dir),
                          "obt-A")
    spec = pt.PartitionSpec.resolve(year_start=1998, year_end=1998, services=["yellow"],
                                    overwrite=True)
    sk.write_obt(testbed.obt(spark, sf_dir, "obt-B"), table, spec, "obt-B")
    return _stored(spark, table)


@register("post_write_ledger")
def post_write_ledger(spark, sf_dir):
    """K6: per-partition counts of the stored table for the spec, empty partitions as 0."""
    table = f"{_database(spark, 'obt')}.obt_trips"
    spec = full_spec(spark, sf_dir)
    sk.replace_partitions(testbed.obt(spark, sf_dir), table, spec, testbed.OBT_RUN_ID,
                          fail_outside=True)
    return sk.post_write_ledger(spark, table, spec)


@register("round_trip")
def round_trip(spark, sf_dir):
    """K5: id/status/timestamp rows written, read back, ordered by id."""
    orders = testdata.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("ts_utc"))
    return sk.round_trip(orders, scratch_path(spark, "roundtrip"), "id")


@register("export_csv")
def export_csv(spark, sf_dir):
    """K7: a result table exported as one CSV with header and read back."""
    report = obt_by_service_month(spark, sf_dir)
    path = scratch_path(spark, "export")
    sk.export_csv(report, path)
    return spark.read.option("header", True).schema(report.schema).csv(path)


# ================================================================ features

def _clean(spark, sf_dir):
    return rg.cleaned(testbed.obt(spark, sf_dir), SPLIT)


def _split(spark, sf_dir):
    return fe.temporal_split(_clean(spark, sf_dir), SPLIT)


@register("analytic_read")
def analytic_read(spark, sf_dir):
    """Year range, reproducible 0.5 % sample, the 10 analytic columns."""
    return files.analytic_read(testbed.obt(spark, sf_dir), *ANALYTIC_YEARS, ANALYTIC_FRACTION)


@register("hash_sample")
def hash_sample(spark, sf_dir):
    """Bernoulli sample by hash threshold (5 %) over the whole OBT."""
    obt = testbed.obt(spark, sf_dir)
    return fe.hash_sample(obt, HASH_FRACTION).select(
        *fe.OBT_SAMPLE_KEY, "total_amount",
        row_hash(obt.schema, list(fe.OBT_SAMPLE_KEY)).alias("hash"))


@register("fixed_sample")
def fixed_sample(spark, sf_dir):
    """F8: exactly n training rows without replacement, by hash order."""
    train = _split(spark, sf_dir).where(F.col("split") == "train").drop("split")
    return fe.fixed_sample(train, FIXED_SAMPLE_ROWS)


@register("clean_ranges")
def clean_ranges(spark, sf_dir):
    """Strict range cleaning and dropping of NULL/NaN rows."""
    return _clean(spark, sf_dir)


@register("temporal_split")
def temporal_split(spark, sf_dir):
    """train / val / test by year."""
    return _split(spark, sf_dir)


@register("split_counts")
def split_counts(spark, sf_dir):
    """rows per split."""
    return fe.split_counts(_split(spark, sf_dir))


@register("one_hot")
def one_hot(spark, sf_dir):
    """One column per level of service and both boroughs, levels from the whole cleaned
    set."""
    clean = _clean(spark, sf_dir)
    return fe.one_hot(clean, fe.category_levels(clean))


@register("poly_features")
def poly_features(spark, sf_dir):
    """Squares and interactions of the pickup features."""
    return fe.poly_features(_clean(spark, sf_dir)).select(
        "trip_distance", "pickup_hour", "passenger_count", *fe.POLY_TERMS)


@register("poly_features_wide")
def poly_features_wide(spark, sf_dir):
    """The exported model's wider terms (fare, tip %, duration, speed) over the OBT."""
    obt = testbed.obt(spark, sf_dir)
    return fe.poly_features(obt.select(*fe.WIDE_NUMERIC), fe.WIDE_POLY_TERMS)


def _kept(df, name):
    """``df`` written to scratch space and read back: what several passes read, the joins run
    once. Nothing is held in memory, and lost executors cost no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _encoded(spark, sf_dir, poly=False):
    return rg.encoded_split(_kept(_clean(spark, sf_dir), "clean"), SPLIT, poly)


@register("scaler_stats")
def scaler_stats(spark, sf_dir):
    """A4: train mean and population std per feature (zero std → 1)."""
    df, feats, _ = _encoded(spark, sf_dir)
    stats = fe.scaler_stats_frame(df.where(F.col("split") == "train"), feats)
    return stats.select("feature", _r("mean").alias("mean"), _r("std").alias("std"))


@register("scaled_features")
def scaled_features(spark, sf_dir):
    """Every split scaled with the train moments."""
    df, feats, _ = _encoded(spark, sf_dir)
    stats = fe.scaler_stats(df.where(F.col("split") == "train"), feats)
    scaled = fe.apply_scaler(df, stats)
    # the label is passed through unchanged; only values computed from moments are rounded
    return scaled.select("split", "y", *[_r(f).alias(f) for f in feats])


# ================================================================ metrics on a closed-form predictor

def _predictions(spark, sf_dir, feature="trip_distance"):
    """One-feature least squares fitted on train (regr_slope / regr_intercept)."""
    df = _kept(_split(spark, sf_dir).withColumnRenamed("total_amount", "y")
               .select("split", "y", feature), "predicted")
    coef = (df.where(F.col("split") == "train")
            .agg(F.regr_slope("y", feature).alias("b"), F.regr_intercept("y", feature).alias("a"))
            .first())
    return df.withColumn("prediction", F.lit(coef["a"]) + F.lit(coef["b"]) * F.col(feature))


@register("regression_metrics")
def regression_metrics(spark, sf_dir):
    """Rmse, mae, r2 per split."""
    m = ev.regression_metrics(_predictions(spark, sf_dir), by=["split"])
    return _round_doubles(m)


@register("residual_summary")
def residual_summary(spark, sf_dir):
    """Mean, population std, p5, p95, min, max of test residuals (exact percentiles)."""
    test = _predictions(spark, sf_dir).where(F.col("split") == "test")
    s = ev.residual_summary(test)
    cols = ["mean", "std", "p5", "p95", "min", "max"]
    return spark.createDataFrame([tuple(float(s[c]) for c in cols)],
                                 ", ".join(f"{c} double" for c in cols)).select(
        *[_r(c).alias(c) for c in cols])


@register("residual_histogram")
def residual_histogram(spark, sf_dir):
    """60 equal-width bins of test residuals."""
    test = _predictions(spark, sf_dir).where(F.col("split") == "test")
    return _round_doubles(ev.residual_histogram(test))


@register("residual_points")
def residual_points(spark, sf_dir):
    """(actual, residual) of every test row."""
    test = _predictions(spark, sf_dir).where(F.col("split") == "test")
    r = ev.residuals(test)
    return r.select("y_true", _r("residual").alias("residual"))


@register("error_by_bucket")
def error_by_bucket(spark, sf_dir):
    """A10: rmse, mae, count per right-closed fare bucket of the test split."""
    test = _predictions(spark, sf_dir).where(F.col("split") == "test")
    return _round_doubles(ev.error_by_bucket(test))


@register("bucket_coverage")
def bucket_coverage(spark, sf_dir):
    """A10 (note): test rows inside the fare buckets and outside them (≤ 0 or > 200), so the
    rows the bucket table leaves out are reported rather than lost."""
    test = _predictions(spark, sf_dir).where(F.col("split") == "test")
    return ev.bucket_coverage(test)


# ================================================================ leaderboards on a moment grid

def _grid_results(spark, sf_dir):
    df = _split(spark, sf_dir).withColumnRenamed("total_amount", "y")
    moments = md.feature_moments(df, list(fe.NUMERIC_FEATURES))
    grid = md.moment_ridge_grid(moments, list(MOMENT_ALPHAS)).drop("slope", "intercept")
    # baseline: predict the train mean (no feature, no alpha) — a result set with fewer columns
    w = {s: F.col("split") == s for s in ("train", "val", "test")}
    ym = df.agg(*[F.sum(F.when(w[s], F.col("y"))).alias(f"sy_{s}") for s in w],
                *[F.sum(F.when(w[s], F.col("y") * F.col("y"))).alias(f"syy_{s}") for s in w],
                *[F.count(F.when(w[s], 1)).cast("double").alias(f"n_{s}") for s in w])
    mean = F.col("sy_train") / F.col("n_train")
    base_cols = [F.lit("train_mean").alias("model")]
    for s in w:
        sse = F.col(f"syy_{s}") - 2 * mean * F.col(f"sy_{s}") + F.col(f"n_{s}") * mean * mean
        sst = F.col(f"syy_{s}") - F.col(f"sy_{s}") * F.col(f"sy_{s}") / F.col(f"n_{s}")
        base_cols += [F.sqrt(F.try_divide(F.greatest(sse, F.lit(0.0)), F.col(f"n_{s}")))
                      .alias(f"rmse_{s}"),
                      (F.lit(1.0) - F.try_divide(sse, sst)).alias(f"r2_{s}")]
    results = grid.unionByName(ym.select(*base_cols), allowMissingColumns=True)
    return _round_doubles(results)


_TIE = ("model", "feature", "alpha")


@register("leaderboard")
def leaderboard(spark, sf_dir):
    """Union of result sets with different columns, ranked by validation RMSE."""
    return ev.leaderboard(_grid_results(spark, sf_dir), "rmse_val", _TIE)


@register("leaderboard_test")
def leaderboard_test(spark, sf_dir):
    """Ranked by test RMSE."""
    return ev.leaderboard(_grid_results(spark, sf_dir), "rmse_test", _TIE)


@register("top_settings")
def top_settings(spark, sf_dir):
    """The 10 best settings by validation RMSE."""
    return ev.top_settings(_grid_results(spark, sf_dir), 10, "rmse_val", _TIE)


@register("best_setting")
def best_setting(spark, sf_dir):
    """T4: per feature, the alpha with the lowest validation RMSE."""
    res = _grid_results(spark, sf_dir).where(F.col("feature").isNotNull())
    return ev.best_setting(res, family="feature", by="rmse_val", setting=("alpha",))


@register("train_val_union")
def train_val_union(spark, sf_dir):
    """Train and validation rows together for the refit."""
    df = _split(spark, sf_dir)
    return df.where(F.col("split") == "train").unionByName(df.where(F.col("split") == "val"))


# ================================================================ Spark ML models (rows-only)

def _prepared(spark, sf_dir, poly=False, wide=False):
    """Prepared features with the cleaned input persisted; use as a context manager."""
    return rg.prepare(testbed.obt(spark, sf_dir), SPLIT, poly=poly, wide=wide, persist=True)


@register("linear_fit")
def linear_fit(spark, sf_dir):
    """E5 M1 M5 M7: plain least squares, scored on train and validation."""
    with _prepared(spark, sf_dir) as prep:
        return rg.fit_setting(spark, prep, md.Setting("linear"))


@register("ridge_fit")
def ridge_fit(spark, sf_dir):
    """M2: ridge α = 0.0005 (reference objective)."""
    with _prepared(spark, sf_dir) as prep:
        return rg.fit_setting(spark, prep, md.Setting("ridge", 5e-4))


@register("lasso_fit")
def lasso_fit(spark, sf_dir):
    """M3: lasso α = 0.0001."""
    with _prepared(spark, sf_dir) as prep:
        return rg.fit_setting(spark, prep, md.Setting("lasso", 1e-4, 1.0))


@register("elastic_net_fit")
def elastic_net_fit(spark, sf_dir):
    """M4: elastic net α = 0.001, l1_ratio = 0.9."""
    with _prepared(spark, sf_dir) as prep:
        return rg.fit_setting(spark, prep, md.Setting("elasticnet", 1e-3, 0.9))


@register("grid_search")
def grid_search(spark, sf_dir):
    """The full reference grid (ridge 6, lasso 5, elastic net 5×3), with training
    and validation loss (MSE + penalty), solved from one pass of Gram moments."""
    with _prepared(spark, sf_dir) as prep:
        return ev.leaderboard(rg.grid(spark, prep))


@register("model_comparison")
def model_comparison(spark, sf_dir):
    """Reference-objective winners and library-objective settings, ranked."""
    with _prepared(spark, sf_dir) as prep:
        return rg.comparison(spark, prep)


@register("refit_test")
def refit_test(spark, sf_dir):
    """Winners of both objectives refitted on train ∪ validation, scored on test."""
    with _prepared(spark, sf_dir) as prep:
        return rg.fit_and_test(spark, prep)


@register("poly_models")
def poly_models(spark, sf_dir):
    """Eight models with polynomial terms, four of each objective, fitted on train,
    with their validation and test scores; best on test first."""
    with _prepared(spark, sf_dir, poly=True) as prep:
        return rg.fit_and_test(spark, prep, rg.POLY_MODELS, ("train",), ("val", "test"))


@register("poly_validation")
def poly_validation(spark, sf_dir):
    """The validation table of the same eight models, best first."""
    with _prepared(spark, sf_dir, poly=True) as prep:
        return (rg.fit_and_test(spark, prep, rg.POLY_MODELS, ("train",), ("val",))
                .select("model", "type", "alpha", "l1_ratio", "rmse_val", "r2_val", "time_sec"))


# Fits with a closed form: one or two scaled features of the whole cleaned table, through the
# same assembly, fit, scoring and table code as the full models.
ONE_FEATURE = ("trip_distance",)
TWO_FEATURES = ("trip_distance", "trip_distance_sq")
CLOSED_FORM = (md.Setting("linear"), md.Setting("ridge", 0.25), md.Setting("lasso", 4.0, 1.0),
               md.Setting("elasticnet", 1.0, 0.5))
LIBRARY_FORM = (md.Setting("ridge", 1000.0), md.Setting("lasso", 2.0, 1.0),
                md.Setting("elasticnet", 0.5, 0.5))
FIT_DIGITS = 4
_METRICS = [f"{m}_{s}" for m in ("rmse", "mae", "r2") for s in ("train", "val")]


def _few(prep, features):
    return dataclasses.replace(prep, features=list(features))


def _scored(df, *columns):
    return df.select("model", "type", "alpha", "l1_ratio",
                     *[_r(c, FIT_DIGITS).alias(c) for c in columns])


@register("one_feature_models")
def one_feature_models(spark, sf_dir):
    """The four models on one scaled feature, with their losses."""
    with _prepared(spark, sf_dir) as prep:
        out = rg.grid_spark_ml(spark, _few(prep, ONE_FEATURE), list(CLOSED_FORM), "reference")
        return _scored(out, *_METRICS, "loss_train", "loss_val")


@register("one_feature_grid")
def one_feature_grid(spark, sf_dir):
    """The whole grid on one scaled feature, from one pass of Gram moments."""
    with _prepared(spark, sf_dir) as prep:
        out = rg.grid(spark, _few(prep, ONE_FEATURE), md.reference_grid() + list(CLOSED_FORM[1:]))
        return _scored(out, *_METRICS, "loss_train", "loss_val")


@register("one_feature_comparison")
def one_feature_comparison(spark, sf_dir):
    """Both objectives and both implementations on one scaled feature."""
    with _prepared(spark, sf_dir) as prep:
        few = _few(prep, ONE_FEATURE)
        parts = [build(spark, few, list(settings), objective, f"{name}/{objective}")
                 for name, build in (("spark-ml", rg.grid_spark_ml), ("moments", rg.grid))
                 for objective, settings in (("reference", CLOSED_FORM), ("library", LIBRARY_FORM))]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return _scored(out, *_METRICS)


@register("one_feature_refit")
def one_feature_refit(spark, sf_dir):
    """Both objectives refitted on train ∪ validation, scored on test."""
    models = [(s, "reference") for s in CLOSED_FORM] + [(s, "library") for s in LIBRARY_FORM]
    with _prepared(spark, sf_dir) as prep:
        out = rg.fit_and_test(spark, _few(prep, ONE_FEATURE), models)
        return _scored(out, "rmse_test", "mae_test", "r2_test").join(
            out.select("model", "type", "n_test"), ["model", "type"])


@register("two_feature_poly")
def two_feature_poly(spark, sf_dir):
    """A feature and its square, least squares and ridge of both objectives, fitted on
    train, scored on test."""
    models = [(s, o) for s in (md.Setting("linear"), md.Setting("ridge", 0.25))
              for o in ("reference", "library")]
    with _prepared(spark, sf_dir, poly=True) as prep:
        out = rg.fit_and_test(spark, _few(prep, TWO_FEATURES), models, ("train",))
        return _scored(out, "rmse_test", "mae_test", "r2_test")


@register("two_feature_poly_models")
def two_feature_poly_models(spark, sf_dir):
    """A feature and its square, all four models of both objectives, fitted on train,
    scored on validation and test."""
    models = [(s, "reference") for s in CLOSED_FORM] + [(s, "library") for s in LIBRARY_FORM]
    with _prepared(spark, sf_dir, poly=True) as prep:
        out = rg.fit_and_test(spark, _few(prep, TWO_FEATURES), models, ("train",),
                              ("val", "test"))
        return _scored(out, *[f"{m}_{s}" for s in ("val", "test") for m in ("rmse", "mae", "r2")])


@register("two_feature_coefficients")
def two_feature_coefficients(spark, sf_dir):
    """Coefficients of the ridge on a feature and its square by absolute value."""
    with _prepared(spark, sf_dir, poly=True) as prep:
        few = _few(prep, TWO_FEATURES)
        train = few.frame("train")
        model, _ = md.fit(train, md.Setting("ridge", 0.25), *md.label_moments(train))
        out = md.coefficient_table(spark, model, few.features)
        return out.select("feature", *[_r(c, FIT_DIGITS).alias(c) for c in ("coef", "abs_coef")])


def _coefficients(spark, sf_dir, wide: bool, objective: str):
    with _prepared(spark, sf_dir, poly=True, wide=wide) as prep:
        train = prep.frame("train")
        sigma_y, n = md.label_moments(train)
        model, _ = md.fit(train, md.Setting("ridge", 1e-5), sigma_y, n, objective)
        return md.coefficient_table(spark, model, prep.features)


@register("coefficient_table")
def coefficient_table(spark, sf_dir):
    """Ridge + polynomial coefficients by descending absolute value."""
    return _coefficients(spark, sf_dir, wide=False, objective="reference")


@register("wide_poly_ridge")
def wide_poly_ridge(spark, sf_dir):
    """The exported family — ridge α = 1e-5 on the wider polynomial set — as a
    coefficient table ordered by |coef| (rows-only: a fit)."""
    return _coefficients(spark, sf_dir, wide=True, objective="library")


# The settings whose training is followed: the winners that have a penalty.
FOLLOWED = tuple(s for s in rg.BEST_REFERENCE if s.alpha > 0)


@register("loss_history")
def loss_history(spark, sf_dir):
    """Loss on train and on validation, and the proven gap, after every iteration of the
    penalised winners' fits, scored on the moments of both splits."""
    with _prepared(spark, sf_dir) as prep:
        return rg.histories(spark, prep, list(FOLLOWED))


@register("one_feature_loss_history")
def one_feature_loss_history(spark, sf_dir):
    """The same on one scaled feature, where the first iteration ends the fit."""
    with _prepared(spark, sf_dir) as prep:
        out = rg.histories(spark, _few(prep, ONE_FEATURE), list(CLOSED_FORM[1:]))
        return out.select("model", "alpha", "l1_ratio", "iteration",
                          *[_r(c, FIT_DIGITS).alias(c) for c in ("loss_train", "loss_val")])


@register("winner_diagnostics")
def winner_diagnostics(spark, sf_dir):
    """A8 A10 on the fitted winner: residual summary and error per fare bucket of the test
    split (elastic net α = 1e-4, l1_ratio 0.5, library objective)."""
    with _prepared(spark, sf_dir) as prep:
        preds = rg.winner_predictions(spark, prep)
        s = ev.residual_summary(preds)
        buckets = ev.error_by_bucket(preds).collect()
    rows = [("summary", k, float(v) if v is not None else None, None, None) for k, v in s.items()]
    rows += [("bucket", b["bucket"], b["rmse"], b["mae"], int(b["count"])) for b in buckets]
    return spark.createDataFrame(rows, "kind string, name string, value double, mae double, "
                                       "count bigint")


# ================================================================ streaming

@register("streaming_ingest")
def streaming_ingest(spark, sf_dir):
    """Incremental build: monthly files landed for both services are picked up by a file
    stream (availableNow), ingested, built and partition-replaced micro-batch by micro-batch;
    the stored OBT is then counted per partition."""
    root = scratch_path(spark, "landing-stream")
    for service in SERVICES:
        files.write_monthly_files(
            testdata.raw_trips(spark, sf_dir, service).withColumn("service_type", F.lit(service)),
            root)
    table = f"{_database(spark, 'stream')}.obt_trips"
    zones = testdata.zones(spark, sf_dir)
    for service in SERVICES:
        q = monthly_ingest.start(spark, root, service, zones, table,
                                 ingested_at=testbed.INGESTED_AT)
        q.awaitTermination()
    return (spark.table(table).groupBy(*PARTITION_KEYS)
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.round(F.sum("total_amount"), MONEY_DIGITS).alias("total_amount")))


@register("streaming_late_file")
def streaming_late_file(spark, sf_dir):
    """Incremental build: each month's rows land in two files at different times, taken up some
    files per micro-batch from one checkpoint; the stored OBT holds the rows of both."""
    root = scratch_path(spark, "landing-late")
    table = f"{_database(spark, 'late')}.obt_trips"
    zones = testdata.zones(spark, sf_dir)
    marks = {s: scratch_path(spark, f"late-{s}") for s in SERVICES}
    for step in (1, 0):
        _land(spark, sf_dir, root, f"PULocationID % 2 = {step}")
        for service in SERVICES:
            monthly_ingest.start(spark, root, service, zones, table, checkpoint=marks[service],
                                 ingested_at=testbed.INGESTED_AT,
                                 max_files_per_trigger=200).awaitTermination()
    return (spark.table(table).groupBy(*PARTITION_KEYS)
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.round(F.sum("total_amount"), MONEY_DIGITS).alias("total_amount")))
