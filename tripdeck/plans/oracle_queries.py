"""Oracle SQL per registered query (DuckDB dialect, test tables pre-registered as views).

Hand-written against the fixture mapping; shares no code with the Spark side except the fixed
parameters (years, fractions, grid values) that both must use.
"""

from __future__ import annotations

from tripdeck.functions.hashing import HASH_BITS
from tripdeck.plans.oracle import OBT, RAW

ORACLE: dict[str, str] = {}

# Fixed values of the test fixture, as the oracle sees them.
SERVICES = ("green", "yellow")
BOROUGHS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
NUMERIC = ("pickup_hour", "pickup_dow", "month", "year", "trip_distance", "passenger_count")
ONE_HOT = ([f"service_type_{s}" for s in SERVICES] + [f"pu_borough_{b}" for b in BOROUGHS]
           + [f"do_borough_{b}" for b in BOROUGHS])
FEATURES = list(NUMERIC) + ONE_HOT


def threshold(fraction: float) -> int:
    return int(fraction * (2 ** HASH_BITS))


def hash_sql(cols: list[str], timestamps: tuple[str, ...] = (), seed: int = 42,
             doubles: tuple[str, ...] = ()) -> str:
    parts = [f"'{seed}'"]
    for c in cols:
        v = (f"CAST(floor(epoch({c})) AS BIGINT)" if c in timestamps
             else f"CAST(floor({c} * 1000000.0::DOUBLE) AS BIGINT)" if c in doubles else c)
        parts.append(f"coalesce(CAST({v} AS VARCHAR), '\\N')")
    return (f"CAST(('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, "
            f"{HASH_BITS // 4})) AS BIGINT)")


OBT_KEY = ["pickup_datetime", "dropoff_datetime", "pu_location_id", "do_location_id",
           "vendor_id", "rate_code_id", "payment_type", "passenger_count", "service_type"]
OBT_HASH = hash_sql(OBT_KEY, ("pickup_datetime", "dropoff_datetime"))
SAMPLE_HASH = hash_sql(["pickup_hour", "pickup_dow", "month", "year", "trip_distance",
                        "passenger_count", "service_type", "pu_borough", "do_borough",
                        "total_amount"], doubles=("trip_distance", "total_amount"))

ML = """,
ml AS (
  SELECT pickup_hour, pickup_dow, month, year, trip_distance, passenger_count, service_type,
         pu_borough, do_borough, total_amount
  FROM obt WHERE source_year BETWEEN 1995 AND 2001
),
clean AS (
  SELECT * FROM ml
  WHERE trip_distance > 0 AND trip_distance < 100 AND passenger_count > 0
    AND passenger_count < 7 AND total_amount > 0 AND total_amount < 500
    AND pickup_hour IS NOT NULL AND pickup_dow IS NOT NULL AND month IS NOT NULL
    AND year IS NOT NULL AND trip_distance IS NOT NULL AND NOT isnan(trip_distance)
    AND passenger_count IS NOT NULL AND service_type IS NOT NULL AND pu_borough IS NOT NULL
    AND do_borough IS NOT NULL AND total_amount IS NOT NULL AND NOT isnan(total_amount)
),
split_t AS (
  SELECT *, CASE WHEN year BETWEEN 1995 AND 1997 THEN 'train'
                 WHEN year BETWEEN 1998 AND 1998 THEN 'val'
                 WHEN year BETWEEN 1999 AND 2001 THEN 'test' END AS split
  FROM clean WHERE year BETWEEN 1995 AND 2001
)"""


def q(body: str, extra: str = "") -> str:
    return "WITH " + OBT + extra + "\n" + body


def qml(body: str, extra: str = "") -> str:
    return "WITH " + OBT + ML + extra + "\n" + body


def qi(name: str) -> str:
    return '"' + name + '"'


# ---------------------------------------------------------------- OBT

ORACLE["obt_build"] = q("SELECT * FROM obt")

ORACLE["obt_by_service_month"] = q("""
SELECT service_type, source_year, source_month,
       count(*) AS trips,
       round(sum(total_amount), 8) AS total_amount,
       round(avg(trip_distance), 6) AS avg_distance,
       round(avg(trip_duration_min), 6) AS avg_duration_min,
       round(avg(tip_pct), 6) AS avg_tip_pct
FROM obt
GROUP BY service_type, source_year, source_month""")

ORACLE["obt_month_partition"] = q(
    "SELECT * FROM obt WHERE service_type = 'yellow' AND source_year = 1998 AND source_month = 6")

# ---------------------------------------------------------------- scalar operators

ORACLE["time_parts"] = """
SELECT event_id,
       CAST(hour(ts) AS SMALLINT) AS pickup_hour,
       CAST(dayofweek(ts) + 1 AS SMALLINT) AS pickup_dow,
       CAST(month(ts) AS SMALLINT) AS month,
       CAST(year(ts) AS SMALLINT) AS year
FROM events"""

ORACLE["decode_vendor"] = q(
    "SELECT vendor_id, vendor_name, count(*) AS trips FROM obt GROUP BY vendor_id, vendor_name")
ORACLE["decode_rate_code"] = q(
    "SELECT rate_code_id, rate_code_desc, count(*) AS trips FROM obt "
    "GROUP BY rate_code_id, rate_code_desc")
ORACLE["decode_payment"] = q(
    "SELECT payment_type, payment_type_desc, count(*) AS trips FROM obt "
    "GROUP BY payment_type, payment_type_desc")

ORACLE["code_casts"] = "WITH " + RAW + """
SELECT service_type,
       PULocationID AS pu_location_id,
       DOLocationID AS do_location_id,
       TRY_CAST(VendorID AS INTEGER) AS vendor_id,
       TRY_CAST(trunc(RatecodeID) AS INTEGER) AS rate_code_id,
       TRY_CAST(payment_type AS INTEGER) AS payment_type,
       TRY_CAST(trunc(passenger_count) AS INTEGER) AS passenger_count,
       TRY_CAST(trunc(trip_type) AS INTEGER) AS trip_type
FROM raw"""

EVENT_DUR = "(floor(epoch(ts + to_seconds(value))) - floor(epoch(ts))) / 60.0::DOUBLE"

ORACLE["trip_duration"] = f"SELECT event_id, {EVENT_DUR} AS trip_duration_min FROM events"

ORACLE["avg_speed"] = f"""
WITH e AS (SELECT event_id, value AS d, {EVENT_DUR} AS dur FROM events)
SELECT event_id, dur AS trip_duration_min,
       CASE WHEN d > 0 AND dur > 0 THEN d / (dur / 60.0::DOUBLE) END AS avg_speed_mph
FROM e"""

ORACLE["tip_pct"] = "WITH " + RAW + """
SELECT service_type, fare_amount, tip_amount,
       CASE WHEN fare_amount > 0 THEN (tip_amount / fare_amount) * 100.0::DOUBLE END AS tip_pct
FROM raw"""

ORACLE["missing_columns_union"] = "WITH " + RAW + """
SELECT service_type, airport_fee, trip_type, count(*) AS rows
FROM raw GROUP BY service_type, airport_fee, trip_type"""

ORACLE["zone_role_join"] = q("""
SELECT pu_location_id, pu_zone, pu_borough, do_location_id, do_zone, do_borough,
       count(*) AS trips
FROM obt
GROUP BY pu_location_id, pu_zone, pu_borough, do_location_id, do_zone, do_borough""")

ORACLE["valid_duration_filter"] = "WITH " + RAW + """
SELECT service_type, count(*) AS trips,
       count(*) FILTER (WHERE dropoff_datetime >= pickup_datetime) AS valid_trips,
       count(*) FILTER (WHERE dropoff_datetime = pickup_datetime) AS zero_duration_trips
FROM raw GROUP BY service_type"""

# ---------------------------------------------------------------- partitions and ledgers

LEDGER = """,
manifest AS (
  SELECT s.service_type, CAST(y.source_year AS INTEGER) AS source_year,
         CAST(m.source_month AS INTEGER) AS source_month
  FROM (VALUES ('yellow'), ('green')) s(service_type)
  CROSS JOIN (SELECT unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + 1))
              FROM orders) y(source_year)
  CROSS JOIN range(1, 13) m(source_month)
),
counts AS (
  SELECT service_type, source_year, source_month, count(*) AS rows
  FROM obt GROUP BY service_type, source_year, source_month
),
ledger AS (
  SELECT m.service_type, m.source_year, m.source_month,
         CAST(coalesce(c.rows, 0) AS BIGINT) AS rows
  FROM manifest m LEFT JOIN counts c
    ON m.service_type = c.service_type AND m.source_year = c.source_year
   AND m.source_month = c.source_month
)"""

ORACLE["partition_manifest"] = q("SELECT * FROM ledger", LEDGER)
ORACLE["post_write_ledger"] = ORACLE["partition_manifest"]
ORACLE["run_totals"] = q("""
SELECT count(*) AS partitions,
       count(*) FILTER (WHERE rows > 0) AS partitions_with_rows,
       CAST(coalesce(sum(rows), 0) AS BIGINT) AS rows
FROM ledger""", LEDGER)
ORACLE["run_summary_by_year"] = q("""
SELECT service_type, source_year, count(*) AS partitions,
       count(*) FILTER (WHERE rows > 0) AS partitions_with_rows,
       CAST(sum(rows) AS BIGINT) AS rows
FROM ledger GROUP BY service_type, source_year""", LEDGER)

ORACLE["run_report"] = q("""
SELECT service_type, source_year, CAST(grouping(service_type, source_year) AS INTEGER) AS level,
       count(*) AS partitions, count(*) FILTER (WHERE rows > 0) AS partitions_with_rows,
       CAST(coalesce(sum(rows), 0) AS BIGINT) AS rows
FROM ledger GROUP BY ROLLUP (service_type, source_year)""", LEDGER)

# ---------------------------------------------------------------- ingest and sources

ORACLE["ingest_lineage"] = ("WITH " + RAW
                            + "\nSELECT * REPLACE ('obt-20240101T000000Z' AS run_id) FROM raw")

ORACLE["ingest_monthly_files"] = "WITH " + RAW + """
SELECT service_type || '_tripdata_' || CAST(source_year AS VARCHAR) || '-'
         || lpad(CAST(source_month AS VARCHAR), 2, '0') || '.parquet' AS source_file,
       service_type, source_year, source_month,
       count(*) AS rows, round(sum(total_amount), 8) AS total_amount
FROM raw GROUP BY service_type, source_year, source_month"""

ORACLE["lookup_csv"] = """
SELECT CAST(n.n_nationkey AS INTEGER) AS LocationID, r.r_name AS Borough, n.n_name AS Zone,
       CAST(NULL AS VARCHAR) AS service_zone
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey"""

# ---------------------------------------------------------------- sinks

STORED = """
SELECT service_type, source_year, source_month, {run_id} AS run_id, count(*) AS rows
FROM obt {where}
GROUP BY service_type, source_year, source_month"""

ORACLE["replace_partitions"] = q(STORED.format(
    run_id="CASE WHEN service_type = 'yellow' AND source_year = 1998 AND source_month <= 6 "
           "THEN 'obt-B' ELSE 'obt-A' END",
    where=""))
ORACLE["replace_empty_partition"] = q(STORED.format(
    run_id="CASE WHEN source_year = 1997 THEN 'obt-B' ELSE 'obt-A' END",
    where="WHERE NOT (service_type = 'green' AND source_year = 1997)"))
ORACLE["truncate_reload"] = q(STORED.format(
    run_id="'obt-B'", where="WHERE service_type = 'yellow' AND source_year = 1998"))

ORACLE["round_trip"] = """
SELECT o_orderkey AS id, o_orderstatus AS status, o_orderdate AS ts_utc FROM orders"""

ORACLE["export_csv"] = ORACLE["obt_by_service_month"]

# ---------------------------------------------------------------- features

ORACLE["analytic_read"] = q(f"""
SELECT pickup_hour, pickup_dow, month, year, trip_distance, passenger_count, service_type,
       pu_borough, do_borough, total_amount
FROM obt
WHERE source_year BETWEEN 1996 AND 2000 AND {OBT_HASH} < {threshold(0.005)}""")

ORACLE["hash_sample"] = q(f"""
SELECT {', '.join(OBT_KEY)}, total_amount, {OBT_HASH} AS hash
FROM obt WHERE {OBT_HASH} < {threshold(0.05)}""")

_CLEAN_COLS = ("pickup_hour, pickup_dow, month, year, trip_distance, passenger_count, "
               "service_type, pu_borough, do_borough, total_amount")

ORACLE["fixed_sample"] = qml(f"""
SELECT {_CLEAN_COLS} FROM split_t WHERE split = 'train'
ORDER BY {SAMPLE_HASH}, pickup_hour, pickup_dow, month, year, trip_distance, passenger_count,
         service_type, pu_borough, do_borough, total_amount
LIMIT 5000""")

ORACLE["clean_ranges"] = qml("SELECT * FROM clean")
ORACLE["temporal_split"] = qml("SELECT * FROM split_t")
ORACLE["split_counts"] = qml("SELECT split, count(*) AS rows FROM split_t GROUP BY split")


def _one_hot_exprs(cast: str) -> list[str]:
    out = [f"CAST(service_type = '{s}' AS {cast}) AS {qi('service_type_' + s)}" for s in SERVICES]
    for role in ("pu_borough", "do_borough"):
        out += [f"CAST({role} = '{b}' AS {cast}) AS {qi(role + '_' + b)}" for b in BOROUGHS]
    return out


ORACLE["one_hot"] = qml(
    "SELECT pickup_hour, pickup_dow, month, year, trip_distance, passenger_count, total_amount, "
    + ", ".join(_one_hot_exprs("INTEGER")) + " FROM clean")

ORACLE["poly_features"] = qml("""
SELECT trip_distance, pickup_hour, passenger_count,
       trip_distance * trip_distance AS trip_distance_sq,
       CAST(pickup_hour AS DOUBLE) * CAST(pickup_hour AS DOUBLE) AS pickup_hour_sq,
       CAST(passenger_count AS DOUBLE) * CAST(passenger_count AS DOUBLE) AS passenger_count_sq,
       trip_distance * CAST(pickup_hour AS DOUBLE) AS trip_dist_x_hour,
       trip_distance * CAST(passenger_count AS DOUBLE) AS trip_dist_x_pass
FROM clean""")

ENC = """,
enc AS (
  SELECT split, CAST(total_amount AS DOUBLE) AS y, """ + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC) + ", " + ", ".join(
    _one_hot_exprs("DOUBLE")) + """
  FROM split_t
)"""

ORACLE["scaler_stats"] = qml(f"""
SELECT feature, round(avg(v), 6) AS mean,
       round(CASE WHEN stddev_pop(v) = 0 THEN 1.0 ELSE stddev_pop(v) END, 6) AS std
FROM (UNPIVOT (SELECT {', '.join(qi(f) for f in FEATURES)} FROM enc WHERE split = 'train')
      ON {', '.join(qi(f) for f in FEATURES)} INTO NAME feature VALUE v)
GROUP BY feature""", ENC)

_stats_cols = ", ".join(
    f"avg({qi(f)}) AS {qi('m_' + f)}, "
    f"CASE WHEN stddev_pop({qi(f)}) = 0 THEN 1.0 ELSE stddev_pop({qi(f)}) END AS {qi('s_' + f)}"
    for f in FEATURES)
ORACLE["scaled_features"] = qml(
    "SELECT e.split, e.y, " + ", ".join(
        f"round((e.{qi(f)} - st.{qi('m_' + f)}) / st.{qi('s_' + f)}, 6) AS {qi(f)}"
        for f in FEATURES)
    + " FROM enc e CROSS JOIN st",
    ENC + f""",
st AS (SELECT {_stats_cols} FROM enc WHERE split = 'train')""")

# ---------------------------------------------------------------- metrics

PRED = """,
coef AS (
  SELECT regr_slope(total_amount, trip_distance) AS b,
         regr_intercept(total_amount, trip_distance) AS a
  FROM split_t WHERE split = 'train'
),
pred AS (
  SELECT s.split, s.total_amount AS y, coef.a + coef.b * s.trip_distance AS prediction
  FROM split_t s CROSS JOIN coef
),
r AS (SELECT y AS y_true, y - prediction AS residual FROM pred WHERE split = 'test')"""

ORACLE["regression_metrics"] = qml("""
SELECT split,
       round(sqrt(avg((y - prediction) * (y - prediction))), 6) AS rmse,
       round(avg(abs(y - prediction)), 6) AS mae,
       round(1 - sum((y - prediction) * (y - prediction)) / (count(*) * var_pop(y)), 6) AS r2,
       count(*) AS n
FROM pred GROUP BY split""", PRED)

ORACLE["residual_summary"] = qml("""
SELECT round(avg(residual), 6) AS mean, round(stddev_pop(residual), 6) AS std,
       round(quantile_cont(residual, 0.05), 6) AS p5,
       round(quantile_cont(residual, 0.95), 6) AS p95,
       round(min(residual), 6) AS min, round(max(residual), 6) AS max
FROM r""", PRED)

ORACLE["residual_points"] = qml(
    "SELECT y_true, round(residual, 6) AS residual FROM r", PRED)

ORACLE["residual_histogram"] = qml("""
SELECT CAST(bins.bin AS INTEGER) AS bin,
       round(mm.lo + (mm.hi - mm.lo) * (bins.bin - 1) / 60.0::DOUBLE, 6) AS lower,
       round(mm.lo + (mm.hi - mm.lo) * bins.bin / 60.0::DOUBLE, 6) AS upper,
       CAST(coalesce(c.cnt, 0) AS BIGINT) AS count
FROM (SELECT range AS bin FROM range(1, 61)) bins
CROSS JOIN mm
LEFT JOIN (
  SELECT CAST(least(floor(60.0::DOUBLE * (residual - lo) / (hi - lo)) + 1, 60) AS INTEGER)
           AS bin, count(*) AS cnt
  FROM r CROSS JOIN mm GROUP BY 1
) c ON bins.bin = c.bin""", PRED + """,
mm AS (SELECT min(residual) AS lo, max(residual) AS hi FROM r)""")

ORACLE["error_by_bucket"] = qml("""
SELECT l.bucket_order, l.bucket,
       round(sqrt(avg(b.residual * b.residual)), 6) AS rmse,
       round(avg(abs(b.residual)), 6) AS mae,
       count(b.residual) AS count
FROM (VALUES (0, '0–10'), (1, '10–20'), (2, '20–30'), (3, '30–40'), (4, '40–60'),
             (5, '60–100'), (6, '100–200')) l(bucket_order, bucket)
LEFT JOIN (
  SELECT residual,
         CASE WHEN y_true > 0 AND y_true <= 10 THEN '0–10'
              WHEN y_true > 10 AND y_true <= 20 THEN '10–20'
              WHEN y_true > 20 AND y_true <= 30 THEN '20–30'
              WHEN y_true > 30 AND y_true <= 40 THEN '30–40'
              WHEN y_true > 40 AND y_true <= 60 THEN '40–60'
              WHEN y_true > 60 AND y_true <= 100 THEN '60–100'
              WHEN y_true > 100 AND y_true <= 200 THEN '100–200' END AS bucket
  FROM r
) b ON l.bucket = b.bucket
GROUP BY l.bucket_order, l.bucket""", PRED)

# ---------------------------------------------------------------- leaderboards on a moment grid

ALPHAS = (0.0, 1e-5, 1e-3, 1e-1, 1.0, 10.0)
SPLITS = ("train", "val", "test")


def _moment_aggs() -> str:
    out = []
    for s in SPLITS:
        f = f"FILTER (WHERE split = '{s}')"
        out += [f"CAST(count(*) {f} AS DOUBLE) AS n_{s}", f"sum(x) {f} AS sx_{s}",
                f"sum(y) {f} AS sy_{s}", f"sum(x * x) {f} AS sxx_{s}",
                f"sum(x * y) {f} AS sxy_{s}", f"sum(y * y) {f} AS syy_{s}"]
    return ", ".join(out)


def _score_cols(a: str, b: str) -> str:
    out = []
    for s in SPLITS:
        sse = (f"(syy_{s} - 2 * {a} * sy_{s} - 2 * {b} * sxy_{s} + n_{s} * {a} * {a} "
               f"+ 2 * {a} * {b} * sx_{s} + {b} * {b} * sxx_{s})")
        out += [f"sqrt(greatest({sse}, 0.0) / NULLIF(n_{s}, 0)) AS rmse_{s}",
                f"1.0 - {sse} / NULLIF(syy_{s} - sy_{s} * sy_{s} / n_{s}, 0) AS r2_{s}"]
    return ", ".join(out)


def _base_cols() -> str:
    out = []
    m = "(sy_train / n_train)"
    for s in SPLITS:
        sse = f"(syy_{s} - 2 * {m} * sy_{s} + n_{s} * {m} * {m})"
        out += [f"sqrt(greatest({sse}, 0.0) / NULLIF(n_{s}, 0)) AS rmse_{s}",
                f"1.0 - {sse} / NULLIF(syy_{s} - sy_{s} * sy_{s} / n_{s}, 0) AS r2_{s}"]
    return ", ".join(out)


_round_res = ", ".join(f"round(rmse_{s}, 6) AS rmse_{s}, round(r2_{s}, 6) AS r2_{s}"
                       for s in SPLITS)
GRID = f""",
long AS (
  UNPIVOT (SELECT split, CAST(total_amount AS DOUBLE) AS y, {', '.join(
      f'CAST({c} AS DOUBLE) AS {c}' for c in NUMERIC)} FROM split_t)
  ON {', '.join(NUMERIC)} INTO NAME feature VALUE x
),
mom AS (SELECT feature, {_moment_aggs()} FROM long GROUP BY feature),
fit AS (
  SELECT mom.*, al.alpha,
         (sxy_train / n_train - (sx_train / n_train) * (sy_train / n_train))
         / NULLIF((sxx_train / n_train - (sx_train / n_train) * (sx_train / n_train))
                  + al.alpha, 0) AS slope
  FROM mom CROSS JOIN (VALUES {', '.join(f'({a!r}::DOUBLE)' for a in ALPHAS)}) al(alpha)
),
fit2 AS (SELECT *, sy_train / n_train - slope * sx_train / n_train AS intercept FROM fit),
grid AS (
  SELECT 'ridge_1d' AS model, feature, alpha, {_score_cols('intercept', 'slope')} FROM fit2
),
ym AS (
  SELECT {', '.join(
      f"sum(CAST(total_amount AS DOUBLE)) FILTER (WHERE split = '{s}') AS sy_{s}, "
      f"sum(CAST(total_amount AS DOUBLE) * CAST(total_amount AS DOUBLE)) "
      f"FILTER (WHERE split = '{s}') AS syy_{s}, "
      f"CAST(count(*) FILTER (WHERE split = '{s}') AS DOUBLE) AS n_{s}" for s in SPLITS)}
  FROM split_t
),
base AS (
  SELECT 'train_mean' AS model, CAST(NULL AS VARCHAR) AS feature,
         CAST(NULL AS DOUBLE) AS alpha, {_base_cols()} FROM ym
),
results AS (
  SELECT model, feature, alpha, {_round_res}
  FROM (SELECT * FROM grid UNION ALL BY NAME SELECT * FROM base)
)"""

_RANK = ("CAST(row_number() OVER (ORDER BY {by} ASC NULLS LAST, model ASC NULLS FIRST, "
         "feature ASC NULLS FIRST, alpha ASC NULLS FIRST) AS INTEGER) AS rank")

ORACLE["leaderboard"] = qml("SELECT *, " + _RANK.format(by="rmse_val") + " FROM results", GRID)
ORACLE["leaderboard_test"] = qml(
    "SELECT *, " + _RANK.format(by="rmse_test") + " FROM results", GRID)
ORACLE["top_settings"] = qml(
    "SELECT * FROM (SELECT *, " + _RANK.format(by="rmse_val") + " FROM results) WHERE rank <= 10",
    GRID)
ORACLE["best_setting"] = qml("""
SELECT feature, rmse_val, alpha FROM results WHERE feature IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY feature ORDER BY rmse_val, alpha) = 1""", GRID)

ORACLE["train_val_union"] = qml("SELECT * FROM split_t WHERE split IN ('train', 'val')")

ORACLE["streaming_ingest"] = q("""
SELECT service_type, source_year, source_month, count(*) AS rows,
       round(sum(total_amount), 8) AS total_amount
FROM obt GROUP BY service_type, source_year, source_month""")

ORACLE["poly_features_wide"] = q("""
SELECT fare_amount, tip_pct, trip_distance, trip_duration_min, avg_speed_mph, year, month,
       pickup_hour, pickup_dow,
       fare_amount * fare_amount AS "fare_amount^2",
       fare_amount * tip_pct AS "fare_amount*tip_pct",
       trip_distance * trip_distance AS "trip_distance^2",
       trip_distance * avg_speed_mph AS "trip_distance*avg_speed_mph",
       tip_pct * tip_pct AS "tip_pct^2",
       trip_distance * fare_amount AS "trip_distance*fare_amount",
       trip_duration_min * trip_duration_min AS "trip_duration_min^2",
       avg_speed_mph * avg_speed_mph AS "avg_speed_mph^2"
FROM obt""")

ORACLE["bucket_coverage"] = qml("""
SELECT count(*) AS rows,
       count(*) FILTER (WHERE y_true > 0 AND y_true <= 200) AS in_buckets,
       count(*) FILTER (WHERE NOT (y_true > 0 AND y_true <= 200)) AS outside_buckets
FROM r""", PRED)

ORACLE["ingest_job"] = "WITH " + RAW + """,
manifest AS (
  SELECT s.service_type, CAST(y.source_year AS INTEGER) AS source_year,
         CAST(m.source_month AS INTEGER) AS source_month
  FROM (VALUES ('yellow'), ('green')) s(service_type)
  CROSS JOIN (SELECT unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + 1))
              FROM orders) y(source_year)
  CROSS JOIN range(1, 13) m(source_month)
),
counts AS (
  SELECT service_type, source_year, source_month, count(*) AS rows
  FROM raw GROUP BY service_type, source_year, source_month
)
SELECT m.service_type, m.source_year, m.source_month,
       CAST(coalesce(c.rows, 0) AS BIGINT) AS rows,
       CASE WHEN c.rows IS NULL THEN 'absent' ELSE 'landed' END AS state
FROM manifest m LEFT JOIN counts c
  ON m.service_type = c.service_type AND m.source_year = c.source_year
 AND m.source_month = c.source_month"""

ORACLE["ingest_job_partial_landing"] = "WITH " + RAW + """,
manifest AS (
  SELECT s.service_type, CAST(y.source_year AS INTEGER) AS source_year,
         CAST(m.source_month AS INTEGER) AS source_month
  FROM (VALUES ('yellow'), ('green')) s(service_type)
  CROSS JOIN (SELECT unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + 1))
              FROM orders) y(source_year)
  CROSS JOIN range(1, 13) m(source_month)
),
counts AS (
  SELECT service_type, source_year, source_month, count(*) AS rows,
         count(*) FILTER (WHERE source_year = 1998 AND PULocationID % 2 = 1) AS later
  FROM raw GROUP BY service_type, source_year, source_month
)
SELECT m.service_type, m.source_year, m.source_month,
       CAST(CASE WHEN c.later > 0 THEN c.later ELSE coalesce(c.rows, 0) END AS BIGINT) AS rows,
       CASE WHEN c.later > 0 THEN 'landed' ELSE 'absent' END AS state
FROM manifest m LEFT JOIN counts c
  ON m.service_type = c.service_type AND m.source_year = c.source_year
 AND m.source_month = c.source_month"""

ORACLE["ingest_drifted_types"] = "WITH " + RAW + """
SELECT service_type, source_year, source_month, count(*) AS rows,
       CAST(sum(VendorID) AS DOUBLE) AS "sum_VendorID",
       CAST(sum(RatecodeID) AS DOUBLE) AS "sum_RatecodeID",
       CAST(sum(PULocationID) AS DOUBLE) AS "sum_PULocationID",
       CAST(sum(DOLocationID) AS DOUBLE) AS "sum_DOLocationID",
       CAST(sum(passenger_count) AS DOUBLE) AS sum_passenger_count,
       CAST(sum(payment_type) AS DOUBLE) AS sum_payment_type,
       CAST(sum(airport_fee) AS DOUBLE) AS sum_airport_fee
FROM raw GROUP BY service_type, source_year, source_month"""

ORACLE["streaming_late_file"] = ORACLE["streaming_ingest"]


# ---------------------------------------------------------------- fits with a closed form

# One feature z (scaled by the train moments): the minimiser of mean(err²) + a (rho |w| +
# (1 - rho) w²) has w = S(cov(z, y), a rho / 2) / (var(z) + a (1 - rho)), S the soft threshold.
# Settings: (type, model, alpha, l1_ratio, a, rho); a of the library's ridge is alpha / n.
_REF_CLOSED = [("linear", 0.0, None, "0.0", 0.0), ("ridge", 0.25, None, "0.25", 0.0),
               ("lasso", 4.0, 1.0, "4.0", 1.0), ("elasticnet", 1.0, 0.5, "1.0", 0.5)]
_LIB_CLOSED = [("ridge", 1000.0, None, "1000.0 / n", 0.0), ("lasso", 2.0, 1.0, "4.0", 1.0),
               ("elasticnet", 0.5, 0.5, "0.75", 2.0 / 3.0)]
_GRID_CLOSED = ([("ridge" if a else "linear", a, None, repr(a), 0.0)
                 for a in (0.0, 1e-5, 5e-5, 1e-4, 5e-4, 1e-3)]
                + [("lasso", a, 1.0, repr(a), 1.0) for a in (1e-5, 5e-5, 1e-4, 5e-4, 1e-3)]
                + [("elasticnet", a, r, repr(a), r) for a in (1e-5, 5e-5, 1e-4, 5e-4, 1e-3)
                   for r in (0.1, 0.5, 0.9)])


def _one_feature(types: dict[str, list], fitted_on: str) -> str:
    rows = " UNION ALL ".join(
        f"SELECT '{t}' AS type, '{m}' AS model, {alpha!r}::DOUBLE AS alpha, "
        f"{'NULL' if l1 is None else l1}::DOUBLE AS l1_ratio, ({a})::DOUBLE AS a, "
        f"{rho!r}::DOUBLE AS rho FROM mom"
        for t, settings in types.items() for m, alpha, l1, a, rho in settings)
    return f""",
zs AS (
  SELECT split, total_amount::DOUBLE AS y, (trip_distance - m) / sd AS z
  FROM split_t CROSS JOIN (SELECT avg(trip_distance) AS m, stddev_pop(trip_distance) AS sd
                           FROM split_t WHERE split = 'train')),
mom AS (
  SELECT CAST(count(*) AS DOUBLE) AS n, avg(z) AS mz, avg(y) AS my, var_pop(z) AS v,
         covar_pop(z, y) AS c FROM zs WHERE split IN ({fitted_on})),
settings AS ({rows}),
fit AS (
  SELECT s.*, mz, my, sign(c) * greatest(abs(c) - a * rho / 2, 0) / (v + a * (1 - rho)) AS w
  FROM settings s CROSS JOIN mom),
e AS (
  SELECT type, model, alpha, l1_ratio, a, rho, w, split, y, y - (my + w * (z - mz)) AS err
  FROM zs CROSS JOIN fit),
m AS (
  SELECT type, model, alpha, l1_ratio, a * (rho * abs(w) + (1 - rho) * w * w) AS pen, split,
         count(*) AS n, avg(err * err) AS mse, avg(abs(err)) AS mae, var_pop(y) AS vy
  FROM e GROUP BY ALL)"""


def _wide(splits: tuple[str, ...], more: str = "") -> str:
    cols = ", ".join(
        f"round(sqrt(max(mse) FILTER (WHERE split = '{s}')), 4) AS rmse_{s}, "
        f"round(max(mae) FILTER (WHERE split = '{s}'), 4) AS mae_{s}, "
        f"round(max(1 - mse / vy) FILTER (WHERE split = '{s}'), 4) AS r2_{s}" for s in splits)
    return (f"SELECT model, type, alpha, l1_ratio, {cols}{more} "
            "FROM m GROUP BY model, type, alpha, l1_ratio")


_LOSSES = "".join(f", round(max(mse + pen) FILTER (WHERE split = '{s}'), 4) AS loss_{s}"
                  for s in ("train", "val"))
ORACLE["one_feature_models"] = qml(_wide(("train", "val"), _LOSSES), _one_feature(
    {"spark-ml": _REF_CLOSED}, "'train'"))
ORACLE["one_feature_grid"] = qml(_wide(("train", "val"), _LOSSES), _one_feature(
    {"moments": _GRID_CLOSED + _REF_CLOSED[1:]}, "'train'"))
ORACLE["one_feature_comparison"] = qml(_wide(("train", "val")), _one_feature(
    {f"{name}/{o}": v for name in ("spark-ml", "moments")
     for o, v in (("reference", _REF_CLOSED), ("library", _LIB_CLOSED))}, "'train'"))
ORACLE["one_feature_refit"] = qml(
    _wide(("test",), ", max(n) FILTER (WHERE split = 'test') AS n_test"),
    _one_feature({"reference": _REF_CLOSED, "library": _LIB_CLOSED}, "'train', 'val'"))

# The fit starts at w = 0 and ends with its first step.
ORACLE["one_feature_loss_history"] = qml("""
SELECT model, alpha, l1_ratio, CAST(i AS INTEGER) AS iteration,
       round(avg(CASE WHEN split = 'train' THEN err * err + pen END), 4) AS loss_train,
       round(avg(CASE WHEN split = 'val' THEN err * err + pen END), 4) AS loss_val
FROM (SELECT model, alpha, l1_ratio, i, split, y - (my + i * w * (z - mz)) AS err,
             i * a * (rho * abs(w) + (1 - rho) * w * w) AS pen
      FROM zs CROSS JOIN fit CROSS JOIN (VALUES (0), (1)) t(i))
GROUP BY model, alpha, l1_ratio, i""", _one_feature({"spark-ml": _REF_CLOSED[1:]}, "'train'"))

# Two features: the 2 x 2 normal equations, with the ridge's a on the diagonal.
_TWO = """,
x2 AS (SELECT split, total_amount::DOUBLE AS y, trip_distance AS p,
              trip_distance * trip_distance AS q FROM split_t),
zs AS (
  SELECT split, y, (p - mp) / sp AS z1, (q - mq) / sq AS z2
  FROM x2 CROSS JOIN (SELECT avg(p) AS mp, stddev_pop(p) AS sp, avg(q) AS mq,
                             stddev_pop(q) AS sq FROM x2 WHERE split = 'train')),
mom AS (
  SELECT CAST(count(*) AS DOUBLE) AS n, avg(z1) AS m1, avg(z2) AS m2, avg(y) AS my,
         var_pop(z1) AS v1, var_pop(z2) AS v2, covar_pop(z1, z2) AS c12,
         covar_pop(z1, y) AS c1, covar_pop(z2, y) AS c2 FROM zs WHERE split = 'train'),
settings AS (
  SELECT 'reference' AS type, 'linear' AS model, 0.0::DOUBLE AS alpha, 0.0::DOUBLE AS a FROM mom
  UNION ALL SELECT 'library', 'linear', 0.0, 0.0 FROM mom
  UNION ALL SELECT 'reference', 'ridge', 0.25, 0.25 FROM mom
  UNION ALL SELECT 'library', 'ridge', 0.25, 0.25 / n FROM mom),
fit AS (
  SELECT s.*, my, m1, m2,
         ((v2 + a) * c1 - c12 * c2) / ((v1 + a) * (v2 + a) - c12 * c12) AS w1,
         ((v1 + a) * c2 - c12 * c1) / ((v1 + a) * (v2 + a) - c12 * c12) AS w2
  FROM settings s CROSS JOIN mom)"""
ORACLE["two_feature_poly"] = qml("""
SELECT model, type, alpha, CAST(NULL AS DOUBLE) AS l1_ratio, round(sqrt(avg(err * err)), 4) AS rmse_test,
       round(avg(abs(err)), 4) AS mae_test, round(1 - avg(err * err) / var_pop(y), 4) AS r2_test
FROM (SELECT model, type, alpha, y, y - (my + w1 * (z1 - m1) + w2 * (z2 - m2)) AS err
      FROM zs CROSS JOIN fit WHERE split = 'test')
GROUP BY model, type, alpha""", _TWO)
ORACLE["two_feature_coefficients"] = qml("""
SELECT 'trip_distance' AS feature, round(w1, 4) AS coef, round(abs(w1), 4) AS abs_coef
FROM fit WHERE type = 'reference' AND model = 'ridge'
UNION ALL
SELECT 'trip_distance_sq', round(w2, 4), round(abs(w2), 4)
FROM fit WHERE type = 'reference' AND model = 'ridge'""", _TWO)

# With L1 the minimiser is the best of the candidates for each pair of signs (0: the feature is
# out) that come out with these signs.
_TWO_SETTINGS = " UNION ALL ".join(
    f"SELECT '{t}' AS type, '{m}' AS model, {alpha!r}::DOUBLE AS alpha, "
    f"{'NULL' if l1 is None else l1}::DOUBLE AS l1_ratio, ({a}) * {rho!r}::DOUBLE AS l1, "
    f"({a}) * (1 - {rho!r}::DOUBLE) AS l2 FROM mom"
    for t, settings in (("reference", _REF_CLOSED), ("library", _LIB_CLOSED))
    for m, alpha, l1, a, rho in settings)
ORACLE["two_feature_poly_models"] = qml(_wide(("val", "test")), _TWO + f""",
penalised AS ({_TWO_SETTINGS}),
candidates AS (
  SELECT s.*, s1, s2, v1, v2, c1, c2, c12, v1 + l2 AS d1, v2 + l2 AS d2,
         c1 - l1 / 2 * s1 AS r1, c2 - l1 / 2 * s2 AS r2
  FROM penalised s CROSS JOIN mom CROSS JOIN (VALUES (-1), (0), (1)) a(s1)
  CROSS JOIN (VALUES (-1), (0), (1)) b(s2)),
solved AS (
  SELECT *, CASE WHEN s1 = 0 THEN 0 WHEN s2 = 0 THEN r1 / d1
                 ELSE (d2 * r1 - c12 * r2) / (d1 * d2 - c12 * c12) END AS w1,
         CASE WHEN s2 = 0 THEN 0 WHEN s1 = 0 THEN r2 / d2
              ELSE (d1 * r2 - c12 * r1) / (d1 * d2 - c12 * c12) END AS w2
  FROM candidates),
best AS (
  SELECT *, row_number() OVER (
    PARTITION BY type, model ORDER BY v1 * w1 * w1 + v2 * w2 * w2 + 2 * c12 * w1 * w2
      - 2 * (c1 * w1 + c2 * w2) + l1 * (abs(w1) + abs(w2)) + l2 * (w1 * w1 + w2 * w2)) AS r
  FROM solved WHERE l1 = 0 AND s1 <> 0 AND s2 <> 0 OR sign(w1) = s1 AND sign(w2) = s2),
e AS (
  SELECT type, model, alpha, l1_ratio, split, y,
         y - (my + w1 * (z1 - m1) + w2 * (z2 - m2)) AS err
  FROM zs CROSS JOIN best CROSS JOIN (SELECT my, m1, m2 FROM mom) WHERE r = 1),
m AS (
  SELECT type, model, alpha, l1_ratio, split, avg(err * err) AS mse, avg(abs(err)) AS mae,
         var_pop(y) AS vy
  FROM e GROUP BY ALL)""")
