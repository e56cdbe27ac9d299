"""Trip-shaped views over the star-schema test tables (the repository's test fixtures).

The test tables are order lines, not taxi trips; these views put them into the shape of the
monthly trip files so every operator runs over whole tables that grow with the scale factor:

* ``raw_trips``   lineitem ⋈ orders ⋈ customer ⋈ supplier, one row per line, in the raw file
  shape of one service plus its file keys ``source_year`` / ``source_month``;
* ``zones``       nation ⋈ region as the zone lookup (LocationID, Borough, Zone);
* ``event_trips`` events with sub-second pickup times, for hour / weekday / duration checks.

All joins are plain equi-joins: the planner broadcasts the dimension sides when statistics
show them small and shuffles otherwise (AQE splits skewed order keys).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdeck.sources.schemas import SERVICE_TIME_COLUMNS, align, raw_file_schema

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
TRIP_TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem")

# Fixed values of the fixture mapping.
RETURNFLAG_TO_VENDOR = {"A": 1, "R": 2, "N": 3}
YELLOW_LINESTATUS = "O"
CONSTANT_CHARGES = {"extra": 0.5, "tolls_amount": 0.0, "improvement_surcharge": 0.3,
                    "congestion_surcharge": 2.5, "airport_fee": 1.25}
FARE_DIVISOR = 200.0


_READS: dict[tuple, DataFrame] = {}


def stamp(spark: SparkSession, path: str) -> tuple[int, int]:
    """Modification time and length of a file or folder as its file system states them."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    status = fs.getFileStatus(hadoop)
    return status.getModificationTime(), status.getLen()


def version(spark: SparkSession, sf_dir: str) -> tuple:
    """The stamps of the tables that trips are made of."""
    return tuple(stamp(spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in TRIP_TABLES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table. The relation (file listing, footer schema) is built once per session, path
    and state of the path, and then reused by every query, as a catalog table would be; a table
    that was rewritten is read anew."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path, stamp(spark, path))
    if key not in _READS:
        _READS[key] = spark.read.parquet(path)
    return _READS[key]


def service_of_line(linestatus: str = "l_linestatus"):
    return F.when(F.col(linestatus) == YELLOW_LINESTATUS, F.lit("yellow")).otherwise(F.lit("green"))


def lines_of_service(service: str):
    """The service predicate written so that it reaches the Parquet scan as a pushed filter."""
    ls = F.col("l_linestatus")
    if service == "yellow":
        return ls == YELLOW_LINESTATUS
    return (ls != YELLOW_LINESTATUS) | ls.isNull()


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # dimensions first: a customer table above the broadcast limit shuffles orders, not lines
    orders = orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
    return (li.join(supp, F.col("l_suppkey") == F.col("s_suppkey"))
              .join(orders, F.col("l_orderkey") == F.col("o_orderkey")))


def _trip_columns(service: Column) -> dict[str, Column]:
    """The trip columns of joined order lines, for the given service of each line."""
    fare = F.col("l_extendedprice") / FARE_DIVISOR
    vendor = None
    for flag, code in RETURNFLAG_TO_VENDOR.items():
        vendor = (F.when(F.col("l_returnflag") == flag, F.lit(code)) if vendor is None
                  else vendor.when(F.col("l_returnflag") == flag, F.lit(code)))
    return {
        "pickup_datetime": F.col("o_orderdate"),
        "dropoff_datetime": F.col("l_shipdate"),
        "VendorID": vendor,
        "store_and_fwd_flag": F.lit("N"),
        "RatecodeID": F.col("l_linenumber"),
        "PULocationID": F.col("c_nationkey"),
        "DOLocationID": F.col("s_nationkey"),
        "passenger_count": F.col("l_quantity").cast("int") % 8,
        "trip_distance": F.col("l_quantity"),
        "fare_amount": fare,
        "extra": F.lit(CONSTANT_CHARGES["extra"]),
        # "+ 0.0" turns the -0.0 of zero discounts/taxes into 0.0.
        "mta_tax": fare * F.col("l_tax") + 0.0,
        "tip_amount": fare * F.col("l_discount") + 0.0,
        "tolls_amount": F.lit(CONSTANT_CHARGES["tolls_amount"]),
        "improvement_surcharge": F.lit(CONSTANT_CHARGES["improvement_surcharge"]),
        "total_amount": fare * (1 + F.col("l_discount") + F.col("l_tax")),
        "payment_type": F.substring("o_orderpriority", 1, 1).cast("int"),
        "congestion_surcharge": F.lit(CONSTANT_CHARGES["congestion_surcharge"]),
        "airport_fee": F.when(service == "yellow", F.lit(CONSTANT_CHARGES["airport_fee"])),
        "trip_type": F.when(service != "yellow", F.col("l_linenumber") % 2 + 1),
        "source_year": F.year("o_orderdate"),
        "source_month": F.month("o_orderdate"),
    }


def raw_trips(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """Rows of ``service`` in the raw monthly-file shape, plus ``source_year``/``source_month``."""
    pickup, dropoff = SERVICE_TIME_COLUMNS[service]
    lines = _lines(spark, sf_dir).where(lines_of_service(service))
    shaped = lines.select(*[c.alias(n) for n, c in _trip_columns(F.lit(service)).items()])
    shaped = shaped.withColumnsRenamed({"pickup_datetime": pickup, "dropoff_datetime": dropoff})
    return align(shaped, raw_file_schema(service, with_keys=True))


def trips_of_all_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both services with their ``service_type`` and renamed times, from one pass over
    the order lines."""
    service = F.col("service_type")
    lines = _lines(spark, sf_dir).withColumn("service_type", service_of_line())
    return lines.select(*[c.alias(n) for n, c in _trip_columns(service).items()], "service_type")


def trip_years(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """First and last pickup year (one aggregate over one column)."""
    year = F.year("o_orderdate")
    row = table(spark, sf_dir, "orders").agg(F.min(year).alias("a"), F.max(year).alias("b")).first()
    if row["a"] is None:
        raise ValueError(f"no trips in {sf_dir}")
    return int(row["a"]), int(row["b"])


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup: ``LocationID`` = nation key, ``Zone`` = nation name, ``Borough`` = region."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
                  .select(F.col("n_nationkey").cast("int").alias("LocationID"),
                          F.col("r_name").alias("Borough"),
                          F.col("n_name").alias("Zone"),
                          F.lit(None).cast("string").alias("service_zone")))


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trips: pickup = ``ts``, dropoff = ``ts + value`` seconds (microsecond exact)."""
    ev = table(spark, sf_dir, "events")
    seconds = F.col("value").cast("decimal(18,6)")
    return ev.select(
        "event_id",
        F.col("ts").alias("pickup_datetime"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds))
        .alias("dropoff_datetime"),
        F.when(F.col("event_id") % 2 == 0, F.lit("yellow")).otherwise(F.lit("green"))
        .alias("service_type"),
        F.year("ts").alias("source_year"),
        F.month("ts").alias("source_month"),
        F.col("value").alias("trip_distance"),
    )
