"""Request grids, maps and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.fixed_values import DEFAULT_LOCATIONS
from obsflow.functions import scalars
from obsflow.functions.maps import parse_amounts, total_by
from obsflow.plans.orders import order_totals
from obsflow.registry.inputs import OBSERVATIONS_SQL, observations, table
from obsflow.sources.requests import request_grid, resolve_locations

ORDERS_PER_DOCUMENT = 512


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each observed location on the five days before it was last observed."""
    places = observations(spark, sf_dir).groupBy("user_id", "latitude", "longitude").agg(
        F.max("datetime").alias("last")
    )
    return request_grid(places, F.col("last")).select(
        "user_id", "latitude", "longitude", "day", "dt", "units"
    )


def default_or_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as requests: coordinates given, blank, missing, or half blank."""
    key = F.col("c_custkey")
    requests = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(key % 4 == 0, "").when(key % 4 == 1, F.lit(None)).otherwise(
            key.cast("string")).alias("latitude"),
        F.when(key % 4 == 0, F.lit(None)).when(key % 4 < 3, "  ").otherwise(
            (-key).cast("string")).alias("longitude"),
    )
    return resolve_locations(requests)


def _order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of one priority as JSON objects of order and price, of bounded length."""
    pair = F.struct(F.col("o_orderkey").cast("string").alias("key"), F.col("o_totalprice"))
    bucket = F.expr(f"o_orderkey DIV {ORDERS_PER_DOCUMENT}").alias("bucket")
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderpriority", bucket)
        .agg(F.to_json(F.map_from_entries(F.collect_list(pair))).alias("document"))
    )


def map_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = order_totals(_order_documents(spark, sf_dir))
    return totals.select(
        "o_orderpriority", "bucket", F.round("total_order_value", 2).alias("total"), "message"
    )


def map_total_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    amounts = _order_documents(spark, sf_dir).withColumn("amounts", parse_amounts(F.col("document")))
    totals = total_by(amounts, ["o_orderpriority"], "amounts")
    return totals.select("o_orderpriority", F.round("total", 2).alias("total"))


def format_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        scalars.stamp(F.col("ts")).alias("seconds"),
        scalars.stamp(F.col("ts"), micros=True).alias("micros"),
    )


def epoch_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    epoch = scalars.to_epoch(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id", epoch.alias("epoch"), scalars.from_epoch(epoch).alias("moment")
    )


def calendar_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = scalars.as_date(F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", date.alias("date"), F.month(date).alias("month"),
        F.date_sub(date, 5).alias("five_days_before"),
    )


def safe_casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Casts of text that may be no number or date; what does not fit is null."""
    customer = table(spark, sf_dir, "customer")
    balance = F.col("c_acctbal").cast("string")
    return customer.select(
        "c_custkey",
        scalars.as_long(F.substr("c_name", F.lit(10))).alias("number"),
        scalars.as_long(F.col("c_mktsegment")).alias("no_number"),
        scalars.as_measure(balance).alias("balance"),
        scalars.as_measure(F.lit("")).alias("blank"),
        F.round(scalars.as_measure(balance) / 8, 2).alias("eighth"),
        scalars.as_date(
            F.concat(F.lit("2020-"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"),
                     F.lit("-15"))
        ).alias("date"),
    )


def text_building(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        scalars.point_text(F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string"))
        .alias("point"),
        scalars.request_address(F.lit("https://host/"), F.col("s_name")).alias("address"),
        scalars.total_message(F.col("s_acctbal")).alias("message"),
    )


def optional_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "map<string,bigint>")
    return table(spark, sf_dir, "events").select(
        "event_id",
        scalars.optional(props, "k").alias("present"),
        scalars.optional(props, "city").alias("absent"),
        F.to_json(props).alias("text"),
    )


QUERIES = {
    "request_grid": grid,
    "default_or_override": default_or_override,
    "map_total": map_total,
    "map_total_by_key": map_total_by_key,
    "format_stamp": format_stamp,
    "epoch_round_trip": epoch_round_trip,
    "calendar_parts": calendar_parts,
    "safe_casts": safe_casts,
    "text_building": text_building,
    "optional_fields": optional_fields,
}

_DEFAULTS_SQL = ", ".join(f"('{lat}', '{lon}')" for lat, lon in DEFAULT_LOCATIONS)

ORACLES = {
    "request_grid": f"""
WITH {OBSERVATIONS_SQL}, places AS (
    SELECT user_id, latitude, longitude, max(datetime) AS last FROM observations GROUP BY ALL
)
SELECT user_id, CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
       strftime(last - to_days(CAST(back AS INTEGER)), '%Y-%m-%d') AS day,
       CAST(epoch_us(last - to_days(CAST(back AS INTEGER))) // 1000000 AS BIGINT) AS dt,
       'metric' AS units
FROM places, range(1, 6) AS days(back)""",
    "default_or_override": f"""
WITH requests AS (
    SELECT c_custkey,
           CASE WHEN c_custkey % 4 = 0 THEN '' WHEN c_custkey % 4 = 1 THEN NULL
                ELSE CAST(c_custkey AS VARCHAR) END AS latitude,
           CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_custkey % 4 < 3 THEN '  '
                ELSE CAST(-c_custkey AS VARCHAR) END AS longitude
    FROM customer
), defaults(latitude, longitude) AS (VALUES {_DEFAULTS_SQL})
SELECT c_custkey, d.latitude, d.longitude FROM requests r, defaults d
WHERE coalesce(trim(r.latitude), '') = '' AND coalesce(trim(r.longitude), '') = ''
UNION ALL
SELECT c_custkey, latitude, longitude FROM requests
WHERE NOT (coalesce(trim(latitude), '') = '' AND coalesce(trim(longitude), '') = '')""",
    "map_total": f"""
WITH totals AS (
    SELECT o_orderpriority, o_orderkey // {ORDERS_PER_DOCUMENT} AS bucket,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
    FROM orders GROUP BY ALL
)
SELECT *, printf('Total order value is: %.2f', total) AS message FROM totals""",
    "map_total_by_key": """
SELECT o_orderpriority, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY ALL""",
    "format_stamp": """
SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS seconds, strftime(ts, '%Y%m%d%H%M%S%f') AS micros
FROM events""",
    "epoch_round_trip": """
SELECT event_id, epoch_us(ts) // 1000000 AS epoch,
       strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS moment
FROM events""",
    "calendar_parts": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date,
       CAST(extract(month FROM o_orderdate) AS BIGINT) AS month,
       strftime(o_orderdate - INTERVAL 5 DAY, '%Y-%m-%d') AS five_days_before
FROM orders""",
    "safe_casts": """
SELECT c_custkey, TRY_CAST(substr(c_name, 10) AS BIGINT) AS number,
       TRY_CAST(c_mktsegment AS BIGINT) AS no_number,
       c_acctbal AS balance, CAST(NULL AS DOUBLE) AS blank,
       CAST(CAST(round(CAST(c_acctbal AS DECIMAL(18,2)) * CAST(0.125 AS DECIMAL(4,3)), 2)
            AS DECIMAL(18,2)) AS DOUBLE) AS eighth,
       CASE WHEN c_nationkey BETWEEN 1 AND 12
            THEN '2020-' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '-15' END AS date
FROM customer""",
    "text_building": """
SELECT s_suppkey, s_suppkey || ',' || s_nationkey AS point, 'https://host/' || s_name AS address,
       printf('Total order value is: %.2f', s_acctbal) AS message
FROM supplier""",
    "optional_fields": """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS present,
       CAST(NULL AS BIGINT) AS absent,
       '{"k":' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}' AS text
FROM events""",
}
