"""Merges, checks, tables and file round trips."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.operators.merge import except_rows, first_per_key, merge_insert_only, new_keys
from obsflow.operators.quality import duplicate_keys, null_counts, over_length
from obsflow.plans.weather import WeatherStore
from obsflow.registry.inputs import (
    EVENTS_PER_DOCUMENT,
    LOCATIONS_SQL,
    OBSERVATIONS_SQL,
    entry_sql,
    locations,
    new_database,
    observations,
    table,
    weather_documents,
)
from obsflow.schemas import COORDINATE, HOURLY_KEY, LOCATION, MEASURE
from obsflow.session import work_folder
from obsflow.sinks.files import append_headerless_csv, land_documents, write_headerless_csv
from obsflow.sinks.tables import BaseTable, create_table, reload_table, write_layer
from obsflow.sources.tables import read_headerless_csv, read_layer
from obsflow.streaming.incremental import run_available

# Two batches that together cover the whole table and overlap by half a month.
FIRST_BATCH_END = 20
SECOND_BATCH_START = 6

HOUR_SCHEMA = T.StructType(
    [
        T.StructField("latitude", COORDINATE),
        T.StructField("longitude", COORDINATE),
        T.StructField("datetime", T.TimestampType()),
        T.StructField("event_id", T.LongType()),
        T.StructField("temp", MEASURE),
    ]
)


def hour_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations at hour grain, where keys do repeat."""
    hour = F.date_trunc("hour", F.col("datetime").cast("timestamp"))
    return observations(spark, sf_dir).select(
        "latitude", "longitude", hour.alias("datetime"), "event_id", "temp"
    )


def hour_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    hours = hour_rows(spark, sf_dir)
    day = F.dayofmonth("datetime")
    later = hours.withColumn("temp", (F.col("temp") + 1).cast(MEASURE))
    return hours.filter(day <= FIRST_BATCH_END), later.filter(day >= SECOND_BATCH_START)


_HOURS_SQL = f"""{OBSERVATIONS_SQL}, hours AS (
    SELECT latitude, longitude, date_trunc('hour', datetime) AS datetime, event_id, temp
    FROM observations
), first_batch AS (
    SELECT * FROM hours WHERE extract(day FROM datetime) <= {FIRST_BATCH_END}
), second_batch AS (
    SELECT latitude, longitude, datetime, event_id, CAST(temp + 1 AS DECIMAL(18,6)) AS temp
    FROM hours WHERE extract(day FROM datetime) >= {SECOND_BATCH_START}
)"""

_HOUR_COLUMNS = """CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
       strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, event_id, CAST(temp AS DOUBLE) AS temp"""


def hour_table(spark: SparkSession) -> BaseTable:
    return BaseTable(
        work_folder(spark, "store") + "/hours", HOUR_SCHEMA, HOURLY_KEY, HOURLY_KEY,
        partition="obs_date", partition_from="datetime",
    )


def merge_two_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = hour_table(spark)
    for batch in hour_batches(spark, sf_dir):
        merge_insert_only(batch, base, "first", ["event_id"])
    return base.read(spark).drop("obs_date")


def merge_reruns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch loaded twice, the first once more at the end: nothing changes."""
    base = hour_table(spark)
    first, second = hour_batches(spark, sf_dir)
    for batch in (first, first, second, second, first):
        merge_insert_only(batch, base, "first", ["event_id"])
    return base.read(spark).drop("obs_date")


def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_per_key(hour_rows(spark, sf_dir), HOURLY_KEY, ["event_id"])


def except_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = hour_rows(spark, sf_dir).drop("event_id")
    day = F.dayofmonth("datetime")
    return except_rows(
        hours.filter(day >= SECOND_BATCH_START), hours.filter(day <= FIRST_BATCH_END)
    )


def anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without a line."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderkey"), "o_totalprice"
    )
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("orderkey"))
    return new_keys(orders, lines, ["orderkey"])


def dup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_counts(locations(spark, sf_dir), LOCATION.names)


def too_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return over_length(table(spark, sf_dir, "documents"), ["text", "lang", "source"])


def staging_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table created twice, filled, then emptied and filled with another batch."""
    name = f"{new_database(spark)}.hours_staged"
    create_table(spark, name, HOUR_SCHEMA)
    create_table(spark, name, HOUR_SCHEMA)
    for batch in hour_batches(spark, sf_dir):
        reload_table(batch, name)
    return spark.table(name)


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = work_folder(spark, "csv")
    write_headerless_csv(locations(spark, sf_dir), folder)
    return read_headerless_csv(spark, folder, LOCATION)


def csv_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two relations appended to one folder and read as one."""
    folder = work_folder(spark, "csv")
    for name, key in (("customer", "c"), ("supplier", "s")):
        rows = table(spark, sf_dir, name)
        append_headerless_csv(
            rows.select(f"{key}_name", f"{key}_nationkey", f"{key}_acctbal"), folder
        )
    schema = T.StructType.fromDDL("name string, nationkey int, acctbal double")
    return read_headerless_csv(spark, folder, schema)


def union_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two landed folders by column name, a missing column being null."""
    root = work_folder(spark, "lake")
    customer = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"))
    for name, rows in (("customer", customer), ("supplier", supplier)):
        write_layer(rows, root, "raw", name)
    landed = [read_layer(spark, root, "raw", name) for name in ("customer", "supplier")]
    return landed[0].unionByName(landed[1], allowMissingColumns=True)


def layer_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A layer overwritten by rows with other columns keeps its old ones, as nulls."""
    root = work_folder(spark, "lake")
    customer = table(spark, sf_dir, "customer")
    write_layer(customer.select("c_custkey", "c_name"), root, "bronze", "customer")
    write_layer(
        customer.select("c_acctbal", "c_custkey"), root, "bronze", "customer", evolve=True
    )
    return read_layer(spark, root, "bronze", "customer")


def _incremental(spark: SparkSession, sf_dir: str) -> WeatherStore:
    """Two landed runs, each followed by an incremental load; late corrections are ignored."""
    store = WeatherStore(work_folder(spark, "store"))
    landing = work_folder(spark, "landing")
    checkpoint = work_folder(spark, "offsets")
    day = F.dayofmonth("day")
    first = weather_documents(spark, sf_dir).filter(day <= FIRST_BATCH_END)
    second = weather_documents(spark, sf_dir, changed=True).filter(day >= SECOND_BATCH_START)
    for stamp, documents in (("20240121000000", first), ("20240131000000", second)):
        land_documents(documents.drop("day"), landing, stamp)
        run_available(spark, landing, store, checkpoint)
    return store


def incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incremental(spark, sf_dir).hourly.read(spark).drop("obs_date")


def incremental_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incremental(spark, sf_dir).current.read(spark).drop("obs_date")


QUERIES = {
    "merge_two_batches": merge_two_batches,
    "merge_reruns": merge_reruns,
    "dedupe_first_per_key": dedupe_first,
    "except_new_rows": except_new,
    "anti_join_new_keys": anti_join,
    "dup_keys": dup_keys,
    "null_counts": nulls,
    "over_length": too_long,
    "staging_reload": staging_reload,
    "csv_round_trip": csv_round_trip,
    "csv_append": csv_append,
    "union_folders": union_folders,
    "layer_evolution": layer_evolution,
    "incremental_available_now": incremental,
    "incremental_current": incremental_current,
}

MERGED_SQL = f"""
WITH {_HOURS_SQL}, loaded AS (
    SELECT * FROM first_batch
    QUALIFY row_number() OVER (PARTITION BY latitude, longitude, datetime ORDER BY event_id) = 1
), added AS (
    SELECT * FROM second_batch
    QUALIFY row_number() OVER (PARTITION BY latitude, longitude, datetime ORDER BY event_id) = 1
)
SELECT {_HOUR_COLUMNS} FROM loaded
UNION ALL
SELECT {_HOUR_COLUMNS} FROM added a
WHERE NOT EXISTS (SELECT 1 FROM loaded l WHERE l.latitude = a.latitude
                  AND l.longitude = a.longitude AND l.datetime = a.datetime)"""

_HOUR_WINDOW = """row_number() OVER (
        PARTITION BY latitude, longitude, datetime
        ORDER BY timezone, temp, feels_like, pressure, humidity, dew_point, uvi) = 1"""



def _incremental_sql(entries: str, moment: str, window: str) -> str:
    return f"""
WITH entries AS ({entries}), loaded AS (
    SELECT * FROM entries WHERE extract(day FROM ts) <= {FIRST_BATCH_END}
    QUALIFY {window}
), added AS (
    SELECT * REPLACE (CAST(CAST(temp + 1 AS DECIMAL(18,6)) AS DOUBLE) AS temp) FROM entries
    WHERE extract(day FROM ts) >= {SECOND_BATCH_START}
    QUALIFY {window}
)
SELECT * EXCLUDE (ts) FROM loaded
UNION ALL
SELECT * EXCLUDE (ts) FROM added a
WHERE NOT EXISTS (SELECT 1 FROM loaded l WHERE l.latitude = a.latitude
                  AND l.longitude = a.longitude AND l.{moment} = a.{moment})"""


ORACLES = {
    "merge_two_batches": MERGED_SQL,
    "merge_reruns": MERGED_SQL,
    "dedupe_first_per_key": f"""
WITH {_HOURS_SQL}
SELECT {_HOUR_COLUMNS} FROM hours
QUALIFY row_number() OVER (
    PARTITION BY hours.latitude, hours.longitude, hours.datetime ORDER BY event_id) = 1""",
    "except_new_rows": f"""
WITH {OBSERVATIONS_SQL}, hours AS (
    SELECT latitude, longitude, date_trunc('hour', datetime) AS datetime, temp FROM observations
), fresh AS (
    SELECT * FROM hours WHERE extract(day FROM datetime) >= {SECOND_BATCH_START}
    EXCEPT
    SELECT * FROM hours WHERE extract(day FROM datetime) <= {FIRST_BATCH_END}
)
SELECT CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
       strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, CAST(temp AS DOUBLE) AS temp
FROM fresh""",
    "anti_join_new_keys": """
SELECT o_orderkey AS orderkey, o_totalprice FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "dup_keys": """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS rows
FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "null_counts": f"""
WITH {LOCATIONS_SQL}
SELECT 'latitude' AS column_name, count(*) FILTER (latitude IS NULL) AS nulls FROM locations
UNION ALL SELECT 'longitude', count(*) FILTER (longitude IS NULL) FROM locations
UNION ALL SELECT 'city', count(*) FILTER (city IS NULL) FROM locations
UNION ALL SELECT 'state', count(*) FILTER (state IS NULL) FROM locations
UNION ALL SELECT 'postcode', count(*) FILTER (postcode IS NULL) FROM locations
UNION ALL SELECT 'country', count(*) FILTER (country IS NULL) FROM locations""",
    "over_length": """
SELECT 'text' AS column_name, count(*) FILTER (length(text) > 255) AS too_long FROM documents
UNION ALL SELECT 'lang', count(*) FILTER (length(lang) > 255) FROM documents
UNION ALL SELECT 'source', count(*) FILTER (length(source) > 255) FROM documents""",
    "staging_reload": f"""
WITH {_HOURS_SQL}
SELECT {_HOUR_COLUMNS} FROM second_batch""",
    "csv_round_trip": f"""
WITH {LOCATIONS_SQL}
SELECT CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
       city, state, postcode, country
FROM locations""",
    "csv_append": """
SELECT c_name AS name, CAST(c_nationkey AS BIGINT) AS nationkey, c_acctbal AS acctbal FROM customer
UNION ALL
SELECT s_name, CAST(s_nationkey AS BIGINT), s_acctbal FROM supplier""",
    "union_folders": """
SELECT c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL
SELECT s_name, NULL FROM supplier""",
    "layer_evolution": """
SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_name, c_acctbal FROM customer""",
    "incremental_available_now": _incremental_sql(f"SELECT {entry_sql()}, ts FROM events", "datetime", _HOUR_WINDOW),
    "incremental_current": _incremental_sql(
        f"""SELECT {entry_sql(now=True)}, ts FROM (SELECT * FROM events QUALIFY row_number() OVER (
            PARTITION BY user_id, date_trunc('day', ts), event_id // {EVENTS_PER_DOCUMENT} ORDER BY ts DESC, event_id DESC) = 1)""",
        "requested_datetime",
        _HOUR_WINDOW.replace("datetime", "requested_datetime").replace("timezone, temp", "timezone, sunrise, sunset, temp"),
    ),
}
