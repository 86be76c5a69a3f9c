"""Relations the queries derive from the test tables, in Spark and as SQL.

There is no weather among the tables. Each customer stands for a location with coordinates
computed from its key, and each event for an observation at the customer it names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.functions.scalars import as_coordinate, as_measure
from obsflow.session import work_folder
from obsflow.sinks.files import land_documents

# A document holds observations of this many consecutive event numbers at most, which
# bounds its size however many events one location has.
EVENTS_PER_DOCUMENT = 4096


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def comparable(rows: DataFrame) -> DataFrame:
    """Plain types that every engine hands out alike: text for moments, doubles for decimals."""
    columns = []
    for field in rows.schema.fields:
        value = F.col("`" + field.name + "`")
        if isinstance(field.dataType, T.DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            value = value.cast("bigint")
        elif isinstance(field.dataType, T.DateType):
            value = F.date_format(value, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
        columns.append(value.alias(field.name))
    return rows.select(*columns)


def _degrees(micro: str) -> Column:
    return F.expr(f"CAST(CAST({micro} AS DECIMAL(12,0)) * 0.000001BD AS DECIMAL(9,6))")


def _degrees_sql(micro: str) -> str:
    return (
        f"CAST(CAST({micro} AS DECIMAL(12,0)) * CAST(0.000001 AS DECIMAL(7,6)) AS DECIMAL(9,6))"
    )


def _latitude(key: str) -> str:
    return f"({key} * 7919) % 1200000 * 100 - 60000000"


def _longitude(key: str) -> str:
    return f"({key} * 104729) % 3600000 * 100 - 180000000"


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer; six decimals, of which the last two are lost by rounding."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    named = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(
        region, nation.n_regionkey == region.r_regionkey
    )
    key = F.col("c_custkey")
    return named.select(
        _degrees(_latitude("c_custkey") + " + c_custkey % 40").alias("latitude"),
        _degrees(_longitude("c_custkey") + " + c_custkey * 3 % 40").alias("longitude"),
        F.concat(F.lit("City "), key % 20).alias("city"),
        F.col("n_name").alias("state"),
        F.when(key % 7 != 0, F.concat(F.lit("P"), key)).alias("postcode"),
        F.col("r_name").alias("country"),
    )


LOCATIONS_SQL = f"""locations AS (
    SELECT {_degrees_sql(_latitude('c_custkey') + ' + c_custkey % 40')} AS latitude,
           {_degrees_sql(_longitude('c_custkey') + ' + c_custkey * 3 % 40')} AS longitude,
           'City ' || (c_custkey % 20) AS city,
           n_name AS state,
           CASE WHEN c_custkey % 7 <> 0 THEN 'P' || c_custkey END AS postcode,
           r_name AS country
    FROM customer
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
)"""


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event, at four decimals, as a service would echo the coordinates."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        _degrees(_latitude("user_id")).alias("latitude"),
        _degrees(_longitude("user_id")).alias("longitude"),
        F.col("ts").alias("datetime"),
        as_measure(F.col("value")).alias("temp"),
    )


OBSERVATIONS_SQL = f"""observations AS (
    SELECT event_id, user_id,
           {_degrees_sql(_latitude('user_id'))} AS latitude,
           {_degrees_sql(_longitude('user_id'))} AS longitude,
           ts AS datetime,
           CAST(value AS DECIMAL(18,6)) AS temp
    FROM events
)"""

JOINED_SQL = f"""{LOCATIONS_SQL}, {OBSERVATIONS_SQL}, joined AS (
    SELECT o.event_id, o.datetime, o.temp, l.city, l.state, l.postcode, l.country
    FROM locations l, observations o
    WHERE round(l.latitude, 4) = round(o.latitude, 4)
      AND round(l.longitude, 4) = round(o.longitude, 4)
)"""


def average_sql(value: str) -> str:
    """Average of non-negative values in hundredths, rounded half up to two places."""
    cents = f"CAST(sum(CAST({value} AS DECIMAL(18,2)) * 100) AS HUGEINT)"
    return f"CAST((2 * {cents} + count({value})) // (2 * count({value})) AS DOUBLE) / 100"


# --- documents ---------------------------------------------------------------

# Entry fields computed from an event, in one wording for both engines. ``{e}`` stands for
# the event the columns belong to.
ENTRY_FIELDS = {
    "temp": "{e}value",
    "feels_like": "CAST({e}event_id % 35 AS DOUBLE)",
    "pressure": "CAST(980 + {e}event_id % 60 AS DOUBLE)",
    "humidity": "CAST({e}event_id % 100 AS DOUBLE)",
    "dew_point": "CAST({e}event_id % 40 - 10 AS DOUBLE)",
    "uvi": "CAST({e}event_id % 110 AS DOUBLE) / CAST(10 AS DOUBLE)",
    "clouds": "CAST({e}event_id % 101 AS DOUBLE)",
    "visibility": "CAST(10000 - {e}event_id % 500 AS DOUBLE)",
    "wind_speed": "CAST({e}event_id % 250 AS DOUBLE) / CAST(10 AS DOUBLE)",
    "wind_deg": "CAST({e}event_id % 360 AS DOUBLE)",
}
GUST_FIELD = (
    "CASE WHEN {e}event_id % 3 <> 0 THEN CAST({e}event_id % 300 AS DOUBLE) / CAST(10 AS DOUBLE) END"
)
CONDITION_FIELDS = {
    "id": "200 + {e}event_id % 600",
    "main": "{e}event_type",
    "description": "concat({e}event_type, ' sky')",
    "icon": "CASE WHEN {e}event_id % 2 = 0 THEN '01d' END",
}


def _struct(fields: dict[str, str], **more: str) -> str:
    named = ", ".join(f"'{name}', {sql}" for name, sql in (fields | more).items())
    return f"named_struct({named})".format(e="e.")


def weather_documents(spark: SparkSession, sf_dir: str, changed: bool = False) -> DataFrame:
    """Events gathered into nested documents per location and day.

    ``changed`` raises every temperature by one, as a later correction would. Only the event
    columns are shuffled; the wide entries are built from them afterwards.
    """
    condition = _struct(CONDITION_FIELDS)
    second = "named_struct('id', 999L, 'main', 'second', 'description', 'second', 'icon', 'second')"
    weather = f"""CASE WHEN e.event_id % 5 = 0 THEN filter(array({condition}), c -> false)
                  WHEN e.event_id % 7 = 0 THEN array({condition}, {second})
                  ELSE array({condition}) END"""
    hour = _struct({"dt": "e.dt", **ENTRY_FIELDS}, wind_gust=GUST_FIELD, weather=weather)
    now = _struct(
        {"dt": "e.dt", "sunrise": "midnight + 21600", "sunset": "midnight + 64800", **ENTRY_FIELDS},
        weather=weather,
    )
    events = table(spark, sf_dir, "events").select(
        "user_id",
        F.to_date("ts").alias("day"),
        F.expr(f"event_id DIV {EVENTS_PER_DOCUMENT}").alias("part"),
        F.struct(
            "ts", "event_id", "event_type", (F.col("value") + int(changed)).alias("value"),
            F.unix_timestamp(F.col("ts").cast("timestamp")).alias("dt"),
        ).alias("event"),
    )
    midnight = F.unix_timestamp(F.col("day").cast("timestamp"))
    return (
        events.groupBy("user_id", "day", "part")
        .agg(F.collect_list("event").alias("events"))
        .select("user_id", "day", "events", midnight.alias("midnight"))
        .select(
            "day",
            _degrees(_latitude("user_id")).cast("double").alias("lat"),
            _degrees(_longitude("user_id")).cast("double").alias("lon"),
            F.concat(F.lit("Zone/"), F.col("user_id") % 4).alias("timezone"),
            (F.col("user_id") % 4 * 3600).alias("timezone_offset"),
            F.expr(f"transform(array(array_max(events)), e -> {now})[0]").alias("current"),
            F.expr(f"transform(events, e -> {hour})").alias("hourly"),
        )
    )


def landed(spark: SparkSession, documents: DataFrame, stamp: str | None = None) -> str:
    """Write documents to a new landing folder and give its path."""
    folder = work_folder(spark, "landing")
    land_documents(documents, folder, stamp)
    return folder


def new_database(spark: SparkSession) -> str:
    """An empty catalog database whose tables lie in the shared folder."""
    name = f"obsflow_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{work_folder(spark, 'database')}'")
    return name


def entry_sql(now: bool = False) -> str:
    """The flat columns of one entry of a document, for a select from ``events``."""
    columns = [
        f"CAST({_degrees_sql(_latitude('user_id'))} AS DOUBLE) AS latitude",
        f"CAST({_degrees_sql(_longitude('user_id'))} AS DOUBLE) AS longitude",
        "'Zone/' || (user_id % 4) AS timezone",
    ]
    moment = "strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S')"
    if now:
        columns += [
            f"{moment} AS requested_datetime",
            "strftime(date_trunc('day', ts) + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') AS sunrise",
            "strftime(date_trunc('day', ts) + INTERVAL 18 HOUR, '%Y-%m-%d %H:%M:%S') AS sunset",
        ]
    else:
        columns.append(f"{moment} AS datetime")
    columns += [f"{sql} AS {name}" for name, sql in ENTRY_FIELDS.items()]
    if not now:
        columns.append(f"{GUST_FIELD} AS wind_gust")
    columns += [
        f"CASE WHEN {{e}}event_id % 5 <> 0 THEN {sql} END AS weather_{name}"
        for name, sql in CONDITION_FIELDS.items()
    ]
    return ",\n           ".join(columns).format(e="")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates of events, a fifth of the users moved off every known location."""
    return observations(spark, sf_dir).select(
        as_coordinate(
            F.col("latitude") + F.when(F.col("user_id") % 5 == 0, F.lit(0.5)).otherwise(F.lit(0.0))
            .cast("decimal(9,6)")
        ).alias("latitude"),
        "longitude",
    )


POINTS_SQL = f"""{OBSERVATIONS_SQL}, points AS (
    SELECT DISTINCT
           CAST(latitude + CASE WHEN user_id % 5 = 0 THEN CAST(0.5 AS DECIMAL(9,6))
                                ELSE CAST(0 AS DECIMAL(9,6)) END AS DECIMAL(9,6)) AS latitude,
           longitude
    FROM observations
)"""
