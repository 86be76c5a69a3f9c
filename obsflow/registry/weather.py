"""Weather documents through landing, scan, screening and flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.fixed_values import DAILY_MAX_VIEW, DAILY_STATS_VIEW
from obsflow.operators.flatten import flatten_current, flatten_hourly, flatten_struct
from obsflow.operators.screening import accepted_responses, split_documents
from obsflow.plans.weather import (
    WeatherStore,
    export_flat_csv,
    load_flat_csv,
    refresh_weather,
    stage,
)
from obsflow.registry.inputs import (
    EVENTS_PER_DOCUMENT,
    LOCATIONS_SQL,
    average_sql,
    entry_sql,
    landed,
    locations,
    new_database,
    table,
    weather_documents,
)
from obsflow.session import work_folder
from obsflow.sinks.files import land_documents
from obsflow.sources.documents import read_weather_documents, with_lineage
from obsflow.sources.tables import read_query


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = weather_documents(spark, sf_dir).drop("day")
    return read_weather_documents(spark, landed(spark, written))


def hourly_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_hourly(_documents(spark, sf_dir))


def current_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_current(_documents(spark, sf_dir))


def _handed_over(spark: SparkSession, sf_dir: str) -> WeatherStore:
    """Documents exported as CSV, loaded from there, twice, into the base tables."""
    folder = work_folder(spark, "processed")
    store = WeatherStore(work_folder(spark, "store"))
    export_flat_csv(spark, landed(spark, weather_documents(spark, sf_dir).drop("day")), folder)
    for _ in range(2):
        load_flat_csv(spark, folder, store, on_duplicate="first")
    return store


def csv_hand_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _handed_over(spark, sf_dir).current.read(spark).drop("obs_date")


def csv_hand_over_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _handed_over(spark, sf_dir).hourly.read(spark).drop("obs_date")


def landing_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries per landed run, the run being read off the path of each file."""
    documents = weather_documents(spark, sf_dir).drop("day")
    folder = landed(spark, documents, "20240131000000")
    land_documents(
        weather_documents(spark, sf_dir, changed=True).drop("day"), folder, "20240201000000"
    )
    read = with_lineage(read_weather_documents(spark, folder).select("lat", "hourly", "_metadata"))
    return (
        read.groupBy(F.regexp_extract("source_file", "run=([0-9]+)", 1).alias("landed"))
        .agg(
            F.count("*").alias("documents"),
            F.sum(F.size("hourly")).alias("entries"),
            F.count_if(F.col("source_modified").isNull()).alias("undated"),
        )
    )


def reject_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One landed line per event: good, an error payload, an empty document or broken text."""
    events = table(spark, sf_dir, "events")
    place = 'concat(\'{"lat": 1.5, "lon": 2.5, "timezone": "UTC"\''
    line = F.expr(
        f"""CASE event_type
            WHEN 'error' THEN concat('{{"cod": 401, "message": "event ', event_id, '"}}')
            WHEN 'click' THEN concat('{{"lat": 1.5, "lon": ', event_id)
            WHEN 'signup' THEN {place}, '}}')
            ELSE {place}, ', "hourly": [{{"dt": ', event_id, ', "temp": ', value, '}}]}}') END"""
    )
    folder = work_folder(spark, "landing")
    events.select(line.alias("value")).write.text(folder)
    documents = stage(
        spark, read_weather_documents(spark, folder), work_folder(spark, "documents")
    )
    good, rejected = split_documents(documents)
    kept = flatten_hourly(good).select(
        F.lit("good").alias("reason"), F.unix_timestamp("datetime").alias("event"), "temp"
    )
    dropped = rejected.select(
        "reason", F.col("lon").try_cast("bigint").alias("event"),
        F.lit(None).cast("decimal(18,6)").alias("temp"),
    )
    return (
        kept.unionByName(dropped)
        .groupBy("reason")
        .agg(F.count("*").alias("documents"), F.sum("event").alias("events"),
             F.sum("temp").alias("temp"))
    )


def accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = "CASE event_type WHEN 'error' THEN 500 WHEN 'click' THEN 204 WHEN 'view' THEN NULL ELSE 200 END"
    responses = table(spark, sf_dir, "events").select("event_id", F.expr(status).alias("status"))
    return accepted_responses(responses)


def flat_struct(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "events").select(
        F.struct(
            F.col("event_id").alias("id"),
            F.struct(F.col("event_type").alias("type"), F.col("value")).alias("body"),
        ).alias("event"),
        F.from_json("props", "k bigint").alias("props"),
        "user_id",
    )
    return flatten_struct(nested)


def refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run, from landed documents to the daily view."""
    store = WeatherStore(work_folder(spark, "store"))
    landing = landed(spark, weather_documents(spark, sf_dir).drop("day"), "20240131000000")
    refresh_weather(
        spark, landing, store, locations(spark, sf_dir), "20240131", on_duplicate="first"
    )
    return read_query(spark, f"SELECT * FROM {DAILY_STATS_VIEW}")


def catalog_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same run into a database, read through its stored view."""
    database = new_database(spark)
    store = WeatherStore(database, rejects=work_folder(spark, "rejected"))
    landing = landed(spark, weather_documents(spark, sf_dir).drop("day"), "20240131000000")
    refresh_weather(
        spark, landing, store, locations(spark, sf_dir), "20240131", on_duplicate="first"
    )
    return read_query(spark, f"SELECT * FROM {database}.{DAILY_MAX_VIEW}")


QUERIES = {
    "hourly_flat": hourly_flat,
    "current_flat": current_flat,
    "csv_hand_over": csv_hand_over,
    "csv_hand_over_hourly": csv_hand_over_hourly,
    "landing_lineage": landing_lineage,
    "reject_split": reject_split,
    "accepted_responses": accepted,
    "flatten_struct": flat_struct,
    "weather_refresh": refresh,
    "catalog_refresh": catalog_refresh,
}

_PLACED_HOURS_SQL = f"""{LOCATIONS_SQL}, hours AS (
    SELECT *, row_number() OVER (
        PARTITION BY latitude, longitude, datetime ORDER BY timezone, temp, feels_like, pressure,
        humidity, dew_point, uvi, clouds, visibility, wind_speed, wind_deg, wind_gust) AS place
    FROM (SELECT {entry_sql()} FROM events)
), joined AS (
    SELECT l.*, h.temp, substr(h.datetime, 1, 10) AS date
    FROM locations l, hours h
    WHERE h.place = 1
      AND round(l.latitude, 4) = round(CAST(h.latitude AS DECIMAL(9,6)), 4)
      AND round(l.longitude, 4) = round(CAST(h.longitude AS DECIMAL(9,6)), 4)
)"""

ORACLES = {
    "hourly_flat": f"""
SELECT {entry_sql()}
FROM events""",
    "current_flat": f"""
SELECT {entry_sql(now=True)}
FROM (SELECT *, row_number() OVER (
          PARTITION BY user_id, date_trunc('day', ts), event_id // {EVENTS_PER_DOCUMENT}
          ORDER BY ts DESC, event_id DESC) AS place
      FROM events)
WHERE place = 1""",
    "csv_hand_over": f"""
WITH latest AS (
    SELECT * FROM events QUALIFY row_number() OVER (
        PARTITION BY user_id, date_trunc('day', ts), event_id // {EVENTS_PER_DOCUMENT}
        ORDER BY ts DESC, event_id DESC) = 1
), flat AS (
    SELECT {entry_sql(now=True)}
    FROM latest
)
SELECT * FROM flat QUALIFY row_number() OVER (
    PARTITION BY latitude, longitude, requested_datetime
    ORDER BY timezone, sunrise, sunset, temp, feels_like, pressure, humidity) = 1""",
    "csv_hand_over_hourly": f"""
SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (
        PARTITION BY latitude, longitude, datetime ORDER BY timezone, temp, feels_like, pressure,
        humidity, dew_point, uvi, clouds, visibility, wind_speed, wind_deg, wind_gust) AS place
    FROM (SELECT {entry_sql()} FROM events))
WHERE place = 1""",
    "landing_lineage": f"""
SELECT landed, count(DISTINCT (user_id, date_trunc('day', ts), event_id // {EVENTS_PER_DOCUMENT}))
           AS documents,
       count(*) AS entries, 0 AS undated
FROM events, (VALUES ('20240131000000'), ('20240201000000')) AS runs(landed)
GROUP BY landed""",
    "reject_split": """
SELECT CASE event_type WHEN 'error' THEN 'incomplete' WHEN 'click' THEN 'corrupt'
                       WHEN 'signup' THEN 'empty' ELSE 'good' END AS reason,
       count(*) AS documents,
       CAST(sum(CASE event_type WHEN 'signup' THEN 2 WHEN 'error' THEN NULL
                WHEN 'click' THEN NULL ELSE event_id END) AS BIGINT) AS events,
       CAST(sum(CASE WHEN event_type NOT IN ('error', 'click', 'signup')
                     THEN CAST(value AS DECIMAL(18,6)) END) AS DOUBLE) AS temp
FROM events GROUP BY 1""",
    "accepted_responses": """
SELECT event_id, CAST(CASE event_type WHEN 'click' THEN 204 ELSE 200 END AS BIGINT) AS status
FROM events WHERE event_type NOT IN ('error', 'view')""",
    "flatten_struct": """
SELECT event_id AS "event.id", event_type AS "event.body.type", value AS "event.body.value",
       CAST(json_extract(props, '$.k') AS BIGINT) AS "props.k", user_id
FROM events""",
    "weather_refresh": f"""
WITH {_PLACED_HOURS_SQL}
SELECT country, state, city, date, max(temp) AS max_temperature, min(temp) AS min_temperature,
       {average_sql('temp')} AS average_temperature
FROM joined GROUP BY ALL""",
    "catalog_refresh": f"""
WITH {_PLACED_HOURS_SQL}
SELECT country, state, city, date, CAST(substr(date, 6, 2) AS BIGINT) AS month,
       max(temp) AS max_temperature
FROM joined GROUP BY ALL""",
}
