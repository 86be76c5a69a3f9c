"""Loads with state, shapes from run to run, sorted files, local days, and addresses as they were."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.operators.drift import drift
from obsflow.operators.history import address_as_of, location_history
from obsflow.operators.merge import first_per_key
from obsflow.plans import marts
from obsflow.plans.local_days import local_daily_stats, split_zones
from obsflow.registry.inputs import JOINED_SQL, LOCATIONS_SQL, OBSERVATIONS_SQL, average_sql, locations, observations, table
from obsflow.registry.loads import HOUR_SCHEMA, hour_rows
from obsflow.schemas import HOURLY_KEY, MEASURE
from obsflow.session import work_folder
from obsflow.sinks.files import land_documents
from obsflow.sinks.sorted_export import read_sorted_csv, write_sorted_csv
from obsflow.sinks.tables import BaseTable
from obsflow.streaming.stateful import load_first_seen, read_loaded

# --- trailing runs -----------------------------------------------------------

# A run on a day brings the five days before it; runs are two days apart here.
RUN_DAYS = (6, 8, 10, 12)


def _runs(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Every run raises its values by its number; the last also brings places of the first three days that no run has brought before."""
    unique = first_per_key(hour_rows(spark, sf_dir), HOURLY_KEY, ["event_id"])
    day = F.dayofmonth("datetime")
    runs = []
    for number, on in enumerate(RUN_DAYS):
        rows = unique.filter(day.between(on - 5, on - 1))
        runs.append(rows.withColumn("temp", (F.col("temp") + number).cast("decimal(18,6)")))
    moved = unique.filter((day <= 3) & (F.col("event_id") % 10 == 0)).withColumn("latitude", (F.col("latitude") + 1).cast("decimal(9,6)"))
    return [*runs[:-1], runs[-1].unionByName(moved)]


def _stateful(spark: SparkSession, sf_dir: str):
    base = BaseTable(work_folder(spark, "store") + "/hours", HOUR_SCHEMA, HOURLY_KEY, HOURLY_KEY, partition="obs_date", partition_from="datetime")
    landing, checkpoint = work_folder(spark, "landing"), work_folder(spark, "offsets")
    reports = []
    for number, rows in enumerate(_runs(spark, sf_dir)):
        land_documents(rows, landing, str(number))
        # Each call is a query of its own that starts from the checkpoint.
        reports.append(load_first_seen(spark, landing, HOUR_SCHEMA, base, checkpoint))
    return base, reports


def stateful_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, _ = _stateful(spark, sf_dir)
    return read_loaded(spark, base).drop("obs_date")


def stateful_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, reports = _stateful(spark, sf_dir)
    rows = F.array(*[F.struct(F.lit(k).alias("run"), F.lit(r.read).alias("read"), F.lit(r.late).alias("late")) for k, r in enumerate(reports)])
    return spark.range(1).select(F.inline(rows))


# --- shapes ------------------------------------------------------------------


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three landed runs of one document per event: in the second ``feels_like`` has no fractions, in the third some are error payloads."""
    events = table(spark, sf_dir, "events")
    folder = work_folder(spark, "landing")
    feels = {"1": "event_id + 0.5", "2": "event_id", "3": "event_id"}
    for run, sql in feels.items():
        good = f"""concat('{{"lat":1.5,"lon":2.5,"hourly":[{{"dt":', event_id, ',"feels_like":', {sql}, '}}]}}')"""
        failed = """'{"cod":401,"message":"no"}'"""
        line = f"CASE WHEN event_type = 'error' THEN {failed} ELSE {good} END" if run == "3" else good
        events.select(F.expr(line).alias("value")).write.text(f"{folder}/run={run}")
    lines = spark.read.text(folder).select(F.regexp_extract("_metadata.file_path", "run=([0-9]+)", 1).alias("run"), F.col("value").alias("text"))
    return drift(lines)


# --- sorted files ------------------------------------------------------------

_MART_FILE = T.StructType(
    [
        *[T.StructField(name, T.StringType()) for name in ("country", "state", "city")],
        T.StructField("date", T.DateType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("max_temperature", MEASURE),
    ]
)


def sorted_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart as files, newest first; each row with its place in them."""
    mart = marts.daily_max(observations(spark, sf_dir), locations(spark, sf_dir)).select(*_MART_FILE.names)
    order = [F.col("date").desc_nulls_first(), F.col("country"), F.col("state"), F.col("city")]
    folder = work_folder(spark, "sorted")
    write_sorted_csv(mart, folder, order, parts=8)
    return read_sorted_csv(spark, folder, _MART_FILE)


# --- local days --------------------------------------------------------------

# Clocks change within the weeks that the moved events cover: on 10 March, 31 March, not at all, and back on 7 April.
ZONES = ("America/New_York", "Europe/Berlin", "Asia/Kolkata", "Pacific/Auckland")
DAYS_MOVED = 68


def _zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = F.when(F.col("event_id") % 97 == 0, "Nowhere/City").when(F.col("event_id") % 101 == 0, F.lit(None))
    for number, name in enumerate(ZONES):
        zone = zone.when(F.col("user_id") % len(ZONES) == number, name)
    moved = (F.col("datetime").cast("timestamp") + F.expr(f"INTERVAL {DAYS_MOVED} DAYS")).alias("datetime")
    return observations(spark, sf_dir).select("event_id", "latitude", "longitude", moved, "temp", zone.alias("timezone"))


def local_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return local_daily_stats(_zoned(spark, sf_dir), locations(spark, sf_dir))


def local_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few local days of a table that is stored by the day in UTC."""
    folder = work_folder(spark, "zoned")
    rows = _zoned(spark, sf_dir).withColumn("obs_date", F.to_date("datetime"))
    rows.hint("rebalance", F.col("obs_date")).write.partitionBy("obs_date").parquet(folder)
    return local_daily_stats(spark.read.parquet(folder), locations(spark, sf_dir), dt.date(2024, 3, 30), dt.date(2024, 4, 1))


def unknown_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, others = split_zones(_zoned(spark, sf_dir))
    return others.select("event_id", "timezone")


# --- addresses over time -----------------------------------------------------

LANDED = ("2023-12-31 00:00:00", "2024-01-10 12:00:00", "2024-01-20 00:00:00")


def _landings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three landings of the locations: some move on the second, some only appear with it, some lose their postcode on the third."""
    base = locations(spark, sf_dir).withColumn("_n", (F.col("latitude") * 1000000).cast("long") % 40)
    landings = []
    for number, moment in enumerate(LANDED):
        rows = base.withColumn("landed", F.to_timestamp(F.lit(moment)))
        if number == 0:
            rows = rows.filter("_n % 5 <> 1")
        if number >= 1:
            rows = rows.withColumn("city", F.when(F.col("_n") % 3 == 0, F.concat("city", F.lit(" moved"))).otherwise(F.col("city")))
        if number == 2:
            rows = rows.withColumn("postcode", F.when(F.col("_n") % 4 != 0, F.col("postcode")))
        landings.append(rows.drop("_n"))
    return landings[0].unionByName(landings[1]).unionByName(landings[2])


def location_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = location_history(_landings(spark, sf_dir))
    return spans.select(F.col("_lat_key").alias("lat_key"), F.col("_lon_key").alias("lon_key"), "city", "postcode", "valid_from", "valid_to")


def address_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = address_as_of(observations(spark, sf_dir), location_history(_landings(spark, sf_dir)))
    return found.select("event_id", "temp", "city", "state", "postcode", "country", "valid_from")


QUERIES = {
    "stateful_load": stateful_load,
    "stateful_load_report": stateful_report,
    "schema_drift": schema_drift,
    "sorted_export": sorted_export,
    "local_day_stats": local_days,
    "local_day_span": local_span,
    "unknown_zones": unknown_zones,
    "location_history": location_spans,
    "address_as_of": address_by_date,
}

_UNIQUE_SQL = f"""{OBSERVATIONS_SQL}, uniq AS (
    SELECT latitude, longitude, date_trunc('hour', datetime) AS datetime, event_id, temp FROM observations
    QUALIFY row_number() OVER (PARTITION BY latitude, longitude, date_trunc('hour', datetime) ORDER BY event_id) = 1
), runs AS (
    SELECT u.*, r.run, r.day FROM uniq u, (VALUES {", ".join(f"({k}, {day})" for k, day in enumerate(RUN_DAYS))}) AS r(run, day)
    WHERE extract(day FROM u.datetime) BETWEEN r.day - 5 AND r.day - 1
)"""

# The hour that a zone's clock is ahead of UTC at a moment, the clock changes being fixed moments.
_OFFSETS_SQL = """CASE timezone
    WHEN 'America/New_York' THEN CASE WHEN datetime >= TIMESTAMP '2024-03-10 07:00:00' THEN -240 ELSE -300 END
    WHEN 'Europe/Berlin' THEN CASE WHEN datetime >= TIMESTAMP '2024-03-31 01:00:00' THEN 120 ELSE 60 END
    WHEN 'Asia/Kolkata' THEN 330
    WHEN 'Pacific/Auckland' THEN CASE WHEN datetime >= TIMESTAMP '2024-04-06 14:00:00' THEN 720 ELSE 780 END END"""

_ZONED_SQL = f"""{JOINED_SQL.replace("joined AS", "plain AS")}, zoned AS (
    SELECT o.event_id, o.user_id, o.latitude, o.longitude, o.temp, o.datetime + INTERVAL {DAYS_MOVED} DAY AS datetime,
           CASE WHEN event_id % 97 = 0 THEN 'Nowhere/City' WHEN event_id % 101 = 0 THEN NULL
                {" ".join(f"WHEN user_id % {len(ZONES)} = {k} THEN '{z}'" for k, z in enumerate(ZONES))} END AS timezone
    FROM observations o
), local AS (
    SELECT z.*, CAST(z.datetime + to_minutes({_OFFSETS_SQL}) AS DATE) AS day
    FROM zoned z WHERE timezone IN {ZONES}
), stats AS (
    SELECT l.country, l.state, l.city, timezone, strftime(day, '%Y-%m-%d') AS date, CAST(max(temp) AS DOUBLE) AS max_temperature,
           CAST(min(temp) AS DOUBLE) AS min_temperature, {average_sql('temp')} AS average_temperature, count(temp) AS observations,
           CAST(CASE WHEN (timezone = 'America/New_York' AND day = DATE '2024-03-10') OR (timezone = 'Europe/Berlin' AND day = DATE '2024-03-31') THEN 23
                     WHEN timezone = 'Pacific/Auckland' AND day = DATE '2024-04-07' THEN 25 ELSE 24 END AS DOUBLE) AS day_hours
    FROM local o, locations l
    WHERE round(l.latitude, 4) = round(o.latitude, 4) AND round(l.longitude, 4) = round(o.longitude, 4)
    GROUP BY l.country, l.state, l.city, timezone, day
)"""

_LANDED_SQL = f"""{LOCATIONS_SQL}, numbered AS (
    SELECT *, CAST(latitude * 1000000 AS BIGINT) % 40 AS n FROM locations
), landings AS (
    SELECT round(latitude, 4) AS lat_key, round(longitude, 4) AS lon_key, r.run, CAST(r.landed AS TIMESTAMP) AS landed,
           CASE WHEN r.run >= 1 AND n % 3 = 0 THEN city || ' moved' ELSE city END AS city, state,
           CASE WHEN r.run = 2 AND n % 4 = 0 THEN NULL ELSE postcode END AS postcode, country
    FROM numbered, (VALUES {", ".join(f"({k}, '{m}')" for k, m in enumerate(LANDED))}) AS r(run, landed)
    WHERE r.run > 0 OR n % 5 <> 1
), starts AS (
    SELECT *, lag(city) OVER w AS was_city, lag(postcode) OVER w AS was_postcode, lag(run) OVER w AS was
    FROM landings WINDOW w AS (PARTITION BY lat_key, lon_key ORDER BY landed)
), spans AS (
    SELECT *, lead(landed) OVER (PARTITION BY lat_key, lon_key ORDER BY landed) AS valid_to FROM starts
    WHERE was IS NULL OR city IS DISTINCT FROM was_city OR postcode IS DISTINCT FROM was_postcode
)"""

ORACLES = {
    "stateful_load": f"""
WITH {_UNIQUE_SQL}
SELECT CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
       strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, event_id, CAST(temp + run AS DOUBLE) AS temp
FROM runs QUALIFY row_number() OVER (PARTITION BY latitude, longitude, datetime ORDER BY run) = 1""",
    "stateful_load_report": f"""
WITH {_UNIQUE_SQL}, late AS (
    SELECT count(*) AS n FROM uniq WHERE extract(day FROM datetime) <= 3 AND event_id % 10 = 0
)
SELECT CAST(run AS BIGINT) AS run, CAST(count(*) + CASE WHEN run = 3 THEN (SELECT n FROM late) ELSE 0 END AS BIGINT) AS read,
       CAST(CASE WHEN run = 3 THEN (SELECT n FROM late) ELSE 0 END AS BIGINT) AS late
FROM runs GROUP BY run""",
    "schema_drift": """
SELECT '2' AS run, '$.hourly[].feels_like' AS path, 'changed' AS change, 'number' AS before, 'whole number' AS after
WHERE (SELECT count(*) FROM events) > 0
UNION ALL
SELECT '3', path, 'added', NULL, kind FROM (VALUES ('$.cod', 'whole number'), ('$.message', 'text')) AS error(path, kind)
WHERE (SELECT count(*) FROM events WHERE event_type = 'error') > 0""",
    "sorted_export": f"""
WITH {JOINED_SQL}, mart AS (
    SELECT country, state, city, strftime(datetime, '%Y-%m-%d') AS date, CAST(extract(month FROM datetime) AS BIGINT) AS month,
           CAST(max(temp) AS DOUBLE) AS max_temperature
    FROM joined GROUP BY ALL
)
SELECT *, row_number() OVER (ORDER BY date DESC NULLS FIRST, country, state, city) AS place FROM mart""",
    "local_day_stats": f"WITH {_ZONED_SQL} SELECT * FROM stats",
    "local_day_span": f"WITH {_ZONED_SQL} SELECT * FROM stats WHERE date BETWEEN '2024-03-30' AND '2024-04-01'",
    "unknown_zones": f"WITH {_ZONED_SQL} SELECT event_id, timezone FROM zoned WHERE timezone IS NULL OR timezone = 'Nowhere/City'",
    "location_history": f"""
WITH {_LANDED_SQL}
SELECT CAST(lat_key AS DOUBLE) AS lat_key, CAST(lon_key AS DOUBLE) AS lon_key, city, postcode,
       strftime(landed, '%Y-%m-%d %H:%M:%S') AS valid_from, strftime(valid_to, '%Y-%m-%d %H:%M:%S') AS valid_to
FROM spans""",
    "address_as_of": f"""
WITH {_LANDED_SQL}, {OBSERVATIONS_SQL}, keyed AS (
    SELECT *, round(latitude, 4) AS lat_key, round(longitude, 4) AS lon_key FROM observations
)
SELECT o.event_id, CAST(o.temp AS DOUBLE) AS temp, s.city, s.state, s.postcode, s.country,
       strftime(s.landed, '%Y-%m-%d %H:%M:%S') AS valid_from
FROM keyed o ASOF LEFT JOIN spans s
  ON o.lat_key = s.lat_key AND o.lon_key = s.lon_key AND o.datetime >= s.landed""",
}
