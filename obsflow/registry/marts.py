"""Marts over observations and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.fixed_values import DEFAULT_LOCATIONS
from obsflow.operators.enrich import lookup_location
from obsflow.operators.nearest import nearest_location, write_place_index
from obsflow.operators.rounded_join import join_on_rounded
from obsflow.plans import marts
from obsflow.plans.weather import WeatherStore, load_locations
from obsflow.registry.inputs import (
    JOINED_SQL,
    LOCATIONS_SQL,
    POINTS_SQL,
    average_sql,
    locations,
    observations,
    points,
    table,
)
from obsflow.session import work_folder
from obsflow.sinks.files import head, preview, write_headerless_csv
from obsflow.sinks.tables import publish_view
from obsflow.sources.tables import read_query


def daily_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.newest_first(
        marts.daily_stats(observations(spark, sf_dir), locations(spark, sf_dir))
    )


def daily_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.newest_first(
        marts.daily_max(observations(spark, sf_dir), locations(spark, sf_dir))
    )


def daily_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.daily_extremes(observations(spark, sf_dir), locations(spark, sf_dir))


def monthly_peak_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = marts.daily_max(observations(spark, sf_dir), locations(spark, sf_dir))
    return marts.monthly_peak(daily, ["country", "state", "city"])


def monthly_peak_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many months: the largest order per nation stands for the highest temperature.

    Orders are reduced per customer and day before they meet the customers.
    """
    days = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.to_date("o_orderdate").alias("date"))
        .agg(F.max("o_totalprice").alias("max_temperature"))
    )
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    placed = (
        days.join(customer, days.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select(F.col("n_name").alias("nation"), "date", "max_temperature")
    )
    return marts.monthly_peak(placed, ["nation"])


def rounded_join_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = join_on_rounded(observations(spark, sf_dir), locations(spark, sf_dir))
    moment = F.date_format("datetime", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("datetime")
    return joined.select("event_id", moment, "temp", "city", "state", "postcode", "country")


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_location(points(spark, sf_dir), locations(spark, sf_dir))


def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_place_index(locations(spark, sf_dir), work_folder(spark, "places"))
    return nearest_location(points(spark, sf_dir), index)


def view_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published mart read by name, its first rows in a total order."""
    publish_view(
        marts.daily_max(observations(spark, sf_dir), locations(spark, sf_dir)), "obsflow_daily_max"
    )
    return read_query(
        spark,
        "SELECT * FROM obsflow_daily_max"
        " ORDER BY max_temperature DESC, date DESC, country, state, city LIMIT 15",
    )


def location_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requested places, some twice, some blank, some no coordinates at all, with their addresses in a store."""
    asked = points(spark, sf_dir).distinct().select(
        F.when(F.col("latitude") > 50, "north").otherwise(F.col("latitude").cast("string")).alias("latitude"), F.col("longitude").cast("string").alias("longitude")
    )
    blank = spark.range(2).select(F.lit(" ").alias("latitude"), F.lit(None).cast("string").alias("longitude"))
    store = WeatherStore(work_folder(spark, "store"))
    for _ in range(2):
        load_locations(spark, asked.unionByName(asked).unionByName(blank), locations(spark, sf_dir), store)
    return store.location.read(spark)


def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows of a mart in a total order, printed with the schema, and handed on."""
    mart = marts.daily_max(observations(spark, sf_dir), locations(spark, sf_dir))
    ordered = mart.orderBy(F.col("date").desc(), "country", "state", "city")
    preview(ordered)
    return head(ordered)


def single_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart as one file, and the rows that it holds."""
    folder = work_folder(spark, "single")
    mart = marts.daily_max(observations(spark, sf_dir), locations(spark, sf_dir))
    write_headerless_csv(mart, folder, single_file=True)
    lines = spark.read.text(folder).select("value", F.col("_metadata.file_name").alias("file"))
    return lines.agg(F.count_distinct("file").alias("files"), F.count("*").alias("rows"))


QUERIES = {
    "rounded_join_daily_stats": daily_stats,
    "rounded_join_daily_max": daily_max,
    "daily_extremes": daily_extremes,
    "monthly_peak_weather": monthly_peak_weather,
    "monthly_peak_orders": monthly_peak_orders,
    "rounded_join_rows": rounded_join_rows,
    "lookup_location": lookup,
    "nearest_location": nearest,
    "view_head": view_head,
    "location_step": location_step,
    "preview_rows": preview_rows,
    "single_file": single_file,
}

_DAY = "strftime(datetime, '%Y-%m-%d')"

ORACLES = {
    "rounded_join_daily_stats": f"""
WITH {JOINED_SQL}
SELECT country, state, city, {_DAY} AS date,
       CAST(max(temp) AS DOUBLE) AS max_temperature,
       CAST(min(temp) AS DOUBLE) AS min_temperature,
       {average_sql('temp')} AS average_temperature
FROM joined GROUP BY ALL""",
    "rounded_join_daily_max": f"""
WITH {JOINED_SQL}
SELECT country, state, city, {_DAY} AS date,
       CAST(extract(month FROM datetime) AS BIGINT) AS month,
       CAST(max(temp) AS DOUBLE) AS max_temperature
FROM joined GROUP BY ALL""",
    "daily_extremes": f"""
WITH {JOINED_SQL}, ranked AS (
    SELECT {_DAY} AS date, temp, city,
           row_number() OVER (PARTITION BY {_DAY} ORDER BY temp, city) AS cold,
           row_number() OVER (PARTITION BY {_DAY} ORDER BY temp DESC, city) AS hot
    FROM joined
)
SELECT date,
       {average_sql('temp')} AS average_temperature,
       CAST(min(temp) AS DOUBLE) AS min_temperature,
       max(CASE WHEN cold = 1 THEN city END) AS min_location,
       max(CASE WHEN hot = 1 THEN city END) AS max_location
FROM ranked GROUP BY date""",
    "monthly_peak_weather": f"""
WITH {JOINED_SQL}, ranked AS (
    SELECT country, state, city, datetime, temp,
           rank() OVER (PARTITION BY country, state, city,
                        extract(year FROM datetime), extract(month FROM datetime)
                        ORDER BY temp DESC) AS place
    FROM joined
)
SELECT DISTINCT country, state, city,
       CAST(extract(year FROM datetime) AS BIGINT) AS year,
       CAST(extract(month FROM datetime) AS BIGINT) AS month,
       {_DAY} AS date, CAST(temp AS DOUBLE) AS max_temperature
FROM ranked WHERE place = 1""",
    "monthly_peak_orders": """
WITH ranked AS (
    SELECT n_name AS nation, o_orderdate, o_totalprice,
           rank() OVER (PARTITION BY n_name,
                        extract(year FROM o_orderdate), extract(month FROM o_orderdate)
                        ORDER BY o_totalprice DESC) AS place
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)
SELECT DISTINCT nation,
       CAST(extract(year FROM o_orderdate) AS BIGINT) AS year,
       CAST(extract(month FROM o_orderdate) AS BIGINT) AS month,
       strftime(o_orderdate, '%Y-%m-%d') AS date, o_totalprice AS max_temperature
FROM ranked WHERE place = 1""",
    "rounded_join_rows": f"""
WITH {JOINED_SQL}
SELECT event_id, strftime(datetime, '%Y-%m-%d %H:%M:%S.%f') AS datetime,
       CAST(temp AS DOUBLE) AS temp, city, state, postcode, country
FROM joined""",
    "lookup_location": f"""
WITH {LOCATIONS_SQL}, {POINTS_SQL}
SELECT CAST(p.latitude AS DOUBLE) AS latitude, CAST(p.longitude AS DOUBLE) AS longitude,
       l.city, l.state, l.postcode, l.country
FROM points p LEFT JOIN locations l
  ON round(l.latitude, 4) = round(p.latitude, 4) AND round(l.longitude, 4) = round(p.longitude, 4)""",
    "nearest_location": f"""
WITH {LOCATIONS_SQL}, {POINTS_SQL}, places AS (
    SELECT city, state, postcode, country, radians(CAST(round(latitude, 4) AS DOUBLE)) AS lat,
           radians(CAST(round(longitude, 4) AS DOUBLE)) AS lon
    FROM locations
), sphere AS (
    SELECT *, cos(lat) * cos(lon) AS x, cos(lat) * sin(lon) AS y, sin(lat) AS z FROM places
), asked AS (
    SELECT latitude, longitude, radians(CAST(latitude AS DOUBLE)) AS lat,
           radians(CAST(longitude AS DOUBLE)) AS lon
    FROM points
), near AS (
    SELECT a.latitude, a.longitude,
           arg_min({{'city': city, 'state': state, 'postcode': postcode, 'country': country}},
                   pow(x - cos(lat_a) * cos(lon_a), 2) + pow(y - cos(lat_a) * sin(lon_a), 2)
                   + pow(z - sin(lat_a), 2)) AS place
    FROM (SELECT latitude, longitude, lat AS lat_a, lon AS lon_a FROM asked) a, sphere
    GROUP BY ALL
)
SELECT CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude,
       place.city AS city, place.state AS state, place.postcode AS postcode,
       place.country AS country
FROM near""",
    "location_step": f"""
WITH {LOCATIONS_SQL}, {POINTS_SQL}, asked AS (
    SELECT latitude, longitude FROM points WHERE latitude <= 50
    UNION
    SELECT * FROM (VALUES {", ".join(f"(CAST('{lat}' AS DECIMAL(9,6)), CAST('{lon}' AS DECIMAL(9,6)))" for lat, lon in DEFAULT_LOCATIONS)})
)
SELECT CAST(p.latitude AS DOUBLE) AS latitude, CAST(p.longitude AS DOUBLE) AS longitude, l.city, l.state, l.postcode, l.country
FROM asked p LEFT JOIN locations l
  ON round(l.latitude, 4) = round(p.latitude, 4) AND round(l.longitude, 4) = round(p.longitude, 4)""",
    "preview_rows": f"""
WITH {JOINED_SQL}
SELECT country, state, city, {_DAY} AS date, CAST(extract(month FROM datetime) AS BIGINT) AS month,
       CAST(max(temp) AS DOUBLE) AS max_temperature
FROM joined GROUP BY ALL ORDER BY date DESC, country, state, city LIMIT 15""",
    "single_file": f"""
WITH {JOINED_SQL}
SELECT 1 AS files, count(DISTINCT (country, state, city, {_DAY})) AS rows FROM joined""",
    "view_head": f"""
WITH {JOINED_SQL}
SELECT country, state, city, {_DAY} AS date,
       CAST(extract(month FROM datetime) AS BIGINT) AS month,
       CAST(max(temp) AS DOUBLE) AS max_temperature
FROM joined GROUP BY ALL
ORDER BY max_temperature DESC, date DESC, country, state, city LIMIT 15""",
}
