"""Loads that keep checks, key bitmaps and marts up to date as they write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.operators.key_bitmaps import KeyBitmaps
from obsflow.operators.observed import merge_observed
from obsflow.plans.day_summaries import DaySummaries, kept_marts
from obsflow.registry.inputs import LOCATIONS_SQL, OBSERVATIONS_SQL, average_sql, locations, observations
from obsflow.registry.loads import HOUR_SCHEMA, MERGED_SQL, hour_batches, hour_table
from obsflow.schemas import HOURLY_KEY
from obsflow.session import work_folder
from obsflow.sinks.tables import BaseTable

# Three batches: the two that overlap, and the first once more with every value raised, which adds nothing.
_BY_EVENT = ["event_id"]


def _loaded(spark: SparkSession, sf_dir: str) -> tuple[BaseTable, DaySummaries]:
    base = hour_table(spark)
    bitmaps = KeyBitmaps(base, work_folder(spark, "keys"))
    summaries = DaySummaries(base, work_folder(spark, "days"))
    first, second = hour_batches(spark, sf_dir)
    for batch in (first, second, first.withColumn("temp", (F.col("temp") + 2).cast("decimal(18,6)"))):
        seen = merge_observed(batch, base, work_folder(spark, "merge"), "first", _BY_EVENT, bitmaps=bitmaps)
        summaries.update(seen.added)
    return base, summaries


def merged_by_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, _ = _loaded(spark, sf_dir)
    return base.read(spark).drop("obs_date")


def _kept(name: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _, summaries = _loaded(spark, sf_dir)
        return kept_marts(spark, summaries, locations(spark, sf_dir))[name]

    return run


_CHECKED = T.StructType([*HOUR_SCHEMA.fields, T.StructField("timezone", T.StringType())])


def observed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one write saw: its rows, how many broke which rule, values lost in a cast included, and how many were added."""
    rows = observations(spark, sf_dir).select(
        F.when(F.col("event_id") % 41 != 0, F.col("latitude")).alias("latitude"),
        "longitude",
        F.col("datetime").cast("timestamp").alias("datetime"),
        "event_id",
        F.when(F.col("event_id") % 50 == 0, F.lit(1e15)).otherwise(F.col("temp").cast("double")).alias("raw"),
        F.when(F.col("event_id") % 90 == 1, F.repeat(F.lit("x"), F.lit(300))).when(F.col("event_id") % 70 != 0, "UTC").alias("timezone"),
    )
    rows = rows.withColumn("temp", F.col("raw").try_cast("decimal(18,6)"))
    table = BaseTable(work_folder(spark, "store") + "/checked", _CHECKED, HOURLY_KEY, [*HOURLY_KEY, "timezone"], partition="obs_date", partition_from="datetime")
    seen = merge_observed(
        rows, table, work_folder(spark, "merge"), "first", _BY_EVENT, quarantine=work_folder(spark, "aside"),
        flags={"temp does not fit": F.col("raw").isNotNull() & F.col("temp").isNull()},
    )
    counts = {"rows": seen.rows, "added": seen.appended, **seen.broken}
    pairs = F.array(*[F.struct(F.lit(name).alias("check"), F.lit(n).cast("long").alias("n")) for name, n in counts.items()])
    return spark.range(1).select(F.inline(pairs))


QUERIES = {
    "merge_two_batches_bitmaps": merged_by_bitmaps,
    "kept_daily_stats": _kept("daily_stats"),
    "kept_daily_extremes": _kept("daily_extremes"),
    "kept_monthly_peak": _kept("monthly_peak"),
    "observed_checks": observed_checks,
}

_KEPT_SQL = f"""{LOCATIONS_SQL}, merged AS ({MERGED_SQL}), joined AS (
    SELECT CAST(m.datetime AS TIMESTAMP) AS datetime, CAST(m.temp AS DECIMAL(18,6)) AS temp, l.city, l.state, l.country
    FROM merged m, locations l
    WHERE round(l.latitude, 4) = round(CAST(m.latitude AS DECIMAL(9,6)), 4)
      AND round(l.longitude, 4) = round(CAST(m.longitude AS DECIMAL(9,6)), 4)
)"""


_DAY = "strftime(datetime, '%Y-%m-%d')"

ORACLES = {
    "merge_two_batches_bitmaps": MERGED_SQL,
    "kept_daily_stats": f"""
WITH {_KEPT_SQL}
SELECT country, state, city, {_DAY} AS date, CAST(max(temp) AS DOUBLE) AS max_temperature,
       CAST(min(temp) AS DOUBLE) AS min_temperature, {average_sql('temp')} AS average_temperature
FROM joined GROUP BY ALL""",
    "kept_daily_extremes": f"""
WITH {_KEPT_SQL}, ranked AS (
    SELECT {_DAY} AS date, temp, city,
           row_number() OVER (PARTITION BY {_DAY} ORDER BY temp, city) AS cold,
           row_number() OVER (PARTITION BY {_DAY} ORDER BY temp DESC, city) AS hot
    FROM joined
)
SELECT date, {average_sql('temp')} AS average_temperature, CAST(min(temp) AS DOUBLE) AS min_temperature,
       max(CASE WHEN cold = 1 THEN city END) AS min_location, max(CASE WHEN hot = 1 THEN city END) AS max_location
FROM ranked GROUP BY date""",
    "kept_monthly_peak": f"""
WITH {_KEPT_SQL}, ranked AS (
    SELECT country, state, city, datetime, temp,
           rank() OVER (PARTITION BY country, state, city, extract(year FROM datetime), extract(month FROM datetime)
                        ORDER BY temp DESC) AS place
    FROM joined
)
SELECT DISTINCT country, state, city, CAST(extract(year FROM datetime) AS BIGINT) AS year,
       CAST(extract(month FROM datetime) AS BIGINT) AS month, {_DAY} AS date, CAST(temp AS DOUBLE) AS max_temperature
FROM ranked WHERE place = 1""",
    "observed_checks": f"""
WITH {OBSERVATIONS_SQL}, judged AS (
    SELECT latitude, longitude, datetime, event_id % 41 = 0 AS placeless, event_id % 50 = 0 AS lost,
           event_id % 90 = 1 AS long, event_id % 90 <> 1 AND event_id % 70 = 0 AS zoneless
    FROM observations
)
SELECT 'rows' AS "check", count(*) AS n FROM judged
UNION ALL SELECT 'added', count(DISTINCT (latitude, longitude, datetime)) FROM judged WHERE NOT (placeless OR lost OR long OR zoneless)
UNION ALL SELECT 'latitude is null', count(*) FROM judged WHERE placeless
UNION ALL SELECT 'timezone is null', count(*) FROM judged WHERE zoneless
UNION ALL SELECT 'timezone is too long', count(*) FROM judged WHERE long
UNION ALL SELECT 'temp does not fit', count(*) FROM judged WHERE lost""",
}
