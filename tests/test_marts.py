from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from obsflow.operators.enrich import lookup_location
from obsflow.operators.quality import duplicate_keys
from obsflow.operators.rounded_join import ROUNDED_KEY, join_on_rounded, with_rounded_key
from obsflow.operators.skew import hot_keys, salted_join
from obsflow.plans import marts
from obsflow.schemas import LOCATION

D = Decimal


@pytest.fixture()
def locations(spark):
    return spark.createDataFrame(
        [
            (D("30.318878"), D("-81.690173"), "Jacksonville", "Florida", "32204", "US"),
            (D("30.400000"), D("-81.700000"), "Jacksonville", "Florida", "32205", "US"),
            (D("40.712776"), D("-74.005974"), None, None, None, "US"),
            (D("47.950356"), D("-124.385490"), "Forks", "Washington", None, "US"),
        ],
        LOCATION,
    )


def hourly(spark, *data):
    return spark.createDataFrame(
        [(D(lat), D(lon), dt.datetime.fromisoformat(t), None if v is None else D(v))
         for lat, lon, t, v in data],
        "latitude decimal(9,6), longitude decimal(9,6), datetime timestamp, temp decimal(18,6)",
    )


JAX, JAX2, NYC = ("30.3189", "-81.6902"), ("30.4", "-81.7"), ("40.7128", "-74.006")


@pytest.fixture()
def observed(spark):
    return hourly(
        spark,
        (*JAX, "2024-01-31T23:00:00", "10.005"), (*JAX, "2024-01-31T00:00:00", "10"),
        (*JAX2, "2024-01-31T12:00:00", "12.5"), (*JAX2, "2024-02-01T00:00:00", None),
        (*NYC, "2024-01-31T05:00:00", "-3"), (*NYC, "2024-02-01T05:00:00", "1"),
        ("1.0", "1.0", "2024-01-31T05:00:00", "99"),
    )


def test_daily_stats(spark, observed, locations):
    rows = {(r.city, r.date): r for r in marts.daily_stats(observed, locations).collect()}
    assert len(rows) == 4
    jax = rows[("Jacksonville", dt.date(2024, 1, 31))]
    assert (jax.max_temperature, jax.min_temperature) == (D("12.5"), D("10"))
    assert jax.average_temperature == D("10.84")  # 32.505 / 3 = 10.835, half away from zero
    assert rows[("Jacksonville", dt.date(2024, 2, 1))].average_temperature is None
    assert rows[(None, dt.date(2024, 1, 31))].average_temperature == D("-3.00")


def test_average_rounds_away_from_zero_below_zero(spark, locations):
    rows = hourly(spark, (*NYC, "2024-01-01T00:00:00", "-1.01"), (*NYC, "2024-01-01T01:00:00", "-1.02"))
    assert marts.daily_stats(rows, locations).first().average_temperature == D("-1.02")


def test_daily_max_month(spark, observed, locations):
    rows = marts.daily_max(observed, locations).collect()
    assert {(r.date.month, r.month) for r in rows} == {(1, 1), (2, 2)}


def test_location_twice_under_one_rounded_key(spark, observed, locations):
    twin = locations.limit(1).withColumn("latitude", F.lit("30.318911").cast("decimal(9,6)")).withColumn(
        "city", F.lit("Twin"))
    both = locations.union(twin)
    cities = {r.city for r in marts.daily_stats(observed, both).collect()}
    assert cities == {"Jacksonville", "Twin", None}
    assert duplicate_keys(with_rounded_key(both), ROUNDED_KEY).count() == 1


def test_monthly_peak_keeps_ties(spark):
    daily = spark.createDataFrame(
        [("a", dt.date(2024, 1, 1), 5.0), ("a", dt.date(2024, 1, 2), 5.0), ("a", dt.date(2024, 1, 2), 4.0),
         ("a", dt.date(2024, 2, 1), 1.0), ("a", dt.date(2023, 1, 9), 2.0), ("b", dt.date(2024, 1, 1), None)],
        "place string, date date, max_temperature double",
    )
    rows = {(r.year, r.month, r.date.day) for r in marts.monthly_peak(daily, ["place"]).collect()}
    assert rows == {(2024, 1, 1), (2024, 1, 2), (2024, 2, 1), (2023, 1, 9)}


def test_daily_extremes(spark, observed, locations):
    rows = {r.date.day: r for r in marts.daily_extremes(observed, locations, "city").collect()}
    assert rows[31].min_location is None and rows[31].max_location == "Jacksonville"
    assert rows[31].min_temperature == D("-3") and rows[31].average_temperature == D("7.38")
    assert rows[1].average_temperature == D("1.00")


def test_newest_first_puts_unknown_dates_ahead(spark):
    rows = spark.createDataFrame([(dt.date(2024, 1, 1),), (None,), (dt.date(2024, 1, 2),)], "date date")
    assert [r.date for r in marts.newest_first(rows).collect()] == [
        None, dt.date(2024, 1, 2), dt.date(2024, 1, 1)]


def test_observations_are_reduced_before_the_join(spark, observed, locations):
    plan = marts.daily_stats(observed, locations)._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join Inner")
    assert plan.count("Aggregate") == 2
    assert plan.index("Aggregate") < join < plan.rindex("Aggregate")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("share", [3, 10, 1000])
def test_salted_join_equals_plain_join(spark, how, share):
    facts = spark.range(3000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100).alias("k"))
    facts = facts.union(facts.filter("k = 0").limit(50)).union(spark.sql("SELECT 7L, NULL"))
    dimension = spark.range(80).select((F.col("id") % 60).alias("k"), F.col("id").alias("label"))
    plain = Counter(map(tuple, facts.join(dimension, ["k"], how).collect()))
    salted = salted_join(facts, dimension, ["k"], how, share=share, spread=8)
    assert salted.columns == facts.join(dimension, ["k"], how).columns
    assert Counter(map(tuple, salted.collect())) == plain


def test_hot_key_list_is_bounded(spark):
    rows = spark.range(1000).select((F.col("id") % 10).alias("k"))
    assert hot_keys(rows, ["k"], 10).count() == 0
    assert hot_keys(rows, ["k"], 11).count() == 10


def test_salted_join_spreads_a_hot_key(spark):
    facts = spark.range(10000).select(F.col("id"), F.lit(1).alias("k"))
    dimension = spark.createDataFrame([(1, "one")], "k int, label string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(facts, dimension, ["k"], spread=64)
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) > 4 and max(r["count"] for r in sizes) < 5000


def test_salting_refuses_other_joins(spark):
    with pytest.raises(ValueError):
        salted_join(spark.range(1), spark.range(1), ["id"], "full")


def test_rounding_is_half_away_from_zero(spark):
    row = with_rounded_key(
        spark.sql("SELECT CAST(30.318850 AS DECIMAL(9,6)) latitude, CAST(-81.69015 AS DECIMAL(9,6)) longitude")
    ).first()
    assert (row._lat_key, row._lon_key) == (D("30.3189"), D("-81.6902"))


def test_rows_join(spark, observed, locations):
    joined = join_on_rounded(observed, locations)
    assert joined.count() == 6
    assert set(joined.columns) == {
        "latitude", "longitude", "datetime", "temp", "city", "state", "postcode", "country"}


def test_lookup_location(spark, observed, locations):
    rows = {str(r.latitude): r for r in lookup_location(observed, locations).collect()}
    assert len(rows) == 4
    assert rows["30.318900"].postcode == "32204"
    assert rows["40.712800"].city is None and rows["40.712800"].country == "US"
    assert rows["1.000000"].country is None
