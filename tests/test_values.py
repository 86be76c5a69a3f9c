from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from obsflow.fixed_values import DEFAULT_LOCATIONS
from obsflow.functions import scalars
from obsflow.functions.maps import parse_amounts, total_by, total_of
from obsflow.plans.orders import order_totals
from obsflow.sources.requests import default_locations, request_grid, resolve_locations, trailing_days


def test_order_message(spark):
    documents = spark.createDataFrame(
        [('{"1001": 301.27, "1002": 433.21, "1003": 502.22}',), ("{}",), ("no json",)], "document string")
    messages = [r.message for r in order_totals(documents).collect()]
    assert messages[:2] == ["Total order value is: 1236.70", "Total order value is: 0.00"]


def test_totals_over_maps(spark):
    rows = spark.createDataFrame([("a", '{"x": 1.5}'), ("a", '{"x": 2, "y": 3}'), ("b", "{}")], "k string, t string")
    amounts = rows.select("k", parse_amounts(F.col("t")).alias("m"))
    assert {r.k: r.total for r in total_by(amounts, ["k"], "m").collect()} == {"a": 6.5, "b": 0.0}
    assert [r[0] for r in amounts.select(total_of(F.col("m"))).collect()] == [1.5, 5.0, 0.0]


def test_default_locations(spark):
    assert [tuple(r) for r in default_locations(spark).collect()] == DEFAULT_LOCATIONS


def test_defaults_only_when_both_are_blank(spark):
    requests = spark.createDataFrame(
        [(1, None, ""), (2, "1.5", "2.5"), (3, "", "9"), (4, " ", None)],
        "id int, latitude string, longitude string")
    rows = resolve_locations(requests).collect()
    by_id = {n: [(r.latitude, r.longitude) for r in rows if r.id == n] for n in (1, 2, 3, 4)}
    assert by_id[1] == by_id[4] == DEFAULT_LOCATIONS
    assert by_id[2] == [("1.5", "2.5")] and by_id[3] == [("", "9")]


def test_grid_of_default_run(spark):
    anchor = F.lit("2024-03-02 10:30:15").cast("timestamp")
    grid = request_grid(default_locations(spark), anchor)
    rows = grid.collect()
    assert len(rows) == 50 and {r.units for r in rows} == {"metric"}
    days = sorted({(r.day, r.dt) for r in rows}, reverse=True)
    assert days[0] == (dt.date(2024, 3, 1), 1709289015)
    assert days[-1][0] == dt.date(2024, 2, 26)
    assert grid._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0


def test_trailing_days_follow_each_anchor(spark):
    rows = spark.createDataFrame([(1, dt.datetime(2024, 1, 3)), (2, dt.datetime(2023, 1, 1))], "id int, at timestamp")
    found = {(r.id, r.day) for r in trailing_days(rows, F.col("at"), 2).collect()}
    assert found == {(1, dt.date(2024, 1, 2)), (1, dt.date(2024, 1, 1)),
                     (2, dt.date(2022, 12, 31)), (2, dt.date(2022, 12, 30))}


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_scalars(spark):
    lit = F.lit
    moment = lit("2022-01-02 03:04:05.678901").cast("timestamp")
    assert one(spark, scalars.to_epoch(moment)) == 1641092645
    assert one(spark, scalars.stamp(moment)) == "20220102030405"
    assert one(spark, scalars.stamp(moment, micros=True)) == "20220102030405678901"
    assert one(spark, scalars.as_long(lit("x1"))) is None
    assert one(spark, scalars.as_date(lit("1980-02-30"))) is None
    assert one(spark, scalars.as_measure(lit(""))) is None
    assert one(spark, scalars.as_coordinate(lit("1000.5"))) is None
    assert one(spark, scalars.is_blank(lit("  "))) is True
    assert one(spark, scalars.is_blank(lit(None).cast("string"))) is True
    assert one(spark, scalars.is_accepted(lit(None).cast("int"))) is False
    assert one(spark, scalars.point_text(lit("1"), lit("2"))) == "1,2"
    assert one(spark, scalars.request_address(lit("h/"), lit("p"))) == "h/p"
    lookup = F.from_json(lit('{"city": "Rome"}'), "map<string,string>")
    assert one(spark, scalars.optional(lookup, "city")) == "Rome"
    assert one(spark, scalars.optional(lookup, "state")) is None


def test_averages_are_rounded_once(spark):
    from decimal import Decimal

    from obsflow.functions.scalars import exact_average

    cases = [
        (["2.004999", "2.005000"], "2.00"),
        (["-2.004999", "-2.005000"], "-2.00"),
        (["2.005000"], "2.01"),
        (["-2.005"], "-2.01"),
        (["0.00"] * 10001 + ["0.01"] * 10000, "0.00"),
        ([None], None),
    ]
    data = [(k, None if v is None else Decimal(v)) for k, (values, _) in enumerate(cases) for v in values]
    rows = spark.createDataFrame(data, "k int, v decimal(18,6)")
    found = rows.groupBy("k").agg(F.expr(exact_average("sum(v)", "count(v)")).alias("a")).collect()
    assert {r.k: r.a for r in found} == {k: None if a is None else Decimal(a) for k, (_, a) in enumerate(cases)}


def test_keys_are_rounded_once(spark):
    from obsflow.functions.scalars import rounded

    rows = spark.createDataFrame([("30.1234499999",), ("30.12345",), ("-0.00005",), ("x",)], "t string")
    assert [None if r[0] is None else str(r[0]) for r in rows.select(rounded(F.col("t"))).collect()] == ["30.1234", "30.1235", "-0.0001", None]


def test_fuller_address_wins(spark):
    from obsflow.operators.enrich import lookup_location

    kind = "latitude decimal(9,6), longitude decimal(9,6), city string, state string, postcode string, country string"
    from decimal import Decimal as D

    gazetteer = spark.createDataFrame([(D("1.00001"), D(2), None, "A", None, "X"), (D("1.00002"), D(2), "Town", "B", None, "X")], kind)
    points = spark.createDataFrame([(D(1), D(2))], "latitude decimal(9,6), longitude decimal(9,6)")
    found = lookup_location(points, gazetteer).first()
    assert (found.city, found.state) == ("Town", "B")
