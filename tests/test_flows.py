from __future__ import annotations

import datetime as dt
import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.operators.drift import drift, run_schemas, shape
from obsflow.operators.history import address_as_of, location_history
from obsflow.plans.local_days import day_hours, local_daily_stats, local_day, split_zones, stored_days
from obsflow.schemas import HOURLY_KEY, LOCATION
from obsflow.sinks.sorted_export import part_sizes, read_sorted_csv, write_sorted_csv
from obsflow.sinks.tables import BaseTable
from obsflow.streaming.stateful import load_first_seen, read_loaded

D = Decimal
HOURS = T.StructType(
    [T.StructField("latitude", T.DecimalType(9, 6)), T.StructField("longitude", T.DecimalType(9, 6)), T.StructField("datetime", T.TimestampType()), T.StructField("temp", T.DecimalType(18, 6))]
)


# --- stateful load


def land_hours(folder, name, days, temp, places=(1,)):
    folder.mkdir(parents=True, exist_ok=True)
    start = dt.datetime(2024, 1, 1)
    rows = [
        {"latitude": p, "longitude": 0, "datetime": (start + dt.timedelta(days=d, hours=h)).strftime("%Y-%m-%dT%H:%M:%SZ"), "temp": temp}
        for p in places
        for d in days
        for h in range(24)
    ]
    (folder / f"{name}.json").write_text("\n".join(map(json.dumps, rows)))


def hour_base(tmp_path):
    return BaseTable(str(tmp_path / "base"), HOURS, HOURLY_KEY, HOURLY_KEY, "obs_date", "datetime")


def test_first_writer_wins_over_restarts_and_state_is_bounded(spark, tmp_path):
    base, landing, offsets = hour_base(tmp_path), tmp_path / "landing", str(tmp_path / "offsets")
    held = []
    for run in range(9):
        # Each run brings five trailing days; four of them have come before.
        land_hours(landing, str(run), range(run, run + 5), run)
        report = load_first_seen(spark, str(landing), HOURS, base, offsets)
        assert report.read == 120 and report.late == 0
        held.append(report.keys_held)
    rows = read_loaded(spark, base).collect()
    assert len(rows) == 13 * 24 == len({r.datetime for r in rows})
    for r in rows:
        assert float(r.temp) == max(0, (r.datetime - dt.datetime(2024, 1, 1)).days - 4)
    # Five days of delay on both sides of the watermark, whatever the number of runs.
    assert max(held) <= 11 * 24 and held[-1] == held[-2]
    again = load_first_seen(spark, str(landing), HOURS, base, offsets)
    assert again.read == 0 and read_loaded(spark, base).count() == len(rows)


def test_rows_from_before_the_watermark_are_counted_and_left_out(spark, tmp_path):
    base, landing, offsets = hour_base(tmp_path), tmp_path / "landing", str(tmp_path / "offsets")
    land_hours(landing, "a", range(10, 15), 1)
    load_first_seen(spark, str(landing), HOURS, base, offsets)
    land_hours(landing, "b", [1, 2], 2, places=(7,))
    land_hours(landing, "c", [15], 3)
    report = load_first_seen(spark, str(landing), HOURS, base, offsets)
    assert (report.read, report.late) == (72, 48)
    assert read_loaded(spark, base).filter("latitude = 7").count() == 0
    with pytest.raises(ValueError):
        load_first_seen(spark, str(landing), HOURS, BaseTable(str(tmp_path / "x"), HOURS, HOURLY_KEY), offsets)


# --- shapes


def lines(spark, *runs):
    return spark.createDataFrame([(name, json.dumps(d) if not isinstance(d, str) else d) for name, docs in runs for d in docs], "run string, text string")


def test_shape_of_a_schema():
    found = shape("OBJECT<a: ARRAY<OBJECT<`x OBJECT<y`: DECIMAL(3,1)>>, b: VOID, c: VARIANT, d: OBJECT<>>")
    assert found == {"$": "object", "$.a": "list", "$.a[]": "object", "$.a[].x OBJECT<y": "number", "$.b": "null", "$.c": "mixed", "$.d": "object"}
    assert shape(None) == {}


def test_what_changed_and_when(spark):
    landed = lines(
        spark,
        ("1", [{"lat": 1.5, "hourly": [{"feels_like": 9.5}]}, {"lat": 2, "hourly": []}]),
        ("2", [{"lat": 1.5, "hourly": [{"feels_like": 9}]}, "{broken"]),
        ("3", ["{broken"]),
        ("4", [{"lat": "1.5"}, {"cod": 401, "message": "no"}]),
    )
    found = {(r.run, r.path): (r.change, r.before, r.after) for r in drift(landed).collect()}
    assert found == {
        ("2", "$.hourly[].feels_like"): ("changed", "number", "whole number"),
        ("4", "$.lat"): ("changed", "number", "text"),
        ("4", "$.hourly"): ("removed", "list", None),
        ("4", "$.hourly[]"): ("removed", "object", None),
        ("4", "$.hourly[].feels_like"): ("removed", "whole number", None),
        ("4", "$.cod"): ("added", None, "whole number"),
        ("4", "$.message"): ("added", None, "text"),
    }
    counts = {r.run: (r.documents, r.broken) for r in run_schemas(landed).collect()}
    assert counts == {"1": (2, 0), "2": (2, 1), "3": (1, 1), "4": (2, 0)}
    assert drift(landed.limit(0)).count() == 0


def test_shapes_are_merged_by_tasks_first(spark):
    plan = run_schemas(lines(spark, ("1", [{"a": 1}])))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ObjectHashAggregate") == 2


# --- sorted files


def test_files_by_name_give_the_order(spark, tmp_path):
    chance = random.Random(1)
    data = [(chance.choice([None, dt.date(2024, 1, chance.randrange(1, 29))]), f'c "{chance.randrange(500)}",\n\\', k) for k in range(3000)]
    schema = T.StructType([T.StructField("date", T.DateType()), T.StructField("city", T.StringType()), T.StructField("n", T.IntegerType())])
    rows = spark.createDataFrame(data, schema)
    path = str(tmp_path / "out")
    write_sorted_csv(rows, path, [F.col("date").desc_nulls_first(), F.col("city"), F.col("n")], 6)
    found = sorted(read_sorted_csv(spark, path, schema).collect(), key=lambda r: r.place)
    assert [r.place for r in found] == list(range(1, 3001))
    expected = sorted(data, key=lambda r: (r[0] is not None, -(r[0].toordinal() if r[0] else 0), r[1], r[2]))
    assert [(r.date, r.city, r.n) for r in found] == expected


def test_a_date_that_most_rows_share_is_split(spark, tmp_path):
    rows = spark.range(20_000).select(F.when(F.col("id") % 4 != 0, F.lit("2024-01-05")).otherwise(F.lit("2024-01-01")).cast("date").alias("date"), "id")
    path = str(tmp_path / "out")
    write_sorted_csv(rows, path, [F.col("date").desc()], 8)
    sizes = [r.rows for r in part_sizes(spark, path).collect()]
    assert sum(sizes) == 20_000 and len(sizes) == 8 and max(sizes) < 1.5 * 20_000 / 8


def test_pieces_of_a_file_keep_their_order(spark, tmp_path):
    rows = spark.range(5000).select(F.col("id").cast("int").alias("n"))
    path = str(tmp_path / "out")
    write_sorted_csv(rows, path, [F.col("n").asc()], 2)
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "4k")
    try:
        found = read_sorted_csv(spark, path, T.StructType([T.StructField("n", T.IntegerType())])).collect()
    finally:
        spark.conf.set(size, before)
    assert all(r.place == r.n + 1 for r in found) and len(found) == 5000


# --- local days


def test_days_of_23_and_25_hours(spark):
    rows = spark.createDataFrame(
        [("Europe/Berlin", dt.date(2024, 3, 31)), ("Europe/Berlin", dt.date(2024, 10, 27)), ("Europe/Berlin", dt.date(2024, 5, 1)), ("Australia/Lord_Howe", dt.date(2024, 4, 7)), ("Asia/Kolkata", dt.date(2024, 3, 31))],
        "zone string, day date",
    )
    found = [float(r[0]) for r in rows.select(day_hours(F.col("day"), F.col("zone"))).collect()]
    assert found == [23, 25, 24, 24.5, 24]


def test_local_stats(spark, tmp_path):
    start = dt.datetime(2024, 3, 30, 22)
    data = [(D(1), D(0), start + dt.timedelta(hours=h), D(h), zone) for h in range(26) for zone in ("Europe/Berlin",)]
    data += [(D(1), D(0), start, D(99), zone) for zone in ("Nowhere/City", None, "")]
    schema = T.StructType([*HOURS.fields, T.StructField("timezone", T.StringType())])
    rows = spark.createDataFrame(data, schema)
    places = spark.createDataFrame([(D(1), D(0), "B", "S", "1", "C")], LOCATION)
    found = {str(r.date): (r.observations, float(r.min_temperature), float(r.max_temperature), float(r.day_hours)) for r in local_daily_stats(rows, places).collect()}
    # Local midnight is at 23:00 UTC before the change and at 22:00 after it.
    assert found == {"2024-03-30": (1, 0, 0, 24), "2024-03-31": (23, 1, 23, 23), "2024-04-01": (2, 24, 25, 24)}
    assert split_zones(rows)[1].count() == 3
    folder = str(tmp_path / "z")
    rows.withColumn("obs_date", F.to_date("datetime")).write.partitionBy("obs_date").parquet(folder)
    day = dt.date(2024, 3, 31)
    span = local_daily_stats(spark.read.parquet(folder), places, day, day)
    assert [(str(r.date), r.observations) for r in span.collect()] == [("2024-03-31", 23)]
    scan = next(line for line in span._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line and "obs_date" in line)
    wanted = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert ">= 2024-03-30" in wanted and "<= 2024-04-01" in wanted
    with pytest.raises(ValueError):
        local_daily_stats(rows, places, first=day)


def test_stored_days_hold_every_zone(spark):
    moments = spark.range(0, 72).select(F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600).alias("at"))
    day = dt.date(2024, 1, 2)
    for zone in ("Pacific/Kiritimati", "Pacific/Pago_Pago", "UTC"):
        rows = moments.select(local_day(F.col("at"), F.lit(zone)).alias("local"), F.to_date("at").alias("stored")).filter(F.col("local") == F.lit(day))
        assert rows.count() == 24 and rows.filter(~stored_days("stored", day, day)).count() == 0


# --- addresses over time


def test_history_and_lookup(spark):
    def at(day):
        return dt.datetime(2024, 1, day)

    landings = [
        (D("1.00001"), D(0), "A", "S", None, "C", at(1)),
        (D("1.00002"), D(0), "A", "S", None, "C", at(3)),
        (D(1), D(0), "B", "S", None, "C", at(5)),
        (D(1), D(0), "B", "S", "9", "C", at(7)),
        (D(1), D(0), "A", "S", None, "C", at(9)),
        (D(1), D(0), "Z", "S", None, "C", at(9)),
        (D(2), D(0), "X", None, None, None, at(4)),
    ]
    chance = random.Random(1)
    chance.shuffle(landings)
    schema = T.StructType([*LOCATION.fields, T.StructField("landed", T.TimestampType())])
    history = location_history(spark.createDataFrame(landings, schema))
    spans = sorted((int(r._lat_key), r.city, r.postcode or "", r.valid_from.day, r.valid_to.day if r.valid_to else None) for r in history.collect())
    assert spans == [(1, "A", "", 1, 5), (1, "A", "", 9, None), (1, "B", "", 5, 7), (1, "B", "9", 7, 9), (2, "X", "", 4, None)]
    rows = spark.createDataFrame([(D(p), D(0), at(d), D(0)) for p, d in ((1, 1), (1, 4), (1, 5), (1, 8), (1, 20), (2, 1), (2, 5), (3, 5))], HOURS)
    found = {(int(r.latitude), r.datetime.day): r.city for r in address_as_of(rows, history).collect()}
    assert found == {(1, 1): "A", (1, 4): "A", (1, 5): "B", (1, 8): "B", (1, 20): "A", (2, 1): None, (2, 5): "X", (3, 5): None}
    assert address_as_of(rows, history.limit(0)).filter("city IS NOT NULL").count() == 0
