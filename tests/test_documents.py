from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from obsflow.operators.flatten import flatten_current, flatten_hourly, flatten_struct
from obsflow.operators.screening import accepted_responses, split_documents
from obsflow.plans.weather import stage
from obsflow.sources.documents import read_weather_documents, with_lineage

GOOD = {
    "lat": 30.3189, "lon": -81.6902, "timezone": "America/New_York", "timezone_offset": -18000,
    "current": {
        "dt": 1640995200, "sunrise": 1640952000, "sunset": 1640990000, "temp": 9, "wind_deg": 350,
        "weather": [{"id": 800, "main": "Clear", "description": "clear sky", "icon": "01n"}],
    },
    "hourly": [
        {"dt": 1640995200, "temp": 9, "feels_like": 7.25, "wind_gust": 3.6,
         "weather": [{"id": 500, "main": "Rain", "description": "light rain", "icon": "10n"},
                     {"id": 701, "main": "Mist", "description": "mist", "icon": "50n"}]},
        {"dt": 1640998800, "temp": 8.5, "weather": []},
        {"dt": 1641002400},
    ],
}


@pytest.fixture()
def landing(tmp_path):
    texts = {
        "good": json.dumps(GOOD),
        "payload": '{"cod":401,"message":"Invalid key"}',
        "broken": '{"lat": 1.0, "lon": ',
        "empty": '{"lat": 1.0, "lon": 2.0, "timezone": "UTC"}',
        "current_only": json.dumps({k: v for k, v in GOOD.items() if k != "hourly"}),
        "no_hours": json.dumps({**GOOD, "hourly": []}),
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    return str(tmp_path)


def test_split_names_the_reason(spark, landing, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("staged"))
    documents = stage(spark, read_weather_documents(spark, landing), folder)
    good, rejected = split_documents(documents)
    assert good.count() == 3
    assert sorted(r.reason for r in rejected.collect()) == ["corrupt", "empty", "incomplete"]
    assert "_corrupt_record" not in good.columns


def test_hourly_rows(spark, landing):
    rows = flatten_hourly(read_weather_documents(spark, f"{landing}/good.json")).orderBy("datetime")
    first, second, third = rows.collect()
    assert len(rows.columns) == 19
    assert first.latitude == Decimal("30.318900") and first.longitude == Decimal("-81.690200")
    assert first.datetime == dt.datetime(2022, 1, 1)
    assert first.temp == Decimal("9.000000") and first.feels_like == Decimal("7.250000")
    assert (first.weather_id, first.weather_main, first.weather_icon) == (500, "Rain", "10n")
    assert second.wind_gust is None and second.weather_id is None
    assert third.temp is None and third.weather_main is None


def test_documents_without_hours_give_no_hourly_row(spark, landing):
    for name in ("current_only", "no_hours", "empty"):
        assert flatten_hourly(read_weather_documents(spark, f"{landing}/{name}.json")).isEmpty()


def test_current_row(spark, landing):
    rows = flatten_current(read_weather_documents(spark, f"{landing}/current_only.json"))
    assert len(rows.columns) == 20
    row = rows.first()
    assert row.requested_datetime == dt.datetime(2022, 1, 1)
    assert row.sunrise == dt.datetime(2021, 12, 31, 12)
    assert row.weather_description == "clear sky"
    assert row.pressure is None
    assert flatten_current(read_weather_documents(spark, f"{landing}/empty.json")).isEmpty()


def test_hourly_scan_reads_only_what_it_needs(spark, landing):
    plan = flatten_hourly(read_weather_documents(spark, landing))._jdf.queryExecution().toString()
    schema = plan.split("ReadSchema:")[1].splitlines()[0]
    assert "current" not in schema and "timezone_offset" not in schema


def test_lineage(spark, landing):
    rows = with_lineage(read_weather_documents(spark, landing)).select("lat", "source_file").collect()
    assert {r.source_file.rsplit("/", 1)[1] for r in rows} >= {"good.json", "payload.json"}


def test_accepted_statuses(spark):
    rows = spark.createDataFrame([(200,), (204,), (404,), (None,)], "status int")
    assert sorted(r.status for r in accepted_responses(rows).collect()) == [200, 204]


def test_flatten_struct_keeps_arrays_and_odd_names(spark):
    rows = spark.sql(
        "SELECT named_struct('a.b', 1, 'c', named_struct('d', array(1, 2))) AS top, 'x' AS y"
    )
    flat = flatten_struct(rows)
    assert flat.columns == ["top.a.b", "top.c.d", "y"]
    assert list(flat.first()) == [1, [1, 2], "x"]
    assert flatten_struct(rows, sep="_").columns == ["top_a.b", "top_c_d", "y"]


def test_flatten_projects_once_below_and_once_above_the_explode(spark, landing):
    plan = flatten_hourly(read_weather_documents(spark, landing))._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("Project") == 2
    assert plan.executedPlan().toString().count("Exchange") == 0


def test_epoch_follows_utc(spark):
    row = spark.range(1).select(F.timestamp_seconds(F.lit(1640995200)).cast("string").alias("t")).first()
    assert row.t == "2022-01-01 00:00:00"
