from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest

from obsflow.fixed_values import DAILY_MAX_VIEW, DAILY_STATS_VIEW
from obsflow.operators.quality import QualityError
from obsflow.plans.weather import WeatherStore, refresh_weather
from obsflow.schemas import LOCATION
from obsflow.streaming.incremental import run_available

D = Decimal


def document(day, temps, lat=30.3189, lon=-81.6902):
    start = int(dt.datetime(2024, 1, day, tzinfo=dt.timezone.utc).timestamp())
    hours = [{"dt": start + 3600 * i, "temp": t, "weather": []} for i, t in enumerate(temps)]
    return {"lat": lat, "lon": lon, "timezone": "UTC", "hourly": hours, "current": hours[-1]}


def land(folder, name, document_or_text):
    folder.mkdir(parents=True, exist_ok=True)
    text = document_or_text if isinstance(document_or_text, str) else json.dumps(document_or_text)
    (folder / f"{name}.json").write_text(text)


@pytest.fixture()
def locations(spark):
    return spark.createDataFrame(
        [(D("30.318878"), D("-81.690173"), "Jacksonville", "Florida", "32204", "US")], LOCATION)


def counts(spark, store):
    return store.hourly.read(spark).count(), store.current.read(spark).count(), store.location.read(spark).count()


def test_refresh_is_idempotent(spark, tmp_path, locations):
    store = WeatherStore(str(tmp_path / "store"))
    landing = tmp_path / "landing"
    land(landing, "1", document(1, [1.5, 2.5]))
    land(landing, "2", document(2, [5, 7]))
    land(landing, "3", '{"cod":429,"message":"slow down"}')
    for _ in range(2):
        marts = refresh_weather(spark, str(landing), store, locations, "20240103")
        assert counts(spark, store) == (4, 2, 1)
        assert spark.read.json(store.rejected("20240103")).count() == 1
    rows = {r.date.day: r for r in spark.table(DAILY_STATS_VIEW).collect()}
    assert rows[1].average_temperature == D("2.00") and rows[2].max_temperature == D("7")
    assert [r.month for r in spark.table(DAILY_MAX_VIEW).collect()] == [1, 1]
    assert set(marts) == {DAILY_MAX_VIEW, DAILY_STATS_VIEW}


def test_overlapping_runs_keep_the_first_value(spark, tmp_path, locations):
    store = WeatherStore(str(tmp_path / "store"))
    for run, temps in (("a", [1, 2]), ("b", [8, 9, 10])):
        land(tmp_path / run, "1", document(1, temps))
        refresh_weather(spark, str(tmp_path / run), store, locations, run)
    temps = [float(r.temp) for r in store.hourly.read(spark).orderBy("datetime").collect()]
    assert temps == [1.0, 2.0, 10.0]


def test_document_landed_twice_is_refused_or_kept_once(spark, tmp_path, locations):
    store = WeatherStore(str(tmp_path / "store"))
    for name in ("1", "2"):
        land(tmp_path / "landing", name, document(1, [1, 2]))
    with pytest.raises(QualityError):
        refresh_weather(spark, str(tmp_path / "landing"), store, locations, "r")
    refresh_weather(spark, str(tmp_path / "landing"), store, locations, "r", on_duplicate="first")
    assert counts(spark, store) == (2, 1, 1)


def test_incremental_takes_each_file_once_and_survives_a_lost_checkpoint(spark, tmp_path):
    store = WeatherStore(str(tmp_path / "store"))
    landing, offsets = tmp_path / "landing", str(tmp_path / "offsets")
    land(landing / "run=1", "1", document(1, [1, 2]))
    run_available(spark, str(landing), store, offsets)
    land(landing / "run=2", "1", document(1, [5, 6, 7]))
    land(landing / "run=2", "2", "{broken")
    run_available(spark, str(landing), store, offsets, files_per_batch=1)
    run_available(spark, str(landing), store, offsets)
    temps = [float(r.temp) for r in store.hourly.read(spark).orderBy("datetime").collect()]
    assert temps == [1.0, 2.0, 7.0]
    # All files again, as after the loss of the checkpoint: the merge skips them.
    run_available(spark, str(landing), store, str(tmp_path / "new-offsets"))
    assert store.hourly.read(spark).count() == 3


def test_date_filter_on_a_mart_prunes_files(spark, tmp_path, locations):
    store = WeatherStore(str(tmp_path / "store"))
    land(tmp_path / "landing", "1", document(1, [1, 2]))
    land(tmp_path / "landing", "2", document(2, [3, 4]))
    refresh_weather(spark, str(tmp_path / "landing"), store, locations, "r")
    frame = spark.sql(f"SELECT * FROM {DAILY_STATS_VIEW} WHERE date = DATE '2024-01-02'")
    scan = next(line for line in frame._jdf.queryExecution().executedPlan().toString().splitlines()
                if "FileScan" in line and "temp#" in line)
    assert "obs_date" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "humidity" not in scan
    assert frame.first().max_temperature == D("4")


def test_incremental_merges_plan_adaptively(spark, tmp_path, monkeypatch):
    from obsflow.sinks.tables import BaseTable

    seen = []
    append = BaseTable.append

    def watch(self, rows):
        seen.append(rows.sparkSession.conf.get("spark.sql.adaptive.enabled"))
        append(self, rows)

    monkeypatch.setattr(BaseTable, "append", watch)
    land(tmp_path / "landing", "1", document(1, [1, 2]))
    run_available(spark, str(tmp_path / "landing"), WeatherStore(str(tmp_path / "store")),
                  str(tmp_path / "offsets"))
    assert seen == ["true", "true"]


def test_incremental_archives_loaded_files(spark, tmp_path):
    store = WeatherStore(str(tmp_path / "store"))
    for number in (1, 2, 3):
        land(tmp_path / "landing", str(number), document(number, [1, 2]))
        run_available(spark, str(tmp_path / "landing"), store, str(tmp_path / "offsets"),
                      archive=str(tmp_path / "archive"))
    assert store.hourly.read(spark).count() == 6
    assert len(list((tmp_path / "archive").rglob("*.json"))) >= 1


def test_command_line(spark, tmp_path, locations, capfd):
    from obsflow.__main__ import main
    from obsflow.sinks.files import write_headerless_csv

    store, places = str(tmp_path / "store"), str(tmp_path / "places")
    land(tmp_path / "landing", "1", document(1, [1, 2]))
    write_headerless_csv(locations, places)
    main(["refresh", "--landing", str(tmp_path / "landing"), "--store", store,
          "--locations", places, "--run", "1"])
    main(["report", "--store", store, "--view", DAILY_STATS_VIEW])
    assert "Jacksonville" in capfd.readouterr().out
    main(["report", "--store", store, "--view", "daily_extremes"])
    assert "Jacksonville" in capfd.readouterr().out
    assert spark.table("monthly_peak").first().max_temperature == D("2")
    main(["export", "--landing", str(tmp_path / "landing"), "--folder", str(tmp_path / "csv")])
    assert spark.read.csv(str(tmp_path / "csv" / "hourly_weather")).count() == 2
    land(tmp_path / "landing", "2", document(2, [1, 2]))
    main(["incremental", "--landing", str(tmp_path / "landing"), "--store", store,
          "--checkpoint", str(tmp_path / "offsets")])
    assert WeatherStore(store).hourly.read(spark).count() == 4
    land(tmp_path / "lake" / "raw" / "patient", "1",
         {"total": 1, "entry": [{"resource": {"id": "5"}, "search": {"mode": "match"}}]})
    main(["clinical", "--root", str(tmp_path / "lake"), "--resources", "patient"])
    assert spark.read.parquet(str(tmp_path / "lake" / "silver" / "patient")).first().id == 5


def test_store_in_the_catalog(spark, tmp_path, locations):
    spark.sql("CREATE DATABASE IF NOT EXISTS weather_db")
    store = WeatherStore("weather_db", rejects=str(tmp_path / "rejected"))
    folder = WeatherStore(str(tmp_path / "store"))
    land(tmp_path / "landing", "1", document(1, [1.5, 2.5, 3.25]))
    land(tmp_path / "landing", "2", document(2, [4, 6]))
    land(tmp_path / "landing", "3", "{broken")
    for _ in range(2):
        stored = refresh_weather(spark, str(tmp_path / "landing"), store, locations, "r")
    session_only = refresh_weather(spark, str(tmp_path / "landing"), folder, locations, "r")
    for name, mart in stored.items():
        assert mart.columns == session_only[name].columns
        assert sorted(map(str, mart.collect())) == sorted(map(str, session_only[name].collect()))
    assert spark.sql(f"SELECT * FROM weather_db.{DAILY_STATS_VIEW}").count() == 2
    with pytest.raises(ValueError):
        WeatherStore("weather_db").rejected("r")
    spark.sql("DROP DATABASE weather_db CASCADE")


def test_rejects_of_two_checkpoints_and_bad_rows_are_all_kept(spark, tmp_path):
    store = WeatherStore(str(tmp_path / "store"))
    for k in (1, 2):
        landing = tmp_path / f"landing{k}"
        land(landing, "good", document(k, [1, 2]))
        land(landing, "bad", "{broken")
        hours = document(10 + k, [3, 4])
        del hours["hourly"][0]["dt"]
        land(landing, "row", hours)
        run_available(spark, str(landing), store, str(tmp_path / f"offsets{k}"))
    assert store.hourly.read(spark).count() == 6
    kept = spark.read.json(f"{tmp_path}/store/rejected").groupBy("run").count().collect()
    assert sum(r["count"] for r in kept) == 4


def test_bad_lines_and_documents_are_kept_in_a_hand_over(spark, tmp_path):
    from obsflow.plans.weather import export_flat_csv, load_flat_csv

    landing, folder = tmp_path / "landing", str(tmp_path / "flat")
    land(landing, "1", document(1, [1, 2]))
    land(landing, "2", "{broken")
    export_flat_csv(spark, str(landing), folder)
    assert spark.read.json(f"{folder}/rejected").count() == 1
    spark.createDataFrame([("too,short",)], "value string").write.mode("append").text(f"{folder}/hourly_weather")
    store = WeatherStore(str(tmp_path / "store"))
    load_flat_csv(spark, folder, store)
    assert store.hourly.read(spark).count() == 2
    assert [r.line for r in spark.read.json(f"{folder}-rejected/hourly_weather").collect()] == ["too,short"]


def test_location_step(spark, tmp_path, locations):
    from obsflow.plans.weather import load_locations

    requests = spark.createDataFrame([("30.31892", "-81.690201"), ("30.31892", "-81.690201"), ("95", "0"), ("x", "1"), ("1", None), ("", " ")], "latitude string, longitude string")
    store = WeatherStore(str(tmp_path / "store"))
    for _ in range(2):
        left = load_locations(spark, requests, locations, store)
    assert sorted(map(tuple, left.collect()), key=str) == [("1", None), ("95", "0"), ("x", "1")]
    rows = store.location.read(spark).collect()
    assert len(rows) == len({(r.latitude, r.longitude) for r in rows}) == 11
    assert {(r.latitude, r.city) for r in rows if r.longitude == D("-81.690201")} == {(D("30.318920"), "Jacksonville")}
    near = WeatherStore(str(tmp_path / "near"))
    load_locations(spark, requests, locations, near, nearest=True)
    assert {r.city for r in near.location.read(spark).collect()} == {"Jacksonville"}


def test_command_line_of_a_store_with_a_grain(spark, tmp_path, locations, capfd):
    from obsflow.__main__ import main
    from obsflow.sinks.files import write_headerless_csv

    places = str(tmp_path / "places")
    write_headerless_csv(locations, places)
    (tmp_path / "requests").mkdir()
    (tmp_path / "requests" / "a.csv").write_text("30.3189,-81.6902\n")
    spark.sql("CREATE DATABASE IF NOT EXISTS grain_db")
    options = ["--store", "grain_db", "--rejects", str(tmp_path / "rejected"), "--grain", "3600"]
    main(["locations", "--requests", str(tmp_path / "requests"), "--gazetteer", places, *options])
    land(tmp_path / "landing", "1", document(1, [1, 2]))
    main(["refresh", "--landing", str(tmp_path / "landing"), "--locations", places, "--run", "1", *options])
    assert spark.table("kept_daily_stats").first().max_temperature == D("2")
    assert spark.table("kept_daily_extremes").first().max_location == "Jacksonville"
    land(tmp_path / "lake" / "raw" / "patient", "1", {"total": 1, "entry": [{"resource": {"id": "5"}, "fullUrl": "u"}]})
    main(["clinical", "--root", str(tmp_path / "lake"), "--resources", "patient", "--whole"])
    assert "true" in capfd.readouterr().out
    spark.sql("DROP DATABASE grain_db CASCADE")
