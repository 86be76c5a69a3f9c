from __future__ import annotations

import datetime as dt
import glob
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsflow.operators.key_bitmaps import KeyBitmaps
from obsflow.operators.merge import merge_insert_only
from obsflow.operators.observed import merge_observed, stage_observed
from obsflow.operators.quality import QualityError
from obsflow.plans.day_summaries import DaySummaries, kept_marts
from obsflow.plans.marts import daily_extremes, daily_max, daily_stats, monthly_peak
from obsflow.plans.weather import WeatherStore, load_documents, publish_kept_marts
from obsflow.schemas import HOURLY_KEY, HOURLY_WEATHER, LOCATION
from obsflow.sinks.tables import BaseTable
from obsflow.sources.documents import read_weather_documents
from test_jobs import document, land

D = Decimal
SCHEMA = T.StructType(
    [T.StructField("latitude", T.DecimalType(9, 6)), T.StructField("longitude", T.DecimalType(9, 6)), T.StructField("datetime", T.TimestampType()), T.StructField("temp", T.DecimalType(18, 6))]
)


def rows(spark, *data):
    return spark.createDataFrame([(D(p), D(0), dt.datetime(2024, 1, day, hour, minute), None if t is None else D(t)) for p, day, hour, minute, t in data], SCHEMA)


def base(tmp_path, label="base"):
    return BaseTable(str(tmp_path / label), SCHEMA, HOURLY_KEY, HOURLY_KEY, "obs_date", "datetime")


def state(spark, table):
    return sorted((int(r.latitude), r.datetime, r.temp) for r in table.read(spark).collect())


def batches(spark):
    return [
        rows(spark, *[(p, d, h, 0, p + d + h) for p in (1, 2) for d in (1, 2, 3) for h in (0, 5, 23)], (3, 1, 0, 0, None)),
        rows(spark, *[(p, d, h, 0, 100 + p) for p in (1, 3) for d in (3, 4) for h in (0, 1, 23)]),
        rows(spark, (1, 1, 7, 0, -5), (1, 1, 0, 0, 999), (9, 20, 0, 0, 1)),
        rows(spark),
    ]


def test_merge_like_the_plain_one(spark, tmp_path):
    plain, kept = base(tmp_path, "plain"), base(tmp_path, "kept")
    bitmaps = KeyBitmaps(kept, str(tmp_path / "keys"))
    for k, batch in enumerate(batches(spark)):
        merge_insert_only(batch, plain)
        before = plain.read(spark).count()
        for again in range(2):
            seen = merge_observed(batch, kept, str(tmp_path / f"work{k}"), bitmaps=bitmaps)
            assert seen.rows == batch.count()
        assert seen.appended == 0 and kept.read(spark).count() == before
        assert state(spark, kept) == state(spark, plain)
        assert bitmaps.out_of_step(spark) == []
    # A day's keys at one place are one row.
    assert spark.read.parquet(str(tmp_path / "keys")).filter("latitude = 1 AND obs_date = '2024-01-01'").count() == 1


@pytest.mark.parametrize("grain", [60, 1800, 86400])
def test_other_grains(spark, tmp_path, grain):
    kept = base(tmp_path)
    bitmaps = KeyBitmaps(kept, str(tmp_path / "keys"), grain)
    minutes = [m for m in (0, 1, 30, 59) if m * 60 % grain == 0]
    hours = [0] if grain == 86400 else [0, 1, 12, 23]
    data = [(1, 1, h, m, 1) for h in hours for m in minutes]
    merge_observed(rows(spark, *data[::2]), kept, str(tmp_path / "a"), bitmaps=bitmaps)
    seen = merge_observed(rows(spark, *data), kept, str(tmp_path / "b"), bitmaps=bitmaps)
    assert seen.appended == len(data) - len(data[::2]) and kept.read(spark).count() == len(data)


def test_a_moment_between_two_steps_breaks_a_rule(spark, tmp_path):
    kept = base(tmp_path)
    bitmaps = KeyBitmaps(kept, str(tmp_path / "keys"))
    batch = rows(spark, (1, 1, 0, 0, 1), (1, 1, 0, 30, 2))
    with pytest.raises(QualityError, match="between two steps"):
        merge_observed(batch, kept, str(tmp_path / "a"), bitmaps=bitmaps)
    assert kept.read(spark).count() == 0
    seen = merge_observed(batch, kept, str(tmp_path / "a"), bitmaps=bitmaps, quarantine=str(tmp_path / "aside"))
    assert seen.appended == 1 and sum(seen.broken.values()) == 1
    assert spark.read.json(str(tmp_path / "aside")).count() == 1
    for wrong in (0, 7, 100_000):
        with pytest.raises(ValueError):
            KeyBitmaps(kept, "x/y", wrong)
    with pytest.raises(ValueError):
        KeyBitmaps(BaseTable("x/y", SCHEMA, ["latitude"], []), "x/y")


def test_bitmaps_heal_after_a_run_that_died(spark, tmp_path, monkeypatch):
    kept = base(tmp_path)
    bitmaps = KeyBitmaps(kept, str(tmp_path / "keys"))
    first, second = batches(spark)[:2]
    merge_observed(first, kept, str(tmp_path / "a"), bitmaps=bitmaps)
    with monkeypatch.context() as broken:
        broken.setattr(KeyBitmaps, "add", lambda self, added: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            merge_observed(second, kept, str(tmp_path / "b"), bitmaps=bitmaps)
    assert [d.day for d in bitmaps.out_of_step(spark)] == [3, 4]
    once = state(spark, kept)
    assert merge_observed(second, kept, str(tmp_path / "b"), bitmaps=bitmaps).appended == 0
    assert state(spark, kept) == once and bitmaps.out_of_step(spark) == []


def test_bitmaps_of_a_table_that_was_there_before_or_lost_a_day(spark, tmp_path):
    import shutil

    kept = base(tmp_path)
    for batch in batches(spark):
        merge_insert_only(batch, kept)
    bitmaps = KeyBitmaps(kept, str(tmp_path / "keys"))
    assert len(bitmaps.heal(spark)) == 5 and bitmaps.heal(spark) == []
    shutil.rmtree(tmp_path / "base" / "obs_date=2024-01-20")
    assert [d.day for d in bitmaps.heal(spark)] == [20] and bitmaps.heal(spark) == []
    assert merge_observed(batches(spark)[2], kept, str(tmp_path / "c"), bitmaps=bitmaps).appended == 1


def test_the_table_is_not_read_for_keys_at_any_size(spark, tmp_path, monkeypatch):
    kept = base(tmp_path)
    bitmaps = KeyBitmaps(kept, str(tmp_path / "keys"))
    merge_observed(batches(spark)[0], kept, str(tmp_path / "a"), bitmaps=bitmaps)
    batch = kept.conform(batches(spark)[1])
    plan = bitmaps.absent(batch)._jdf.queryExecution().toString()
    assert "/base" not in plan
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "2024-01-03" in scan.split("PartitionFilters: [")[1].split("]")[0]


def test_metrics_of_a_write(spark, tmp_path):
    data = spark.range(1000).withColumn("x", F.when(F.col("id") % 10 != 0, F.col("id")))
    stored, found = stage_observed(data, str(tmp_path / "w"), {"rows": F.count(F.lit(1)), "x is null": F.count_if(F.col("x").isNull()), "most": F.max("x")})
    assert found == {"rows": 1000, "x is null": 100, "most": 999} and stored.count() == 1000
    _, empty = stage_observed(data.limit(0), str(tmp_path / "e"), {"rows": F.count(F.lit(1)), "most": F.max("x")})
    assert empty == {"rows": 0, "most": None}


def test_checks_take_one_scan(spark, tmp_path):
    """The rows' source is scanned once for checks and write together."""
    source = str(tmp_path / "source")
    batches(spark)[0].coalesce(1).write.parquet(source)
    read = spark.sparkContext.accumulator(0)

    def count(it):
        for part in it:
            read.add(len(part))
            yield part

    watched = spark.read.parquet(source).mapInPandas(count, SCHEMA)
    merge_observed(watched, base(tmp_path), str(tmp_path / "w"))
    assert read.value == batches(spark)[0].count()


def full(spark, table, locations):
    hourly = table.read(spark)
    highest = daily_max(hourly, locations)
    return {
        "daily_max": highest,
        "daily_stats": daily_stats(hourly, locations),
        "monthly_peak": monthly_peak(highest, ["country", "state", "city"]),
        "daily_extremes": daily_extremes(hourly, locations),
    }


@pytest.fixture()
def locations(spark):
    return spark.createDataFrame([(D(p), D(0), f"City {p % 2}", "S", "1", "C") for p in (1, 2, 3, 9)], LOCATION)


def same_marts(spark, table, summaries, locations):
    expected = full(spark, table, locations)
    for name, mart in kept_marts(spark, summaries, locations).items():
        assert mart.columns == expected[name].columns
        assert sorted(map(str, mart.collect())) == sorted(map(str, expected[name].collect())), name


def test_kept_marts_equal_full_ones(spark, tmp_path, locations):
    table = base(tmp_path)
    summaries = DaySummaries(table, str(tmp_path / "days"))
    for k, batch in enumerate(batches(spark)):
        seen = merge_observed(batch, table, str(tmp_path / f"w{k}"))
        before = {f: f for f in glob.glob(str(tmp_path / "days" / "obs_date=*" / "*.parquet"))}
        days = summaries.update(seen.added)
        assert summaries.heal(spark) == []
        same_marts(spark, table, summaries, locations)
        # Files of days that the batch didn't add to are the same files as before.
        touched = {f"obs_date={d}" for d in days}
        after = set(glob.glob(str(tmp_path / "days" / "obs_date=*" / "*.parquet")))
        assert {f for f in before if f.split("/")[-2] not in touched} <= after
    assert summaries.update(rows(spark).withColumn("obs_date", F.to_date("datetime"))) == []


def test_summaries_heal(spark, tmp_path, locations):
    import shutil

    table = base(tmp_path)
    summaries = DaySummaries(table, str(tmp_path / "days"))
    for batch in batches(spark)[:2]:
        merge_insert_only(batch, table)
    assert len(summaries.heal(spark)) == 4
    same_marts(spark, table, summaries, locations)
    merge_insert_only(batches(spark)[2], table)
    assert [d.day for d in summaries.heal(spark)] == [1, 20]
    shutil.rmtree(tmp_path / "base" / "obs_date=2024-01-20")
    assert [d.day for d in summaries.heal(spark)] == [20] and summaries.heal(spark) == []
    same_marts(spark, table, summaries, locations)


def test_only_touched_days_are_read(spark, tmp_path):
    table = base(tmp_path)
    summaries = DaySummaries(table, str(tmp_path / "days"))
    plans = []
    summaries.update(table.conform(batches(spark)[0]))
    from obsflow.sinks.day_tables import DayTable

    replace = DayTable.replace
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(DayTable, "replace", lambda self, r: (plans.append(r._jdf.queryExecution().executedPlan().toString()), replace(self, r)))
        summaries.update(table.conform(rows(spark, (1, 2, 0, 0, 5))))
    scan = next(line for line in plans[0].splitlines() if "FileScan" in line)
    wanted = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "2024-01-02" in wanted and "2024-01-03" not in wanted


def test_a_store_with_a_grain(spark, tmp_path, locations):
    store = WeatherStore(str(tmp_path / "store"), grain=3600)
    merge_insert_only(locations, store.location)
    landing = tmp_path / "landing"
    for run, temps in (("1", [1, 2, None]), ("2", [9, 9, 9, 4])):
        land(landing / run, "a", document(1, temps, 1, 0))
        land(landing / run, "b", document(2 + int(run), temps, 2, 0))
        for _ in range(2):
            seen = load_documents(spark, read_weather_documents(spark, str(landing / run)), store, run)
    assert seen["hourly_weather"].appended == 0
    marts = publish_kept_marts(spark, store)
    expected = full(spark, store.hourly, locations)
    for name, mart in marts.items():
        assert sorted(map(str, spark.table(f"kept_{name}").collect())) == sorted(map(str, expected[name].collect()))
    with pytest.raises(ValueError):
        publish_kept_marts(spark, WeatherStore(str(tmp_path / "store")))
    with pytest.raises(ValueError):
        WeatherStore("db", grain=3600).hourly_keys


def test_values_that_do_not_fit_are_counted_and_set_aside(spark, tmp_path):
    store = WeatherStore(str(tmp_path / "store"), grain=3600)
    bad = document(1, [1, 1e15, 3])
    bad["hourly"][2]["pressure"] = 1e14
    land(tmp_path / "landing", "a", json.dumps(bad))
    documents = read_weather_documents(spark, str(tmp_path / "landing"))
    with pytest.raises(QualityError, match="temp does not fit"):
        load_documents(spark, documents, store, "r")
    seen = load_documents(spark, documents, store, "r", strict=False)
    assert seen["hourly_weather"].broken == {"temp does not fit": 1, "pressure does not fit": 1}
    assert store.hourly.read(spark).count() == 1
    aside = spark.read.json(f"{store.rejected('r')}-hourly_weather").collect()
    assert sorted(r.broken[0] for r in aside) == ["pressure does not fit", "temp does not fit"]


def test_schema_of_hourly_table_has_a_place_and_a_moment():
    assert [f for f in HOURLY_KEY if f in HOURLY_WEATHER.names] == HOURLY_KEY
