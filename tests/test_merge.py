from __future__ import annotations

import datetime as dt
import glob
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from obsflow.operators import merge
from obsflow.operators.merge import (
    except_rows,
    first_per_key,
    merge_insert_only,
    new_keys_of_small,
    new_rows,
)
from obsflow.operators.quality import (
    QualityError,
    assert_clean,
    duplicate_keys,
    null_counts,
    over_length,
)
from obsflow.sinks.tables import BaseTable

SCHEMA = T.StructType(
    [
        T.StructField("place", T.StringType()),
        T.StructField("moment", T.TimestampType()),
        T.StructField("temp", T.DecimalType(18, 6)),
    ]
)
KEYS = ["place", "moment"]


def rows(spark, *data):
    return spark.createDataFrame(
        [(p, dt.datetime(2024, 1, day, hour), None if t is None else Decimal(t))
         for p, day, hour, t in data],
        SCHEMA,
    )


@pytest.fixture(params=["path", "catalog"])
def table(spark, tmp_path, request):
    name = f"base_{tmp_path.name.replace('-', '_')}"
    location = str(tmp_path / "base") if request.param == "path" else name
    yield BaseTable(location, SCHEMA, KEYS, KEYS, partition="day", partition_from="moment")
    if request.param == "catalog":
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def state(spark, table):
    return sorted((r.place, r.moment.day, r.moment.hour, str(r.temp)) for r in table.read(spark).collect())


def test_first_writer_wins(spark, table):
    merge_insert_only(rows(spark, ("a", 1, 0, 1), ("b", 1, 0, 2)), table)
    merge_insert_only(rows(spark, ("a", 1, 0, 9), ("a", 2, 0, 3)), table)
    assert state(spark, table) == [
        ("a", 1, 0, "1.000000"), ("a", 2, 0, "3.000000"), ("b", 1, 0, "2.000000"),
    ]


def test_rerun_changes_nothing(spark, table):
    batch = rows(spark, ("a", 1, 0, 1), ("b", 2, 5, None))
    merge_insert_only(batch, table)
    once = state(spark, table)
    merge_insert_only(batch, table)
    assert state(spark, table) == once


def test_disjoint_batches_in_any_order(spark, tmp_path):
    first, second = rows(spark, ("a", 1, 0, 1)), rows(spark, ("a", 2, 0, 2))
    states = []
    for label, order in (("x", (first, second)), ("y", (second, first))):
        table = BaseTable(str(tmp_path / label), SCHEMA, KEYS, KEYS, "day", "moment")
        for batch in order:
            merge_insert_only(batch, table)
        states.append(state(spark, table))
    assert states[0] == states[1]


def test_repeated_key_in_a_batch(spark, table):
    batch = rows(spark, ("a", 1, 0, 5), ("a", 1, 0, 4))
    with pytest.raises(QualityError, match="more than once"):
        merge_insert_only(batch, table)
    assert state(spark, table) == []
    merge_insert_only(batch, table, on_duplicate="first")
    assert state(spark, table) == [("a", 1, 0, "4.000000")]
    with pytest.raises(ValueError):
        merge_insert_only(batch, table, on_duplicate="last")


def test_null_key_and_long_text_are_refused(spark, table):
    with pytest.raises(QualityError, match="place is null"):
        merge_insert_only(rows(spark, (None, 1, 0, 1)), table)
    with pytest.raises(QualityError, match="place is too long"):
        merge_insert_only(rows(spark, ("x" * 256, 1, 0, 1)), table)
    merge_insert_only(rows(spark, ("x" * 255, 1, 0, 1)), table)


def test_empty_batch(spark, table):
    merge_insert_only(rows(spark), table)
    assert state(spark, table) == []


def test_batch_columns_go_by_name(spark, table):
    batch = rows(spark, ("a", 1, 0, 1)).select("temp", "moment", "place")
    merge_insert_only(batch, table)
    assert state(spark, table) == [("a", 1, 0, "1.000000")]


def test_only_the_days_of_the_batch_are_read(spark, tmp_path, monkeypatch):
    table = BaseTable(str(tmp_path / "base"), SCHEMA, KEYS, KEYS, "day", "moment")
    merge_insert_only(rows(spark, *[("a", day, 0, day) for day in range(1, 11)]), table)
    assert len(glob.glob(str(tmp_path / "base" / "day=*"))) == 10
    plans = []
    append = BaseTable.append
    monkeypatch.setattr(
        BaseTable, "append",
        lambda self, added: (plans.append(added._jdf.queryExecution().toString()), append(self, added)),
    )
    merge_insert_only(rows(spark, ("a", 3, 0, 0), ("a", 4, 1, 0)), table)
    filters = plans[0].split("PartitionFilters: [")[1].split("]")[0]
    assert ">= 2024-01-03" in filters and "<= 2024-01-04" in filters
    assert table.read(spark).count() == 11


def test_first_per_key_does_not_depend_on_partitioning(spark):
    data = [("a", 1, 0, n) for n in (3, 1, 2)] + [("b", 1, 0, 7)]
    expected = {("a", "1.000000"), ("b", "7.000000")}
    for parts in (1, 3, 7):
        kept = first_per_key(rows(spark, *data).repartition(parts), KEYS)
        assert {(r.place, str(r.temp)) for r in kept.collect()} == expected


def test_hot_keys_are_reduced_before_the_shuffle(spark):
    plan = first_per_key(rows(spark, ("a", 1, 0, 1)), KEYS)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_new_rows_is_pure(spark):
    target = rows(spark, ("a", 1, 0, 1))
    batch = rows(spark, ("a", 1, 0, 2), ("b", 1, 0, 3), ("b", 1, 0, 4))
    added = new_rows(batch, target, KEYS).collect()
    assert [(r.place, str(r.temp)) for r in added] == [("b", "3.000000")]


def test_except_treats_nulls_as_equal(spark):
    batch = rows(spark, ("a", 1, 0, None), ("a", 1, 0, None), ("b", 1, 0, 1), ("b", 1, 0, 1))
    left = except_rows(batch, rows(spark, ("a", 1, 0, None)))
    assert [(r.place, str(r.temp)) for r in left.collect()] == [("b", "1.000000")]


def test_quality_reports(spark):
    data = rows(spark, ("a", 1, 0, None), ("a", 1, 0, 1), (None, 2, 0, 1), ("toolong", 3, 0, 1))
    assert [r.rows for r in duplicate_keys(data, KEYS).collect()] == [2]
    assert {r.column_name: r.nulls for r in null_counts(data, ["place", "temp"]).collect()} == {
        "place": 1, "temp": 1,
    }
    assert over_length(data, ["place"], 3).first().too_long == 1
    with pytest.raises(QualityError, match="temp is null"):
        assert_clean(data, ["temp"], [])


def test_a_day_that_holds_the_whole_batch_is_written_by_several_tasks(spark, tmp_path):
    table = BaseTable(str(tmp_path / "base"), SCHEMA, KEYS, KEYS, "day", "moment")
    batch = spark.range(20000, numPartitions=4).selectExpr(
        "CAST(xxhash64(id) AS STRING) AS place", "TIMESTAMP '2024-01-01 00:00:00' AS moment",
        "CAST(id AS DECIMAL(18,6)) AS temp")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "64k")
    try:
        merge_insert_only(batch, table)
    finally:
        spark.conf.unset(size)
    assert len(glob.glob(str(tmp_path / "base" / "day=2024-01-01" / "*.parquet"))) > 1
    assert table.read(spark).count() == 20000


def test_except_is_one_shuffle(spark):
    batch = rows(spark, ("a", 1, 0, 1))
    plan = except_rows(batch, batch)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_merge_shuffles_the_batch_once_before_writing(spark, tmp_path):
    table = BaseTable(str(tmp_path / "base"), SCHEMA, KEYS, KEYS)
    table.create(spark)
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    try:
        batch = table.conform(rows(spark, ("a", 1, 0, 1)))
        plan = new_rows(batch, table.read(spark), KEYS)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset(threshold)
    assert plan.count("Exchange hashpartitioning") == 2


def test_a_small_batch_does_not_shuffle_the_base(spark, tmp_path):
    table = BaseTable(str(tmp_path / "base"), SCHEMA, KEYS, KEYS)
    table.append(table.conform(spark.range(5000).selectExpr(
        "concat('p', id) AS place", "timestamp_seconds(id) AS moment", "CAST(1 AS DECIMAL(18,6)) AS temp")))
    table.conform(rows(spark, ("a", 1, 0, 1))).write.parquet(str(tmp_path / "batch"))
    batch = spark.read.parquet(str(tmp_path / "batch"))
    found = new_keys_of_small(batch, table.read(spark), KEYS)
    assert len(found.collect()) == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_broken_rows_are_set_aside(spark, tmp_path):
    table = BaseTable(str(tmp_path / "base"), SCHEMA, KEYS, KEYS)
    batch = rows(spark, ("a", 1, 0, 1), (None, 1, 0, 2), ("x" * 300, 2, 0, 3))
    with pytest.raises(QualityError):
        merge_insert_only(batch, table)
    merge_insert_only(batch, table, quarantine=str(tmp_path / "aside"))
    assert [r.place for r in table.read(spark).collect()] == ["a"]
    broken = spark.read.json(str(tmp_path / "aside")).collect()
    assert sorted(r.broken[0] for r in broken) == ["place is null", "place is too long"]


@pytest.mark.parametrize("few", [0, 100])
def test_large_batch_keeps_the_first_of_repeated_keys(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(merge, "SMALL_BATCH", 0)
    monkeypatch.setattr(merge, "FEW_REPEATED", few)
    table = BaseTable(str(tmp_path / "t"), SCHEMA, KEYS, partition="day", partition_from="moment")
    merge_insert_only(rows(spark, ("a", 1, 0, "2"), ("a", 1, 0, "1"), ("b", 1, 0, "5"), ("c", 2, 3, None), ("c", 2, 3, "4")), table, "first")
    stored = {(r.place, r.moment.day): r.temp for r in table.read(spark).collect()}
    assert stored == {("a", 1): Decimal(1), ("b", 1): Decimal(5), ("c", 2): None}
    merge_insert_only(rows(spark, ("a", 1, 0, "0"), ("d", 1, 0, "9"), ("d", 1, 0, "8"), ("b", 2, 0, "3"), ("a", 1, 0, "7")), table, "first")
    stored = sorted((r.place, r.moment.day, r.temp) for r in table.read(spark).filter("place <> 'c'").collect())
    assert stored == [("a", 1, Decimal(1)), ("b", 1, Decimal(5)), ("b", 2, Decimal(3)), ("d", 1, Decimal(8))]
    assert table.read(spark).count() == 5


def test_large_batch_with_null_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merge, "SMALL_BATCH", 0)
    table = BaseTable(str(tmp_path / "t"), SCHEMA, KEYS)
    batch = rows(spark, (None, 1, 0, "2"), (None, 1, 0, "1"), ("b", 1, 0, "5"))
    for times in (1, 2):
        merge_insert_only(batch, table, "first")
        # A null is equal to a null in a batch, but never found in the table.
        assert sorted((r.place or "", r.temp) for r in table.read(spark).collect()) == [("", Decimal(1))] * times + [("b", Decimal(5))]


def test_large_batch_is_sorted_and_joined_only_where_it_must(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merge, "SMALL_BATCH", 0)
    sizes = []
    monkeypatch.setattr(merge, "first_per_key", lambda batch, *more: sizes.append(batch.count()) or first_per_key(batch, *more))
    monkeypatch.setattr(merge, "new_keys", lambda *_: pytest.fail("nothing or everything is stored"))
    table = BaseTable(str(tmp_path / "t"), SCHEMA, KEYS, partition="day", partition_from="moment")
    batch = rows(spark, *[("p", 1 + n % 20, n // 20, str(n)) for n in range(100)], ("p", 1, 0, "-1"))
    for _ in range(2):
        merge_insert_only(batch, table, "first")
        assert table.read(spark).count() == 100
    assert sizes == [2]
