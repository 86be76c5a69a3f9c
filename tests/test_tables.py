from __future__ import annotations

import pytest
from pyspark.sql import types as T

from obsflow import session
from obsflow.plans.report import show_view
from obsflow.sinks.files import (
    append_headerless_csv,
    land_documents,
    preview,
    write_headerless_csv,
)
from obsflow.sinks.tables import (
    create_table,
    create_view,
    publish_view,
    reload_table,
    truncate_table,
    write_layer,
)
from obsflow.sources.tables import (
    read_headerless_csv,
    read_layer,
    read_query,
    read_remote_ranges,
)

SCHEMA = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("size", T.DecimalType(9, 6))]
)


@pytest.fixture()
def rows(spark):
    return spark.sql(
        "SELECT * FROM VALUES ('a, b', CAST(1.5 AS DECIMAL(9,6))), (NULL, NULL), ('quote\"d', 2) AS t(name, size)"
    )


def test_csv_keeps_commas_quotes_and_nulls(spark, rows, tmp_path):
    path = str(tmp_path / "csv")
    write_headerless_csv(rows, path)
    write_headerless_csv(rows.repartition(3), path, single_file=True)
    assert len(list((tmp_path / "csv").glob("part-*.csv"))) == 1
    again = read_headerless_csv(spark, path, SCHEMA)
    assert sorted(map(str, again.collect())) == sorted(map(str, rows.select(
        "name", rows["size"].cast("decimal(9,6)")).collect()))


def test_csv_append(spark, rows, tmp_path):
    path = str(tmp_path / "csv")
    append_headerless_csv(rows, path)
    append_headerless_csv(rows, path)
    assert read_headerless_csv(spark, path, SCHEMA).count() == 6


def test_landed_run_folder(spark, rows, tmp_path):
    land_documents(rows, str(tmp_path), "20240101000000")
    assert spark.read.json(str(tmp_path)).first().run == 20240101000000


def test_catalog_table(spark, rows):
    create_table(spark, "cat_sizes", SCHEMA)
    create_table(spark, "cat_sizes", SCHEMA)
    reload_table(rows.select("size", "name"), "cat_sizes")
    reload_table(rows, "cat_sizes")
    assert spark.table("cat_sizes").count() == 3
    create_view(spark, "cat_big", "SELECT name FROM cat_sizes WHERE size > 1.6")
    create_view(spark, "cat_big", "SELECT name, size FROM cat_sizes WHERE size > 1.7")
    assert [r.name for r in read_query(spark, "SELECT * FROM cat_big").collect()] == ['quote"d']
    truncate_table(spark, "cat_sizes")
    assert spark.table("cat_sizes").isEmpty() and spark.table("cat_big").isEmpty()
    spark.sql("DROP VIEW cat_big")
    spark.sql("DROP TABLE cat_sizes")


def test_layer_overwrite_with_and_without_old_columns(spark, tmp_path):
    root = str(tmp_path)
    write_layer(spark.sql("SELECT 1 AS a, 'x' AS b"), root, "bronze", "e", evolve=True)
    write_layer(spark.sql("SELECT 2 AS a, 3.5D AS c"), root, "bronze", "e", evolve=True)
    frame = read_layer(spark, root, "bronze", "e")
    assert frame.columns == ["a", "b", "c"] and tuple(frame.first()) == (2, None, 3.5)
    write_layer(spark.sql("SELECT 4 AS a"), root, "bronze", "e")
    assert read_layer(spark, root, "bronze", "e").columns == ["a"]


def test_preview_and_report(spark, rows, capfd):
    preview(rows, 2)
    assert "only showing top 2 rows" in capfd.readouterr().out
    publish_view(rows, "report_rows")
    frame = show_view(spark, "report_rows")
    printed = capfd.readouterr().out
    assert frame.count() == 3 and "a, b" in printed and "|-- size: decimal" in printed


class _Reader:
    """Stands in for the reader of a remote database and keeps what it is told."""

    def __init__(self):
        self.told = {}

    def format(self, name):
        self.told["format"] = name
        return self

    def options(self, **given):
        self.told |= given
        return self

    def option(self, key, value):
        self.told[key] = value
        return self

    def load(self):
        return self.told


class _Session:
    def __init__(self):
        self.read = _Reader()


LOGIN = {"url": "jdbc:x://host/db", "user": "u", "password": "p", "driver": "d"}


def test_remote_query_is_sent_as_text():
    told = read_query(_Session(), "SELECT * FROM v", LOGIN)
    assert told == {"format": "jdbc", **LOGIN, "query": "SELECT * FROM v"}


def test_remote_table_in_ranges():
    told = read_remote_ranges(_Session(), "t", LOGIN, "id", 0, 1000, 16)
    assert told == {
        "format": "jdbc", **LOGIN, "dbtable": "t", "partitionColumn": "id",
        "lowerBound": "0", "upperBound": "1000", "numPartitions": "16",
    }


class _Conf(dict):
    def set(self, key, value):
        self[key] = value


class _Cluster:
    def __init__(self, master, **conf):
        self.conf = _Conf(conf)
        self.sparkContext = type("Context", (), {"master": master})


def test_work_folders():
    cluster = _Cluster("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    assert session.work_folder(cluster, "x").startswith("hdfs:///shared/x-")
    assert session.work_folder(cluster, "x") != session.work_folder(cluster, "x")
    assert session.staging_folder(cluster, "s") == session.staging_folder(cluster, "s")
    assert session.staging_folder(cluster, "s") != session.staging_folder(cluster, "t")
    with pytest.raises(RuntimeError):
        session.work_folder(_Cluster("yarn"), "x")
    local = _Cluster("local[2]")
    session.work_folder(local, "x")
    assert local.conf["spark.checkpoint.dir"]


TEXTS = [" blank at the ends ", 'quote " and, comma', "back\\slash \\n \\\\n", "two\nlines\r\nthree", "\\", '"', "tab\t", "\\\n"]


def test_csv_keeps_any_text(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "n int, t string")
    write_headerless_csv(rows, path)
    again = read_headerless_csv(spark, path, rows.schema)
    assert sorted(map(tuple, again.collect())) == list(enumerate(TEXTS))


def test_csv_lines_that_are_no_rows(spark, tmp_path):
    path = str(tmp_path / "csv")
    lines = ["a,1", "b,x", "c", "d,2,3", ",4"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    schema = "t string, n int"
    schema = spark.createDataFrame([], schema).schema
    found = read_headerless_csv(spark, path, schema, corrupt="bad").collect()
    assert sorted((r.bad or "") for r in found) == ["", "", "b,x", "c", "d,2,3"]
    assert sorted(((r.t, r.n) for r in found if r.bad is None), key=str) == [("a", 1), (None, 4)]
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        read_headerless_csv(spark, path, schema).collect()
