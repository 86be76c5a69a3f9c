from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from obsflow.operators.bundles import SILVER, patient_silver
from obsflow.operators.entries import page_copies, split_entries, split_pages
from obsflow.plans.clinical import bundle_balance, patient_to_silver, raw_to_whole_bronze
from obsflow.sinks.tables import write_layer
from obsflow.sources.documents import read_bundle_variants
from obsflow.sources.tables import layer_path, read_layer


def entry(number, **fields):
    return {"fullUrl": f"urn:{number}", "resource": {"id": str(number), "resourceType": "Patient", **fields}, "search": {"mode": "match", "score": 0.5}}


def columnar(*bundles):
    return {name: {str(i): b[name] for i, b in enumerate(bundles)} for name in bundles[0]}


def land(root, files, resource="patient"):
    folder = root / "raw" / resource
    folder.mkdir(parents=True, exist_ok=True)
    for name, lines in files.items():
        (folder / f"{name}.json").write_text("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines))
    return str(root)


def canonical(value):
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def bronze_of(spark, root, resource="patient"):
    return read_layer(spark, root, "bronze", resource).select(F.to_json("data").alias("data")).collect()


def balances(spark, root):
    found = bundle_balance(spark, root, "patient").collect()
    return {r.source_file.rsplit("/", 1)[1]: (r.landed, r.bronze, r.rejected, r.removed, r.balanced) for r in found}


def test_entries_come_back_as_they_landed(spark, tmp_path):
    one = entry(1, contact=[{"rank": 1, "x": {"deep": [1, 2.5, None, True, "ä"]}}], meta={"tag": [{"code": "t"}]})
    root = land(tmp_path, {"a": [{"total": 2, "entry": [one, entry(2)]}]})
    raw_to_whole_bronze(spark, root, ["patient"])
    assert sorted(r.data for r in bronze_of(spark, root)) == sorted(map(canonical, [one, entry(2)]))


def test_pages_that_differ_in_an_unknown_field_only_are_two(spark, tmp_path):
    page = {"total": 1, "entry": [entry(1)]}
    other = json.loads(json.dumps(page).replace("urn:1", "urn:2"))
    turned = '{"entry": [' + json.dumps(dict(reversed(entry(1).items()))) + '],   "total": 1}'
    root = land(tmp_path, {"a": [page], "b": [other], "c": [page, turned], "d": [columnar(page, other)]})
    raw_to_whole_bronze(spark, root, ["patient"])
    assert len(bronze_of(spark, root)) == 2
    assert balances(spark, root) == {"a.json": (1, 1, 0, 0, True), "b.json": (1, 1, 0, 0, True), "c.json": (2, 0, 0, 2, True), "d.json": (2, 0, 0, 2, True)}
    removed = read_layer(spark, root, "removed", "patient").collect()
    assert {r.kept_file.rsplit("/", 1)[1] for r in removed} == {"a.json", "b.json"}


def test_everything_unusable_is_kept_with_a_reason(spark, tmp_path):
    files = {
        "cut": ['{"total": 3, "entry": [{"a"'],
        "twice": ['{"entry": [], "entry": []}'],
        "error": [{"cod": 401, "message": "no"}, [1, 2], "7"],
        "lists": [{"entry": "text"}, {"entry": {"0": [entry(1)], "1": 5, "2": None}}],
        "entries": [{"total": 4, "entry": [entry(2), 5, None, {"fullUrl": "x"}, {"resource": "x"}]}],
        "empty": [{"total": 0}, {"total": 0, "entry": []}, {"entry": None}, "", "   "],
    }
    root = land(tmp_path, files)
    raw_to_whole_bronze(spark, root, ["patient"])
    assert sorted(json.loads(r.data)["resource"]["id"] for r in bronze_of(spark, root)) == ["1", "2"]
    rejects = read_layer(spark, root, "rejected", "patient").collect()
    assert sorted((r.reason, r.text) for r in rejects) == sorted(
        [
            ("broken document", files["cut"][0]),
            ("broken document", files["twice"][0]),
            ("no bundle", json.dumps(files["error"][0])),
            ("no bundle", "[1, 2]"),
            ("no bundle", "7"),
            ("entries are no list", '{"entry": "text"}'),
            ("page is no list", "5"),
            ("page is no list", "null"),
            ("no resource", "5"),
            ("no resource", "null"),
            ("no resource", '{"fullUrl":"x"}'),
            ("no resource", '{"resource":"x"}'),
        ]
    )
    found = balances(spark, root)
    assert found == {"cut.json": (1, 0, 1, 0, True), "twice.json": (1, 0, 1, 0, True), "error.json": (3, 0, 3, 0, True), "lists.json": (4, 1, 3, 0, True), "entries.json": (5, 1, 4, 0, True)}


def test_a_lost_or_changed_entry_shows(spark, tmp_path):
    root = land(tmp_path, {"a": [{"total": 2, "entry": [entry(1), entry(2)]}], "b": [{"total": 1, "entry": [entry(3)]}]})
    raw_to_whole_bronze(spark, root, ["patient"])
    bronze = read_layer(spark, root, "bronze", "patient")
    changed = F.when(F.try_variant_get("data", "$.resource.id", "string") == "2", F.parse_json(F.lit('{"resource":{"id":"9"}}'))).otherwise(F.col("data"))
    write_layer(bronze.withColumn("data", changed), root, "bronze2", "patient")
    write_layer(read_layer(spark, root, "bronze2", "patient"), root, "bronze", "patient")
    assert balances(spark, root) == {"a.json": (2, 2, 0, 0, False), "b.json": (1, 1, 0, 0, True)}
    write_layer(read_layer(spark, root, "bronze2", "patient").filter("position = 1"), root, "bronze", "patient")
    assert balances(spark, root)["b.json"] == (1, 0, 0, 0, False)


def test_runs_repeat(spark, tmp_path):
    page = {"total": 2, "entry": [entry(1), entry(2)]}
    root = land(tmp_path, {"a": [page, page], "b": [page]})
    for _ in range(2):
        raw_to_whole_bronze(spark, root, ["patient"])
    assert len(bronze_of(spark, root)) == 2
    assert balances(spark, root) == {"a.json": (4, 2, 0, 2, True), "b.json": (2, 0, 0, 2, True)}


def test_a_document_over_several_lines(spark, tmp_path):
    root = land(tmp_path, {"a": [json.dumps({"total": 1, "entry": [entry(1)]}, indent=2)]})
    raw_to_whole_bronze(spark, root, ["patient"], multiline=True)
    assert len(bronze_of(spark, root)) == 1
    assert bundle_balance(spark, root, "patient", multiline=True).first().balanced


def test_silver_from_whole_entries(spark, tmp_path):
    first = entry(7, birthDate="1980-02-29", active=True, name=[{"family": "Doe", "given": ["J"], "period": {"start": "2001"}}], telecom=[{"rank": 1}])
    odd = entry("abc", birthDate="not a date", name="Doe", meta={"versionId": 3})
    root = land(tmp_path, {"a": [{"entry": [first, odd]}], "b": [{"entry": [first]}]})
    raw_to_whole_bronze(spark, root, ["patient"])
    patient_to_silver(spark, root)
    silver = read_layer(spark, root, "silver", "patient")
    assert silver.columns == ["id", *SILVER] and silver.count() == 2
    rows = {r.id: r for r in silver.collect()}
    assert str(rows[7].birthdate) == "1980-02-29" and rows[7].name[0].family == "Doe" and rows[7].active is True
    assert rows[None].birthdate is None and rows[None].name is None and rows[None].meta.versionId == "3"
    patient_to_silver(spark, root, nested="whole")
    whole = read_layer(spark, root, "silver", "patient")
    assert whole.columns == ["id", *SILVER] and whole.count() == 2
    texts = {r.id: r for r in whole.select("id", *[F.to_json(c).alias(c) for c in ("name", "telecom", "search")]).collect()}
    assert texts[7].name == canonical(first["resource"]["name"]) and texts[7].telecom == '[{"rank":1}]'
    assert texts[None].name == '"Doe"' and texts[None].search == '{"mode":"match","score":0.5}'
    with pytest.raises(ValueError):
        patient_silver(whole.select(F.struct("id").alias("data")), nested="whole")
    with pytest.raises(ValueError):
        patient_silver(whole, nested="cut")


def test_digests_travel_and_entries_do_not(spark, tmp_path):
    root = land(tmp_path, {"a": [{"entry": [entry(1)]}]})
    raw_to_whole_bronze(spark, root, ["patient"])
    pages = split_pages(read_bundle_variants(spark, layer_path(root, "raw", "patient")))
    folder = str(tmp_path / "pages")
    pages.write.parquet(folder)
    stored = spark.read.parquet(folder)
    plan = page_copies(stored)._jdf.queryExecution().executedPlan().toString()
    assert "entries" not in plan
    good, _ = split_entries(stored, read_layer(spark, root, "removed", "patient"))
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
