from __future__ import annotations

import datetime as dt
import json

import pytest

from obsflow.operators.bundles import explode_entries, pages, patient_silver, reconcile_totals
from obsflow.plans.clinical import patient_to_silver, raw_to_bronze
from obsflow.schemas import PATIENT_ENTRY
from obsflow.sinks.files import as_columnar, land_documents
from obsflow.sources.documents import read_bundles
from obsflow.sources.tables import read_layer


def entry(number, **fields):
    return {"resource": {"id": str(number), "resourceType": "Patient", **fields},
            "search": {"mode": "match"}}


ONE = {"total": 2, "entry": [entry(1), entry(2)]}
TWO = {"total": 3, "entry": [entry(2), entry(3)]}


def columnar(*bundles):
    names = bundles[0].keys()
    return {name: {str(i): b[name] for i, b in enumerate(bundles)} for name in names}


def write(folder, *documents):
    folder.mkdir(parents=True, exist_ok=True)
    for i, document in enumerate(documents):
        (folder / f"{i}.json").write_text(json.dumps(document))
    return str(folder)


def ids(entries):
    return sorted(r.id for r in entries.select("data.resource.id").collect())


@pytest.mark.parametrize("schema", [None, PATIENT_ENTRY])
@pytest.mark.parametrize("layout", ["plain", "columnar"])
@pytest.mark.parametrize("told", [True, False])
def test_both_layouts(spark, tmp_path, schema, layout, told):
    wrap = columnar if layout == "columnar" else lambda bundle: bundle
    path = write(tmp_path / "b", wrap(ONE), wrap(ONE), wrap(TWO))
    bundles = read_bundles(spark, path, schema, layout if told else "auto")
    if schema is not None:
        row = reconcile_totals(bundles, []).first()
        assert (row.declared, row.extracted) == (7, 6)
    assert ids(explode_entries(bundles, "page")) == ["1", "2", "2", "3"]
    assert ids(explode_entries(bundles, "entry")) == ["1", "2", "3"]
    assert ids(explode_entries(bundles, None)) == ["1", "1", "2", "2", "2", "3"]


@pytest.mark.parametrize("schema", [None, PATIENT_ENTRY])
def test_several_row_labels(spark, tmp_path, schema):
    path = write(tmp_path / "b", columnar(ONE, TWO, ONE))
    assert ids(explode_entries(read_bundles(spark, path, schema))) == ["1", "2", "2", "3"]


def test_mixed_folder_and_missing_entries(spark, tmp_path):
    path = write(tmp_path / "b", ONE, columnar(TWO), {"total": 0, "entry": []}, {"total": 0})
    bundles = read_bundles(spark, path, PATIENT_ENTRY)
    assert ids(explode_entries(bundles)) == ["1", "2", "2", "3"]
    assert sorted(r.total for r in bundles.collect()) == [0, 0, 2, 3]


def test_unknown_dedupe(spark, tmp_path):
    bundles = read_bundles(spark, write(tmp_path / "b", ONE), PATIENT_ENTRY)
    with pytest.raises(ValueError):
        explode_entries(bundles, "row")
    with pytest.raises(ValueError):
        read_bundles(spark, str(tmp_path), PATIENT_ENTRY, "rows")


def test_pages_are_deduplicated_by_tasks_first(spark, tmp_path):
    bundles = read_bundles(spark, write(tmp_path / "b", ONE), PATIENT_ENTRY)
    plan = pages(bundles).distinct()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "collect_set" not in plan


def test_columnar_sink_round_trip(spark, tmp_path):
    plain = read_bundles(spark, write(tmp_path / "b", ONE, TWO))
    land_documents(as_columnar(plain), str(tmp_path / "c"))
    again = read_bundles(spark, str(tmp_path / "c"), PATIENT_ENTRY)
    assert ids(explode_entries(again)) == ["1", "2", "2", "3"]


@pytest.mark.parametrize("schema", [None, PATIENT_ENTRY])
def test_reconcile(spark, tmp_path, schema):
    bundles = read_bundles(spark, write(tmp_path / "b", ONE, TWO), schema)
    row = reconcile_totals(bundles, []).first()
    assert (row.declared, row.extracted, row.missing) == (5, 4, 1)


def test_patient_silver_types(spark, tmp_path):
    bundle = {"total": 3, "entry": [
        entry(7, birthDate="1980-02-29", active=True,
              name=[{"family": "Doe", "given": ["J"]}]),
        entry("abc", birthDate="not a date"),
        entry(7, birthDate="1980-02-29", active=True,
              name=[{"family": "Doe", "given": ["J"]}]),
    ]}
    bronze = explode_entries(read_bundles(spark, write(tmp_path / "b", bundle), PATIENT_ENTRY))
    silver = patient_silver(bronze)
    assert silver.columns == [
        "id", "active", "name", "resourceType", "address", "birthdate", "careProvider", "gender",
        "identifier", "managingOrganization", "maritalStatus", "meta", "telecom", "search",
    ]
    rows = {r.id: r for r in silver.collect()}
    assert set(rows) == {7, None} and silver.count() == 2
    assert rows[7].birthdate == dt.date(1980, 2, 29) and rows[7].name[0].family == "Doe"
    assert rows[None].birthdate is None


def test_layers(spark, tmp_path):
    write(tmp_path / "raw" / "patient", ONE, columnar(ONE), TWO)
    write(tmp_path / "raw" / "location", {"total": 1, "entry": [
        {"resource": {"id": "L1", "name": "Main"}, "search": {"mode": "match"}}]})
    root = str(tmp_path)
    raw_to_bronze(spark, root, ["patient", "location"])
    raw_to_bronze(spark, root, ["patient", "location"])
    patient_to_silver(spark, root)
    assert read_layer(spark, root, "bronze", "patient").count() == 4
    assert read_layer(spark, root, "bronze", "location").first().data.resource.name == "Main"
    assert sorted(r.id for r in read_layer(spark, root, "silver", "patient").collect()) == [1, 2, 3]


def test_bronze_keeps_fields_that_later_pages_lack(spark, tmp_path):
    raw = tmp_path / "raw" / "procedure"
    write(raw, {"entry": [{"resource": {"id": "1", "code": "x"}, "search": {"mode": "match"}}]})
    raw_to_bronze(spark, str(tmp_path), ["procedure"])
    write(raw, {"entry": [{"resource": {"id": "1", "note": "y"}, "search": {"mode": "match"}}]})
    raw_to_bronze(spark, str(tmp_path), ["procedure"])
    row = read_layer(spark, str(tmp_path), "bronze", "procedure").first()
    assert (row.data.resource.code, row.data.resource.note) == (None, "y")
