from __future__ import annotations

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from obsflow.operators.nearest import DEPTH, nearest_location, write_place_index
from obsflow.schemas import LOCATION


def decimal(value):
    return Decimal(f"{value:.4f}")


def chord(a, b):
    (x1, y1, z1), (x2, y2, z2) = (
        (math.cos(math.radians(lat)) * math.cos(math.radians(lon)),
         math.cos(math.radians(lat)) * math.sin(math.radians(lon)),
         math.sin(math.radians(lat)))
        for lat, lon in ((float(p[0]), float(p[1])) for p in (a, b)))
    return (x1 - x2) ** 2 + (y1 - y2) ** 2 + (z1 - z2) ** 2


def places():
    """A dense town, a sparse world, both poles and both sides of the date line."""
    rng = random.Random(5)
    found = {(decimal(52 + rng.random() * 0.02), decimal(13 + rng.random() * 0.02)) for _ in range(300)}
    found |= {(decimal(rng.uniform(-90, 90)), decimal(rng.uniform(-180, 180))) for _ in range(60)}
    found |= {(decimal(90), decimal(0)), (decimal(-90), decimal(0)), (decimal(10), decimal(179.999)),
              (decimal(10.5), decimal(-179.999)), (decimal(0), decimal(0))}
    return sorted(found)


def points():
    rng = random.Random(6)
    found = [(decimal(rng.uniform(-90, 90)), decimal(rng.uniform(-180, 180))) for _ in range(60)]
    found += [(decimal(52 + rng.random() * 0.03), decimal(13 + rng.random() * 0.03)) for _ in range(40)]
    found += [(decimal(52.2), decimal(13.2)), (decimal(89.9), decimal(170)), (decimal(10.2), decimal(-179.9)),
              (decimal(-89.99), decimal(-90)), (decimal(10), decimal(180))]
    return found


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rows = [(lat, lon, f"{lat},{lon}", None, None, "X") for lat, lon in places()]
    gazetteer = spark.createDataFrame(rows, LOCATION)
    return write_place_index(gazetteer, str(tmp_path_factory.mktemp("places") / "index"))


def test_same_as_trying_every_place(spark, index):
    asked = points()
    frame = spark.createDataFrame(asked + asked[:5], "latitude decimal(9,6), longitude decimal(9,6)")
    found = nearest_location(frame, index).collect()
    assert len(found) == len(asked)
    everywhere = places()
    for row in found:
        here = (row.latitude, row.longitude)
        best = min(chord(here, place) for place in everywhere)
        lat, lon = row.city.split(",")
        assert chord(here, (lat, lon)) <= best * (1 + 1e-9) + 1e-18


def test_unknown_coordinates_stay(spark, index):
    frame = spark.sql("SELECT CAST(NULL AS DECIMAL(9,6)) AS latitude, CAST(1 AS DECIMAL(9,6)) AS longitude")
    row = nearest_location(frame, index).first()
    assert row.country is None and row.longitude == 1


def test_smallest_cubes_hold_few_places(index):
    crowded = index.filter(F.col("level") == DEPTH + 1).groupBy("parent").agg(F.count("*").alias("n"))
    assert crowded.agg(F.max("n")).first()[0] <= 40


def test_each_search_step_reads_its_own_level(spark, index):
    frame = spark.createDataFrame(points()[:2], "latitude decimal(9,6), longitude decimal(9,6)")
    plan = nearest_location(frame, index)._jdf.queryExecution().executedPlan().toString()
    assert all(f"(level#" in plan and f" = {level})" in plan for level in range(1, DEPTH + 2))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
