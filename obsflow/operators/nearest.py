"""The nearest place of a gazetteer, exactly, without pairing points with places.

Places are put into a tree of cubes around the unit sphere, each level cutting a cube into
512, of which a sphere meets about a fifth. The tree is a table with one row per occupied cube and one place in it. A search goes
down level by level as a join of (point, cube) with the cubes below. The distance to the place
known of any cube bounds the nearest from above, the distance to the cube itself from below, so a
cube farther than the best place known is dropped. Few cubes per point are left at each
level, however many places a cube holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsflow.functions.scalars import as_coordinate
from obsflow.operators.enrich import ADDRESS, fullest_address
from obsflow.operators.rounded_join import ROUNDED_KEY, keyed_locations

# Each level splits an axis in 8; the smallest cube measures about 50 m. Places are distinct at
# four decimals (11 m), so it holds a few dozen at most.
AXIS_BITS = 3
DEPTH = 6
LEAF_BITS = AXIS_BITS * DEPTH
# Levels whose cubes are few whatever the data: at most 512 ** 2.
SMALL_LEVELS = 2
# Cubes are widened by this much, far more than rounding errors can amount to.
SLACK = 1e-12
AXES = ("x", "y", "z")


def _on_sphere(latitude: Column, longitude: Column) -> dict[str, Column]:
    lat, lon = (F.radians(c.cast("double")) for c in (latitude, longitude))
    return {"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)}


def _leaf(axis: str) -> Column:
    steps = 1 << LEAF_BITS
    place = F.floor((F.col(axis) + 1.0) * (steps / 2))
    return F.least(place, F.lit(steps - 1).cast("long")).alias(f"_{axis}")


def _cube(level: str) -> Column:
    """The number of the cube at a level, from the smallest steps of its axes."""
    drop = f"{AXIS_BITS} * ({DEPTH} - ({level}))"
    x, y, z = (f"shiftright(_{axis}, {drop})" for axis in AXES)
    return F.expr(f"shiftleft({x}, {2 * LEAF_BITS}) | shiftleft({y}, {LEAF_BITS}) | {z}")


def write_place_index(gazetteer: DataFrame, folder: str) -> DataFrame:
    """Build the tree of a gazetteer and store it, partitioned by level.

    Built once per gazetteer: a single aggregation of (level, cube), reduced by each task
    before the shuffle. The last level holds the places and their addresses.
    """
    places = (
        keyed_locations(gazetteer)
        .groupBy(*ROUNDED_KEY)
        .agg(fullest_address().alias("address"))
        .dropna(subset=ROUNDED_KEY)
        .withColumns(_on_sphere(*(F.col(c) for c in ROUNDED_KEY)))
        .select("*", *[_leaf(axis) for axis in AXES])
    )
    known = F.struct(*ROUNDED_KEY, *AXES)
    cubes = (
        places.select(
            *ROUNDED_KEY, *AXES, *[f"_{axis}" for axis in AXES],
            F.explode(F.sequence(F.lit(1), F.lit(DEPTH))).alias("level"),
        )
        .select(
            "level", _cube("level - 1").alias("parent"), _cube("level").alias("cube"),
            known.alias("known"),
        )
        .groupBy("level", "parent", "cube")
        .agg(F.min("known").alias("known"))
        .withColumn("address", F.lit(None).cast(places.schema["address"].dataType))
    )
    leaves = places.select(
        F.lit(DEPTH + 1).alias("level"), _cube(str(DEPTH)).alias("parent"),
        F.lit(None).cast("long").alias("cube"), known.alias("known"), "address",
    )
    index = cubes.unionByName(leaves)
    index.write.mode("overwrite").partitionBy("level").parquet(folder)
    return read_place_index(gazetteer.sparkSession, folder)


def read_place_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(folder)


def _squared(gaps: list[Column]) -> Column:
    total = gaps[0] * gaps[0]
    for gap in gaps[1:]:
        total = total + gap * gap
    return total


def _to_place() -> Column:
    return _squared([F.col(axis) - F.col(f"known.{axis}") for axis in AXES])


def _to_cube(level: int) -> Column:
    bits = AXIS_BITS * level
    width = 2.0 / (1 << bits)
    mask = (1 << LEAF_BITS) - 1
    gaps = []
    for position, axis in enumerate(AXES):
        step = F.expr(f"shiftright(next, {LEAF_BITS * (2 - position)}) & {mask}L")
        low = step * F.lit(width) - 1.0
        gaps.append(
            F.greatest(
                low - SLACK - F.col(axis),
                F.col(axis) - (low + width + SLACK),
                F.lit(0.0),
            )
        )
    return _squared(gaps)


def _largest_cubes() -> Column:
    steps = range(1 << AXIS_BITS)
    numbers = [
        x << 2 * LEAF_BITS | y << LEAF_BITS | z for x in steps for y in steps for z in steps
    ]
    return F.array(*[F.lit(n).cast("long") for n in numbers])


def nearest_location(points: DataFrame, index: DataFrame) -> DataFrame:
    """Each distinct coordinate with the address of its nearest place.

    Places equally near are told apart by coordinates, the smaller first. Coordinates
    are null-safe: a point without them comes back without an address.
    """
    key = ["latitude", "longitude"]
    distinct_points = points.select(
        as_coordinate(F.col("latitude")).alias("latitude"),
        as_coordinate(F.col("longitude")).alias("longitude"),
    ).distinct()
    state = (
        distinct_points.dropna()
        .withColumns(_on_sphere(F.col("latitude"), F.col("longitude")))
        .withColumn("cube", F.explode(_largest_cubes()))
    )
    for level in range(1, DEPTH + 1):
        # The search starts at all cubes of the first level, then goes from parent to child.
        above = "cube" if level == 1 else "parent"
        below = index.filter(F.col("level") == level).select(
            F.col(above).alias("cube"), F.col("cube").alias("next"), "known"
        )
        if level <= SMALL_LEVELS:
            below = F.broadcast(below)
        best = F.min("_upper").over(Window.partitionBy(*key))
        state = (
            state.join(below, "cube")
            .withColumn("_upper", _to_place())
            .withColumn("_lower", _to_cube(level))
            .withColumn("_best", best)
            .filter(F.col("_lower") <= F.col("_best"))
            .select(*key, *AXES, F.col("next").alias("cube"))
        )
    places = index.filter(F.col("level") == DEPTH + 1).select(
        F.col("parent").alias("cube"), "known", "address"
    )
    rank = F.struct(_to_place().alias("distance"), *[f"known.{c}" for c in ROUNDED_KEY])
    nearest = (
        state.join(places, "cube")
        .groupBy(*key)
        .agg(F.min_by("address", rank).alias("address"))
    )
    return distinct_points.join(nearest, key, "left").select(
        *key, *[F.col(f"address.{name}").alias(name) for name in ADDRESS]
    )
