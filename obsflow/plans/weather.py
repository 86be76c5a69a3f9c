"""From landed weather documents to base tables and marts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.fixed_values import DAILY_MAX_VIEW, DAILY_STATS_VIEW
from obsflow.functions.scalars import as_coordinate
from obsflow.operators.enrich import lookup_location
from obsflow.operators.flatten import flatten_current, flatten_hourly, unfit_flags
from obsflow.operators.key_bitmaps import KeyBitmaps
from obsflow.operators.merge import merge_insert_only
from obsflow.operators.nearest import nearest_location, write_place_index
from obsflow.operators.observed import Merged, merge_observed
from obsflow.operators.screening import split_documents
from obsflow.plans.day_summaries import DaySummaries, kept_marts
from obsflow.plans.mart_views import mart_queries
from obsflow.plans.marts import daily_extremes, daily_max, daily_stats, monthly_peak
from obsflow.schemas import (
    CORRUPT_COLUMN,
    CURRENT_KEY,
    CURRENT_MEASURES,
    CURRENT_WEATHER,
    HOURLY_KEY,
    HOURLY_MEASURES,
    HOURLY_WEATHER,
    LOCATION,
    LOCATION_KEY,
)
from obsflow.session import pin_utc, staging_folder
from obsflow.sinks.day_tables import days_of
from obsflow.sinks.files import write_headerless_csv
from obsflow.sinks.tables import BaseTable, create_view, publish_view
from obsflow.sources.documents import read_weather_documents
from obsflow.sources.requests import resolve_locations
from obsflow.sources.tables import read_headerless_csv

PEAK_VIEW, EXTREMES_VIEW = "monthly_peak", "daily_extremes"


@dataclass(frozen=True)
class WeatherStore:
    """The base tables of one store.

    ``root`` is a folder when it holds a slash, else a database of the catalog. A database
    keeps its views across sessions and needs ``rejects``, a folder for rejected documents.

    With ``grain``, seconds that every hourly moment is a multiple of, loads look stored keys up in bitmaps and keep summaries per
    place and day up to date, from which ``kept_marts`` are read.
    """

    root: str
    rejects: str | None = None
    grain: int | None = None

    @property
    def is_folder(self) -> bool:
        return "/" in self.root

    def _at(self, name: str) -> str:
        return f"{self.root}/{name}" if self.is_folder else f"{self.root}.{name}"

    @property
    def location(self) -> BaseTable:
        return BaseTable(self._at("location"), LOCATION, LOCATION_KEY, LOCATION_KEY)

    @property
    def hourly(self) -> BaseTable:
        return BaseTable(
            self._at("hourly_weather"),
            HOURLY_WEATHER,
            HOURLY_KEY,
            [*HOURLY_KEY, "timezone"],
            partition="obs_date",
            partition_from="datetime",
        )

    @property
    def current(self) -> BaseTable:
        return BaseTable(
            self._at("current_weather"),
            CURRENT_WEATHER,
            CURRENT_KEY,
            [*CURRENT_KEY, "timezone"],
            partition="obs_date",
            partition_from="requested_datetime",
        )

    def _beside(self, name: str) -> str:
        if self.rejects is None and not self.is_folder:
            raise ValueError("a store in the catalog needs a folder for rejected documents")
        return f"{self.root}/{name}" if self.is_folder else f"{self.rejects}-{name}"

    @property
    def hourly_keys(self) -> KeyBitmaps | None:
        return KeyBitmaps(self.hourly, self._beside("hourly_keys"), self.grain) if self.grain else None

    @property
    def hourly_days(self) -> DaySummaries | None:
        return DaySummaries(self.hourly, self._beside("hourly_days")) if self.grain else None

    def rejected(self, run: str) -> str:
        if self.rejects is None and not self.is_folder:
            raise ValueError("a store in the catalog needs a folder for rejected documents")
        return f"{self.rejects or self.root + '/rejected'}/run={run}"


def stage(spark: SparkSession, rows: DataFrame, folder: str) -> DataFrame:
    """Write a batch once and go on from the stored copy, in the given session.

    Text is parsed a single time; checks and merges then read only the columns they need.
    """
    rows.write.mode("overwrite").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def load_documents(
    spark: SparkSession,
    documents: DataFrame,
    store: WeatherStore,
    run: str,
    on_duplicate: str = "error",
    strict: bool = True,
) -> dict[str, Merged]:
    """Screen one batch of documents and merge it into the base tables.

    ``run`` names the batch: a repeated run replaces its own rejects and adds nothing. With
    ``strict`` a row that breaks a rule of its table fails the load, as in a database; without, it is
    set aside under the rejects of the run and the others are loaded.

    Text is parsed once. In a store with a grain each table's rows are computed once too, the checks being counted while they are
    written, a value that doesn't fit its column breaks a rule (else it is null), and keys are looked up in bitmaps; what each merge saw comes back.
    """
    folder = staging_folder(spark, store.root)
    staged = stage(spark, documents, folder)
    good, rejected = split_documents(staged)
    rejected.write.mode("overwrite").json(store.rejected(run))
    seen = {}
    for name, flatten, table, measures in (
        ("hourly_weather", flatten_hourly, store.hourly, HOURLY_MEASURES),
        ("current_weather", flatten_current, store.current, CURRENT_MEASURES),
    ):
        aside = None if strict else f"{store.rejected(run)}-{name}"
        if store.grain is None:
            merge_insert_only(flatten(good), table, on_duplicate, quarantine=aside)
        else:
            hourly = table == store.hourly
            seen[name] = merge_observed(
                flatten(good, unfit=True), table, f"{folder}-{name}", on_duplicate, quarantine=aside,
                bitmaps=store.hourly_keys if hourly else None, flags=unfit_flags(measures), follow=hourly,
            )
    if store.hourly_days is not None:
        added = seen["hourly_weather"].added
        store.hourly_days.update(added)
        store.hourly_days.heal(spark, days_of(added, store.hourly.partition))
    return seen


def export_flat_csv(spark: SparkSession, landing: str | list[str], folder: str) -> None:
    """Landed documents as two folders of headerless CSV, for loading elsewhere.

    The documents are stored once and read twice, each time only the half that is needed. Rejected
    ones are kept as JSON in the folder ``rejected`` beside the two.
    """
    pin_utc(spark)
    documents = read_weather_documents(spark, landing)
    good, rejected = split_documents(stage(spark, documents, staging_folder(spark, folder)))
    rejected.write.mode("overwrite").json(f"{folder}/rejected")
    write_headerless_csv(flatten_hourly(good), f"{folder}/hourly_weather")
    write_headerless_csv(flatten_current(good), f"{folder}/current_weather")


def load_flat_csv(
    spark: SparkSession, folder: str, store: WeatherStore, on_duplicate: str = "error"
) -> None:
    """Merge two such folders into the base tables, through a staging copy of each.

    Lines that are no row of their table are kept as JSON in ``<folder>-rejected``, by table.
    """
    pin_utc(spark)
    for name, table in (("hourly_weather", store.hourly), ("current_weather", store.current)):
        rows = read_headerless_csv(spark, f"{folder}/{name}", table.schema, corrupt=CORRUPT_COLUMN)
        staged = stage(spark, rows, staging_folder(spark, f"{store.root}/{name}"))
        bad = staged.filter(F.col(CORRUPT_COLUMN).isNotNull()).select(F.col(CORRUPT_COLUMN).alias("line"))
        bad.write.mode("overwrite").json(f"{folder.rstrip('/')}-rejected/{name}")
        good = staged.filter(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)
        merge_insert_only(good, table, on_duplicate)


def publish_marts(spark: SparkSession, store: WeatherStore) -> dict[str, DataFrame]:
    """The two marts as views: stored ones in a database, else ones for this session."""
    store.hourly.create(spark)
    store.location.create(spark)
    if not store.is_folder:
        texts = mart_queries(store.hourly.location, store.location.location)
        for name, query in texts.items():
            create_view(spark, f"{store.root}.{name}", query)
        return {name: spark.table(f"{store.root}.{name}") for name in texts}
    hourly, locations = store.hourly.read(spark), store.location.read(spark)
    marts = {
        DAILY_MAX_VIEW: daily_max(hourly, locations),
        DAILY_STATS_VIEW: daily_stats(hourly, locations),
    }
    for name, mart in marts.items():
        publish_view(mart, name)
    return marts


def load_locations(
    spark: SparkSession,
    requests: DataFrame,
    gazetteer: DataFrame,
    store: WeatherStore,
    nearest: bool = False,
) -> DataFrame:
    """The location step: what was asked for, with the address of each place, added to the store's locations.

    A request with two blank coordinates stands for the default locations. Addresses come from the gazetteer's row of the same rounded
    coordinates, or with ``nearest`` from the nearest one. A coordinate that is no number in range is left out and given back, as text.
    """
    pin_utc(spark)
    wanted = resolve_locations(requests.select("latitude", "longitude"))
    typed = wanted.select(
        F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"),
        as_coordinate(F.col("latitude")).alias("latitude"), as_coordinate(F.col("longitude")).alias("longitude"),
    )
    good = F.coalesce(F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180), F.lit(False))
    places = typed.filter(good).select("latitude", "longitude")
    if nearest:
        index = write_place_index(gazetteer, f"{staging_folder(spark, store.root)}-places")
        found = nearest_location(places, index)
    else:
        found = lookup_location(places, gazetteer)
    staged = stage(spark, found, f"{staging_folder(spark, store.root)}-locations")
    merge_insert_only(staged, store.location)
    return typed.filter(~good).select(F.col("_lat").alias("latitude"), F.col("_lon").alias("longitude"))


def publish_peaks(spark: SparkSession, store: WeatherStore, locations: DataFrame | None = None) -> dict[str, DataFrame]:
    """The two marts as the documentation describes them, as views for this session: one peak per place and month, and each day's extremes over all places."""
    store.hourly.create(spark)
    store.location.create(spark)
    hourly = store.hourly.read(spark)
    places = store.location.read(spark) if locations is None else locations
    marts = {
        PEAK_VIEW: monthly_peak(daily_max(hourly, places), ["country", "state", "city"]),
        EXTREMES_VIEW: daily_extremes(hourly, places),
    }
    for name, mart in marts.items():
        publish_view(mart, name)
    return marts


def publish_kept_marts(spark: SparkSession, store: WeatherStore) -> dict[str, DataFrame]:
    """Four marts over the stored summaries of a store with a grain: both daily ones, monthly peaks and daily extremes."""
    if store.hourly_days is None:
        raise ValueError("only a store with a grain keeps summaries")
    store.location.create(spark)
    marts = kept_marts(spark, store.hourly_days, store.location.read(spark))
    for name, mart in marts.items():
        publish_view(mart, f"kept_{name}")
    return marts


def refresh_weather(
    spark: SparkSession,
    landing: str | list[str],
    store: WeatherStore,
    locations: DataFrame,
    run: str,
    on_duplicate: str = "error",
) -> dict[str, DataFrame]:
    """One whole run: load locations and landed documents, then publish the marts.

    Running it again on the same input leaves the store as it is.
    """
    pin_utc(spark)
    merge_insert_only(locations, store.location, on_duplicate)
    documents = read_weather_documents(spark, landing)
    load_documents(spark, documents, store, run, on_duplicate)
    return publish_marts(spark, store)
