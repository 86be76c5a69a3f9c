"""Command line: ``spark-submit`` or ``python -m obsflow <job> ...``.

The session takes master, memory and parallelism from the submitter.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from obsflow.fixed_values import BUNDLE_RESOURCES, DAILY_MAX_VIEW, DAILY_STATS_VIEW
from obsflow.plans.clinical import bundle_balance, patient_to_silver, raw_to_bronze, raw_to_whole_bronze
from obsflow.plans.report import show_view
from obsflow.plans.weather import (
    EXTREMES_VIEW,
    PEAK_VIEW,
    WeatherStore,
    export_flat_csv,
    load_locations,
    publish_kept_marts,
    publish_marts,
    publish_peaks,
    refresh_weather,
)
from obsflow.schemas import LOCATION, REQUEST
from obsflow.session import pin_utc
from obsflow.sources.tables import read_headerless_csv
from obsflow.streaming.incremental import run_available


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="obsflow")
    jobs = root.add_subparsers(dest="job", required=True)

    refresh = jobs.add_parser("refresh", help="load landed documents and publish the marts")
    refresh.add_argument("--landing", required=True)
    refresh.add_argument("--store", required=True)
    refresh.add_argument("--locations", required=True, help="headerless CSV of locations")
    refresh.add_argument("--run", required=True, help="name of this run, e.g. its date")
    refresh.add_argument("--on-duplicate", choices=["error", "first"], default="error")
    _store_options(refresh)

    incremental = jobs.add_parser("incremental", help="load what landed since the last run")
    incremental.add_argument("--landing", required=True)
    incremental.add_argument("--store", required=True)
    incremental.add_argument("--checkpoint", required=True)
    incremental.add_argument("--files-per-batch", type=int)
    incremental.add_argument("--archive")
    _store_options(incremental)

    places = jobs.add_parser("locations", help="look up the address of requested places and store them")
    places.add_argument("--store", required=True)
    places.add_argument("--requests", required=True, help="headerless CSV of latitude and longitude; blank for the defaults")
    places.add_argument("--gazetteer", required=True, help="headerless CSV of locations")
    places.add_argument("--nearest", action="store_true")
    _store_options(places)

    export = jobs.add_parser("export", help="landed documents as headerless CSV")
    export.add_argument("--landing", required=True)
    export.add_argument("--folder", required=True)

    report = jobs.add_parser("report", help="show the head of a mart")
    report.add_argument("--store", required=True)
    _store_options(report)
    report.add_argument("--view", choices=[DAILY_MAX_VIEW, DAILY_STATS_VIEW, PEAK_VIEW, EXTREMES_VIEW], default=DAILY_MAX_VIEW)

    clinical = jobs.add_parser("clinical", help="bundles from raw to bronze and silver")
    clinical.add_argument("--root", required=True)
    clinical.add_argument("--resources", nargs="+", default=list(BUNDLE_RESOURCES))
    clinical.add_argument("--format", default="parquet")
    clinical.add_argument("--layout", choices=["auto", "plain", "columnar"], default="auto", help="of declared entries")
    clinical.add_argument("--whole", action="store_true", help="keep every field of every entry, and show what became of each file")
    return root


def _store_options(job: argparse.ArgumentParser) -> None:
    job.add_argument("--rejects", help="folder for rejected documents; needed by a store in the catalog")
    job.add_argument("--grain", type=int, help="seconds that hourly moments are multiples of; keeps bitmaps and summaries")


def _store(given: argparse.Namespace) -> WeatherStore:
    return WeatherStore(given.store, given.rejects, given.grain)


def main(arguments: list[str] | None = None) -> None:
    given = parser().parse_args(arguments)
    spark = pin_utc(SparkSession.builder.appName(f"obsflow-{given.job}").getOrCreate())
    if given.job == "refresh":
        locations = read_headerless_csv(spark, given.locations, LOCATION)
        store = _store(given)
        refresh_weather(spark, given.landing, store, locations, given.run, given.on_duplicate)
        if store.grain:
            publish_kept_marts(spark, store)
    elif given.job == "incremental":
        run_available(
            spark, given.landing, _store(given), given.checkpoint,
            given.files_per_batch, archive=given.archive,
        )
    elif given.job == "export":
        export_flat_csv(spark, given.landing, given.folder)
    elif given.job == "report":
        publish_marts(spark, _store(given))
        publish_peaks(spark, _store(given))
        show_view(spark, given.view)
    elif given.job == "locations":
        requests = read_headerless_csv(spark, given.requests, REQUEST)
        gazetteer = read_headerless_csv(spark, given.gazetteer, LOCATION)
        load_locations(spark, requests, gazetteer, _store(given), given.nearest).show(truncate=False)
    elif given.whole:
        raw_to_whole_bronze(spark, given.root, given.resources, fmt=given.format)
        for resource in given.resources:
            bundle_balance(spark, given.root, resource, given.format).show(truncate=False)
        if "patient" in given.resources:
            patient_to_silver(spark, given.root, given.format, nested="whole")
    else:
        raw_to_bronze(spark, given.root, given.resources, fmt=given.format, layout=given.layout)
        if "patient" in given.resources:
            patient_to_silver(spark, given.root, given.format)


if __name__ == "__main__":
    main()
