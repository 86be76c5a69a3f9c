"""Loading whatever has landed since the last run."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from obsflow.plans.weather import WeatherStore, load_documents
from obsflow.schemas import CORRUPT_COLUMN, WEATHER_DOCUMENT
from obsflow.session import pin_utc


def run_available(
    spark: SparkSession,
    landing: str,
    store: WeatherStore,
    checkpoint: str,
    files_per_batch: int | None = None,
    on_duplicate: str = "first",
    archive: str | None = None,
) -> None:
    """Merge all files not seen yet, then stop. Meant to be started once a day.

    The checkpoint takes each file once across restarts. Should a batch be repeated after
    a failure, the merge skips what it stored already, so the outcome is the same. A batch
    whose rows break a rule of the tables loses only those: they are kept with the rejects.
    ``files_per_batch`` bounds the work of one batch; older files go first. With ``archive``
    loaded files are moved to that folder, so that the landing folder stays quick to list.
    """
    pin_utc(spark)
    stream = (
        spark.readStream.schema(WEATHER_DOCUMENT)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("recursiveFileLookup", True)
    )
    if files_per_batch is not None:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)

    if archive is not None:
        stream = stream.option("cleanSource", "archive").option("sourceArchiveDir", archive)

    # Batches of every checkpoint count from 0, so its name is part of that of the rejects.
    stream_name = "batch-" + hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def load(batch: DataFrame, number: int) -> None:
        # The session of the caller, unlike the one of the stream, plans adaptively.
        load_documents(spark, batch, store, f"{stream_name}-{number}", on_duplicate, strict=False)

    (
        stream.json(landing)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
