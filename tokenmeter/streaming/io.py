"""Stream sources and the layout of sinks.

Sink layout: ``<path>/batch_id=<n>/`` holds what micro-batch ``n`` emitted.
A retried batch rewrites its own folder (overwrite), so a replay after a
failure never duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def file_stream(spark: SparkSession, folder: str, file_glob: str, files_per_trigger: int | None = 16,
                schema=None) -> DataFrame:
    """Parquet files landing in ``folder`` as a stream.  A stream needs a
    schema: the one given, else the one of the files already there (a
    footer read).  ``files_per_trigger=None`` takes every new file into one
    micro-batch."""
    if schema is None:
        schema = spark.read.option("pathGlobFilter", file_glob).parquet(folder).schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if files_per_trigger is not None:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    return r.parquet(folder)


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def run_available(query_builder) -> None:
    """Run a stream over everything available now and wait for it."""
    q = query_builder.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
