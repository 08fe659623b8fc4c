"""Incremental bronze load with Structured Streaming.

The batch load (``strata.sources.landing.ingest_entity``) re-reads whatever
days it is given.  For a landing zone that keeps growing, this stream reads
only files it has not seen: the file source records processed files in its
checkpoint, and the Parquet file sink commits each micro-batch atomically
through its own log, so every landing file lands in bronze exactly once,
across restarts, retries and lost executors.

Run it with ``trigger(availableNow=True)`` (the default here) to drain what
has arrived and stop, as a scheduled job would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructField

from strata.sources.contracts import all_text
from strata.sources.landing import lineage


def start_incremental_ingest(
    spark: SparkSession,
    landing_entity_root: str,
    bronze_path: str,
    checkpoint: str,
    columns: Sequence[str],
    delimiter: str = ",",
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start streaming ``<landing_entity_root>/ingest_date=<d>/*.csv`` into
    ``bronze_path`` (Parquet, partitioned by ``ingest_date``).

    ``columns`` is the text schema in header order (a stream needs a fixed
    schema); a file whose header differs from it fails the run."""
    schema = all_text(columns).add(StructField("ingest_date", DateType(), True))
    reader = (spark.readStream.schema(schema).option("header", True).option("delimiter", delimiter)
              .option("mode", "PERMISSIVE").option("enforceSchema", False))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = lineage(reader.csv(landing_entity_root))
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).partitionBy("ingest_date"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(bronze_path)


def drain(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an ``availableNow`` run to finish; re-raise its failure, and
    raise ``TimeoutError`` if it is still running after ``timeout_s``."""
    if query.awaitTermination(timeout_s) is False:
        raise TimeoutError(f"the load is still running after {timeout_s} s")
    if query.exception() is not None:
        raise query.exception()
