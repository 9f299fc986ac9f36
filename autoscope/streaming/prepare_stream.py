"""Prepare job (P1) over a stream of raw listing files.

``readStream`` of the landing folder (explicit all-string schema: a
streaming source needs one) -> per micro-batch: surrogate key, drop, clean,
city/state join -> Parquet partition ``batch_id=N``.

Exactly-once output: a micro-batch that is replayed after a failure
overwrites its own ``batch_id`` partition instead of appending twice; the
source offsets live in the checkpoint location (a shared folder).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from autoscope.operators.enrich import attach_state
from autoscope.plans import listings as L
from autoscope.session import scratch_path
from autoscope.sources.io import string_schema


def prepare_stream(spark: SparkSession, landing_dir: str, columns: list[str], cities_raw: DataFrame,
                   out_path: str, checkpoint: str | None = None, available_now: bool = True,
                   max_files_per_trigger: int | None = None):
    """Start the incremental prepare; returns the ``StreamingQuery``.

    ``available_now=True`` processes everything that has landed, in
    bounded micro-batches, then stops (a scheduled catch-up run);
    ``False`` keeps running with a processing-time trigger.
    """
    reader = (spark.readStream.schema(string_schema(columns))
              .option("header", "true").option("escape", '"').option("multiLine", "true")
              .option("enforceSchema", "false"))  # a file with other columns fails, it is not read by position
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(landing_dir)
    dim = L.cities(spark, cities_raw)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        prepared = attach_state(L.clean_listings(batch), dim)
        # (batch_id, rowno) is the key: the batch is the output partition
        (prepared.write.mode("overwrite")
                 .parquet(f"{out_path.rstrip('/')}/batch_id={batch_id}"))

    ck = checkpoint or scratch_path(spark, "streams/prepare")
    writer = raw.writeStream.foreachBatch(write_batch).option("checkpointLocation", ck)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
