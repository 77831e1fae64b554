"""Streaming load: new telemetry files -> keyed table with INSERT-OR-IGNORE semantics.

Each micro-batch is de-duplicated (first ``order`` wins), checked against the
stored keys between its first and last day (literal bounds on the partition
column, so other days' files are not read) and the new rows are appended.  The step is idempotent: if a batch is replayed after
a failure, rows it already wrote are found by the anti join and not written
twice, so the sink is exactly-once even though the file append is not
transactional.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from fleetscope.schema import COLUMNS, KEYS, TELEMETRY
from fleetscope.sources.ingest import append_if_absent, conform_schema, normalise_nans


def telemetry_stream(spark: SparkSession, folder: str, glob: str = "*.parquet",
                     max_files_per_trigger: int | None = None, extra: T.StructType | None = None) -> DataFrame:
    """Telemetry rows from the Parquet files that arrive in ``folder``.

    The schema is declared (the telemetry columns, and ``extra`` ones such as
    an arrival order), so the stream can start on an empty landing folder.
    """
    fields = [*(extra.fields if extra else ()), *TELEMETRY.fields]
    r = spark.readStream.schema(T.StructType(fields)).option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(folder)


def _upsert(target_path: str, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]):
    def run(batch: DataFrame, batch_id: int) -> None:
        rows = normalise_nans(conform_schema(batch, keep=[o for o in order if o not in COLUMNS]))
        append_if_absent(rows, target_path, keys, order, columns)
    return run


def load_stream(stream: DataFrame, target_path: str, checkpoint_path: str,
                keys: Sequence[str] = KEYS, order: Sequence[str] = ("event_id",),
                columns: Sequence[str] = COLUMNS, available_now: bool = True):
    """Start the load; with ``available_now`` it processes what is there and stops."""
    w = (stream.writeStream.foreachBatch(_upsert(target_path, keys, order, columns))
               .option("checkpointLocation", checkpoint_path))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
