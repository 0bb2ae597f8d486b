"""Structured Streaming driver: an incremental run at every trigger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.incremental import Sink, run_incremental


def start_stream(
    spark: SparkSession,
    root: str,
    job: str,
    sink: Sink,
    state_path: str,
    checkpoint: str,
    *,
    poll_interval: float | None = 60,
    **options,
) -> StreamingQuery:
    """Follow growing files: every ``poll_interval`` seconds, or once over what there is for None.

    The stream itself carries no files, only triggers: Spark's file stream reads a path once and never
    again, while log files grow for an hour. Each trigger lists the container once, on any file
    system Spark reads, and the status alone decides what is new, so a file that shows up late, with
    whatever time, is taken. A batch replayed after a crash finds files committed before unchanged and
    skips them, and finishes a batch that was staged but not committed from its staged rows. Sinks that
    overwrite by version or name thus write each event once; a sender may repeat the lines of the batch
    that was interrupted. ``options`` are those of ``run_incremental``.
    """

    def convert(_trigger: DataFrame, _batch_id: int) -> None:
        run_incremental(spark, root, job, sink, state_path, **options)

    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1)
    writer = ticks.load().writeStream.queryName(job).option("checkpointLocation", checkpoint).foreachBatch(convert)
    if poll_interval is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{poll_interval} seconds").start()
