"""Per-file aggregates. All combine on the map side, so a file with many rows costs no more to
shuffle than a small one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import POS_TYPE


def file_record_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("file").agg(F.count("record_pos").cast("int").alias("last_count"))


def event_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("file").agg(F.count("*").alias("event_count"))


def error_counts(rejects: DataFrame) -> DataFrame:
    """Errors per record."""
    return rejects.groupBy("file", F.col("pos.record_pos").alias("record_pos")).agg(
        F.count("*").alias("error_count")
    )


def file_event_bounds(events: DataFrame) -> DataFrame:
    """Epoch of the first and the last event in file order, and the number of events."""
    return events.groupBy("file").agg(
        F.min(F.struct("pos", "epoch"))["epoch"].alias("first_epoch"),
        F.max(F.struct("pos", "epoch"))["epoch"].alias("last_epoch"),
        F.count("*").alias("event_count"),
    )


def last_record_time(records: DataFrame) -> DataFrame:
    """Time of the last record in file order that has one, which need not be the latest."""
    return records.groupBy("file").agg(_last_time().alias("last_processed_record"))


def _last_time():
    # A record without time must not set a file's progress back to its start.
    return F.max_by("time", F.when(F.col("time").isNotNull(), F.col("record_pos")))


def file_progress(records: DataFrame, events: DataFrame) -> DataFrame:
    """One row per file of ``records``: counts, bounds and the time the next run continues after.

    A file without records has a row with ``record_pos`` NULL and gets count 0. Records and events
    are counted in one aggregation, without a join.
    """
    none = F.lit(None)
    heads = records.select(
        "file", "record_pos", "time", none.cast(POS_TYPE).alias("pos"), none.cast("bigint").alias("epoch")
    )
    tails = events.select(
        "file", none.cast("bigint").alias("record_pos"), none.cast("timestamp").alias("time"), "pos", "epoch"
    )
    event = F.when(F.col("pos").isNotNull(), F.struct("pos", "epoch"))
    found = heads.unionByName(tails).groupBy("file").agg(
        F.count("record_pos").cast("int").alias("last_count"),
        _last_time().alias("last_processed_record"),
        F.min(event)["epoch"].alias("first_epoch"),
        F.max(event)["epoch"].alias("last_epoch"),
        F.count(event).alias("event_count"),
    )
    return found.withColumn(
        "last_processed_timestamp", F.coalesce("last_epoch", F.unix_seconds("last_processed_record"))
    )


def last_processed_timestamp(records: DataFrame, events: DataFrame) -> DataFrame:
    """Epoch of a file's last event, or of its last record when it yields no events."""
    return file_progress(records, events).select("file", "last_processed_timestamp")
