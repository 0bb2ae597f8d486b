"""Operators over records: the rows readers produce, one per entry of a log document."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.paths import (
    ACCESS,
    ACCESS_OPERATION,
    FIREWALL,
    FIREWALL_OPERATION,
    NSG,
    NSG_FLOW_OPERATION,
    NSG_RULE_OPERATION,
    log_time,
    source_path,
    split_gateway_resource,
    split_nsg_resource,
)

OPERATIONS = {
    NSG: [NSG_FLOW_OPERATION, NSG_RULE_OPERATION],
    ACCESS: [ACCESS_OPERATION],
    FIREWALL: [FIREWALL_OPERATION],
}


def timestamp_column(value: datetime | str | Column) -> Column:
    """A bound for time comparisons; a naive ``datetime`` is taken as UTC."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.col(value)
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit(int(value.timestamp()) * 1_000_000 + value.microsecond))


def _zero_time() -> Column:
    return F.make_timestamp(F.lit(1), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0), F.lit("UTC"))


def records_after(records: DataFrame, after: datetime | str | Column | None = None) -> DataFrame:
    """Records strictly later than ``after``: a bound, or the name of a column holding one per row.

    Without a bound (or where it is NULL) every record that has a time is kept.
    """
    bound = _zero_time() if after is None else F.coalesce(timestamp_column(after), _zero_time())
    return records.where(F.col("time") > bound)


def records_before(records: DataFrame, before: datetime | str | Column) -> DataFrame:
    return records.where(F.col("time") < timestamp_column(before))


def dispatch_operation(records: DataFrame, family: str) -> DataFrame:
    """Records whose operation the family converts; any other operation yields no events."""
    return records.where(F.col("operationName").isin(OPERATIONS[family]))


def sort_records(records: DataFrame) -> DataFrame:
    """Records by time, with file order breaking ties."""
    return records.orderBy("time", "file", "record_pos")


def log_file_from_records(records: DataFrame, family: str) -> DataFrame:
    """One listing row per file, made from its first record that has a time instead of a storage
    listing; the position that record has does not matter."""
    split = split_nsg_resource if family == NSG else split_gateway_resource
    first = F.min_by(F.struct("resourceId", "time"), "record_pos").alias("first")
    rows = records.where("time IS NOT NULL").groupBy("file").agg(first).select("file", "first.*")
    name = source_path(F.col("resourceId"), F.col("time"))
    return rows.select(
        "file",
        name.alias("name"),
        F.col("time").alias("last_modified"),
        log_time(name).alias("log_time"),
        split(F.col("resourceId"))["resource_name"].alias("nsg_name"),
    )
