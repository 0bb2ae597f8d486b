"""Schemas shared by readers, operators and sinks, as Spark DDL text."""

from __future__ import annotations


def ddl(types: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in types.items())


# One log record of any family. ``properties`` is schemaless, so it stays VARIANT; gateway
# records carry no ``systemId``.
RECORD_FIELDS = (
    "time TIMESTAMP, systemId STRING, category STRING, resourceId STRING, "
    "operationName STRING, properties VARIANT"
)

# One log document: the envelope around its records.
LOG_DDL = f"records ARRAY<STRUCT<{RECORD_FIELDS}>>, _corrupt_record STRING"

# Typed form of a flow record's ``properties.flows``.
FLOWS_TYPE = (
    "ARRAY<STRUCT<rule: STRING, flows: ARRAY<STRUCT<mac: STRING, flowTuples: ARRAY<STRING>>>>>"
)
# The same with VARIANT leaves, which keeps the JSON type of every leaf visible.
FLOWS_VARIANT_TYPE = (
    "ARRAY<STRUCT<rule: VARIANT, flows: ARRAY<STRUCT<mac: VARIANT, flowTuples: ARRAY<VARIANT>>>>>"
)

# The event row every family is flattened to.
EVENT_TYPES = {
    "cef_version": "INT",
    "device_vendor": "STRING",
    "device_product": "STRING",
    "device_version": "STRING",
    "device_event_class_id": "STRING",
    "time": "TIMESTAMP",
    "name": "STRING",
    "severity": "INT",
    "extension": "MAP<STRING, STRING>",
}
EVENT_COLUMNS = list(EVENT_TYPES)
EVENT_DDL = ddl(EVENT_TYPES)

# Where an event came from inside its file; structs compare field by field, so ``pos`` sorts events
# into file order.
POS_TYPE = "STRUCT<record_pos: BIGINT, flow_pos: INT, group_pos: INT, tuple_pos: INT>"

# Files of a container, before and after path parsing.
LISTING_DDL = "path STRING, name STRING, etag STRING, last_modified TIMESTAMP, length BIGINT"

# Per-file progress, with the JSON names of the exchange format.
STATUS_TYPES = {
    "name": "STRING",
    "etag": "STRING",
    "last_modified": "TIMESTAMP",
    "last_processed": "TIMESTAMP",
    "last_processed_record": "TIMESTAMP",
    "last_processed_timestamp": "BIGINT",
    "last_count": "INT",
    "last_processed_range": "STRUCT<Start: BIGINT, End: BIGINT>",
    "log_time": "TIMESTAMP",
    "nsg_name": "STRING",
}
STATUS_COLUMNS = list(STATUS_TYPES)
STATUS_DDL = ddl(STATUS_TYPES)

# A file to process, with its earlier progress.
SELECTED_TYPES = {
    "path": "STRING",
    "name": "STRING",
    "etag": "STRING",
    "last_modified": "TIMESTAMP",
    "length": "BIGINT",
    "nsg_name": "STRING",
    "log_time": "TIMESTAMP",
    "last_processed_record": "TIMESTAMP",
    "last_processed_range": "STRUCT<Start: BIGINT, End: BIGINT>",
    "known_count": "INT",
}
SELECTED_COLUMNS = list(SELECTED_TYPES)
SELECTED_DDL = ddl(SELECTED_TYPES)
