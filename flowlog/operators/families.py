"""Operation handlers: which function turns the records of an operation into events."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import (
    ACCESS,
    ACCESS_OPERATION,
    FIREWALL,
    FIREWALL_OPERATION,
    NSG,
    NSG_FLOW_OPERATION,
    NSG_RULE_OPERATION,
)
from . import flow, gateway, records as R
from .events import position, union_events


class Handler(NamedTuple):
    """Functions of one operation, each called as ``f(records, after)``."""

    events: Callable[..., DataFrame]
    rejected: Callable[..., DataFrame] | None = None
    tuple_errors: Callable[..., DataFrame] | None = None
    #: Rejected records and tuple errors together, as reject rows, in fewer passes.
    rejects: Callable[..., DataFrame] | None = None


HANDLERS: dict[str, dict[str, Handler]] = {
    NSG: {
        NSG_FLOW_OPERATION: Handler(
            flow.flow_events, flow.rejected_flow_records, flow.flow_tuple_errors, flow.flow_rejects
        ),
        NSG_RULE_OPERATION: Handler(flow.rule_counter_events),
    },
    ACCESS: {ACCESS_OPERATION: Handler(gateway.access_events, gateway.rejected_access_records)},
    FIREWALL: {FIREWALL_OPERATION: Handler(gateway.firewall_events, gateway.rejected_firewall_records)},
}


def register_operation(family: str, operation: str, handler: Handler) -> None:
    """Add or replace the handler of an operation; it must return the shared event row."""
    HANDLERS[family][operation] = handler
    if operation not in R.OPERATIONS[family]:
        R.OPERATIONS[family].append(operation)


def family_events(records: DataFrame, family: str, after=None) -> DataFrame:
    """Events of all operations of a family."""
    return union_events(
        *[
            handler.events(records.where(F.col("operationName") == operation), after)
            for operation, handler in HANDLERS[family].items()
        ]
    )


def accepted_records(records: DataFrame, family: str) -> DataFrame:
    """Records whose fields are all there with the right type; others yield no event at all."""
    accepted = {
        NSG: flow.accepted_flow_records,
        ACCESS: gateway.accepted_access_records,
        FIREWALL: gateway.accepted_firewall_records,
    }
    return accepted[family](records)


def rejected_records(records: DataFrame, family: str, after=None) -> DataFrame:
    """Rejected records of a family as reject rows."""
    parts = [h.rejected(records, after) for h in HANDLERS[family].values() if h.rejected is not None]
    return union_events(*[_record_reject(p) for p in parts])


def rejects(records: DataFrame, family: str, after=None) -> DataFrame:
    """Everything that did not become a clean event: bad tuples and rejected records."""
    parts = []
    for handler in HANDLERS[family].values():
        if handler.rejects is not None:
            parts.append(handler.rejects(records, after))
            continue
        if handler.rejected is not None:
            parts.append(_record_reject(handler.rejected(records, after)))
        if handler.tuple_errors is not None:
            parts.append(handler.tuple_errors(records, after))
    return union_events(*parts)


def _record_reject(records: DataFrame) -> DataFrame:
    return records.select(
        "file",
        position("record_pos").alias("pos"),
        F.lit("record").alias("kind"),
        F.lit(flow.RECORD_MESSAGE).alias("message"),
        F.to_json("properties").alias("raw"),
    )
