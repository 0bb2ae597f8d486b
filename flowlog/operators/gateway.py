"""Application-gateway records to events: one event per accepted record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.paths import ACCESS_OPERATION, FIREWALL_OPERATION, split_gateway_resource
from .events import event_rows, position
from .records import records_after

ACCESS_TEXTS = ["clientIP", "requestUri", "httpMethod"]
FIREWALL_TEXTS = ["clientIp", "requestUri", "action", "message", "instanceId"]


def access_events(records: DataFrame, after=None) -> DataFrame:
    """Events of gateway access records later than ``after``."""

    def pairs(p: Column) -> dict[str, Column | str]:
        uri, method = X.property_text(p, "requestUri"), X.property_text(p, "httpMethod")
        return {
            "src": X.property_text(p, "clientIP"),
            "spt": X.access_port(p),
            "request": uri,
            "cs1": uri,
            "cs1label": "requestUri",
            "requestMethod": method,
            "act": method,
            "msg": X.properties_json(p),
        }

    return _gateway_events(_due(records, ACCESS_OPERATION, after).where(_access_accepted()), pairs)


def firewall_events(records: DataFrame, after=None) -> DataFrame:
    """Events of gateway firewall records later than ``after``."""

    def pairs(p: Column) -> dict[str, Column | str]:
        return {
            "src": X.property_text(p, "clientIp"),
            "spt": X.firewall_port(p),
            "cs1": X.property_text(p, "requestUri"),
            "cs1label": "requestUri",
            "act": X.property_text(p, "action"),
            "cs5": X.property_text(p, "message"),
            "cs5label": "message",
            "cs6": X.property_text(p, "instanceId"),
            "cs6label": "instanceId",
            "msg": X.properties_json(p),
        }

    return _gateway_events(_due(records, FIREWALL_OPERATION, after).where(_firewall_accepted()), pairs)


def accepted_access_records(records: DataFrame) -> DataFrame:
    return records.where(_access_accepted())


def accepted_firewall_records(records: DataFrame) -> DataFrame:
    return records.where(_firewall_accepted())


def rejected_access_records(records: DataFrame, after=None) -> DataFrame:
    return _due(records, ACCESS_OPERATION, after).where(~_access_accepted())


def rejected_firewall_records(records: DataFrame, after=None) -> DataFrame:
    return _due(records, FIREWALL_OPERATION, after).where(~_firewall_accepted())


def _due(records: DataFrame, operation: str, after) -> DataFrame:
    return records_after(records.where(F.col("operationName") == operation), after)


def _all_text(keys: list[str]) -> Column:
    checks = [X.is_text(X.property_value(F.col("properties"), k)) for k in keys]
    out = checks[0]
    for check in checks[1:]:
        out = out & check
    return out


def _access_accepted() -> Column:
    return _all_text(ACCESS_TEXTS) & X.is_number(X.property_value(F.col("properties"), "clientPort"))


def _firewall_accepted() -> Column:
    return _all_text(FIREWALL_TEXTS)


def _gateway_events(accepted: DataFrame, pairs) -> DataFrame:
    resource = split_gateway_resource(F.col("resourceId"))
    rows = accepted.select("*", *[c.alias(n) for n, c in resource.items()])
    skeleton = {
        "cs2": F.col("resource_name"),
        "cs2label": "Azure Application Gateway",
        "cs3": F.col("subscription_id"),
        "cs3label": "Subscription ID",
        "cs4": F.col("resource_group"),
        "cs4label": "Resource Group",
    }
    return event_rows(
        rows,
        pos=position("record_pos"),
        epoch=F.unix_seconds("time"),
        time=F.col("time"),
        product=X.GATEWAY_PRODUCT,
        class_id=F.col("category"),
        name=F.col("resource_name"),
        severity=F.lit(0),
        pairs={**skeleton, **pairs(F.col("properties"))},
    )
