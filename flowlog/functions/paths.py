"""Column expressions over blob paths and resource ids."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import lookup, text, wall_clock

# --- fixed values -------------------------------------------------------------------------------
# (?d): only a newline ends a line.
LOG_PATH = r"(?d).*/([^/\n]*)/y=([0-9]{4})/m=([0-9]{2})/d=([0-9]{2})/h=([0-9]{2})/m=([0-9]{2}).*"
RESOURCE_MARKERS = ["SUBSCRIPTIONS/", "/RESOURCEGROUPS/", "/PROVIDERS/"]
NSG_MARKER = "NETWORKSECURITYGROUPS/"
GATEWAY_MARKER = "APPLICATIONGATEWAYS/"
NSG_FLOW_OPERATION = "NetworkSecurityGroupFlowEvents"
NSG_RULE_OPERATION = "NetworkSecurityGroupEvents"
ACCESS_OPERATION = "ApplicationGatewayAccess"
FIREWALL_OPERATION = "ApplicationGatewayFirewall"
CONTAINERS = {
    NSG_FLOW_OPERATION: "insights-logs-networksecuritygroupflowevent",
    NSG_RULE_OPERATION: "insights-logs-networksecuritygroupevent",
    ACCESS_OPERATION: "insights-logs-applicationgatewayaccesslog",
    FIREWALL_OPERATION: "insights-logs-applicationgatewayfirewalllog",
}
# ------------------------------------------------------------------------------------------------

NSG, ACCESS, FIREWALL = "nsg", "access", "firewall"


def path_tokens(path: Column) -> Column:
    """Source, year, month, day, hour and minute of a log path, NULL for any other path.

    One pattern match gives all six; several uses of a path should share this column.
    """
    tokens = F.split(F.regexp_replace(path, LOG_PATH, "$1\n$2\n$3\n$4\n$5\n$6"), "\n", -1)
    return F.when(path.rlike(LOG_PATH), tokens)


def is_log_path(path: Column) -> Column:
    return path.rlike(LOG_PATH)


def resource_name(path: Column) -> Column:
    """Path component in front of ``/y=``, ``''`` for a path that is not a log path."""
    return F.regexp_extract(path, LOG_PATH, 1)


def log_time(path: Column) -> Column:
    """Hour a log path stands for, NULL for an impossible date or another path."""
    return tokens_time(path_tokens(path))


def tokens_time(tokens: Column) -> Column:
    parts = [F.get(tokens, F.lit(i)).try_cast("int") for i in range(1, 6)]
    return F.try_make_timestamp(*parts, F.lit(0), F.lit("UTC"))


def short_name(name: Column, time: Column) -> Column:
    return F.concat(name, F.lit("-"), F.date_format(wall_clock(time), "yyyy-MM-dd-HH"))


def blob_name(path: Column) -> Column:
    """Name of a file inside its container: the path from ``resourceId=`` on."""
    name = F.regexp_extract(path, "(?s)(resourceId=.*)$", 1)
    return F.when(name != "", name).otherwise(path)


def relative_name(path: Column, root: str) -> Column:
    """Name of a file below ``root``: its path relative to the root, or ``blob_name`` for other paths.

    Scheme and authority are left out of the comparison, so ``/in`` and ``file:///in`` are one root.
    """
    base = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root).strip("/")
    place = F.ltrim(F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), F.lit("/"))
    return F.when(F.startswith(place, F.lit(base + "/")), F.substr(place, F.lit(len(base) + 2))).otherwise(
        blob_name(path)
    )


def source_hash(path: Column) -> Column:
    """Short name of the resource a log file belongs to, by everything in front of its hour."""
    return F.hex(F.xxhash64(F.regexp_extract(path, r"(?s)^(.*)/y=[0-9]{4}/", 1)))


def split_nsg_resource(resource_id: Column) -> dict[str, Column]:
    """Subscription, resource group and NSG of a resource id, all ``''`` where it does not match."""
    return _split_resource(resource_id, NSG_MARKER)


def split_gateway_resource(resource_id: Column) -> dict[str, Column]:
    return _split_resource(resource_id, GATEWAY_MARKER)


def _split_resource(resource_id: Column, kind: str) -> dict[str, Column]:
    """Each marker counts where it occurs last in front of the next one; all four must be there."""
    subscriptions, groups, providers = RESOURCE_MARKERS
    to_kind = _before(resource_id, kind)
    to_providers = _before(to_kind, providers)
    to_groups = _before(to_providers, groups)
    found = (
        F.contains(resource_id, F.lit(kind))
        & F.contains(to_kind, F.lit(providers))
        & F.contains(to_providers, F.lit(groups))
        & F.contains(to_groups, F.lit(subscriptions))
    )
    parts = {
        "subscription_id": F.substring_index(to_groups, subscriptions, -1),
        "resource_group": F.substring_index(to_providers, groups, -1),
        "resource_name": F.substring_index(resource_id, kind, -1),
    }
    return {name: F.when(found, part).otherwise("") for name, part in parts.items()}


def _before(col: Column, marker: str) -> Column:
    """What stands before the last occurrence of a marker."""
    return F.left(col, F.length(col) - F.length(F.substring_index(col, marker, -1)) - len(marker))


def source_path(resource_id: Column, time: Column) -> Column:
    """Blob path a record belongs to."""
    hour = F.date_format(wall_clock(time), "'y='yyyy'/m='MM'/d='dd'/h='HH")
    return F.concat(F.lit("resourceId="), text(resource_id), F.lit("/"), hour, F.lit("/m=00/PT1H.json"))


def source_container(operation: Column) -> Column:
    """Container records of an operation are kept in, ``''`` for any other operation."""
    return lookup(operation, CONTAINERS, "")


def log_family(container: Column) -> Column:
    """Log family of a container; whatever is not a gateway container is read as NSG logs."""
    gateways = {CONTAINERS[ACCESS_OPERATION]: ACCESS, CONTAINERS[FIREWALL_OPERATION]: FIREWALL}
    return lookup(container, gateways, NSG)


def output_name(path: Column, first_epoch: Column, last_epoch: Column) -> Column:
    """Name of the event file made from a log file, NULL for a path that is not a log path."""
    tokens = path_tokens(path)
    return F.concat(
        F.lit("nsgLog-"),
        F.get(tokens, F.lit(0)),
        F.lit("-"),
        F.array_join(F.slice(tokens, 2, 5), ""),
        F.lit("-"),
        first_epoch.cast("string"),
        F.lit("-"),
        last_epoch.cast("string"),
        F.lit(".json"),
    )
