"""Scalar column expressions: flow tuple fields, gateway properties, CEF and syslog text.

Everything here is a ``Column`` built from Spark functions; nothing runs in Python per row.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------------------
PROTOCOLS = {"T": "TCP", "U": "UDP"}
DIRECTIONS = {"I": 0, "O": 1}
OUTCOMES = {"A": "Allow", "D": "Deny"}
OUTCOME_SEVERITY = {"Allow": 0, "Deny": 6}
UNKNOWN_OUTCOME = "Unknown"
UNKNOWN_SEVERITY = 4
CEF_VERSION = 0
DEVICE_VENDOR = "Microsoft"
DEVICE_VERSION = "1"
NSG_PRODUCT = "Azure NSG"
GATEWAY_PRODUCT = "Azure Application Gateway"
SYSLOG_TIME_FORMAT = "MMM dd HH:mm:ss"
TUPLE_TOKENS = 8
# White space of Unicode, the characters cut from both ends of an extension text.
UNICODE_SPACE = "".join(
    chr(c)
    for c in [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
# Characters the JSON text of gateway properties writes as escapes.
JSON_ESCAPES = {
    "<": "\\u003c",
    ">": "\\u003e",
    "&": "\\u0026",
    chr(0x2028): "\\u2028",
    chr(0x2029): "\\u2029",
}
# Control characters whose escape Spark writes in another form.
JSON_CONTROL_ESCAPES = {
    "\\b": "\\u0008",
    "\\f": "\\u000c",
    "\\u000B": "\\u000b",
    "\\u000E": "\\u000e",
    "\\u000F": "\\u000f",
    "\\u001A": "\\u001a",
    "\\u001B": "\\u001b",
    "\\u001C": "\\u001c",
    "\\u001D": "\\u001d",
    "\\u001E": "\\u001e",
    "\\u001F": "\\u001f",
}
# ------------------------------------------------------------------------------------------------

# Largest epoch second a Spark timestamp holds.
MAX_EPOCH = (2**63 - 1) // 1_000_000


def text(col: Column) -> Column:
    """A missing string reads as the empty string."""
    return F.coalesce(col, F.lit(""))


def lookup(col: Column, mapping: dict, default=None) -> Column:
    """Value of ``col`` in a fixed mapping, ``default`` where it has no entry."""
    out = F
    for key, value in mapping.items():
        out = out.when(col == key, value)
    return out.otherwise(default)


# --- flow tuples --------------------------------------------------------------------------------


def split_tuple(tuple_text: Column) -> Column:
    return F.split(tuple_text, ",", -1)


def token_count(tuple_text: Column) -> Column:
    return F.size(split_tuple(tuple_text))


def format_mac(mac: Column) -> Column:
    """``000D3AF33854`` as ``00:0D:3A:F3:38:54``; no colon after the last pair."""
    return F.regexp_replace(mac, "(?s)(..)(?=.)", "$1:")


def protocol_name(code: Column) -> Column:
    return lookup(code, PROTOCOLS, "")


def device_direction(code: Column) -> Column:
    """0 inbound, 1 outbound; an unknown code counts as inbound."""
    return lookup(code, DIRECTIONS, 0)


def outcome_name(code: Column) -> Column:
    return lookup(code, OUTCOMES, UNKNOWN_OUTCOME)


def outcome_severity(code: Column) -> Column:
    return lookup(outcome_name(code), OUTCOME_SEVERITY, UNKNOWN_SEVERITY)


def parse_epoch(token: Column) -> Column:
    """Epoch seconds of a tuple token, NULL unless it is a plain integer a timestamp can hold."""
    value = token.try_cast("bigint")
    return F.when(token.rlike("^[+-]?[0-9]+$") & value.between(-MAX_EPOCH, MAX_EPOCH), value)


def event_epoch(token: Column) -> Column:
    """Epoch an event carries: a bad epoch token is an error, yet the event stays, at epoch 0."""
    return F.coalesce(parse_epoch(token), F.lit(0).cast("bigint"))


def event_time(epoch: Column) -> Column:
    return F.timestamp_seconds(epoch)


def start_millis(epoch: Column) -> Column:
    return (epoch * F.lit(1000)).cast("string")


def token_count_message(tuple_text: Column) -> Column:
    return F.concat(
        F.lit("unexpected # tokens in tuple "), tuple_text, F.lit(f". expected {TUPLE_TOKENS}")
    )


def epoch_message(token: Column) -> Column:
    reason = F.when(token.rlike("^[+-]?[0-9]+$"), "value out of range").otherwise("invalid syntax")
    return F.concat(F.lit('strconv.ParseInt: parsing "'), token, F.lit('": '), reason)


# --- gateway properties -------------------------------------------------------------------------


def variant_type(value: Column) -> Column:
    return F.schema_of_variant(value)


def is_text(value: Column) -> Column:
    return F.coalesce(variant_type(value) == F.lit("STRING"), F.lit(False))


def is_number(value: Column) -> Column:
    return F.coalesce(variant_type(value).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.lit(False))


def property_value(properties: Column, key: str) -> Column:
    return F.try_variant_get(properties, f"$.{key}", "variant")


def property_text(properties: Column, key: str) -> Column:
    return F.try_variant_get(properties, f"$.{key}", "string")


def properties_json(properties: Column) -> Column:
    """Compact JSON of all properties with keys sorted at every level."""
    out = F.to_json(properties)
    # An escape of a control character may only be rewritten where its backslash is not itself
    # escaped, so rewrite between the escaped backslashes. Few texts need it.
    rewritten = F.array_join(
        F.transform(F.split(out, r"\\\\", -1), lambda part: _replace_all(part, JSON_CONTROL_ESCAPES)),
        "\\\\",
    )
    needs_rewrite = out.rlike(r"\\(b|f|u00[01][A-F])")
    return _replace_all(F.when(needs_rewrite, rewritten).otherwise(out), JSON_ESCAPES)


def access_port(properties: Column) -> Column:
    """Client port of an access record: the number cut to an integer."""
    number = F.try_variant_get(properties, "$.clientPort", "double")
    return number.try_cast("bigint").cast("string")


def firewall_port(properties: Column) -> Column:
    """Client port of a firewall record: any value as text."""
    return F.coalesce(property_text(properties, "clientPort"), F.lit("<nil>"))


def _replace_all(col: Column, pairs: dict[str, str]) -> Column:
    for old, new in pairs.items():
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


# --- CEF and syslog -----------------------------------------------------------------------------


def cef_escape(value: Column) -> Column:
    return F.replace(value, F.lit("="), F.lit("\\="))


def drop_empty(extension: Column) -> Column:
    """Extension map without its empty values."""
    return F.map_filter(extension, lambda _, v: v != "")


def sorted_entries(extension: Column) -> Column:
    """Entries of an extension map by key, bytewise ascending."""
    return F.sort_array(F.map_entries(extension))


def extension_text(extension: Column) -> Column:
    """``|k=v k=v`` over the non-empty entries of an extension map, ``''`` when there are none."""
    pairs = F.transform(
        sorted_entries(drop_empty(extension)),
        lambda e: F.concat(e["key"], F.lit("="), cef_escape(e["value"])),
    )
    # A bar goes in front of any text but the empty one.
    return _trim(F.regexp_replace(F.array_join(pairs, " "), "(?s)^(?=.)", "|"))


class Either(NamedTuple):
    """A value that goes under one key or another: ``condition`` and ``value`` as SQL."""

    key: str
    other: str
    condition: str
    value: str

    def pairs(self) -> dict[str, str]:
        return {
            self.key: f"CASE WHEN {self.condition} THEN {self.value} END",
            self.other: f"CASE WHEN NOT {self.condition} THEN {self.value} END",
        }


def extension_map(pairs: dict[str, str], either: Either | None = None) -> Column:
    """Extension map from a SQL expression per key."""
    entries = [f"'{key}', {pairs[key]}" for key in sorted(pairs)]
    if either is not None:
        key = f"CASE WHEN {either.condition} THEN '{either.key}' ELSE '{either.other}' END"
        entries.append(f"{key}, {either.value}")
    return F.expr(f"map({', '.join(entries)})")


def pairs_text(pairs: dict[str, str], either: Either | None = None, trim: bool = True) -> Column:
    """Same text as ``extension_text(extension_map(pairs, either))`` without building the map, for
    pairs of which at least one is a fixed text. ``trim=False`` is for a last value that is never empty and
    never ends in white space.

    The keys are known when the plan is made, so the sort happens here and the whole text is one
    generated-code expression.
    """
    pairs = pairs if either is None else {**pairs, **either.pairs()}
    shown = ", ".join(
        f"'{key}={pairs[key][1:-1]}'"
        if pairs[key].startswith("'")
        else f"CASE WHEN {pairs[key]} <> '' THEN concat('{key}=', replace({pairs[key]}, '=', r'\\=')) END"
        for key in sorted(pairs)
    )
    joined = F.expr(f"concat_ws(' ', {shown})")
    return F.concat(F.lit("|"), _trim(joined) if trim else joined)


def _trim(joined: Column) -> Column:
    return F.btrim(joined, F.lit(UNICODE_SPACE))


def cef_text(
    class_id: Column,
    name: Column,
    severity: Column,
    ext_text: Column,
    product: Column,
    vendor: Column | None = None,
    version: Column | None = None,
    cef_version: Column | None = None,
) -> Column:
    """``CEF:0|vendor|product|version|class|name|severity`` followed by the extension text."""
    header = F.concat_ws(
        "|",
        F.concat(F.lit("CEF:"), F.lit(CEF_VERSION) if cef_version is None else cef_version),
        F.lit(DEVICE_VENDOR) if vendor is None else vendor,
        product,
        F.lit(DEVICE_VERSION) if version is None else version,
        text(class_id),
        text(name),
        severity.cast("string"),
    )
    return F.concat(header, text(ext_text))


def wall_clock(time: Column, tz: str = "UTC") -> Column:
    """Timestamp whose session-zone fields show the wall clock of ``tz``."""
    utc = F.to_utc_timestamp(time, F.current_timezone())
    return utc if tz == "UTC" else F.from_utc_timestamp(utc, tz)


def syslog_time(time: Column, tz: str = "UTC") -> Column:
    return F.date_format(wall_clock(time, tz), SYSLOG_TIME_FORMAT)


def syslog_text(time: Column, cef: Column, tz: str = "UTC") -> Column:
    """CEF text with its event time in front; an event without time has no prefix."""
    return F.when(time.isNull(), cef).otherwise(F.concat(syslog_time(time, tz), F.lit("|"), cef))


def syslog_frame(content: Column, host: str | Column, now: Column | None = None, tz: str = "UTC") -> Column:
    """``<time> <host> <message>`` for one line of content.

    The time is what stands before the last ``|CEF`` of the first line, and the message then ends
    with that line. Other content is sent whole under ``now``, which is one value per query.
    """
    host = F.lit(host) if isinstance(host, str) else host
    now = F.current_timestamp() if now is None else now
    line = F.substring_index(content, "\n", 1)
    tail = F.substring_index(line, "|CEF", -1)
    prefix = F.left(line, F.length(line) - F.length(tail) - 4)
    timed = F.concat_ws(" ", prefix, host, F.concat(F.lit("CEF"), tail))
    untimed = F.concat_ws(" ", syslog_time(now, tz), host, content)
    return F.when(F.contains(line, F.lit("|CEF")), timed).otherwise(untimed)
