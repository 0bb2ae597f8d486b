"""Network flow records to events: one event per valid flow tuple."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as X
from ..functions.paths import NSG_FLOW_OPERATION, split_nsg_resource
from ..schemas import FLOWS_TYPE, FLOWS_VARIANT_TYPE
from .events import event_rows, position
from .records import records_after


#: Why a record yields nothing.
RECORD_MESSAGE = "a required field is missing or has another type"


def flow_events(records: DataFrame, after=None) -> DataFrame:
    """Events of flow records later than ``after``, one per 8-token tuple of an accepted record."""
    tokens = [F.get("tokens", F.lit(i)) for i in range(X.TUPLE_TOKENS)]
    tuples = flow_tuples(records, after).where(F.size("tokens") == X.TUPLE_TOKENS)
    rows = tuples.select(
        "file",
        "pos",
        "category",
        "operationName",
        "systemId",
        "subscription_id",
        "resource_group",
        "resource_name",
        "rule",
        "mac",
        "tokens",
        X.event_epoch(tokens[0]).alias("epoch"),
    )
    pairs = {
        "deviceExternalId": X.text(F.col("systemId")),
        "cs1": F.col("rule"),
        "cs1label": "Rule Name",
        "cs2": F.col("resource_name"),
        "cs2label": "Azure NSG",
        "cs3": F.col("subscription_id"),
        "cs3label": "Subscription ID",
        "cs4": F.col("resource_group"),
        "cs4label": "Resource Group",
        "start": X.start_millis(F.col("epoch")),
        "src": tokens[1],
        "dst": tokens[2],
        "spt": tokens[3],
        "dpt": tokens[4],
        "proto": X.protocol_name(tokens[5]),
        "deviceDirection": X.device_direction(tokens[6]).cast("string"),
        "categoryOutcome": X.outcome_name(tokens[7]),
    }
    return event_rows(
        rows,
        pos=F.col("pos"),
        epoch=F.col("epoch"),
        time=X.event_time(F.col("epoch")),
        product=X.NSG_PRODUCT,
        class_id=F.col("operationName"),
        name=F.col("category"),
        severity=X.outcome_severity(tokens[7]),
        pairs=pairs,
        # The address is that of the virtual machine: the target of inbound flows, the source of
        # outbound ones.
        either=X.Either("dmac", "smac", "`ext deviceDirection` = '0'", "mac"),
        extra=("mac",),
        # The last pair is ``start``, digits.
        trim=False,
    )


def rule_counter_events(records: DataFrame, after=None) -> DataFrame:
    """Rule-counter records have no event form: the event row without rows."""
    return flow_events(records, after).where(F.lit(False))


def flow_tuples(records: DataFrame, after=None) -> DataFrame:
    """All tuples of accepted flow records with their position, split into tokens."""
    due = records_after(records.where(F.col("operationName") == NSG_FLOW_OPERATION), after)
    resource = split_nsg_resource(F.col("resourceId"))
    kept = ["file", "record_pos", "category", "operationName", "systemId"]
    # What is the same for all tuples of a record, flow or group is computed below its explode.
    # Acceptance is a filter on a one-element array, so that the nested arrays are read once for the
    # check and the explode together.
    accepted = f"filter(array({_flows_sql(due)}), flows -> {_accepted_sql(due, 'flows')})"
    named = due.select(*kept, *[c.alias(n) for n, c in resource.items()], "properties")
    kept += list(resource)
    records = named.select(*kept, F.explode(F.expr(accepted)).alias("flows"))
    return _exploded(records, kept, F.posexplode)


def _exploded(records: DataFrame, kept: list[str], explode) -> DataFrame:
    """The tuples in the ``flows`` of records; an outer ``explode`` keeps records without tuples."""
    flows = records.select(*kept, explode("flows").alias("flow_pos", "flow"))
    kept = [*kept, "flow_pos"]
    groups = flows.select(*kept, F.col("flow.rule").alias("rule"), explode("flow.flows").alias("group_pos", "group"))
    kept += ["rule", "group_pos"]
    macs = groups.select(*kept, X.format_mac(F.col("group.mac")).alias("mac"), "group.flowTuples")
    tuples = macs.select(*kept, "mac", explode("flowTuples").alias("tuple_pos", "tuple"))
    return tuples.select(
        "*",
        position("record_pos", "flow_pos", "group_pos", "tuple_pos").alias("pos"),
        X.split_tuple(F.col("tuple")).alias("tokens"),
    )


def flow_tuple_errors(records: DataFrame, after=None) -> DataFrame:
    """One row per tuple error of accepted records.

    A tuple with another number of tokens gives an error and no event; a bad epoch gives an error
    beside its event.
    """
    return flow_tuples(records, after).where(_is_bad()).select("file", "pos", *_tuple_error(), F.col("tuple").alias("raw"))


def _is_bad() -> Column:
    wrong_size = F.size("tokens") != X.TUPLE_TOKENS
    return wrong_size | X.parse_epoch(F.get("tokens", F.lit(0))).isNull()


def _tuple_error() -> list[Column]:
    wrong_size = F.size("tokens") != X.TUPLE_TOKENS
    message = F.when(wrong_size, X.token_count_message(F.col("tuple"))).otherwise(
        X.epoch_message(F.get("tokens", F.lit(0)))
    )
    return [F.when(wrong_size, "token_count").otherwise("epoch").alias("kind"), message.alias("message")]


def flow_rejects(records: DataFrame, after=None) -> DataFrame:
    """Tuple errors of accepted flow records and the rejected records, from one pass over the records.

    Whether a record is accepted is decided once; a rejected record goes through the explodes as one
    row without a tuple.
    """
    due = records_after(records.where(F.col("operationName") == NSG_FLOW_OPERATION), after)
    judged = f"transform(array({_flows_sql(due)}), flows -> struct(flows, {_accepted_sql(due, 'flows')} AS accepted))"
    one = due.select("file", "record_pos", "properties", F.explode(F.expr(judged)).alias("judged"))
    accepted = F.col("judged.accepted")
    kept = ["file", "record_pos", "accepted", "record_raw"]
    rows = one.select(
        "file",
        "record_pos",
        accepted.alias("accepted"),
        F.when(~accepted, F.to_json("properties")).alias("record_raw"),
        F.when(accepted, F.col("judged.flows")).alias("flows"),
    )
    tuples = _exploded(rows, kept, F.posexplode_outer)
    bad = tuples.where(~F.col("accepted") | (F.col("tuple").isNotNull() & _is_bad()))
    kind, message = _tuple_error()
    whole = ~F.col("accepted")
    return bad.select(
        "file",
        F.when(whole, position("record_pos")).otherwise(F.col("pos")).alias("pos"),
        F.when(whole, "record").otherwise(kind).alias("kind"),
        F.when(whole, RECORD_MESSAGE).otherwise(message).alias("message"),
        F.when(whole, F.col("record_raw")).otherwise(F.col("tuple")).alias("raw"),
    )


def accepted_flow_records(records: DataFrame) -> DataFrame:
    return records.where(_accepted(records))


def rejected_flow_records(records: DataFrame, after=None) -> DataFrame:
    """Flow records that are due and yield nothing, because a field is missing or has another type."""
    due = records_after(records.where(F.col("operationName") == NSG_FLOW_OPERATION), after)
    return due.where(~_accepted(due))


# Acceptance is a property of the whole record: one wrong field and none of its tuples count, so it
# is decided on the nested arrays, before any explode.


def _is_typed(records: DataFrame) -> bool:
    return isinstance(records.schema["properties"].dataType, T.StructType)


def _flows_sql(records: DataFrame) -> str:
    if _is_typed(records):
        return f"CAST(properties.flows AS {FLOWS_TYPE})"
    return f"try_variant_get(properties, '$.flows', '{FLOWS_TYPE}')"


def _accepted(records: DataFrame) -> Column:
    return F.expr(_accepted_sql(records, _flows_sql(records)))


def _accepted_sql(records: DataFrame, flows: str) -> str:
    """Condition that a record is accepted; ``flows`` is its nested arrays."""
    if _is_typed(records):
        return _well_formed(flows, "{} IS NOT NULL", "{} IS NOT NULL", "{}")
    # Reading leaves as text is fast but also turns numbers and nested values into text. Leaves
    # that cannot have been anything but text settle most records; the others are read again with
    # their JSON types.
    surely = _well_formed(flows, _SURELY_TEXT, _SURELY_TUPLE, "{}")
    typed = f"try_variant_get(properties, '$.flows', '{FLOWS_VARIANT_TYPE}')"
    exact = _well_formed(typed, _IS_TEXT, _IS_TEXT, "try_variant_get({}, '$', 'string')")
    return f"(({surely}) OR ({exact}))"


_IS_TEXT = "coalesce(schema_of_variant({}) = 'STRING', false)"
# Not how a JSON number, boolean, object or array would read as text.
_SURELY_TEXT = (
    r"coalesce(NOT {} RLIKE r'^(-?(0|[1-9]\d*)(\.\d+)?(E-?\d+)?$|true$|false$|[\[{{])', false)"
)
_SURELY_TUPLE = "coalesce(instr({0}, ',') > 0 AND left({0}, 1) NOT IN ('[', '{{'), false)"


def _well_formed(flows: str, is_text: str, is_tuple_text: str, as_text: str) -> str:
    """SQL condition that the nested arrays are all there and their leaves are text.

    The templates say, for a leaf, whether it is text and how to read it as text. A group without a
    mac is harmless until an 8-token tuple needs it.
    """
    tokens = f"size(split({as_text.format('t')}, ',', -1))"
    group_ok = f"""
        coalesce(forall(g.flowTuples, t -> {is_tuple_text.format("t")}), false)
        AND ({is_text.format("g.mac")} OR NOT exists(g.flowTuples, t -> {tokens} = {X.TUPLE_TOKENS}))
    """
    flow_ok = f"{is_text.format('f.rule')} AND coalesce(forall(f.flows, g -> {group_ok}), false)"
    return f"coalesce(forall({flows}, f -> {flow_ok}), false)"
