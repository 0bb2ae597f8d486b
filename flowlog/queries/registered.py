"""Registered queries: each operator over logs derived from the tables, with its SQL twin.

Texts and epochs stand in for maps and timestamps, so that results compare across engines. Every
query covers the whole of its tables.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import paths as P
from ..functions import text as X
from ..operators import events as E
from ..operators import families, flow, gateway, progress
from ..operators import records as R
from ..plans import status as S
from ..plans.incremental import job_summary, run_incremental, run_polling
from ..schemas import LOG_DDL
from ..sinks.files import file_sink
from ..sinks.syslog import syslog_sink, write_syslog
from ..sources import logs
from ..sources.events import read_cef_json
from ..streaming.stream import start_stream
from . import derive as D
from .sql import (
    ACCESS,
    EVENTS,
    FIREWALL,
    FLOW_OPERATION,
    LISTING,
    RECORDS,
    TUPLES,
    documents,
    hour_path,
    json_escaped,
    mac,
    nsg_rid,
    rid,
    stamp,
    with_,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def c(name: str):
    return F.col(name)


def epoch(name: str):
    return F.unix_seconds(name)


POS = ["pos.record_pos", "pos.flow_pos", "pos.group_pos", "pos.tuple_pos"]

# --- flow records -------------------------------------------------------------------------------


@query(
    with_(
        EVENTS,
        f"""SELECT file, record_pos, flow_pos, group_pos, tuple_pos, epoch, severity,
  '{FLOW_OPERATION}' AS device_event_class_id, 'NetworkSecurityGroupFlowEvent' AS name,
  'Azure NSG' AS device_product, ext AS extension FROM ev""",
    )
)
def flow_events(spark, sf_dir):
    events = flow.flow_events(D.flow_records(spark, sf_dir))
    return events.select(
        "file", *POS, "epoch", "severity", "device_event_class_id", "name", "device_product",
        c("extension_text").alias("extension"),
    )


@query(
    with_(
        EVENTS,
        """SELECT k % 20 AS source_group, severity, proto, direction, count(*) AS events,
  CAST(sum(epoch) AS BIGINT) AS epoch_sum, count(DISTINCT src_ip) AS sources FROM ev GROUP BY ALL""",
    )
)
def flow_event_report(spark, sf_dir):
    events = flow.flow_events(D.flow_records(spark, sf_dir))
    ext = c("extension")
    rows = events.select(
        (F.regexp_extract("file", "NSG-([0-9]+)", 1).cast("bigint") % 20).alias("source_group"),
        "severity",
        ext["proto"].alias("proto"),
        ext["deviceDirection"].cast("int").alias("direction"),
        "epoch",
        ext["src"].alias("src"),
    )
    return rows.groupBy("source_group", "severity", "proto", "direction").agg(
        F.count("*").alias("events"),
        F.sum("epoch").alias("epoch_sum"),
        F.count_distinct("src").alias("sources"),
    )


@query(
    """SELECT o_custkey % 50 AS source_group, (o_orderkey + n) % 7 = 0 AS denied,
  n % 5 % 2 = 1 AS tcp, n // 5 % 2 AS direction, 'Rule_' || (n // 10) AS rule, count(*) AS events,
  CAST(sum(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * 86400 + o_orderkey % 86400 + n)
    AS BIGINT) AS epoch_sum,
  CAST(sum(1024 + (o_orderkey + n) % 60000) AS BIGINT) AS port_sum
FROM orders, (SELECT UNNEST(range(20)) AS n) ns GROUP BY ALL"""
)
def dense_flow_report(spark, sf_dir):
    """Records of twenty tuples in two flows and four groups."""
    events = flow.flow_events(D.dense_flow_records(spark, sf_dir))
    ext = c("extension")
    rows = events.select(
        (F.regexp_extract("file", "NSG-([0-9]+)", 1).cast("bigint") % 50).alias("source_group"),
        (c("severity") == 6).alias("denied"),
        (ext["proto"] == "TCP").alias("tcp"),
        ext["deviceDirection"].cast("bigint").alias("direction"),
        ext["cs1"].alias("rule"),
        "epoch",
        ext["spt"].cast("bigint").alias("port"),
    )
    return rows.groupBy("source_group", "denied", "tcp", "direction", "rule").agg(
        F.count("*").alias("events"),
        F.sum("epoch").alias("epoch_sum"),
        F.sum("port").alias("port_sum"),
    )


TUPLE_TEXT = (
    "concat_ws(',', tok0, src_ip, dst_ip, spt, dpt, proto_code, dir_code, "
    "CASE WHEN whole THEN decision END)"
)
TUPLE_ERRORS = f"""SELECT file, record_pos, flow_pos, group_pos, tuple_pos,
  CASE WHEN whole THEN 'epoch' ELSE 'token_count' END AS kind,
  CASE WHEN whole THEN 'strconv.ParseInt: parsing "' || tok0 || '": invalid syntax'
    ELSE 'unexpected # tokens in tuple ' || {TUPLE_TEXT} || '. expected 8' END AS message,
  {TUPLE_TEXT} AS raw
FROM tup WHERE NOT whole OR tok0 IN ('abcde', ' 12')"""
REJECTED = f"""SELECT file, record_pos, 0 AS flow_pos, 0 AS group_pos, 0 AS tuple_pos, 'record' AS kind
FROM rec WHERE op = '{FLOW_OPERATION}' AND time_epoch IS NOT NULL AND NOT accepted"""


@query(with_(TUPLES, TUPLE_ERRORS))
def flow_tuple_errors(spark, sf_dir):
    errors = flow.flow_tuple_errors(D.flow_records(spark, sf_dir))
    return errors.select("file", *POS, "kind", "message", "raw")


@query(with_(RECORDS, REJECTED))
def flow_rejected_records(spark, sf_dir):
    rejected = families.rejected_records(D.flow_records(spark, sf_dir), P.NSG)
    return rejected.select("file", *POS, "kind")


@query(
    with_(
        TUPLES,
        f"""SELECT file, record_pos, flow_pos, group_pos, tuple_pos, kind FROM ({TUPLE_ERRORS})
UNION ALL {REJECTED}""",
    )
)
def rejects(spark, sf_dir):
    return families.rejects(D.flow_records(spark, sf_dir), P.NSG).select("file", *POS, "kind")


@query(
    with_(
        TUPLES,
        """SELECT file, record_pos, count(*) AS error_count FROM tup
WHERE NOT whole OR tok0 IN ('abcde', ' 12') GROUP BY ALL""",
    )
)
def error_counts(spark, sf_dir):
    return progress.error_counts(flow.flow_tuple_errors(D.flow_records(spark, sf_dir)))


@query(with_(RECORDS, "SELECT file, record_pos FROM rec WHERE accepted"))
def accepted_records(spark, sf_dir):
    records = D.flow_records(spark, sf_dir)
    return families.accepted_records(records, P.NSG).select("file", "record_pos")


SPLIT_AT = datetime(1998, 1, 1, 2, 0, 33)
SPLIT_EPOCH = 883620033


@query(with_(RECORDS, f"SELECT file, record_pos, time_epoch FROM rec WHERE time_epoch > {SPLIT_EPOCH}"))
def records_after(spark, sf_dir):
    records = R.records_after(D.flow_records(spark, sf_dir), SPLIT_AT)
    return records.select("file", "record_pos", epoch("time").alias("time_epoch"))


@query(with_(RECORDS, f"SELECT file, record_pos, time_epoch FROM rec WHERE time_epoch < {SPLIT_EPOCH}"))
def records_before(spark, sf_dir):
    records = R.records_before(D.flow_records(spark, sf_dir), SPLIT_AT)
    return records.select("file", "record_pos", epoch("time").alias("time_epoch"))


@query(with_(RECORDS, "SELECT op AS operation, count(*) AS records FROM rec WHERE op <> 'Other' GROUP BY ALL"))
def operation_dispatch(spark, sf_dir):
    records = R.dispatch_operation(D.flow_records(spark, sf_dir), P.NSG)
    return records.groupBy(c("operationName").alias("operation")).agg(F.count("*").alias("records"))


@query(with_(EVENTS, "SELECT 'NetworkSecurityGroupFlowEvents' AS class_id, count(*) AS events FROM ev"))
def rule_counter_events(spark, sf_dir):
    """All operations of the family: rule-counter records add no events."""
    events = families.family_events(D.flow_records(spark, sf_dir), P.NSG)
    return events.groupBy(c("device_event_class_id").alias("class_id")).agg(F.count("*").alias("events"))


@query(
    with_(
        RECORDS,
        """SELECT file, record_pos,
  CASE WHEN rid LIKE 'UNMATCHED%' THEN '' ELSE 'SUB' || (k % 3) END AS subscription_id,
  CASE WHEN rid LIKE 'UNMATCHED%' THEN '' ELSE 'RG' || (k % 5) END AS resource_group,
  CASE WHEN rid LIKE 'UNMATCHED%' THEN ''
    ELSE 'NSG-' || k || CASE WHEN k % 11 = 0 THEN '/' ELSE '' END END AS resource_name FROM rec""",
    )
)
def nsg_resource_split(spark, sf_dir):
    split = P.split_nsg_resource(c("resourceId"))
    return D.flow_records(spark, sf_dir).select(
        "file", "record_pos", *[v.alias(k) for k, v in split.items()]
    )


@query(
    with_(
        ACCESS,
        "SELECT event_id, sub AS subscription_id, rg AS resource_group, gw AS resource_name FROM acc",
    )
)
def gateway_resource_split(spark, sf_dir):
    split = P.split_gateway_resource(c("resourceId"))
    return D.access_records(spark, sf_dir).select(
        c("record_pos").alias("event_id"), *[v.alias(k) for k, v in split.items()]
    )


# --- fields of flow events ----------------------------------------------------------------------


@query(
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {mac("format('{:X}', l_partkey * 37 + l_orderkey)")} AS mac
FROM lineitem"""
)
def format_mac(spark, sf_dir):
    li = D.table(spark, sf_dir, "lineitem")
    text = F.hex(c("l_partkey") * 37 + c("l_orderkey"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", X.format_mac(text).alias("mac"))


@query(with_(EVENTS, "SELECT proto_code, proto, count(*) AS events FROM ev GROUP BY ALL"))
def protocol_name(spark, sf_dir):
    code = c("tokens")[5]
    tuples = flow.flow_tuples(D.flow_records(spark, sf_dir)).where(F.size("tokens") == 8)
    named = tuples.select(code.alias("proto_code"), X.protocol_name(code).alias("proto"))
    return named.groupBy("proto_code", "proto").agg(F.count("*").alias("events"))


@query(
    with_(
        EVENTS,
        """SELECT file, record_pos, flow_pos, group_pos, tuple_pos, CAST(direction AS VARCHAR) AS direction,
  CASE WHEN direction = 0 THEN mac END AS dmac, CASE WHEN direction = 1 THEN mac END AS smac FROM ev""",
    )
)
def direction_mac(spark, sf_dir):
    ext = c("extension")
    return flow.flow_events(D.flow_records(spark, sf_dir)).select(
        "file", *POS, ext["deviceDirection"].alias("direction"), ext["dmac"].alias("dmac"),
        ext["smac"].alias("smac"),
    )


@query(with_(EVENTS, "SELECT decision, outcome, severity, count(*) AS events FROM ev GROUP BY ALL"))
def outcome_severity(spark, sf_dir):
    code = c("tokens")[7]
    tuples = flow.flow_tuples(D.flow_records(spark, sf_dir)).where(F.size("tokens") == 8)
    named = tuples.select(
        code.alias("decision"), X.outcome_name(code).alias("outcome"), X.outcome_severity(code).alias("severity")
    )
    return named.groupBy("decision", "outcome", "severity").agg(F.count("*").alias("events"))


@query(
    with_(
        EVENTS,
        """SELECT file, record_pos, flow_pos, group_pos, tuple_pos, epoch AS time_epoch,
  CAST(epoch * 1000 AS VARCHAR) AS start FROM ev""",
    )
)
def event_time_start(spark, sf_dir):
    events = flow.flow_events(D.flow_records(spark, sf_dir))
    return events.select(
        "file", *POS, epoch("time").alias("time_epoch"), c("extension")["start"].alias("start")
    )


@query(
    with_(
        TUPLES,
        f"""SELECT CASE WHEN whole THEN 8 ELSE 7 END AS tokens, src_ip, count(*) AS tuples
FROM tup GROUP BY ALL""",
    )
)
def split_tuple(spark, sf_dir):
    tuples = flow.flow_tuples(D.flow_records(spark, sf_dir))
    parts = X.split_tuple(c("tuple"))
    rows = tuples.select(F.size(parts).alias("tokens"), parts[1].alias("src_ip"))
    return rows.groupBy("tokens", "src_ip").agg(F.count("*").alias("tuples"))


# --- text of events -----------------------------------------------------------------------------


@query(with_(EVENTS, "SELECT record_pos, flow_pos, tuple_pos, file, header || ext AS line FROM ev"))
def cef_text(spark, sf_dir):
    events = flow.flow_events(D.flow_records(spark, sf_dir))
    return events.select(
        "pos.record_pos", "pos.flow_pos", "pos.tuple_pos", "file", E.cef_column(events).alias("line")
    )


@query(
    """SELECT event_id, CASE WHEN pairs = '' THEN '' ELSE '|' || trim(pairs, ' ' || chr(160)) END AS extension FROM (
  SELECT event_id, concat_ws(' ',
    'Upper=' || user_id, 'a=' || event_type || CASE WHEN event_id % 2 = 0 THEN chr(160) ELSE '' END,
    CASE WHEN event_id % 3 <> 0 THEN 'b=' || event_id || '\\=' || user_id END,
    'props=' || replace(props, '=', '\\='),
    CASE WHEN event_id % 5 <> 0 THEN 'z=' || event_type || chr(160) || '  ' END) AS pairs
  FROM events WHERE event_id % 11 <> 0
  UNION ALL SELECT event_id, '' FROM events WHERE event_id % 11 = 0)"""
)
def extension_text(spark, sf_dir):
    """Any extension map: key order, empty values, escapes, trailing white space, an empty map."""
    event, space = c("event_id"), F.lit(chr(160))
    nothing = event % 11 == 0

    def entry(value, shown=None):
        value = value if shown is None else F.when(shown, value).otherwise("")
        return F.when(nothing, "").otherwise(value)

    entries = {
        "z": entry(F.concat("event_type", space, F.lit("  ")), event % 5 != 0),
        "props": entry(c("props")),
        "a": entry(F.concat("event_type", F.when(event % 2 == 0, space).otherwise(""))),
        "Upper": entry(c("user_id").cast("string")),
        "b": entry(F.concat(event.cast("string"), F.lit("="), c("user_id").cast("string")), event % 3 != 0),
    }
    extension = F.create_map(*[x for k, v in entries.items() for x in (F.lit(k), v)])
    rows = D.table(spark, sf_dir, "events").select("event_id", extension.alias("extension"))
    return rows.select("event_id", X.extension_text(c("extension")).alias("extension"))


@query(
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 1 ELSE 2 END AS kept,
  CASE WHEN event_id % 3 = 0 THEN 'type' ELSE 'prop,type' END AS keys FROM events"""
)
def drop_empty(spark, sf_dir):
    """Empty entries leave the map; the rest come out by key."""
    extension = F.create_map(
        F.lit("type"), c("event_type"), F.lit("prop"), F.when(c("event_id") % 3 == 0, "").otherwise(c("props"))
    )
    kept = X.sorted_entries(X.drop_empty(c("extension")))
    rows = D.table(spark, sf_dir, "events").select("event_id", extension.alias("extension"))
    keys = F.array_join(F.transform(kept, lambda e: e["key"]), ",")
    return rows.select("event_id", F.size(kept).alias("kept"), keys.alias("keys"))


@query("SELECT doc_id, replace(text, '=', '\\=') AS escaped FROM documents")
def cef_escape(spark, sf_dir):
    return D.table(spark, sf_dir, "documents").select("doc_id", X.cef_escape(c("text")).alias("escaped"))


@query(
    with_(ACCESS, "SELECT event_id, strftime(t, '%b %d %H:%M:%S') || '|' || header || ext AS line FROM access")
)
def syslog_text(spark, sf_dir):
    events = gateway.access_events(D.access_records(spark, sf_dir))
    return events.select(c("pos.record_pos").alias("event_id"), E.syslog_column(events).alias("line"))


@query(
    with_(
        FIREWALL,
        f"""SELECT doc, strftime({stamp("time_epoch")}, '%b %d %H:%M:%S') || ' host1 '
  || split_part(header || ext, chr(10), 1) AS line FROM firewall""",
    )
)
def syslog_frame(spark, sf_dir):
    """Messages hold line breaks here, so most lines end early."""
    lines = E.syslog_lines(gateway.firewall_events(D.firewall_records(spark, sf_dir)), "host1")
    return lines.select(c("pos.record_pos").alias("doc"), "line")


@query(
    """SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'Jul 14 02:40:00 host1 ' || text
  ELSE 'a|CEF b host1 CEF:' || split_part(text, chr(10), 1) END AS line FROM documents"""
)
def syslog_frame_any_content(spark, sf_dir):
    """Content without a time goes out whole; the last ``|CEF`` of the first line splits the rest."""
    docs = D.table(spark, sf_dir, "documents")
    timed = F.concat(F.lit("a|CEF b|CEF:"), c("text"))
    content = F.when(c("doc_id") % 2 == 0, c("text")).otherwise(timed)
    now = F.timestamp_seconds(F.lit(1500000000))
    return docs.select("doc_id", X.syslog_frame(content, "host1", now).alias("line"))


@query(
    with_(
        ACCESS,
        """SELECT event_id, '{"cef_version":0,"device_vendor":"Microsoft","device_product":"Azure Application Gateway",'
  || '"device_version":"1","device_event_class_id":"ApplicationGatewayAccessLog","time":"'
  || strftime(t, '%Y-%m-%dT%H:%M:%SZ') || '","name":"' || gw || '","severity":0,"extension":{"act":"' || method
  || '","cs1":"' || uri || '","cs1label":"requestUri","cs2":"' || gw
  || '","cs2label":"Azure Application Gateway","cs3":"' || sub || '","cs3label":"Subscription ID","cs4":"' || rg
  || '","cs4label":"Resource Group","msg":' || CAST(to_json(msg) AS VARCHAR) || ',"request":"' || uri
  || '","requestMethod":"' || method || '","spt":"' || port_text || '","src":"' || ip || '"}}' AS event
FROM access""",
    )
)
def event_json(spark, sf_dir):
    events = gateway.access_events(D.access_records(spark, sf_dir))
    return events.select(c("pos.record_pos").alias("event_id"), E.event_json(events).alias("event"))


# --- gateway records ----------------------------------------------------------------------------


@query(
    with_(
        ACCESS,
        """SELECT file, event_id, time_epoch, gw AS name, 'ApplicationGatewayAccessLog' AS class_id,
  0 AS severity, ext AS extension FROM access""",
    )
)
def access_events(spark, sf_dir):
    events = gateway.access_events(D.access_records(spark, sf_dir))
    return events.select(
        "file", c("pos.record_pos").alias("event_id"), epoch("time").alias("time_epoch"), "name",
        c("device_event_class_id").alias("class_id"), "severity", c("extension_text").alias("extension"),
    )


@query(
    with_(
        FIREWALL,
        """SELECT file, doc, time_epoch, gw AS name, 'ApplicationGatewayFirewallLog' AS class_id,
  ext AS extension FROM firewall""",
    )
)
def firewall_events(spark, sf_dir):
    events = gateway.firewall_events(D.firewall_records(spark, sf_dir))
    return events.select(
        "file", c("pos.record_pos").alias("doc"), epoch("time").alias("time_epoch"), "name",
        c("device_event_class_id").alias("class_id"), c("extension_text").alias("extension"),
    )


@query(
    with_(
        f"{ACCESS}, {FIREWALL}",
        """SELECT 'access' AS family, event_id AS id FROM acc WHERE event_id % 50 = 0 AND event_id % 23 <> 0
UNION ALL SELECT 'firewall', doc FROM facc WHERE doc % 41 = 0""",
    )
)
def gateway_rejected_records(spark, sf_dir):
    access = families.rejected_records(D.access_records(spark, sf_dir), P.ACCESS)
    firewall = families.rejected_records(D.firewall_records(spark, sf_dir), P.FIREWALL)
    return E.union_events(
        access.select(F.lit("access").alias("family"), c("pos.record_pos").alias("id")),
        firewall.select(F.lit("firewall").alias("family"), c("pos.record_pos").alias("id")),
    )


@query(
    f"""SELECT page_id, {json_escaped("""'{"a":' || page_id || ',"html":' || CAST(to_json(html) AS VARCHAR) """
    """|| ',"z":{"b":' || (page_id * 0.5)::DECIMAL(18,1) || ',"url":"' || url || '"}}'""")}
  AS properties FROM pages"""
)
def properties_json(spark, sf_dir):
    """Whole web pages as properties: markup, quotes and line breaks to escape."""
    half = F.concat(F.floor(c("page_id") / 2).cast("string"), F.when(c("page_id") % 2 == 0, ".0").otherwise(".5"))
    nested = F.struct(c("url").alias("url"), half.alias("b"))
    properties = F.to_variant_object(F.struct(nested.alias("z"), c("html").alias("html"), c("page_id").alias("a")))
    text = X.properties_json(c("properties"))
    # The half is written as text so that both engines print the same digits.
    unquoted = F.regexp_replace(text, r'"b":"(\d+\.\d)"', '"b":$1')
    return D.table(spark, sf_dir, "pages").select("page_id", properties.alias("properties")).select(
        "page_id", unquoted.alias("properties")
    )


@query(
    with_(
        f"{ACCESS}, {FIREWALL}",
        """SELECT 'access' AS family, event_id AS id, port_text AS port FROM acc WHERE event_id % 50 <> 0
UNION ALL SELECT 'firewall', doc, port_text FROM facc""",
    )
)
def port_text(spark, sf_dir):
    p, pos = c("properties"), c("record_pos").alias("id")
    access = D.access_records(spark, sf_dir).where(X.is_number(X.property_value(p, "clientPort")))
    firewall = D.firewall_records(spark, sf_dir)
    return E.union_events(
        access.select(F.lit("access").alias("family"), pos, X.access_port(p).alias("port")),
        firewall.select(F.lit("firewall").alias("family"), pos, X.firewall_port(p).alias("port")),
    )


@query(
    with_(
        f"{EVENTS}, {ACCESS.replace('src AS', 'asrc AS').replace('FROM src', 'FROM asrc')}, {FIREWALL}",
        """SELECT product, class_id, severity, count(*) AS events, CAST(sum(epoch) AS BIGINT) AS epoch_sum FROM (
  SELECT 'Azure NSG' AS product, 'NetworkSecurityGroupFlowEvents' AS class_id, severity, epoch FROM ev
  UNION ALL SELECT 'Azure Application Gateway', 'ApplicationGatewayAccessLog', 0, time_epoch FROM access
  UNION ALL SELECT 'Azure Application Gateway', 'ApplicationGatewayFirewallLog', 0, time_epoch FROM firewall)
GROUP BY ALL""",
    )
)
def event_union(spark, sf_dir):
    events = E.union_events(
        flow.flow_events(D.flow_records(spark, sf_dir)),
        gateway.access_events(D.access_records(spark, sf_dir)),
        gateway.firewall_events(D.firewall_records(spark, sf_dir)),
    )
    keys = [c("device_product").alias("product"), c("device_event_class_id").alias("class_id"), "severity"]
    return events.groupBy(*keys).agg(F.count("*").alias("events"), F.sum("epoch").alias("epoch_sum"))


# --- paths --------------------------------------------------------------------------------------


@query(with_(LISTING, "SELECT name, nsg_name, log_epoch FROM logs"))
def path_name_time(spark, sf_dir):
    parsed = logs.parse_listing(D.listing(spark, sf_dir))
    return parsed.select("name", "nsg_name", epoch("log_time").alias("log_epoch"))


@query(with_(LISTING, "SELECT name FROM listing WHERE k = 48"))
def rejected_paths(spark, sf_dir):
    return logs.rejected_paths(D.listing(spark, sf_dir)).select(c("file").alias("name"))


@query(
    with_(LISTING, f"SELECT name, nsg_name || '-' || strftime({stamp('log_epoch')}, '%Y-%m-%d-%H') AS short_name FROM logs")
)
def short_name(spark, sf_dir):
    return logs.parse_listing(D.listing(spark, sf_dir)).select("name", "short_name")


@query(
    f"""SELECT o_orderkey, 'resourceId=' || {nsg_rid("o_custkey")}
  || {hour_path("o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT))")} AS path FROM orders"""
)
def source_path(spark, sf_dir):
    time = F.timestamp_seconds(F.unix_date(F.to_date("o_orderdate")).cast("bigint") * 86400 + c("o_orderkey") % 24 * 3600)
    path = P.source_path(D.nsg_resource_id(c("o_custkey")), time)
    return D.table(spark, sf_dir, "orders").select("o_orderkey", path.alias("path"))


@query(
    with_(
        RECORDS,
        f"""SELECT op AS operation, CASE op WHEN '{FLOW_OPERATION}' THEN 'insights-logs-networksecuritygroupflowevent'
  WHEN 'NetworkSecurityGroupEvents' THEN 'insights-logs-networksecuritygroupevent' ELSE '' END AS container,
  'nsg' AS family, count(*) AS records FROM rec GROUP BY ALL
UNION ALL SELECT CASE WHEN event_id % 23 = 0 THEN 'ApplicationGatewayFirewall' ELSE 'ApplicationGatewayAccess' END,
  CASE WHEN event_id % 23 = 0 THEN 'insights-logs-applicationgatewayfirewalllog'
    ELSE 'insights-logs-applicationgatewayaccesslog' END,
  CASE WHEN event_id % 23 = 0 THEN 'firewall' ELSE 'access' END, count(*) FROM events GROUP BY ALL""",
    )
)
def source_container(spark, sf_dir):
    """Container of each operation, and the family the router reads that container as."""
    operation = c("operationName")
    records = E.union_events(
        D.flow_records(spark, sf_dir).select(operation), D.access_records(spark, sf_dir).select(operation)
    )
    container = P.source_container(operation)
    named = records.select(
        operation.alias("operation"), container.alias("container"), P.log_family(container).alias("family")
    )
    return named.groupBy("operation", "container", "family").agg(F.count("*").alias("records"))


@query(
    with_(
        LISTING,
        """SELECT name, CASE WHEN k <> 48 THEN 'nsgLog-' || nsg_name || '-' || strftime(day, '%Y')
  || CASE WHEN k = 49 THEN '13' ELSE strftime(day, '%m') END || strftime(day, '%d')
  || lpad(CAST(last_order % 24 AS VARCHAR), 2, '0') || '00-' || modified || '-' || (modified + length) || '.json'
  END AS output_name FROM listing""",
    )
)
def output_name(spark, sf_dir):
    first = epoch("last_modified")
    name = P.output_name(c("name"), first, first + c("length"))
    return D.listing(spark, sf_dir).select("name", name.alias("output_name"))


# --- selection and status -----------------------------------------------------------------------

BEGIN = "1996-06-15-12"
BEGIN_EPOCH = 834840000


@query(with_(LISTING, f"SELECT name, log_epoch FROM logs WHERE log_epoch > {BEGIN_EPOCH}"))
def begin_time_filter(spark, sf_dir):
    parsed = logs.parse_listing(D.listing(spark, sf_dir))
    return S.begin_time_filter(parsed, BEGIN).select("name", epoch("log_time").alias("log_epoch"))


JOINED = """SELECT l.name, l.modified, s.modified AS known_modified, s.record_epoch, s.last_ts, s.last_end
FROM logs l LEFT JOIN known s ON l.name = s.name"""


def _joined(rows: DataFrame) -> DataFrame:
    return rows.select(
        "name",
        epoch("last_modified").alias("modified"),
        epoch("known_modified").alias("known_modified"),
        epoch("last_processed_record").alias("record_epoch"),
        c("last_processed_timestamp").alias("last_ts"),
        c("last_processed_range.End").alias("last_end"),
    )


@query(with_(LISTING, JOINED))
def join_status(spark, sf_dir):
    listing = logs.parse_listing(D.listing(spark, sf_dir))
    return _joined(S.join_status(listing, D.status(spark, sf_dir)))


@query(with_(LISTING, f"{JOINED} WHERE s.name IS NULL OR l.modified > s.modified"))
def unprocessed_files(spark, sf_dir):
    listing = logs.parse_listing(D.listing(spark, sf_dir))
    return _joined(S.unprocessed_files(listing, D.status(spark, sf_dir)))


@query(
    with_(
        LISTING,
        """SELECT name, modified, CASE WHEN k % 2 = 0 THEN last_count + 5 ELSE last_count END AS last_count
FROM (SELECT l.k, s.* FROM known s JOIN logs l ON l.name = s.name)""",
    )
)
def status_upsert(spark, sf_dir):
    old = D.status(spark, sf_dir)
    even = F.regexp_extract("name", "NSG-([0-9]+)", 1).cast("int") % 2 == 0
    new = old.where(even).withColumn("last_count", c("last_count") + 5)
    merged = S.upsert_status(old, new)
    return merged.select("name", epoch("last_modified").alias("modified"), "last_count")


# --- per-file aggregates ------------------------------------------------------------------------


@query(with_(RECORDS, "SELECT file, CAST(count(*) AS INT) AS last_count FROM rec GROUP BY ALL"))
def file_record_counts(spark, sf_dir):
    return progress.file_record_counts(D.flow_records(spark, sf_dir))


@query(with_(EVENTS, "SELECT file, count(*) AS event_count FROM ev GROUP BY ALL"))
def event_counts(spark, sf_dir):
    return progress.event_counts(flow.flow_events(D.flow_records(spark, sf_dir)))


BOUNDS = """SELECT file, arg_min(epoch, pos) AS first_epoch, arg_max(epoch, pos) AS last_epoch, count(*) AS event_count
FROM (SELECT *, record_pos * 8 + flow_pos * 4 + group_pos * 2 + tuple_pos AS pos FROM ev) GROUP BY file"""


@query(with_(EVENTS, BOUNDS))
def file_event_bounds(spark, sf_dir):
    return progress.file_event_bounds(flow.flow_events(D.flow_records(spark, sf_dir)))


LAST_RECORD = """SELECT file, arg_max(time_epoch, record_pos) FILTER (WHERE time_epoch IS NOT NULL) AS last_record_epoch
FROM rec GROUP BY file"""


@query(with_(RECORDS, LAST_RECORD))
def last_record_time(spark, sf_dir):
    last = progress.last_record_time(D.flow_records(spark, sf_dir))
    return last.select("file", epoch("last_processed_record").alias("last_record_epoch"))


@query(
    with_(
        EVENTS,
        f"""SELECT file, coalesce(last_epoch, last_record_epoch) AS last_processed_timestamp
FROM ({LAST_RECORD}) r LEFT JOIN ({BOUNDS}) b USING (file)""",
    )
)
def last_processed_timestamp(spark, sf_dir):
    records = D.flow_records(spark, sf_dir)
    return progress.last_processed_timestamp(records, flow.flow_events(records))


@query(
    with_(
        RECORDS,
        """SELECT row_number() OVER (ORDER BY time_epoch NULLS FIRST, file, record_pos) - 1 AS rank,
  file, record_pos, time_epoch FROM rec""",
    )
)
def record_order(spark, sf_dir):
    """The place of each record in the order: its partition's first place and its place there."""
    records = R.sort_records(D.flow_records(spark, sf_dir).drop("properties"))
    path = D.scratch(spark, "record_order")
    mid = F.monotonically_increasing_id()
    numbered = records.select("file", "record_pos", epoch("time").alias("time_epoch"), mid.alias("mid"))
    numbered.write.parquet(path)
    stored = spark.read.parquet(path).withColumn("part", F.shiftrightunsigned("mid", 33))
    parts = stored.groupBy("part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = stored.join(parts.select("part", before.alias("before")), "part")
    rank = c("before") + c("mid").bitwiseAND((1 << 33) - 1)
    return placed.select(rank.alias("rank"), "file", "record_pos", "time_epoch")


ARRAY_EVENT = """'{"cef_version":0,"device_vendor":"Microsoft","device_product":"Azure Application Gateway",'
  || '"device_version":"1","device_event_class_id":"ApplicationGatewayFirewallLog","time":"'
  || strftime(make_timestamp(time_epoch * 1000000), '%Y-%m-%dT%H:%M:%SZ') || '","name":"' || gw
  || '","severity":0,"extension":{"act":"' || action || '","cs1":"' || uri
  || '","cs1label":"requestUri","cs2":"' || gw || '","cs2label":"Azure Application Gateway","cs3":"' || sub
  || '","cs3label":"Subscription ID","cs4":"' || rg || '","cs4label":"Resource Group","cs5":'
  || CAST(to_json(message) AS VARCHAR) || ',"cs5label":"message","cs6":"' || instance
  || '","cs6label":"instanceId","msg":' || CAST(to_json(msg) AS VARCHAR) || ',"spt":"' || port_text
  || '","src":"' || ip || '"}}'"""


@query(
    with_(
        FIREWALL,
        f"""SELECT file, CAST(doc // 60 AS INT) AS chunk, CAST(count(*) AS INT) AS event_count,
  '[' || string_agg({ARRAY_EVENT}, ',' ORDER BY doc) || ']' AS events FROM firewall GROUP BY ALL""",
    )
)
def ordered_event_array(spark, sf_dir):
    return E.ordered_event_array(gateway.firewall_events(D.firewall_records(spark, sf_dir)), 60)


@query(
    with_(
        FIREWALL,
        f"""SELECT file, doc AS record_pos, CASE WHEN row_number() OVER w = 1 THEN '[' ELSE ',' END || {ARRAY_EVENT}
  || CASE WHEN lead(doc) OVER w IS NULL THEN ']' ELSE '' END AS value
FROM firewall WINDOW w AS (PARTITION BY file ORDER BY doc)""",
    )
)
def event_array_rows(spark, sf_dir):
    """One array per log file, an event per row."""
    rows = E.event_array_rows(gateway.firewall_events(D.firewall_records(spark, sf_dir)))
    return rows.select("file", "pos.record_pos", "value")


@query(
    with_(
        RECORDS,
        f"""SELECT file, strftime({stamp("time_epoch")}, '%Y-%m-%dT%H:%M:%S') AS last_modified,
  CASE WHEN rid LIKE 'UNMATCHED%' THEN ''
    ELSE 'NSG-' || k || CASE WHEN k % 11 = 0 THEN '/' ELSE '' END END AS nsg_name,
  'resourceId=' || rid || {hour_path(stamp("time_epoch"))} AS name, time_epoch - time_epoch % 3600 AS log_epoch
FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY record_pos) AS nth FROM rec
  WHERE time_epoch IS NOT NULL) WHERE nth = 1""",
    )
)
def log_file_from_records(spark, sf_dir):
    """The first record of a file that has a time, wherever it stands."""
    rows = R.log_file_from_records(D.flow_records(spark, sf_dir), P.NSG)
    modified = F.date_format(X.wall_clock(c("last_modified")), "yyyy-MM-dd'T'HH:mm:ss")
    return rows.select(
        "file", modified.alias("last_modified"), "nsg_name", "name", epoch("log_time").alias("log_epoch")
    )


# --- files --------------------------------------------------------------------------------------
# These write log documents derived from the tables to the shared folder and read them back.


def _documents(spark, sf_dir, root, **options) -> str:
    D.write_documents(D.log_documents(spark, sf_dir, **options), root)
    return root


def _container(spark, name: str) -> str:
    return f"{D.scratch(spark, name)}/container"


def _state(root: str) -> str:
    """Beside the container of the query's documents, in the same scratch folder."""
    return root.rsplit("/", 1)[0] + "/state"


def _no_output(events, batch) -> None:
    events.write.format("noop").mode("overwrite").save()


@query(with_(documents(), "SELECT file, i AS record_pos, t AS tuple_pos, ext AS extension FROM dev"))
def read_nsg_log(spark, sf_dir):
    root = _documents(spark, sf_dir, _container(spark, "read_nsg_log"))
    events = flow.flow_events(logs.read_logs(spark, "insights-logs-networksecuritygroupflowevent", root))
    return events.select("file", "pos.record_pos", "pos.tuple_pos", c("extension_text").alias("extension"))


@query(with_(documents(long=True), "SELECT file, i AS record_pos, t AS tuple_pos, ext AS extension FROM dev"))
def read_split_log(spark, sf_dir):
    """Documents above 20 kB are cut into chunks and read by several tasks, the others whole."""
    root = _documents(spark, sf_dir, _container(spark, "read_split_log"), long=True)
    rows = logs.read_log_rows(spark, logs.list_log_files(spark, root), root, split_bytes=20_000)
    events = flow.flow_events(logs.log_records(rows))
    return events.select("file", "pos.record_pos", "pos.tuple_pos", c("extension_text").alias("extension"))


@query(with_(documents(hours=2), "SELECT file AS name, 'NSG-' || k AS nsg_name, start_epoch AS log_epoch FROM doc"))
def list_log_files(spark, sf_dir):
    listing = logs.parse_listing(logs.list_log_files(spark, _documents(spark, sf_dir, _container(spark, "list_log_files"), hours=2), "resourceId="))
    return listing.where("length > 0").select("name", "nsg_name", epoch("log_time").alias("log_epoch"))


@query(
    with_(documents(grown=True), "SELECT file, epoch, CASE WHEN i > base_last THEN 1 ELSE 0 END AS version, ext FROM dev")
)
def incremental_two_runs(spark, sf_dir):
    """Two runs over files that grow in between: each event once, in the run that saw it first.

    Every file ends with a record without time, which must not set its progress back.
    """
    root = _documents(spark, sf_dir, _container(spark, "incremental_two_runs"), timeless=True)

    def keep(events, batch):
        rows = events.select("file", "epoch", F.lit(batch.version).alias("version"), "extension_text")
        rows.write.mode("overwrite").parquet(f"{_state(root)}/out/run={batch.version}")

    for grown in (False, True):
        if grown:
            _documents(spark, sf_dir, root, grown=True, timeless=True)
        run_incremental(spark, root, "queries", keep, _state(root), files_per_batch=100_000)
    return spark.read.parquet(f"{_state(root)}/out").select(
        "file", "epoch", "version", c("extension_text").alias("ext")
    )


@query(
    with_(documents(grown=True), "SELECT file, epoch, CASE WHEN i > base_last THEN 1 ELSE 0 END AS round, ext FROM dev")
)
def incremental_inventory(spark, sf_dir):
    """The files come from a stored inventory instead of a walk, in batches bounded by their bytes, of which the next is staged
    while one is emitted; documents above 2,000 bytes are read in chunks. Two rounds over files that grow in between."""
    root = _documents(spark, sf_dir, _container(spark, "incremental_inventory"))

    def keep(events, batch):
        events.select("file", "epoch", "extension_text").write.mode("overwrite").parquet(f"{out}/run={batch.version}")

    for n in (0, 1):
        if n:
            _documents(spark, sf_dir, root, grown=True)
        inventory, out = f"{_state(root)}/inventory/{n}", f"{_state(root)}/out/round={n}"
        logs.list_log_files(spark, root).select("path", "last_modified", "length").write.parquet(inventory)
        listed = spark.read.parquet(inventory)
        half = listed.agg(F.sum("length")).first()[0] // 2 + 1
        run_incremental(
            spark, root, "queries", keep, _state(root), listing=listed, bytes_per_batch=half, split_bytes=2000
        )
    kept = spark.read.parquet(f"{_state(root)}/out")
    return kept.select("file", "epoch", "round", c("extension_text").alias("ext"))


DOC_STATUS = """SELECT d.file AS name, CAST(last + 1 AS INT) AS last_count, start_epoch + last * 60 AS record_epoch,
  max(epoch) AS last_processed_timestamp, 'NSG-' || d.k AS nsg_name, start_epoch AS log_epoch,
  count(*) AS event_count
FROM doc d JOIN (SELECT file, epoch FROM dev) e ON e.file = d.file GROUP BY ALL"""


@query(with_(documents(), f"SELECT 'queries' AS job, * FROM ({DOC_STATUS})"))
def status_view(spark, sf_dir):
    root = _documents(spark, sf_dir, _container(spark, "status_view"))
    run_incremental(spark, root, "queries", _no_output, _state(root))
    view = S.status_view(spark, _state(root), ["queries"])
    return view.select(
        "job", "name", "last_count", epoch("last_processed_record").alias("record_epoch"),
        "last_processed_timestamp", "nsg_name", epoch("log_time").alias("log_epoch"), "event_count",
    )


@query(with_(documents(), f"SELECT name, last_count, record_epoch, last_processed_timestamp FROM ({DOC_STATUS})"))
def status_documents(spark, sf_dir):
    """Status written as JSON documents and read back."""
    root = _documents(spark, sf_dir, _container(spark, "status_documents"))
    run_incremental(spark, root, "queries", _no_output, _state(root))
    folder = S.write_status(S.StatusTable(spark, _state(root), "queries").read(), _state(root), "queries")
    return S.read_status(spark, folder).select(
        "name", "last_count", epoch("last_processed_record").alias("record_epoch"), "last_processed_timestamp"
    )


@query(
    with_(
        documents(),
        """SELECT 'COMPLETE' AS status, count(DISTINCT file) AS files, count(DISTINCT file || i) AS records,
  count(*) FILTER (NOT short) AS events FROM dtup""",
    )
)
def run_summary(spark, sf_dir):
    root = _documents(spark, sf_dir, _container(spark, "run_summary"))
    run = run_incremental(spark, root, "queries", _no_output, _state(root))
    return job_summary(spark, run).select("status", "files", "records", "events")


@query(
    with_(
        documents(long=True),
        f"""SELECT 'nsgLog-NSG-' || nk || '-' || strftime({stamp("start_epoch")}, '%Y%m%d%H%M') || '-'
    || min(epoch) OVER (PARTITION BY k) || '-' || max(epoch) OVER (PARTITION BY k) || '.json' AS output_name,
  epoch, header || ext AS line FROM dev""",
    )
)
def event_files(spark, sf_dir):
    """Event files in array form, read back as events; long files, and resources that share a name."""
    root = _documents(spark, sf_dir, _container(spark, "event_files"), long=True)
    out = f"{_state(root)}/events"
    run_incremental(spark, root, "file", file_sink(out, mode="array"), _state(root))
    events = read_cef_json(spark, out, file="path")
    name = F.regexp_extract("path", "output_name=([^/]*)/", 1).alias("output_name")
    return events.select(name, epoch("time").alias("epoch"), E.cef_column(events).alias("line"))


@query(
    with_(
        documents(),
        f"""SELECT strftime({stamp("epoch")}, '%b %d %H:%M:%S') || ' host1 ' || header || ext AS line FROM dev""",
    )
)
def syslog_sink_lines(spark, sf_dir):
    root = _documents(spark, sf_dir, _container(spark, "syslog_sink_lines"))
    out = f"{_state(root)}/syslog"
    run_incremental(spark, root, "syslog", syslog_sink("host1", out), _state(root))
    return spark.read.option("recursiveFileLookup", True).text(out).select(c("value").alias("line"))


@query(
    with_(
        documents(grown=True),
        """SELECT file, i - base_last - 1 AS record_pos, t AS tuple_pos, epoch, ext FROM dev WHERE i > base_last""",
    )
)
def log_tail(spark, sf_dir):
    """Only the bytes past what the short form of each file had are read from the grown form, and none
    that were appended after the second listing."""
    root = _documents(spark, sf_dir, _container(spark, "log_tail"))
    seen, listed = f"{_state(root)}/seen", f"{_state(root)}/listed"
    # Fix the lengths before the files grow, and again before they grow once more.
    logs.list_log_files(spark, root).select("name", c("length").alias("last_end")).write.parquet(seen)
    grown = D.log_documents(spark, sf_dir, grown=True)
    D.write_documents(grown, root)
    logs.list_log_files(spark, root).select("path", "name", "length").write.parquet(listed)
    D.write_documents(grown.withColumn("text", F.concat("text", F.lit(',{"time": "late"}]}'))), root)
    listing = spark.read.parquet(listed).join(spark.read.parquet(seen), "name")
    rows = logs.log_rows(logs.read_log_tail(spark, listing, root))
    events = flow.flow_events(logs.log_records(rows))
    return events.select(
        "file", "pos.record_pos", "pos.tuple_pos", "epoch", c("extension_text").alias("ext")
    )


@query(
    with_(
        documents(),
        """SELECT file, CASE WHEN k % 3 = 0 THEN 'not a log document' ELSE 'ok' END AS outcome,
  CASE WHEN k % 3 = 0 THEN 0 ELSE CAST(last + 1 AS INT) END AS records FROM doc""",
    )
)
def split_corrupt(spark, sf_dir):
    """Every third document loses its end; it becomes a reject, the others all records."""
    root = D.scratch(spark, "split_corrupt")
    docs = D.log_documents(spark, sf_dir)
    broken = F.regexp_extract("name", "NSG-([0-9]+)", 1).cast("int") % 3 == 0
    cut = F.when(broken, F.expr("left(text, length(text) - 20)")).otherwise(c("text"))
    D.write_documents(docs.withColumn("text", cut), root)
    records, bad = logs.split_corrupt(logs.log_rows(logs.read_log_files(spark, root)))
    good = records.groupBy("file").agg(F.lit("ok").alias("outcome"), F.count("*").cast("int").alias("records"))
    return good.unionByName(bad.select("file", c("message").alias("outcome"), F.lit(0).alias("records")))


@query(
    with_(
        documents(),
        f"""SELECT strftime({stamp("epoch")}, '%b %d %H:%M:%S') || ' host1 ' || header || ext AS line FROM dev""",
    )
)
def syslog_text_file(spark, sf_dir):
    """Framed lines straight to text files, without reading logs from files."""
    parsed = D.log_documents(spark, sf_dir).select(
        c("name").alias("file"), F.from_json("text", LOG_DDL).alias("log")
    )
    rows = parsed.select("file", F.posexplode("log.records").alias("record_pos", "r"))
    events = flow.flow_events(rows.select("file", c("record_pos").cast("bigint").alias("record_pos"), "r.*"))
    out = D.scratch(spark, "syslog_text_file")
    write_syslog(E.syslog_lines(events, "host1"), out)
    return spark.read.text(out).select(c("value").alias("line"))


@query(
    with_(
        documents(hours=2),
        """SELECT file AS name FROM doc WHERE k % 3 = 1""",
    )
)
def list_log_files_prefix(spark, sf_dir):
    """A prefix that leaves out the other subscriptions."""
    root = _documents(spark, sf_dir, _container(spark, "list_log_files_prefix"), hours=2)
    return logs.list_log_files(spark, root, "resourceId=/SUBSCRIPTIONS/SUB1/").select("name")


@query(with_(documents(hours=48), f"SELECT file AS name FROM doc WHERE start_epoch >= 1500076800"))
def list_log_files_since(spark, sf_dir):
    """Days before the one of the given time are not listed: here, those before 2017-07-15.

    A file lies in folders of its own, so that 48 of a supplier take 0.6 MB of disk. The documents of ``LISTED_SUPPLIERS`` are
    there at a time: they are written, listed, and removed from the container once their listing is stored; the next ones are
    written into their folders.
    """
    root = _container(spark, "list_log_files_since")
    listed, spare, since = f"{_state(root)}/listed", f"{_state(root)}/spare", datetime(2017, 7, 15, 22)
    lots = -(-D.table(spark, sf_dir, "supplier").count() // LISTED_SUPPLIERS) or 1
    for lot in range(lots):
        documents = D.log_documents(spark, sf_dir, hours=48, of=F.pmod(F.xxhash64("s_suppkey"), F.lit(lots)) == lot)
        D.write_documents(documents, root, spare)
        found = logs.list_log_files(spark, root, since=since, folders=logs.RESOURCE_FOLDERS)
        found.select("name").write.parquet(f"{listed}/lot={lot}")
        D.remove_documents(documents, root, spare)
    D.remove_spare(spark, spare)
    return spark.read.schema("name STRING").parquet(f"{listed}/lot=*")


LISTED_SUPPLIERS = 5000


GATEWAY_RECORDS = f"""
grec AS (
  SELECT s_suppkey AS k, UNNEST(range(2 + s_suppkey % 5)) AS i,
    'resourceId=' || {rid("s_suppkey", "APPLICATIONGATEWAYS/GW")} || {hour_path(stamp("1499997600"))} AS file
  FROM supplier
)"""
GATEWAY_EVENT = """SELECT file, i AS record_pos, 1499997600 + i * 60 AS epoch, '10.' || (k % 256) || '.' || i || '.1' AS src,
  CAST(1024 + k * 7 % 60000 AS VARCHAR) AS spt"""


def _gateway_events(spark, sf_dir, name, operation, convert):
    root = _container(spark, name)
    D.write_documents(D.gateway_documents(spark, sf_dir), root)
    return convert(logs.read_logs(spark, P.CONTAINERS[operation], root)), c("extension")


@query(with_(GATEWAY_RECORDS, f"{GATEWAY_EVENT}, '/p' || i || '?u=' || k AS request FROM grec WHERE i % 2 = 0"))
def read_access_log(spark, sf_dir):
    """Access records of files that hold firewall records as well."""
    events, ext = _gateway_events(spark, sf_dir, "read_access_log", P.ACCESS_OPERATION, gateway.access_events)
    return events.select(
        "file", "pos.record_pos", "epoch", ext["src"].alias("src"), ext["spt"].alias("spt"),
        ext["request"].alias("request"),
    )


@query(with_(GATEWAY_RECORDS, f"{GATEWAY_EVENT}, 'rule ' || i AS message FROM grec WHERE i % 2 = 1"))
def read_firewall_log(spark, sf_dir):
    """Firewall records of files that hold access records as well."""
    events, ext = _gateway_events(spark, sf_dir, "read_firewall_log", P.FIREWALL_OPERATION, gateway.firewall_events)
    return events.select(
        "file", "pos.record_pos", "epoch", ext["src"].alias("src"), ext["spt"].alias("spt"),
        ext["cs5"].alias("message"),
    )


def _keep(out: str):
    def keep(events, batch):
        rows = events.select("file", "epoch", F.lit(batch.version).alias("version"), "extension_text")
        rows.write.mode("overwrite").parquet(f"{out}/run={batch.version}")

    return keep


def _kept(spark, out: str) -> DataFrame:
    return spark.read.parquet(out).select("file", "epoch", "version", c("extension_text").alias("ext"))


TWO_ROUNDS = "SELECT file, epoch, CASE WHEN i > base_last THEN 1 ELSE 0 END AS version, ext FROM dev"


@query(
    with_(
        documents(grown=True),
        """SELECT file, epoch, CASE WHEN i > base_last OR k = (SELECT min(k) FROM doc) THEN 1 ELSE 0 END AS version, ext
FROM dev""",
    )
)
def stream_two_batches(spark, sf_dir):
    """A stream stopped and started again over files that grow in between. One file shows up in between only, with a time long past."""
    root = _container(spark, "stream_two_batches")
    documents = D.log_documents(spark, sf_dir)
    late = documents.orderBy(F.regexp_extract("name", "NSG-([0-9]+)", 1).cast("int")).first()["name"]
    D.write_documents(documents.where(c("name") != late), root)
    for grown in (False, True):
        if grown:
            _documents(spark, sf_dir, root, grown=True)
            place = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{late}")
            place.getFileSystem(spark._jsc.hadoopConfiguration()).setTimes(place, 1_000_000, -1)
        run = start_stream(
            spark, root, "queries", _keep(f"{_state(root)}/out"), _state(root), f"{_state(root)}/checkpoint",
            poll_interval=None, files_per_batch=100_000,
        )
        run.awaitTermination()
    return _kept(spark, f"{_state(root)}/out")


@query(with_(documents(grown=True), TWO_ROUNDS))
def polling_rounds(spark, sf_dir):
    root = _documents(spark, sf_dir, _container(spark, "polling_rounds"))
    keep = _keep(f"{_state(root)}/out")
    for _ in run_polling(spark, root, "poll", keep, _state(root), poll_interval=0, rounds=2, files_per_batch=100_000):
        _documents(spark, sf_dir, root, grown=True)
    return _kept(spark, f"{_state(root)}/out")


@query(
    with_(
        documents(grown=True),
        f"""SELECT 'early' AS job, * FROM ({TWO_ROUNDS})
UNION ALL SELECT 'late', file, epoch, 0, ext FROM dev""",
    )
)
def two_jobs(spark, sf_dir):
    """Two destinations follow one root under one state: the one that starts later sees it all at once."""
    root = _documents(spark, sf_dir, _container(spark, "two_jobs"))
    outs = {job: f"{_state(root)}/out-{job}" for job in ("early", "late")}
    run_incremental(spark, root, "early", _keep(outs["early"]), _state(root), files_per_batch=100_000)
    _documents(spark, sf_dir, root, grown=True)
    for job, out in outs.items():
        run_incremental(spark, root, job, _keep(out), _state(root), files_per_batch=100_000)
    kept = [_kept(spark, out).select(F.lit(job).alias("job"), "*") for job, out in outs.items()]
    return kept[0].unionByName(kept[1])


@query(
    with_(
        documents(),
        """SELECT file, 'token_count' AS kind, count(*) AS rejects FROM dtup WHERE short AND k % 4 > 1 GROUP BY ALL
UNION ALL SELECT file, 'file', 1 FROM doc WHERE k % 4 = 0
UNION ALL SELECT 'notes/' || k || '.json', 'path', 1 FROM doc WHERE k % 4 > 1
UNION ALL SELECT replace(file, '/m=07/', '/m=13/'), 'hour', 1 FROM doc WHERE k % 4 = 1""",
    )
)
def run_rejects(spark, sf_dir):
    """What two runs turn away: files that are no logs by their path or hour, once; broken files; bad tuples."""
    root = _container(spark, "run_rejects")
    docs = D.log_documents(spark, sf_dir).withColumn("k", F.regexp_extract("name", "NSG-([0-9]+)", 1).cast("int"))
    name = F.when(c("k") % 4 == 1, F.replace("name", F.lit("/m=07/"), F.lit("/m=13/"))).otherwise(c("name"))
    text = F.when(c("k") % 4 == 0, F.expr("left(text, length(text) - 20)")).otherwise(c("text"))
    D.write_documents(docs.select(name.alias("name"), text.alias("text")), root)
    notes = docs.where("k % 4 > 1").select(F.concat(F.lit("notes/"), c("k"), F.lit(".json")).alias("name"), "text")
    D.write_documents(notes, root)
    for job in ("queries", "queries"):
        run_incremental(spark, root, job, _no_output, _state(root), files_per_batch=100_000)
    rejects = spark.read.parquet(f"{_state(root)}/rejects/queries")
    # A broken file is tried by every run, and turned away by each.
    once = rejects.groupBy("file", "kind", "version").agg(F.count("*").alias("rejects"))
    return once.groupBy("file", "kind").agg(F.max("rejects").alias("rejects"))
