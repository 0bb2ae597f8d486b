"""DuckDB side of the registered queries: the same answers computed flat from the tables."""

from __future__ import annotations

FLOW_OPERATION = "NetworkSecurityGroupFlowEvents"


def rid(k: str, kind: str = "NETWORKSECURITYGROUPS/NSG") -> str:
    return (
        f"'/SUBSCRIPTIONS/SUB' || ({k} % 3) || '/RESOURCEGROUPS/RG' || ({k} % 5) || "
        f"'/PROVIDERS/MICROSOFT.NETWORK/{kind}-' || ({k})"
    )


def nsg_rid(k: str) -> str:
    return (
        f"CASE WHEN {k} % 13 = 0 THEN 'UNMATCHED/NSG-' || ({k}) "
        f"ELSE {rid(k)} || CASE WHEN {k} % 11 = 0 THEN '/' ELSE '' END END"
    )


def hour_path(ts: str) -> str:
    return f"strftime({ts}, '/y=%Y/m=%m/d=%d/h=%H/m=00/PT1H.json')"


def stamp(epoch: str) -> str:
    return f"make_timestamp(CAST({epoch} AS BIGINT) * 1000000)"


def pair(key: str, value: str) -> str:
    return f"CASE WHEN {value} <> '' THEN '{key}=' || replace({value}, '=', '\\=') END"


def extension(**pairs: str) -> str:
    return "'|' || rtrim(concat_ws(' ', " + ", ".join(pair(k, pairs[k]) for k in sorted(pairs)) + "))"


def mac(value: str) -> str:
    return f"rtrim(regexp_replace({value}, '(..)', '\\1:', 'g'), ':')"


RECORDS = f"""
src AS (
  SELECT l_orderkey AS ord, l_partkey AS part, l_suppkey AS k, l_linenumber AS line, l_orderkey % 4 AS h,
    date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) * 86400 + (l_orderkey % 4) * 3600 + 33
      AS epoch0,
    l_returnflag AS rf, l_linestatus AS ls, l_returnflag || l_linestatus AS rule,
    (l_orderkey * 8 + l_linenumber) * 1000 + l_partkey % 1000 AS record_pos,
    1 + l_linenumber % 3 AS n, {nsg_rid("l_suppkey")} AS rid,
    date_trunc('year', l_shipdate) + to_hours(CAST(l_orderkey % 4 AS INT)) AS file_hour
  FROM lineitem
),
rec AS (
  SELECT *, 'resourceId=' || rid || {hour_path("file_hour")} AS file,
    CASE WHEN ord % 59 <> 0 THEN epoch0 END AS time_epoch,
    CASE WHEN ord % 29 = 0 THEN 'NetworkSecurityGroupEvents' WHEN ord % 31 = 0 THEN 'Other'
      ELSE '{FLOW_OPERATION}' END AS op,
    ord % 211 <> 5 AND ord % 307 <> 3 AND ord % 401 <> 7
      AND NOT (k % 10 = 7 AND h = 3 AND (ord % 97 <> 0 OR (n >= 2 AND (ord + 1) % 97 <> 0))) AS accepted
  FROM src
)"""

TUPLES = f"""{RECORDS},
tup AS (
  SELECT rec.*, j, CASE WHEN j = 2 THEN 1 ELSE 0 END AS flow_pos, 0 AS group_pos,
    CASE WHEN j = 1 THEN 1 ELSE 0 END AS tuple_pos,
    (ord + j) % 97 <> 0 AS whole,
    CASE WHEN (ord + j) % 101 = 0 THEN 'abcde' WHEN (ord + j) % 103 = 0 THEN ' 12'
      ELSE CAST(epoch0 + line + j AS VARCHAR) END AS tok0,
    '10.' || (part % 256) || '.0.1' AS src_ip, '172.16.' || (k % 256) || '.9' AS dst_ip,
    CAST(1024 + part % 60000 AS VARCHAR) AS spt, CASE WHEN line % 2 = 0 THEN '443' ELSE '80' END AS dpt,
    CASE WHEN (line + j) % 3 = 0 THEN 'T' WHEN (line + j) % 3 = 1 THEN 'U' ELSE 'X' END AS proto_code,
    CASE WHEN (part + j) % 17 = 0 THEN 'Z' WHEN ls = 'O' THEN 'O' ELSE 'I' END AS dir_code,
    CASE WHEN rf = 'A' THEN 'A' WHEN rf = 'N' THEN 'D' ELSE 'Z' END AS decision
  FROM rec, (SELECT UNNEST([0, 1, 2]) AS j) js
  WHERE j < n AND accepted AND op = '{FLOW_OPERATION}' AND time_epoch IS NOT NULL
)"""

EVENTS = f"""{TUPLES},
base AS (
  SELECT *, CASE WHEN tok0 IN ('abcde', ' 12') THEN 0 ELSE CAST(tok0 AS BIGINT) END AS epoch,
    CASE WHEN rid LIKE 'UNMATCHED%' THEN '' ELSE 'SUB' || (k % 3) END AS sub,
    CASE WHEN rid LIKE 'UNMATCHED%' THEN '' ELSE 'RG' || (k % 5) END AS rg,
    CASE WHEN rid LIKE 'UNMATCHED%' THEN ''
      ELSE 'NSG-' || k || CASE WHEN k % 11 = 0 THEN '/' ELSE '' END END AS nsg,
    CASE WHEN j = 2 THEN 'DefaultRule_' || rule ELSE rule END AS rule_name,
    {mac("CASE WHEN j = 2 THEN format('{:X}', part) ELSE lpad(format('{:X}', k), 12, '0') END")} AS mac,
    CASE proto_code WHEN 'T' THEN 'TCP' WHEN 'U' THEN 'UDP' ELSE '' END AS proto,
    CASE dir_code WHEN 'O' THEN 1 ELSE 0 END AS direction,
    CASE decision WHEN 'A' THEN 'Allow' WHEN 'D' THEN 'Deny' ELSE 'Unknown' END AS outcome,
    CASE decision WHEN 'A' THEN 0 WHEN 'D' THEN 6 ELSE 4 END AS severity
  FROM tup WHERE whole
),
ev AS (
  SELECT *, {extension(
      categoryOutcome="outcome", cs1="rule_name", cs1label="'Rule Name'", cs2="nsg", cs2label="'Azure NSG'",
      cs3="sub", cs3label="'Subscription ID'", cs4="rg", cs4label="'Resource Group'",
      deviceDirection="CAST(direction AS VARCHAR)",
      deviceExternalId="CASE WHEN k % 4 <> 0 THEN 'sys-' || k ELSE '' END",
      dmac="CASE WHEN direction = 0 THEN mac ELSE '' END", dpt="dpt", dst="dst_ip", proto="proto",
      smac="CASE WHEN direction = 1 THEN mac ELSE '' END", spt="spt", src="src_ip",
      start="CAST(epoch * 1000 AS VARCHAR)")} AS ext,
    'CEF:0|Microsoft|Azure NSG|1|{FLOW_OPERATION}|NetworkSecurityGroupFlowEvent|' || severity AS header
  FROM base
)"""  # fmt: skip

GATEWAY_EXT = {
    "cs2": "gw",
    "cs2label": "'Azure Application Gateway'",
    "cs3": "sub",
    "cs3label": "'Subscription ID'",
    "cs4": "rg",
    "cs4label": "'Resource Group'",
}


def json_escaped(text: str) -> str:
    return (
        f"replace(replace(replace({text}, '<', '\\u003c'), '>', '\\u003e'), '&', '\\u0026')"
    )


ACCESS = f"""
src AS (
  SELECT event_id, user_id, event_type, user_id % 20 AS gk, 1024 + event_id % 60000 AS port,
    date_trunc('second', ts) AS t, '10.0.' || user_id || '.1' AS ip,
    '/' || event_type || '?u=' || user_id || '&x=<1>' AS uri,
    CASE event_type WHEN 'purchase' THEN 'POST' WHEN 'signup' THEN 'PUT' ELSE 'GET' END AS method
  FROM events
),
acc AS (
  SELECT *, 'GW-' || gk AS gw, 'SUB' || (gk % 3) AS sub, 'RG' || (gk % 5) AS rg,
    {rid("gk", "APPLICATIONGATEWAYS/GW")} AS rid, CAST(epoch(t) AS BIGINT) AS time_epoch,
    'resourceId=' || {rid("gk", "APPLICATIONGATEWAYS/GW")} || {hour_path("t")} AS file,
    {json_escaped('''
      '{"clientIP":"' || ip || '","clientPort":' || port
      || CASE WHEN event_id % 7 = 0 THEN '.75' ELSE '' END
      || ',"details":{"a":"' || event_type || '","b":' || (event_id % 9)
      || '},"httpMethod":"' || method || '","requestUri":"' || uri || '"}' ''')} AS msg,
    CAST(port AS VARCHAR) AS port_text
  FROM src
),
access AS (
  SELECT *, {extension(
      src="ip", spt="port_text", request="uri", cs1="uri", cs1label="'requestUri'",
      requestMethod="method", act="method", msg="msg", **GATEWAY_EXT)} AS ext,
    'CEF:0|Microsoft|Azure Application Gateway|1|ApplicationGatewayAccessLog|' || gw || '|0' AS header
  FROM acc WHERE event_id % 50 <> 0 AND event_id % 23 <> 0
)"""  # fmt: skip

FIREWALL = f"""
fsrc AS (
  SELECT d.doc_id AS doc, doc_id % 20 AS gk, 1500000000 + doc_id * 61 AS time_epoch,
    '10.1.' || (doc_id % 256) || '.1' AS ip, '/d/' || doc_id || '?q=a&b' AS uri,
    CASE WHEN toxic = 1 THEN 'Blocked' ELSE 'Detected' END AS action,
    text || CASE WHEN doc_id % 7 = 0 THEN '\\' ELSE '' END || CASE WHEN doc_id % 5 = 0 THEN '=' ELSE '' END
      AS message,
    CAST(1024 + doc_id % 60000 AS VARCHAR) AS port, 'gw_' || (doc_id % 4) AS instance
  FROM documents d LEFT JOIN labels USING (doc_id)
),
facc AS (
  SELECT *, 'GW-' || gk AS gw, 'SUB' || (gk % 3) AS sub, 'RG' || (gk % 5) AS rg,
    'resourceId=' || {rid("gk", "APPLICATIONGATEWAYS/GW")} || {hour_path(stamp("time_epoch"))} AS file,
    CASE WHEN doc % 3 = 2 THEN '<nil>' ELSE port END AS port_text,
    {json_escaped('''
      '{"action":"' || action || '","clientIp":"' || ip || '","clientPort":'
      || CASE doc % 3 WHEN 0 THEN '"' || port || '"' WHEN 1 THEN port ELSE 'null' END
      || ',"instanceId":"' || instance || '","message":' || CAST(to_json(message) AS VARCHAR)
      || ',"requestUri":"' || uri || '"}' ''')} AS msg
  FROM fsrc
),
firewall AS (
  SELECT *, {extension(
      src="ip", spt="port_text", cs1="uri", cs1label="'requestUri'", act="action", cs5="message",
      cs5label="'message'", cs6="instance", cs6label="'instanceId'", msg="msg", **GATEWAY_EXT)} AS ext,
    'CEF:0|Microsoft|Azure Application Gateway|1|ApplicationGatewayFirewallLog|' || gw || '|0' AS header
  FROM facc WHERE doc % 41 <> 0
)"""  # fmt: skip

LISTING = f"""
files AS (
  SELECT o_custkey % 50 AS k, CAST(o_orderdate AS DATE) AS day, max(o_orderkey) AS last_order,
    count(*) AS orders
  FROM orders GROUP BY ALL
),
listing AS (
  SELECT k, day, last_order,
    CASE WHEN k = 48 THEN 'notes/' || strftime(day, '%Y%m%d') || '.txt' ELSE 'resourceId=' || {nsg_rid("k")}
      || '/y=' || strftime(day, '%Y') || '/m=' || CASE WHEN k = 49 THEN '13' ELSE strftime(day, '%m') END
      || '/d=' || strftime(day, '%d') || '/h=' || lpad(CAST(last_order % 24 AS VARCHAR), 2, '0')
      || '/m=00/PT1H.json' END AS name,
    'etag-' || last_order AS etag,
    date_diff('day', DATE '1970-01-01', day) * 86400 + last_order % 86400 AS modified,
    orders * 100 AS length,
    CASE WHEN k % 11 = 0 AND k % 13 <> 0 THEN '' ELSE 'NSG-' || k END AS nsg_name,
    CASE WHEN k <> 49 THEN date_diff('day', DATE '1970-01-01', day) * 86400 + last_order % 24 * 3600 END
      AS log_epoch
  FROM files
),
logs AS (SELECT * FROM listing WHERE k <> 48),
known AS (
  SELECT name, etag, modified + (modified % 3 - 1) * 3600 AS modified, modified - 7200 AS record_epoch,
    modified - 7190 AS last_ts, CAST(length / 100 AS INT) AS last_count, length - 50 AS last_end
  FROM logs WHERE k % 3 = 0
)"""


def documents(hours: int = 1, grown: bool = False, long: bool = False) -> str:
    """Records and events of ``derive.log_documents``."""
    start = 1500000000 - 1500000000 % 3600
    shared = "(s_suppkey - s_suppkey % 2)" if long else "s_suppkey"
    last = f"1 + s_suppkey % 5 + {3 if grown else 0}"
    if long:
        last = f"CASE WHEN s_suppkey % 25 = 0 THEN 520 WHEN s_suppkey % 10 = 5 THEN 75 ELSE {last} END"
    return f"""
doc AS (
  SELECT s_suppkey AS k, {shared} AS nk, h, {start} + h * 3600 AS start_epoch, 1 + s_suppkey % 5 AS base_last,
    'resourceId=/SUBSCRIPTIONS/SUB' || (s_suppkey % 3) || '/RESOURCEGROUPS/RG' || (s_suppkey % 5)
      || '/PROVIDERS/MICROSOFT.NETWORK/NETWORKSECURITYGROUPS/NSG-' || {shared}
      || {hour_path(stamp(f"{start} + h * 3600"))} AS file,
    {last} AS last
  FROM supplier, (SELECT UNNEST(range({hours})) AS h) hs
),
drec AS (SELECT doc.*, UNNEST(range(last + 1)) AS i FROM doc),
dtup AS (
  SELECT *, start_epoch + i * 60 + t AS epoch, (k + i) % 4 = 0 AND t = 1 AS short
  FROM drec, (SELECT UNNEST([0, 1, 2]) AS t) ts
),
dev AS (
  SELECT *, {extension(
      categoryOutcome="CASE t WHEN 0 THEN 'Allow' ELSE 'Deny' END", cs1="'Rule_' || (i % 2)",
      cs1label="'Rule Name'", cs2="'NSG-' || nk", cs2label="'Azure NSG'", cs3="'SUB' || (k % 3)",
      cs3label="'Subscription ID'", cs4="'RG' || (k % 5)", cs4label="'Resource Group'",
      deviceDirection="CASE t WHEN 2 THEN '1' ELSE '0' END", deviceExternalId="'sys-' || k",
      dmac=f"CASE WHEN t <> 2 THEN {mac("lpad(format('{:X}', k), 12, '0')")} ELSE '' END",
      smac=f"CASE WHEN t = 2 THEN {mac("lpad(format('{:X}', k), 12, '0')")} ELSE '' END",
      dpt="'443'", dst="'172.16.0.9'", proto="CASE t WHEN 0 THEN 'UDP' ELSE 'TCP' END",
      spt="CAST(1024 + k * 7 % 60000 AS VARCHAR)", src="'10.' || (k % 256) || '.' || i || '.1'",
      start="CAST(epoch * 1000 AS VARCHAR)")} AS ext,
    'CEF:0|Microsoft|Azure NSG|1|{FLOW_OPERATION}|NetworkSecurityGroupFlowEvent|'
      || CASE t WHEN 0 THEN 0 ELSE 6 END AS header
  FROM dtup WHERE NOT short
)"""  # fmt: skip


def with_(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"
