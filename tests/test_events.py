"""Records to events, and the text forms of events."""

import re

import pytest
from conftest import access_record, firewall_record, flow_record, to_records
from pyspark.sql import functions as F

import flowlog as fl
from flowlog.functions import paths as P
from flowlog.functions import text as X
from flowlog.operators.events import cef_column, event_json, syslog_column
from flowlog.schemas import FLOWS_TYPE

GOOD = "1551557214,10.20.30.40,198.51.100.7,50123,8443,T,O,A"


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def events_of(spark, *records):
    return fl.flow_events(to_records(spark, list(records)))


def test_four_token_tuple_is_one_error_beside_one_event(spark):
    records = to_records(spark, [flow_record(tuples=["1551557213,10.20.30.40,198.51.100.7,50123", GOOD])])
    errors = fl.flow_tuple_errors(records).collect()
    assert [e["message"] for e in errors] == [
        "unexpected # tokens in tuple 1551557213,10.20.30.40,198.51.100.7,50123. expected 8"
    ]
    assert fl.flow_events(records).count() == 1


def test_bad_epoch_is_an_error_and_an_event(spark):
    records = to_records(spark, [flow_record(tuples=["abcde" + GOOD[10:], GOOD])])
    errors = fl.flow_tuple_errors(records).collect()
    assert [e["message"] for e in errors] == ['strconv.ParseInt: parsing "abcde": invalid syntax']
    assert sorted(e["epoch"] for e in fl.flow_events(records).collect()) == [0, 1551557214]


@pytest.mark.parametrize(
    "token, epoch",
    [
        ("12", 12), ("+12", 12), ("-12", -12), ("0012", 12), (" 12", None), ("12 ", None), ("", None),
        ("1.5", None), ("1e3", None), ("9" * 30, None), ("9223372036855", None), ("9223372036854", 9223372036854),
    ],
)
def test_parse_epoch(spark, token, epoch):
    assert one(spark, X.parse_epoch(F.lit(token))) == epoch


def test_extension_of_a_flow_event(spark):
    event = events_of(spark, flow_record(tuples=[GOOD])).first()
    assert event["extension"] == {
        "deviceExternalId": "sys-77", "cs1": "Rule_A", "cs1label": "Rule Name",
        "cs2": "WEB-TIER", "cs2label": "Azure NSG", "cs3": "SUB-7", "cs3label": "Subscription ID",
        "cs4": "EDGE", "cs4label": "Resource Group", "start": "1551557214000",
        "src": "10.20.30.40", "dst": "198.51.100.7", "spt": "50123", "dpt": "8443", "proto": "TCP",
        "deviceDirection": "1", "smac": "0A:1B:2C:3D:4E:5F", "categoryOutcome": "Allow",
    }
    assert (event["severity"], event["name"]) == (0, "NetworkSecurityGroupFlowEvent")


def test_unknown_codes(spark):
    event = events_of(spark, flow_record(tuples=["1,a,b,1,2,X,Q,?"])).first()
    ext = event["extension"]
    assert (ext["proto"], ext["deviceDirection"], ext["categoryOutcome"]) == ("", "0", "Unknown")
    assert event["severity"] == 4 and "dmac" in ext and "smac" not in ext
    assert "proto=" not in event["extension_text"]


def test_text_and_map_forms_agree(spark):
    nsg = events_of(spark, flow_record(tuples=[GOOD, "1,a=b,c d,1,2,X,Q,? "]), flow_record(rule="", tuples=[GOOD]))
    access = fl.access_events(to_records(spark, [access_record(requestUri="/a=1\n b ")]))
    firewall = fl.firewall_events(to_records(spark, [firewall_record(), firewall_record(clientPort=...)]))
    events = fl.union_events(nsg, access, firewall)
    texts = events.select("extension_text", X.extension_text(F.col("extension")).alias("from_map")).collect()
    assert len(texts) == 6
    for row in texts:
        assert row["extension_text"] == row["from_map"]


# Each change turns the record away as a whole, with the good tuples before it.
BAD_PROPERTIES = [
    None,
    {},
    {"flows": None},
    {"flows": "x"},
    {"flows": [5]},
    {"flows": [None]},
    {"flows": [{"flows": []}]},
    {"flows": [{"rule": 5, "flows": []}]},
    {"flows": [{"rule": None, "flows": []}]},
    {"flows": [{"rule": ["a"], "flows": []}]},
    {"flows": [{"rule": "r"}]},
    {"flows": [{"rule": "r", "flows": {}}]},
    {"flows": [{"rule": "r", "flows": ["x"]}]},
    {"flows": [{"rule": "r", "flows": [{"mac": "AB"}]}]},
    {"flows": [{"rule": "r", "flows": [{"mac": "AB", "flowTuples": GOOD}]}]},
    {"flows": [{"rule": "r", "flows": [{"mac": "AB", "flowTuples": [GOOD, 5]}]}]},
    {"flows": [{"rule": "r", "flows": [{"mac": "AB", "flowTuples": [GOOD, None]}]}]},
    {"flows": [{"rule": "r", "flows": [{"mac": "AB", "flowTuples": [GOOD, [1, 2, 3, 4, 5, 6, 7, 8]]}]}]},
    {"flows": [{"rule": "r", "flows": [{"mac": "AB", "flowTuples": [GOOD, {"a": 1, "b": 2}]}]}]},
    {"flows": [{"rule": "r", "flows": [{"mac": "AB", "flowTuples": [GOOD, True]}]}]},
    {"flows": [{"rule": "r", "flows": [{"flowTuples": [GOOD]}]}]},
    {"flows": [{"rule": "r", "flows": [{"mac": 12, "flowTuples": [GOOD]}]}]},
    {"flows": [{"rule": "r", "flows": [{"mac": "AB", "flowTuples": [GOOD]}, {"mac": None, "flowTuples": [GOOD]}]}]},
]
GOOD_PROPERTIES = [
    ({"flows": []}, 0),
    ({"flows": [{"rule": "r", "flows": []}]}, 0),
    ({"flows": [{"rule": "5", "flows": [{"mac": "12", "flowTuples": [GOOD]}]}]}, 1),
    ({"flows": [{"rule": "true", "flows": [{"mac": "[x", "flowTuples": [GOOD, "5", "[1,2", ""]}]}]}, 1),
    # Without an 8-token tuple nothing reads the mac.
    ({"flows": [{"rule": "r", "flows": [{"flowTuples": ["1,2"]}, {"mac": 5, "flowTuples": []}]}]}, 0),
]


def test_one_bad_field_rejects_the_whole_record(spark):
    bad = to_records(spark, [flow_record(properties=p) for p in BAD_PROPERTIES])
    assert fl.flow_events(bad).count() == 0
    assert fl.flow_tuple_errors(bad).count() == 0
    rejected = fl.rejected_records(bad, fl.NSG)
    assert rejected.count() == len(BAD_PROPERTIES)
    assert fl.accepted_records(bad, fl.NSG).count() == 0


def test_good_records_are_accepted(spark):
    good = to_records(spark, [flow_record(properties=p) for p, _ in GOOD_PROPERTIES])
    assert fl.rejected_records(good, fl.NSG).count() == 0
    counts = {r["file"]: r["event_count"] for r in fl.event_counts(fl.flow_events(good)).collect()}
    assert counts == {"f": sum(n for _, n in GOOD_PROPERTIES)}


def test_typed_properties_give_the_same_events(spark):
    mixed = flow_record(tuples=[GOOD, "1,2", "abcde" + GOOD[10:]])
    records = to_records(spark, [mixed, flow_record(mac=None, tuples=[GOOD])])
    typed = f"STRUCT<Version: INT, flows: {FLOWS_TYPE}>"
    other = records.withColumn("properties", F.try_variant_get("properties", "$", typed))
    for f in (fl.flow_events, fl.flow_tuple_errors):
        a, b = (f(r).drop("extension").orderBy("pos").collect() for r in (records, other))
        assert a == b and len(a) == 2


def test_events_and_errors_account_for_all_tuples(spark):
    records = to_records(spark, [flow_record(tuples=[GOOD, "1,2", "x" + GOOD[10:], GOOD, "9,9,9,9,9,9,9,9,9"])])
    bad_epochs = fl.flow_tuple_errors(records).where("kind = 'epoch'").count()
    errors = fl.flow_tuple_errors(records).count()
    assert fl.flow_events(records).count() + errors == 5 + bad_epochs
    assert fl.error_counts(fl.rejects(records, fl.NSG)).first()["error_count"] == errors == 3


def test_dispatch_and_time_filters(spark):
    records = to_records(
        spark,
        [
            flow_record(tuples=[GOOD]),
            flow_record(tuples=[GOOD], operationName="NetworkSecurityGroupEvents"),
            flow_record(tuples=[GOOD], operationName="Other"),
            flow_record(tuples=[GOOD], time=None),
            flow_record(tuples=[GOOD], time="2019-03-02T20:08:33Z"),
        ],
    )
    assert fl.flow_events(records).count() == 2
    assert fl.family_events(records, fl.NSG).count() == 2
    assert fl.rule_counter_events(records).count() == 0
    assert fl.dispatch_operation(records, fl.NSG).count() == 4
    from datetime import datetime

    at = datetime(2019, 3, 2, 20, 8, 33)
    assert fl.records_after(records, at).count() == 0
    assert fl.records_before(records, at).count() == 3
    assert fl.flow_events(records, datetime(2019, 3, 2, 20, 8)).count() == 1
    assert [r["time"] for r in fl.sort_records(records).collect()][0] is None


def test_operations_can_be_registered(spark):
    records = to_records(spark, [flow_record(tuples=[GOOD], operationName="Custom")])
    assert fl.family_events(records, fl.NSG).count() == 0

    def custom(rows, after=None):
        return fl.flow_events(rows.withColumn("operationName", F.lit("NetworkSecurityGroupFlowEvents")), after)

    from flowlog.operators.families import HANDLERS
    from flowlog.operators.records import OPERATIONS

    fl.register_operation(fl.NSG, "Custom", fl.Handler(custom))
    try:
        assert fl.family_events(records, fl.NSG).count() == 1
        assert fl.dispatch_operation(records, fl.NSG).count() == 1
    finally:
        del HANDLERS[fl.NSG]["Custom"]
        OPERATIONS[fl.NSG].remove("Custom")


def test_access_records(spark):
    good = [access_record(), access_record(clientPort=80.9), access_record(extra={"b": 1, "a": None})]
    bad = [access_record(**{k: v}) for k in ("clientIP", "requestUri", "httpMethod") for v in (5, None, ...)]
    bad += [access_record(clientPort=v) for v in ("80", None, ..., True)]
    records = to_records(spark, good + bad)
    events = fl.access_events(records).orderBy("pos").collect()
    assert [e["extension"]["spt"] for e in events] == ["8080", "80", "8080"]
    assert fl.rejected_records(records, fl.ACCESS).count() == len(bad)
    ext = events[0]["extension"]
    assert ext["request"] == ext["cs1"] == "/a?b=<c>&d" and ext["act"] == ext["requestMethod"] == "GET"
    assert ext["msg"] == (
        '{"clientIP":"1.2.3.4","clientPort":8080,"httpMethod":"GET","requestUri":"/a?b=\\u003cc\\u003e\\u0026d"}'
    )
    assert events[0]["name"] == ext["cs2"] == "FRONT-GW" and "deviceExternalId" not in ext
    assert events[0]["device_product"] == "Azure Application Gateway"


def test_firewall_records(spark):
    ports = ["0", 443, None, ..., True, 1.5]
    good = [firewall_record(clientPort=p) for p in ports]
    bad = [
        firewall_record(**{k: v})
        for k in ("clientIp", "requestUri", "action", "message", "instanceId")
        for v in (5, None, ...)
    ]
    records = to_records(spark, good + bad)
    events = fl.firewall_events(records).orderBy("pos").collect()
    assert [e["extension"]["spt"] for e in events] == ["0", "443", "<nil>", "<nil>", "true", "1.5"]
    assert events[0]["extension"]["cs5"] == "Missing header" and events[0]["extension"]["cs6"] == "gw_0"
    assert '"details":{"data":"","line":"47","message":"m"}' in events[0]["extension"]["msg"]
    assert fl.rejected_records(records, fl.FIREWALL).count() == len(bad)


def test_properties_json_escapes(spark):
    text = "\x01\x0b\x0e\x1f\b\f\n\r\t\"\\\x7f/<>&" + chr(0x2028) + chr(0x2029) + "é \\u001F \\b"
    record = to_records(spark, [access_record(note=text)])
    out = record.select(X.properties_json(F.col("properties"))).first()[0]
    note = out.split('"note":')[1].split(',"requestUri"')[0]
    assert note == (
        '"\\u0001\\u000b\\u000e\\u001f\\u0008\\u000c\\n\\r\\t\\"\\\\\x7f/\\u003c\\u003e\\u0026\\u2028\\u2029'
        'é \\\\u001F \\\\b"'
    )


def named_event(spark, extension):
    schema = (
        "cef_version int, device_vendor string, device_product string, device_version string, "
        "device_event_class_id string, time timestamp, name string, severity int, extension map<string,string>"
    )
    from datetime import datetime

    row = (0, "Microsoft", "Azure NSG", "1", "nsg-flow", datetime(2019, 3, 21, 13, 5, 4), "nsg-flow", 0, extension)
    return spark.createDataFrame([row], schema)


HEADER = "Mar 21 13:05:04|CEF:0|Microsoft|Azure NSG|1|nsg-flow|nsg-flow|0"


@pytest.mark.parametrize(
    "extension, text",
    [
        ({"cs1": "Allow_Web", "act": "back\\"}, "|act=back\\ cs1=Allow_Web"),
        ({"cs1": "Allow_Web", "act": "a=b"}, "|act=a\\=b cs1=Allow_Web"),
        ({"cs1": "U", "act": "two\nlines"}, "|act=two\nlines cs1=U"),
        ({"cs1": "U", "act": ""}, "|cs1=U"),
        ({"b": "x", "B": "y", "a": "z  \n"}, "|B=y a=z  \n b=x"),
        ({"b": "x" + chr(0xA0) + chr(0x3000)}, "|b=x"),
        ({"b": " "}, "|b="),
        ({"act": ""}, ""),
        ({}, ""),
    ],
)
def test_syslog_text(spark, extension, text):
    events = named_event(spark, extension)
    assert events.select(syslog_column(events)).first()[0] == HEADER + text


def test_syslog_text_zone_and_missing_time(spark):
    events = named_event(spark, {})
    assert events.select(syslog_column(events, "America/Toronto")).first()[0].startswith("Mar 21 09:05:04|")
    untimed = events.withColumn("time", F.lit(None).cast("timestamp"))
    assert untimed.select(syslog_column(untimed)).first()[0] == HEADER.split("|", 1)[1]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        events = fl.flow_events(to_records(spark, [flow_record(tuples=[GOOD])]))
        assert events.select(syslog_column(events)).first()[0].startswith("Mar 02 20:06:54|CEF")
        assert '"time":"2019-03-02T20:06:54Z"' in events.select(event_json(events)).first()[0]
        path = P.source_path(F.lit("/x"), F.timestamp_seconds(F.lit(1551557214)))
        assert one(spark, path) == "resourceId=/x/y=2019/m=03/d=02/h=20/m=00/PT1H.json"
        assert one(spark, F.unix_seconds(P.log_time(F.concat(F.lit("a/"), path)))) == 1551556800
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def frame_by_regex(content, host, now):
    """The frame rule with Python's regular expressions."""
    match = re.match(r"^(.*)\|(CEF.*)", content)
    return f"{match[1]} {host} {match[2]}" if match else f"{now} {host} {content}"


@pytest.mark.parametrize(
    "content",
    [
        "CEF", "Feb 03 04:05:06|CEF", "t|CEF:0|a|CEF b", "t|CEF:0\n|CEF x", "a\nt|CEF", "", "|CEF", "t|CE",
        "é|CEF:0\rx" + chr(0x2028) + "y\nz", "t|CEF|CEFCEF",
    ],
)
def test_syslog_frame(spark, content):
    now = F.timestamp_seconds(F.lit(1551557214))
    out = one(spark, X.syslog_frame(F.lit(content), "host7", now))
    assert out == frame_by_regex(content, "host7", "Mar 02 20:06:54")


def test_format_mac(spark):
    cases = {"0A1B2C3D4E5F": "0A:1B:2C:3D:4E:5F", "ABC": "AB:C", "AB": "AB", "A": "A", "": ""}
    for mac, text in cases.items():
        assert one(spark, X.format_mac(F.lit(mac))) == text


def test_paths(spark):
    resource = "/SUBSCRIPTIONS/S/RESOURCEGROUPS/R/PROVIDERS/MICROSOFT.NETWORK/NETWORKSECURITYGROUPS/N"
    path = f"resourceId={resource}/y=2019/m=03/d=02/h=21/m=00/PT1H.json"
    assert one(spark, P.resource_name(F.lit(path))) == "N"
    assert one(spark, P.resource_name(F.lit("x/PT1H.json"))) == ""
    assert one(spark, P.log_time(F.lit(path))).hour == 21
    for bad in ("/m=13/", "/m=00/"):
        assert one(spark, P.log_time(F.lit(path.replace("/m=03/", bad)))) is None
    assert one(spark, P.log_time(F.lit(path.replace("d=02", "d=32")))) is None
    assert one(spark, P.output_name(F.lit(path), F.lit(5), F.lit(9))) == "nsgLog-N-201903022100-5-9.json"
    assert one(spark, P.output_name(F.lit("x"), F.lit(5), F.lit(9))) is None
    resource += "/"
    split = {k: one(spark, v) for k, v in P.split_nsg_resource(F.lit(resource)).items()}
    assert split == {"subscription_id": "S", "resource_group": "R", "resource_name": "N/"}
    assert set(one(spark, v) for v in P.split_gateway_resource(F.lit(resource)).values()) == {""}


def test_ordered_array_is_cut_by_records(spark):
    records = to_records(spark, [flow_record(tuples=[GOOD, GOOD]) for _ in range(5)])
    arrays = fl.ordered_event_array(fl.flow_events(records), records_per_array=2).orderBy("chunk").collect()
    assert [a["event_count"] for a in arrays] == [4, 4, 2]
    whole = fl.ordered_event_array(fl.flow_events(records)).collect()
    assert len(whole) == 1
    joined = ",".join(a["events"][1:-1] for a in arrays)
    assert f"[{joined}]" == whole[0]["events"]


def test_cef_column_without_ready_text(spark):
    events = events_of(spark, flow_record(tuples=[GOOD]))
    plain = events.drop("extension_text")
    assert events.select(cef_column(events)).first() == plain.select(cef_column(plain)).first()


def test_file_bounds_follow_file_order(spark):
    records = to_records(
        spark,
        [
            flow_record(time="2019-03-02T20:09:00Z", tuples=["7" + GOOD[10:], "1,2", "3" + GOOD[10:]]),
            flow_record(time="2019-03-02T20:08:00Z", tuples=["9" + GOOD[10:], "5" + GOOD[10:]]),
            flow_record(time="2019-03-02T20:07:00Z"),
        ],
    )
    events = fl.flow_events(records)
    bounds = fl.file_event_bounds(events).first()
    assert (bounds["first_epoch"], bounds["last_epoch"], bounds["event_count"]) == (7, 5, 4)
    assert fl.last_record_time(records).first()["last_processed_record"].minute == 7
    assert fl.file_record_counts(records).first()["last_count"] == 3
    assert fl.last_processed_timestamp(records, events).first()["last_processed_timestamp"] == 5
    none = fl.last_processed_timestamp(records, events.where("false")).first()
    assert none["last_processed_timestamp"] == 1551557220


def test_resource_split_agrees_with_a_greedy_pattern(spark):
    pieces = ["SUBSCRIPTIONS/", "/RESOURCEGROUPS/", "/PROVIDERS/", "NETWORKSECURITYGROUPS/", "a", "/", "b/c"]
    import random

    rng = random.Random(7)
    ids = ["".join(rng.choice(pieces) for _ in range(rng.randint(3, 12))) for _ in range(3000)]
    ids += ["x/SUBSCRIPTIONS/s/RESOURCEGROUPS/r/PROVIDERS/P/NETWORKSECURITYGROUPS/n" + "/" * i for i in range(3)]
    pattern = re.compile(".*SUBSCRIPTIONS/(.*)/RESOURCEGROUPS/(.*)/PROVIDERS/.*NETWORKSECURITYGROUPS/(.*)")
    frame = spark.createDataFrame([(i,) for i in ids], "id string")
    split = P.split_nsg_resource(F.col("id"))
    matches = 0
    for row in frame.select("id", *[v.alias(k) for k, v in split.items()]).collect():
        match = pattern.search(row["id"])
        matches += bool(match)
        assert tuple(row)[1:] == (match.groups() if match else ("", "", "")), row["id"]
    assert matches > 20
