import json
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("flowlog-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.driver.extraJavaOptions", "-XX:TieredStopAtLevel=1")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


NSG_ID = "/SUBSCRIPTIONS/SUB-7/RESOURCEGROUPS/EDGE/PROVIDERS/MICROSOFT.NETWORK/NETWORKSECURITYGROUPS/WEB-TIER"
GATEWAY_ID = "/SUBSCRIPTIONS/SUB-7/RESOURCEGROUPS/EDGE/PROVIDERS/MICROSOFT.NETWORK/APPLICATIONGATEWAYS/FRONT-GW"


def flow_record(time="2019-03-02T20:07:33.837Z", tuples=(), rule="Rule_A", mac="0A1B2C3D4E5F", **extra):
    group = {"flowTuples": list(tuples)}
    if mac is not None:
        group["mac"] = mac
    record = {
        "time": time,
        "systemId": "sys-77",
        "category": "NetworkSecurityGroupFlowEvent",
        "resourceId": NSG_ID,
        "operationName": "NetworkSecurityGroupFlowEvents",
        "properties": {"Version": 1, "flows": [{"rule": rule, "flows": [group]}]},
    }
    record.update(extra)
    return record


def access_record(time="2019-04-11T09:01:00Z", **properties):
    values = {"clientIP": "1.2.3.4", "clientPort": 8080, "requestUri": "/a?b=<c>&d", "httpMethod": "GET"}
    values.update(properties)
    return {
        "resourceId": GATEWAY_ID,
        "operationName": "ApplicationGatewayAccess",
        "time": time,
        "category": "ApplicationGatewayAccessLog",
        "properties": {k: v for k, v in values.items() if v is not ...},
    }


def firewall_record(time="2019-04-11T09:02:00Z", **properties):
    values = {
        "instanceId": "gw_0",
        "clientIp": "1.2.3.4",
        "clientPort": "0",
        "requestUri": "/x",
        "ruleSetType": "OWASP",
        "message": "Missing header",
        "action": "Detected",
        "details": {"message": "m", "line": "47", "data": ""},
    }
    values.update(properties)
    return {
        "resourceId": GATEWAY_ID,
        "operationName": "ApplicationGatewayFirewall",
        "time": time,
        "category": "ApplicationGatewayFirewallLog",
        "properties": {k: v for k, v in values.items() if v is not ...},
    }


def blob_path(root, resource=NSG_ID, hour="y=2019/m=03/d=02/h=20/m=00"):
    path = os.path.join(str(root), f"resourceId={resource}", hour, "PT1H.json")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    return path


def write_log(path, records, mtime=None):
    with open(path, "w") as out:
        json.dump({"records": records}, out)
    if mtime is not None:
        os.utime(path, (mtime, mtime))
    return path


def to_records(spark, records):
    """Records frame straight from Python dicts, as the readers would give it."""
    from flowlog.schemas import LOG_DDL
    from pyspark.sql import functions as F

    text = json.dumps({"records": records})
    log = spark.createDataFrame([(text,)], "j string").select(F.from_json("j", LOG_DDL).alias("log"))
    rows = log.select(F.lit("f").alias("file"), F.posexplode("log.records").alias("record_pos", "r"))
    return rows.select("file", F.col("record_pos").cast("bigint").alias("record_pos"), "r.*")
