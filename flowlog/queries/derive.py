"""Network logs derived from the star-schema tables.

Every derivation is a projection of one table (or an equi-join of two): no grouping, so nested
records are as small as the row they come from and the work grows with the table. The SQL in
this package computes the flat answers from the same tables directly, without any nesting.
"""

from __future__ import annotations

import contextlib
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import (
    ACCESS_OPERATION,
    FIREWALL_OPERATION,
    NSG_FLOW_OPERATION,
    NSG_RULE_OPERATION,
    source_path,
)
from ..plans.files import folder_names, remove

c = F.col


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_local: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """An empty folder of this application that all executors reach, for what a query writes first.

    A later call with the same name empties it, so a query leaves one folder behind, for its result to be
    read from.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="flowlog-"))
        base = _local[0]
    folder = f"{base.rstrip('/')}/flowlog-queries/{spark.sparkContext.applicationId}/{name}"
    remove(spark, folder)
    return folder


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of ``supplier``, a small file, spread over all cores, as much is made of each."""
    keys = table(spark, sf_dir, "supplier").select("s_suppkey")
    return keys.repartition(spark.sparkContext.defaultParallelism, "s_suppkey")


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _variant(col: Column) -> Column:
    return col.cast("variant")


def nsg_resource_id(k: Column) -> Column:
    matched = _text(
        "/SUBSCRIPTIONS/SUB", k % 3, "/RESOURCEGROUPS/RG", k % 5,
        "/PROVIDERS/MICROSOFT.NETWORK/NETWORKSECURITYGROUPS/NSG-", k,
    )
    trailing = F.when(k % 11 == 0, "/").otherwise("")
    return F.when(k % 13 == 0, _text("UNMATCHED/NSG-", k)).otherwise(F.concat(matched, trailing))


def gateway_resource_id(k: Column) -> Column:
    return _text(
        "/SUBSCRIPTIONS/SUB", k % 3, "/RESOURCEGROUPS/RG", k % 5,
        "/PROVIDERS/MICROSOFT.NETWORK/APPLICATIONGATEWAYS/GW-", k,
    )


def flow_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One flow record per ``lineitem`` row: up to two flows, three groups and three tuples, with
    wrong tuples, wrong field types, other operations and missing times among them."""
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    li = (table(spark, sf_dir, "lineitem").select(*columns, "l_shipdate"))
    order, part, k, line = c("l_orderkey"), c("l_partkey"), c("l_suppkey"), c("l_linenumber")
    hour = order % 4
    epoch = F.unix_date(F.to_date("l_shipdate")).cast("bigint") * 86400 + hour * 3600 + 33
    year_start = F.unix_date(F.to_date(F.trunc("l_shipdate", "year"))).cast("bigint") * 86400
    count = 1 + line % 3
    # Texts are made below the nested values, and what they share below them, so that none is made twice. A filter has all
    # below it interpreted, and code beyond 8,000 bytes a step is never compiled.
    middle = F.concat_ws(
        ",",
        _text("10.", part % 256, ".0.1"),
        _text("172.16.", k % 256, ".9"),
        (1024 + part % 60000).cast("string"),
        F.when(line % 2 == 0, "443").otherwise("80"),
    )
    decision = F.when(c("l_returnflag") == "A", "A").when(c("l_returnflag") == "N", "D").otherwise("Z")
    shared = li.select(
        *columns,
        epoch.alias("epoch"),
        F.timestamp_seconds(year_start + hour * 3600).alias("file_hour"),
        middle.alias("middle"),
        decision.alias("decision"),
        nsg_resource_id(k).alias("resourceId"),
    )

    def flow_tuple(j: int) -> Column:
        slot = order + j
        return F.concat_ws(
            ",",
            F.when(slot % 101 == 0, "abcde")
            .when(slot % 103 == 0, " 12")
            .otherwise((c("epoch") + line + j).cast("string")),
            c("middle"),
            F.when((line + j) % 3 == 0, "T").when((line + j) % 3 == 1, "U").otherwise("X"),
            F.when((part + j) % 17 == 0, "Z").when(c("l_linestatus") == "O", "O").otherwise("I"),
            F.when(slot % 97 != 0, c("decision")),
        )

    texts = shared.select(
        *["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "resourceId", "file_hour"],
        F.when(order % 59 != 0, F.timestamp_seconds("epoch")).alias("time"),
        F.concat("l_returnflag", "l_linestatus").alias("rule"),
        flow_tuple(0).alias("tuple_0"),
        F.when(count >= 2, flow_tuple(1)).alias("tuple_1"),
        F.when(count == 3, flow_tuple(2)).alias("tuple_2"),
    )
    mac = F.when(~((k % 10 == 7) & (hour == 3)), F.lpad(F.hex(k), 12, "0"))
    rule, odd_rule, odd_tuple = c("rule"), order % 211 == 5, order % 401 == 7

    def group(mac_col: Column, tuples: Column) -> Column:
        return F.struct(mac_col.alias("mac"), tuples.alias("flowTuples"))

    def flow(rule_col: Column, *groups: Column) -> Column:
        return F.struct(rule_col.alias("rule"), F.array(*groups).alias("flows"))

    def properties(leaf: Callable[[Column], Column], kind: str, rule_col: Column, *more: Column) -> Column:
        """The nested values, whose texts are as ``leaf`` makes them; ``more`` follows the first group's tuples."""
        first_tuples = F.filter(F.array(leaf(c("tuple_0")), leaf(c("tuple_1")), *more), F.isnotnull)
        empty = group(leaf(F.lit("EMPTY")), F.array().cast(f"array<{kind}>"))
        first = flow(rule_col, group(leaf(mac), first_tuples), empty)
        second = flow(
            leaf(F.concat(F.lit("DefaultRule_"), rule)), group(leaf(F.hex(part)), F.array(leaf(c("tuple_2"))))
        )
        flows = F.when(count == 3, F.array(first, second)).otherwise(F.array(first))
        return F.to_variant_object(F.struct(F.lit(1).alias("Version"), flows.alias("flows")))

    wrong_type = properties(
        _variant, "variant", F.when(odd_rule, _variant(F.lit(5))).otherwise(_variant(rule)),
        F.when(odd_tuple, _variant(F.lit(12345))),
    )
    return texts.select(
        source_path(c("resourceId"), c("file_hour")).alias("file"),
        ((order * 8 + line) * 1000 + part % 1000).alias("record_pos"),
        "time",
        F.when(k % 4 != 0, _text("sys-", k)).alias("systemId"),
        F.lit("NetworkSecurityGroupFlowEvent").alias("category"),
        "resourceId",
        F.when(order % 29 == 0, NSG_RULE_OPERATION)
        .when(order % 31 == 0, "Other")
        .otherwise(NSG_FLOW_OPERATION)
        .alias("operationName"),
        F.when(order % 307 == 3, F.to_variant_object(F.struct(F.lit(1).alias("Version"))))
        .when(odd_rule | odd_tuple, wrong_type)
        .otherwise(properties(lambda text: text, "string", rule))
        .alias("properties"),
    )


def dense_flow_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One clean flow record per ``orders`` row: two rules of two groups of five tuples, nearer to the
    size records have in real logs."""
    orders = (table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"))
    order, k = c("o_orderkey"), c("o_custkey")
    epoch = F.unix_date(F.to_date("o_orderdate")).cast("bigint") * 86400 + order % 86400

    def flow_tuple(r: int, g: int, t: int) -> Column:
        n = r * 10 + g * 5 + t
        return F.concat_ws(
            ",",
            (epoch + n).cast("string"),
            _text("10.", k % 256, f".{n}.1"),
            F.lit("172.16.0.9"),
            (1024 + (order + n) % 60000).cast("string"),
            F.lit("443"),
            F.lit("T" if t % 2 else "U"),
            F.lit("O" if g else "I"),
            F.when((order + n) % 7 == 0, "D").otherwise("A"),
        )

    flows = F.array(
        *[
            F.struct(
                F.lit(f"Rule_{r}").alias("rule"),
                F.array(
                    *[
                        F.struct(
                            F.lpad(F.hex(k * 2 + g), 12, "0").alias("mac"),
                            F.array(*[flow_tuple(r, g, t) for t in range(5)]).alias("flowTuples"),
                        )
                        for g in range(2)
                    ]
                ).alias("flows"),
            )
            for r in range(2)
        ]
    )
    resource_id = nsg_resource_id(k)
    time = F.timestamp_seconds(epoch)
    return orders.select(
        source_path(resource_id, time).alias("file"),
        order.alias("record_pos"),
        time.alias("time"),
        _text("sys-", k).alias("systemId"),
        F.lit("NetworkSecurityGroupFlowEvent").alias("category"),
        resource_id.alias("resourceId"),
        F.lit(NSG_FLOW_OPERATION).alias("operationName"),
        F.to_variant_object(F.struct(F.lit(1).alias("Version"), flows.alias("flows"))).alias("properties"),
    )


def access_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One gateway access record per ``events`` row; a port given as text rejects the record."""
    ev = table(spark, sf_dir, "events")
    event, user, kind = c("event_id"), c("user_id"), c("event_type")
    # The column has no zone; its wall clock is UTC whatever zone the session has.
    instant = F.from_utc_timestamp(c("ts").cast("timestamp"), F.current_timezone())
    time = F.timestamp_seconds(F.unix_seconds(instant))
    port = 1024 + event % 60000
    method = F.when(kind == "purchase", "POST").when(kind == "signup", "PUT").otherwise("GET")
    properties = F.to_variant_object(
        F.struct(
            _text("10.0.", user, ".1").alias("clientIP"),
            F.when(event % 50 == 0, _variant(port.cast("string")))
            .when(event % 7 == 0, _variant(port + F.lit(0.75).cast("double")))
            .otherwise(_variant(port))
            .alias("clientPort"),
            _text("/", kind, "?u=", user, "&x=<1>").alias("requestUri"),
            method.alias("httpMethod"),
            F.struct((event % 9).alias("b"), kind.alias("a")).alias("details"),
        )
    )
    resource_id = gateway_resource_id(user % 20)
    return ev.select(
        source_path(resource_id, time).alias("file"),
        event.alias("record_pos"),
        time.alias("time"),
        F.lit(None).cast("string").alias("systemId"),
        F.lit("ApplicationGatewayAccessLog").alias("category"),
        resource_id.alias("resourceId"),
        F.when(event % 23 == 0, FIREWALL_OPERATION).otherwise(ACCESS_OPERATION).alias("operationName"),
        properties.alias("properties"),
    )


def firewall_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One gateway firewall record per document, its whole text the message; blocked where the
    document is labelled toxic."""
    doc = c("doc_id")
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    message = F.concat(
        "text", F.when(doc % 7 == 0, "\\").otherwise(""), F.when(doc % 5 == 0, "=").otherwise("")
    )
    time = F.timestamp_seconds(1500000000 + doc * 61)
    port = F.when(doc % 3 == 0, _variant((1024 + doc % 60000).cast("string"))).when(
        doc % 3 == 1, _variant(1024 + doc % 60000)
    )
    text = F.struct(
        _text("10.1.", doc % 256, ".1").alias("clientIp"),
        port.alias("clientPort"),
        _text("/d/", doc, "?q=a&b").alias("requestUri"),
        F.when(c("toxic") == 1, "Blocked").otherwise("Detected").alias("action"),
        message.alias("message"),
        F.when(doc % 41 != 0, _text("gw_", doc % 4)).alias("instanceId"),
    )
    resource_id = gateway_resource_id(doc % 20)
    return docs.select(
        source_path(resource_id, time).alias("file"),
        doc.alias("record_pos"),
        time.alias("time"),
        F.lit(None).cast("string").alias("systemId"),
        F.lit("ApplicationGatewayFirewallLog").alias("category"),
        resource_id.alias("resourceId"),
        F.lit(FIREWALL_OPERATION).alias("operationName"),
        F.to_variant_object(text).alias("properties"),
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Container listing: one file per customer group and order day. One group has an impossible
    month, one no log paths at all."""
    group, day = c("o_custkey") % 50, F.to_date("o_orderdate")
    files = (
        table(spark, sf_dir, "orders")
        .groupBy(group.alias("k"), day.alias("day"))
        .agg(F.max("o_orderkey").alias("last_order"), F.count("*").alias("orders"))
    )
    k = c("k")
    month = F.when(k == 49, "13").otherwise(F.date_format("day", "MM"))
    hour = _text(
        "/y=", F.date_format("day", "yyyy"), "/m=", month, "/d=", F.date_format("day", "dd"),
        "/h=", F.lpad((c("last_order") % 24).cast("string"), 2, "0"), "/m=00/PT1H.json",
    )
    log_path = F.concat(F.lit("resourceId="), nsg_resource_id(k), hour)
    name = F.when(k == 48, _text("notes/", F.date_format("day", "yyyyMMdd"), ".txt")).otherwise(log_path)
    modified = F.unix_date("day").cast("bigint") * 86400 + c("last_order") % 86400
    return files.select(
        F.concat(F.lit("/container/"), name).alias("path"),
        name.alias("name"),
        _text("etag-", c("last_order")).alias("etag"),
        F.timestamp_seconds(modified).alias("last_modified"),
        (c("orders") * 100).alias("length"),
    )


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier progress of every third customer group, recorded before, at or after the files' last
    change."""
    known = listing(spark, sf_dir).where("name LIKE 'resourceId=%'")
    group = F.regexp_extract("name", "NSG-([0-9]+)", 1).cast("int")
    seconds = F.unix_seconds("last_modified")
    shift = (seconds % 3 - 1) * 3600
    return known.where(group % 3 == 0).select(
        "name",
        "etag",
        F.timestamp_seconds(seconds + shift).alias("last_modified"),
        F.timestamp_seconds(seconds + shift + 60).alias("last_processed"),
        F.timestamp_seconds(seconds - 7200).alias("last_processed_record"),
        (seconds - 7190).alias("last_processed_timestamp"),
        (c("length") / 100).cast("int").alias("last_count"),
        F.struct(F.lit(0).cast("bigint").alias("Start"), (c("length") - 50).alias("End")).alias(
            "last_processed_range"
        ),
        F.timestamp_seconds(seconds - seconds % 3600).alias("log_time"),
        _text("NSG-", group).alias("nsg_name"),
    )


def log_documents(
    spark: SparkSession,
    sf_dir: str,
    hours: int = 1,
    grown: bool = False,
    long: bool = False,
    timeless: bool = False,
    of: Column | None = None,
) -> DataFrame:
    """Flow log documents, one per ``supplier`` row and hour: ``name`` and JSON ``text``.

    A file has 2 to 6 records a minute apart, three more once it has ``grown``; every record has one
    group of three tuples, the second without its last token in some. Of ``long`` documents some have
    76 or 521 records, and two resources each, in different groups, share a name. ``timeless`` ones end
    with a record that has no time. ``of`` says of which suppliers.
    """
    k, h = c("s_suppkey"), c("h")
    start = F.lit(1500000000 - 1500000000 % 3600).cast("bigint") + h * 3600
    resource_id = _text(
        "/SUBSCRIPTIONS/SUB", k % 3, "/RESOURCEGROUPS/RG", k % 5,
        "/PROVIDERS/MICROSOFT.NETWORK/NETWORKSECURITYGROUPS/NSG-", k - k % 2 if long else k,
    )
    last = 1 + k % 5 + (3 if grown else 0)
    if long:
        last = F.when(k % 25 == 0, 520).when(k % 10 == 5, 75).otherwise(last)

    def record(i: Column, timed: bool = True) -> Column:
        epoch = start + i * 60

        def flow_tuple(t: int) -> Column:
            short = ((k + i) % 4 == 0) & F.lit(t == 1)
            return F.concat_ws(
                ",",
                (epoch + t).cast("string"),
                _text("10.", k % 256, ".", i, ".1"),
                F.lit("172.16.0.9"),
                (1024 + k * 7 % 60000).cast("string"),
                F.lit("443"),
                F.lit("T" if t else "U"),
                F.lit("O" if t == 2 else "I"),
                F.when(~short, "A" if t == 0 else "D"),
            )

        group = F.struct(
            F.lpad(F.hex(k), 12, "0").alias("mac"),
            F.array(*[flow_tuple(t) for t in range(3)]).alias("flowTuples"),
        )
        flow = F.struct(_text("Rule_", i % 2).alias("rule"), F.array(group).alias("flows"))
        return F.struct(
            F.when(F.lit(timed), F.timestamp_seconds(epoch)).alias("time"),
            _text("sys-", k).alias("systemId"),
            F.lit("NetworkSecurityGroupFlowEvent").alias("category"),
            resource_id.alias("resourceId"),
            F.lit(NSG_FLOW_OPERATION).alias("operationName"),
            F.struct(F.lit(1).alias("Version"), F.array(flow).alias("flows")).alias("properties"),
        )

    records = F.transform(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint")), lambda i: record(i))
    if timeless:
        records = F.concat(records, F.array(record(last.cast("bigint") + 1, timed=False)))
    return (
        suppliers(spark, sf_dir)
        .where(F.lit(True) if of is None else of)
        .select("s_suppkey", F.explode(F.array(*[F.lit(i).cast("bigint") for i in range(hours)])).alias("h"))
        .select(
            source_path(resource_id, F.timestamp_seconds(start)).alias("name"),
            F.to_json(F.struct(records.alias("records"))).alias("text"),
        )
    )


def gateway_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gateway log documents, one per ``supplier`` row, whose records are access and firewall records in turns."""
    k = c("s_suppkey")
    resource_id = gateway_resource_id(k)
    start = F.lit(1500000000 - 1500000000 % 3600).cast("bigint")

    def record(i: Column) -> Column:
        access = i % 2 == 0
        address, uri = _text("10.", k % 256, ".", i, ".1"), _text("/p", i, "?u=", k)
        port = 1024 + k * 7 % 60000
        properties = F.struct(
            F.when(access, address).alias("clientIP"),
            F.when(~access, address).alias("clientIp"),
            port.alias("clientPort"),
            uri.alias("requestUri"),
            F.when(access, "GET").alias("httpMethod"),
            F.when(~access, "Blocked").alias("action"),
            F.when(~access, _text("rule ", i)).alias("message"),
            F.when(~access, "gw_0").alias("instanceId"),
        )
        return F.struct(
            F.timestamp_seconds(start + i * 60).alias("time"),
            F.when(access, ACCESS_OPERATION).otherwise("ApplicationGatewayFirewall").alias("operationName"),
            F.when(access, "ApplicationGatewayAccessLog").otherwise("ApplicationGatewayFirewallLog").alias("category"),
            resource_id.alias("resourceId"),
            properties.alias("properties"),
        )

    records = F.transform(F.sequence(F.lit(0).cast("bigint"), 1 + k % 5), record)
    return suppliers(spark, sf_dir).select(
        source_path(resource_id, F.timestamp_seconds(start)).alias("name"),
        F.to_json(F.struct(records.alias("records"))).alias("text"),
    )


def _each(rows: DataFrame, body: Callable[[Iterator[pa.RecordBatch]], None]) -> None:
    """Run ``body`` over the batches of every partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        body(batches)
        return iter(())

    rows.mapInArrow(run, "none int").write.format("noop").mode("overwrite").save()


def _store(root: str):
    """The Arrow file system of a folder, and the folder's name there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")


def _resource(name: str) -> str:
    """The folder of a document's resource."""
    return name.split("/y=", 1)[0]


def write_documents(documents: DataFrame, root: str, spare: str | None = None) -> None:
    """Write ``name, text`` rows as files below ``root``, at exactly these names, which no Spark
    writer can choose. Test data for the queries over files, written a file at a time by the tasks; the
    library itself writes with Spark's writers only.

    On a local or mounted path a resource that is not there yet takes over a folder that ``remove_documents`` put below
    ``spare``, as to make and remove folders costs far more than to write into them. What that held besides is removed.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> None:
        from pyarrow import fs

        store, base = _store(root)
        local = isinstance(store, fs.LocalFileSystem)
        spares = _spares(spare) if local and spare is not None else []
        last, before, written = None, set(), set()
        for batch in batches:
            for name, text in zip(batch["name"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist(), strict=True):
                path = f"{base}/{name}"
                if not local:
                    store.create_dir(path.rsplit("/", 1)[0])
                    with store.open_output_stream(path) as out:
                        out.write(text)
                    continue
                if spare is not None and (folder := f"{base}/{_resource(name)}") != last:
                    last = folder
                    if spares and not os.path.exists(folder):
                        before |= _taken(spares.pop(), folder)
                _put(path, text)
                if before:
                    written.add(path)
        for path in before - written:
            os.remove(path)
            with contextlib.suppress(OSError):
                os.removedirs(os.path.dirname(path))  # as far as they are empty

    _each(documents.select("name", "text"), write)


def _spares(spare: str) -> list[str]:
    """The folders this task may take over: those that the task of its number put aside."""
    own = f"{_store(spare)[1]}/{TaskContext.get().partitionId()}"
    return [f"{own}/{name}" for name in os.listdir(own)] if os.path.isdir(own) else []


def _taken(old: str, folder: str) -> set[str]:
    """Make a folder that was put aside another one, and give the files it holds."""
    held = [os.path.relpath(os.path.join(at, name), old) for at, _, names in os.walk(old) for name in names]
    os.makedirs(os.path.dirname(folder), exist_ok=True)
    try:
        os.rename(old, folder)
    except OSError:  # meanwhile another task has written below it
        return set()
    return {f"{folder}/{name}" for name in held}


def _put(path: str, content: bytes) -> None:
    """Write a file. What is there already is written over in place."""
    flags = os.O_WRONLY | os.O_CREAT | os.O_CLOEXEC
    try:
        out = os.open(path, flags, 0o666)
    except FileNotFoundError:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        out = os.open(path, flags, 0o666)
    with os.fdopen(out, "wb") as file:
        file.write(content)
        file.truncate()


def remove_documents(documents: DataFrame, root: str, spare: str | None = None) -> None:
    """Remove the resource folders of ``log_documents`` that were written, with all they hold, or put them below ``spare``, for
    ``write_documents`` with as many tasks. A folder's documents are in one task."""

    def delete(batches: Iterator[pa.RecordBatch]) -> None:
        from pyarrow import fs

        store, base = _store(root)
        local, seen = isinstance(store, fs.LocalFileSystem), set()
        own = f"{_store(spare)[1]}/{TaskContext.get().partitionId()}" if local and spare is not None else None
        if own is not None:
            os.makedirs(own, exist_ok=True)
        for batch in batches:
            for folder in {_resource(name) for name in batch["name"].to_pylist()} - seen:
                seen.add(folder)
                path = f"{base}/{folder}"
                if own is not None:
                    with contextlib.suppress(FileNotFoundError):
                        os.rename(path, f"{own}/{uuid.uuid4().hex}")
                elif local:
                    shutil.rmtree(path, ignore_errors=True)
                elif store.get_file_info(path).type != fs.FileType.NotFound:
                    store.delete_dir(path)

    _each(documents.select("name"), delete)


def remove_spare(spark: SparkSession, spare: str) -> None:
    """Remove what ``remove_documents`` has put aside, the folders of a task by a task."""
    names = folder_names(spark, spare)

    def delete(batches: Iterator[pa.RecordBatch]) -> None:
        for batch in batches:
            for n in batch["id"].to_pylist():
                shutil.rmtree(f"{_store(spare)[1]}/{names[n]}")

    if names:
        _each(spark.range(0, len(names), 1, len(names)), delete)
    remove(spark, spare)
