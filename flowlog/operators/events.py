"""The event row all families share, and its text forms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..schemas import EVENT_COLUMNS, POS_TYPE


def position(record_pos, flow_pos=None, group_pos=None, tuple_pos=None) -> Column:
    parts = [record_pos, flow_pos, group_pos, tuple_pos]
    return F.struct(*[F.lit(0) if p is None else F.col(p) for p in parts]).cast(POS_TYPE)


def event_rows(
    rows: DataFrame,
    *,
    pos: Column,
    epoch: Column,
    time: Column,
    product: str,
    class_id: Column,
    name: Column,
    severity: Column,
    pairs: dict[str, Column | str],
    either: X.Either | None = None,
    extra: tuple[str, ...] = (),
    trim: bool = True,
) -> DataFrame:
    """Event rows from flattened input. A value of ``pairs`` is a column or a fixed text; ``either``
    is over these columns, by the names ``ext <key>``, and over the columns ``extra`` of ``rows``.

    ``extension`` and ``extension_text`` say the same thing as map and as text. Both are plain
    projections, so a query that reads one of them never computes the other.
    """
    named = {k: f"'{v}'" if isinstance(v, str) else f"`ext {k}`" for k, v in pairs.items()}
    valued = rows.select(
        "file",
        pos.alias("pos"),
        epoch.alias("epoch"),
        F.lit(X.CEF_VERSION).alias("cef_version"),
        F.lit(X.DEVICE_VENDOR).alias("device_vendor"),
        F.lit(product).alias("device_product"),
        F.lit(X.DEVICE_VERSION).alias("device_version"),
        X.text(class_id).alias("device_event_class_id"),
        time.alias("time"),
        X.text(name).alias("name"),
        severity.cast("int").alias("severity"),
        *[v.alias(f"ext {k}") for k, v in pairs.items() if not isinstance(v, str)],
        *extra,
    )
    return valued.select(
        "file",
        "pos",
        "epoch",
        *EVENT_COLUMNS[:-1],
        X.extension_map(named, either).alias("extension"),
        X.pairs_text(named, either, trim).alias("extension_text"),
    )


def union_events(*events: DataFrame) -> DataFrame:
    """Events of several families as one; families share the event row."""
    return reduce(DataFrame.unionByName, events)


def cef_column(events: DataFrame) -> Column:
    """CEF text of each event, from the ready extension text where the rows carry it."""
    if "extension_text" in events.columns:
        extension = F.col("extension_text")
    else:
        extension = X.extension_text(F.col("extension"))
    return X.cef_text(
        F.col("device_event_class_id"),
        F.col("name"),
        F.col("severity"),
        extension,
        product=F.col("device_product"),
        vendor=F.col("device_vendor"),
        version=F.col("device_version"),
        cef_version=F.col("cef_version"),
    )


def syslog_column(events: DataFrame, tz: str = "UTC") -> Column:
    return X.syslog_text(F.col("time"), cef_column(events), tz)


def syslog_lines(events: DataFrame, host: str, now: Column | None = None, tz: str = "UTC") -> DataFrame:
    """Framed syslog lines: ``file``, ``pos``, ``line``."""
    cef = events.select("file", "pos", "time", cef_column(events).alias("cef"))
    # A timed message of one line that holds no second message is framed from its parts.
    plain = F.col("time").isNotNull() & ~F.contains("cef", F.lit("\n")) & ~F.contains("cef", F.lit("|CEF"))
    parts = F.concat(X.syslog_time(F.col("time"), tz), F.lit(f" {host} "), F.col("cef"))
    content = X.syslog_text(F.col("time"), F.col("cef"), tz)
    line = F.when(plain, parts).otherwise(X.syslog_frame(content, host, now, tz))
    return cef.select("file", "pos", line.alias("line"))


def event_json(events: DataFrame, compat: bool = False) -> Column:
    """JSON object of each event, keys in event order and the extension sorted by key.

    ``compat`` leaves out product and version, which the exchange format lacks, and escapes the
    characters that format does.
    """
    # Seconds fraction without trailing zeros, always in UTC.
    utc = F.concat(F.replace(X.wall_clock(F.col("time")).cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))
    dropped = {"device_product", "device_version"} if compat else set()
    values = {c: F.col(c) for c in EVENT_COLUMNS if c not in dropped}
    values["time"] = utc
    values["extension"] = F.map_from_entries(X.sorted_entries(F.col("extension")))
    text = F.to_json(F.struct(*[v.alias(c) for c, v in values.items()]))
    if compat:
        for char in "<>&\u2028\u2029":
            text = F.replace(text, F.lit(char), F.lit(f"\\u{ord(char):04x}"))
    return text


def event_array_rows(
    events: DataFrame, records_per_document: int | None = None, compat: bool = False, extra: tuple[str, ...] = ()
) -> DataFrame:
    """JSON arrays of events in file order, an event per row: ``file``, ``document``, ``pos``, ``value``.

    The values of a document, one after another, are one JSON array, however many events it has; no
    row holds more than one of them. A log file makes one document, or one for every
    ``records_per_document`` records.
    """
    of = F.lit(0) if records_per_document is None else F.floor(F.col("pos.record_pos") / records_per_document)
    rows = events.withColumn("document", of.cast("int"))
    order = Window.partitionBy("file", "document").orderBy("pos")
    placed = rows.withColumn("nth", F.row_number().over(order)).withColumn("next", F.lead("pos").over(order))
    value = F.concat(
        F.when(F.col("nth") == 1, "[").otherwise(","),
        event_json(placed, compat),
        F.when(F.col("next").isNull(), "]").otherwise(""),
    )
    return placed.select("file", "document", "pos", *extra, value.alias("value"))


def ordered_event_array(
    events: DataFrame, records_per_array: int | None = None, compat: bool = False
) -> DataFrame:
    """JSON arrays of events as one text each: ``file``, ``chunk``, ``event_count``, ``events``.

    One array per log file, or one for every ``records_per_array`` records. It holds an array in one
    row; ``event_array_rows`` gives the same text in as many rows as events.
    """
    rows = event_array_rows(events, records_per_array, compat)
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"])
    return rows.groupBy("file", F.col("document").alias("chunk")).agg(
        F.count("*").cast("int").alias("event_count"), F.array_join(ordered, "").alias("events")
    )
