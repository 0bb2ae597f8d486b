"""Syslog sinks: framed CEF lines to text files or through an injected sender."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from ..operators.events import syslog_lines

# Called once per partition with its lines in order.
Sender = Callable[[Iterable[str]], None]


def write_syslog(lines: DataFrame, sink: str | Sender, whole_files: bool = False) -> None:
    """Write ``syslog_lines`` in file order: to text files at a path, or through a sender.

    Lines are range-partitioned by position, so partitions follow one another and a large file is
    sent by several tasks. Part files keep that order. A sender sees partitions at the same time, so
    lines of a file that is spread arrive in turns; with ``whole_files`` one task sends a file from
    first to last line. A task that is retried sends its lines again: delivery through a sender is at
    least once.
    """
    spread = lines.repartition("file") if whole_files else lines.repartitionByRange("file", "pos")
    ordered = spread.sortWithinPartitions("file", "pos").select("line")
    if isinstance(sink, str):
        ordered.write.mode("overwrite").text(sink)
        return

    def send(rows) -> None:
        sink(row["line"] for row in rows)

    ordered.foreachPartition(send)


def syslog_sink(host: str, sink: str | Sender, tz: str = "UTC", whole_files: bool = False):
    """Destination ``syslog``; lines for a path go to one folder per batch."""

    def write(events: DataFrame, batch) -> None:
        target = f"{sink.rstrip('/')}/{batch.version}" if isinstance(sink, str) else sink
        write_syslog(syslog_lines(events, host, tz=tz), target, whole_files)

    return write
