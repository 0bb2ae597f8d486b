"""Incremental runs: pick new or grown files, convert what is new in them, record the progress."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from itertools import count

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.paths import CONTAINERS, NSG_FLOW_OPERATION
from ..operators.events import union_events
from ..operators.families import family_events, rejects
from ..operators.progress import file_progress
from ..schemas import EVENT_DDL, LISTING_DDL, POS_TYPE, RECORD_FIELDS, SELECTED_COLUMNS, SELECTED_DDL, STATUS_DDL
from ..sources.logs import (
    family_of,
    file_rejects,
    impossible_hours,
    list_log_files,
    listing_rows,
    parse_listing,
    read_log_rows,
    rejected_paths,
    unread_range,
)
from ..sources.ranges import CHUNK_BYTES
from .files import exists, folder_names, remove
from .status import StatusTable, begin_time_filter, begin_time, unprocessed_files

_STAGED_DDL = (
    f"file STRING, error STRING, raw STRING, record_pos BIGINT, {RECORD_FIELDS}, after TIMESTAMP, known_count INT"
)
STAGED_EVENT_DDL = f"file STRING, pos {POS_TYPE}, epoch BIGINT, {EVENT_DDL}, extension_text STRING"
_PROGRESS_DDL = f"{STATUS_DDL}, event_count BIGINT, first_epoch BIGINT, last_epoch BIGINT"
_STARTED_DDL = "version BIGINT, files BIGINT, records BIGINT, events BIGINT"
_REJECT_DDL = f"file STRING, pos {POS_TYPE}, kind STRING, message STRING, raw STRING, version BIGINT"


@dataclass(frozen=True)
class Batch:
    """What a sink may need beside the events: ``version`` is the same when a batch is replayed,
    ``bounds`` has the first and last event epoch of each file."""

    version: int
    bounds: DataFrame


Sink = Callable[[DataFrame, Batch], None]


@dataclass
class Run:
    """Outcome of a run."""

    job: str
    start_time: datetime
    end_time: datetime | None = None
    state: str = "RUNNING"
    batches: int = 0
    files: int = 0
    records: int = 0
    events: int = 0


@dataclass
class Job:
    """A named conversion of one container. Jobs keep separate progress, so several destinations
    can follow the same files.

    ``resume`` says what counts as new in a file read before: ``time`` takes records later than the
    last one seen, ``position`` those past the number of records seen. ``root`` is what the names of
    the listing are relative to. All a job keeps lies below ``state_path``: status, rejects and the
    batches in work. A batch ends with the file that reaches ``bytes_per_batch`` or ``files_per_batch``; documents above
    ``split_bytes`` are read by several tasks.
    """

    spark: SparkSession
    name: str
    sink: Sink
    state_path: str
    container: str = CONTAINERS[NSG_FLOW_OPERATION]
    begin: str | datetime | None = None
    resume: str = "time"
    files_per_batch: int = 200_000
    bytes_per_batch: int = 64 << 30
    split_bytes: int = CHUNK_BYTES
    root: str | None = None
    status: StatusTable = field(init=False)

    def __post_init__(self):
        if self.resume not in ("time", "position"):
            raise ValueError(f"resume must be time or position, not {self.resume}")
        self.family = family_of(self.container)
        self.status = StatusTable(self.spark, self.state_path, self.name)

    @property
    def rejects_path(self) -> str:
        return f"{self.state_path.rstrip('/')}/rejects/{self.name}"

    def process(self, listing: DataFrame) -> Run:
        """Convert what is new in the listed files.

        The listing is evaluated once, into a staged table. Selected files are dealt into batches in a plan table,
        oldest hour first, each committed on its own and in order; while one is emitted the next is
        staged. The driver holds the paths of these batches; file contents stay on the executors.
        """
        run = Run(self.name, datetime.now(timezone.utc))
        self._finish_started_batches(run)
        listing.write.mode("overwrite").parquet(self._staged("listing"))
        listing = self._read(self._staged("listing"), LISTING_DDL)
        self._reject_paths(listing)
        due = begin_time_filter(parse_listing(listing), self.begin)
        batches = self._plan(unprocessed_files(due, self.status.read()).select(SELECTED_COLUMNS))
        first = self.status.next_version()
        with ThreadPoolExecutor(1) as pool:
            staged = pool.submit(self._stage, batches[0], first) if batches else None
            for n in range(len(batches)):
                staged.result()
                if n + 1 < len(batches):
                    staged = pool.submit(self._stage, batches[n + 1], first + n + 1)
                self._emit(first + n, run)
        run.end_time, run.state = datetime.now(timezone.utc), "COMPLETE"
        return run

    def _plan(self, selected: DataFrame) -> list[int]:
        """Write the selected files with the batch each belongs to, and give the batches.

        A file's batch is that of the bytes before it, in the order of hours. These are sums within ranges of hours,
        and of whole ranges, so no task sees all files. A file counts as its share of ``files_per_batch`` at least.
        """
        order = ["log_time", "name"]
        ranged = selected.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
        ranged.write.mode("overwrite").parquet(self._staged("selected"))
        rows = self._read(self._staged("selected"), f"{SELECTED_DDL}, range INT")
        least = -(-self.bytes_per_batch // self.files_per_batch)
        rows = rows.withColumn("cost", F.greatest(F.col("length"), F.lit(least)))
        ranges = rows.groupBy("range").agg(F.sum("cost").alias("total"))
        earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        ranges = ranges.select("range", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
        within = Window.partitionBy("range").orderBy(*order)
        place = F.col("before") + F.sum("cost").over(within) - F.col("cost")
        planned = rows.join(ranges, "range").withColumn("batch", F.floor(place / F.lit(self.bytes_per_batch)))
        path = self._staged("plan")
        planned.select(*SELECTED_COLUMNS, "batch").write.mode("overwrite").partitionBy("batch").parquet(path)
        return sorted(int(n.removeprefix("batch=")) for n in folder_names(self.spark, path) if n.startswith("batch="))

    def _reject_paths(self, listing: DataFrame) -> None:
        """Record the files no run will read, once each, under a version of their own and apart from other rejects."""
        found = union_events(rejected_paths(listing), impossible_hours(listing))
        folder = f"{self.rejects_path}/of=paths"
        known = self._read(folder, _REJECT_DDL).select("file", "kind")
        none = F.lit(None)
        new = found.join(known, ["file", "kind"], "left_anti").select(
            "file", none.cast(POS_TYPE).alias("pos"), "kind", "message", none.cast("string").alias("raw")
        )
        if not new.isEmpty():
            version = self.status.next_version()
            new.write.mode("overwrite").parquet(f"{folder}/version={version}")
            self.status.commit(version)

    # A batch is read once, into staged tables below the state path: the rows of its files, the events
    # made from them, the progress, and last a row that says that all are whole and what they amount to. Sink and
    # rejects are made from these. A file that grows meanwhile cannot get ahead of its recorded progress, and a
    # batch that was staged but not committed is finished from the same rows, so a sink that
    # overwrites by version or name writes the same output again. A committed batch's tables are removed.

    def _stage(self, batch: int, version: int) -> None:
        known = self._read(f"{self._staged('plan')}/batch={batch}", SELECTED_DDL)
        since = known.select(
            F.col("name").alias("file"), F.col("last_processed_record").alias("after"), "known_count"
        )

        number = count()

        def keep(rows: DataFrame) -> DataFrame:
            path = f"{self._staged('pieces', version)}/{next(number)}"
            rows.write.mode("overwrite").parquet(path)
            return self.spark.read.schema(rows.schema).parquet(path)

        rows = read_log_rows(self.spark, known, self.root, self.split_bytes, keep=keep)
        rows.join(since, "file").write.mode("overwrite").parquet(self._staged("rows", version))
        staged = self._staged_rows(version)
        family_events(self._due(staged), self.family, self._after()).write.mode("overwrite").parquet(
            self._staged("events", version)
        )
        progress = file_progress(staged.where("error IS NULL"), self._staged_events(version))
        status = known.alias("k").join(progress.withColumnRenamed("file", "name"), "name").select(
            "name",
            "etag",
            "last_modified",
            F.current_timestamp().alias("last_processed"),
            # A file whose new records all lack a time stays where it was.
            F.coalesce(progress["last_processed_record"], F.col("k.last_processed_record")).alias(
                "last_processed_record"
            ),
            "last_processed_timestamp",
            "last_count",
            unread_range(F.col("length"), F.col("last_processed_range.End")).alias(
                "last_processed_range"
            ),
            "log_time",
            "nsg_name",
            "event_count",
            "first_epoch",
            "last_epoch",
        )
        totals = Observation()
        counts = [F.count("*").alias("files"), F.sum("last_count").alias("records"), F.sum("event_count").alias("events")]
        status.observe(totals, *counts).write.mode("overwrite").parquet(self._staged("progress", version))
        row = (version, *(int(totals.get[n] or 0) for n in ("files", "records", "events")))
        started = self.spark.createDataFrame([row], _STARTED_DDL).coalesce(1)
        started.write.mode("overwrite").parquet(self._staged("started", version))

    def _emit(self, version: int, run: Run) -> None:
        staged = self._staged_rows(version)
        progress = self._read(self._staged("progress", version), _PROGRESS_DDL)
        bounds = progress.where("event_count > 0").select(
            F.col("name").alias("file"), "first_epoch", "last_epoch", "event_count"
        )
        self.sink(self._staged_events(version), Batch(version, bounds))
        bad = union_events(
            file_rejects(staged), rejects(self._due(staged), self.family, self._after())
        )
        folder, found = f"{self.rejects_path}/of=batches/version={version}", Observation()
        bad.observe(found, F.count("*").alias("rows")).write.mode("overwrite").parquet(folder)
        if not found.get["rows"]:
            remove(self.spark, folder)
        started = self._read(self._staged("started", version), _STARTED_DDL).first()
        self.status.commit(version, progress)
        for table in ("started", "rows", "events", "progress", "pieces"):
            remove(self.spark, self._staged(table, version))
        run.batches += 1
        run.files += started["files"]
        run.records += started["records"]
        run.events += started["events"]

    def _finish_started_batches(self, run: Run) -> None:
        """Emit batches that were staged as a whole but not committed, and forget what else was staged."""
        for table in ("started", "rows", "events", "progress", "pieces"):
            versions = sorted(int(n.removeprefix("version=")) for n in folder_names(self.spark, self._staged(table)))
            for version in versions:
                if table != "started":
                    remove(self.spark, self._staged(table, version))
                elif version == self.status.next_version() and self._read(self._staged(table, version), _STARTED_DDL).count():
                    self._emit(version, run)
                else:
                    remove(self.spark, self._staged(table, version))

    def _read(self, path: str, ddl: str) -> DataFrame:
        """A table that may not be there yet; a write that was cut short leaves it without rows."""
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(path)

    def _staged(self, table: str, version: int | None = None) -> str:
        path = f"{self.state_path.rstrip('/')}/stage/{self.name}/{table}"
        return path if version is None else f"{path}/version={version}"

    def _staged_rows(self, version: int) -> DataFrame:
        return self._read(self._staged("rows", version), _STAGED_DDL)

    def _staged_events(self, version: int) -> DataFrame:
        return self._read(self._staged("events", version), STAGED_EVENT_DDL)

    def _due(self, staged: DataFrame) -> DataFrame:
        records = staged.where("record_pos IS NOT NULL")
        if self.resume == "position":
            return records.where(F.col("record_pos") >= F.coalesce("known_count", F.lit(0)))
        return records

    def _after(self) -> str | None:
        return "after" if self.resume == "time" else None


def run_incremental(
    spark: SparkSession,
    root: str,
    job: str,
    sink: Sink,
    state_path: str,
    *,
    begin: str | datetime | None = None,
    prefix: str | None = None,
    folders: str | None = None,
    open_hours: float | None = None,
    listing: DataFrame | None = None,
    **options,
) -> Run:
    """Process everything new under ``root`` once.

    ``listing`` replaces the walk over ``root`` by an inventory, rows of ``path``, ``last_modified`` and ``length``,
    such as a stored table that the storage account keeps; prefix, folders and open hours are not looked at then.

    ``folders``, a glob of the folders that hold the hours (``RESOURCE_FOLDERS`` for the usual layout), lets
    the listing leave out the days before ``begin``. With ``open_hours`` it also leaves out days whose
    hours lie further back than that from the newest hour in the status; files that turn up or grow
    later than that are found by a run without ``open_hours`` only.
    """
    work = Job(spark, job, sink, state_path, begin=begin, root=root, **options)
    if listing is not None:
        return work.process(listing_rows(listing, root))
    return work.process(list_log_files(spark, root, prefix, _since(work, begin, open_hours), folders))


def _since(work: Job, begin: str | datetime | None, open_hours: float | None) -> datetime | None:
    since = begin_time(begin)
    if open_hours is not None:
        newest = work.status.read().agg(F.unix_seconds(F.max("log_time"))).first()[0]
        if newest is not None:
            oldest_open = datetime.fromtimestamp(newest, timezone.utc) - timedelta(hours=open_hours)
            since = oldest_open if since is None else max(since, oldest_open)
    return since


def run_polling(
    spark: SparkSession,
    root: str,
    job: str,
    sink: Sink,
    state_path: str,
    *,
    poll_interval: float = 60,
    rounds: int | None = None,
    **options,
) -> Iterator[Run]:
    """Repeat ``run_incremental`` every ``poll_interval`` seconds, for ever or for some rounds."""
    done = 0
    while rounds is None or done < rounds:
        if done:
            time.sleep(poll_interval)
        yield run_incremental(spark, root, job, sink, state_path, **options)
        done += 1


def job_summary(spark: SparkSession, run: Run) -> DataFrame:
    """One row about a run."""
    return spark.createDataFrame(
        [
            (run.job, run.start_time, run.end_time, run.state, run.batches, run.files, run.records, run.events)
        ],
        "name STRING, start_time TIMESTAMP, end_time TIMESTAMP, status STRING, batches INT, "
        "files BIGINT, records BIGINT, events BIGINT",
    )
