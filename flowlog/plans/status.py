"""Per-file progress: the status table, its JSON exchange form, and the joins against a listing."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.records import timestamp_column
from ..schemas import STATUS_COLUMNS, STATUS_DDL
from ..sources.logs import path_not_found
from .files import exists, file_names, remove, touch

_COMMIT_DDL = f"{STATUS_DDL}, event_count BIGINT, version BIGINT"


class StatusTable:
    """Progress of one job: a snapshot of all files, and the commits after it.

    A commit holds the new status of the files of one batch, and counts once its marker is there, an
    empty file that comes last. Versions are taken from the markers, so a batch that changes no
    status uses one up as well. After ``compact_every`` commits the whole status is written as a
    snapshot, and what it replaces is removed: reading never meets more commits than that.
    """

    def __init__(self, spark: SparkSession, path: str, job: str, compact_every: int = 50):
        self.spark = spark
        self.job = job
        self.compact_every = compact_every
        base = path.rstrip("/")
        self.path = f"{base}/status/{job}"
        self.markers = f"{base}/commits/{job}"
        self.snapshots = f"{base}/snapshots/{job}"
        self.snapshot_markers = f"{base}/snapshot-commits/{job}"

    def _table(self, path: str, ddl: str) -> DataFrame:
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(path)

    def _marked(self, path: str) -> list[int]:
        """Versions that have a marker; at most ``compact_every`` of them outlive a compaction."""
        names = file_names(self.spark, path)
        return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))

    def _mark(self, path: str, version: int) -> None:
        touch(self.spark, f"{path}/version={version}")

    def commits(self) -> DataFrame:
        """The newest snapshot's status rows and those of whole commits after it."""
        snapshots = self._marked(self.snapshot_markers)
        newest = snapshots[-1] if snapshots else -1
        after = [v for v in self._marked(self.markers) if v > newest]
        rows = self._table(self.path, _COMMIT_DDL).where(F.col("version").isin(after))
        if not snapshots:
            return rows
        return rows.unionByName(self._table(self.snapshots, _COMMIT_DDL).where(F.col("version") == newest))

    def read(self) -> DataFrame:
        """Current status, one row per file name."""
        return latest_status(self.commits())

    def next_version(self) -> int:
        """One more than any version that was ever whole."""
        return max([-1, *self._marked(self.markers), *self._marked(self.snapshot_markers)]) + 1

    def commit(self, version: int, status: DataFrame | None = None) -> None:
        """Record the status rows of one batch; ``event_count`` is the events it gave per file.

        Without status only the version is used up.
        """
        if status is not None:
            rows = status.select(*STATUS_COLUMNS, "event_count")
            rows.write.mode("overwrite").parquet(f"{self.path}/version={version}")
        self._mark(self.markers, version)
        if len(self._marked(self.markers)) >= self.compact_every:
            self.compact(version)

    def compact(self, version: int) -> None:
        """Write the whole status up to ``version``, the last one, and remove what it replaces."""
        old = [*self._marked(self.markers), *self._marked(self.snapshot_markers)]
        rows = status_with_events(self.commits()).select(*STATUS_COLUMNS, "event_count")
        rows.write.mode("overwrite").parquet(f"{self.snapshots}/version={version}")
        self._mark(self.snapshot_markers, version)
        # Only now: until the snapshot counts, the commits do.
        for v in {v for v in old if v <= version}:
            remove(self.spark, f"{self.markers}/version={v}")
            remove(self.spark, f"{self.path}/version={v}")
            if v < version:
                remove(self.spark, f"{self.snapshot_markers}/version={v}")
                remove(self.spark, f"{self.snapshots}/version={v}")


def status_with_events(commits: DataFrame) -> DataFrame:
    """Newest status of each name, and the events of all its commits."""
    newest = F.max_by(F.struct(*STATUS_COLUMNS), "version").alias("status")
    per_file = commits.groupBy("name").agg(newest, F.sum("event_count").alias("event_count"))
    return per_file.select("status.*", "event_count")


def latest_status(commits: DataFrame) -> DataFrame:
    newest = F.max_by(F.struct(*STATUS_COLUMNS), "version").alias("status")
    return commits.groupBy("name").agg(newest).select("status.*")


# --- exchange form ------------------------------------------------------------------------------


def read_status(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """Status rows of JSON documents that map names to status, one document per line.

    ``whole`` reads each file as one document, however its lines are broken. A missing file is an
    empty status; a document that does not parse fails the read.
    """
    try:
        documents = spark.read.text(path, wholetext=whole)
    except AnalysisException as error:
        if path_not_found(error):
            return spark.createDataFrame([], STATUS_DDL)
        raise
    entries = F.from_json("value", f"MAP<STRING, STRUCT<{STATUS_DDL}>>", {"mode": "FAILFAST"})
    # A status without its own name takes that of its key.
    rows = documents.select(F.explode(entries).alias("key", "status"))
    fields = [F.coalesce("status.name", "key").alias("name")]
    return rows.select(*fields, *[f"status.{c}" for c in STATUS_COLUMNS[1:]])


def status_json(status: DataFrame) -> DataFrame:
    """Status rows as JSON documents, one ``value`` per file: a map from its name to its status."""
    document = F.create_map("name", F.struct(*STATUS_COLUMNS))
    return status.select(F.to_json(document, {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}).alias("value"))


def write_status(status: DataFrame, path: str, job: str) -> str:
    """Write the JSON form of a job's status, a line per file, and return its folder."""
    folder = f"{path.rstrip('/')}/status-{job}.json"
    status_json(status).write.mode("overwrite").text(folder)
    return folder


# --- selection ----------------------------------------------------------------------------------


def begin_time(begin: str | datetime | None) -> datetime | None:
    """Begin time from ``yyyy-MM-dd-HH`` in UTC; text that is no such time is an error."""
    if isinstance(begin, str):
        begin = datetime.strptime(begin, "%Y-%m-%d-%H")
    return begin.replace(tzinfo=timezone.utc) if begin is not None and begin.tzinfo is None else begin


def begin_time_filter(listing: DataFrame, begin: str | datetime | None = None) -> DataFrame:
    """Files of hours strictly later than ``begin``; files without a valid hour never pass."""
    bound = begin_time(begin)
    return listing.where("log_time IS NOT NULL" if bound is None else F.col("log_time") > timestamp_column(bound))


def join_status(listing: DataFrame, status: DataFrame) -> DataFrame:
    """Listing with the known progress of each file beside it, NULL for new files."""
    known = status.select(
        "name",
        F.col("last_modified").alias("known_modified"),
        "last_processed_record",
        "last_processed_timestamp",
        "last_processed_range",
        F.col("last_count").alias("known_count"),
    )
    return listing.join(known, "name", "left")


def unprocessed_files(listing: DataFrame, status: DataFrame) -> DataFrame:
    """New files, and known files modified since, with their progress carried along."""
    joined = join_status(listing, status)
    return joined.where(
        F.col("known_modified").isNull() | (F.col("last_modified") > F.col("known_modified"))
    )


def upsert_status(old: DataFrame, new: DataFrame) -> DataFrame:
    """Status where rows of ``new`` replace those of ``old`` by name and other names stay."""
    return old.join(new, "name", "left_anti").unionByName(new)


# --- views --------------------------------------------------------------------------------------


def status_view(spark: SparkSession, path: str, jobs: list[str]) -> DataFrame:
    """Progress of several jobs by file, with the events each file gave so far."""
    parts = []
    for job in jobs:
        rows = status_with_events(StatusTable(spark, path, job).commits())
        parts.append(rows.select(F.lit(job).alias("job"), "*"))
    return reduce(DataFrame.unionByName, parts)
