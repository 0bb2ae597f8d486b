"""Reading log files: listing, whole-file and tail reads, and the rejection of broken files."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import (
    ACCESS,
    ACCESS_OPERATION,
    CONTAINERS,
    FIREWALL,
    FIREWALL_OPERATION,
    NSG,
    blob_name,
    is_log_path,
    log_time,
    path_tokens,
    relative_name,
    short_name,
    tokens_time,
)
from ..operators.records import dispatch_operation
from ..plans.files import any_path
from ..schemas import LISTING_DDL, LOG_DDL, POS_TYPE
from .folders import in_tasks, walk_files
from .ranges import CHUNK_BYTES, Opener, open_path, read_documents, read_ranges, split_rows

RECORD_COLUMNS = [
    "file",
    "record_pos",
    "time",
    "systemId",
    "category",
    "resourceId",
    "operationName",
    "properties",
]


def path_not_found(error: AnalysisException) -> bool:
    return (error.getCondition() or "").startswith("PATH_NOT_FOUND")


# --- listing ------------------------------------------------------------------------------------


#: Folders of the resources below a container, whose hours lie right below them.
RESOURCE_FOLDERS = "resourceId=/SUBSCRIPTIONS/*/RESOURCEGROUPS/*/PROVIDERS/*/*/*"


def list_log_files(
    spark: SparkSession,
    root: str,
    prefix: str | None = None,
    since: datetime | None = None,
    folders: str | None = None,
) -> DataFrame:
    """All files under ``root`` whose name starts with ``prefix``, without reading any of them.

    With ``since`` and ``folders``, a glob of the folders that hold the hours, only the days from then
    on are listed, and the cost follows the resources and not the files ever kept. What lies elsewhere is
    not found then.
    """
    location = root.rstrip("/") + (f"/{glob_literal(prefix)}*" if prefix else "")
    if since is not None and folders is not None:
        if prefix:
            raise ValueError("a listing of days has no prefix; narrow its folders instead")
        location = f"{root.rstrip('/')}/{folders}/{{{','.join(_days(since, datetime.now(timezone.utc)))}}}"
    if in_tasks(spark, root):
        return listing_rows(walk_files(spark, [location]), root)
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(location)
    except AnalysisException as error:
        if path_not_found(error):
            return spark.createDataFrame([], LISTING_DDL)
        raise
    return listing_rows(
        files.select(
            read_path().alias("path"),
            F.col("_metadata.file_modification_time").alias("last_modified"),
            F.col("_metadata.file_size").alias("length"),
        ),
        root,
    )


def _days(since: datetime, now: datetime) -> list[str]:
    """Path globs from the day of ``since`` to the day after ``now``: days, and whole months and years."""
    if since.tzinfo is None:
        since = since.replace(tzinfo=timezone.utc)
    day, last = since.astimezone(timezone.utc).date(), max(now, since).date() + timedelta(days=1)
    globs = []
    while day <= last:
        if day.month == day.day == 1 and date(day.year, 12, 31) <= last:
            globs.append(f"y={day:%Y}")
            day = date(day.year + 1, 1, 1)
            continue
        after = date(day.year + day.month // 12, day.month % 12 + 1, 1)
        if day.day == 1 and after - timedelta(days=1) <= last:
            globs.append(f"y={day:%Y}/m={day:%m}")
            day = after
            continue
        globs.append(f"y={day:%Y}/m={day:%m}/d={day:%d}")
        day += timedelta(days=1)
    return globs


def read_path():
    """Path of the file a row was read from. Its metadata column holds the path URL-encoded."""
    return F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))


def listing_rows(files: DataFrame, root: str) -> DataFrame:
    """Listing columns from ``path, last_modified, length``; the etag changes whenever they do.

    The name is the path below ``root``, so files of two containers under one root stay apart.
    """
    etag = F.hex(F.xxhash64("path", "last_modified", "length"))
    return files.select(
        "path",
        relative_name(F.col("path"), root).alias("name"),
        etag.alias("etag"),
        "last_modified",
        "length",
    )


def parse_listing(listing: DataFrame) -> DataFrame:
    """Listing with what the path says: source, hour and short name. Files that are no log files
    are left out; ``rejected_paths`` has them."""
    # Exploding a one-element array keeps later filters on the time from matching the path again.
    found = F.filter(F.array(path_tokens(F.col("name"))), F.isnotnull)
    named = listing.select("*", F.explode(found).alias("tokens")).select(
        *listing.columns,
        F.get("tokens", F.lit(0)).alias("nsg_name"),
        tokens_time(F.col("tokens")).alias("log_time"),
    )
    return named.select("*", short_name(F.col("nsg_name"), F.col("log_time")).alias("short_name"))


def rejected_paths(listing: DataFrame) -> DataFrame:
    """Files that are no log files by their path."""
    return listing.where(~is_log_path(F.col("name"))).select(
        F.col("name").alias("file"),
        F.lit("path").alias("kind"),
        F.lit("expected <resource>/y=YYYY/m=MM/d=DD/h=HH/m=mm in the path").alias("message"),
    )


def impossible_hours(listing: DataFrame) -> DataFrame:
    """Log files whose path names an hour that does not exist."""
    bad = is_log_path(F.col("name")) & log_time(F.col("name")).isNull()
    return listing.where(bad).select(
        F.col("name").alias("file"),
        F.lit("hour").alias("kind"),
        F.lit("no such hour in the path").alias("message"),
    )


def glob_literal(path: str) -> str:
    """Path text with nothing left for Spark to expand."""
    return "".join(f"\\{ch}" if ch in "*?[]{}\\" else ch for ch in path)


# --- whole files --------------------------------------------------------------------------------


def read_log_files(spark: SparkSession, paths: str | list[str], root: str | None = None) -> DataFrame:
    """One row per log file: its records as one array, and whether the document is broken.

    ``file`` is the path below ``root``, or from ``resourceId=`` on without a root. The blob layout
    names two path levels ``m``, so partition discovery must stay off.
    """
    globs = [paths] if isinstance(paths, str) else paths
    if globs and all(in_tasks(spark, p) for p in globs):
        for p in globs:
            if not any_path(spark, p):
                spark.read.text(p)  # fails as any reader does
        found = walk_files(spark, globs)
        file = blob_name(F.col("path")) if root is None else relative_name(F.col("path"), root)
        plain = read_listed(found.where(~is_packed()).select("path", file.alias("file"), "length"))
        packed = [glob_literal(r["path"]) for r in found.where(is_packed()).select("path").collect()]
        return plain.unionByName(_read_files(spark, packed, root)) if packed else plain
    return _read_files(spark, paths, root)


def is_packed():
    """Files that Spark unpacks by their ending."""
    return F.col("path").rlike(r"\.(gz|bz2|deflate|zst|lz4|snappy)$")


def _read_files(spark: SparkSession, paths: str | list[str], root: str | None) -> DataFrame:
    """``read_log_files`` by Spark's reader, whose listing is on the driver."""
    files = (
        spark.read.schema(LOG_DDL)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("recursiveFileLookup", True)
        .json(paths)
    )
    file = blob_name(read_path()) if root is None else relative_name(read_path(), root)
    return files.select(file.alias("file"), "records", "_corrupt_record").select("*", _file_error().alias("error"))


def _file_error():
    """Why a file fails as a whole, NULL for a good file. A document with no records is good."""
    timeless = (F.size("records") > 0) & ~F.exists("records", lambda r: r["time"].isNotNull())
    return (
        F.when(F.col("_corrupt_record").isNotNull() | F.col("records").isNull(), "not a log document")
        .when(timeless, 'failed to find "time" in JSON payload')
        .otherwise(F.lit(None))
    )


def read_listed(files: DataFrame, opener: Opener = open_path) -> DataFrame:
    """What ``read_log_files`` gives of files listed as ``path, file, length``, without any path on the driver."""
    log = F.from_json("text", LOG_DDL, {"mode": "PERMISSIVE"})
    # A document that is an array has a row for each item, as in Spark's reader of files.
    items = F.from_json("text", f"ARRAY<STRUCT<{LOG_DDL}>>", {"mode": "PERMISSIVE"})
    many = F.when(F.col("text").rlike(r"^[ \t\r\n]*\["), items)
    logs = F.explode(F.coalesce(many, F.array(log))).alias("log")
    raw = F.coalesce(F.col("raw").cast("string"), "text")
    bad = F.col("log").isNull() | F.col("log._corrupt_record").isNotNull()
    rows = read_documents(files, opener).select("file", "text", "raw", logs)
    rows = rows.select("file", "log.records", F.when(bad, raw).alias("_corrupt_record"))
    return rows.select("*", _file_error().alias("error"))


def parsed_documents(texts: DataFrame) -> DataFrame:
    """What ``read_log_files`` gives, from whole documents as ``file, text``."""
    log = F.from_json("text", LOG_DDL, {"mode": "PERMISSIVE"}).alias("log")
    return texts.select("file", log).select("file", "log.records", "log._corrupt_record").select("*", _file_error().alias("error"))


def read_log_rows(
    spark: SparkSession, listing: DataFrame, root: str | None = None, split_bytes: int | None = None, **options
) -> DataFrame:
    """``log_rows`` of listed files, ``path``, ``name`` and ``length``; files above ``split_bytes`` are read by several tasks.

    The driver holds the paths of files that tasks cannot open, one batch. ``options`` are those of ``split_rows``.
    """
    split_bytes = CHUNK_BYTES if split_bytes is None else split_bytes
    own = F.col("path").startswith("file:") | (F.col("path").startswith("/") & F.lit(in_tasks(spark, "/")))
    own = own & ~is_packed()
    small = F.col("length") <= split_bytes
    file = blob_name(F.col("path")) if root is None else relative_name(F.col("path"), root)
    parts = [log_rows(read_listed(listing.where(own & small).select("path", file.alias("file"), "length")))]
    others = [glob_literal(r["path"]) for r in listing.where(~own & small).select("path").collect()]
    if others:
        parts.append(log_rows(_read_files(spark, others, root)))
    if not listing.where(~small).isEmpty():
        large = listing.where(F.col("length") > split_bytes).select("path", F.col("name").alias("file"), "length")
        parts.append(split_rows(large, min(split_bytes, CHUNK_BYTES), **options))
    return reduce(DataFrame.unionByName, parts)


def log_rows(files: DataFrame) -> DataFrame:
    """One row per record of a good file, in file order, and one row per file without records.

    The latter has ``record_pos`` NULL; for a broken file it also has ``error`` and ``raw``.
    """
    broken = F.col("error").isNotNull()
    rows = files.select(
        "file",
        "error",
        F.when(broken, F.col("_corrupt_record")).alias("raw"),
        F.posexplode_outer(F.when(~broken, F.col("records"))).alias("record_pos", "record"),
    )
    pos = F.col("record_pos").cast("bigint").alias("record_pos")
    return rows.select("file", "error", "raw", pos, "record.*")


def log_records(rows: DataFrame) -> DataFrame:
    """The records among ``log_rows``."""
    return rows.where("record_pos IS NOT NULL").select(RECORD_COLUMNS)


def file_rejects(rows: DataFrame) -> DataFrame:
    """The broken files among ``log_rows`` as reject rows."""
    return rows.where("error IS NOT NULL").select(
        "file",
        F.lit(None).cast(POS_TYPE).alias("pos"),
        F.lit("file").alias("kind"),
        F.col("error").alias("message"),
        "raw",
    )


def split_corrupt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records of the good files, and reject rows for the broken ones."""
    return log_records(rows), file_rejects(rows)


FAMILIES = (NSG, ACCESS, FIREWALL)


def read_log(spark: SparkSession, family: str, paths: str | list[str], root: str | None = None) -> DataFrame:
    """Records of the operations of a family in log files; other records of the files are left out."""
    records = log_records(log_rows(read_log_files(spark, paths, root)))
    return dispatch_operation(records, family)


def family_of(container: str) -> str:
    """Log family kept in a container; containers other than the gateways' hold NSG logs."""
    gateways = {CONTAINERS[ACCESS_OPERATION]: ACCESS, CONTAINERS[FIREWALL_OPERATION]: FIREWALL}
    return gateways.get(container, NSG)


def read_logs(spark: SparkSession, container: str, paths: str | list[str], root: str | None = None) -> DataFrame:
    """Records of the family a container holds."""
    return read_log(spark, family_of(container), paths, root)


# --- tails --------------------------------------------------------------------------------------


def unread_range(length, last_end):
    """Bytes not read yet: from the last end on, or everything for a new file."""
    start = F.when(F.coalesce(last_end, F.lit(0)) != 0, last_end).otherwise(F.lit(0).cast("bigint"))
    return F.struct(start.alias("Start"), length.alias("End"))


def read_log_tail(spark: SparkSession, listing: DataFrame, root: str, opener: Opener = open_path) -> DataFrame:
    """One row per file as ``read_log_files`` gives, from the bytes past ``last_end`` up to ``length``.

    ``listing`` has ``path``, ``name`` below ``root``, ``length`` and ``last_end`` (NULL or 0 for a new file). Tasks
    fetch these bytes and no others, and files without new bytes are not opened; what was appended after the listing
    is left for the next range. Text starts at the first ``"time"``: keys standing before it in that record are lost,
    which costs gateway logs, whose records start with the resource id, the first record of every read.
    Whole-file reads do not.
    """
    start = F.coalesce("last_end", F.lit(0)).alias("start")
    due = listing.select("path", F.col("name").alias("file"), start, F.col("length").alias("stop"))
    tails = read_ranges(due, opener).select("file", F.decode("content", "UTF-8").alias("tail"))
    first = F.instr("tail", '"time"')
    framed = tails.select(
        "file",
        "tail",
        F.when(
            first > 0,
            F.concat(F.lit('{"records": [{ '), F.expr("substring(tail, instr(tail, '\"time\"'))")),
        ).alias("framed"),
    )
    parsed = framed.select(
        "file",
        "tail",
        F.from_json("framed", LOG_DDL, {"mode": "PERMISSIVE"}).alias("log"),
    )
    error = F.when(F.instr("tail", '"time"') == 0, 'failed to find "time" in JSON payload').when(
        F.col("log._corrupt_record").isNotNull() | F.col("log.records").isNull(), "not a log document"
    )
    return parsed.select(
        "file",
        F.col("log.records").alias("records"),
        F.when(error.isNotNull(), F.col("tail")).alias("_corrupt_record"),
        error.alias("error"),
    )
