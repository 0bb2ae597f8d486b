"""Reading events back from event files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.files import any_path
from ..schemas import EVENT_COLUMNS, EVENT_DDL
from .folders import in_tasks, walk_files
from .logs import glob_literal, is_packed
from .ranges import read_lines

#: Files longer than this, which several tasks may read, are left to Spark's reader.
WHOLE_BYTES = 16 << 20


def read_cef_json(spark: SparkSession, path: str | list[str], file: str | None = None) -> DataFrame:
    """Events of JSON files: an event per line, alone or as an item of an array, or a whole array per line.

    Arrays may follow one another in a file; all are read. A line that is none of these, such as part
    of an event, fails the read. ``file`` names a column for the path of the file.
    """
    lines = _lines(spark, [path] if isinstance(path, str) else path).where("trim(value) <> ''")
    # An item's line may begin or end its array and have a comma on either side.
    items = F.regexp_replace("value", r"^\s*[\[,]?\s*|\s*[\],]?\s*$", "")
    parsed = F.from_json(F.concat(F.lit("["), items, F.lit("]")), f"ARRAY<STRUCT<{EVENT_DDL}>>", {"mode": "FAILFAST"})
    events = lines.select("path", F.explode(parsed).alias("event"))
    own = [] if file is None else [F.col("path").alias(file)]
    return events.select(*[F.col(f"event.{c}").alias(c) for c in EVENT_COLUMNS], *own)


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, value`` of all lines of files, which tasks list and read; the driver holds the paths of large and packed files, and
    of file systems that tasks cannot open."""
    if not (paths and all(in_tasks(spark, p) for p in paths)):
        return _read_lines(spark, paths)
    for p in paths:
        if not any_path(spark, p):
            spark.read.text(p)  # fails as any reader does
    found = walk_files(spark, paths)
    others = is_packed() | (F.col("length") > WHOLE_BYTES)
    lines = read_lines(found.where(~others).select("path", "length"))
    left = [glob_literal(r["path"]) for r in found.where(others).select("path").collect()]
    return lines.unionByName(_read_lines(spark, left)) if left else lines


def _read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    lines = spark.read.option("recursiveFileLookup", True).text(paths)
    return lines.select(F.col("_metadata.file_path").alias("path"), "value")
