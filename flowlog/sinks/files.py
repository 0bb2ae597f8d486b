"""File sinks: events, rejects."""

from __future__ import annotations

import os
import re
import shutil
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import output_name, source_hash
from ..operators.events import event_array_rows, event_json
from ..operators.progress import file_event_bounds
from ..plans.files import qualified, remove
from ..sources.folders import in_tasks
from ..sources.logs import glob_literal
from ..sources.ranges import file_system

#: Parts a file's events are spread over when their file's name is joined to them.
_SALTS = 32
#: Files a task has written before it gives them.
_BATCH = 10_000


def event_file_names(bounds: DataFrame) -> DataFrame:
    """``file, source, output_name`` from ``file_event_bounds``: the event file each log file becomes.

    The name tells the resource's last part, hour and epochs only, so files of resources that share these
    are told apart by ``source``.
    """
    name = output_name(F.col("file"), F.col("first_epoch"), F.col("last_epoch"))
    return bounds.select("file", source_hash(F.col("file")).alias("source"), name.alias("output_name")).where(
        "output_name IS NOT NULL"
    )


def _named(events: DataFrame, names: DataFrame, whole: bool) -> DataFrame:
    """Events with the name of their file. Unless ``whole`` files go to a task each anyway, one with very many events is met by several.

    The names are never broadcast, which would have the driver hold them all; Spark's size checks do not see the salts.
    """
    if whole:
        return events.join(names.hint("shuffle_hash"), "file")
    every = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("salt")
    salted = events.withColumn("salt", F.pmod(F.hash("pos"), F.lit(_SALTS)))
    return salted.join(names.select("*", every).hint("merge"), ["file", "salt"]).drop("salt")


def write_event_files(
    events: DataFrame,
    data_path: str,
    mode: str = "lines",
    bounds: DataFrame | None = None,
    compat: bool = False,
    records_per_document: int | None = None,
) -> None:
    """Write events under ``<data_path>/source=<hash>/output_name=<event file name>/`` in file order.

    ``lines`` writes an event per line: rows are range-partitioned by name and position, so a large
    file is written by several tasks whose part files follow one another. ``array`` writes one JSON array
    per log file, in one part file with an event per line, or with ``records_per_document`` several
    below ``document=<n>/``. Writing the same events again replaces their files.
    """
    whole = mode == "array" and records_per_document is None
    named = _named(events, event_file_names(file_event_bounds(events) if bounds is None else bounds), whole)
    folders = ["source", "output_name"]
    if mode == "lines":
        order = [*folders, "pos"]
        placed = named.repartitionByRange(*order).sortWithinPartitions(*order)
        rows = placed.select(*folders, event_json(placed, compat).alias("value"))
    elif mode == "array":
        if records_per_document is not None:
            folders.append("document")
        rows = event_array_rows(named, records_per_document, compat, extra=("source", "output_name"))
        rows = rows.sortWithinPartitions(*folders, "pos").select(*folders, "value")
    else:
        raise ValueError(f"mode must be lines or array, not {mode}")
    if in_tasks(events.sparkSession, data_path):
        _write_in_tasks(rows, data_path, folders)
        return
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*folders).text(data_path)


def _write_in_tasks(rows: DataFrame, data_path: str, folders: list[str]) -> None:
    """Write ``value`` as lines below folders named by columns, in the order of the rows, where those of a folder stand together. What a folder
    held before is replaced.

    Spark's writer gives the driver every folder, which it then moves, one after the other. Here tasks write files aside, and others
    move them into their folders. Either may be repeated: a file's name is that of its attempt, and what was moved stays.
    """
    spark, base = rows.sparkSession, file_system(qualified(rows.sparkSession, data_path))[1]
    aside = f"{base}/.staging-{uuid.uuid4().hex}"
    moves, names = f"file:{aside}/moves", "folder string, part string"

    def stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = f"{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        os.makedirs(f"{aside}/{own}")
        out, last, found = None, None, []

        def given() -> pa.RecordBatch:
            columns = [pa.array([row[i] for row in found], pa.string()) for i in (0, 1)]
            found.clear()
            return pa.RecordBatch.from_arrays(columns, ["folder", "part"])

        count = 0
        try:
            for batch in batches:
                *keys, values = (c.to_pylist() for c in batch.columns)
                for key, value in zip(zip(*keys, strict=True), values, strict=True):
                    if key != last:
                        if out is not None:
                            out.close()
                        last, part, count = key, f"{own}/{count:06d}", count + 1
                        out = open(f"{aside}/{part}", "wb")
                        found.append(("/".join(f"{c}={_folder(v)}" for c, v in zip(folders, key, strict=True)), part))
                    out.write((value or b"") + b"\n")
                if len(found) >= _BATCH:
                    yield given()
        finally:
            if out is not None:
                out.close()
        yield given()

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, list[str]] = {}
        for batch in batches:
            for folder, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                parts.setdefault(folder, []).append(part)
        for folder, own in parts.items():
            target, new = f"{base}/{folder}", {f"part-{part.replace('/', '-')}.txt": part for part in own}
            os.makedirs(target, exist_ok=True)
            held = set(os.listdir(target))
            for name in held - set(new):
                shutil.rmtree(f"{target}/{name}") if os.path.isdir(f"{target}/{name}") else os.remove(f"{target}/{name}")
            for name in set(new) - held:
                os.rename(f"{aside}/{new[name]}", f"{target}/{name}")
        return iter(())

    lines = rows.select(*[F.col(f).cast("string").alias(f) for f in folders], F.col("value").cast("binary").alias("value"))
    try:
        lines.mapInArrow(stage, names).write.parquet(moves)
        tasks = 4 * spark.sparkContext.defaultParallelism
        placed = spark.read.schema(names).parquet(glob_literal(moves)).repartition(tasks, "folder")
        placed.mapInArrow(move, "none int").write.format("noop").mode("overwrite").save()
    finally:
        remove(spark, f"file:{aside}")


def _folder(value: str | None) -> str:
    """A value as a name of a folder, as Spark's writer makes it."""
    if not value:
        return "__HIVE_DEFAULT_PARTITION__"
    return re.sub(r"[\x01-\x1f\"#%'*/:=?\\\x7f{\[\]^]", lambda found: f"%{ord(found[0]):02X}", value)


def file_sink(data_path: str, mode: str = "lines", compat: bool = False, records_per_document: int | None = None):
    """Destination ``file`` for ``run_incremental`` and ``start_stream``."""

    def write(events: DataFrame, batch) -> None:
        write_event_files(events, data_path, mode, batch.bounds, compat, records_per_document)

    return write
