"""Folders walked by tasks: the files below them as rows, of which none passes through the driver.

Spark's own listing gives every folder of a level a task of its own and keeps all files on the driver. Here a task
walks down level by level until there are enough folders, these are dealt out anew, and each task walks its share to the end.
Tasks list through Arrow, on file systems that need no credentials of Spark's configuration; others are left to Spark.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.files import qualified

#: Folders a first task leaves to the others, at least, where there are as many.
SPREAD = 1024
_BATCH = 10_000
_FOUND_DDL = "nodes array<int>, path string, file boolean, length long, modified long"
_FOUND = pa.schema(
    [("nodes", pa.list_(pa.int32())), ("path", pa.string()), ("file", pa.bool_()), ("length", pa.int64()), ("modified", pa.int64())]
)
#: Stands for a place of a glob below which everything counts.
_BELOW = -1


def in_tasks(spark: SparkSession, path: str) -> bool:
    """Whether tasks may list and open a path without Spark's file systems."""
    return qualified(spark, path).startswith("file:")


def hidden(name: str, is_file: bool) -> bool:
    """Names that Spark's readers leave out."""
    if not is_file and name.startswith(("_common_metadata", "_metadata")):
        return False
    return name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name)


def alternatives(glob: str) -> list[str]:
    """A path glob without braces for each choice of theirs."""
    depth, begin, parts, at = 0, 0, [], 0
    while at < len(glob):
        ch = glob[at]
        if ch == "\\":
            at += 1
        elif ch == "{":
            depth += 1
            if depth == 1:
                begin, parts, last = at, [], at + 1
        elif ch == "," and depth == 1 or ch == "}" and depth == 1:
            parts.append(glob[last:at])
            last = at + 1
        if ch == "}" and depth:
            depth -= 1
            if not depth:
                return [x for part in parts for x in alternatives(glob[:begin] + part + glob[at + 1 :])]
        at += 1
    return [glob]


def _expression(glob: str) -> str:
    """A name's glob, which has no braces, as a regular expression."""
    out, at = "", 0
    while at < len(glob):
        ch = glob[at]
        close = glob.find("]", at + 2) if ch == "[" else -1
        if ch == "\\" and at + 1 < len(glob):
            at += 1
            out += re.escape(glob[at])
        elif ch == "*":
            out += ".*"
        elif ch == "?":
            out += "."
        elif close > 0:
            inner = glob[at + 1 : close]
            negated = inner[0] in "^!"
            inner = (inner[1:] if negated else inner).replace("\\", "\\\\").replace("[", "\\[")
            out += f"[{'^' if negated else ''}{inner}]"
            at = close
        else:
            out += re.escape(ch)
        at += 1
    return out


def _literal(name: str) -> str | None:
    """The one name a glob stands for, or None."""
    plain = re.sub(r"\\(.)", r"\1", name, flags=re.DOTALL)
    return plain if not re.search(r"[*?\[\]{}]", re.sub(r"\\.", "", name, flags=re.DOTALL)) else None


def _seed(glob: str) -> tuple[str, list[str]]:
    """The folder a glob without braces starts from, and the globs of the names below it."""
    names = glob.split("/")
    fixed = 0
    while fixed < len(names) and _literal(names[fixed]) is not None:
        fixed += 1
    return "/".join(_literal(n) for n in names[:fixed]) or "/", [n for n in names[fixed:] if n]


class _Node:
    """A place that globs have come to: what may follow by name or expression, and how many of them end here."""

    def __init__(self):
        self.named: dict[str, int] = {}
        self.matched: dict[str, int] = {}
        self.ends = 0


def _merged(seeds: list[tuple[str, list[str]]]) -> tuple[dict[str, int], list[_Node]]:
    """Globs as trees that share what they begin with, so that a folder is listed once for all: the node of each base, and all nodes."""
    nodes: list[_Node] = []

    def new() -> int:
        nodes.append(_Node())
        return len(nodes) - 1

    bases: dict[str, int] = {}
    for base, names in seeds:
        if base not in bases:
            bases[base] = new()
        at = bases[base]
        for name in names:
            literal = _literal(name)
            following = nodes[at].matched if literal is None else nodes[at].named
            key = _expression(name) if literal is None else literal
            if key not in following:
                following[key] = new()
            at = following[key]
        nodes[at].ends += 1
    return bases, nodes


def _arrived(nodes: list[_Node], at: int) -> list[int]:
    """Where a folder is that has come to a node: there, if more may follow, and below each glob that ends there."""
    node = nodes[at]
    return [at] * bool(node.named or node.matched) + [_BELOW] * node.ends


def _entries(path: str) -> Iterator[tuple[str, bool, int, int]]:
    """Name, whether it is a file, length and milliseconds of change of all right below a folder, which may have gone."""
    from pyarrow import fs

    from .ranges import file_system

    system, name = file_system(path)
    if not isinstance(system, fs.LocalFileSystem):
        for info in system.get_file_info(fs.FileSelector(name, allow_not_found=True)):
            yield info.base_name, info.is_file, info.size if info.is_file else 0, (info.mtime_ns or 0) // 1_000_000
        return
    try:
        found = os.scandir(name)
    except FileNotFoundError:
        return
    with found:
        for entry in found:
            if not entry.is_file():
                yield entry.name, False, 0, 0
                continue
            try:
                stat = entry.stat()
            except FileNotFoundError:
                continue
            yield entry.name, True, stat.st_size, stat.st_mtime_ns // 1_000_000


def _children(nodes: list[_Node], patterns: dict[str, re.Pattern], folder: tuple) -> Iterator[tuple]:
    """Files and folders right below a folder, as far as the globs let them pass; a file as often as globs have it."""
    at, path, *_ = folder
    below, path = at.count(_BELOW), path.rstrip("/")
    at = [nodes[n] for n in at if n != _BELOW]
    for name, is_file, length, modified in _entries(path or "/"):
        unseen = hidden(name, is_file)
        reached = [] if unseen else [_BELOW] * below
        for node in at:
            following = [node.named[name]] if name in node.named else []
            following += [n for expression, n in node.matched.items() if patterns[expression].fullmatch(name)]
            for n in following:
                reached += ([] if unseen else [_BELOW] * nodes[n].ends) if is_file else _arrived(nodes, n)
        if is_file:
            yield from [([], f"{path}/{name}", True, length, modified)] * len(reached)
        elif reached:
            yield reached, f"{path}/{name}", False, 0, 0


def _walker(nodes: list[_Node], spread: int | None):
    """Goes down level by level until there are ``spread`` folders or none is left."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .ranges import file_system

        patterns = {e: re.compile(e, re.DOTALL) for node in nodes for e in node.matched}
        done: list[tuple] = []

        def given() -> pa.RecordBatch:
            columns = zip(*done, strict=True) if done else [[] for _ in _FOUND]
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND, strict=True)], schema=_FOUND)
            done.clear()
            return batch

        folders: list[tuple] = []
        for batch in batches:
            for row in batch.to_pylist():
                if row["length"] < 0:  # a base may be a file
                    system, name = file_system(row["path"])
                    info = system.get_file_info(name)
                    if info.is_file:
                        times = 0 if hidden(info.base_name, True) else row["nodes"].count(_BELOW)
                        done.extend([([], row["path"], True, info.size, (info.mtime_ns or 0) // 1_000_000)] * times)
                        continue
                (done if row["file"] else folders).append(tuple(row[f.name] for f in _FOUND))
                if len(done) >= _BATCH:
                    yield given()
        while folders and (spread is None or len(folders) < spread):
            # To the end depth first, so that a task holds few folders at a time.
            level, folders = (folders, []) if spread is not None else ([folders.pop()], folders)
            for folder in level:
                for found in _children(nodes, patterns, folder):
                    (done if found[2] else folders).append(found)
                if len(done) >= _BATCH:
                    yield given()
        done.extend((at, path, is_file, 0, 0) for at, path, is_file, *_ in folders)
        yield given()

    return walk


def walk_files(spark: SparkSession, globs: list[str]) -> DataFrame:
    """``path, last_modified, length`` of all files at or below path globs, as they are now."""
    bases, nodes = _merged([_seed(x) for glob in globs for x in alternatives(glob)])
    rows = [(_arrived(nodes, at), qualified(spark, base), False, -1, 0) for base, at in bases.items()]
    cores = spark.sparkContext.defaultParallelism
    first = spark.createDataFrame(rows, _FOUND_DDL).repartition(max(1, min(cores, len(rows) // SPREAD)), "path")
    dealt = first.mapInArrow(_walker(nodes, SPREAD), _FOUND_DDL).repartition(4 * cores, "path")
    files = dealt.mapInArrow(_walker(nodes, None), _FOUND_DDL)
    # Spark's readers leave out empty files as well.
    found = files.where("length > 0").select("path", F.timestamp_millis("modified").alias("last_modified"), "length")
    # A listing is what there was when it was made, however often it is looked at.
    return found.localCheckpoint()
