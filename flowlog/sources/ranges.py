"""Byte ranges of log files: tails of which nothing else is fetched, and documents read by several tasks.

Ranges are rows of a DataFrame, dealt out to tasks in proportion to their bytes. A task opens each file, seeks and reads its
range; no path or content passes through the driver.

A large log document is cut into chunks at any byte. What a byte means depends on all before it: whether it stands in a
string, and how deep. A first pass finds, per chunk and for either way it may begin, how it changes both and how many
objects open at each depth; running sums over a file's few chunks then tell where every chunk really begins. In a
second pass each chunk gives the records that begin in it, reading on to the end of its last one, with positions counted from
the chunks before. What stands between the records is kept as the document's skeleton, with 0 for each record, and has to parse
as a document of that many. Documents that do not, that have a record which does not parse, or that are no good for any other
reason are read whole, so that they are rejected, or accepted, exactly as any other file.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from json import detect_encoding
from typing import Any
from urllib.parse import quote, urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import RECORD_FIELDS

#: Bytes a task reads, and what opening a file counts as.
TASK_BYTES = 128 << 20
OPEN_BYTES = 128 << 10
#: Bytes that are worth a task while there are cores without one.
_LEAST_BYTES = 8 << 20
#: Documents longer than this are cut into chunks of this length.
CHUNK_BYTES = 64 << 20
_BLOCK = 1 << 20

#: Opens a path for reading; what it returns has ``seek`` and ``read`` and is closed as a context.
Opener = Callable[[str], Any]


def file_system(path: str):
    """The Arrow file system of a path, local, Azure, S3, GCS or HDFS, and the path's name there."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    parts = urlsplit(path)
    system, base = fs.FileSystem.from_uri(f"{parts.scheme}://{parts.netloc}/")
    # The path is no URL: what looks like a query or an escape in it is part of a name.
    return system, f"{base.rstrip('/')}/{path.split('/', 3)[3]}"


def open_path(path: str):
    """A file of any file system that Arrow knows: local, Azure, S3, GCS or HDFS."""
    system, name = file_system(path)
    return system.open_input_file(name)


def task_count(ranges: DataFrame, size, task_bytes: int = TASK_BYTES) -> int:
    """Tasks that the ranges need by their bytes, or one for each core as long as it has some; ``size`` is a range's number of bytes.

    A task costs about as much as opening thousands of small files, so many small files share one.
    """
    total = int(ranges.agg(F.sum(size + F.lit(OPEN_BYTES))).first()[0] or 0)
    cores = ranges.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-total // task_bytes), min(cores, total // min(task_bytes, _LEAST_BYTES)))


def read_ranges(ranges: DataFrame, opener: Opener = open_path) -> DataFrame:
    """``file, content`` for rows of ``path, file, start, stop``: the bytes from ``start`` up to ``stop``.

    A file that is shorter gives what there is of it; ranges without any byte have no row.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: list[str] = []
        contents: list[bytes] = []
        held = 0

        def given() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(contents, pa.binary())], ["file", "content"])

        for batch in batches:
            for path, file, start, stop in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with opener(path) as source:
                    source.seek(start)
                    content = source.read(stop - start)
                if not content:
                    continue
                files.append(file)
                contents.append(content)
                held += len(content)
                if held >= _READ_BYTES or len(files) >= _READ_ROWS:
                    yield given()
                    files, contents, held = [], [], 0
        if files:
            yield given()

    due = ranges.select("path", "file", F.col("start").cast("bigint"), F.col("stop").cast("bigint")).where("stop > start")
    tasks = task_count(due, F.col("stop") - F.col("start"))
    return due.repartition(tasks, "path", "start").mapInArrow(read, "file string, content binary")


def read_documents(files: DataFrame, opener: Opener = open_path) -> DataFrame:
    """``file, text, raw`` of whole files listed as ``path, file, length``, each read to its end.

    ``text`` is NULL where the bytes are no text; ``raw`` has the bytes where they are not those of the text. As Spark's
    reader of JSON does, it tells UTF-8, 16 and 32 apart, and gives no row for files without anything but blanks.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            for path, file in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with opener(path) as source:
                    content = source.read()
                if not content.strip(b" \t\r\n"):
                    continue
                encoding, raw = detect_encoding(content[:4]), None
                if encoding != "utf-8":
                    content, raw = content.decode(encoding, "replace").encode(), content
                rows.append((file, content, raw))
                held += len(content)
                if held >= _READ_BYTES or len(rows) >= _READ_ROWS:
                    yield _documents(rows)
                    rows, held = [], 0
        if rows:
            yield _documents(rows)

    tasks = task_count(files, F.col("length"))
    return files.select("path", "file").repartition(tasks, "path").mapInArrow(read, "file string, text string, raw binary")


#: Bytes and rows given at a time.
_READ_BYTES = 4 << 20
_READ_ROWS = 1000


def _documents(rows: list[tuple]) -> pa.RecordBatch:
    files, contents, raws = (list(c) for c in zip(*rows, strict=True))
    try:
        texts = pa.array(contents, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:  # bytes that are no text
        for n, content in enumerate(contents):
            try:
                content.decode()
            except UnicodeDecodeError:
                raws[n], contents[n] = raws[n] or content, None
        texts = pa.array(contents, pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([pa.array(files, pa.string()), texts, pa.array(raws, pa.binary())], ["file", "text", "raw"])


def read_lines(files: DataFrame, opener: Opener = open_path) -> DataFrame:
    """``path, value`` for the lines of files listed as ``path, length``, each read whole; the path as Spark's readers give it.

    As for them, a line ends with any of the usual ends, and a byte order mark is no part of the first.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        paths: list[str] = []
        lines: list[list[bytes]] = []
        held = 0

        def given() -> pa.RecordBatch:
            columns = [pa.array(paths, pa.string()), pa.array(lines, pa.list_(pa.binary()))]
            return pa.RecordBatch.from_arrays(columns, ["path", "lines"])

        for batch in batches:
            for path in batch.column(0).to_pylist():
                with opener(path) as source:
                    content = source.read()
                paths.append(_url(path))
                lines.append(content.removeprefix(b"\xef\xbb\xbf").splitlines())
                held += len(content)
                if held >= _READ_BYTES or len(paths) >= _READ_ROWS:
                    yield given()
                    paths, lines, held = [], [], 0
        if paths:
            yield given()

    tasks = task_count(files, F.col("length"))
    found = files.select("path").repartition(tasks, "path").mapInArrow(read, "path string, lines array<binary>")
    return found.select("path", F.explode("lines").alias("line")).select("path", F.col("line").cast("string").alias("value"))


def _url(path: str) -> str:
    """A path of a file system as ``_metadata.file_path`` has it."""
    scheme, _, place = path.partition(":")
    quoted = re.sub(r"[^!$&-;=@-Z_a-z~\x80-\U0010ffff]|[\x80-\x9f\s]", lambda found: quote(found[0], safe=""), place)
    return f"{scheme}:{quoted}"


# --- chunks of a document -----------------------------------------------------------------------


_QUOTE, _BACKSLASH, _OPEN, _CLOSE = 34, 92, 123, 125
_STEP = np.zeros(256, np.int8)
_STEP[[91, _OPEN]] = 1
_STEP[[93, _CLOSE]] = -1


def _quotes(block: np.ndarray, escaped: bool) -> tuple[np.ndarray, bool]:
    """Positions of the quotes that no backslash escapes, and whether the byte after the block is escaped.

    ``escaped`` says so of the block's first byte.
    """

    def before(at: np.ndarray) -> np.ndarray:
        """Backslashes right before each position, odd or even."""
        odd, rest = np.zeros(len(at), bool), np.arange(len(at))
        back = at.copy()
        while len(rest):
            back[rest] -= 1
            inside = back[rest] >= 0
            if escaped:  # the run goes on before the block, by an odd number
                odd[rest[~inside]] ^= True
            rest = rest[inside]
            rest = rest[block[back[rest]] == _BACKSLASH]
            odd[rest] ^= True
        return odd

    found = np.flatnonzero(block == _QUOTE)
    return found[~before(found)], bool(before(np.array([len(block)]))[0])


def _blocks(source, low: int, high: int) -> Iterator[tuple[int, np.ndarray, bool]]:
    """Position, bytes, and whether the first is escaped, of blocks from ``low`` on. The last ends at ``high``."""
    look, run = 64, 0
    while low:
        first = max(0, low - look)
        source.seek(first)
        data = source.read(low - first)
        run = len(data) - len(data.rstrip(b"\\"))
        if run < len(data) or first == 0:
            break
        look *= 16
    escaped = bool(run % 2)
    source.seek(low)
    while low < high:
        block = np.frombuffer(source.read(min(_BLOCK, high - low)), np.uint8)
        if not len(block):
            return
        yield low, block, escaped
        escaped = _quotes(block, escaped)[1]
        low += len(block)


def _scan(opener: Opener):
    """Per chunk: whether it has an odd number of quotes, and for a begin outside or inside of a string, the change of
    depth and the number of objects opened at each depth."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                odd, depth, opened = 0, [0, 0], [{}, {}]
                with opener(row["path"]) as source:
                    for _, block, escaped in _blocks(source, row["low"], row["high"]):
                        quotes, _ = _quotes(block, escaped)
                        at = np.flatnonzero(_STEP[block])
                        within = (np.searchsorted(quotes, at) + odd) & 1
                        for begin in (0, 1):
                            own = at[within == begin]
                            step = _STEP[block[own]].astype(np.int64)
                            before = depth[begin] + step.cumsum() - step
                            depths, counts = np.unique(before[block[own] == _OPEN], return_counts=True)
                            for d, n in zip(depths.tolist(), counts.tolist(), strict=True):
                                opened[begin][d] = opened[begin].get(d, 0) + n
                            depth[begin] += int(step.sum())
                        odd ^= len(quotes) & 1
                row |= {"odd": odd, "depth0": depth[0], "depth1": depth[1]}
                row |= {"opened0": list(opened[0].items()), "opened1": list(opened[1].items())}
            yield pa.RecordBatch.from_pylist(rows, _SCANNED)

    return scan


_SCANNED = pa.schema(
    [("path", pa.string()), ("file", pa.string()), ("chunk", pa.int64()), ("low", pa.int64()), ("high", pa.int64()),
     ("length", pa.int64()), ("odd", pa.int64()), ("depth0", pa.int64()), ("depth1", pa.int64()),
     ("opened0", pa.map_(pa.int64(), pa.int64())), ("opened1", pa.map_(pa.int64(), pa.int64()))]
)
_SCANNED_DDL = (
    "path string, file string, chunk long, low long, high long, length long, odd long, depth0 long, depth1 long, "
    "opened0 map<long, long>, opened1 map<long, long>"
)


def begun(scanned: DataFrame) -> DataFrame:
    """Chunks with how they begin: in a string or not, how deep, and after how many records of their file."""
    before = Window.partitionBy("file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)

    def so_far(column):
        return F.coalesce(F.sum(column).over(before), F.lit(0)).cast("long")

    rows = scanned.withColumn("quoted", so_far("odd") % 2)
    outside = F.col("quoted") == 0
    rows = rows.withColumn("depth", so_far(F.when(outside, F.col("depth0")).otherwise(F.col("depth1"))))
    opened = F.when(outside, F.col("opened0")).otherwise(F.col("opened1"))
    records = F.coalesce(F.try_element_at(opened, 2 - F.col("depth")), F.lit(0))
    rows = rows.withColumn("records_before", so_far(records))
    return rows.select("path", "file", "chunk", "low", "high", "length", "quoted", "depth", "records_before")


def cut(source, low: int, high: int, length: int, quoted: int, depth: int) -> tuple[list[bytes], bytes]:
    """The records that begin in a chunk, and its part of the skeleton."""
    records: list[bytes] = []
    between: list[bytes] = []
    if low and depth <= 0:
        return records, b""  # after the document's end
    open_parts: list[bytes] | None = None  # of a record that began here
    foreign = depth > 2  # in a record of a chunk before
    for at, block, escaped in _blocks(source, low, length):
        if at >= high and open_parts is None:
            break
        quotes, _ = _quotes(block, escaped)
        places = np.flatnonzero(_STEP[block])
        places = places[((np.searchsorted(quotes, places) + quoted) & 1) == 0]
        quoted = (quoted + len(quotes)) & 1
        step, kind = _STEP[block[places]].astype(np.int64), block[places]
        after = depth + step.cumsum()
        begins, ends = (kind == _OPEN) & (after == 3) & (step > 0), (kind == _CLOSE) & (after == 2)
        over = np.flatnonzero(after <= 0)
        stop = int(places[over[0]]) + 1 if len(over) else len(block)
        own = max(0, min(stop, high - at))  # what follows belongs to the next chunk
        raw = block.tobytes()
        mark = 0
        for k in np.flatnonzero(begins | ends).tolist():
            place = int(places[k])
            if place >= stop:
                break
            if ends[k]:
                if open_parts is not None:
                    open_parts.append(raw[mark : place + 1])
                    records.append(b"".join(open_parts))
                    between.append(b"0")
                    open_parts = None
                foreign, mark = False, place + 1
            elif place >= own:
                break
            else:
                between.append(raw[mark:place])
                open_parts, mark = [], place
        if open_parts is not None:
            open_parts.append(raw[mark:])
        elif not foreign:
            between.append(raw[mark:own])
        depth = int(after[-1]) if len(after) else depth
        if len(over) or (open_parts is None and at + len(block) >= high):
            break
    if open_parts is not None:
        between.append(b"{")  # never closed: the skeleton will not parse
    return records, b"".join(between)


_CUT_DDL = "file string, chunk long, record_pos long, text string"
_CUT = pa.schema([("file", pa.string()), ("chunk", pa.int64()), ("record_pos", pa.int64()), ("text", pa.string())])


def _text(raw: bytes) -> str | None:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        return None


def _cutter(opener: Opener):
    """Records with their position, and the chunk's part of the skeleton without one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0

        def given() -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CUT, strict=True)], schema=_CUT)

        for batch in batches:
            for row in batch.to_pylist():
                with opener(row["path"]) as source:
                    records, between = cut(source, *(row[n] for n in ("low", "high", "length", "quoted", "depth")))
                rows += ((row["file"], row["chunk"], n, _text(x)) for n, x in enumerate(records, row["records_before"]))
                rows.append((row["file"], row["chunk"], None, _text(between)))
                held += sum(map(len, records)) + len(between)
                if held >= _READ_BYTES or len(rows) >= _READ_ROWS:
                    yield given()
                    rows, held = [], 0
        if rows:
            yield given()

    return run


def cut_documents(listing: DataFrame, chunk_bytes: int = CHUNK_BYTES, opener: Opener = open_path) -> DataFrame:
    """``file, chunk, record_pos, text`` of the documents listed as ``path, file, length``: a row per record, and a
    row per chunk without position that has the chunk's part of the skeleton."""
    first = F.explode(F.sequence(F.lit(0), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(chunk_bytes)))
    own = listing.select("path", "file", F.col("length").cast("bigint").alias("length"))
    chunks = own.select("*", first.alias("low")).select(
        "path", "file", (F.col("low") / chunk_bytes).cast("bigint").alias("chunk"), F.col("low").cast("bigint").alias("low"),
        F.least(F.col("low") + chunk_bytes, "length").cast("bigint").alias("high"), "length",
    )
    # The running sums in between are over a row per chunk, so chunks are dealt out anew.
    tasks = task_count(chunks, F.col("high") - F.col("low"))
    scanned = chunks.repartition(tasks, "file", "chunk").mapInArrow(_scan(opener), _SCANNED_DDL)
    return begun(scanned).repartition(tasks, "file", "chunk").mapInArrow(_cutter(opener), _CUT_DDL)


Keep = Callable[[DataFrame], DataFrame]


def split_rows(
    listing: DataFrame, chunk_bytes: int = CHUNK_BYTES, opener: Opener = open_path, keep: Keep | None = None
) -> DataFrame:
    """What ``log_rows`` gives of whole-file reads, for large documents listed as ``path, file, length``.

    Records of one document come from as many tasks as it has chunks. Documents that cannot be cut are read whole.
    Files are judged by all their records before any is given, so they are read and judged more than once, unless
    ``keep`` writes the rows it is given, first the records and then the names of good files, and reads them back.
    """
    from .logs import log_rows, parsed_documents

    pieces = cut_documents(listing, chunk_bytes, opener)
    is_record = F.col("record_pos").isNotNull()
    read = F.from_json("text", f"{RECORD_FIELDS}, _corrupt_record STRING", {"mode": "PERMISSIVE"})
    pieces = pieces.select(
        "file", "chunk", "record_pos", F.when(is_record, read).alias("record"),
        F.when(~is_record, F.coalesce("text", F.lit("\0"))).alias("between"),
    )
    pieces = keep(pieces) if keep else pieces
    broken = is_record & (F.col("record").isNull() | F.col("record._corrupt_record").isNotNull())
    parts = F.array_sort(F.collect_list(F.when(~is_record, F.struct("chunk", "between"))))
    judged = pieces.groupBy("file").agg(
        F.count("record_pos").alias("records"),
        F.max(broken).alias("broken"),
        F.max(F.col("record.time").isNotNull()).alias("timed"),
        F.array_join(parts["between"], "").alias("skeleton"),
    )
    frame = F.from_json("skeleton", "records ARRAY<INT>, _corrupt_record STRING", {"mode": "PERMISSIVE"})
    good = judged.withColumn("frame", frame).where(
        ~F.col("broken")
        & F.col("timed")
        & F.col("frame._corrupt_record").isNull()
        & (F.size("frame.records") == F.col("records"))
        & F.forall("frame.records", lambda x: x == 0)
    ).select("file")
    good = keep(good) if keep else good
    none = F.lit(None).cast("string")
    fields = [f"record.{f.split()[0]}" for f in RECORD_FIELDS.split(", ")]
    records = pieces.where(is_record).join(good, "file", "left_semi")
    rows = records.select("file", none.alias("error"), none.alias("raw"), "record_pos", *fields)
    others = listing.join(good, "file", "left_anti").select("path", "file", F.lit(0).alias("start"), F.col("length").alias("stop"))
    whole = read_ranges(others, opener).select("file", F.col("content").cast("string").alias("text"))
    return rows.unionByName(log_rows(parsed_documents(whole)))
