"""WARC archives of pages, and a global capture index by external merge.

Writing: one record per page, in WARC/1.1, as text files whose line separator is the empty line that ends a
record, so that any file system Spark writes to will do. Pages of equal payload are archived once: that
with the largest id is the response, the others revisit it.

Reading: every file is parsed by its records' lengths and gives its captures, payload digests recomputed.
The index is an external merge: each task sorts its captures into a run and cuts it at sampled bounds
of (URL key, timestamp, id); each range is then merged from its sorted runs by a loser tree. A URL with very many
captures spreads over several ranges, and its histories are numbered across them.

Defined results: a null html is an empty payload; a null URL has no target header and an empty key; a null
id is smaller than all others. Of repeated rows with the largest id, all are responses. An empty table
gives an empty index.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlog.llm.storage import new_path, partitions, stored

END = "\r\n\r\n"
#: Records in an archive file; a file is read as one value.
FILE_RECORDS = 2000
#: Captures a task sorts into one run.
RUN_CAPTURES = 100_000
#: Sampled keys per range of the merged index.
SAMPLE_PER_RANGE = 20
#: Time of a page without one, by its id in seconds after this (2023-11-14T22:13:20Z).
FIRST_CAPTURE = 1_700_000_000
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8" + END
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_of(hexadecimal: Column) -> Column:
    """Base32 of 40 hexadecimal digits."""
    letters = []
    for part in range(4):
        value = F.conv(F.substring(hexadecimal, 10 * part + 1, 10), 16, 10).cast("long")
        for place in range(7, -1, -1):
            letter = F.shiftright(value, 5 * place).bitwiseAND(31) + 1
            letters.append(F.substring(F.lit(_ALPHABET), letter.cast("int"), F.lit(1)))
    return F.concat(*letters)


def _urn(page_id: Column) -> Column:
    digits = F.md5(F.concat(F.lit("page "), F.coalesce(page_id.cast("string"), F.lit("null"))))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(digits, a, n) for a, n in cuts]), F.lit(">"))


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """``value``: one WARC record per page, without the empty line that ends it.

    Payloads of under ``min_bytes`` bytes are all responses.
    """
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    own = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        payload.alias("html"),
    ).select("*", F.octet_length("html").cast("long").alias("n"), base32_of(F.sha1(F.col("html").cast("binary"))).alias("digest"))
    groups = own.where(F.col("n") >= min_bytes).groupBy("digest")
    # Written first, so that the join below is planned by its size.
    shared = stored(
        groups.agg(F.max("page_id").alias("kept"), F.count("*").alias("pages")).where("pages > 1").select("digest", "kept"),
        "shared",
    )
    joined = own.join(shared, "digest", "left")
    revisit = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    date = F.date_format(
        F.timestamp_seconds(F.lit(FIRST_CAPTURE) + F.coalesce("page_id", F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'"
    )
    target = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")

    def header(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"\r\n{name}: "), value.cast("string"))

    block_bytes = F.lit(len(_HTTP)) + F.when(revisit, 0).otherwise(F.col("n"))
    head = F.concat(
        F.lit("WARC/1.1"),
        header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        header("WARC-Record-ID", _urn(F.col("page_id"))),
        header("WARC-Date", date),
        F.coalesce(header("WARC-Target-URI", target), F.lit("")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(
            revisit,
            F.concat(header("WARC-Profile", F.lit(_PROFILE)), header("WARC-Refers-To", _urn(F.col("kept")))),
        ).otherwise(""),
        F.coalesce(header("X-Page-ID", F.col("page_id")), F.lit("")),
        F.when(revisit, header("X-Refers-To-Page", F.col("kept"))).otherwise(""),
        header("X-Payload-Length", F.col("n")),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", block_bytes),
        F.lit(END + _HTTP),
    )
    return joined.select(F.concat(head, F.when(revisit, "").otherwise(F.col("html"))).alias("value"))


def write_archives(pages: DataFrame, path: str, **options) -> None:
    """WARC files below ``path``, each of ``FILE_RECORDS`` records at most."""
    writer = records(pages, **options).write.option("lineSep", END).option("maxRecordsPerFile", FILE_RECORDS)
    writer.text(path)


def parse(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Offset, headers and block of each record of an archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError(f"no record at byte {at}")
        headers = dict(line.split(": ", 1) for line in lines)
        begin = end + 4
        stop = begin + int(headers["Content-Length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} has another length")
        yield at, headers, data[begin:stop]
        at = stop + 4


def url_key(url: str | None) -> str:
    """Host labels in reverse, then path and query; without scheme, port, user and fragment."""
    found = re.match(r"(?s).*?://([^/?#]*)([^#]*)", url or "")
    if not found:
        return ""
    host = found[1].rpartition("@")[2].partition(":")[0].lower()
    return ",".join(reversed(host.split("."))) + ")" + (found[2] or "/")


_CAPTURES = pa.schema(
    [
        ("url_key", pa.string()),
        ("captured", pa.string()),
        ("page_id", pa.int64()),
        ("file", pa.string()),
        ("at", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)
_CAPTURES_DDL = (
    "url_key string, captured string, page_id long, file string, at long, payload_bytes long, "
    "payload_digest string, record_type string, refers_to long"
)


def _capture(file: str, at: int, headers: dict[str, str], block: bytes) -> dict:
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    length = int(headers["X-Payload-Length"])
    if headers["WARC-Type"] == "response":
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if (found, len(payload)) != (digest, length):
            raise ValueError(f"the payload at byte {at} of {file} has another digest or length")
    ids = [int(headers[n]) if n in headers else None for n in ("X-Page-ID", "X-Refers-To-Page")]
    return {
        "url_key": url_key(headers.get("WARC-Target-URI")),
        "captured": headers["WARC-Date"],
        "page_id": ids[0],
        "file": file,
        "at": at,
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": headers["WARC-Type"],
        "refers_to": ids[1],
    }


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for file, content in zip(batch["path"], batch["content"], strict=True):
            rows = [_capture(file.as_py(), *record) for record in parse(content.as_py())]
            yield pa.RecordBatch.from_pylist(rows, schema=_CAPTURES)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``, in no order."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(_read, _CAPTURES_DDL)


Key = tuple[bytes, str, int]


def _key(row: dict) -> Key:
    return row["url_key"].encode(), row["captured"], -1 if row["page_id"] is None else row["page_id"]


class LoserTree:
    """Merges sorted runs: every inner node keeps the loser of its match, the winner goes up."""

    def __init__(self, runs: list[list[dict]]) -> None:
        self.runs = [iter(run) for run in runs]
        self.size = max(1, len(runs))
        self.heads = [next(run, None) for run in self.runs] or [None]
        self.keys = [None if row is None else _key(row) for row in self.heads]
        self.losers = [-1] * self.size
        self.winner = -1
        for leaf in range(self.size):
            self._play(leaf)

    def _beats(self, a: int, b: int) -> bool:
        if self.keys[a] is None or self.keys[b] is None:
            return self.keys[b] is None and (self.keys[a] is not None or a < b)
        return (self.keys[a], a) < (self.keys[b], b)

    def _play(self, leaf: int) -> None:
        winner, node = leaf, (leaf + self.size) // 2
        while node:
            if self.losers[node] < 0:  # the first to come waits for the other side
                self.losers[node] = winner
                return
            if self._beats(self.losers[node], winner):
                self.losers[node], winner = winner, self.losers[node]
            node //= 2
        self.winner = winner

    def __iter__(self) -> Iterator[dict]:
        while self.keys[self.winner] is not None:
            leaf = self.winner
            yield self.heads[leaf]
            row = self.heads[leaf] = next(self.runs[leaf], None)
            self.keys[leaf] = None if row is None else _key(row)
            self._play(leaf)


def sorted_runs(rows: Iterable[dict], bounds: list[Key]) -> Iterator[tuple[int, list[dict]]]:
    """A run of captures in order, cut into the ranges its captures fall in."""
    rows = sorted(rows, key=_key)
    ranges = [bisect_right(bounds, _key(row)) for row in rows]
    low = 0
    while low < len(rows):
        high = bisect_right(ranges, ranges[low])
        yield ranges[low], rows[low:high]
        low = high


def _packed(rows: list[dict]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _CAPTURES) as writer:
        writer.write_table(pa.Table.from_pylist(rows, _CAPTURES))
    return sink.getvalue().to_pybytes()


def _runs(bounds: list[Key]):
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[dict]) -> pa.RecordBatch:
            cut = list(sorted_runs(rows, bounds))
            return pa.RecordBatch.from_arrays(
                [pa.array([r for r, _ in cut], pa.int64()), pa.array([_packed(x) for _, x in cut], pa.binary())],
                ["range", "run"],
            )

        rows: list[dict] = []
        for batch in batches:
            rows += batch.to_pylist()
            if len(rows) >= RUN_CAPTURES:
                yield flush(rows)
                rows = []
        if rows:
            yield flush(rows)

    return sort


def _merge(table: pa.Table) -> pa.Table:
    runs = sorted((pa.ipc.open_stream(run.as_py()).read_all().to_pylist() for run in table["run"]), key=lambda r: _key(r[0]))
    rows = list(LoserTree(runs))
    merged = pa.Table.from_pylist(rows, _CAPTURES)
    numbers, n, last = [], 0, None
    for row in rows:
        n = n + 1 if row["url_key"] == last else 1
        last = row["url_key"]
        numbers.append(n)
    return (
        merged.append_column("range", pa.array([table["range"][0].as_py()] * len(rows), pa.int64()))
        .append_column("place", pa.array(range(len(rows)), pa.int64()))
        .append_column("number", pa.array(numbers, pa.int64()))
    )


def capture_index(captures: DataFrame) -> DataFrame:
    """The captures with ``position`` in the global order and ``capture_no`` in the history of their URL key."""
    spark = captures.sparkSession
    captures = stored(captures, "captures")
    ranges = partitions(spark)
    total = captures.count()
    share = min(1.0, SAMPLE_PER_RANGE * ranges / max(1, total))
    sample = sorted(_key(r.asDict()) for r in captures.select("url_key", "captured", "page_id").sample(share, seed=3).collect())
    bounds = sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)}) if sample else []
    runs = captures.mapInArrow(_runs(bounds), "range long, run binary")
    merged = stored(
        runs.groupBy("range").applyInArrow(_merge, _CAPTURES_DDL + ", range long, place long, number long"), "merged"
    )
    # Captures in the ranges before, of all keys and of one key: only a range's first key can go on from before.
    sizes = merged.groupBy("range").agg(F.count("*").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ranges_before"))
    own = merged.groupBy("url_key", "range").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("url_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumn("key_before", F.sum("n").over(earlier)).where("key_before IS NOT NULL").drop("n")
    return (
        merged.join(sizes, "range")
        .join(own, ["url_key", "range"], "left")
        .withColumn("position", F.col("ranges_before") + F.col("place"))
        .withColumn("capture_no", F.col("number") + F.coalesce("key_before", F.lit(0)))
        .drop("range", "place", "number", "ranges_before", "key_before")
    )


def archived(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Writes the pages' archives below ``path`` and gives the index of what is read back."""
    spark = pages.sparkSession
    path = path or new_path(spark, "warc")
    write_archives(pages, path, **options)
    return capture_index(read_archives(spark, path))
