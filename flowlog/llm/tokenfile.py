"""Token-id files: the ids of all documents in order of their id, in blocks coded by context mixing.

Documents are dealt out by ranges of (doc_id, hash of the text), a task writes those of a range in order, and each
file stands for itself: a header with its place among all files, an index of its documents, and blocks of at most 4,096 ids,
each coded anew by ``mixcoder`` and with a checksum of its own. Files are written by Spark's text writer, a file a row and
ended by a line end, so on any file system; documents do not span files, so a file holds ``FILE_IDS`` ids or one
longer document. Reading checks every checksum and gives each document's ids back.

Layout, little-endian; ``crc`` is the unsigned CRC-32 of the rest of its part:

    header     magic "ctxmix1\\n", crc u32, range u32, number of the file in its range u32, documents u32, blocks u32,
               ids of the range before this file u64
    documents  crc u32; then per document: has an id u8, doc_id i64, ids u64 (``documents`` times)
    block      crc u32, ids u32, alphabet size u32, bytes of the alphabet u32, words of code u32;
               gaps between the sorted ids of the alphabet as 7-bit groups, a frequency class u8 for each, words u32

Defined results: a null text is an empty one and gives the end id only. A null id comes first and is null when read
back. Repeated rows are written each; rows that share an id are in the order of their texts' hashes. An empty
table gives no documents. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlog.llm import mixcoder, vocab
from flowlog.llm.storage import new_path, stored

MAGIC = b"ctxmix1\n"
#: Id written after each document.
END_ID = 2
FILE_IDS = mixcoder.LANES * mixcoder.BLOCK_IDS

_HEADER = struct.Struct("<IIIIQ")
_BLOCK = struct.Struct("<IIII")
_CRC = struct.Struct("<I")
_DOC = np.dtype([("known", "u1"), ("doc_id", "<i8"), ("ids", "<u8")])


def _groups(values: np.ndarray) -> bytes:
    """Numbers as 7-bit groups, the lowest first, with the high bit set in all but a number's last."""
    places = 7 * np.arange(5, dtype=np.uint64)
    rest = values.astype(np.uint64)[:, None] >> places
    used = rest > 0
    used[:, 0] = True
    more = np.zeros_like(used)
    more[:, :-1] = used[:, 1:]
    return ((rest & np.uint64(127)) | (more.astype(np.uint64) << np.uint64(7)))[used].astype(np.uint8).tobytes()


def _numbers(data: bytes) -> np.ndarray:
    """The numbers of ``_groups``."""
    raw = np.frombuffer(data, np.uint8).astype(np.uint64)
    ends = np.flatnonzero(raw < 128)
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((raw & np.uint64(127)) << (7 * place).astype(np.uint64), starts)


def _sealed(body: bytes) -> bytes:
    return _CRC.pack(zlib.crc32(body)) + body


def _opened(data: memoryview, at: int, size: int, what: str) -> memoryview:
    """The ``size`` bytes at ``at`` after their checksum."""
    body = data[at + 4 : at + 4 + size]
    if len(body) != size or zlib.crc32(body) != _CRC.unpack_from(data, at)[0]:
        raise ValueError(f"the checksum of the {what} at byte {at} is another")
    return body


def pack_blocks(ids: np.ndarray) -> list[bytes]:
    """The blocks of a run of ids (``u4``), in order."""
    size = mixcoder.BLOCK_IDS
    out: list[bytes] = []
    for low in range(0, len(ids), size * mixcoder.LANES):
        lot = ids[low : low + size * mixcoder.LANES]
        alphabets, places, kinds = [], [], []
        for i in range(0, len(lot), size):
            alphabet, place, counts = np.unique(lot[i : i + size], return_inverse=True, return_counts=True)
            alphabets.append(alphabet)
            places.append(place)
            kinds.append(mixcoder.classes(counts))
        for alphabet, place, kind, words in zip(alphabets, places, kinds, mixcoder.encode(places, kinds), strict=True):
            gaps = _groups(np.diff(alphabet, prepend=alphabet.dtype.type(0)))
            head = _BLOCK.pack(len(place), len(alphabet), len(gaps), len(words))
            out.append(_sealed(head + gaps + kind.tobytes() + words.tobytes()))
    return out


def pack_file(part: int, number: int, before: int, docs: list[tuple[int | None, bytes]]) -> bytes:
    """A file of documents, each its id and its token ids as ``<u4`` bytes."""
    ids = np.frombuffer(b"".join(d for _, d in docs), "<u4")
    blocks = pack_blocks(ids)
    index = np.array([(i is not None, i or 0, len(d) // 4) for i, d in docs], _DOC)
    head = _HEADER.pack(part, number, len(docs), len(blocks), before)
    return b"".join([MAGIC, _sealed(head), _sealed(index.tobytes()), *blocks])


def _parsed(content: bytes) -> tuple[tuple[int, ...], np.ndarray, list[tuple]]:
    """Header, documents and coded blocks (length, alphabet, classes, words) of a file."""
    data = memoryview(content)
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("this is no file of token ids")
    at = len(MAGIC)
    head = _HEADER.unpack(_opened(data, at, _HEADER.size, "header"))
    at += 4 + _HEADER.size
    index = np.frombuffer(_opened(data, at, head[2] * _DOC.itemsize, "index"), _DOC)
    at += 4 + index.nbytes
    blocks = []
    for _ in range(head[3]):
        length, size, gaps, words = _BLOCK.unpack_from(data, at + 4)
        body = _opened(data, at, _BLOCK.size + gaps + size + 4 * words, "block")
        at += 4 + len(body)
        first = _BLOCK.size + gaps
        alphabet = _numbers(body[_BLOCK.size : first]).cumsum().astype("<u4")
        kinds = np.frombuffer(body, np.uint8, size, first)
        blocks.append((length, alphabet, kinds, np.frombuffer(body, "<u4", words, first + size)))
    return head, index, blocks


def _decoded(blocks: list[tuple]) -> list[np.ndarray]:
    """The ids of coded blocks, longer ones decoded first."""
    order = sorted(range(len(blocks)), key=lambda i: -blocks[i][0])
    out: list[np.ndarray] = [np.empty(0, "<u4")] * len(blocks)
    for low in range(0, len(order), mixcoder.LANES):
        lot = order[low : low + mixcoder.LANES]
        lengths, alphabets, kinds, words = zip(*(blocks[i] for i in lot), strict=True)
        for i, alphabet, places in zip(lot, alphabets, mixcoder.decode(list(words), np.array(lengths), list(kinds)), strict=True):
            out[i] = alphabet[places]
    return out


def unpack_files(contents: list[bytes]) -> Iterator[tuple[tuple[int, ...], np.ndarray, np.ndarray]]:
    """Header, documents and ids of each file; their blocks are decoded side by side."""
    parsed = [_parsed(c) for c in contents]
    ids = _decoded([b for _, _, blocks in parsed for b in blocks])
    at = 0
    for head, index, blocks in parsed:
        own = ids[at : at + len(blocks)]
        at += len(blocks)
        yield head, index, np.concatenate(own) if own else np.empty(0, "<u4")


def _writer(vocabulary: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocab.encoder(vocabulary)
        part = TaskContext.get().partitionId()
        number = before = size = 0
        docs: list[tuple[int | None, bytes]] = []

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([pack_file(part, number, before, docs)], pa.binary())], ["content"])

        for batch in batches:
            doc_ids = batch["doc_id"].to_pylist()
            for first, texts in vocab.lots([t or "" for t in batch["text"].to_pylist()]):
                for i, ids in enumerate(encoder.encode(texts), first):
                    if docs and size + len(ids) // 4 + 1 > FILE_IDS:
                        yield flush()
                        number, before, size, docs = number + 1, before + size, 0, []
                    docs.append((doc_ids[i], ids + end))
                    size += len(ids) // 4 + 1
        if docs:
            yield flush()

    return write


def write_ids(
    docs: DataFrame, path: str, vocabulary: str = vocab.BYTE_BPE, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text"
) -> None:
    """Write the ids of all documents as files below ``path``."""
    own = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    own = own.withColumn("tie", F.xxhash64("text"))
    ranged = own.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    files = ranged.select("doc_id", "text").mapInArrow(_writer(vocabulary, end_id), "content binary")
    # The text writer puts out the bytes of a string as they are.
    rows = files.select(F.col("content").cast("string").alias("value"))
    rows.write.option("lineSep", "\n").option("maxRecordsPerFile", 1).text(path)


_READ_DDL = "part int, number int, place long, position long, doc_id long, ids binary"
_READ = pa.schema(
    [("part", pa.int32()), ("number", pa.int32()), ("place", pa.int64()), ("position", pa.int64()),
     ("doc_id", pa.int64()), ("ids", pa.binary())]
)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        contents = batch["content"].to_pylist()
        lot: list[bytes] = []
        for i, content in enumerate(contents):
            lot.append(content)
            if sum(map(len, lot)) < 4 * FILE_IDS and i + 1 < len(contents):
                continue
            for (part, number, _, _, before), index, ids in unpack_files(lot):
                ends = index["ids"].astype(np.int64).cumsum()
                starts = ends - index["ids"].astype(np.int64)
                raw = ids.astype("<u4").tobytes()
                columns = [
                    pa.array(np.full(len(index), part, np.int32)),
                    pa.array(np.full(len(index), number, np.int32)),
                    pa.array(np.arange(len(index))),
                    pa.array(starts + before),
                    pa.array(index["doc_id"], mask=index["known"] == 0),
                    pa.array([raw[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema=_READ)
            lot = []


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files below ``path``: its id and its token ids (``<u4`` bytes), and where it stands:
    ``part`` and ``number`` of its file, ``place`` in it, and ``position``, the ids of the part before it."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(_read, _READ_DDL)


def written(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Writes the files and gives, from what is read back, ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens`` and ``ids_crc32`` per document."""
    spark = docs.sparkSession
    path = path or new_path(spark, "ids")
    write_ids(docs, path, **options)
    read = read_ids(spark, path).select(
        "part", "position", "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
    read = stored(read, "read")
    # A row per range of documents; each has the documents of one task.
    ranges = read.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ids_before"))
    return read.join(ranges, "part").select("doc_id", (F.col("ids_before") + F.col("position")).alias("start"), "n_tokens", "ids_crc32")
