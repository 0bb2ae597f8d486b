"""Tails read by range, and documents cut into chunks, against whole reads."""

import io
import json
import os
import random

import pytest
from conftest import access_record, blob_path, flow_record, write_log

from pyspark.sql import functions as F

import flowlog as fl
from flowlog.sources import logs, ranges

GOOD = "1551557214,10.20.30.40,198.51.100.7,50123,8443,T,O,A"


def documents():
    """Names and texts of documents of every kind."""
    rng = random.Random(9)
    odd = ['"', "\\", '\\"', "{", "}", "[", "]", "},{", '"records":[{', "é好\U0001f600", "\n", "\\\\", " ", "a" * 50]
    records = []
    for i in range(40):
        text = "".join(rng.choice(odd) for _ in range(rng.randint(0, 12)))
        records.append(flow_record(time=f"2019-03-02T20:{i:02d}:00Z", tuples=[GOOD] * (i % 4), rule=text, note={text: [text, {"x": [[]]}]}))
    whole = json.dumps({"records": records}, ensure_ascii=False)
    texts = {
        "plain": whole,
        "ascii": json.dumps({"records": records}),
        "spaced": json.dumps({"records": records}, indent=3),
        "keys": json.dumps({"a": {"b": 1}, "records": records, "z": "}]"}),
        "other": json.dumps({"more": [{"c": 1}], "records": records}),
        "late": whole + " trailing }{ [",
        "none": '{"records": []}' + " " * 300,
        "cut": whole[: len(whole) // 2],
        "cutstring": whole[:-40],
        "nocomma": whole.replace("}, {\"time\"", "} {\"time\""),
        "twocommas": whole.replace("}, {\"time\"", "},, {\"time\"", 1),
        "badrecord": whole.replace('"category": "Net', '"category" "Net', 1),
        "badtype": whole.replace("2019-03-02T20:05:00Z", "not a time"),
        "null": whole[:-2] + ", null]}",
        "number": whole[:-2] + ", 5]}",
        "timeless": json.dumps({"records": [{"category": "x" * 20}] * 30}),
        "norecords": json.dumps({"entries": records}),
        "notjson": "x" * 3000,
        "gateway": json.dumps({"records": [access_record()] * 20}),
    }
    return texts


def write(folder, texts):
    folder.mkdir()
    for name, text in texts.items():
        (folder / f"{name}.json").write_text(text, encoding="utf-8")


def comparable(rows):
    out = []
    for r in rows.withColumn("properties", F.col("properties").cast("string")).collect():
        out.append((r["file"], r["error"], r["raw"], -1 if r["record_pos"] is None else r["record_pos"], r["time"], r["resourceId"], r["properties"]))
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [211, 4000])
def test_chunks_equal_the_whole_read(spark, tmp_path, chunk):
    write(tmp_path / "in", documents())
    root = str(tmp_path / "in")
    listing = fl.list_log_files(spark, root)
    split = ranges.split_rows(listing.select("path", F.col("name").alias("file"), "length"), chunk)
    whole = logs.log_rows(logs.read_log_files(spark, root, root))
    assert comparable(split) == comparable(whole)


def test_good_documents_are_not_read_whole(spark, tmp_path, monkeypatch):
    texts = documents()
    good = ["plain", "ascii", "spaced", "keys", "late", "gateway"]
    write(tmp_path / "in", {name: texts[name] for name in good})
    listing = fl.list_log_files(spark, str(tmp_path / "in")).select("path", F.col("name").alias("file"), "length")
    pieces = ranges.cut_documents(listing, 500)
    counted = {r["file"]: (r["n"], r["chunks"]) for r in pieces.groupBy("file").agg(F.count("record_pos").alias("n"), F.countDistinct("chunk").alias("chunks")).collect()}
    assert {f: n for f, (n, _) in counted.items()} == {f"{name}.json": 20 if name == "gateway" else 40 for name in good}
    assert all(chunks > 10 for _, chunks in counted.values())

    read, whole = ranges.read_ranges, []
    monkeypatch.setattr(ranges, "read_ranges", lambda rows, opener: whole.append(rows.count()) or read(rows, opener))
    assert ranges.split_rows(listing, 500).count() == 5 * 40 + 20
    assert whole == [0]


@pytest.mark.parametrize("chunk, block", [(1, 1), (37, 5), (1000, 64), (64, 1000)])
def test_blocks_of_any_size_cut_alike(monkeypatch, chunk, block):
    monkeypatch.setattr(ranges, "_BLOCK", block)
    raw = documents()["plain"].encode()[:3000] + b"}]}"
    raw = raw[: raw.rindex(b', {"time"')] + b"]}"
    found, skeleton, quoted, depth = [], b"", 0, 0
    for low in range(0, len(raw), chunk):
        records, between = ranges.cut(io.BytesIO(raw), low, min(low + chunk, len(raw)), len(raw), quoted, depth)
        found, skeleton = found + records, skeleton + between
        for i in range(low, min(low + chunk, len(raw))):
            escaped = (i - len(raw[:i].rstrip(b"\\"))) % 2
            quoted ^= raw[i] == 34 and not escaped
            depth += 0 if quoted else (raw[i] in b"{[") - (raw[i] in b"}]")
        quoted = int(quoted)
    assert [json.loads(r) for r in found] == json.loads(raw)["records"]
    assert json.loads(skeleton) == {"records": [0] * len(found)}


def test_read_log_rows_splits_large_files_only(spark, tmp_path):
    small = write_log(blob_path(tmp_path, hour="y=2019/m=03/d=02/h=19/m=00"), [flow_record(tuples=[GOOD])])
    write_log(blob_path(tmp_path), [flow_record(time=f"2019-03-02T20:00:{i:02d}Z", tuples=[GOOD]) for i in range(50)])
    listing = fl.list_log_files(spark, str(tmp_path))
    rows = fl.read_log_rows(spark, listing, str(tmp_path), split_bytes=os.path.getsize(small))
    assert comparable(rows) == comparable(logs.log_rows(logs.read_log_files(spark, str(tmp_path), str(tmp_path))))
    assert fl.read_log_rows(spark, listing.limit(0), str(tmp_path)).count() == 0


def test_quotes_and_escapes():
    rng = random.Random(1)
    for _ in range(300):
        text = bytes(rng.choice(b'"\\a{') for _ in range(rng.randint(0, 30)))
        at, quotes, escaped = rng.randint(0, len(text)), [], False
        for i, byte in enumerate(text):
            if byte == 34 and not escaped:
                quotes.append(i)
            escaped = byte == 92 and not escaped
        first, after = ranges._quotes(ranges.np.frombuffer(text[:at], "u1"), False)
        second, last = ranges._quotes(ranges.np.frombuffer(text[at:], "u1"), after)
        assert [*first, *(second + at)] == quotes and last == escaped


def test_a_tail_of_a_huge_file_is_read_alone(spark, tmp_path):
    path = blob_path(tmp_path)
    start = 20 << 30
    tail = ", " + json.dumps(flow_record(tuples=[GOOD])) + "]}"
    with open(path, "wb") as out:  # a sparse file of 20 GiB
        out.seek(start)
        out.write(tail.encode())
    listing = fl.list_log_files(spark, str(tmp_path)).withColumn("last_end", F.lit(start))
    rows = logs.log_rows(fl.read_log_tail(spark, listing, str(tmp_path)))
    assert fl.flow_events(logs.log_records(rows)).count() == 1


def test_ranges_are_dealt_out_by_bytes(spark, tmp_path):
    (tmp_path / "f").write_bytes(b"0123456789")
    path = str(tmp_path / "f")
    frame = spark.createDataFrame([(path, "a", 2, 5), (path, "b", 8, 30), (path, "c", 4, 4), (path, "d", 50, 60)], "path string, file string, start long, stop long")
    assert {r["file"]: bytes(r["content"]) for r in ranges.read_ranges(frame).collect()} == {"a": b"234", "b": b"89"}
    big = spark.range(40).select(F.lit(path).alias("path"), (F.col("id") * 10).alias("n"))
    assert ranges.task_count(big, F.lit(100 << 20)) == 32
    assert ranges.read_ranges(frame.limit(0)).count() == 0


def test_paths_with_odd_characters(spark, tmp_path):
    path = tmp_path / "a b%20c+d?e#f"
    path.write_bytes(b"xyz")
    for text in (str(path), f"file:{path}", f"file://{path}"):
        with ranges.open_path(text) as source:
            assert source.read(3) == b"xyz"


def test_small_files_share_tasks(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    for files, most in ((100, cores), (200_000, 200)):
        assert ranges.task_count(spark.range(files), F.lit(2000)) <= most
    (tmp_path / "f").write_bytes(b"0123456789")
    rows = spark.range(500).select(F.lit(str(tmp_path / "f")).alias("path"), F.col("id").cast("string").alias("file"), F.lit(1).alias("start"), F.lit(3).alias("stop"))
    found = ranges.read_ranges(rows)
    assert found.rdd.getNumPartitions() <= cores
    assert sorted((int(r["file"]), bytes(r["content"])) for r in found.collect()) == [(i, b"12") for i in range(500)]


def test_a_kept_split_judges_files_once(spark, tmp_path):
    texts = documents()
    paths = [(str(tmp_path / name), name, len(text.encode())) for name, text in texts.items()]
    for path, name, _ in paths:
        with open(path, "w", encoding="utf-8") as out:
            out.write(texts[name])
    listing, kept = spark.createDataFrame(paths, "path string, file string, length long"), []

    def keep(rows):
        kept.append(rows.columns)
        rows.write.parquet(str(tmp_path / f"kept{len(kept)}"))
        return spark.read.schema(rows.schema).parquet(str(tmp_path / f"kept{len(kept)}"))

    assert comparable(ranges.split_rows(listing, 1000, keep=keep)) == comparable(ranges.split_rows(listing, 1000))
    assert kept[1:] == [["file"]]
