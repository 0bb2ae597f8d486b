"""Listing and whole-file reads by tasks: equal to Spark's own readers, with few tasks and no path on the driver."""

import gzip
import json
import os
from datetime import datetime, timezone

import pytest
from conftest import blob_path, flow_record, write_log
from flowlog.operators.events import position
from flowlog.operators.progress import file_event_bounds
from flowlog.sinks import files as sinks
from flowlog.sources import events, folders, logs
from pyspark.sql import functions as F


def put(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as out:
        out.write(content)


NAMES = [
    "a/b.json", "a/.hidden.json", "a/_x.json", "a/_k=1/c.json", "a/_metadata", "a/x._COPYING_", "_skip/d.json", "a b/ü%20+.json",
    "y=1/m=07/e.json", "y=1/m=08/f.json", "y=2/g.json", "h.json", "q[1]/i.json", "{z}/j.json",
    "a/empty.json",
]


@pytest.mark.parametrize("spread", [1, 3, 1024])
@pytest.mark.parametrize("glob", ["", "/a*", "/y=1/{m=07,m=0[8]}", "/{y=1/m=07,y=2}", "/q\\[1\\]", "/\\{z\\}/?.json", "/[^a]*/*", "/h.json"])
def test_a_walk_finds_what_spark_lists(spark, tmp_path, monkeypatch, spread, glob):
    monkeypatch.setattr(folders, "SPREAD", spread)
    for name in NAMES:
        put(str(tmp_path / "in" / name), b"" if "empty" in name else name.encode())
    place = f"{tmp_path}/in{glob}"
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(place)
    own = listed.select(logs.read_path(), "_metadata.file_modification_time", "_metadata.file_size").collect()
    assert sorted(map(tuple, folders.walk_files(spark, [place]).collect())) == sorted(map(tuple, own))


def test_a_listing_needs_no_task_for_each_folder(spark, tmp_path):
    for n in range(200):
        write_log(blob_path(tmp_path / "in", f"/S/N-{n}"), [flow_record(tuples=[])])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        assert logs.list_log_files(spark, str(tmp_path / "in")).count() == 200
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("listing")]
        stages = [tracker.getStageInfo(s) for j in jobs for s in j.stageIds]
        assert sum(s.numTasks for s in stages if s) < 100  # one for each of 200 folders before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_documents_read_by_tasks_are_as_spark_reads_them(spark, tmp_path):
    good = json.dumps({"records": [flow_record(tuples=["é"])]}, ensure_ascii=False)
    contents = {
        "good": good.encode(), "empty": b"", "blank": b" \n", "short": good.encode()[:-9], "array": f"[{good},{good}]".encode(),
        "none": b"null", "number": b"5", "trailing": good.encode() + b" x", "wide": good.encode("utf-16-le"), "two": f"{good}\n{good}".encode(),
        "mark": b"\xef\xbb\xbf" + good.encode(), "bytes": good.encode().replace("é".encode(), b"\xff"),
    }
    for name, content in contents.items():
        put(str(tmp_path / "in" / f"{name}.json"), content)
    put(str(tmp_path / "in" / "packed.json.gz"), gzip.compress(good.encode()))
    root = str(tmp_path / "in")

    def rows(files):
        return sorted(map(str, files.select("file", F.to_json("records").alias("records"), "error", "_corrupt_record").collect()))

    mine, own = rows(logs.read_log_files(spark, root, root)), rows(logs._read_files(spark, root, root))
    assert mine == own


def test_globs_that_begin_alike_share_a_walk(spark, tmp_path, monkeypatch):
    for name in NAMES:
        put(str(tmp_path / name), name.encode())
    bases, nodes = folders._merged([folders._seed(x) for x in folders.alternatives(f"{tmp_path}/[ay]*/{{m=07,m=0*,m=0[78],m=07,?.json}}")])
    seen, entries = [], folders._entries

    def listed(path):
        seen.append(path)
        return entries(path)

    monkeypatch.setattr(folders, "_entries", listed)
    rows = [(folders._arrived(nodes, at), f"file:{base}", False, -1, 0) for base, at in bases.items()]
    batch = folders.pa.RecordBatch.from_arrays([folders.pa.array(c, f.type) for c, f in zip(zip(*rows), folders._FOUND)], schema=folders._FOUND)
    found = [r["path"].removeprefix(f"file:{tmp_path}/") for out in folders._walker(nodes, None)(iter([batch])) for r in out.to_pylist()]
    # A file comes as often as globs have it, as from Spark's readers.
    assert sorted(found) == ["a/b.json"] + ["y=1/m=07/e.json"] * 4 + ["y=1/m=08/f.json"] * 2 + ["y=2/g.json"]
    assert len(bases) == 1 and len(seen) == len(set(seen))  # no folder is listed again for each glob


def test_days_of_a_listing_cost_a_resource_one_look(spark, tmp_path):
    for n in range(3):
        write_log(blob_path(tmp_path, f"/SUBSCRIPTIONS/S/RESOURCEGROUPS/G/PROVIDERS/M/K/N-{n}"), [flow_record(tuples=[])])
    location = f"{tmp_path}/{logs.RESOURCE_FOLDERS}/{{{','.join(logs._days(datetime(2017, 7, 15), datetime(2026, 12, 4, tzinfo=timezone.utc)))}}}"
    bases, nodes = folders._merged([folders._seed(x) for x in folders.alternatives(location)])
    assert len(bases) == 1 and len(folders.alternatives(location)) > 40
    rows = logs.list_log_files(spark, str(tmp_path), since=datetime(2017, 7, 15), folders=logs.RESOURCE_FOLDERS)
    assert rows.count() == 3


def test_lines_read_by_tasks_are_as_spark_reads_them(spark, tmp_path):
    contents = {
        "plain": b"a\nb\n\n c", "ends": b"a\r\nb\rc\r\n", "empty": b"", "mark": b"\xef\xbb\xbfx\ny", "bytes": b"\xff\xfe\n\xc3", "vertical": b"a\x0bb\x0cc\x1cd\xc2\x85e",
        "_hidden": b"no", "a b%20+\"<>^`{|}#?[1];é ~": b"odd", "o=1/.p": b"no", "o=1/nested": b"yes",
    }
    for name, content in contents.items():
        put(str(tmp_path / "in" / name), content)
    put(str(tmp_path / "in" / "packed.gz"), gzip.compress(b"un\npacked"))

    def rows(lines):
        return sorted(map(tuple, lines.select("path", F.col("value").cast("binary")).collect()))

    for paths in ([f"{tmp_path}/in"], [f"{tmp_path}/in/o=1", f"file://{tmp_path}/in/pl*"]):
        mine = rows(events._lines(spark, paths))
        assert mine == rows(events._read_lines(spark, paths)) and len(mine) > 4


def test_large_files_are_left_to_the_reader_that_cuts_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(events, "WHOLE_BYTES", 10)
    for n in (2, 20):
        put(str(tmp_path / f"{n}.json"), b"ab\n" * n)
    assert [r["n"] for r in events._lines(spark, [str(tmp_path)]).groupBy("path").agg(F.count("*").alias("n")).orderBy("n").collect()] == [2, 20]


def event_rows(spark, names):
    """Two flow events a log file, in file order."""
    records = [
        (f"resourceId=/S/{name}/y=2019/m=03/d=02/h=20/m=00/PT1H.json", p, 1551556800 + p)
        for name in names for p in (1, 0)
    ]
    rows = spark.createDataFrame(records, "file string, p long, epoch long")
    return rows.select(
        "file", position("p").alias("pos"), "epoch", F.lit(0).alias("cef_version"), F.lit("v").alias("device_vendor"),
        F.lit("d").alias("device_product"), F.lit("1").alias("device_version"), F.lit("c").alias("device_event_class_id"),
        F.timestamp_seconds("epoch").alias("time"), F.col("file").alias("name"), F.lit(1).alias("severity"),
        F.create_map(F.lit("k"), F.col("p").cast("string")).alias("extension"),
    )


def contents(root):
    """Each folder's part files as one text, in order."""
    found = {}
    for at, _, names in os.walk(root):
        texts = [open(os.path.join(at, n), "rb").read() for n in sorted(names) if n.startswith("part")]
        if texts:
            found[os.path.relpath(at, root)] = b"".join(texts)
    return found


@pytest.mark.parametrize("options", [{}, {"mode": "array"}, {"mode": "array", "records_per_document": 1}])
def test_event_files_written_by_tasks_are_as_spark_writes_them(spark, tmp_path, monkeypatch, options):
    rows = event_rows(spark, ["N-1", "N-2", "odd=%:'[x]^{y} ü?#"])
    for _ in range(2):  # the second time in place of the first
        sinks.write_event_files(rows, str(tmp_path / "own"), **options)
    with monkeypatch.context() as patched:
        patched.setattr(sinks, "in_tasks", lambda *_: False)
        sinks.write_event_files(rows, str(tmp_path / "spark"), **options)
    assert contents(tmp_path / "own") == contents(tmp_path / "spark") and len(contents(tmp_path / "own")) >= 3
    assert sorted(os.listdir(tmp_path / "own")) == sorted(os.listdir(tmp_path / "spark"))  # nothing is left aside
    for kind, of in (("none", lambda *_: True), ("none-spark", lambda *_: False)):
        with monkeypatch.context() as patched:
            patched.setattr(sinks, "in_tasks", of)
            sinks.write_event_files(rows.limit(0), str(tmp_path / kind), **options)
    assert os.path.isdir(tmp_path / "none") == os.path.isdir(tmp_path / "none-spark")
    # One document a file again: what a folder held before goes, other folders stay.
    sinks.write_event_files(event_rows(spark, ["N-1"]), str(tmp_path / "own"), mode="array")
    found = contents(tmp_path / "own")
    (folder,) = [f for f in found if "-N-1-" in f]
    assert json.loads(found[folder])[0]["extension"] == {"k": "0"} and any("-N-2-" in f for f in found)
    assert events.read_cef_json(spark, str(tmp_path / "own")).count() == 6


@pytest.mark.parametrize("options", [{}, {"mode": "array"}, {"mode": "array", "records_per_document": 1}])
def test_names_of_event_files_are_not_broadcast(spark, tmp_path, monkeypatch, options):
    plans = []
    monkeypatch.setattr(sinks, "_write_in_tasks", lambda rows, *_: plans.append((rows.collect(), rows._jdf.queryExecution().toString())))
    rows = event_rows(spark, ["N-1", "N-2"])
    sinks.write_event_files(rows, str(tmp_path), bounds=file_event_bounds(rows), **options)
    ((written, plan),) = plans
    executed = plan.split("== Physical Plan ==")[1].split("== Initial Plan ==")[0]
    assert len(written) == 4 and "Join" in executed and "BroadcastExchange" not in executed
    if options == {"mode": "array"}:
        assert executed.count("Exchange hashpartitioning(file") == 2  # names and events; the arrays need no other


def test_event_files_need_no_task_for_each_and_no_folder_on_the_driver(spark, tmp_path, monkeypatch):
    rows = event_rows(spark, [f"N-{n}" for n in range(150)])
    tracker = spark.sparkContext.statusTracker()
    monkeypatch.setattr(type(rows.write), "partitionBy", None)  # its folders and their moves are the driver's
    spark.sparkContext.setJobGroup("events", "events")
    try:
        sinks.write_event_files(rows, str(tmp_path / "out"), mode="array")
        assert events.read_cef_json(spark, str(tmp_path / "out"), file="path").count() == 300
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("events")]
        stages = {s: tracker.getStageInfo(s) for j in jobs for s in j.stageIds}
        assert max(s.numTasks for s in stages.values() if s) < 100  # one for each of 150 folders before
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
