"""Reading, selecting, converting and recording real files."""

import json
import os
from datetime import datetime, timedelta, timezone

import pytest
from conftest import GATEWAY_ID, NSG_ID, access_record, blob_path, flow_record, write_log

from pyspark.sql import functions as F

import flowlog as fl
from flowlog.schemas import STATUS_DDL
from flowlog.sources import logs

GOOD = "1551557214,10.20.30.40,198.51.100.7,50123,8443,T,O,A"


def tuples(epoch, n=2):
    return [f"{epoch + i},10.0.0.1,10.0.0.2,1,443,T,I,A" for i in range(n)]


class Collect:
    """Sink that keeps what it was given."""

    def __init__(self):
        self.batches = []

    def __call__(self, events, batch):
        rows = events.orderBy("file", "pos").select("file", "epoch", "extension_text").collect()
        self.batches.append([tuple(r) for r in rows])

    @property
    def epochs(self):
        return [r[1] for batch in self.batches for r in batch]


def test_listing_reads_names_and_sizes_only(spark, tmp_path):
    path = write_log(blob_path(tmp_path), [flow_record(tuples=[GOOD])], mtime=1_500_000_000)
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "note.txt").write_text("x")
    listing = fl.list_log_files(spark, str(tmp_path))
    assert "content" not in listing.columns
    row = listing.where("name LIKE 'resourceId=%'").first()
    assert row["name"].endswith("/y=2019/m=03/d=02/h=20/m=00/PT1H.json")
    assert row["length"] == os.path.getsize(path)
    assert row["last_modified"].timestamp() == 1_500_000_000
    parsed = fl.parse_listing(listing).collect()
    assert [r["nsg_name"] for r in parsed] == ["WEB-TIER"]
    assert parsed[0]["short_name"] == "WEB-TIER-2019-03-02-20"
    assert [r["kind"] for r in fl.rejected_paths(listing).collect()] == ["path"]


def test_listing_prefix(spark, tmp_path):
    write_log(blob_path(tmp_path), [flow_record()])
    write_log(blob_path(tmp_path, GATEWAY_ID), [access_record()])
    prefix = "resourceId=/SUBSCRIPTIONS/SUB-7/RESOURCEGROUPS/EDGE/PROVIDERS/MICROSOFT.NETWORK/NETW"
    assert fl.list_log_files(spark, str(tmp_path), prefix).count() == 1
    assert fl.list_log_files(spark, str(tmp_path), "nothing").count() == 0
    assert fl.list_log_files(spark, str(tmp_path / "missing")).count() == 0


def test_read_nsg_log_with_duplicate_partition_key(spark, tmp_path):
    write_log(blob_path(tmp_path), [flow_record(tuples=[GOOD]), flow_record(tuples=[GOOD, GOOD])])
    records = fl.read_log(spark, fl.NSG, str(tmp_path))
    assert [r["record_pos"] for r in records.orderBy("record_pos").collect()] == [0, 1]
    assert fl.flow_events(records).count() == 3


def test_odd_path_characters(spark, tmp_path):
    root = tmp_path / "a b+c%41[x]"
    write_log(blob_path(root), [flow_record(tuples=tuples(1551557200))])
    sink = Collect()
    run = fl.run_incremental(
        spark, str(tmp_path), "odd", sink, str(tmp_path / "state")
    )
    assert (run.files, run.events) == (1, 2)


def test_read_logs_routes_by_container(spark, tmp_path):
    write_log(blob_path(tmp_path, GATEWAY_ID), [access_record(), access_record()])
    records = fl.read_logs(spark, "insights-logs-applicationgatewayaccesslog", str(tmp_path))
    # Records that start with the resource id all survive a whole-file read.
    assert fl.access_events(records).count() == 2
    assert logs.family_of("insights-logs-applicationgatewayfirewalllog") == fl.FIREWALL
    assert logs.family_of("anything else") == fl.NSG


def test_broken_files_become_rejects(spark, tmp_path):
    hours = [f"y=2019/m=03/d=02/h={h:02d}/m=00" for h in range(5)]
    paths = [blob_path(tmp_path, hour=h) for h in hours]
    write_log(paths[0], [flow_record(tuples=[GOOD])])
    text = json.dumps({"records": [flow_record(tuples=[GOOD])]})
    open(paths[1], "w").write(text[: len(text) // 2])
    open(paths[2], "w").write('{"records": []}')
    open(paths[3], "w").write(json.dumps({"records": [{"category": "x"}]}))
    open(paths[4], "w").write(text + "\ntrailing")
    rows = logs.log_rows(logs.read_log_files(spark, str(tmp_path)))
    good, bad = fl.split_corrupt(rows)
    assert {r["file"][-18:-15] for r in good.collect()} == {"=00", "=04"}
    found = {r["file"][-17:-15]: (r["kind"], r["message"], r["raw"]) for r in bad.collect()}
    assert set(found) == {"01", "03"}
    assert found["01"][2] == text[: len(text) // 2]
    assert found["03"][1] == 'failed to find "time" in JSON payload'


def test_tail_read(spark, tmp_path):
    first = [flow_record(time=f"2019-03-02T20:0{i}:00Z", tuples=tuples(1551557200 + 60 * i)) for i in range(2)]
    path = write_log(blob_path(tmp_path), first)
    seen = os.path.getsize(path)
    write_log(path, first + [flow_record(time="2019-03-02T20:05:00Z", tuples=tuples(1551557500))])
    listed = fl.list_log_files(spark, str(tmp_path))

    def read(last_end):
        listing = listed.withColumn("last_end", F.lit(last_end).cast("bigint"))
        return logs.log_rows(fl.read_log_tail(spark, listing, str(tmp_path)))

    # The old closing bracket was overwritten, so the tail starts inside the new record.
    assert [r["time"].minute for r in logs.log_records(read(seen)).collect()] == [5]
    assert fl.flow_events(logs.log_records(read(None))).count() == 6
    assert read(os.path.getsize(path)).count() == 0
    blank = read(os.path.getsize(path) - 1).first()
    assert blank["error"] == 'failed to find "time" in JSON payload'
    # What is appended after the listing is left for the next range.
    listed = spark.createDataFrame(listed.collect(), listed.schema)
    write_log(path, first + [flow_record(time=f"2019-03-02T20:0{m}:00Z") for m in (5, 6)])
    assert logs.log_records(read(seen)).count() <= 1


def test_tail_read_loses_first_gateway_record(spark, tmp_path):
    write_log(blob_path(tmp_path, GATEWAY_ID), [access_record(), access_record()])
    listing = fl.list_log_files(spark, str(tmp_path)).withColumn("last_end", F.lit(None).cast("bigint"))
    records = logs.log_records(logs.log_rows(fl.read_log_tail(spark, listing, str(tmp_path))))
    assert records.count() == 2
    assert fl.access_events(records).count() == 1


def test_log_file_from_records(spark, tmp_path):
    write_log(blob_path(tmp_path), [flow_record(tuples=[GOOD]), flow_record(time="2019-03-03T00:00:00Z")])
    row = fl.log_file_from_records(fl.read_log(spark, fl.NSG, str(tmp_path)), fl.NSG).collect()
    assert len(row) == 1
    assert row[0]["name"].endswith("WEB-TIER/y=2019/m=03/d=02/h=20/m=00/PT1H.json")
    assert row[0]["nsg_name"] == "WEB-TIER"
    assert row[0]["log_time"].hour == 20
    later = fl.records_after(fl.read_log(spark, fl.NSG, str(tmp_path)), datetime(2019, 3, 2, 21))
    assert [r["log_time"].day for r in fl.log_file_from_records(later, fl.NSG).collect()] == [3]


def grow(tmp_path, n, mtime, hour="y=2019/m=03/d=02/h=20/m=00"):
    """The hour file after n minutes."""
    records = [
        flow_record(time=f"2019-03-02T20:{i:02d}:00Z", tuples=tuples(1551556800 + 60 * i)) for i in range(n)
    ]
    return write_log(blob_path(tmp_path / "in", hour=hour), records, mtime)


@pytest.mark.parametrize("resume", ["time", "position"])
def test_growth_in_steps_equals_one_run(spark, tmp_path, resume):
    steps, once = Collect(), Collect()
    for n, mtime in [(2, 1000), (3, 2000), (6, 3000)]:
        grow(tmp_path, n, mtime)
        fl.run_incremental(
            spark, str(tmp_path / "in"), "steps", steps, str(tmp_path / "s1"), resume=resume
        )
    fl.run_incremental(spark, str(tmp_path / "in"), "once", once, str(tmp_path / "s2"))
    assert len(steps.batches) == 3
    assert steps.epochs == once.epochs
    assert len(once.epochs) == 12


def test_second_run_emits_nothing_and_status_is_kept(spark, tmp_path):
    grow(tmp_path, 3, 1000)
    grow(tmp_path, 1, 1000, "y=2019/m=03/d=02/h=19/m=00")
    sink, state = Collect(), str(tmp_path / "state")
    first = fl.run_incremental(spark, str(tmp_path / "in"), "job", sink, state)
    second = fl.run_incremental(spark, str(tmp_path / "in"), "job", sink, state)
    assert (first.files, first.records, first.events) == (2, 4, 8)
    assert (second.files, second.batches, len(sink.batches)) == (0, 0, 1)
    status = {r["log_time"].hour: r for r in fl.StatusTable(spark, state, "job").read().collect()}
    assert status[20]["last_count"] == 3
    assert status[20]["last_processed_record"].minute == 2
    assert status[20]["last_processed_timestamp"] == 1551556800 + 121
    assert status[20]["last_processed_range"]["Start"] == 0
    assert status[20]["nsg_name"] == "WEB-TIER"
    view = fl.status_view(spark, state, ["job"]).collect()
    assert sorted(r["event_count"] for r in view) == [2, 6]
    summary = fl.job_summary(spark, first).first()
    assert (summary["name"], summary["status"], summary["files"]) == ("job", "COMPLETE", 2)


def test_batches_go_oldest_hour_first(spark, tmp_path):
    for h in (22, 20, 21):
        grow(tmp_path, 1, 1000, f"y=2019/m=03/d=02/h={h}/m=00")
    sink = Collect()
    run = fl.run_incremental(
        spark, str(tmp_path / "in"), "job", sink, str(tmp_path / "state"), files_per_batch=1
    )
    assert run.batches == 3
    assert [b[0][0][-17:-15] for b in sink.batches] == ["20", "21", "22"]


def test_batches_are_bounded_by_bytes(spark, tmp_path):
    for h in range(10, 20):
        grow(tmp_path, 2 if h == 14 else 1, 1000, f"y=2019/m=03/d=02/h={h}/m=00")
    root = str(tmp_path / "in")
    listing = fl.list_log_files(spark, root).select("path", "last_modified", "length")
    one = min(r["length"] for r in listing.collect())
    sink = Collect()
    run = fl.run_incremental(
        spark, root, "job", sink, str(tmp_path / "state"), listing=listing, bytes_per_batch=one * 4, split_bytes=one
    )
    hours = [sorted({int(r[0][-17:-15]) for r in batch}) for batch in sink.batches]
    assert hours == [[10, 11, 12, 13], [14, 15, 16, 17], [18, 19]] and run.files == 10 and run.events == 22
    assert [r["version"] for r in fl.StatusTable(spark, str(tmp_path / "state"), "job").commits().select("version").distinct().orderBy("version").collect()] == [0, 1, 2]


def test_a_batch_staged_ahead_is_finished_in_order(spark, tmp_path):
    for h in (20, 21, 22):
        grow(tmp_path, 1, 1000, f"y=2019/m=03/d=02/h={h}/m=00")
    root, state, sink = str(tmp_path / "in"), str(tmp_path / "state"), Collect()

    def crash(events, batch):
        if batch.version == 0:
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        fl.run_incremental(spark, root, "job", crash, state, files_per_batch=1)
    run = fl.run_incremental(spark, root, "job", sink, state, files_per_batch=1)
    assert run.batches == 3 and [b[0][0][-17:-15] for b in sink.batches] == ["20", "21", "22"]
    # Neither staged tables nor empty reject folders stay.
    assert not os.listdir(f"{state}/stage/job/rows") and not os.path.exists(f"{state}/rejects/job/of=batches/version=0")


def test_begin_time_is_strict_and_must_parse(spark, tmp_path):
    for h in (20, 21):
        grow(tmp_path, 1, 1000, f"y=2019/m=03/d=02/h={h}/m=00")
    grow(tmp_path, 1, 1000, "y=2019/m=13/d=02/h=22/m=00")
    root, state = str(tmp_path / "in"), str(tmp_path / "state")
    assert fl.run_incremental(spark, root, "a", Collect(), state, begin="2019-03-02-20").files == 1
    assert fl.run_incremental(spark, root, "b", Collect(), state).files == 2
    assert [r["kind"] for r in spark.read.parquet(f"{state}/rejects/b").collect()] == ["hour"]
    with pytest.raises(ValueError):
        fl.run_incremental(spark, root, "c", Collect(), state, begin="yesterday")


def test_broken_and_empty_files_in_a_run(spark, tmp_path):
    grow(tmp_path, 1, 1000)
    empty = write_log(blob_path(tmp_path / "in", hour="y=2019/m=03/d=02/h=18/m=00"), [])
    broken = blob_path(tmp_path / "in", hour="y=2019/m=03/d=02/h=19/m=00")
    open(broken, "w").write('{"records": [{')
    sink, state = Collect(), str(tmp_path / "state")
    run = fl.run_incremental(spark, str(tmp_path / "in"), "job", sink, state)
    assert (run.files, run.events) == (2, 2)
    counts = {r["log_time"].hour: r["last_count"] for r in fl.StatusTable(spark, state, "job").read().collect()}
    assert counts == {18: 0, 20: 1}
    rejects = spark.read.parquet(f"{state}/rejects/job").collect()
    assert [r["kind"] for r in rejects] == ["file"]
    # A broken file is tried again on the next run, and found once it is whole.
    write_log(broken, [flow_record(tuples=tuples(1551553400))])
    assert fl.run_incremental(spark, str(tmp_path / "in"), "job", sink, state).events == 2
    assert os.path.exists(empty)


def test_interrupted_batch_is_finished_from_staged_rows(spark, tmp_path):
    grow(tmp_path, 2, 1000)
    root, state, out = str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "out")
    write = fl.file_sink(out)

    def crash(events, batch):
        write(events, batch)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        fl.run_incremental(spark, root, "job", crash, state)
    # The file grows before the restart; the interrupted batch must not pick that up half way.
    grow(tmp_path, 3, 2000)
    run = fl.run_incremental(spark, root, "job", write, state)
    assert (run.batches, run.events) == (2, 6)
    events = fl.read_cef_json(spark, out)
    assert events.count() == events.select("time").distinct().count() == 6


def test_event_files(spark, tmp_path):
    grow(tmp_path, 2, 1000)
    out = tmp_path / "out"
    fl.run_incremental(
        spark, str(tmp_path / "in"), "file", fl.file_sink(str(out), mode="array"), str(tmp_path / "state")
    )
    (source,) = [d for d in os.listdir(out) if d.startswith("source")]
    names = os.listdir(out / source)
    assert names == ["output_name=nsgLog-WEB-TIER-201903022000-1551556800-1551556861.json"]
    parts = [f for f in os.listdir(out / source / names[0]) if f.startswith("part")]
    assert len(parts) == 1
    events = json.loads((out / source / names[0] / parts[0]).read_text())
    assert [e["extension"]["start"] for e in events] == [
        "1551556800000", "1551556801000", "1551556860000", "1551556861000"
    ]
    assert list(events[0]["extension"]) == sorted(events[0]["extension"])
    assert events[0]["time"] == "2019-03-02T20:00:00Z"
    assert events[0]["device_product"] == "Azure NSG"
    back = fl.read_cef_json(spark, str(out))
    assert back.count() == 4
    direct = fl.flow_events(fl.read_log(spark, fl.NSG, str(tmp_path / "in")))
    from flowlog.operators.events import cef_column

    assert {r[0] for r in back.select(cef_column(back)).collect()} == {
        r[0] for r in direct.select(cef_column(direct)).collect()
    }
    fl.write_event_files(direct, str(tmp_path / "compat"), compat=True)
    line = spark.read.text(str(tmp_path / "compat")).first()[0]
    assert "device_product" not in json.loads(line) and "device_version" not in json.loads(line)


def event_parts(out):
    """Texts of the part files of each event file."""
    found = {}
    for folder, _, files in os.walk(out):
        texts = [open(os.path.join(folder, f)).read() for f in sorted(files) if f.startswith("part")]
        if texts and "output_name=" in folder:
            found[os.path.relpath(folder, out)] = texts
    return found


@pytest.mark.parametrize("per_document", [None, 100])
def test_event_arrays_of_any_length_are_documents(spark, tmp_path, per_document):
    epoch = 1551556800
    twin = NSG_ID.replace("EDGE", "CORE")
    for resource, n in ((NSG_ID, 520), (twin, 520), (NSG_ID.replace("WEB", "APP"), 70)):
        records = [flow_record(time=f"2019-03-02T20:{i // 60:02d}:{i % 60:02d}Z", tuples=tuples(epoch + 2 * i)) for i in range(n)]
        write_log(blob_path(tmp_path / "in", resource), records)
    out = tmp_path / "out"
    sink = fl.file_sink(str(out), mode="array", records_per_document=per_document)
    run = fl.run_incremental(spark, str(tmp_path / "in"), "file", sink, str(tmp_path / "state"))
    assert run.events == 2 * (520 + 520 + 70)
    found = event_parts(out)
    assert len(found) == (3 if per_document is None else 13)
    events = []
    for texts in found.values():
        assert len(texts) == 1
        own = json.loads(texts[0])
        starts = [int(e["extension"]["start"]) for e in own]
        assert starts == sorted(starts)
        events += own
    assert len(events) == run.events == fl.read_cef_json(spark, str(out)).count()


def test_event_reader_takes_all_arrays_or_fails(spark, tmp_path):
    one = json.dumps({"cef_version": 0, "name": "a,]b", "severity": 1, "extension": {"k": "[v],"}})
    (tmp_path / "a.json").write_text(f"[{one},{one}]\n[{one}\n,{one}\n]\n\n{one}\n")
    rows = fl.read_cef_json(spark, str(tmp_path / "a.json")).collect()
    assert len(rows) == 5 and {(r["name"], r["extension"]["k"]) for r in rows} == {("a,]b", "[v],")}
    (tmp_path / "b.json").write_text(json.dumps([json.loads(one)], indent=1))
    with pytest.raises(Exception):
        fl.read_cef_json(spark, str(tmp_path / "b.json")).collect()


def test_compat_json_escapes_markup(spark):
    from conftest import to_records

    from flowlog.operators.events import event_json

    events = fl.access_events(to_records(spark, [access_record(requestUri="/a<b>&c")]))
    plain, compat = events.select(event_json(events), event_json(events, compat=True)).first()
    assert "/a<b>&c" in plain
    assert "/a\\u003cb\\u003e\\u0026c" in compat and json.loads(compat)["extension"] == json.loads(plain)["extension"]


def test_syslog_sinks(spark, tmp_path):
    grow(tmp_path, 2, 1000)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    fl.run_incremental(spark, str(tmp_path / "in"), "syslog", fl.syslog_sink("myhost", out), state)
    lines = [r[0] for r in spark.read.text(f"{out}/0").collect()]
    assert len(lines) == 4
    assert lines[0].startswith("Mar 02 20:00:00 myhost CEF:0|Microsoft|Azure NSG|1|NetworkSecurityGroupFlow")
    sent = str(tmp_path / "sent")
    os.makedirs(sent)

    def sender(rows):
        import uuid

        with open(f"{sent}/{uuid.uuid4()}", "w") as target:
            target.writelines(line + "\n" for line in rows)

    fl.run_incremental(spark, str(tmp_path / "in"), "sender", fl.syslog_sink("myhost", sender), state)
    text = [line for f in os.listdir(sent) for line in open(f"{sent}/{f}").read().splitlines()]
    assert sorted(text) == sorted(lines)
    whole = fl.syslog_sink("myhost", sender, whole_files=True)
    before = set(os.listdir(sent))
    fl.run_incremental(spark, str(tmp_path / "in"), "whole", whole, state)
    in_order = [open(f"{sent}/{f}").read().splitlines() for f in set(os.listdir(sent)) - before]
    assert lines in in_order and sum(map(len, in_order)) == 4


def test_status_documents(spark, tmp_path):
    grow(tmp_path, 2, 1000)
    grow(tmp_path, 1, 1000, "y=2019/m=03/d=02/h=19/m=00")
    state = str(tmp_path / "state")
    fl.run_incremental(spark, str(tmp_path / "in"), "file", Collect(), state)
    status = fl.StatusTable(spark, state, "file").read()
    folder = fl.write_status(status, str(tmp_path / "json"), "file")
    document = {}
    for row in spark.read.text(folder).collect():
        document |= json.loads(row[0])
    name = next(n for n in document if "h=20" in n)
    assert document[name]["last_count"] == 2 and document[name]["last_processed_range"]["Start"] == 0
    back = fl.read_status(spark, folder)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, status.select(back.columns).collect()), key=str)
    (tmp_path / "one.json").write_text(json.dumps(document, indent=2))
    assert fl.read_status(spark, str(tmp_path / "one.json"), whole=True).count() == 2
    assert fl.read_status(spark, str(tmp_path / "absent")).count() == 0
    (tmp_path / "broken.json").write_text('{"a": {"name":')
    with pytest.raises(Exception):
        fl.read_status(spark, str(tmp_path / "broken.json")).collect()


def test_polling(spark, tmp_path):
    grow(tmp_path, 1, 1000)
    sink = Collect()
    runs = fl.run_polling(
        spark, str(tmp_path / "in"), "poll", sink, str(tmp_path / "state"), poll_interval=0, rounds=2
    )
    assert next(runs).events == 2
    grow(tmp_path, 2, 2000)
    assert next(runs).events == 2


def test_stream_follows_growing_files(spark, tmp_path):
    root, state, check = (str(tmp_path / d) for d in ("in", "state", "check"))
    sink = Collect()

    def once():
        query = fl.start_stream(spark, root, "stream", sink, state, check, poll_interval=None)
        query.awaitTermination(120)
        assert query.exception() is None

    grow(tmp_path, 2, None)
    once()
    assert len(sink.epochs) == 4
    once()
    assert len(sink.epochs) == 4
    grow(tmp_path, 4, None)
    grow(tmp_path, 1, None, "y=2019/m=03/d=02/h=21/m=00")
    once()
    reference = Collect()
    fl.run_incremental(spark, root, "batch", reference, str(tmp_path / "other"))
    assert sorted(sink.epochs) == sorted(reference.epochs)


def test_stream_takes_a_file_that_shows_up_with_an_old_time(spark, tmp_path):
    root, state, check = (str(tmp_path / d) for d in ("in", "state", "check"))
    sink = Collect()
    grow(tmp_path, 2, None)
    for n in (4, 6, 6):
        fl.start_stream(spark, root, "stream", sink, state, check, poll_interval=None).awaitTermination(120)
        assert len(sink.epochs) == n
        grow(tmp_path, 1, 1000, "y=2019/m=03/d=02/h=21/m=00")


def crash_at(monkeypatch, folder):
    """The next write below a folder fails; what was written before it stays."""
    from pyspark.sql import DataFrameWriter

    from flowlog.plans import status

    def lost(*_):
        raise RuntimeError("lost")

    if folder == "/commits/":
        monkeypatch.setattr(status, "touch", lost)
        return

    write = DataFrameWriter.parquet

    def failing(self, path, *args, **kwargs):
        if folder in path:
            os.makedirs(path, exist_ok=True)
            raise RuntimeError("lost")
        return write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", failing)


@pytest.mark.parametrize(
    "folder", ["/stage/job/rows", "/stage/job/events", "/stage/job/progress", "/stage/job/started", "/rejects/", "/status/", "/commits/"]
)
def test_a_run_goes_on_after_a_crash_at_any_write(spark, tmp_path, monkeypatch, folder):
    root, state, out = str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "out")
    sink = fl.file_sink(out)
    grow(tmp_path, 2, 1000)
    with monkeypatch.context() as patch:
        crash_at(patch, folder)
        with pytest.raises(RuntimeError):
            fl.run_incremental(spark, root, "job", sink, state)
    grow(tmp_path, 3, 2000)
    fl.run_incremental(spark, root, "job", sink, state)
    events = fl.read_cef_json(spark, out)
    starts = sorted(int(r[0]) for r in events.select(F.col("extension")["start"]).collect())
    assert len(starts) == len(set(starts)) == 6
    status = fl.StatusTable(spark, state, "job")
    assert [r["last_count"] for r in status.read().collect()] == [3]
    # A batch that was staged is finished as it was; one that was not is staged anew, with the third minute.
    staged = folder in ("/rejects/", "/status/", "/commits/")
    assert status.next_version() == (2 if staged else 1)


def test_batches_of_broken_files_keep_their_rejects(spark, tmp_path):
    root, state = str(tmp_path / "in"), str(tmp_path / "state")
    for h in (18, 19):
        open(blob_path(tmp_path / "in", hour=f"y=2019/m=03/d=02/h={h}/m=00"), "w").write("{")
    (tmp_path / "in" / "note.txt").write_text("x")
    run = fl.run_incremental(spark, root, "job", Collect(), state, files_per_batch=1)
    assert run.batches == 2
    rejects = spark.read.parquet(f"{state}/rejects/job").collect()
    assert sorted(r["kind"] for r in rejects) == ["file", "file", "path"]
    assert len({r["version"] for r in rejects}) == 3
    fl.run_incremental(spark, root, "job", Collect(), state)
    kinds = [r["kind"] for r in spark.read.parquet(f"{state}/rejects/job").collect()]
    assert kinds.count("path") == 1


def test_jobs_with_like_states_do_not_share_a_stage(spark, tmp_path):
    grow(tmp_path, 1, 1000)

    def crash(events, batch):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        fl.run_incremental(spark, str(tmp_path / "in"), "t", crash, str(tmp_path / "g-s"))
    (tmp_path / "empty").mkdir()
    sink = Collect()
    for state in (tmp_path / "g" / "s", tmp_path / "g-s-t"):
        run = fl.run_incremental(spark, str(tmp_path / "empty"), "t", sink, str(state))
        assert (run.files, sink.batches) == (0, [])


def test_progress_never_goes_back(spark, tmp_path):
    sink, state = Collect(), str(tmp_path / "state")
    timed = [flow_record(time=f"2019-03-02T20:0{i}:00Z", tuples=tuples(1551556800 + 60 * i, 1)) for i in range(4)]
    timeless = flow_record(time=None, tuples=tuples(1551560000, 1))
    path = blob_path(tmp_path / "in")
    for n, records in enumerate([timed[:3] + [timeless], timed[:3] + [timeless, timed[3], timeless]], 1):
        write_log(path, records, 1000 * n)
        fl.run_incremental(spark, str(tmp_path / "in"), "job", sink, state)
    assert [len(b) for b in sink.batches] == [3, 1]
    write_log(path, timed[:3] + [timeless] * 2, 5000)
    fl.run_incremental(spark, str(tmp_path / "in"), "job", sink, state)
    assert len(sink.epochs) == 4


def test_containers_below_one_root_stay_apart(spark, tmp_path):
    for name in ("one", "two"):
        records = [flow_record(tuples=tuples(1551556800, 1)), flow_record(tuples=tuples(1551556900, 1))]
        write_log(blob_path(tmp_path / "in" / name), records)
    run = fl.run_incremental(spark, f"file://{tmp_path}/in", "job", Collect(), str(tmp_path / "state"))
    assert (run.files, run.records, run.events) == (2, 4, 4)
    names = {r["name"].split("/")[0] for r in fl.StatusTable(spark, str(tmp_path / "state"), "job").read().collect()}
    assert names == {"one", "two"}


def test_status_is_compacted(spark, tmp_path):
    state = str(tmp_path / "state")
    table = fl.StatusTable(spark, state, "job", compact_every=3)
    rows = lambda i: spark.createDataFrame([(f"n{i % 4}", None, None, None, None, None, i, None, None, None, 1)], f"{STATUS_DDL}, event_count bigint")
    for i in range(10):
        version = table.next_version()
        assert version == i
        table.commit(version, rows(i) if i != 4 else None)
        folders = [d for d in os.listdir(tmp_path / "state" / "commits" / "job") if d.startswith("version")]
        assert len(folders) < 3
    assert {r["name"]: r["last_count"] for r in table.read().collect()} == {"n0": 8, "n1": 9, "n2": 6, "n3": 7}
    view = {r["name"]: r["event_count"] for r in fl.status_view(spark, state, ["job"]).collect()}
    assert view == {"n0": 2, "n1": 3, "n2": 2, "n3": 2}
    # A commit without its marker does not count, nor does an empty folder for one.
    rows(99).select("*").write.parquet(f"{table.path}/version=10")
    os.makedirs(f"{table.markers}/version=10")
    assert table.next_version() == 10
    assert table.read().where("last_count = 99").count() == 0


def test_idle_run_lists_open_hours_only(spark, tmp_path, monkeypatch):
    now = datetime.now(timezone.utc)
    for days in (40, 3, 1, 0):
        when = now - timedelta(days=days)
        hour = f"y={when:%Y}/m={when:%m}/d={when:%d}/h=05/m=00"
        write_log(blob_path(tmp_path / "in", hour=hour), [flow_record(tuples=tuples(1551556800, 1))])
    listed = []
    from flowlog.plans import incremental

    listing = incremental.list_log_files

    def counted(*args):
        found = listing(*args)
        listed.append(found.count())
        return found

    monkeypatch.setattr(incremental, "list_log_files", counted)
    options = {"folders": fl.RESOURCE_FOLDERS}
    root, state = str(tmp_path / "in"), str(tmp_path / "state")
    begin = now - timedelta(days=10)
    assert fl.run_incremental(spark, root, "job", Collect(), state, begin=begin, **options).files == 3
    assert fl.run_incremental(spark, root, "job", Collect(), state, begin=begin, open_hours=26, **options).files == 0
    assert listed[0] == 3 and listed[1] == 2
    assert fl.run_incremental(spark, root, "job", Collect(), state, **options).files == 1
    assert listed[2] == 4


def test_days_of_a_listing():
    at = lambda *d: datetime(*d, tzinfo=timezone.utc)
    assert logs._days(at(2019, 3, 2, 23), at(2019, 3, 3)) == ["y=2019/m=03/d=02", "y=2019/m=03/d=03", "y=2019/m=03/d=04"]
    days = logs._days(at(2017, 11, 29), at(2020, 2, 29, 5))
    assert days == [
        "y=2017/m=11/d=29", "y=2017/m=11/d=30", "y=2017/m=12", "y=2018", "y=2019", "y=2020/m=01", "y=2020/m=02",
        "y=2020/m=03/d=01",
    ]


def test_rejects_and_progress_plans(spark, tmp_path):
    write_log(blob_path(tmp_path), [flow_record(tuples=["1,2", GOOD]), flow_record(mac=None, tuples=[GOOD])])
    path = str(tmp_path / "records")
    fl.read_log(spark, fl.NSG, str(tmp_path)).write.parquet(path)
    records = spark.read.parquet(path)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    bad = fl.rejects(records, fl.NSG)
    assert plan(bad).count("FileScan") == 1
    assert sorted(r["kind"] for r in bad.collect()) == ["record", "token_count"]
    progress = fl.file_progress(records, fl.flow_events(records))
    assert "Join" not in plan(progress)


def test_a_hot_file_is_written_by_several_tasks_in_order(spark, tmp_path):
    records = [
        flow_record(time=f"2019-03-02T20:{i:02d}:00Z", tuples=tuples(1551556800 + 60 * i, 20)) for i in range(40)
    ]
    write_log(blob_path(tmp_path / "in"), records)
    events = fl.flow_events(fl.read_log(spark, fl.NSG, str(tmp_path / "in")))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        fl.write_event_files(events, str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    (parts,) = event_parts(tmp_path / "out").values()
    assert len(parts) > 1
    lines = [line for text in parts for line in text.splitlines()]
    starts = [int(json.loads(line)["extension"]["start"]) for line in lines]
    assert starts == sorted(starts) and len(starts) == 800
