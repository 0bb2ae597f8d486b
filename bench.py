"""Benchmark: prints one JSON line with the seconds of each headline query.

The log records the queries read are derived from the tables once, before the clock starts, and
kept as Parquet, as a landed log table would be; every timed query then runs over all of them and
writes its whole result to the no-op sink. File queries read and write real files.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

import flowlog as fl
from flowlog.functions import paths as P
from flowlog.operators import events as E
from flowlog.plans.status import latest_status
from flowlog.queries import derive as D

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))


def session(folder: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("flowlog-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def landed(spark, folder, name, records):
    path = f"{folder}/{name}"
    records.repartition(int(CPUS) * 2).write.parquet(path)
    return spark.read.parquet(path)


def main() -> None:
    folder = tempfile.mkdtemp(prefix="run-")
    spark = session(folder)
    flows = landed(spark, folder, "flows", D.flow_records(spark, SF_DIR))
    dense = landed(spark, folder, "dense", D.dense_flow_records(spark, SF_DIR))
    access = landed(spark, folder, "access", D.access_records(spark, SF_DIR))
    firewall = landed(spark, folder, "firewall", D.firewall_records(spark, SF_DIR))
    events = fl.flow_events(flows)
    tuples = events.count() + fl.flow_tuple_errors(flows).where("kind = 'token_count'").count()
    dense_events = fl.flow_events(dense)
    dense_tuples = dense_events.count()
    root = f"{folder}/container"
    D.write_documents(D.log_documents(spark, SF_DIR), root)
    files = fl.list_log_files(spark, root).count()

    counter = iter(range(10**6))

    def first_run():
        job = f"bench{next(counter)}"
        fl.run_incremental(spark, root, job, lambda e, b: run(e), f"{folder}/state")

    def idle_run():
        fl.run_incremental(spark, root, "bench0", lambda e, b: run(e), f"{folder}/state")

    ext = F.col("extension")
    timed = {
        "flow_event_report": lambda: run(
            events.groupBy("severity", ext["proto"], ext["deviceDirection"]).agg(
                F.count("*"), F.sum("epoch"), F.count_distinct(ext["src"])
            )
        ),
        "flow_events": lambda: run(events.select("file", "pos", "time", "severity", "extension_text")),
        "flow_event_maps": lambda: run(events.select("file", "pos", "time", "severity", "extension")),
        "cef_lines": lambda: run(events.select(E.cef_column(events))),
        "syslog_lines": lambda: run(fl.syslog_lines(events, "host")),
        "dense_flow_events": lambda: run(
            dense_events.select("file", "pos", "time", "severity", "extension_text")
        ),
        "dense_cef_lines": lambda: run(dense_events.select(E.cef_column(dense_events))),
        "rejects": lambda: run(fl.rejects(flows, P.NSG)),
        "file_progress": lambda: run(fl.file_progress(flows, events)),
        "access_events": lambda: run(fl.access_events(access).select("file", "pos", "time", "extension_text")),
        "firewall_events": lambda: run(
            fl.firewall_events(firewall).select("file", "pos", "time", "extension_text")
        ),
        "path_selection": lambda: run(
            fl.unprocessed_files(
                fl.begin_time_filter(fl.parse_listing(D.listing(spark, SF_DIR)), "1995-01-01-00"),
                D.status(spark, SF_DIR),
            )
        ),
        "status_latest": lambda: run(latest_status(D.status(spark, SF_DIR).withColumn("version", F.lit(1)))),
        "read_log_files": lambda: run(fl.flow_events(fl.read_log(spark, fl.NSG, root)).select("epoch")),
        "incremental_first_run": first_run,
        "incremental_idle_run": idle_run,
    }
    seconds = {}
    for name, query in timed.items():
        query()
        taken = []
        for _ in range(REPEATS):
            start = time.perf_counter()
            query()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
                "flow_tuples": tuples,
                "flow_tuples_per_sec": round(tuples / seconds["flow_events"]),
                "cef_lines_per_sec": round(tuples / seconds["cef_lines"]),
                "dense_tuples_per_sec": round(dense_tuples / seconds["dense_flow_events"]),
                "dense_cef_lines_per_sec": round(dense_tuples / seconds["dense_cef_lines"]),
                "files": files,
                "files_per_sec": round(files / seconds["read_log_files"]),
            }
        )
    )


if __name__ == "__main__":
    main()
