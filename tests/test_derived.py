"""How the logs derived from the tables are made, as the queries over them grow with it."""

import contextlib
import io
import re
from datetime import date

from pyspark.sql import functions as F

from flowlog.queries import derive as D
from flowlog.queries import registered


def lineitems(spark, folder):
    rows = [
        (o, 7 * o + 3, o % 40, 1 + o % 7, "ANR"[o % 3], "OF"[o % 2], date(1997, 3, 1 + o % 28))
        for o in [*range(1, 200), 5 + 211, 3 + 307, 7 + 401, 97 * 3, 101 * 4, 103 * 5]
    ]
    rows += [(None, 1, 2, 3, "A", "O", date(1997, 1, 1)), (8, None, 2, 3, "A", None, date(1997, 1, 1)), (9, 1, None, None, None, "F", None)]
    ddl = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_linestatus string, l_shipdate date"
    spark.createDataFrame(rows, ddl).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_flow_records_make_their_texts_in_compiled_code(spark, tmp_path):
    records = D.flow_records(spark, lineitems(spark, tmp_path))
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        records.explain("codegen")
        records.explain("extended")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000  # the JVM compiles no longer method
    plan = text.getvalue().split("== Physical Plan ==")[-1]
    nested = [line for line in plan.splitlines() if "to_variant_object" in line]
    assert nested and not any("concat_ws" in line for line in nested)  # there it would be interpreted


def test_flow_records_keep_odd_rows_and_nulls(spark, tmp_path):
    records = D.flow_records(spark, lineitems(spark, tmp_path))
    found = {
        r["record_pos"]: r["p"] for r in records.select("record_pos", F.to_json("properties").alias("p")).collect()
    }
    assert found[(408 * 8 + 3) * 1000 + (7 * 408 + 3) % 1000].count("12345") == 1
    assert '"rule":5' in found[(216 * 8 + 1 + 216 % 7) * 1000 + (7 * 216 + 3) % 1000]
    assert found[(310 * 8 + 1 + 310 % 7) * 1000 + (7 * 310 + 3) % 1000] == '{"Version":1}'
    # Nulls leave their token out.
    without_part = spark.read.parquet(f"{tmp_path}/lineitem.parquet").where("l_partkey IS NULL")
    assert without_part.count() == 1
    nulls = [r["p"] for r in records.where("record_pos IS NULL").select(F.to_json("properties").alias("p")).collect()]
    assert len(nulls) == 3 and any('"172.16.2.9,' in p or ",172.16.2.9," in p for p in nulls)


def test_listed_documents_are_there_a_lot_at_a_time(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(k,) for k in [*range(1, 11), 4]], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    monkeypatch.setattr(registered, "LISTED_SUPPLIERS", 3)
    monkeypatch.setattr(registered.D, "scratch", lambda spark, name: f"{tmp_path}/{name}")
    seen, walk = [], registered.logs.list_log_files

    def listing(spark, root, *args, **options):
        found = walk(spark, root, *args, **options)
        seen.append({r["name"].split("/y=")[0] for r in found.collect()})
        return found

    monkeypatch.setattr(registered.logs, "list_log_files", listing)
    names = [r["name"] for r in registered.QUERIES["list_log_files_since"](spark, str(tmp_path)).collect()]
    assert len(names) == len(set(names)) == 10 * 26  # 26 of the 48 hours lie on the 15th and 16th
    assert not list(tmp_path.rglob("PT1H.json"))
    assert len(seen) == 4 and sum(map(len, seen)) == 10 and max(map(len, seen)) < 10


def texts(root):
    return {str(p.relative_to(root)): p.read_text() for p in root.rglob("*") if p.is_file()}


def test_documents_written_into_spare_folders_are_those_alone(spark, tmp_path):
    root, spare = tmp_path / "in", str(tmp_path / "spare")

    def documents(keys, hours, text):
        names = [(f"resourceId=/S/N-{k}/y=2017/m=07/d=14/h={h:02d}/m=00/PT1H.json", text * k) for k in keys for h in range(hours)]
        return spark.createDataFrame(names, "name string, text string").coalesce(1)

    first, second = documents(range(1, 7), 3, "long text"), documents([3, 8, 9], 2, "é")
    D.write_documents(first, str(root), spare)
    assert len(texts(root)) == 18
    inodes = {p.stat().st_ino for p in root.rglob("PT1H.json")}
    D.remove_documents(first, str(root), spare)
    assert not texts(root)
    D.write_documents(second, str(root), spare)
    assert texts(root) == {r["name"]: r["text"] for r in second.collect()}  # no hour and no end of a text from before
    assert {p.stat().st_ino for p in root.rglob("PT1H.json")} < inodes  # written into the folders that were there
    D.write_documents(documents([3], 1, "new"), str(root), spare)
    assert len(texts(root)) == 6  # a resource that is there keeps its other documents
    D.remove_documents(second, str(root), spare)
    D.remove_spare(spark, spare)
    assert not [p for p in tmp_path.rglob("*") if p.is_file()]


def test_documents_of_a_resource_without_key_leave_the_others(spark, tmp_path):
    root, spare = tmp_path / "in", str(tmp_path / "spare")

    def documents(*keys):
        names = [(f"resourceId={k}/y=2017/m=07/d=14/h=00/m=00/PT1H.json", f"text of {k}") for k in keys]
        return spark.createDataFrame(names, "name string, text string").coalesce(1)

    for lot in (documents("/S/N-1", "", "/S/N-2"), documents("/S/N-3", "/S/N-4", "/S/N-5"), documents("", "/S/N-6")):
        D.write_documents(lot, str(root), spare)
        assert texts(root) == {r["name"]: r["text"] for r in lot.collect()}
        D.remove_documents(lot, str(root), spare)
        assert not texts(root)
