"""Streams against batches: state that lasts over a restart, late rows, arriving catalogues."""

import datetime
import time

from pyspark.sql import functions as F

from foliary import schema as S
from foliary.operators import selection as Q
from foliary.operators.keyed import KeyedTable
from foliary.streaming import incremental

CATALOG = "transferyear string, rc_rfile_no string, rc_ritem_no string, mngno string, detno int, kikwancode string, prodyear string, org_file_path string, save_file_name string"


def drained(stream, folder, mark):
    query = stream.writeStream.format("parquet").option("path", folder).option("checkpointLocation", mark).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()


def test_each_key_once_over_a_restart(spark, tmp_path):
    schema, source = "k string, v int", str(tmp_path / "in")
    batches = [[("a", 2), ("a", 1), ("b", 1)], [("a", 0), ("c", 5)], [("b", 9), ("c", 1), ("d", None), (None, 3), (None, 4)]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        drained(incremental.once_each(incremental.arriving(spark, source, schema), "k"), str(tmp_path / "out"), str(tmp_path / "mark"))  # a new query each time
    found = {(r.k, r.v) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert found == {("a", 1), ("b", 1), ("c", 5), ("d", None), (None, 3)}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_keys_are_forgotten_after_their_time(spark, tmp_path):
    schema, source, out = "k string, v int", str(tmp_path / "in"), str(tmp_path / "out")

    def arrives(v):
        spark.createDataFrame([("a", v)], schema).coalesce(1).write.mode("append").parquet(source)

    arrives(1)
    stream = incremental.once_each(incremental.arriving(spark, source, schema), "k", ttl_seconds=20)
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "mark")).outputMode("append").trigger(processingTime="1 second").start()
    try:
        deadline = time.time() + 100
        while time.time() < deadline and not (tmp_path / "out" / "_spark_metadata").exists():
            time.sleep(0.5)
        arrives(2)  # known still
        time.sleep(30)
        arrives(3)
        while time.time() < deadline and spark.read.schema(schema).parquet(out).count() < 2:
            time.sleep(1)
    finally:
        query.stop()
    assert {r.v for r in spark.read.parquet(out).collect()} == {1, 3}


def test_late_rows_count_until_the_watermark(spark, tmp_path):
    schema, source, at = "at timestamp, status string", str(tmp_path / "in"), lambda m: datetime.datetime(2024, 1, 1, 12, m)
    batches = [[(at(1), "PASS"), (at(2), "PASS"), (at(30), "FAIL")], [(at(3), "PASS"), (at(24), "PASS")], [(at(59), "PASS")], [(at(59), "FAIL")]]
    for rows in batches:  # the second comes when the watermark stands at 12:20
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        drained(incremental.progress_by_window(incremental.arriving(spark, source, schema)), str(tmp_path / "out"), str(tmp_path / "mark"))
    found = {(r.window.start.minute, r.status, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert (0, "PASS", 2) in found and (20, "PASS", 1) in found and (30, "FAIL", 1) in found and not any(n == 3 for _, _, n in found)


def test_arriving_catalogues_are_extracted_once(spark, tmp_path):
    rows = []
    for i in range(8):
        folder = tmp_path / "store" / "2023" / f"F{i // 4}" / f"R{i}"
        folder.mkdir(parents=True)
        if i != 5:
            (folder / f"{i}.txt").write_text(f"text {i}")
        rows.append(("2023", f"F{i // 4}", f"R{i}", "M", 1, "K", "2020", None, f"{i}.txt"))
    base, source, empty = f"file://{tmp_path}/store", str(tmp_path / "in"), spark.createDataFrame([], S.EXTRACTS)
    table = KeyedTable(spark, str(tmp_path / "extracts"), S.EXTRACTS, "rc_rfile_no", 4)
    whole = KeyedTable(spark, str(tmp_path / "whole"), S.EXTRACTS, "rc_rfile_no", 4)
    for t in (table, whole):
        t.create(empty)
    for part in (rows[:3], rows[2:6], rows[6:] + rows[:1]):  # some arrive twice; a new query for each, as after a restart
        spark.createDataFrame(part, CATALOG).coalesce(1).write.mode("append").parquet(source)
        incremental.extract_stream(incremental.arriving(spark, source, CATALOG), table, base, str(tmp_path / "mark"), Q.Params()).awaitTermination()
    from foliary.operators import merge
    from foliary.plans import workflow

    _, made = workflow.extract_run(spark.createDataFrame(rows, CATALOG), empty, base, Q.Params())
    whole.merge(made, merge.upsert_extracts)
    assert sorted(table.read().collect(), key=str) == sorted(whole.read().collect(), key=str)
    assert {(r.rc_ritem_no, r.extract_status) for r in table.read().collect()} == {(f"R{i}", S.FAIL if i == 5 else S.PASS) for i in range(8)}
    assert table.read().where(F.col("contents") == "text 3").count() == 1
