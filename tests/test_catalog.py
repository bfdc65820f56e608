"""Every registered query that SQL can express, on the smallest tables; and the streaming wrapper."""

import glob
import os

import duckdb
import pytest

from foliary.plans import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def canonical(rows):
    return sorted((tuple("" if v is None else repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r) for r in rows))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, duck, name):
    found = catalog.QUERIES[name](spark, SF)
    names = sorted(found.columns)
    want = duck.execute(f"SELECT {', '.join(names)} FROM ({catalog.ORACLES[name]})").fetchall()
    assert canonical(tuple(r) for r in found.select(*names).collect()) == canonical(want)


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_gives_rows(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0 and set(catalog.QUERIES) <= set(__spark_entry__.queries())


def test_stream_chunks_what_arrives(spark, tmp_path):
    from foliary.streaming import incremental

    rows = [(i, "a.txt", None, "문장이 이어진다. " * 40 if i else "표지") for i in range(3)]
    schema = "extract_idx long, file_name string, zip_entry_file_name string, indexing_contents string"
    source = str(tmp_path / "in")
    spark.createDataFrame(rows, schema).write.parquet(source)
    for _ in range(2):  # the second run finds nothing new
        incremental.chunk_stream(incremental.arriving(spark, source, schema), str(tmp_path / "out"), str(tmp_path / "mark"), size=3500, overlap=350).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.extract_idx, r.chunk_status) for r in found.collect()) == [(0, "SKIP"), (1, "READY"), (2, "READY")]
