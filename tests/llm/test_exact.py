"""Exact de-duplication against grouping by the text, in one run and over several."""

import hashlib

from pyspark.sql import functions as F

from checks.compare import database, differences
from sootledger.llm import exact

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, row int, at string, digest string"


def brute(rows):
    """(doc_id, keep_id, group_size, kept, sha) of rows (doc_id, text) without repeated ids, NULL last."""
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        out += [(i, keep, len(ids), i == keep, sha) for i in ids]
    return sorted(out, key=str)


def table(spark, path, rows, files=1, mode="overwrite"):
    df = spark.createDataFrame([(i, t, 1, "x", "y") for i, t in rows], SCHEMA)
    df.repartition(files).write.mode(mode).parquet(path)
    return path


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


ODD = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "A"), (6, "a "), (7, "long " * 50_000), (8, "long " * 50_000), (None, "only"), (9, "é"), (10, "é")]


def test_equals_sql(spark):
    assert differences(exact.op12_exact(spark, SF), database(SF), exact.OP12_SQL) == []


def test_odd_rows(spark, tmp_path):
    source = table(spark, f"{tmp_path}/docs", ODD, files=3)
    exact.ingest(spark, source, f"{tmp_path}/state")
    out = exact.resolved(spark, source, f"{tmp_path}/state")
    assert found(exact.digest_rows(out)) == brute(ODD)
    stay = exact.unique_rows(spark, source, f"{tmp_path}/state")
    assert stay.columns == ["doc_id", "text", "row", "at", "digest"]
    assert {r["doc_id"] for r in stay.collect()} == {2, 4, 5, 6, 8, None, 9, 10}


def test_repeated_rows_leave_one(spark, tmp_path):
    source = table(spark, f"{tmp_path}/docs", [(1, "a"), (1, "a"), (1, "a"), (2, "b"), (None, "b")], files=2)
    exact.ingest(spark, source, f"{tmp_path}/state")
    out = exact.digest_rows(exact.resolved(spark, source, f"{tmp_path}/state"))
    assert sorted((r["doc_id"] or 0, r["kept"], r["group_size"]) for r in out.collect()) == [
        (0, False, 2), (1, False, 3), (1, False, 3), (1, True, 3), (2, True, 2)]


def test_state_outlives_the_runs(spark, tmp_path):
    """Files that come later meet what the state holds; a call without new files changes nothing."""
    source, state = f"{tmp_path}/docs", f"{tmp_path}/state"
    first, second = ODD[:6], [(20, "a"), (0, "only"), (21, "new"), (22, "")]
    table(spark, source, first, files=2)
    exact.ingest(spark, source, state)
    assert found(exact.digest_rows(exact.resolved(spark, source, state))) == brute(first)
    table(spark, source, second, mode="append")
    for _ in range(2):
        exact.ingest(spark, source, state)
        assert found(exact.digest_rows(exact.resolved(spark, source, state))) == brute(first + second)
    batches = spark.read.parquet(f"{state}/groups")
    assert batches.select("batch").distinct().count() == 2


def test_bytes_are_checked_on_hits(spark, tmp_path):
    """A digest of one byte puts different texts together; their bytes part them again."""
    rows = [(i, f"text {i % 97}") for i in range(300)] + [(i, "hot") for i in range(300, 450)]
    source, state = table(spark, f"{tmp_path}/docs", rows, files=3), f"{tmp_path}/state"

    def weak(text):
        return F.substring(F.unhex(F.sha2(text, 256)), 1, 1)

    exact.ingest(spark, source, state, digest=weak)
    assert found(exact.digest_rows(exact.resolved(spark, source, state, digest=weak))) == brute(rows)


def test_empty_table(spark, tmp_path):
    source = f"{tmp_path}/docs"
    spark.createDataFrame([], SCHEMA).write.parquet(source)
    exact.ingest(spark, source, f"{tmp_path}/state")
    out = exact.digest_rows(exact.resolved(spark, source, f"{tmp_path}/state"))
    assert out.count() == 0 and out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_no_python_in_the_plan(spark, tmp_path):
    source = table(spark, f"{tmp_path}/docs", ODD)
    exact.ingest(spark, source, f"{tmp_path}/state")
    plan = exact.resolved(spark, source, f"{tmp_path}/state")._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
