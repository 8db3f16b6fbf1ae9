"""Verdicts of the rules do not depend on how the rows are split, ordered or accompanied."""

import re

import pytest
from pyspark.sql import functions as F

from sootledger.llm import rules

SF = "/root/testdata/sf0.001"


@pytest.fixture
def model(spark, monkeypatch):
    monkeypatch.setattr(rules, "BUCKETS", 1 << 10)
    found = rules.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    assert isinstance(found, rules.Table)
    return found


def verdicts(docs, model):
    return {r["doc_id"]: (r["ratio"], r["kept"]) for r in rules.rated(docs, model).collect()}


def test_other_splits_and_orders(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = verdicts(docs, model)
    good = {i for i, (_, kept) in want.items() if kept}
    assert 0 < len(good) < len(want)
    moved = docs.repartition(7, "doc_id").withColumn("n_words", F.lit("mine")).withColumn("_key", F.lit(1))
    assert verdicts(moved.drop("_key"), model) == want
    assert rules.rated(moved.drop("_key"), model).schema["n_words"].dataType.simpleString() == "bigint"
    stay = rules.kept(moved, model)
    assert stay.columns == moved.columns and {r["n_words"] for r in stay.collect()} == {"mine"}
    assert {r["doc_id"] for r in stay.collect()} == good
    # Another size of splits in each of the scans.
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("20000", "70000", "1000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            judged = rules.kept(docs, model)
            spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
            assert {r["doc_id"] for r in judged.collect()} == good
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_repeated_rows_share_a_key(spark, model):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    once = verdicts(docs, model)
    again = docs.unionByName(docs).unionByName(docs)
    rows = rules.rated(again, model).collect()
    assert len(rows) == 60 and all((r["ratio"], r["kept"]) == once[r["doc_id"]] for r in rows)


def test_counting_sends_few_rows(spark, monkeypatch):
    """As many tasks as cores count the n-grams of a table, or more where there are many; splits do not matter."""
    monkeypatch.setattr(rules, "BUCKETS", 1 << 10)
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(40)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    tasks, coalesce = [], type(docs).coalesce
    monkeypatch.setattr(type(docs), "coalesce", lambda self, n: tasks.append(n) or coalesce(self, n))
    tables = []
    for counted in (rules.COUNTED, 10_000):
        monkeypatch.setattr(rules, "COUNTED", counted)
        model = rules.fit(docs, labels)
        tables.append({(r["page"], tuple(r["ratios"])) for r in model.pages.collect()})
    cores = spark.sparkContext.defaultParallelism
    assert tasks[0] == cores < 40 and tasks[1] > cores and tables[0] == tables[1]


def test_n_grams_of_awkward_texts(spark):
    texts = [None, "", " \n", "a", " a\tb ", "a\x0b\x0cb\r\nc  d\u00a0e", "a a a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {}
    for i, t in enumerate(texts):
        found = [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]
        rows = spark.createDataFrame([(w, v) for w, v in zip(found, [*found[1:], None])], "w string, v string")
        own = rules.hashed(F.col("w"))
        pair = F.when(F.col("v").isNotNull(), rules.joined(own, rules.hashed(F.col("v"))))
        hashes = [x for r in rows.select(own, pair).collect() for x in r if x is not None]
        want[i] = sorted(x % 1000003 for x in hashes)
    got = {i: [] for i in want}
    firsts = dict.fromkeys(want, 0)
    for r in rules.placed_grams(docs, 1000003, first=True).collect():
        got[r["doc_id"]].append(r["bucket"])
        firsts[r["doc_id"]] += r["_first"]
    assert {i: sorted(b) for i, b in got.items()} == want
    assert firsts == {i: int(bool(b)) for i, b in want.items()}
    plan = rules.placed_grams(docs, 1000003)._jdf.queryExecution().executedPlan().toString()
    assert "transform" not in plan and "lambda" not in plan  # compiled, not interpreted word by word


def test_a_large_table_is_looked_up_in_slices(spark, model, monkeypatch):
    """Beyond what the driver can hold, slices of the table are broadcast one by one; n-grams never move."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    keyed = docs.unionByName(docs.limit(9)).select(rules.text_key().alias("_key"), "text")
    keyed = keyed.unionByName(spark.createDataFrame([(b"none", None), (b"word", "one")], "_key binary, text string"))

    def sums():
        found = model.sums(keyed)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(page" not in plan and "SortMergeJoin" not in plan
        return {bytes(r["_key"]): r["_sum"] for r in found.collect()}

    want = sums()
    assert len(want) > 40 and b"word" in want and b"none" not in want and model.buckets > 2 * rules.PAGE
    monkeypatch.setattr(rules, "PACKED", rules.PAGE)
    assert sums() == want
    whole, parts = rules.Table._part, []
    monkeypatch.setattr(rules.Table, "_part", lambda self, d, a, b: parts.append((a, b)) or whole(self, d, a, b))
    sums()
    pages = -(-model.buckets // rules.PAGE)
    assert parts == [(i, i + 1) for i in range(pages)]


def test_slices_follow_the_driver(spark, monkeypatch):
    assert rules.PAGE <= rules.slice_size(spark) <= rules.PACKED
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()
    monkeypatch.setattr(rules, "PAGE_BYTES", heap // 120)
    assert rules.slice_size(spark) == 10 * rules.PAGE
