"""Columns of a caller with names that operators use themselves, and samples of repeated and long rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sootledger.llm import language, mixing, quality, shared, sharding, simhash

NAMES = ["_row", "_hash", "_text", "_id", "_found", "_doc", "_at", "_h", "fp", "component_id", "n_words", "kept", "members",
         "large", "score", "lang_pred", "shard", "slot", "a b.c"]


@pytest.fixture(scope="module")
def clashing(spark):
    texts = ["the same words stand here in this order and nothing else", None, "", "one other text, of its own"] * 3
    rows = [(i, t, "en", None if i == 5 else f"s{i % 2}") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    # Stored, as in the pipeline: the optimizer should not have to infer constraints between 20 computed columns.
    return shared.cut(docs.select("*", *(F.concat(F.lit(f"{n}-"), F.col("doc_id").cast("string")).alias(n) for n in NAMES),
                       F.create_map(F.lit("k"), F.col("doc_id")).alias("map")))


def _untouched(out, replaced=()):
    """Every column of the caller, but for replaced ones, holds what it held."""
    rows = out.collect()
    assert rows
    for r in rows:
        assert all(r[n] == f"{n}-{r['doc_id']}" for n in NAMES if n not in replaced)
        assert r["map"] == {"k": r["doc_id"]}
    return rows


def test_rows_leave_columns_alone(clashing):
    for out in (mixing.mixed(clashing), language.accepted(clashing, language.fit(clashing))):
        assert out.columns == clashing.columns
        _untouched(out)


def test_added_columns_replace_those_of_their_name(spark, clashing):
    labels = spark.createDataFrame([(0, 1), (3, 0)], "doc_id long, quality int")
    rows = _untouched(quality.judged(clashing, quality.fit(clashing, labels)), ["score"])
    assert len(rows) == 12 and all(0 <= r["score"] <= 1 for r in rows)
    rows = _untouched(language.identify(clashing, language.fit(clashing)), ["score", "lang_pred"])
    assert {r["lang_pred"] for r in rows} == {"en", "und"}


@pytest.mark.parametrize("similar", [None, 0.8])
def test_near_duplicates_leave_columns_alone(clashing, similar):
    kept = simhash.keep_one(clashing, similar=similar)
    assert kept.columns == clashing.columns
    assert sorted(r["doc_id"] for r in _untouched(kept)) == [0, 1, 3]
    found = simhash.near_duplicates(clashing, similar=similar)
    rows = _untouched(found, ["fp", "component_id"])
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: 1 if i % 4 in (1, 2) else i % 4 for i in range(12)}


def test_repeated_rows_with_columns_of_any_name_stay_once(clashing):
    kept = simhash.keep_one(clashing.unionByName(clashing))
    assert sorted(r["doc_id"] for r in _untouched(kept)) == [0, 1, 3]


def test_shards_leave_columns_alone(clashing):
    linked = clashing.withColumns({"hub": F.md5("text"), "tie": F.xxhash64("doc_id")})
    out = sharding.shard_evenly(linked, 3)
    assert set(out.columns) == set(linked.columns)
    rows = _untouched(out, ["shard", "slot"])
    assert sorted((r["shard"], r["slot"]) for r in rows) == [(s, i) for s in range(3) for i in range(4)]


def test_sample_is_bounded_with_repeated_rows(spark):
    ids = spark.range(40).select((F.col("id") % 20).alias("k"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("g"))
    rows = ids.crossJoin(spark.range(300).select()).withColumn("t", F.repeat(F.lit("x"), F.col("k").cast("int")))
    got = shared.bounded_sample(rows, "g", "k", 100)
    assert {g: sum(r["g"] == g for r in got) for g in "ab"} == {"a": 100, "b": 100}
    assert got == shared.bounded_sample(rows.repartition(7), "g", "k", 100)
    held = shared.bounded_sample(rows, "g", "k", 100, "t", 50)
    assert all(0 < sum(len(r["t"]) for r in held if r["g"] == g) <= 50 or sum(r["g"] == g for r in held) == 1 for g in "ab")


def test_classes_of_long_texts_only_are_learned(spark):
    long_en, long_fr = "the cat sat on the mat and " * 3000, "le chat est sur la table et " * 3000
    docs = spark.createDataFrame(
        [(1, "der hund und die katze", "de"), (3, long_en, "en"), (4, long_fr, "fr"), (5, long_fr + "x", "fr")],
        "doc_id long, text string, lang string",
    ).where(~shared.held_out(F.col("doc_id")))
    model = language.fit(docs, most_bytes=100)
    assert set(model.languages) == {r["lang"] for r in docs.collect()}
    labels = docs.select("doc_id", (F.col("lang") == "de").cast("int").alias("quality"))
    learned = quality.fit(docs, labels.unionByName(labels), most_bytes=100)
    assert set(np.unique(learned.labels)) == {r["quality"] for r in labels.collect()}
