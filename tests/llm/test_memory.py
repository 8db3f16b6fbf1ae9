"""What stages that share executors keep: sets and words that are no longer needed are given back."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from sootledger.llm import language, packing, simhash, tokens


def test_short_texts_fill_runs():
    texts = [b"ab"] * 2000
    sizes = [len(run) for run in language.runs(texts)]
    assert sum(sizes) == 2000 and max(sizes) <= 300_000 // language.WINDOW + 1


def test_words_are_given_back():
    path = packing.vocabulary()
    list(tokens.encoded(pa.array(["some words here"]), path, 1))
    assert path in tokens._encoders
    tokens.forget()
    assert not tokens._encoders


def test_pieces_do_not_depend_on_memory(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = [
        sorted(map(tuple, packing.digest(packing.pack(docs, packing.vocabulary(), remember=r)).collect()))
        for r in (True, False)
    ]
    assert found[0] == found[1] and found[0]


def test_one_key_for_the_same_few_sets(spark):
    groups = [[1, 2], [1, 2], [1, 3], [1, 2, 3], [3, 2, 1], [1, 2, 4], [5], [1, 2, 3, 4], [1, 2, 3, 4], [-7, 9], [9, -7]]
    rows = [(s, i % 3, i) for i, g in enumerate(groups) for s in g]
    keyed = spark.createDataFrame(rows, "sid long, choice int, key long")
    kept = [frozenset(groups[r["key"]]) for r in simhash.shared_keys(keyed).collect()]
    small = [g for g in kept if len(g) < 4]
    assert len(small) == len(set(small)) and set(kept) == {frozenset(g) for g in groups if len(g) > 1}
    assert len(kept) == len(small) + 2  # larger groups are compared under each of their keys


def test_sets_are_read_for_wanted_ids_only(spark):
    texts = [f"text number {i} with a few more words of its own {i * i}" for i in range(300)] + [None, ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(999, texts[0])], "doc_id long, text string")
    marked = simhash.sketches(docs)
    wanted = marked.where("doc_id in (0, 7, 999)").groupBy("sid").agg(F.min("tk").alias("tk"))
    got = {r["sid"]: np.frombuffer(r["members"], np.uint64).tolist() for r in simhash.sets_of(docs, wanted).collect()}
    want = [simhash.shingles(texts[i].encode()) for i in (0, 7)]
    assert sorted(got.values()) == sorted(x.tolist() for x in want)
