"""Whitening against a plain eigendecomposition, and on awkward rows."""

import numpy as np
import pytest

from sootledger.llm import whitening

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, n int"


def plain(x):
    """Covariance, eigenvalues and vectors of whole-number rows, falling."""
    centred = x - x.mean(axis=0)
    v = centred.T @ centred / len(x)
    e, q = np.linalg.eigh(v)
    return centred, e[::-1], q[:, ::-1]


def test_equals_eigendecomposition(spark):
    out = whitening.op11_whitening(spark, SF).toPandas()
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([[int(np.floor(1024 * c)) + 100_000 for c in r["embedding"]] for r in rows])
    centred, e, q = plain(x)
    assert len(out) == 8 * len(rows) and set(out["n"]) == {len(rows)}
    for k in range(8):
        one = out[out["component"] == k + 1].sort_values("vec_id")
        assert one["vec_id"].tolist() == [r["vec_id"] for r in rows]
        want = centred @ q[:, k] / np.sqrt(e[k])
        got = one["whitened"].to_numpy()
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-9
        assert one["explained"].iloc[0] == pytest.approx(e[k] / e.sum(), rel=1e-9)
        exact = [sum((len(rows) * int(a) - int(s)) ** 2 for a, s in zip(r, x.sum(axis=0))) for r in x]
        assert one["deviation"].tolist() == exact
    assert 0 <= out["identity_error"].iloc[0] < 1e-9


def test_lower_rank_and_odd_rows(spark):
    a = np.round(np.random.default_rng(1).normal(size=(300, 3)) * 1024) / 1024
    a = np.hstack([a, 2 * a[:, :1], np.ones((300, 1))])
    odd = [None, [1.0, None, 2.0, 3.0, 4.0], [float("nan")] * 5, [1.0, float("inf"), 1.0, 1.0, 1.0], [1.0], [], [1e30, 1.0, 1.0, 1.0, 1.0]]
    rows = [(i, v.tolist(), 7) for i, v in enumerate(a)] + [(1000 + i, v, 1) for i, v in enumerate(odd)]
    rows += [(None, [0.5, 0.5, 0.5, 1.0, 1.0], 1)] + 2 * [(5, [0.25, 0.25, 0.25, 0.5, 1.0], 2)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = whitening.fit(docs)
    assert model.centre.n == 303 and model.components() == 3 and model.identity_error < 1e-9
    out = whitening.applied(docs, model).toPandas()
    assert len(out) == 303 * 3 and out["vec_id"].isna().sum() == 3
    assert not set(range(1000, 1007)) & set(out["vec_id"])
    twice = out[out["vec_id"] == 5].groupby("component")["whitened"].nunique()
    assert set(twice) == {2}  # row 5 itself, and two equal rows of the same id


def test_no_variance_and_no_rows(spark):
    same = spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1)], SCHEMA)
    assert whitening.fit(same).components() == 0
    assert whitening.applied(same, whitening.fit(same)).count() == 0
    for none in (same.where("false"), spark.createDataFrame([(1, None, 1), (2, [], 1)], SCHEMA)):
        assert whitening.fit(none) is None
        assert whitening.applied(none, None).columns[:3] == ["vec_id", "n", "deviation"]


def test_sums_beyond_64_bits_stay_exact(spark):
    rows = [(1, [2.0**52, 1.0], 1), (2, [-(2.0**52), 3.0], 1), (3, [0.0, 0.0], 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = whitening.fit(docs)
    assert model.centre.sums == [300_000, 300_000 + 4 * 1024]
    out = whitening.applied(docs, model).where("component = 1").orderBy("vec_id").collect()
    assert out[0]["deviation"] is None and out[1]["deviation"] is None
    assert out[2]["deviation"] == 0 + (4 * 1024) ** 2


def test_nearly_dependent_directions(spark):
    """Eigenvalues ten orders of magnitude apart, where a covariance alone would lose half the digits."""
    rng = np.random.default_rng(2)
    a = rng.normal(size=(500, 4)) * [3e5, 3e2, 1.0, 0.01]
    mix = np.linalg.qr(rng.normal(size=(4, 4)))[0]
    docs = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(a @ mix)], SCHEMA)
    model = whitening.fit(docs)
    assert model.components() == 4 and model.identity_error < 1e-6
