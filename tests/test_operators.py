import datetime as dt

import pytest
from pyspark.sql import functions as F

from sootledger.operators import aggregates, contract, filters, joins, ranking, sets
from tests.conftest import rows


def test_keep_columns_reports_missing(spark):
    df = spark.createDataFrame([(1, 2, 3)], " a int, `b ` int, c int")
    kept, missing = contract.keep_columns(df, ["b", " a", "z"], also=["c", "y"])
    assert kept.columns == ["b", "a", "c"] and missing == ["z"]


def test_conform(spark):
    from sootledger import schemas
    df = spark.createDataFrame([("p", 1)], "ID_PERSONNEL string, extra int")
    out = contract.conform(df, schemas.DIM_PERSONNEL)
    assert out.schema.simpleString() == schemas.DIM_PERSONNEL.simpleString()
    assert rows(out) == [("p", None, None, None)]


def test_case_insensitive_filters_use_the_stored_key(spark):
    df = spark.createDataFrame([("Paris", "paris"), ("LA", "la")], "ID_SITE string, ID_SITE_KEY string")
    plan = filters.ci_equals(df, "ID_SITE", "PARIS")._jdf.queryExecution().toString()
    assert "lower(" not in plan
    assert rows(filters.ci_equals(df, "ID_SITE", "PARIS"), "ID_SITE") == [("Paris",)]
    assert rows(filters.ci_in(df.drop("ID_SITE_KEY"), "ID_SITE", ["La"])) == [("LA",)]


@pytest.mark.parametrize("start, end, days", [
    ("2026-06-01", "2026-06-02", [1, 2]), (None, "2026-06-01", [1]), ("2026-06-02", None, [2, 3]),
    (None, None, [1, 2, 3, None]),
])
def test_filter_period(spark, start, end, days):
    df = spark.createDataFrame(
        [(d, d and dt.datetime(2026, 6, d, 23, 59, 59)) for d in (1, 2, 3, None)],
        "n int, DATE timestamp",
    )
    assert rows(filters.filter_period(df, start, end), "n") == sorted(
        [(d,) for d in days], key=lambda r: (r[0] is None, str(r[0])))
    assert filters.filter_period(df.drop("DATE"), start, end).count() == 4


def test_last_day_of_between_is_included(spark):
    df = spark.createDataFrame([(dt.date(2026, 9, 30),), (dt.date(2026, 10, 1),)], "d date")
    assert rows(filters.between_days(df, "d", "2026-06-01", "2026-09-30")) == [(dt.date(2026, 9, 30),)]


def test_filter_equal_and_filled(spark):
    df = spark.createDataFrame([("a", " "), ("b", "x"), (None, None)], "k string, v string")
    assert rows(filters.filter_equal(df, k="b", v=None, absent="z")) == [("b", "x")]
    assert rows(filters.only_filled(df, "v")) == [("b", "x")]


BANDS = [
    ("AVION", None, False, 1000.0, False, "s"), ("AVION", 1000.0, True, 3500.0, True, "m"),
    ("AVION", 3500.0, False, None, False, "l"), ("TRAIN", None, False, 200.0, True, "t"),
    ("TRAIN", 200.0, False, None, False, "g"), ("TAXI", None, False, None, False, "x"),
]


def test_band_lookup_bounds(spark):
    bands = spark.createDataFrame(
        BANDS, "CODE string, LO double, LO_IN boolean, HI double, HI_IN boolean, BAND string")
    cases = {
        ("AVION", 999.99): "s", ("AVION", 1000.0): "m", ("AVION", 3500.0): "m",
        ("AVION", 3500.01): "l", ("TRAIN", 200.0): "t", ("TRAIN", 200.01): "g", ("TAXI", 7.0): "x",
        ("TAXI", None): None, ("VELO", 1.0): None, (None, 1.0): None,
    }
    df = spark.createDataFrame(list(cases), "code string, km double")
    out = joins.band_lookup(df, bands, "code", "km")
    assert {(r["code"], r["km"]): r["BAND"] for r in out.collect()} == cases


def test_lookup_null_never_matches(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "k string, n int")
    ref = spark.createDataFrame([(None, 9), ("a", 8)], "k string, v int")
    assert rows(joins.lookup(df, ref, "k"), "n", "v") == [(1, None), (2, 8)]


def test_lookup_or_compute(spark):
    ref = spark.createDataFrame([("a", 1.0), ("b", None)], "k string, v double")
    df = spark.createDataFrame([("a",), ("b",), ("b",), ("c",), (None,)], "k string")
    asked = []

    def compute(keys):
        asked.extend(r[0] for r in keys.collect())
        return keys.withColumn("v", F.when(F.col("k") == "b", F.lit(7.0)))

    out, added = joins.lookup_or_compute(df, ref, ["k"], "v", compute)
    assert sorted(asked) == ["b", "c"]
    assert rows(added) == [("b", 7.0)]
    assert rows(out) == [("a", 1.0), ("b", 7.0), ("b", 7.0), ("c", None), (None, None)]
    assert rows(joins.append_reference(ref, added, ["k"])) == [("a", 1.0), ("b", 7.0)]


def test_outer_add_two_ways(spark):
    a = spark.createDataFrame([("x", 1.0), (None, 2.0)], "k string, v double")
    b = spark.createDataFrame([("y", 3.0), (None, 4.0), ("x", 5.0)], "k string, v double")
    expected = [("x", 6.0), ("y", 3.0), (None, 6.0)]
    assert rows(joins.outer_add([a, b], ["k"], "v")) == expected
    assert rows(joins.outer_add_join(a, b, "k", "v")) == expected


def test_reconcile_site(spark):
    df = spark.createDataFrame(
        [("KeyPers_Paris_1", None, "LA"), ("KeyPers_Paris_1", "Berlin", None)],
        "ID_PERSONNEL string, ID_SITE_x string, ID_SITE_y string")
    out = joins.reconcile_site(df, ["ID_SITE_x", "ID_SITE_y"])
    assert rows(out, "ID_SITE") == [("Berlin",), ("LA",)]
    assert rows(joins.reconcile_site(df.select("ID_PERSONNEL")), "ID_SITE") == [("Paris",)] * 2
    assert joins.reconcile_site(df.select("ID_SITE_x")).columns == ["ID_SITE_x"]


def test_first_and_last_combine_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    last = ranking.last_per_key(df, "k", ["id"])
    assert rows(last) == [(0, 999), (1, 997), (2, 998)]
    assert rows(ranking.first_per_key(df, ["k"], ["id"])) == [(0, 0), (1, 1), (2, 2)]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_orders(spark):
    df = spark.createDataFrame([("b", 1.0), ("z", 5.0), ("a", 2.0), ("y", 0.5)], "k string, v double")
    assert [r[0] for r in ranking.order_by_list(df, "k", ["b", "a", "q"]).collect()] == ["b", "a", "y", "z"]
    again = ranking.reindex_to_list(df, "k", ["q", "a", "b"], "v").collect()
    assert [tuple(r) for r in again] == [("q", 0.0), ("a", 2.0), ("b", 1.0)]
    ties = df.withColumn("v", F.lit(1.0))
    assert [r[0] for r in ranking.top_n(ties, "v", 2, ["k"]).collect()] == ["a", "b"]


def test_totals(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, None)], "k string, IMPACT double")
    assert rows(aggregates.group_total(df, "k", "IMPACT")) == [("a", 1.0), (None, 2.0)]
    assert aggregates.group_total(df, "absent", "IMPACT").count() == 0
    assert rows(aggregates.total_tonnes(df, "t")) == [(0.003,)]
    assert rows(aggregates.total_tonnes(df.limit(0), "t")) == [(None,)]
    assert rows(df.limit(0).agg(aggregates.sum_or_zero("IMPACT"))) == [(0.0,)]
    assert rows(aggregates.count_distinct(df, "k", "n", approx=True)) == [(1,)]
    assert rows(aggregates.count_rows(df, "k", "n")) == [(1,)]


def test_matrix_leaves_null_keys_out(spark):
    df = spark.createDataFrame(
        [("r", "a", 1.0), ("r", "b", 2.0), ("s", "a", 3.0), (None, "a", 9.0), ("u", None, 9.0)],
        "r string, c string, v double")
    for columns in (["a", "b"], None):
        out = aggregates.matrix(df, "r", "c", "v", columns)
        assert out.columns == ["r", "a", "b"]
        assert rows(out) == [("r", 1.0, 2.0), ("s", 3.0, 0.0)]


def test_missing_percent(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), ("2",)], "v string")
    assert rows(aggregates.missing_percent(df, "v", 5.0)) == [(50.0, True)]
    assert rows(aggregates.missing_percent(df.limit(0), "v", 5.0)) == [(0.0, False)]


def test_day_bounds_default(spark):
    empty = spark.createDataFrame([], "d date")
    default = (dt.date(2026, 1, 1), dt.date(2026, 2, 1))
    assert rows(aggregates.day_bounds([(empty, "d")], default)) == [default]


def test_stack_fills_absent_columns(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([("q",)], "y string")
    assert rows(sets.stack(a, b)) == [(1, None), (None, "q")]
    assert rows(sets.tagged(a, "m")) == [(1, "m")]
