"""Cases that earlier versions got wrong."""

from conftest import rows

from sootledger.files import CSV_WRITE_OPTIONS, read_delimited
from sootledger.operators import aggregates
from sootledger.plans import enrich, questions
from sootledger.sources import split_impacts


def test_matrix_keeps_columns_that_are_not_listed(spark):
    df = spark.createDataFrame([("s", "Paris", 1.0), ("s", "Tokyo", 5.0)], "s string, site string, v double")
    assert aggregates.matrix(df, "s", "site", "v", ["Paris", "LA"]).collect() == [("s", 1.0, 0.0, 5.0)]


def test_blank_type_and_blank_model_meet(spark):
    reference = spark.createDataFrame(
        [(" ", "Modèle par défaut", "99", 0), (None, "modèle par défaut", "7", 1), ("Ecran", "modèle par défaut", "3", 2)],
        "TYPE string, MODELE string, IMPACT string, _position long",
    )
    bought = spark.createDataFrame(
        [("a", " ", " "), ("b", None, None), ("c", " ", "modèle par défaut"), ("d", "Ecran", "")],
        "ID string, TYPE string, MODELE string",
    )
    out = enrich.equipment_impact(bought, *split_impacts(reference))
    assert rows(out, "ID", "IMPACT") == [("a", 99.0), ("b", 99.0), ("c", 350.0), ("d", 3.0)]


def test_cells_survive_writing_and_reading(spark, tmp_path):
    cells = [('a "b" c', " plane "), ("back\\slash", 'x;"y'), ('"', "é")]
    df = spark.createDataFrame(cells, "k string, v string")
    df.coalesce(1).write.option("sep", ";").options(**CSV_WRITE_OPTIONS).csv(str(tmp_path / "out"))
    assert rows(read_delimited(spark, str(tmp_path / "out"), ";")) == sorted(cells)


def test_question_that_fails_while_running(spark, monkeypatch):
    def fails(s):
        return s.range(3).selectExpr("raise_error('late') AS x")

    monkeypatch.setitem(questions.QUESTIONS, "q1", fails)
    monkeypatch.setitem(questions.QUESTIONS, "q2", lambda s: s.range(2))
    got = questions.run_questions(spark, ["q1", "q2"])
    assert isinstance(got["q1"], Exception) and got["q2"].count() == 2
