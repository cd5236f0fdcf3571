"""Role resolution (P1/P2), header normalization (P3), union by name."""

import pytest

from refloom.operators import schema


def test_pick_column_exact_then_substring():
    assert schema.pick_column(["DEP", "CODGEO", "LIB"], ["COM", "CODGEO"]) == "CODGEO"
    assert schema.pick_column(["x_typecom_2024", "code"], ["TYPECOM", "TYPE_COM"]) == "x_typecom_2024"
    assert schema.pick_column(["x", "TUU2020_bis"], ["TUU2020", "TUU"]) == "TUU2020_bis"
    # same normalized key twice: the later column wins
    assert schema.pick_column(["com", "COM"], ["COM"]) == "COM"


def test_pick_column_error_lists_columns():
    with pytest.raises(schema.RoleNotFound, match="a, b"):
        schema.pick_column(["a", "b"], ["COM"])


def test_normalize_headers_like_loader():
    raw = ["Année été", "2nd col", "Nom (x)", "nom x", "Select", "a__b", " DATE-DEBUT"]
    assert schema.normalize_headers(raw) == ["annee_ete", "_2nd_col", "nom_x", "nom_x_1", "_select", "a__b", "datedebut"]
    assert schema.normalize_headers(["", "   ", "ID", "id"]) == ["column0", "_", "id", "id_1"]


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1, "x")], "id long, nom string")
    b = spark.createDataFrame([("y", 2.5)], "nom string, hauteur double")
    rows = schema.union_by_name([a, b]).collect()
    assert [tuple(r) for r in rows] == [("1", "x", None), (None, "y", "2.5")]
    assert set(schema.union_by_name([a, b]).dtypes) == {("id", "string"), ("nom", "string"), ("hauteur", "string")}
