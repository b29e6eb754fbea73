import pytest

from starfold.operators.cleanse import clean_columns, dedupe_by_key, dedupe_exact, rejected_values, require_not_null
from starfold.operators.mapping import ambiguous_mappings, apply_mapping, clean_mapping


def test_dedupe_exact(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k long, v string")
    assert sorted(dedupe_exact(df).collect()) == [(1, "a"), (2, "b")]


@pytest.mark.parametrize("keep,expected", [("first", "a"), ("last", "c")])
def test_dedupe_by_key_is_deterministic(spark, keep, expected):
    rows = [(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 1, "z")]
    df = spark.createDataFrame(rows, "k long, o int, v string").repartition(4)
    out = {r.k: r.v for r in dedupe_by_key(df, ["k"], ["o"], keep).collect()}
    assert out[1] == expected and out[2] == "z"
    assert dedupe_by_key(df, ["k"], ["o"], keep).columns == ["k", "o", "v"]


def test_dedupe_by_key_nulls_lowest(spark):
    df = spark.createDataFrame([(1, None, "n"), (1, 0, "z")], "k long, o int, v string")
    assert dedupe_by_key(df, ["k"], ["o"]).first().v == "n"


def test_require_not_null(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "k long, v string")
    assert require_not_null(df, ["k", "v"]).count() == 1


def test_clean_columns_spec(spark):
    df = spark.createDataFrame([("7", " NA ", " f ", "24", "winter")], "id string, n string, s string, a string, se string")
    out = clean_columns(df, [("id", "id", "id:long"), ("n", "name", "text"), ("s", "sex", "upper"),
                             ("a", "age", "int"), ("se", "season", "title")]).first()
    assert tuple(out) == (7, None, "F", 24, "Winter")


def test_mapping_clean_apply_and_ambiguity(spark):
    raw = spark.createDataFrame(
        [(" NOC_REGIONS ", " sin ", " sgp ", " r "), ("noc_regions", None, "X", None), ("other", "AAA", "BBB", None)],
        "source_system string, source_code string, canonical_code string, reason string",
    )
    m = clean_mapping(raw)
    assert sorted(tuple(r) for r in m.collect()) == [("noc_regions", "SIN", "SGP", "r"), ("other", "AAA", "BBB", None)]
    df = spark.createDataFrame([("SIN", 1), ("POR", 2), ("AAA", 3)], "code string, n int")
    out = {r.code: r.noc for r in apply_mapping(df, m, "NOC_Regions", "code", "noc").collect()}
    assert out == {"SIN": "SGP", "POR": "POR", "AAA": "AAA"}
    assert ambiguous_mappings(m).count() == 0
    dup = m.unionByName(spark.createDataFrame([("noc_regions", "SIN", "SGX", None)], m.schema))
    amb = ambiguous_mappings(dup).collect()
    assert [(r.source_code, r.n_rows, r.n_canonical) for r in amb] == [("SIN", 2, 2)]


def test_rejected_values_are_told_from_missing_ones(spark):
    df = spark.createDataFrame([("1", " 7 ", "1.5"), ("x", "NA", ""), ("", "seven", "1,5"), (None, None, None), ("9" * 30, "2", "NULL")],
                               "id string, n string, d string")
    spec = [("id", "id", "id:long"), ("n", "n", "int"), ("d", "size", "double")]
    got = clean_columns(df, spec, "null", rejected="bad").collect()
    assert [(r["id"], r["n"], r["size"]) for r in got] == [(1, 7, 1.5), (None, None, None), (None, None, None), (None, None, None), (None, 2, None)]
    assert [[tuple(e) for e in r["bad"]] for r in got] == [
        [], [("id", "x", "id:long")], [("n", "seven", "int"), ("d", "1,5", "double")], [], [("id", "9" * 30, "id:long")]]
    rows = sorted(tuple(r) for r in rejected_values(df, spec, keep=["n"]).collect())
    assert rows == sorted([("NA", "id", "x", "id:long"), ("seven", "n", "seven", "int"), ("seven", "d", "1,5", "double"), ("2", "id", "9" * 30, "id:long")])
    assert clean_columns(df.where("id = '1'"), spec, rejected="bad").first()["bad"] == []
