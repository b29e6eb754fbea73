import hashlib

from pyspark.sql import functions as F

from starfold.functions import (
    add_record_hash,
    null_if_missing,
    ratio,
    surrogate_key,
    title_case,
    typed,
    upper_code,
)


def test_null_if_missing_tokens(spark):
    df = spark.createDataFrame([(v,) for v in [" NA ", "N/A", "", "null", "NULL", "na", "Null", " x ", None]], "v string")
    out = [r[0] for r in df.select(null_if_missing("v")).collect()]
    # tokens are case-sensitive; trimming is on spaces
    assert out == [None, None, None, None, None, "na", "Null", "x", None]


def test_case_standardisation(spark):
    df = spark.createDataFrame([(" m ", "gOLD medal")], "a string, b string")
    r = df.select(upper_code("a").alias("a"), title_case("b").alias("b")).first()
    assert (r.a, r.b) == ("M", "Gold Medal")


def test_record_hash_matches_format(spark):
    df = spark.createDataFrame([(1, " a ", None)], "x long, y string, z string")
    got = add_record_hash(df, ["x", "y", "z"]).first().record_hash
    assert got == hashlib.sha256("1||a||<null>".encode()).hexdigest()


def test_record_hash_validates_columns(spark):
    df = spark.createDataFrame([(1,)], "x long")
    import pytest

    with pytest.raises(ValueError):
        add_record_hash(df, [])
    with pytest.raises(ValueError):
        add_record_hash(df, ["x", "missing"])


def test_surrogate_key_skips_nulls(spark):
    df = spark.createDataFrame([("a", None)], "s string, e string")
    r = df.select(surrogate_key("s", "e").alias("k1"), surrogate_key("s").alias("k2")).first()
    assert r.k1 == r.k2


def test_typed_cast_modes(spark):
    import pytest
    from pyspark.errors import PySparkException

    df = spark.createDataFrame([("12",), ("abc",)], "v string")
    assert [r[0] for r in df.select(typed("v", "int", "null")).collect()] == [12, None]
    with pytest.raises(PySparkException):
        df.select(typed("v", "int", "fail")).collect()


def test_ratio_rounds_and_guards_zero(spark):
    df = spark.createDataFrame([(1, 3), (1, 0)], "a long, b long")
    assert [r[0] for r in df.select(ratio("a", "b")).collect()] == [0.3333, None]
    assert df.select(F.lit(1)).count() == 2
