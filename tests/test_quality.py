import pytest

from starfold.operators import quality as Q
from starfold.operators.scd2 import Scd2Spec


def test_checks_and_enforce(spark):
    fact = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id long, dk long")
    dim = spark.createDataFrame([(10,), (11,)], "dk long")
    assert Q.orphan_keys(fact, dim, "dk").violations.collect()[0].dk == 99
    assert Q.orphan_keys(fact, dim, "dk", exclude_nulls=False).violations.count() == 2
    assert Q.null_keys(fact, ["dk"], "f").violations.count() == 1
    prof = Q.null_key_profile(fact, ["id", "dk"]).first()
    assert (prof.null_ids, prof.null_dks) == (0, 1)
    empty = spark.createDataFrame([], "x long")
    assert Q.empty_table(empty, "e").violations.count() == 1
    assert Q.empty_table(fact, "f").violations.count() == 0
    assert Q.enforce([Q.empty_table(fact, "f")]) == {"f is empty": 0}
    with pytest.raises(Q.QualityError, match="orphans: 1 violation"):
        Q.enforce([Q.empty_table(fact, "f"), Q.orphan_keys(fact, dim, "dk")])


def test_blank_keys_and_versions(spark):
    df = spark.createDataFrame([("a", True), (" ", True), ("b", True), ("b", True), ("c", False)],
                               "k string, is_current boolean")
    assert Q.null_keys(df, ["k"], "t", blank=True).violations.count() == 1
    spec = Scd2Spec(("k",), (), ("k",))
    assert [r.k for r in Q.multiple_current_versions(df, spec, "t").violations.collect()] == ["b"]
    assert sorted(r.k for r in Q.current_version_violations(df, spec, "t").violations.collect()) == ["b", "c"]


def test_reference_coverage_keeps_null_codes(spark):
    ev = spark.createDataFrame([("A",), ("B",), ("B",), (None,)], "code string")
    ref = spark.createDataFrame([("A",)], "code string")
    got = {r.code: r["count"] for r in Q.reference_coverage(ev, ref, "code").violations.collect()}
    assert got == {"B": 2, None: 1}


def test_late_batch(spark):
    spec = Scd2Spec(("k",), (), ("a",))
    from starfold.operators.scd2 import scd2_init

    dim = scd2_init(spark.createDataFrame([("x", "1")], "k string, a string"), spec, "2026-01-02")
    inc = spark.createDataFrame([("x", "2")], "k string, a string")
    assert Q.late_batch(dim, inc, spec, "2026-01-01").violations.count() == 1
    assert Q.late_batch(dim, inc, spec, "2026-01-03").violations.count() == 0


def test_checks_counted_together_equal_their_violations(spark):
    """Nulls in keys, equal keys in several gates, composite keys, empty tables, references with nulls."""
    df = spark.createDataFrame(
        [(1, "a", 1, True), (1, "a", 2, True), (None, "b", 3, False), (None, None, 3, True), (2, " ", None, None), (3, "c", 9, True)],
        "k int, s string, f long, is_current boolean")
    ref = spark.createDataFrame([(1, "a"), (9, None), (None, "b")], "f int, s string")
    spec = Scd2Spec(("k",), ("s",), ("s",), key_name="vk")
    for table in (df, df.limit(0)):
        checks = [
            Q.empty_table(table, "t"), Q.null_keys(table, ["k", "f"], "t"), Q.null_keys(table, ["s"], "t", blank=True),
            Q.duplicate_keys(table, ["k"], "t"), Q.duplicate_keys(table, ["s", "k"], "t"), Q.duplicate_keys(table, ["k", "s"], "again"),
            Q.multiple_current_versions(table, spec, "t"), Q.current_version_violations(table, spec, "t"),
            Q.reference_coverage(table, ref, "s", table="t"), Q.orphan_keys(table, ref, "f", table="t"),
            Q.orphan_keys(table, ref, "f", table="with nulls", exclude_nulls=False),
            Q.Check("alone", table.where("k = 1")),
        ]
        want = [c.violations.count() for c in checks]
        got = {r["check"]: r["violations"] for r in Q.run_checks(checks).collect()}
        assert [got[c.name] for c in checks] == want
    assert len(got) == len(checks) and want[0] == 1


def test_a_table_is_scanned_once_for_all_its_checks(spark, workdir, capsys):
    path = f"{workdir}/t"
    spark.range(100).selectExpr("id as k", "id % 7 as f", "cast(id as string) as s").write.parquet(path)
    df, ref = spark.read.parquet(path), spark.range(7).withColumnRenamed("id", "f")
    Q.run_checks([Q.empty_table(df, "t"), Q.null_keys(df, ["k", "s"], "t"), Q.duplicate_keys(df, ["k"], "t"),
                  Q.duplicate_keys(df, ["s", "f"], "t"), Q.orphan_keys(df, ref, "f", table="t")]).explain()
    plan = capsys.readouterr().out
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1


def test_worst_first_orders_by_count_then_keys(spark):
    v = spark.createDataFrame([("b", 2), ("a", 2), ("c", 9), (None, 1)], "code string, count long")
    assert [tuple(r) for r in Q.worst_first(v).collect()] == [("c", 9), ("a", 2), ("b", 2), (None, 1)]
    assert [r["code"] for r in Q.worst_first(v, n=2).collect()] == ["c", "a"]


def test_yearly_trend_is_in_ascending_order(spark):
    from __spark_entry__ import entry

    years = [r["year"] for r in entry(spark).collect()]
    assert years == sorted(years) and len(years) > 3
