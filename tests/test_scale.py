"""What large tables need: rows are shuffled where they must be, and results stay those of the plain way."""

import contextlib
import glob
import io
import os

import pytest
from pyspark.sql import functions as F

from starfold import session
from starfold.functions.columns import digest, exact_sum, surrogate_key
from starfold.operators.analytics import deduped_class_table
from starfold.operators.cleanse import dedupe_exact, dedupe_staged
from starfold.operators.dims import build_dimension
from starfold.operators.facts import DimLookup, resolve_keys
from starfold.plans import dirty, ledger, pipeline, pipeline_demo, warehouse
from starfold.sources.bronze import write_batch
from starfold.sources.versions import VersionedTables, totals
from tests.conftest import SF_SMALL

BROADCAST = "spark.sql.autoBroadcastJoinThreshold"


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get(BROADCAST)
    spark.conf.set(BROADCAST, "-1")
    yield
    spark.conf.set(BROADCAST, before)


def test_dedupe_staged_leaves_rows_that_occur_once_where_they_are(spark):
    rows = [(1, "a"), (1, "a"), (2, None), (2, None), (None, "2"), (3, "a"), (None, None), (None, None), (4, "")]
    df = spark.createDataFrame(rows, "k int, t string")
    out = dedupe_staged(df)
    assert sorted(map(str, out.collect())) == sorted(map(str, dedupe_exact(df).collect()))
    anti = _plan(out).split("LeftAnti")[1].split("HashAggregate")[0]
    assert "hashpartitioning(k" not in anti and "hashpartitioning(t" not in anti


def test_dedupe_staged_when_all_rows_come_twice(spark, no_broadcast):
    df = spark.range(500).selectExpr("id", "cast(id % 7 as string) t")
    out = dedupe_staged(df.union(df)).collect()
    assert sorted(out) == sorted(df.collect())


def test_dedupe_staged_looks_for_copies_by_telling_columns_only(spark):
    rows = [(1, "a", 1), (1, "a", 1), (1, "b", 1), (1, None, 1), (1, None, 1), (2, "c", 2), (None, "d", 3), (3, None, None), (3, None, None)]
    df = spark.createDataFrame(rows, "k int, t string, v int")
    out = dedupe_staged(df, ["k", "v"])  # rows alike in these are compared by all columns
    assert sorted(map(str, out.collect())) == sorted(map(str, dedupe_exact(df).collect()))
    # A column beside them is not even made for rows that occur once.
    costly = df.where("k = 2").withColumn("t", F.when(F.col("k") == 2, F.raise_error(F.lit("made"))).otherwise(F.col("t")))
    assert dedupe_staged(costly, ["k", "v"]).select("k").collect() == [(2,)]


def test_sums_of_hashes_are_exact(spark):
    low, high = -(1 << 63), (1 << 63) - 1
    for rows in ([low] * 5, [high] * 7, [low, high, -1, 0, 1, (1 << 42) - 1, -(1 << 21), None], [None], []):
        df = spark.createDataFrame([(x,) for x in rows], "h long")
        there = [x for x in rows if x is not None]
        found = df.agg(exact_sum("h")).first()[0]
        assert found == (sum(there) if there else None)
    df = spark.range(1000).selectExpr("id", "cast(id as string) t", "id % 3 = 0 as third")
    h = F.xxhash64("id", "t").cast("decimal(20,0)")
    want = df.agg(F.count(F.lit(1)), F.sum(h), F.count_if("third"), F.sum(F.when(F.col("third"), h))).first()
    assert ledger.counted(df, ["id", "t"], [F.lit(True), F.col("third")]) == [(want[0], int(want[1])), (want[2], int(want[3]))]


def test_packed_rows_are_read_by_more_tasks(spark, workdir, monkeypatch):
    spark.range(0, 480, 1, 48).write.parquet(f"{workdir}/t")
    tasks = lambda: spark.read.parquet(f"{workdir}/t").rdd.getNumPartitions()
    before, plain = spark.conf.get(session.READ_SIZE), tasks()
    monkeypatch.setattr(session, "PACKED_BYTES", 1 << 20)
    with session.small_reads(spark):
        assert plain < tasks() == 48
    assert spark.conf.get(session.READ_SIZE) == before
    spark.conf.set(session.READ_SIZE, "4096")  # what the session says is smaller: it stays
    try:
        with session.small_reads(spark):
            assert spark.conf.get(session.READ_SIZE) == "4096"
    finally:
        spark.conf.set(session.READ_SIZE, before)


def test_a_batch_reads_its_packed_input_so(spark, monkeypatch):
    seen = []
    for name in ("ingest_bronze", "build_silver"):
        def spy(s, *rest, real=getattr(pipeline, name)):
            seen.append(int(s.conf.get(session.READ_SIZE)))
            return real(s, *rest)
        monkeypatch.setattr(pipeline, name, spy)
    before = spark.conf.get(session.READ_SIZE)
    out = pipeline_demo.run_two_batches(warehouse.loader(spark, SF_SMALL))
    assert seen == [session.PACKED_BYTES] * 4 and spark.conf.get(session.READ_SIZE) == before
    # The second batch holds all lines, those of the first moved, not written again.
    layout = pipeline.Layout(out)
    first, second = (pipeline.read_batch(spark, layout.bronze("athlete_events"), d).select(pipeline.EVENT_COLUMNS)
                     for d in (pipeline_demo.BATCH_1_DATE, pipeline_demo.BATCH_2_DATE))
    lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert 0 < first.count() < second.count() == lines and first.exceptAll(second).count() == 0
    folders = [f"{out.removesuffix('/out')}/in/batch_{i}/athlete_events.csv/part-*" for i in (1, 2)]
    assert not glob.glob(folders[0].removeprefix("file:")) and glob.glob(folders[1].removeprefix("file:"))


def test_hashed_lookup_is_that_of_a_join(spark, no_broadcast):
    events = spark.createDataFrame([(1, "x"), (1, "y"), (2, "x"), (None, "x"), (9, "z"), (9, "z")], "m int, t string")
    dim = build_dimension(events.where("m < 9"), ["m"], [], "m_key")
    plain, hashed = (resolve_keys(events, [DimLookup(dim, ("m",), "m_key", hashed=h)]).select("m", "t", "m_key") for h in (False, True))
    assert sorted(map(str, plain.collect())) == sorted(map(str, hashed.collect()))
    assert hashed.where("m = 9 and m_key is not null").count() == 0
    assert hashed.where(F.col("m_key") == surrogate_key("m")).count() == 3


def test_batches_are_written_without_a_shuffle(spark, workdir):
    df = spark.range(0, 400, 1, 4).selectExpr("id", "cast(id % 2 as int) y")
    assert write_batch(df.withColumn("_batch_date", F.lit("2026-01-01")), f"{workdir}/t", "2026-01-01", ["y"]) == 400
    assert len(glob.glob(f"{workdir}/t/_batch_date=2026-01-01/y=0/*.parquet")) == 4
    parts = VersionedTables(spark, f"{workdir}/s").stage_by(df, "f", "y")
    assert [n for n, _ in totals(parts).values()] == [200, 200]
    assert all(len(glob.glob(f"{p['path']}/*.parquet")) == 4 for held in parts.values() for p in held)


def test_upsert_by_null_keys_and_several_columns(spark, workdir):
    def frame(rows):
        return spark.createDataFrame(rows, "a string, b string, y int, v int")

    store = VersionedTables(spark, workdir)
    store.publish({"f": store.stage_by(frame([("p", None, 1, 0), (None, "p", 1, 0), (None, None, 1, 0), ("ab", "c", 1, 0), ("a", "bc", 2, 0)]), "f", "y")})
    untouched = store.tables["f"]
    new = store.stage_by(frame([(None, "p", 1, 1), (None, None, 1, 1), ("a", "bc", 1, 1)]), "f", "y")
    after = store.upsert(new, "f", ["a", "b"], "y")
    store.publish({"f": after})
    store.audit("f")
    rows = {tuple(r) for r in store.read("f").collect()}
    assert rows == {("p", None, 1, 0), (None, "p", 1, 1), (None, None, 1, 1), ("ab", "c", 1, 0), ("a", "bc", 1, 1), ("a", "bc", 2, 0)}
    assert all(v in after.values() for k, v in untouched.items() if "2" in k)


def test_digest_tells_nulls_and_columns_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), (None, None), ("ab", "c"), ("a", "bc")], "a string, b string")
    one, two = digest("a", "b")
    assert df.select(one.alias("x")).distinct().count() == df.select(two.alias("x")).distinct().count() == 5


def test_customers_meet_orders_not_lines(spark, no_broadcast):
    T = warehouse.loader(spark, SF_SMALL)
    plan = _plan(warehouse.q_fact_star(T))
    assert plan.index("sha2(") < plan.index("Join")  # line keys are made after the joins
    found = _plan(dirty.q_fact_versions(T))
    assert found.count("hashpartitioning(customer_key") == 2  # only the versions themselves meet lines


def test_class_table_deals_rows_by_their_number(spark):
    df = spark.range(3000).selectExpr("id % 3 g", "id % 500 o", "if(id % 2 = 0, 'A', null) m")
    args = (df, ["g", "o", "m"], ["g"], "m", {"a": "A"})
    assert sorted(deduped_class_table(*args).collect()) == sorted(deduped_class_table(*args, rows=3000).collect())
    assert "REPARTITION_BY_NUM" in _plan(warehouse.q_deduped_medal_table(warehouse.loader(spark, SF_SMALL)))


def test_demo_batches_share_stored_lines_and_packed_files(spark):
    out = pipeline_demo.run_two_batches(warehouse.loader(spark, SF_SMALL))
    folder = f"{os.path.dirname(out)}/in/batch_2/athlete_events.csv"
    assert glob.glob(f"{folder}/*.csv.gz") and not glob.glob(f"{folder}/*.csv")
