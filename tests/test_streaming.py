import datetime as dt
import os

import pytest

from starfold.operators.scd2 import Scd2Spec, scd2_from_snapshots
from starfold.operators.quality import QualityError
from starfold.sources.versions import VersionedTables
from starfold.streaming.scd2_stream import merge_snapshots, read_dimension, read_ledger, start_scd2_stream

SCHEMA = "k long, a string, batch_date date"


def test_stream_of_batches_builds_history(spark, workdir):
    spec = Scd2Spec(("k",), ("a",), ("a",), key_name="vk")
    src = os.path.join(workdir, "incoming")
    target = os.path.join(workdir, "dim")
    batches = [
        [(1, "x"), (2, "y")],
        [(1, "x"), (2, "z"), (3, "w")],
        [(2, "z"), (3, "v")],
    ]
    all_rows = []
    ckpt = os.path.join(workdir, "ckpt")
    for i, rows in enumerate(batches):
        d = dt.date(2026, 3, 1) + dt.timedelta(days=i)
        data = [(k, a, d) for k, a in rows]
        all_rows += data
        spark.createDataFrame(data, SCHEMA).write.mode("append").parquet(src)
        q = start_scd2_stream(spark, src, spark.createDataFrame([], SCHEMA).schema, spec, target,
                              checkpoint=ckpt)
        q.awaitTermination()
    got = sorted(map(tuple, read_dimension(spark, target).collect()))
    want = sorted(map(tuple, scd2_from_snapshots(spark.createDataFrame(all_rows, SCHEMA), spec,
                                                 "batch_date").collect()))
    assert got == want


def test_replays_change_nothing_and_faults_stop(spark, workdir):
    spec = Scd2Spec(("k",), ("a",), ("a",), key_name="vk")
    target = os.path.join(workdir, "dim")
    day = lambda n: dt.date(2026, 3, n)
    rows = [(1, "x", day(1)), (2, "y", day(1)), (1, "z", day(3)), (2, "y", day(3))]
    later = [(1, "z", day(5)), (2, "w", day(5)), (1, "q", day(6))]
    frame = lambda r: spark.createDataFrame(r, SCHEMA)
    for part in (rows, rows, later, rows + later, later):  # two dates at once, and again
        merge_snapshots(spark, frame(part), spec, target, "batch_date")
    want = sorted(map(tuple, scd2_from_snapshots(frame(rows + later), spec, "batch_date").collect()))
    read = lambda: sorted(map(tuple, read_dimension(spark, target).collect()))
    assert read() == want
    for bad in ([(1, "late", day(2))], [(1, "a", day(9)), (1, "b", day(9))], [(None, "a", day(9))]):
        with pytest.raises(QualityError):
            merge_snapshots(spark, frame(bad), spec, target, "batch_date")
    assert read() == want


def run_stream(spark, src, spec, target, ckpt, **kw):
    q = start_scd2_stream(spark, src, spark.createDataFrame([], SCHEMA).schema, spec, target, checkpoint=ckpt, **kw)
    q.awaitTermination()


def test_two_files_of_one_date_give_what_one_gives(spark, workdir):
    spec = Scd2Spec(("k",), ("a",), ("a",), key_name="vk")
    src, target, ckpt = (os.path.join(workdir, n) for n in ("incoming", "dim", "ckpt"))
    day = lambda n: dt.date(2026, 3, n)
    files = [[(1, "x", day(1)), (2, "y", day(1))], [(3, "w", day(1))],  # the first date in two files
             [(1, "z", day(2))], [(2, "q", day(2)), (4, "n", day(2)), (3, "w", day(2))], [(1, "z", day(2)), (5, "m", day(2))]]
    for rows in files:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(src)
        run_stream(spark, src, spec, target, ckpt)
    want = sorted(map(tuple, scd2_from_snapshots(spark.createDataFrame(sum(files, []), SCHEMA).distinct(), spec, "batch_date").collect()))
    read = lambda: sorted(map(tuple, read_dimension(spark, target).collect()))
    assert read() == want
    ledger = read_ledger(spark, target).collect()
    assert len(ledger) == 5 and sum(r["rows"] for r in ledger) == 9 and len({r["source"] for r in ledger}) == 5
    # A new stream without the old checkpoint reads all files again: nothing changes.
    version = VersionedTables(spark, target).number
    run_stream(spark, src, spec, target, os.path.join(workdir, "other"), files_per_batch=2)
    assert read() == want and VersionedTables(spark, target).number == version
    # A key that a second file of its date changes stops the stream.
    spark.createDataFrame([(5, "changed", day(2))], SCHEMA).coalesce(1).write.mode("append").parquet(src)
    with pytest.raises(Exception, match="not after the current versions"):
        run_stream(spark, src, spec, target, ckpt)
    assert read() == want


def test_replayed_and_altered_sources(spark, workdir):
    spec = Scd2Spec(("k",), ("a",), ("a",), key_name="vk")
    target, day = os.path.join(workdir, "dim"), dt.date(2026, 3, 1)
    frame = lambda rows: spark.createDataFrame(rows, "k long, a string, batch_date date, _source string")
    one, two = [(1, "x", day, "f1")], [(2, "y", day, "f2")]
    merge_snapshots(spark, frame(one), spec, target, "batch_date", 0)
    merge_snapshots(spark, frame(one + two), spec, target, "batch_date", 0)  # the replay brings one file more
    assert sorted(r["k"] for r in read_dimension(spark, target).collect()) == [1, 2]
    merge_snapshots(spark, frame(one + two), spec, target, "batch_date", 1)
    assert VersionedTables(spark, target).number == 2
    with pytest.raises(QualityError, match="merged with other rows"):
        merge_snapshots(spark, frame([(1, "altered", day, "f1")]), spec, target, "batch_date", 2)
    with pytest.raises(QualityError, match="without a batch date"):
        merge_snapshots(spark, frame([(3, "x", None, "f3")]), spec, target, "batch_date", 3)


def test_closed_versions_and_the_ledger_are_compacted(spark, workdir, monkeypatch):
    from starfold.streaming import scd2_stream

    monkeypatch.setattr(scd2_stream, "PIECES", 2)
    spec = Scd2Spec(("k",), ("a",), ("a",), key_name="vk")
    target = os.path.join(workdir, "dim")
    rows = [(1, f"v{i}", dt.date(2026, 3, 1 + i)) for i in range(5)]
    for r in rows:
        merge_snapshots(spark, spark.createDataFrame([r], SCHEMA), spec, target, "batch_date")
    assert all(len(v) <= 3 for t in VersionedTables(spark, target).tables.values() for v in t.values())
    want = sorted(map(tuple, scd2_from_snapshots(spark.createDataFrame(rows, SCHEMA), spec, "batch_date").collect()))
    assert sorted(map(tuple, read_dimension(spark, target).collect())) == want and read_ledger(spark, target).count() == 5
