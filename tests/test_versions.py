"""Pieces, parts, publication, upkeep of versioned tables."""

import datetime as dt
import os
import threading

import pytest

from starfold.plans.totals import maintained, read_totals
from starfold.sources.versions import ALL, LostRows, VersionConflict, VersionedTables, part_key, totals

ROWS = "k int, t string, y int"


@pytest.fixture()
def store(spark, workdir):
    return VersionedTables(spark, os.path.join(workdir, "gold"))


def frame(spark, rows, schema=ROWS):
    return spark.createDataFrame(rows, schema)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_parts_keep_null_type_and_text_apart(spark, store):
    texts = [None, "", "null", "None", "__HIVE_DEFAULT_PARTITION__", "a/b=c %41", "vnull", "é"]
    df = frame(spark, [(i, t, 1) for i, t in enumerate(texts)])
    parts = store.stage_by(df, "f", "t")
    assert set(parts) == {part_key("string", t) for t in texts}
    store.publish({"f": parts})
    for i, t in enumerate(texts):
        assert rows_of(store.read("f", [part_key("string", t)])) == [(i, t, 1)]
    assert part_key("int", 1) != part_key("string", "1") and part_key("int", None) != part_key("string", None)
    assert part_key("boolean", True) in store.stage_by(df.selectExpr("k", "k = 0 as b"), "g", "b")


def test_totals_are_those_of_the_rows_in_any_order(spark, store):
    df = frame(spark, [(1, "a", None), (2, None, 5), (2, None, 5)])
    one, other = store.stage(df, "f"), store.stage(df.repartition(3).select("y", "t", "k"), "f")
    assert totals(one) == totals(other) and totals(one)[ALL][0] == 3
    assert totals(store.stage(df.dropDuplicates(), "f")) != totals(one)
    assert totals(store.stage(df.selectExpr("*", "cast(null as int) as added"), "f")) == totals(one)
    assert totals(store.stage(df.limit(0), "f"))[ALL] == (0, 0)


def test_upsert_writes_only_parts_that_lose_rows(spark, store):
    store.publish({"f": store.stage_by(frame(spark, [(1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "d", None), (5, "e", 3)]), "f", "y")})
    before = store.tables["f"]
    new = store.stage_by(frame(spark, [(1, "A", 1), (6, "f", 2), (4, "D", None), (7, "g", None), (8, "h", 9)]), "f", "y")
    after = store.upsert(new, "f", ["k"], "y")
    store.publish({"f": after})
    assert rows_of(store.read("f")) == rows_of(frame(spark, [(1, "A", 1), (2, "b", 1), (3, "c", 2), (6, "f", 2), (4, "D", None),
                                                             (7, "g", None), (5, "e", 3), (8, "h", 9)]))
    key = lambda y: part_key("int", y)
    assert after[key(3)] == before[key(3)] and after[key(2)][:1] == before[key(2)]
    assert before[key(1)][0] not in after[key(1)] and before[key(None)][0] not in after[key(None)]
    assert {k: v[0] for k, v in totals(after).items()} == {key(1): 2, key(2): 2, key(3): 1, key(9): 1, key(None): 2}
    store.audit("f")


def test_a_lost_row_stops_the_publication(spark, store, monkeypatch):
    store.publish({"f": store.stage_by(frame(spark, [(1, "a", 1), (2, "b", 1), (3, "c", 1)]), "f", "y")})
    new = store.stage_by(frame(spark, [(1, "A", 1)]), "f", "y")
    stage_by = VersionedTables.stage_by
    monkeypatch.setattr(VersionedTables, "stage_by", lambda self, df, *a, **k: stage_by(self, df.where("k <> 2"), *a, **k))
    with pytest.raises(LostRows, match="3 rows stored, 1 replaced, 1 staged again"):
        store.upsert(new, "f", ["k"], "y")
    changed = lambda self, df, *a, **k: stage_by(self, df.replace("b", "x"), *a, **k)  # noqa: E731  as many rows, other values
    monkeypatch.setattr(VersionedTables, "stage_by", changed)
    with pytest.raises(LostRows):
        store.upsert(new, "f", ["k"], "y")
    with pytest.raises(LostRows, match="missing"):
        store.proven("f", new, {"x": [{"path": "p"}]})


def test_an_audit_notices_damaged_files(spark, store):
    store.publish({"f": store.stage(frame(spark, [(1, "a", 1), (2, "b", 1)]), "f")})
    store.audit("f")
    path = store.tables["f"][ALL][0]["path"]
    frame(spark, [(1, "a", 1), (2, "b", 2)]).write.mode("overwrite").parquet(path)
    with pytest.raises(LostRows):
        VersionedTables(spark, store.root).audit("f")


def test_added_columns_are_kept_and_null_before(spark, store):
    store.publish({"f": store.stage_by(frame(spark, [(1, "a", 1)]), "f", "y", ranges=["k"])})
    new = store.stage_by(frame(spark, [(2, "b", 1, 0.5)], "k int, t string, y int, more double"), "f", "y", ranges=["k"])
    store.publish({"f": store.upsert(new, "f", ["k"], "y")})
    assert rows_of(store.read("f").select("k", "t", "y", "more")) == [(1, "a", 1, None), (2, "b", 1, 0.5)]
    store.publish({"f": store.compacted("f", 1)})
    assert rows_of(store.read("f").select("k", "more")) == [(1, None), (2, 0.5)]
    other = store.stage(frame(spark, [("x",)], "k string"), "f")
    with pytest.raises(ValueError, match="column k is"):
        store.frame(store.tables["f"] | other)


def test_ranges_leave_pieces_unread(spark, store):
    day = dt.date(2026, 1, 1)
    a = store.stage(frame(spark, [(1, day), (5, day)], "k int, d date"), "f", "a", ["k", "d"])
    b = store.stage(frame(spark, [(6, dt.date(2026, 2, 1))], "k int, d date"), "f", "b", ["k", "d"])
    c = store.stage(frame(spark, [(None, None)], "k int, d date"), "f", "c", ["k", "d"])
    read = lambda **w: None if (x := store.frame(a | b | c, between=w)) is None else sorted(r["k"] for r in x.collect())
    assert read(k=(4, 5)) == [1, 5] and read(k=(7, 9)) is None and read(d=(dt.date(2026, 1, 15), dt.date(2026, 3, 1))) == [6]
    assert read(unknown=(1, 2), k=(0, 10)) == [1, 5, 6]


def test_of_racing_writers_one_publishes(spark, store, monkeypatch):
    store.publish({"f": store.stage(frame(spark, [(0, "a", 1)]), "f")})
    writers = [VersionedTables(spark, store.root) for _ in range(6)]
    gate, won, lost = threading.Barrier(len(writers)), [], []
    put = VersionedTables._put

    def late(self, fs, made, target, data):
        gate.wait()
        return put(self, fs, made, target, data)

    monkeypatch.setattr(VersionedTables, "_put", late)

    def run(i):
        try:
            writers[i].publish({}, by=i)
            won.append(i)
        except VersionConflict:
            lost.append(i)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(len(writers))]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1 and len(lost) == len(writers) - 1
    now = VersionedTables(spark, store.root)
    assert now.number == 2 and now.info["by"] == won[0] and now.read("f").count() == 1
    assert sorted(os.listdir(f"{store.root}/_versions")) == [n for n in sorted(os.listdir(f"{store.root}/_versions"))
                                                             if n.endswith((".json", ".json.crc"))]


def test_collection_takes_dead_pieces_only(spark, store):
    store.publish({"f": store.stage_by(frame(spark, [(1, "a", 1), (2, "b", 2)]), "f", "y")})
    for i in range(3):  # part 2 stays the same folder, part 1 is written anew
        store.publish({"f": store.upsert(store.stage_by(frame(spark, [(1, f"a{i}", 1)]), "f", "y"), "f", ["k"], "y")})
    orphan = store.stage(frame(spark, [(9, "failed run", 1)]), "f")[ALL][0]["path"]
    held = {p["path"] for v in store.tables["f"].values() for p in v}
    assert store.collect(keep=2, retention=3600) == []  # everything is young
    gone = store.collect(keep=2, retention=-60)
    assert {os.path.basename(p) for p in gone if p.endswith(".json")} == {"00000001.json", "00000002.json"}
    assert all(os.path.exists(p) for p in held) and not os.path.exists(orphan)
    now = VersionedTables(spark, store.root)
    assert rows_of(now.read("f")) == [(1, "a2", 1), (2, "b", 2)]
    assert rows_of(VersionedTables(spark, store.root, now.number - 1).read("f")) == [(1, "a1", 1), (2, "b", 2)]
    assert store.collect(keep=2, retention=-60) == []


def test_compaction_keeps_totals(spark, store):
    for i in range(5):
        store.publish({"f": {ALL: store.tables.get("f", {}).get(ALL, []) + store.stage(frame(spark, [(i, "a", i)]), "f")[ALL]}})
    small = store.compacted("f", 3)
    assert len(small[ALL]) == 1 and totals(small) == totals(store.tables["f"])
    assert store.compacted("f", 5) == store.tables["f"]
    store.publish({"f": small})
    assert sorted(r["k"] for r in store.read("f").collect()) == [0, 1, 2, 3, 4]


def test_maintained_totals_equal_the_full_query_and_read_new_pieces_only(spark, store, monkeypatch):
    batches = [[(1, "a", 1), (2, "b", 1), (3, "c", 2), (4, "d", None)], [(1, "A", 1), (5, "e", 9)], [(6, "f", None), (5, "E", 9)]]
    frame_of = VersionedTables.frame
    for rows in batches:
        new = store.stage_by(frame(spark, [(*r, r[0] * 10) for r in rows], "k int, t string, y int, n int"), "f", "y")
        fact = store.upsert(new, "f", ["k"], "y")
        had = {p["path"] for v in store.tables.get("f", {}).values() for p in v}
        seen = []
        monkeypatch.setattr(VersionedTables, "frame", lambda self, t, *a, **k: seen.extend(
            p["path"] for v in t.values() for p in v) or frame_of(self, t, *a, **k))
        sums = maintained(store, fact, "sums", ["y"], ["n"])
        monkeypatch.setattr(VersionedTables, "frame", frame_of)
        assert seen and not set(seen) & had
        assert len(sums) == sum(len(v) for v in fact.values())
        store.publish({"f": fact, "sums": sums})
        want = rows_of(store.read("f").groupBy("y").sum("n"))
        assert rows_of(read_totals(store, "sums", ["y"], ["n"])) == want
    assert read_totals(store, "none", ["y"], ["n"]) is None
    assert maintained(store, store.tables["f"], "sums", ["y"], ["n"]) == store.tables["sums"]
