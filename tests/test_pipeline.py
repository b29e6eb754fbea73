"""End-to-end: two batches into one output (Bronze -> Silver -> Gold)."""

import csv
import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from starfold.operators.analytics import totals_by_member, yearly_trend
from starfold.operators.quality import QualityError
from starfold.plans.pipeline import EVENT_COLUMNS, run_batch
from starfold.plans.pipeline import gold as published

from conftest import FIXTURES

B1, B2 = "2026-06-20", "2026-06-21"

# Synthetic athlete events: (ID, Name, Sex, Age, Height, Weight, Team, NOC, Games, Year,
# Season, City, Sport, Event, Medal)
EVENTS_1 = [
    ["1", "Ann", "f", "24", "170", "60", "Australia", "AUS", "2000 Summer", "2000", "summer", "Sydney",
     "Swimming", "Swimming 100m", "gold"],
    ["1", "Ann", "F", "24", "170", "60", "Australia", "AUS", "2000 Summer", "2000", "Summer", "Sydney",
     "Swimming", "Swimming 200m", "NA"],
    ["2", "Bo", "M", "NA", "", "N/A", "USA", "usa", "2000 Summer", "2000", "Summer", "Sydney",
     "Rowing", "Rowing Eights", "Silver"],
    ["3", "Cy", "M", "30", "180", "80", "USA", "USA", "2000 Summer", "2000", "Summer", "Sydney",
     "Rowing", "Rowing Eights", "Silver"],
    ["3", "Cy", "M", "30", "180", "80", "USA", "USA", "2000 Summer", "2000", "Summer", "Sydney",
     "Rowing", "Rowing Eights", "Silver"],  # exact duplicate
    ["4", "Di", "F", "22", "165", "55", "Germany", "GER", "2004 Summer", "2004", "Summer", "Athina",
     "Judo", "Judo Lightweight", "bronze"],
    ["", "Nobody", "F", "22", "165", "55", "Germany", "GER", "2004 Summer", "2004", "Summer", "Athina",
     "Judo", "Judo Lightweight", ""],  # null id: dropped
    ["5", "Ed", "M", "28", "175", "70", "Portugal", "POR", "2006 Winter", "2006", "WINTER", "Torino",
     "Skiing", "Slalom", ""],
]
EVENTS_2 = [
    ["6", "Fei", "F", "25", "160", "50", "Singapore", "SGP", "2008 Summer", "2008", "Summer", "Beijing",
     "Swimming", "Swimming 100m", ""],
    ["7", "Gus", "M", "27", "185", "85", "Germany", "GER", "2008 Summer", "2008", "Summer", "Beijing",
     "Judo", "Judo Lightweight", "Gold"],
    ["8", "Hu", "M", "21", "172", "66", "China", "CHN", "2008 Summer", "2008", "Summer", "Beijing",
     "Judo", "Judo Lightweight", "Silver"],
]


def write_inputs(root, batch, events):
    d = os.path.join(root, batch)
    os.makedirs(d, exist_ok=True)
    shutil.copy(os.path.join(FIXTURES, "noc", batch, "noc_regions.csv"), d)
    with open(os.path.join(d, "athlete_events.csv"), "w", newline="") as fh:
        w = csv.writer(fh, quoting=csv.QUOTE_MINIMAL)
        w.writerow(EVENT_COLUMNS)
        w.writerows(events)
    return d


def test_two_batches_accumulate_history(spark, workdir):
    ref = os.path.join(FIXTURES, "noc", "reference")
    out = os.path.join(workdir, "out")
    r1 = run_batch(spark, write_inputs(workdir, "batch_1", EVENTS_1), ref, out, B1)
    assert r1.dim_noc_mode == "initial"
    assert r1.bronze_rows["athlete_events"] == len(EVENTS_1)
    gold = lambda t: published(spark, out, t)
    assert gold("dim_noc").count() == 10
    fact1 = gold("fact_participation")
    assert fact1.count() == 6  # 8 rows - duplicate - null id
    assert gold("dim_athlete").count() == 5
    assert gold("dim_event").count() == 5
    f = {r.participation_key: r for r in fact1.collect()}
    assert all(r.noc_key is not None for r in f.values())
    trend = {r.year: r for r in yearly_trend(fact1).collect()}
    assert (trend[2000].participations, trend[2000].medals, trend[2000].gold_medals) == (4, 3, 1)
    silver = spark.read.parquet(f"{out}/silver/athlete_events")
    bo = silver.filter(F.col("athlete_id") == 2).first()
    assert (bo.age, bo.height_cm, bo.weight_kg, bo.noc_code, bo.sex) == (None, None, None, "USA", "M")
    assert silver.filter(F.col("athlete_id") == 5).first().season == "Winter"

    r2 = run_batch(spark, write_inputs(workdir, "batch_2", EVENTS_2), ref, out, B2)
    assert r2.dim_noc_mode == "merge"
    dim = gold("dim_noc")
    assert dim.count() == 19 and dim.filter("is_current").count() == 16
    expired = dim.filter(~F.col("is_current")).collect()
    assert {r.valid_to for r in expired} == {dt.date(2026, 6, 20)}
    # years of batch 1 stay in the fact (dynamic partition overwrite), 2008 added
    fact = gold("fact_participation")
    assert sorted(r.year for r in fact.select("year").distinct().collect()) == [2000, 2004, 2006, 2008]
    silver = spark.read.parquet(f"{out}/silver/athlete_events")
    sgp = silver.filter(F.col("athlete_id") == 6).first()
    assert (sgp.source_noc_code, sgp.noc_code) == ("SGP", "SGP")
    by_code = {r.noc_code: r for r in totals_by_member(fact, dim, "noc_key", ["noc_code", "region"]).collect()}
    assert by_code["GER"].gold == 1 and by_code["GER"].region == "Federal Republic of Germany"

    # same batch again: the dimension does not change
    run_batch(spark, write_inputs(workdir, "batch_2", EVENTS_2), ref, out, B2)
    assert gold("dim_noc").count() == 19


def test_uncovered_code_stops_the_batch(spark, workdir):
    ref = os.path.join(FIXTURES, "noc", "reference")
    out = os.path.join(workdir, "out")
    bad = EVENTS_1 + [["9", "Iv", "M", "20", "", "", "Japan", "JPN", "2000 Summer", "2000", "Summer", "Sydney",
                       "Judo", "Judo Lightweight", ""]]
    with pytest.raises(QualityError, match="missing from reference"):
        run_batch(spark, write_inputs(workdir, "batch_1", bad), ref, out, B1)
    assert not os.path.exists(f"{out}/gold/_versions")


def test_null_sport_gives_null_event_key(spark, workdir):
    ref = os.path.join(FIXTURES, "noc", "reference")
    out = os.path.join(workdir, "out")
    bad = EVENTS_1 + [["9", "Iv", "M", "20", "", "", "USA", "USA", "2000 Summer", "2000", "Summer", "Sydney",
                       "NA", "Judo Open", ""]]
    with pytest.raises(QualityError, match="null keys"):
        run_batch(spark, write_inputs(workdir, "batch_1", bad), ref, out, B1)


def test_incremental_batch_keeps_earlier_rows_of_its_years(spark, workdir):
    ref, out = os.path.join(FIXTURES, "noc", "reference"), os.path.join(workdir, "out")
    run_batch(spark, write_inputs(workdir, "batch_1", EVENTS_1), ref, out, B1)
    before = {r.participation_key for r in published(spark, out, "fact_participation").collect()}
    more = [["11", "Kit", "F", "20", "", "", "USA", "USA", "2000 Summer", "2000", "Summer", "Sydney", "Judo", "Judo Open", ""]]
    run_batch(spark, write_inputs(workdir, "batch_2", more), ref, out, B2, batch_mode="incremental")
    fact = published(spark, out, "fact_participation")
    after = [r.participation_key for r in fact.collect()]
    assert before < set(after) and len(after) == len(before) + 1
    for dim, key in (("dim_athlete", "athlete_key"), ("dim_games", "games_key"), ("dim_event", "event_key"), ("dim_noc", "noc_key")):
        assert fact.join(published(spark, out, dim), key, "left_anti").count() == 0
    silver = spark.read.parquet(f"{out}/silver/athlete_events")
    assert silver.count() == 7
    # the same batch again changes nothing
    run_batch(spark, write_inputs(workdir, "batch_2", more), ref, out, B2, batch_mode="incremental")
    assert sorted(r.participation_key for r in published(spark, out, "fact_participation").collect()) == sorted(after)


def test_failure_before_the_publication_leaves_the_old_version(spark, workdir, monkeypatch):
    from starfold.sources.versions import VersionedTables

    ref, out = os.path.join(FIXTURES, "noc", "reference"), os.path.join(workdir, "out")
    run_batch(spark, write_inputs(workdir, "batch_1", EVENTS_1), ref, out, B1)
    tables = ["dim_athlete", "dim_games", "dim_event", "dim_noc", "fact_participation"]
    before = {t: sorted(map(str, published(spark, out, t).collect())) for t in tables}

    def fail(self, df, table, *rest, **kw):
        if table == "fact_participation":
            raise OSError("lost")
        return stage_by(self, df, table, *rest, **kw)

    stage_by = VersionedTables.stage_by
    monkeypatch.setattr(VersionedTables, "stage_by", fail)
    with pytest.raises(OSError, match="lost"):
        run_batch(spark, write_inputs(workdir, "batch_2", EVENTS_2), ref, out, B2)
    assert {t: sorted(map(str, published(spark, out, t).collect())) for t in tables} == before


def test_unreadable_lines_are_set_aside_and_counted(spark, workdir):
    ref, out = os.path.join(FIXTURES, "noc", "reference"), os.path.join(workdir, "out")
    d = write_inputs(workdir, "batch_1", EVENTS_1)
    with open(os.path.join(d, "athlete_events.csv"), "a") as fh:
        fh.write("99,short line\n")
    r = run_batch(spark, d, ref, out, B1)
    assert r.bronze_rows["athlete_events"] == len(EVENTS_1) + 1 and r.rejected_rows["athlete_events"] == 1
    assert r.silver_rows["athlete_events"] == 6 and r.dropped_rows["athlete_events"] == 2
    bad = spark.read.parquet(f"{out}/quarantine/athlete_events").collect()
    assert [x["_corrupt_record"] for x in bad] == ["99,short line"]


def test_an_empty_batch_replaces_its_predecessor_and_stops(spark, workdir):
    ref, out = os.path.join(FIXTURES, "noc", "reference"), os.path.join(workdir, "out")
    run_batch(spark, write_inputs(workdir, "batch_1", EVENTS_1), ref, out, B1)
    with pytest.raises(QualityError, match="empty"):
        run_batch(spark, write_inputs(workdir, "batch_1", []), ref, out, B1)
    assert spark.read.parquet(f"{out}/bronze/athlete_events").count() == 0
    assert published(spark, out, "fact_participation").count() == 6


def test_rows_without_a_year_stay_in_the_next_batches(spark, workdir):
    ref, out = os.path.join(FIXTURES, "noc", "reference"), os.path.join(workdir, "out")
    row = lambda i, games, year: [str(i), f"P{i}", "F", "20", "", "", "USA", "USA", games, year, "Summer", "Sydney",
                                  "Judo", "Judo Open", ""]
    run_batch(spark, write_inputs(workdir, "batch_1", EVENTS_1 + [row(20, "Unknown A", "")]), ref, out, B1)
    run_batch(spark, write_inputs(workdir, "batch_2", [row(21, "Unknown B", "NA"), row(22, "2000 Summer", "2000")]),
              ref, out, B2, batch_mode="incremental")
    fact = published(spark, out, "fact_participation")
    games = published(spark, out, "dim_games")
    got = sorted(r.games_name for r in fact.where("year is null").join(games.select("games_key", "games_name"), "games_key").collect())
    assert got == ["Unknown A", "Unknown B"] and fact.count() == 6 + 3
    # as new truth, a batch with rows of no year replaces those of no year
    run_batch(spark, write_inputs(workdir, "batch_2", [row(23, "Unknown C", "")]), ref, out, "2026-06-22")
    assert published(spark, out, "fact_participation").where("year is null").count() == 1


def test_only_touched_buckets_and_parts_are_written_again(spark, workdir):
    from starfold.sources.versions import VersionedTables

    ref, out = os.path.join(FIXTURES, "noc", "reference"), os.path.join(workdir, "out")
    run_batch(spark, write_inputs(workdir, "batch_1", EVENTS_1), ref, out, B1)
    before = VersionedTables(spark, f"{out}/gold").tables
    again = [x for x in EVENTS_1 if x[0] in ("1", "4")]  # known members, two of them in years stored before
    changed = [[x[0], "Ann Changed" if x[0] == "1" else x[1], *x[2:]] for x in again]
    run_batch(spark, write_inputs(workdir, "batch_2", changed), ref, out, B2, batch_mode="incremental")
    after = VersionedTables(spark, f"{out}/gold").tables
    paths = lambda t: {p["path"] for held in t.values() for p in held}
    for table in ("dim_games", "dim_event"):
        assert paths(before[table]) == paths(after[table])
    moved = [k for k in before["dim_athlete"] if before["dim_athlete"][k] != after["dim_athlete"].get(k)]
    assert len(moved) == 1
    assert before["fact_participation"]['["int", "2006"]'] == after["fact_participation"]['["int", "2006"]']
    names = {r.athlete_id: r.athlete_name for r in published(spark, out, "dim_athlete").collect()}
    assert len(names) == 5 and names[1] == "Ann Changed"
    assert published(spark, out, "fact_participation").count() == 6


def test_rejected_values_are_kept_with_their_lines_and_counted(spark, workdir):
    ref, out = os.path.join(FIXTURES, "noc", "reference"), os.path.join(workdir, "out")
    bad = [["30", "Lu", "F", "old", "1m70", "NA", "USA", "USA", "2000 Summer", "2000", "Summer", "Sydney", "Judo", "Judo Open", ""],
           ["x31", "Mo", "F", "20", "", "", "USA", "USA", "2000 Summer", "2000", "Summer", "Sydney", "Judo", "Judo Open", ""]]
    r = run_batch(spark, write_inputs(workdir, "batch_1", EVENTS_1 + bad), ref, out, B1, on_malformed="null")
    assert r.rejected_values == {"Age": 1, "Height": 1, "ID": 1} and r.silver_rows["athlete_events"] == 7
    rows = spark.read.parquet(f"{out}/quarantine/athlete_events_values").collect()
    assert sorted((x["Name"], x["column_name"], x["value"], x["rule"]) for x in rows) == [
        ("Lu", "Age", "old", "int"), ("Lu", "Height", "1m70", "double"), ("Mo", "ID", "x31", "id:long")]
    r = run_batch(spark, write_inputs(workdir, "batch_1", EVENTS_1), ref, out, B1, on_malformed="null")
    assert r.rejected_values == {} and spark.read.parquet(f"{out}/quarantine/athlete_events_values").count() == 0


def test_the_ledger_reconciles_the_layers(spark, workdir):
    from starfold.plans.ledger import reconciliation

    ref, out = os.path.join(FIXTURES, "noc", "reference"), os.path.join(workdir, "out")
    d = write_inputs(workdir, "batch_1", EVENTS_1)
    with open(os.path.join(d, "athlete_events.csv"), "a") as fh:
        fh.write("99,short line\n")
    run_batch(spark, d, ref, out, B1)
    run_batch(spark, d, ref, out, B1)  # a batch run again: its last run counts
    run_batch(spark, write_inputs(workdir, "batch_2", EVENTS_2), ref, out, B2)
    got = [r.asDict() for r in reconciliation(published(spark, out, "ledger")).orderBy("batch_date").collect()]
    mapping = 1
    assert [(r["landed"], r["set_aside"], r["read"], r["silver"], r["fact"], r["stored"]) for r in got] == [
        (len(EVENTS_1) + 1 + 10 + mapping, 1, len(EVENTS_1) + 10 + mapping, 6 + 10, 6, 6),
        (len(EVENTS_2) + 16 + mapping, 0, len(EVENTS_2) + 16 + mapping, 3 + 16, 3, 9)]
    assert all(r["landed_agrees"] and r["fact_agrees"] for r in got)
    # equal numbers of rows do not hide a changed one
    changed = published(spark, out, "ledger").withColumn("sum", F.expr("if(layer = 'fact', sum + 1, sum)"))
    assert not any(r["fact_agrees"] for r in reconciliation(changed).collect())
