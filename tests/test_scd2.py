import datetime as dt
import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starfold.operators.scd2 import (
    Scd2Spec,
    scd2_changes,
    scd2_classify,
    scd2_classify_counts,
    scd2_compare,
    scd2_from_snapshots,
    scd2_init,
    scd2_inserts,
    scd2_lifecycle,
    scd2_merge,
    scd2_status,
    scd2_timeline,
)
from starfold.plans.pipeline import NOC_SPEC, REFERENCE_COLUMNS, clean_code_mapping, transform_reference
from starfold.sources.bronze import all_string_schema, read_raw_csv, stamp_batch

from conftest import FIXTURES

B1, B2 = "2026-06-20", "2026-06-21"


def silver_noc(spark, batch, date):
    raw = read_raw_csv(spark, os.path.join(FIXTURES, "noc", batch, "noc_regions.csv"),
                       all_string_schema(REFERENCE_COLUMNS))
    mraw = read_raw_csv(spark, os.path.join(FIXTURES, "noc", "reference", "noc_code_mapping.csv"),
                        all_string_schema(["source_system", "source_noc_code", "canonical_noc_code", "reason"]))
    return transform_reference(stamp_batch(raw, "noc_regions.csv", date), clean_code_mapping(mraw))


def two_batches(spark):
    first = scd2_init(silver_noc(spark, "batch_1", B1), NOC_SPEC, B1)
    second = scd2_merge(first, silver_noc(spark, "batch_2", B2), NOC_SPEC, B2)
    return first, second


def test_goldens(spark):
    first, second = two_batches(spark)
    rows1 = first.collect()
    assert len(rows1) == 10 and all(r.is_current for r in rows1)
    assert {r.valid_to for r in rows1} == {dt.date(9999, 12, 31)}
    assert first.columns == NOC_SPEC.columns and second.columns == NOC_SPEC.columns

    cmp = {r.noc_code: r.change_type for r in scd2_compare(first, silver_noc(spark, "batch_2", B2), NOC_SPEC).collect()}
    assert sorted(k for k, v in cmp.items() if v == "UPDATE") == ["GER", "POR", "USA"]
    assert sorted(k for k, v in cmp.items() if v == "INSERT") == ["CHN", "JPN", "KOR", "NED", "SGP", "SWE"]
    assert sorted(k for k, v in cmp.items() if v == "NO_CHANGE") == ["AUS", "BRA", "CAN", "ESP", "FRA", "GBR", "ITA"]

    rows2 = second.collect()
    assert len(rows2) == 19
    expired = [r for r in rows2 if not r.is_current]
    assert sorted(r.noc_code for r in expired) == ["GER", "POR", "USA"]
    assert {r.valid_to for r in expired} == {dt.date(2026, 6, 20)}
    assert {tuple(r) for r in scd2_status(second, NOC_SPEC).collect()} == {(True, 16), (False, 3)}

    por = sorted((r.valid_from, r.valid_to) for r in rows2 if r.noc_code == "POR")
    assert por == [(dt.date(2026, 6, 20), dt.date(2026, 6, 20)), (dt.date(2026, 6, 21), dt.date(9999, 12, 31))]

    changes = {r.noc_code: (r.previous_region, r.new_region) for r in scd2_changes(second, NOC_SPEC, "region").collect()}
    assert changes == {
        "GER": ("Germany", "Federal Republic of Germany"),
        "POR": ("Portugal", "Portuguese Republic"),
        "USA": ("USA", "United States of America"),
    }
    life = scd2_lifecycle(second, NOC_SPEC, "region")
    counts = {r.change_type: r["count"] for r in scd2_classify_counts(scd2_classify(life, B2)).collect()}
    assert counts == {"INSERT": 6, "UNCHANGED": 7, "UPDATE": 3}
    ins = {r.noc_code for r in scd2_inserts(life, NOC_SPEC, B2, "region").collect()}
    assert ins == {"CHN", "JPN", "KOR", "NED", "SGP", "SWE"}
    tl = scd2_timeline(second, NOC_SPEC, ["GER", "POR", "USA"])
    assert tl.count() == 6


def test_rerun_is_noop_and_absent_keys_stay_current(spark):
    _, second = two_batches(spark)
    again = scd2_merge(second, silver_noc(spark, "batch_2", B2), NOC_SPEC, B2)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, second.collect()))
    # batch 1 only has 10 codes: merging it again closes nothing for missing codes
    # (their versions stay current) but re-opens changed regions.
    third = scd2_merge(second, silver_noc(spark, "batch_1", "2026-06-22"), NOC_SPEC, "2026-06-22")
    cur = {r.noc_code for r in third.filter("is_current").collect()}
    assert {"CHN", "JPN", "SGP"} <= cur and third.filter("is_current").count() == 16


def test_notes_only_change_is_not_a_version(spark):
    spec = NOC_SPEC
    base = spark.createDataFrame([("AAA", "R", "n1")], "noc_code string, region string, notes string")
    first = scd2_init(base, spec, B1)
    nxt = spark.createDataFrame([("AAA", "R", "n2")], "noc_code string, region string, notes string")
    assert scd2_merge(first, nxt, spec, B2).count() == 1


def _sequential(spark, spec, batches):
    dim = None
    for date, rows in batches:
        inc = spark.createDataFrame(rows, "k long, a string")
        dim = scd2_init(inc, spec, date) if dim is None else scd2_merge(dim, inc, spec, date)
    return dim


batch_strategy = st.lists(
    st.dictionaries(st.integers(0, 5), st.sampled_from(["x", "y", "z"]), min_size=1, max_size=6),
    min_size=1, max_size=4,
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batch_strategy)
def test_bulk_equals_sequential_and_invariants(spark, raw_batches):
    spec = Scd2Spec(("k",), ("a",), ("a",), key_name="vk")
    batches = [((dt.date(2026, 1, 1) + dt.timedelta(days=7 * i)).isoformat(), sorted(b.items()))
               for i, b in enumerate(raw_batches)]
    seq = _sequential(spark, spec, batches)
    snaps = spark.createDataFrame(
        [(k, a, dt.date.fromisoformat(d)) for d, rows in batches for k, a in rows], "k long, a string, b date"
    )
    bulk = scd2_from_snapshots(snaps, spec, "b")
    assert sorted(map(tuple, seq.collect())) == sorted(map(tuple, bulk.collect()))
    rows = bulk.collect()
    by_key = {}
    for r in rows:
        by_key.setdefault(r.k, []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r.valid_from)
        assert sum(r.is_current for r in versions) == 1 and versions[-1].is_current
        for a, b in zip(versions, versions[1:]):
            assert a.valid_to == b.valid_from - dt.timedelta(days=1)
            assert a.record_hash != b.record_hash
    assert bulk.filter(F.col("is_current")).count() == len(by_key)
