import os

from starfold.sources.bronze import (
    all_string_schema,
    read_batch,
    read_raw_csv,
    split_corrupt,
    stamp_batch,
    write_batch,
)


def test_corrupt_lines_are_captured_and_quarantined(spark, workdir):
    path = os.path.join(workdir, "noc.csv")
    with open(path, "w") as fh:
        fh.write('"NOC","region","notes"\n"AUS","Australia",""\n"BRA","Brazil","x","extra"\n"CAN"\n"ESP","Spain",\n')
    raw = read_raw_csv(spark, path, all_string_schema(["NOC", "region", "notes"])).cache()
    good, bad = split_corrupt(raw)
    assert sorted(r.NOC for r in good.collect()) == ["AUS", "ESP"]
    assert sorted(r.NOC for r in bad.collect()) == ["BRA", "CAN"]
    assert all(r._corrupt_record for r in bad.collect())


def test_batches_replace_only_their_partition(spark, workdir):
    out = os.path.join(workdir, "bronze")
    df = spark.createDataFrame([("a",), ("b",)], "v string")
    assert write_batch(stamp_batch(df, "f.csv", "2026-01-01"), out) == 2
    assert write_batch(stamp_batch(df.limit(1), "f.csv", "2026-01-02"), out) == 1
    assert write_batch(stamp_batch(df, "f.csv", "2026-01-02"), out) == 2  # rerun replaces the batch
    all_rows = spark.read.parquet(out)
    counts = {r[0].isoformat(): r[1] for r in all_rows.groupBy("_batch_date").count().collect()}
    assert counts == {"2026-01-01": 2, "2026-01-02": 2}
    one = read_batch(spark, out, "2026-01-01")
    assert one.count() == 2
    assert set(one.columns) >= {"v", "_ingested_at", "_source_filename", "_batch_date"}



def test_a_batch_keeps_the_types_of_its_partition_columns(spark, workdir):
    path = os.path.join(workdir, "t")
    df = spark.createDataFrame([("a", None, "01")], "v string, year int, code string")
    write_batch(df, path, "2026-01-01", ["year", "code"])
    back = read_batch(spark, path, "2026-01-01", df.schema)
    assert [(r["v"], r["year"], r["code"]) for r in back.collect()] == [("a", None, "01")]
    assert dict(back.dtypes) == {"v": "string", "year": "int", "code": "string", "_batch_date": "date"}
