"""A key holding a third of the rows: results stay exact and the plan keeps
aggregation partial (map-side) so the hot key is combined before the shuffle."""

import contextlib
import io

import pandas as pd
from pyspark.sql import functions as F

from starfold.operators.analytics import totals_by_member
from starfold.operators.cleanse import dedupe_by_key


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _skewed(spark, n=30000):
    # key 0 holds a third of all rows; the rest spread over 2,000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).alias("k"),
        (F.col("id") * 7919 % 10007).alias("o"),
        F.col("id").cast("string").alias("v"),
    )


def test_dedupe_by_key_on_hot_key(spark):
    df = _skewed(spark)
    out = dedupe_by_key(df, ["k"], ["o", "v"], keep="last")
    assert "partial_max" in _plan(out)
    got = {r.k: (r.o, r.v) for r in out.collect()}
    pdf = df.toPandas().sort_values(["k", "o", "v"]).groupby("k").tail(1)
    want = {int(r.k): (int(r.o), r.v) for r in pdf.itertuples()}
    assert got == want


def test_member_totals_on_hot_key(spark):
    df = _skewed(spark).select(
        F.col("k").alias("fk"),
        F.lit(1).alias("participation_count"),
        (F.col("o") % 2).cast("int").alias("medal_count"),
        (F.col("o") % 2).cast("int").alias("gold_count"),
        F.lit(0).alias("silver_count"),
        F.lit(0).alias("bronze_count"),
    )
    dim = spark.range(0, 2001).select(F.col("id").alias("fk"), (F.col("id") % 5).alias("grp"),
                                     F.lit(True).alias("is_current"))
    out = totals_by_member(df, dim, "fk", ["grp"])
    assert "partial_sum" in _plan(out)
    got = {r.grp: (r.participations, r.gold) for r in out.collect()}
    p = df.toPandas().merge(dim.toPandas(), on="fk")
    want = {int(g): (int(x.participation_count.sum()), int(x.gold_count.sum())) for g, x in p.groupby("grp")}
    assert got == want
    assert isinstance(p, pd.DataFrame)
