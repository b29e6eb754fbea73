"""Raw CSV batch round trip on a driver table: source file -> Bronze -> typed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.operators.cleanse import clean_columns
from starfold.session import scratch_path
from starfold.sources.bronze import (
    all_string_schema,
    read_batch,
    read_raw_csv,
    split_corrupt,
    stamp_batch,
    write_batch,
)

CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
CUSTOMER_TYPES = [
    ("c_custkey", "c_custkey", "id:long"),
    ("c_name", "c_name", "text"),
    ("c_nationkey", "c_nationkey", "int"),
    ("c_acctbal", "c_acctbal", "double"),
    ("c_mktsegment", "c_mktsegment", "upper"),
]
BATCH = "2026-01-01"


def customer_roundtrip(T) -> DataFrame:
    """Write ``customer`` as a CSV source file, ingest it as one Bronze batch,
    read that batch back (partition pruned) and type it. Files go to the
    shared checkpoint folder, never to a machine-local directory."""
    src = T("customer")
    spark = src.sparkSession
    raw_dir = scratch_path(spark, "raw-customer")
    bronze_dir = scratch_path(spark, "bronze-customer")
    (src.select(*[F.col(c).cast("string") for c in CUSTOMER_COLUMNS])
     .write.option("header", True).option("quote", '"').option("escape", '"').csv(raw_dir))
    raw = read_raw_csv(spark, raw_dir, all_string_schema(CUSTOMER_COLUMNS))
    write_batch(stamp_batch(raw, "customer.csv", BATCH), bronze_dir, BATCH)
    good, _quarantine = split_corrupt(read_batch(spark, bronze_dir, BATCH))
    return clean_columns(good, CUSTOMER_TYPES)
