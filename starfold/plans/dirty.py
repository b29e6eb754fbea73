"""Checks and cleaning over dirty input that Spark derives from the driver's tables.

The driver's tables are clean. Here a fixed rule over a row's key spoils some
values: every missing token, malformed numbers, null and blank keys, repeated
rows, incomplete mapping rows, and lines of the wrong length. So each query's
result differs from that of a broken operator.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.operators import analytics, quality
from starfold.operators.cleanse import clean_columns, dedupe_exact, rejected_values
from starfold.operators.mapping import clean_mapping
from starfold.session import scratch_path
from starfold.sources.bronze import CSV_FORMAT, all_string_schema, read_raw_csv, split_corrupt
from starfold.sources.tables import stored
from starfold.plans.warehouse import CUSTOMER_SPEC, fact_lines, stored_customer_history

# Fixed values of the spoiling rules (kept identical in the SQL).
TOKENS = ["", "NA", "N/A", "null", "NULL", "  NA "]
MALFORMED = ["12x", "--1", "1 2"]


def pick(key: str, values: list[str], otherwise: Column, every: int) -> Column:
    """The n-th of ``values`` where the key's remainder by ``every`` is n, else ``otherwise``."""
    rest = F.pmod(F.col(key), F.lit(every))
    out = reduce(lambda c, v: c.when(rest == v[0], F.lit(v[1])), list(enumerate(values))[1:], F.when(rest == 0, F.lit(values[0])))
    return out.otherwise(otherwise)


def spoilt_parts(T) -> DataFrame:
    size = F.concat(F.lit(" "), F.col("p_size").cast("string"))
    return T("part").select(F.col("p_partkey").cast("string").alias("p_partkey"),
                            pick("p_partkey", TOKENS + MALFORMED, size, 17).alias("p_size"),
                            pick("p_partkey", TOKENS, F.lower("p_brand"), 13).alias("p_brand"),
                            pick("p_partkey", TOKENS, F.upper("p_type"), 11).alias("p_type"))


PART_SPEC = [("p_partkey", "p_partkey", "id:long"), ("p_size", "p_size", "int"),
             ("p_brand", "p_brand", "upper"), ("p_type", "p_type", "title")]


def q_typed_cast(T) -> DataFrame:
    """Missing tokens and malformed numbers to null, the rest typed."""
    return clean_columns(spoilt_parts(T), PART_SPEC, "null")


def q_rejected_values(T) -> DataFrame:
    """Each malformed value with its row's key, column, text and rule."""
    return rejected_values(spoilt_parts(T), PART_SPEC, keep=["p_partkey"])


def spoilt_customers(T) -> DataFrame:
    """Customers with null and blank keys and repeated rows."""
    c = T("customer")
    key = F.when(F.pmod("c_custkey", F.lit(19)) != 0, F.col("c_custkey"))
    segment = pick("c_custkey", ["", "  "], F.col("c_mktsegment"), 23)
    rows = c.select(key.alias("c_custkey"), "c_name", segment.alias("c_mktsegment"), "c_nationkey")
    return rows.union(rows.where(F.pmod("c_nationkey", F.lit(5)) == 1))


def q_dirty_gate_summary(T) -> DataFrame:
    c = spoilt_customers(T)
    return quality.run_checks([
        quality.empty_table(c.where("c_nationkey < 0"), "nowhere"),
        quality.null_keys(c, ["c_custkey"], "customer"),
        quality.null_keys(c, ["c_name", "c_mktsegment"], "customer", blank=True),
        quality.duplicate_keys(c, ["c_custkey"], "customer"),
        quality.duplicate_keys(dedupe_exact(c), ["c_custkey"], "distinct customer"),
    ])


def q_clean_mapping(T) -> DataFrame:
    """A mapping without its incomplete rows, in normal form."""
    n = T("nation")
    return clean_mapping(n.select(
        F.when(F.col("n_nationkey") % 7 != 0, F.lit(" Customer ")).alias("source_system"),
        F.when(F.col("n_nationkey") % 5 != 0, F.concat(F.lit(" n"), "n_nationkey")).alias("source_code"),
        F.when(F.col("n_nationkey") % 3 != 0, F.lower("n_name")).alias("canonical_code"),
        F.lit(" why ").alias("reason")))


def q_corrupt_rows(T) -> DataFrame:
    """Lines of the wrong length, set aside with their text, and how many lines were read well."""
    s = T("supplier")
    spark = s.sparkSession
    path = scratch_path(spark, "raw-supplier")
    key = F.col("s_suppkey").cast("string")
    short, long = key, F.concat_ws(",", key, "s_name", F.col("s_nationkey").cast("string"), F.lit("more"))
    well = F.concat_ws(",", key, "s_name", F.col("s_nationkey").cast("string"))
    rest = F.col("s_suppkey") % 10
    s.select(F.when(rest == 3, short).when(rest == 4, long).otherwise(well).alias("value")).write.text(path)
    schema = all_string_schema(["s_suppkey", "s_name", "s_nationkey"])
    raw = read_raw_csv(spark, path, schema, dialect={**CSV_FORMAT, "header": "false", "enforceSchema": "true"})
    good, bad = split_corrupt(stored(raw, "bronze-supplier"))
    return bad.select(F.lit("rejected").alias("kind"), F.col("_corrupt_record").alias("line"), F.lit(1).cast("long").alias("rows")).union(
        good.agg(F.count("s_name").alias("rows")).select(F.lit("read"), F.lit(None).cast("string"), "rows"))


def q_fact_versions(T) -> DataFrame:
    """For each line, the customer version that the fact's key leads to."""
    customers = stored_customer_history(T)
    found = customers.select("customer_key", "valid_from", "record_hash", F.col("c_custkey").alias("member"))
    return fact_lines(T, customers).join(found, "customer_key", "left").select("line_key", "member", "valid_from", "record_hash")


def q_totals_all_versions(T) -> DataFrame:
    """Totals by customer segment over facts of all versions of a customer."""
    customers = stored_customer_history(T)
    keys = CUSTOMER_SPEC.business_key[0]
    members = customers.groupBy(keys).agg(F.max("c_mktsegment").alias("c_mktsegment"))
    return analytics.totals_by_member(fact_lines(T, customers), members, keys, ["c_mktsegment"], current_col=None)


QUERIES = {"typed_cast": q_typed_cast, "rejected_values": q_rejected_values, "dirty_gate_summary": q_dirty_gate_summary, "clean_mapping": q_clean_mapping,
           "corrupt_rows": q_corrupt_rows, "fact_versions": q_fact_versions, "totals_all_versions": q_totals_all_versions}
