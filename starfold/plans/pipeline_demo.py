"""Two pipeline batches driven by the driver tables (end-to-end, E1/E2).

The driver tables are written as athlete-event style CSV batches:

* events: one line item = one participation (customer as athlete, nation
  code ``N<key>`` as NOC, order year as games, part type/brand as
  sport/event, return flag as medal written in lower case, no medal as
  ``NA``);
* reference: one row per nation; African nations are listed under the code
  ``A<key>`` and mapped back to ``N<key>`` by the governed mapping; batch 2
  renames European nations (an SCD2 update);
* batch 1 holds orders before 1999, batch 2 all orders.

``run_batch`` then runs twice into one output folder under the shared
checkpoint folder, and the result is read from Gold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.operators.analytics import yearly_trend
from starfold.plans.ledger import reconciliation
from starfold.plans.pipeline import EVENT_COLUMNS, EVENT_FILE, TOTALS, gold, run_batch
from starfold.plans.warehouse import source_state
from starfold.session import scratch_path, small_reads
from starfold.sources.tables import stored

# Fixed values of this demonstration (kept identical in the SQL oracle).
BATCH_1_DATE = "2026-06-20"
BATCH_2_DATE = "2026-06-21"
BATCH_1_END = "1999-01-01 00:00:00"
SPLIT_PRICE = 150_000
MAPPED_REGION = "AFRICA"
RENAMED_REGION = "EUROPE"
NO_YEAR = 7
# Lines of one packed CSV file.
CSV_LINES = 1_000_000


def _lines(T, first: F.Column) -> DataFrame:
    """Line items with order, customer and part, and whether the order is one of ``first``; stored for both batches.

    Customers meet the orders, not the lines, and lines go through the joins
    with the columns that an event needs.
    """
    li, o, c, p = T("lineitem"), T("orders"), T("customer"), T("part")
    medal = (F.when(F.col("l_returnflag") == "A", "gold").when(F.col("l_returnflag") == "R", "silver")
             .when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), "bronze")
             .otherwise("NA"))
    li = li.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", medal.alias("medal"))
    o = o.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"), first.alias("first"))
    o = o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", "year", "first", "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    p = p.select("p_partkey", "p_size", "p_type", "p_brand")
    ev = li.join(p, li.l_partkey == p.p_partkey).join(o, li.l_orderkey == o.o_orderkey)
    return stored(ev.drop("l_orderkey", "o_orderkey", "l_partkey", "p_partkey"), "event-lines")


def _events(ev: DataFrame, only: F.Column) -> DataFrame:
    ev = ev.filter(only)
    year = F.col("year").cast("string")
    cols = [
        F.col("c_custkey").cast("string"), F.col("c_name"), F.lower(F.substring("c_mktsegment", 1, 1)),
        (F.col("l_linenumber") + 20).cast("string"), F.col("l_quantity").cast("string"),
        F.col("p_size").cast("string"), F.col("c_mktsegment"), F.concat(F.lit("N"), F.col("c_nationkey")),
        F.concat(year, F.lit(" Summer")), year, F.lit("summer"), F.concat(F.lit("Host "), year),
        F.col("p_type"), F.col("p_brand"), F.col("medal"),
    ]
    return ev.select(*[c.alias(name) for c, name in zip(cols, EVENT_COLUMNS)])


def _reference(T, renamed: bool) -> DataFrame:
    n = T("nation").join(T("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    code = F.when(F.col("r_name") == MAPPED_REGION, F.concat(F.lit("A"), F.col("n_nationkey"))).otherwise(
        F.concat(F.lit("N"), F.col("n_nationkey")))
    region = F.col("n_name")
    if renamed:
        region = F.when(F.col("r_name") == RENAMED_REGION, F.concat(region, F.lit(" (EU)"))).otherwise(region)
    return n.select(code.alias("NOC"), region.alias("region"), F.col("r_name").alias("notes"))


def _mapping(T) -> DataFrame:
    n = T("nation").join(T("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return n.filter(F.col("r_name") == MAPPED_REGION).select(
        F.lit("noc_regions").alias("source_system"),
        F.concat(F.lit("A"), F.col("n_nationkey")).alias("source_noc_code"),
        F.concat(F.lit("N"), F.col("n_nationkey")).alias("canonical_noc_code"),
        F.lit("regional code").alias("reason"),
    )


def _without_year(events: DataFrame) -> DataFrame:
    """Events of customers by ``NO_YEAR`` come without a year, in games of no year."""
    none = F.pmod(F.col("ID").cast("long"), F.lit(NO_YEAR)) == 0
    return events.withColumns({"Games": F.when(none, F.lit("Unknown Summer")).otherwise(F.col("Games")),
                               "Year": F.when(none, F.lit("NA")).otherwise(F.col("Year")),
                               "City": F.when(none, F.lit("NA")).otherwise(F.col("City"))})


def _spoilt_reference(reference: DataFrame) -> DataFrame:
    """For each line of the reference one more without a code, which must be dropped."""
    return reference.union(reference.select(F.lit("N/A").alias("NOC"), "region", "notes"))


def _write_csv(df: DataFrame, folder: str, name: str) -> None:
    """A folder of packed CSV files per source (the pipeline reads ``<folder>/<name>``).

    A packed file is read by one task, so its lines are limited. Beyond level 3
    packing costs most of the time of writing and saves little.
    """
    (df.write.option("header", True).option("quote", '"').option("escape", '"')
     .option("compression", "gzip").option("zlib.compress.level", "THREE").option("maxRecordsPerFile", CSV_LINES)
     .csv(f"{folder}/{name}"))


def _move_csv(spark: SparkSession, source: str, target: str) -> None:
    """Put the files of one CSV folder into another, whose own stay."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(path(source)):
        file = status.getPath()
        if file.getName().startswith("part-") and not fs.rename(file, path(f"{target}/{file.getName()}")):
            raise OSError(f"{file.toString()} could not be moved to {target}")


def run_two_batches(T, split: bool = False, spoilt: bool = False) -> str:
    """Run both batches; return the output root.

    ``split``: each row is in one batch only; otherwise the second batch gets
    the first one's files, once they are landed, with those of the other rows.
    ``spoilt``: some rows come without a year, and the reference has lines
    without a code.
    """
    spark = T("orders").sparkSession
    root = scratch_path(spark, "pipeline-demo")
    ref_dir = f"{root}/in/reference"
    _write_csv(_mapping(T), ref_dir, "noc_code_mapping.csv")
    early = F.col("o_orderdate") < F.lit(BATCH_1_END).cast("timestamp_ntz")
    cheap = F.col("o_totalprice") < SPLIT_PRICE
    lines, first = _lines(T, cheap if split else early), F.col("first")
    rows = [(first, BATCH_1_DATE), (~first if split else ~F.coalesce(first, F.lit(False)), BATCH_2_DATE)]
    for i, (only, date) in enumerate(rows, start=1):
        in_dir = f"{root}/in/batch_{i}"
        events, reference = _events(lines, only), _reference(T, renamed=(i == 2))
        if spoilt:
            events, reference = _without_year(events), _spoilt_reference(reference)
        with small_reads(spark):
            _write_csv(events, in_dir, EVENT_FILE)
        if i == 2 and not split:
            _move_csv(spark, f"{root}/in/batch_1/{EVENT_FILE}", f"{in_dir}/{EVENT_FILE}")
        _write_csv(reference, in_dir, "noc_regions.csv")
        run_batch(spark, in_dir, ref_dir, f"{root}/out", date, batch_mode="incremental" if split else "snapshot")
    return f"{root}/out"


def q_pipeline_yearly_trend(T) -> DataFrame:
    """Yearly participation and medal trend read from the published fact."""
    return yearly_trend(gold(T("orders").sparkSession, run_two_batches(T), "fact_participation"), "year")


def q_pipeline_dim_noc(T) -> DataFrame:
    """The Type 2 code dimension after both batches (surrogate key and hash hidden)."""
    return gold(T("orders").sparkSession, run_two_batches(T), "dim_noc").drop("noc_key", "record_hash")


def q_pipeline_incremental(T) -> DataFrame:
    """Rows and medals a year after a second batch that holds only new rows, most of them of years stored before.

    The first batch has the lines of orders with a total price under
    ``SPLIT_PRICE``, the second the others.
    """
    out = run_two_batches(T, split=True)
    return yearly_trend(gold(T("orders").sparkSession, out, "fact_participation"), "year")


_SPOILT_RUNS: dict[tuple, str] = {}


def spoilt_run(T) -> str:
    """Output of the two spoilt batches; one run for each session and state of the tables serves the queries that read it."""
    key = source_state(T, "lineitem", "orders", "customer", "part", "nation", "region")
    if key not in _SPOILT_RUNS:
        _SPOILT_RUNS[key] = run_two_batches(T, split=True, spoilt=True)
    return _SPOILT_RUNS[key]


def q_pipeline_null_years(T) -> DataFrame:
    """As the incremental query, with rows that have no year in both batches: all of them stay."""
    out = spoilt_run(T)
    return yearly_trend(gold(T("orders").sparkSession, out, "fact_participation"), "year")


def q_pipeline_reconciliation(T) -> DataFrame:
    """The ledger of both batches: rows by layer, and whether layers agree in number and sum of hashes."""
    out = spoilt_run(T)
    return reconciliation(gold(T("orders").sparkSession, out, "ledger"))


def q_pipeline_maintained_trend(T) -> DataFrame:
    """The yearly trend after both batches out of the totals that each batch kept, without reading the fact."""
    out = spoilt_run(T)
    return yearly_trend(gold(T("orders").sparkSession, out, TOTALS), "year")
