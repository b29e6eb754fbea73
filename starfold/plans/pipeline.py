"""One batch of the medallion pipeline for athlete-event style inputs.

``run_batch`` takes three CSV sources (events, code reference, governed code
mapping), lands them in Bronze, sets lines that do not parse aside, cleans
the rest into Silver, and stages Gold: three Type 1 dimensions, the Type 2
code dimension and the participation fact. Gates run on the staged files and
on the state that would be stored; then all tables are published by one
version file, or none.

No earlier row is lost: Silver keeps each batch in a folder of its own; the
fact takes a batch either as new truth for the years it delivers
(``snapshot``) or row by row, by participation key (``incremental``); Type 1
dimensions keep members that a batch does not name, and only buckets with
changed members are written again; of the Type 2 dimension only the current
part is read and written again, closed versions are added. What is written
again must be, in number and in sum of row hashes, what was stored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.functions.columns import add_record_hash, digest
from starfold.operators import quality as Q
from starfold.operators.cleanse import clean_columns, dedupe_by_key, dedupe_staged, rejected_values, require_not_null
from starfold.operators.dims import build_dimension
from starfold.operators.facts import DimLookup, build_fact, class_counters
from starfold.operators.mapping import ambiguous_mappings, apply_mapping, clean_mapping
from starfold.operators.scd2 import Scd2Spec, scd2_init, scd2_merge
from starfold.plans import ledger
from starfold.plans.totals import maintained
from starfold.session import small_reads
from starfold.sources.bronze import CORRUPT_COL, all_string_schema, read_batch, read_raw_csv, split_corrupt, stamp_batch, write_batch
from starfold.sources.versions import ALL, Parts, VersionedTables, part_key, totals

# Fixed source layouts of the athlete-event inputs (column names as supplied).
EVENT_COLUMNS = ["ID", "Name", "Sex", "Age", "Height", "Weight", "Team", "NOC", "Games", "Year",
                 "Season", "City", "Sport", "Event", "Medal"]
REFERENCE_COLUMNS = ["NOC", "region", "notes"]
MAPPING_COLUMNS = ["source_system", "source_noc_code", "canonical_noc_code", "reason"]
EVENT_FILE = "athlete_events.csv"
REFERENCE_FILE = "noc_regions.csv"
MAPPING_FILE = "noc_code_mapping.csv"
# Source-system names used to select mapping rows.
EVENT_SYSTEM = "athlete_events"
REFERENCE_SYSTEM = "noc_regions"

EVENT_SPEC = [
    ("ID", "athlete_id", "id:long"),
    ("Name", "athlete_name", "text"),
    ("Sex", "sex", "upper"),
    ("Age", "age", "int"),
    ("Height", "height_cm", "double"),
    ("Weight", "weight_kg", "double"),
    ("Team", "team", "text"),
    ("NOC", "source_noc_code", "upper"),
    ("Games", "games_name", "text"),
    ("Year", "year", "int"),
    ("Season", "season", "title"),
    ("City", "host_city", "text"),
    ("Sport", "sport", "text"),
    ("Event", "event_name", "text"),
    ("Medal", "medal", "title"),
]
REFERENCE_SPEC = [
    ("NOC", "source_noc_code", "upper"),
    ("region", "region", "text"),
    ("notes", "notes", "text"),
]
MEDALS = {"gold_count": "Gold", "silver_count": "Silver", "bronze_count": "Bronze"}
NOC_SPEC = Scd2Spec(
    business_key=("noc_code",), attributes=("region", "notes"), tracked=("region",), key_name="noc_key"
)
#: Columns that tell participations apart: the grain and the measures.
EVENT_TELLING = ["athlete_id", "games_name", "event_name", "age", "height_cm", "weight_kg"]
#: Parts of the Type 2 dimension.
CURRENT, CLOSED = part_key("boolean", True), part_key("boolean", False)
META = ["_ingested_at", "_source_filename", "_batch_date"]


@dataclass
class Layout:
    """Paths of one pipeline output root."""

    root: str

    def bronze(self, name: str) -> str:
        return f"{self.root}/bronze/{name}"

    def silver(self, name: str) -> str:
        return f"{self.root}/silver/{name}"

    def gold(self, name: str) -> str:
        return f"{self.root}/gold/{name}"


@dataclass
class BatchReport:
    batch_date: str
    #: Rows landed, set aside as unreadable, cleaned and dropped in between, by source.
    bronze_rows: dict[str, int] = field(default_factory=dict)
    rejected_rows: dict[str, int] = field(default_factory=dict)
    silver_rows: dict[str, int] = field(default_factory=dict)
    dropped_rows: dict[str, int] = field(default_factory=dict)
    #: Values of read lines that became null because their rule could not read them, by column.
    rejected_values: dict[str, int] = field(default_factory=dict)
    #: Participation keys that occur more than once in the batch (reported, not enforced).
    repeated_keys: int = 0
    version: int = 0
    gate_counts: dict[str, int] = field(default_factory=dict)
    dim_noc_mode: str = ""


# --- Bronze ---------------------------------------------------------------


def ingest_bronze(spark: SparkSession, input_path: str, reference_path: str, out: Layout,
                  batch_date: str) -> dict[str, int]:
    """Land the three CSV sources as the batch's Bronze partitions."""
    sources = [
        ("athlete_events", f"{input_path}/{EVENT_FILE}", EVENT_COLUMNS, EVENT_FILE),
        ("noc_regions", f"{input_path}/{REFERENCE_FILE}", REFERENCE_COLUMNS, REFERENCE_FILE),
        ("reference/noc_code_mapping", f"{reference_path}/{MAPPING_FILE}", MAPPING_COLUMNS, MAPPING_FILE),
    ]
    def land(source) -> int:
        name, path, cols, fname = source
        raw = read_raw_csv(spark, path, all_string_schema(cols))
        return write_batch(stamp_batch(raw, fname, batch_date), out.bronze(name), batch_date)

    return dict(zip([x[0] for x in sources], together(land, sources), strict=True))


def together(work: Callable, items: Iterable) -> list:
    """``work`` on a few items at once: their Spark jobs do not depend on each other and share the cluster."""
    with ThreadPoolExecutor(4) as pool:
        return list(pool.map(work, items))


def readable(spark: SparkSession, out: Layout, name: str, batch_date: str, report: BatchReport) -> DataFrame:
    """A batch's Bronze rows; lines that do not parse are written to quarantine and counted."""
    good, bad = split_corrupt(read_batch(spark, out.bronze(name), batch_date))
    report.rejected_rows[name] = write_batch(bad, f"{out.root}/quarantine/{name}", batch_date)
    return good


def set_aside_values(spark: SparkSession, lines: DataFrame, out: Layout, batch_date: str) -> dict[str, int]:
    """Write each value that its rule cannot read to quarantine, with its whole line; returns their number by column."""
    path = f"{out.root}/quarantine/athlete_events_values"
    found = rejected_values(lines, EVENT_SPEC, keep=[*EVENT_COLUMNS, *META])
    if not write_batch(found, path, batch_date):
        return {}
    rows = read_batch(spark, path, batch_date, found.schema).groupBy("column_name").count().collect()  # one for each column
    return {r["column_name"]: r["count"] for r in rows}


# --- Silver ---------------------------------------------------------------


def clean_code_mapping(bronze_mapping: DataFrame) -> DataFrame:
    return clean_mapping(bronze_mapping, "source_system", "source_noc_code", "canonical_noc_code", "reason")


def map_codes(df: DataFrame, mapping: DataFrame, system: str) -> DataFrame:
    return apply_mapping(df, mapping, system, "source_noc_code", "noc_code",
                         "source_system", "source_noc_code", "canonical_noc_code")


def transform_events(bronze_events: DataFrame, mapping: DataFrame, on_malformed: str = "fail") -> DataFrame:
    """Typed, standardised, de-duplicated events with canonical codes and the
    grain hash ``source_record_hash``."""
    typed = clean_columns(bronze_events, EVENT_SPEC, on_malformed, keep=META)
    kept = dedupe_staged(require_not_null(typed, ["athlete_id", "games_name", "event_name"]), EVENT_TELLING)
    mapped = map_codes(kept, mapping, EVENT_SYSTEM)
    return add_record_hash(
        mapped, ["athlete_id", "games_name", "event_name", "team", "noc_code"], "source_record_hash"
    )


def transform_reference(bronze_ref: DataFrame, mapping: DataFrame) -> DataFrame:
    """One row per canonical code (deterministic survivor: smallest source
    code), hashed on ``region`` only, so a notes-only change is no change."""
    typed = clean_columns(bronze_ref, REFERENCE_SPEC, keep=META)
    mapped = map_codes(require_not_null(typed, ["source_noc_code"]), mapping, REFERENCE_SYSTEM)
    one = dedupe_by_key(mapped, ["noc_code"], ["source_noc_code"])
    return add_record_hash(one, ["region"], "record_hash")


def build_silver(spark: SparkSession, out: Layout, batch_date: str, report: BatchReport,
                 on_malformed: str = "fail") -> tuple[DataFrame, DataFrame]:
    """Write the batch's Silver tables and return them *read back from
    storage*, so later steps never recompute from Bronze."""
    mapping = clean_code_mapping(readable(spark, out, "reference/noc_code_mapping", batch_date, report))
    Q.enforce([Q.Check("mapping ambiguity", ambiguous_mappings(
        mapping, "source_system", "source_noc_code", "canonical_noc_code"))])
    lines = readable(spark, out, "athlete_events", batch_date, report)
    if on_malformed == "null":
        report.rejected_values = set_aside_values(spark, lines, out, batch_date)
    events = transform_events(lines, mapping, on_malformed)
    ref = transform_reference(readable(spark, out, "noc_regions", batch_date, report), mapping)
    tables = [("athlete_events", events, ["year"]), ("noc_regions", ref, [])]
    for (name, _, _), rows in zip(tables, together(lambda t: write_batch(t[1], out.silver(t[0]), batch_date, t[2]), tables), strict=True):
        report.silver_rows[name] = rows
        report.dropped_rows[name] = report.bronze_rows[name] - report.rejected_rows[name] - rows
        if not rows:
            raise Q.QualityError(f"silver_{name} is empty: 1 violation(s)")
    return (read_batch(spark, out.silver("athlete_events"), batch_date, events.schema),
            read_batch(spark, out.silver("noc_regions"), batch_date, ref.schema))


# --- Gold -----------------------------------------------------------------


def build_dims(events: DataFrame) -> dict[str, DataFrame]:
    return {
        "dim_athlete": build_dimension(events, ["athlete_id"], ["athlete_name", "sex"], "athlete_key"),
        "dim_games": build_dimension(events, ["games_name"], ["year", "season", "host_city"], "games_key"),
        "dim_event": build_dimension(events, ["sport", "event_name"], [], "event_key"),
    }


def build_participation(events: DataFrame, dims: dict[str, DataFrame], dim_noc: DataFrame) -> DataFrame:
    """Participation fact: four key lookups (current code version only),
    participation attributes and five additive counters."""
    return build_fact(
        events,
        [
            DimLookup(dims["dim_athlete"], ("athlete_id",), "athlete_key", hashed=True),
            DimLookup(dims["dim_games"], ("games_name",), "games_key"),
            DimLookup(dims["dim_event"], ("sport", "event_name"), "event_key"),
            DimLookup(dim_noc, ("noc_code",), "noc_key", current_col="is_current"),
        ],
        [
            F.col("source_record_hash").alias("participation_key"),
            "athlete_key", "games_key", "event_key", "noc_key",
            "year", "team", "age", "height_cm", "weight_kg", "medal",
            *class_counters("medal", MEDALS),
        ],
    )


def gold(spark: SparkSession, output_path: str, table: str) -> DataFrame:
    """A published Gold table."""
    df = VersionedTables(spark, Layout(output_path.rstrip("/")).gold("")).read(table)
    if df is None:
        raise ValueError(f"no table {table} has been published under {output_path}")
    return df


DIM_KEYS = {"dim_athlete": ("athlete_key", ["athlete_id"]), "dim_games": ("games_key", ["games_name"]),
            "dim_event": ("event_key", ["sport", "event_name"])}
#: Additive totals by year and code version, kept piece by piece of the fact.
TOTALS, TOTALS_KEYS = "totals_participation", ["year", "noc_key"]
COUNTERS = ["participation_count", "medal_count", *MEDALS]
#: Buckets of a Type 1 dimension; the first load decides.
DIM_BUCKETS = 8


def refresh_dimension(store: VersionedTables, members: DataFrame, table: str, keys: list[str], buckets: int) -> Parts:
    """Put a batch's members into a stored dimension, bucket by bucket of the key.

    Members that are stored as they are do not count as delivered, so only
    buckets with new or changed members are touched, and only those with
    changed ones are written again.
    """
    earlier = store.read(table)
    if earlier is not None:
        same = [members[c].eqNullSafe(earlier[c]) for c in members.columns]
        members = members.join(earlier, same, "left_anti")
    by = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    return store.upsert(store.stage_by(members, table, by, "int"), table, keys, by, "int")


def run_batch(spark: SparkSession, input_path: str, reference_path: str, output_path: str,
              batch_date: str, on_malformed: str = "fail", batch_mode: str = "snapshot",
              dim_buckets: int = DIM_BUCKETS) -> BatchReport:
    """Bronze -> Silver -> gates -> staged Gold -> gates -> one published version.

    ``batch_mode``: ``snapshot``, the batch holds all rows of the years it
    delivers (a missing year is a year, too) and replaces them;
    ``incremental``, it holds new or changed rows. ``on_malformed``: ``fail``,
    or ``null``, where each rejected value is written to quarantine with its
    column, text and rule, and counted. ``dim_buckets`` holds for the first
    load only.
    """
    if batch_mode not in ("snapshot", "incremental"):
        raise ValueError(f"batch_mode must be 'snapshot' or 'incremental', got {batch_mode!r}")
    out = Layout(output_path.rstrip("/"))
    report = BatchReport(batch_date)
    with small_reads(spark):
        report.bronze_rows = ingest_bronze(spark, input_path, reference_path, out, batch_date)
        events, ref = build_silver(spark, out, batch_date, report, on_malformed)
    report.gate_counts.update(Q.enforce([
        Q.reference_coverage(events, ref, "noc_code", table="silver_athlete_events"),
        Q.null_keys(events, ["athlete_id"], "silver_athlete_events", blank=True),
        Q.null_keys(ref, ["noc_code"], "silver_noc_regions", blank=True),
        Q.duplicate_keys(ref, ["noc_code"], "silver_noc_regions"),
    ]))

    store = VersionedTables(spark, out.gold(""))
    buckets = store.info.get("dim_buckets", dim_buckets)
    made = list(build_dims(events).items())
    staged = dict(zip([n for n, _ in made], together(
        lambda x: refresh_dimension(store, x[1], x[0], DIM_KEYS[x[0]][1], buckets), made), strict=True))
    current = store.read("dim_noc", [CURRENT])
    if current is not None:
        Q.enforce([Q.late_batch(current, ref, NOC_SPEC, batch_date, "dim_noc")])
    report.dim_noc_mode = "initial" if current is None else "merge"
    merged = scd2_init(ref, NOC_SPEC, batch_date) if current is None else scd2_merge(current, ref, NOC_SPEC, batch_date)
    parts = store.stage_by(merged, "dim_noc", NOC_SPEC.is_current)
    closed = store.tables.get("dim_noc", {}).get(CLOSED, []) + parts.get(CLOSED, [])
    staged["dim_noc"] = {CURRENT: parts[CURRENT]} | ({CLOSED: closed} if closed else {})
    dims = {name: store.frame(p) for name, p in staged.items()}

    parts = store.stage_by(build_participation(events, dims, dims["dim_noc"]), "fact_participation", "year", ranges=["year"])
    fact = store.frame(parts)  # the batch's rows; those stored before passed when they were
    if batch_mode == "incremental":
        staged["fact_participation"] = store.upsert(parts, "fact_participation", ["participation_key"], "year", ranges=["year"])
    else:
        staged["fact_participation"] = store.tables.get("fact_participation", {}) | parts
        store.proven("fact_participation", staged["fact_participation"], parts)
    gates = [
        *[Q.duplicate_keys(dims[name], [key], name) for name, (key, _) in DIM_KEYS.items()],
        *[Q.empty_table(d, name) for name, d in dims.items()],
        Q.multiple_current_versions(dims["dim_noc"], NOC_SPEC, "dim_noc"),
        Q.duplicate_keys(dims["dim_noc"], ["noc_key"], "dim_noc"),
        Q.null_keys(fact, ["athlete_key", "games_key", "event_key", "noc_key"], "fact_participation"),
        *[Q.orphan_keys(fact, dims[name], key, table="fact_participation")
          for name, key in (*((n, k) for n, (k, _) in DIM_KEYS.items()), ("dim_noc", "noc_key"))],
    ]
    # Facts of earlier batches keep their dimension rows: no key that was stored may be gone.
    for name, key in (*((n, k) for n, (k, _) in DIM_KEYS.items()), ("dim_noc", "noc_key")):
        again = _rewritten(store.tables.get(name, {}), staged[name])
        if again:
            gates.append(Q.orphan_keys(store.frame(again), dims[name], key, table=f"earlier {name}"))
    short = fact.select(*[c.alias(name) for c, name in zip(digest("participation_key"), ("key_1", "key_2"), strict=True)])
    # Nothing here depends on another: gates, report, totals and ledger look at staged files.
    passed, report.repeated_keys, staged[TOTALS], counted, layers = together(lambda look: look(), [
        lambda: Q.enforce(gates),
        lambda: Q.duplicate_keys(short, ["key_1", "key_2"], "fact_participation").violations.count(),
        lambda: maintained(store, staged["fact_participation"], TOTALS, TOTALS_KEYS, COUNTERS),
        lambda: ledger.counted(fact, ["participation_key"])[0],
        lambda: layer_lines(spark, out, batch_date, report),
    ])
    report.gate_counts.update(passed)
    stored = [v for v in totals(staged["fact_participation"]).values()]
    lines = [*layers,
             ("fact", "fact_participation", *counted),
             ("stored", "fact_participation", sum(n for n, _ in stored), sum(h for _, h in stored))]
    told = [(store.number + 1, date.fromisoformat(batch_date), layer, source, rows, Decimal(total)) for layer, source, rows, total in lines]
    told = spark.createDataFrame(told, ledger.SCHEMA).coalesce(1)
    staged[ledger.TABLE] = {ALL: store.tables.get(ledger.TABLE, {}).get(ALL, []) + store.stage(told, ledger.TABLE)[ALL]}
    report.version = store.publish(staged, last_batch=batch_date, dim_buckets=buckets)
    return report


def layer_lines(spark: SparkSession, out: Layout, batch_date: str, report: BatchReport) -> list[tuple[str, str, int, int]]:
    """Rows and sums of the batch's files by layer and source."""
    def bronze(source) -> list[tuple[str, str, int, int]]:
        name, columns = source
        whole, good = [*columns, CORRUPT_COL], F.col(CORRUPT_COL).isNull()
        landed = read_batch(spark, out.bronze(name), batch_date)
        all_of_it, read = ledger.counted(landed, whole, [F.lit(True), good])
        aside = (0, 0)
        if report.rejected_rows[name]:
            aside = ledger.counted(read_batch(spark, f"{out.root}/quarantine/{name}", batch_date, landed.schema), whole)[0]
        return [("landed", name, *all_of_it), ("read", name, *read), ("set_aside", name, *aside)]

    def silver(source) -> list[tuple[str, str, int, int]]:
        name, key = source
        return [("silver", name, *ledger.counted(read_batch(spark, out.silver(name), batch_date), key)[0])]

    steps = [(bronze, ("athlete_events", EVENT_COLUMNS)), (bronze, ("noc_regions", REFERENCE_COLUMNS)),
             (bronze, ("reference/noc_code_mapping", MAPPING_COLUMNS)),
             (silver, ("athlete_events", ["source_record_hash"])), (silver, ("noc_regions", ["record_hash"]))]
    return [line for lines in together(lambda x: x[0](x[1]), steps) for line in lines]


def _rewritten(earlier: Parts, now: Parts) -> Parts:
    """Those pieces of an earlier version that the new one does not name."""
    named = {p["path"] for held in now.values() for p in held}
    gone = {k: [p for p in held if p["path"] not in named] for k, held in earlier.items()}
    return {k: v for k, v in gone.items() if v}
