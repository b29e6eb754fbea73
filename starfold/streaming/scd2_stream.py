"""Apply arriving batch snapshots to a Type 2 dimension with Structured Streaming.

New snapshot files dropped into a folder (a batch date in any number of
files) are picked up by a file stream; every micro-batch is merged into the
stored dimension, batch dates in ascending order, and published as one
version of it together with a ledger of what was merged: for each source (a
file) and date the number of rows and the sum of their hashes. What the
ledger has is not merged again, whether a micro-batch is replayed or a file
is read by a new stream; another file of the same date is merged as if it
had come with the first. A date that arrives after a later one was merged, a
key that is repeated or changed within its date, or a null key stops the
stream before anything is published.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from starfold.operators import quality as Q
from starfold.operators.scd2 import Scd2Spec, scd2_from_snapshots, scd2_merge
from starfold.sources.versions import ALL, VersionedTables, part_key, row_hash

TABLE, LEDGER = "dimension", "ledger"
CURRENT, CLOSED = part_key("boolean", True), part_key("boolean", False)
#: The column that says which source a row came from; without it a date's rows of one call are one source.
SOURCE = "_source"
#: Pieces of closed versions or of the ledger beyond which they are put together.
PIECES = 16


def read_dimension(spark: SparkSession, target: str) -> DataFrame | None:
    """The published dimension; None before the first batch."""
    return VersionedTables(spark, target).read(TABLE)


def read_ledger(spark: SparkSession, target: str) -> DataFrame | None:
    """``batch_date, source, rows, sum, epoch`` of all that was merged; None before the first batch."""
    return VersionedTables(spark, target).read(LEDGER)


def arrivals(snapshots: DataFrame, batch_col: str) -> DataFrame:
    """``batch_date, source, rows, sum`` for each date and source; a source without a name is known by its rows' sum."""
    data = snapshots.drop(SOURCE)
    source = F.col(SOURCE) if SOURCE in snapshots.columns else F.lit(None).cast("string")
    rows = snapshots.select(F.col(batch_col).cast("date").alias("batch_date"), source.alias("source"), row_hash(data).alias("h"))
    out = rows.groupBy("batch_date", "source").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("h").cast("decimal(20,0)")).cast("string").alias("sum"))
    return out.withColumn("source", F.coalesce("source", F.concat_ws(":", F.lit("rows"), "rows", "sum")))


def merge_snapshots(spark: SparkSession, snapshots: DataFrame, spec: Scd2Spec, target: str,
                    batch_col: str, epoch: int | None = None) -> None:
    """Merge the sources and dates of ``snapshots`` that ``target``'s ledger does not have.

    ``snapshots`` may have a column ``_source``. The first load builds the
    history of all its dates at once. Later dates are merged one after the
    other, a date that has been merged last may go on: current rows are read
    and written again, closed versions are added to those that are stored.
    Only dates and sources reach the driver, as many as the call brings. A
    source whose rows of a date are not those of the ledger is an error.
    """
    store = VersionedTables(spark, target)
    found = arrivals(snapshots, batch_col)
    ledger = store.read(LEDGER)
    if ledger is not None:
        had = ledger.select("batch_date", "source", F.col("sum").alias("had"), F.col("rows").alias("had_rows"))
        found = found.join(had, ["batch_date", "source"], "left")
    else:
        found = found.withColumns({"had": F.lit(None).cast("string"), "had_rows": F.lit(None).cast("long")})
    found = found.orderBy("batch_date", "source").collect()
    changed = [r for r in found if r["had"] is not None and (r["had"], r["had_rows"]) != (r["sum"], r["rows"])]
    if changed:
        raise Q.QualityError(f"source {changed[0]['source']} of {changed[0]['batch_date']} was merged with other rows")
    new = [r for r in found if r["had"] is None]
    if not new:
        return
    if any(r["batch_date"] is None for r in new):
        raise Q.QualityError("rows without a batch date")
    dates = sorted({r["batch_date"].isoformat() for r in new})
    last = store.info.get("last_date")
    if last and dates[0] < last:
        raise Q.QualityError(f"batch {dates[0]} arrives after {last} was merged")
    date = F.col(batch_col).cast("date")
    rows = snapshots
    if SOURCE in snapshots.columns and len(new) < len(found):
        keep = spark.createDataFrame([(r["batch_date"], r["source"]) for r in new], f"_d date, {SOURCE} string")
        rows = snapshots.join(keep, (date == F.col("_d")) & (snapshots[SOURCE] == keep[SOURCE]), "left_semi")
    rows = rows.drop(SOURCE).filter(date.isin([F.to_date(F.lit(d)) for d in dates]))
    Q.enforce([Q.null_keys(rows, list(spec.business_key), TABLE),
               Q.duplicate_keys(rows, [*spec.business_key, batch_col], TABLE)])
    schema = "batch_date date, source string, rows long, sum string, epoch long"
    for done in [dates] if store.read(TABLE) is None else [[d] for d in dates]:
        current = store.read(TABLE, [CURRENT])
        if current is None:
            out = scd2_from_snapshots(rows, spec, batch_col)
        else:
            incoming = rows.filter(date == F.to_date(F.lit(done[0]))).drop(batch_col)
            # A second source of the date may add keys and repeat rows, but not change what the first one set.
            Q.enforce([Q.late_batch(current, incoming, spec, done[0], TABLE)])
            out = scd2_merge(current, incoming, spec, done[0])
        parts = store.stage_by(out, TABLE, spec.is_current)
        closed = store.tables.get(TABLE, {}).get(CLOSED, []) + parts.get(CLOSED, [])
        told = [(r["batch_date"], r["source"], r["rows"], r["sum"], epoch) for r in new if r["batch_date"].isoformat() in done]
        lines = store.tables.get(LEDGER, {}).get(ALL, []) + store.stage(spark.createDataFrame(told, schema).coalesce(1), LEDGER)[ALL]
        store.publish({TABLE: {CURRENT: parts[CURRENT]} | ({CLOSED: closed} if closed else {}), LEDGER: {ALL: lines}},
                      last_date=done[-1], last_epoch=epoch)
    if max(len(closed), len(lines)) > PIECES:
        store.publish({t: store.compacted(t, PIECES) for t in (TABLE, LEDGER)})


def start_scd2_stream(spark: SparkSession, source_dir: str, schema: StructType, spec: Scd2Spec,
                      target: str, checkpoint: str, batch_col: str = "batch_date",
                      available_now: bool = True, files_per_batch: int | None = None) -> StreamingQuery:
    """Stream Parquet snapshot files from ``source_dir`` into the dimension at
    ``target``. ``checkpoint`` records which files were read; should it be
    lost, the ledger at ``target`` keeps files from being merged twice. With
    ``available_now`` the query processes what is there and stops; otherwise
    it keeps polling."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(source_dir).withColumn(SOURCE, F.col("_metadata.file_path"))
    writer = (
        stream.writeStream.foreachBatch(
            lambda df, epoch: merge_snapshots(df.sparkSession, df, spec, target, batch_col, epoch)
        )
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
