"""Slowly changing dimension, Type 2.

A version row is ``key, *business_key, *attributes, record_hash, valid_from,
valid_to, is_current``. A new version starts when the hash of the tracked
attributes differs from the current version's; keys absent from a batch stay
current (no deletes); re-running a batch with identical data changes nothing.

Two ways to build history, giving identical results:

* :func:`scd2_merge` – incremental: one batch into an existing dimension.
  Only *current* rows meet the batch in a join; expired history is passed
  through without being shuffled, so the cost of a merge follows the number
  of live keys, not the length of history.
* :func:`scd2_from_snapshots` – bulk: many batches at once (backfill) with two
  window functions over the business key, one shuffle for all batches.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starfold.functions.columns import (
    OPEN_END_DATE,
    classify,
    date_lit,
    record_hash_expr,
    surrogate_key,
)


@dataclass(frozen=True)
class Scd2Spec:
    """Column layout of one Type 2 dimension."""

    business_key: tuple[str, ...]
    attributes: tuple[str, ...]
    tracked: tuple[str, ...]
    key_name: str = "version_key"
    hash_col: str = "record_hash"
    valid_from: str = "valid_from"
    valid_to: str = "valid_to"
    is_current: str = "is_current"

    def __post_init__(self) -> None:
        if not self.business_key:
            raise ValueError("business_key cannot be empty")
        if not self.tracked:
            raise ValueError("tracked columns cannot be empty")

    @property
    def columns(self) -> list[str]:
        return [
            self.key_name,
            *self.business_key,
            *self.attributes,
            self.hash_col,
            self.valid_from,
            self.valid_to,
            self.is_current,
        ]

    @property
    def payload(self) -> list[str]:
        """Columns supplied by a batch: business key, attributes, hash."""
        return [*self.business_key, *self.attributes, self.hash_col]


def with_hash(incoming: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Batch rows with the tracked-attribute hash (computed when absent)."""
    if spec.hash_col not in incoming.columns:
        missing = sorted(set(spec.tracked) - set(incoming.columns))
        if missing:
            raise ValueError(f"Columns missing from DataFrame: {missing}")
        incoming = incoming.withColumn(spec.hash_col, record_hash_expr(list(spec.tracked)))
    return incoming.select(*spec.payload)


def _version_key(spec: Scd2Spec) -> Column:
    """Version key: hash of business key, record hash and start date."""
    return surrogate_key(*spec.business_key, spec.hash_col, spec.valid_from)


def scd2_init(incoming: DataFrame, spec: Scd2Spec, batch_date: str) -> DataFrame:
    """First load: every batch row is current from ``batch_date`` onwards."""
    rows = with_hash(incoming, spec)
    out = (
        rows.withColumn(spec.valid_from, date_lit(batch_date))
        .withColumn(spec.valid_to, date_lit(OPEN_END_DATE))
        .withColumn(spec.is_current, F.lit(True))
    )
    return out.withColumn(spec.key_name, _version_key(spec)).select(*spec.columns)


def scd2_compare(existing: DataFrame, incoming: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Per batch row: INSERT (no current version), UPDATE (hash differs) or NO_CHANGE."""
    cur = existing.filter(F.col(spec.is_current)).select(
        *spec.business_key, F.col(spec.hash_col).alias("existing_hash")
    )
    rows = with_hash(incoming, spec)
    cmp = rows.join(cur, on=list(spec.business_key), how="left")
    change = classify(
        [
            (F.col("existing_hash").isNull(), "INSERT"),
            (F.col(spec.hash_col) != F.col("existing_hash"), "UPDATE"),
        ],
        "NO_CHANGE",
    )
    return cmp.select(*spec.payload, "existing_hash", change.alias("change_type"))


def scd2_merge(existing: DataFrame, incoming: DataFrame, spec: Scd2Spec, batch_date: str) -> DataFrame:
    """Apply one batch to an existing Type 2 dimension.

    UPDATE keys get their current row closed (``valid_to`` = day before the
    batch, ``is_current`` false) and a new current row; INSERT keys get a
    first row; everything else is returned unchanged. The batch must hold one
    row per business key.
    """
    bd = date_lit(batch_date)
    types = dict(existing.dtypes)
    current_cond = F.coalesce(F.col(spec.is_current), F.lit(False))
    cur = existing.filter(F.col(spec.is_current))
    history = existing.filter(~current_cond).select(*spec.columns)

    c = cur.select(*[F.col(x).alias("c_" + x) for x in spec.columns], F.lit(True).alias("_has_c"))
    i = with_hash(incoming, spec).select(
        *[F.col(x).alias("i_" + x) for x in spec.payload], F.lit(True).alias("_has_i")
    )
    on = reduce(lambda a, b: a & b, [c["c_" + k] == i["i_" + k] for k in spec.business_key])
    j = c.join(i, on, "full_outer")

    has_c = F.coalesce(F.col("_has_c"), F.lit(False))
    has_i = F.coalesce(F.col("_has_i"), F.lit(False))
    changed = has_c & has_i & (F.col("c_" + spec.hash_col) != F.col("i_" + spec.hash_col))

    def cast(name: str, col: Column) -> Column:
        return col.cast(types[name]).alias(name) if name in types else col.alias(name)

    kept = F.struct(
        *[cast(x, F.col("c_" + x)) for x in [spec.key_name, *spec.payload, spec.valid_from]],
        cast(spec.valid_to, F.when(changed, F.date_sub(bd, 1)).otherwise(F.col("c_" + spec.valid_to))),
        cast(spec.is_current, F.when(changed, F.lit(False)).otherwise(F.col("c_" + spec.is_current))),
    )
    fresh = F.struct(
        cast(spec.key_name, surrogate_key(*[F.col("i_" + k) for k in spec.business_key],
                                          F.col("i_" + spec.hash_col), bd)),
        *[cast(x, F.col("i_" + x)) for x in spec.payload],
        cast(spec.valid_from, bd),
        cast(spec.valid_to, date_lit(OPEN_END_DATE)),
        cast(spec.is_current, F.lit(True)),
    )
    versions = F.array(
        F.when(has_c, kept),
        F.when(has_i & (~has_c | changed), fresh),
    )
    merged = j.select(F.explode(F.filter(versions, lambda v: v.isNotNull())).alias("_v")).select("_v.*")
    return history.unionByName(merged).select(*spec.columns)


def scd2_from_snapshots(snapshots: DataFrame, spec: Scd2Spec, batch_col: str) -> DataFrame:
    """Whole history from many batches at once.

    ``snapshots`` holds one row per (business key, batch) with the batch date
    in ``batch_col``. A row opens a version when its hash differs from the
    key's previous snapshot; the version closes the day before the key's next
    version. Both windows share one partitioning and ordering, so the plan
    has a single shuffle and a single sort. A key's window holds at most one
    row per batch, so no key can pile up a third of the table in one task.
    """
    base = snapshots
    if spec.hash_col not in base.columns:
        base = base.withColumn(spec.hash_col, record_hash_expr(list(spec.tracked)))
    base = base.select(*spec.payload, F.col(batch_col).cast("date").alias(spec.valid_from))
    w = Window.partitionBy(*spec.business_key).orderBy(spec.valid_from)
    prev = F.lag(spec.hash_col).over(w)
    starts = base.withColumn("_prev_hash", prev).filter(
        F.col("_prev_hash").isNull() | (F.col("_prev_hash") != F.col(spec.hash_col))
    )
    nxt = F.lead(spec.valid_from).over(w)
    out = (
        starts.withColumn("_next_from", nxt)
        .withColumn(
            spec.valid_to,
            F.coalesce(F.date_sub(F.col("_next_from"), 1), date_lit(OPEN_END_DATE)),
        )
        .withColumn(spec.is_current, F.col("_next_from").isNull())
        .withColumn(spec.key_name, _version_key(spec))
    )
    return out.select(*spec.columns)


# --- history reports -------------------------------------------------------


def scd2_status(dim: DataFrame, spec: Scd2Spec) -> DataFrame:
    """Number of current and expired rows."""
    return dim.groupBy(spec.is_current).agg(F.count(F.lit(1)).alias("count"))


def scd2_changes(dim: DataFrame, spec: Scd2Spec, column: str) -> DataFrame:
    """Old and new value of ``column`` for each consecutive pair of versions
    where it changed (previous value present and different)."""
    w = Window.partitionBy(*spec.business_key).orderBy(spec.valid_from)
    return (
        dim.select(
            *spec.business_key,
            F.lag(column).over(w).alias(f"previous_{column}"),
            F.col(column).alias(f"new_{column}"),
            F.lag(spec.valid_from).over(w).alias("previous_valid_from"),
            F.lag(spec.valid_to).over(w).alias("previous_valid_to"),
            F.col(spec.valid_from).alias("new_valid_from"),
            F.col(spec.valid_to).alias("new_valid_to"),
            F.col(spec.is_current),
        )
        .filter(F.col(f"previous_{column}").isNotNull())
        .filter(F.col(f"previous_{column}") != F.col(f"new_{column}"))
    )


def scd2_timeline(dim: DataFrame, spec: Scd2Spec, keys: DataFrame | Sequence,
                  columns: Sequence[str] | None = None) -> DataFrame:
    """All versions of the chosen keys (a key DataFrame, or values of a
    single-column business key)."""
    cols = list(columns) if columns is not None else [
        *spec.business_key, *spec.attributes, spec.valid_from, spec.valid_to,
        spec.is_current, spec.hash_col,
    ]
    if isinstance(keys, DataFrame):
        picked = dim.join(keys.select(*spec.business_key).distinct(), list(spec.business_key), "left_semi")
    else:
        if len(spec.business_key) != 1:
            raise ValueError("a value list needs a single-column business key")
        picked = dim.filter(F.col(spec.business_key[0]).isin(list(keys)))
    return picked.select(*cols)


def scd2_lifecycle(dim: DataFrame, spec: Scd2Spec, column: str) -> DataFrame:
    """Per key: number of versions, first and latest start, current ``column``."""
    return dim.groupBy(*spec.business_key).agg(
        F.count(F.lit(1)).alias("nb_of_versions"),
        F.min(spec.valid_from).alias("first_seen"),
        F.max(spec.valid_from).alias("latest_version"),
        F.max(F.when(F.col(spec.is_current), F.col(column))).alias(f"current_{column}"),
    )


def scd2_inserts(lifecycle: DataFrame, spec: Scd2Spec, batch_date: str, column: str) -> DataFrame:
    """Keys first seen in ``batch_date`` with a single version."""
    return lifecycle.filter(F.col("nb_of_versions") == 1).filter(
        F.col("first_seen") == date_lit(batch_date)
    ).select(*spec.business_key, f"current_{column}", "first_seen")


def scd2_classify(lifecycle: DataFrame, batch_date: str) -> DataFrame:
    """UPDATE when a key has several versions, INSERT when first seen in
    ``batch_date``, UNCHANGED otherwise."""
    return lifecycle.withColumn(
        "change_type",
        classify(
            [
                (F.col("nb_of_versions") > 1, "UPDATE"),
                (F.col("first_seen") == date_lit(batch_date), "INSERT"),
            ],
            "UNCHANGED",
        ),
    )


def scd2_classify_counts(classified: DataFrame) -> DataFrame:
    """Keys per change type."""
    return classified.groupBy("change_type").agg(F.count(F.lit(1)).alias("count"))
