"""Fact tables: surrogate-key lookups plus additive counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.functions.columns import flag, surrogate_key
from starfold.operators.joins import lookup
from starfold.sources.tables import stored


@dataclass(frozen=True)
class DimLookup:
    """Resolve ``key`` from ``dim`` by matching ``on`` (natural key columns
    present in both the source and the dimension).

    ``current_col`` restricts a Type 2 dimension to its current versions.
    ``hashed``: ``key`` is the hash of ``on`` and ``dim`` has one row per key
    (Type 1); then only distinct keys meet the dimension, not all rows.
    """

    dim: DataFrame
    on: tuple[str, ...]
    key: str
    current_col: str | None = None
    hashed: bool = False


def resolve_keys(source: DataFrame, lookups: Sequence[DimLookup]) -> DataFrame:
    """Add each lookup's surrogate key to ``source`` (null when unmatched).

    Left joins keep every source row, so a missing dimension member surfaces
    as a null key for the null-key gate instead of silently dropping facts.
    """
    out = source
    for lk in lookups:
        dim = lk.dim if lk.current_col is None else lk.dim.filter(F.col(lk.current_col))
        out = hashed_key(out, dim, lk.on, lk.key) if lk.hashed else lookup(out, dim, lk.on, [lk.key])
    return out


def hashed_key(source: DataFrame, dim: DataFrame, on: Sequence[str], key: str) -> DataFrame:
    """What ``lookup`` gives for a key that is the hash of ``on``: computed on the row, null where ``dim`` lacks the key.

    The source's distinct keys are compared with the dimension; those it
    lacks, normally none, are stored and looked up, so a fact is not shuffled
    for a dimension that is too large to broadcast.
    """
    on = list(on)
    lacking = stored(source.select(*on).distinct().join(dim.select(*on), on, "left_anti").dropna(subset=on), "lacking-members")
    found = source.join(lacking.withColumn("_lacking", F.lit(True)), on, "left")
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    return found.select(*[source[c] for c in source.columns if c not in on], *on,
                        F.when(whole & F.col("_lacking").isNull(), surrogate_key(*on)).alias(key))


def class_counters(
    class_col: str,
    classes: Mapping[str, str],
    total: str = "participation_count",
    any_class: str = "medal_count",
) -> list[Column]:
    """``total`` = 1, ``any_class`` = 1 when the class is present, and one
    0/1 counter per ``{output_name: class_value}``."""
    cols = [F.lit(1).alias(total), flag(F.col(class_col).isNotNull()).alias(any_class)]
    cols += [flag(F.col(class_col) == F.lit(v)).alias(name) for name, v in classes.items()]
    return cols


def build_fact(
    source: DataFrame,
    lookups: Sequence[DimLookup],
    columns: Sequence[str | Column],
) -> DataFrame:
    """Resolve all lookups then project ``columns`` (keys, attributes, counters)."""
    return resolve_keys(source, lookups).select(*columns)
