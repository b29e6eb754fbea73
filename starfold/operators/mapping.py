"""Governed code mapping: clean it, check it, apply it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def clean_mapping(
    mapping: DataFrame,
    system_col: str = "source_system",
    source_col: str = "source_code",
    canonical_col: str = "canonical_code",
    reason_col: str | None = "reason",
) -> DataFrame:
    """Lower-case trimmed system, upper-case trimmed codes; drop incomplete rows."""
    cols = [
        F.lower(F.trim(F.col(system_col))).alias(system_col),
        F.upper(F.trim(F.col(source_col))).alias(source_col),
        F.upper(F.trim(F.col(canonical_col))).alias(canonical_col),
    ]
    if reason_col is not None:
        cols.append(F.trim(F.col(reason_col)).alias(reason_col))
    out = mapping.select(*cols)
    for c in (system_col, source_col, canonical_col):
        out = out.filter(F.col(c).isNotNull())
    return out


def apply_mapping(
    df: DataFrame,
    mapping: DataFrame,
    source_system: str,
    code_col: str,
    output_col: str,
    system_col: str = "source_system",
    source_col: str = "source_code",
    canonical_col: str = "canonical_code",
) -> DataFrame:
    """Add ``output_col`` = canonical code when mapped, else the source code.

    The planner chooses the join from measured sizes: a small mapping is
    broadcast, and with a large one a hot source code's partition is split.
    ``code_col`` is kept unchanged. A
    source code listed twice fans rows out, as a plain left join would:
    run :func:`ambiguous_mappings` first.
    """
    m = (
        mapping.filter(F.col(system_col) == F.lit(source_system.lower()))
        .select(F.col(source_col).alias("_map_src"), F.col(canonical_col).alias("_map_dst"))
    )
    joined = df.join(m, df[code_col] == m["_map_src"], "left")
    return joined.select(
        *[df[c] for c in df.columns],
        F.coalesce(F.col("_map_dst"), df[code_col]).alias(output_col),
    )


def ambiguous_mappings(
    mapping: DataFrame,
    system_col: str = "source_system",
    source_col: str = "source_code",
    canonical_col: str = "canonical_code",
) -> DataFrame:
    """Source codes listed more than once or mapped to several canonical codes."""
    return (
        mapping.groupBy(system_col, source_col)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct(F.col(canonical_col)).alias("n_canonical"),
        )
        .filter((F.col("n_rows") > 1) | (F.col("n_canonical") > 1))
    )
