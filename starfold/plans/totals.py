"""Additive totals of a fact table, kept piece by piece.

The totals are a table of the same store, with one part for each piece of the
fact. A piece is never changed, so neither are its totals: a batch sums up the
pieces that it wrote, names the totals of the others again, and drops those
of pieces that are no longer named. Analyses sum the few rows of totals
instead of the fact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starfold.sources.versions import Parts, VersionedTables, part_key

PIECE = "_piece"


def maintained(store: VersionedTables, fact: Parts, table: str, keys: Sequence[str], counters: Sequence[str]) -> Parts:
    """The parts of ``table``: for each piece of ``fact``, sums of ``counters`` by ``keys``.

    Only pieces without stored totals are read. A column that an older piece
    does not have is null there, and its sum, too.
    """
    earlier = store.tables.get(table, {})
    pieces = {part_key("string", p["path"]): p for held in fact.values() for p in held if p["rows"]}
    new = [p for key, p in pieces.items() if key not in earlier]
    out = {key: earlier[key] for key in pieces if key in earlier}
    if new:
        # Rows are grouped by a piece's number, which is put back to its path in the few rows of sums.
        frames = [store.frame({"one": [p]}).withColumn(PIECE, F.lit(i)) for i, p in enumerate(new)]
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        sums = rows.groupBy(PIECE, *keys).agg(*[F.sum(c).alias(c) for c in counters])
        path = F.array(*[F.lit(p["path"]) for p in new])[F.col(PIECE)]
        out |= store.stage_by(sums.withColumn(PIECE, path), table, PIECE)
    return out


def read_totals(store: VersionedTables, table: str, keys: Sequence[str], counters: Sequence[str]) -> DataFrame | None:
    """One row for each value of ``keys``: the sums over all pieces of the published version."""
    rows = store.read(table)
    return None if rows is None else rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counters])
