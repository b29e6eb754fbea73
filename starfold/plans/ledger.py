"""A stored ledger of what each batch brought through the layers.

For each batch and layer it has the number of rows and the sum of their
hashes, read back from the files that were written, and is published with the
version that the batch made. Layers that must hold the same rows are compared
by both: what landed is what was set aside and what was read on; what Silver
has of the events is what the fact got.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starfold.functions.columns import exact_sum

TABLE = "ledger"
SCHEMA = "version long, batch_date date, layer string, source string, rows long, sum decimal(38,0)"


def counted(df: DataFrame, columns: Sequence[str], when: Sequence[Column] | None = None) -> list[tuple[int, int]]:
    """For each condition: number of rows that meet it, and the sum of the hashes of their ``columns``; one scan."""
    when = when or [F.lit(True)]
    met = [w.alias(f"w{i}") for i, w in enumerate(when)]
    hashed = df.select(F.xxhash64(*[F.col(c) for c in columns]).alias("h"), *met)
    sums = [exact_sum(F.when(F.col(f"w{i}"), F.col("h"))).alias(f"s{i}") for i in range(len(met))]
    r = hashed.agg(*[F.count_if(F.col(f"w{i}")).alias(f"n{i}") for i in range(len(met))], *sums).first()
    return [(r[f"n{i}"], int(r[f"s{i}"] or 0)) for i in range(len(when))]


def reconciliation(ledger: DataFrame) -> DataFrame:
    """One row for each batch, from its last run: rows by layer, and whether layers that must agree do.

    Columns: ``batch_date, landed, set_aside, read, silver, fact, stored,
    landed_agrees, fact_agrees``; ``stored`` counts the fact's rows after the
    batch.
    """
    last = ledger.groupBy("batch_date").agg(F.max("version").alias("version"))
    lines = ledger.join(last, ["batch_date", "version"])

    def total(column: str, layer: str, events: bool = False) -> Column:
        here = F.col("layer") == layer
        if events:
            here &= F.col("source") == "athlete_events"
        return F.sum(F.when(here, F.col(column)).otherwise(F.lit(0)))

    out = lines.groupBy("batch_date").agg(
        *[total("rows", layer).cast("long").alias(layer) for layer in ("landed", "set_aside", "read", "silver", "fact", "stored")],
        *[total("sum", layer).alias(f"sum_{layer}") for layer in ("landed", "set_aside", "read", "fact")],
        total("sum", "silver", True).alias("sum_events"), total("rows", "silver", True).alias("events"))
    landed = (F.col("landed") == F.col("set_aside") + F.col("read")) & (F.col("sum_landed") == F.col("sum_set_aside") + F.col("sum_read"))
    fact = (F.col("events") == F.col("fact")) & (F.col("sum_events") == F.col("sum_fact"))
    return out.select("batch_date", "landed", "set_aside", "read", "silver", "fact", "stored",
                      landed.alias("landed_agrees"), fact.alias("fact_agrees"))
