"""Join helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def lookup(source: DataFrame, dim: DataFrame, on: Sequence[str], take: Sequence[str]) -> DataFrame:
    """Left join ``source`` to ``dim`` on ``on`` and bring ``take`` columns.

    Rows without a match keep null in ``take``. The planner chooses the join:
    a side whose measured size is small is broadcast, and skewed partitions
    of a sort-merge join are split. For the latter ``dim`` should be read
    from storage (not aggregated in the same plan), so that nothing above its
    shuffle has to keep a key's rows together.
    """
    return source.join(dim.select(*on, *take), on=list(on), how="left")
