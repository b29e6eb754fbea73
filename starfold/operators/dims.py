"""Type 1 dimensions: one row per business key plus a hashed surrogate key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from starfold.functions.columns import surrogate_key
from starfold.operators.cleanse import dedupe_by_key


def build_dimension(
    df: DataFrame,
    business_key: Sequence[str],
    attributes: Sequence[str],
    key_name: str,
    order_by: Sequence[str] | None = None,
    keep: str = "first",
) -> DataFrame:
    """``key_name, *business_key, *attributes`` with one row per business key.

    When a key carries several attribute combinations the survivor is chosen
    deterministically (see :func:`dedupe_by_key`), so a rebuild never invents
    a change. The key is ``xxhash64`` of the business key: identical across
    runs without any lookup of the previous dimension, hence no shuffle
    between the dimension and the fact build.
    """
    business_key = list(business_key)
    attributes = list(attributes)
    narrowed = df.select(*business_key, *attributes)
    one_per_key = dedupe_by_key(narrowed, business_key, order_by, keep)
    return one_per_key.select(
        surrogate_key(*business_key).alias(key_name), *business_key, *attributes
    )
