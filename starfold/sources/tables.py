"""Tables stored for the length of a session."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starfold.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back as a table."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
