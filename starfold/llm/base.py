"""What the corpus operators share: tables, staged results, label folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` under ``sf_dir``, read by Spark (any file system)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with files that outlive any executor, so that a result
    used several times is computed once and never from a lost cache.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(id_col: str | Column, parts: int) -> Column:
    """``crc32`` of the id's decimal text modulo ``parts``: a fixed split.

    A null id counts as the empty text, so the fold is never null.
    """
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(parts)


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Deal rows over the session's shuffle partitions by ``cols``."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *cols)


def without_ids(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", gone_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is none of ``gone``'s; a null id stays. Any column names may clash."""
    name = "gone"
    while name in docs.columns:
        name += "_"
    ids = gone.select(F.col(gone_col).alias(name)).distinct()
    return docs.join(ids, docs[id_col] == ids[name], "left_anti")
