"""Raw batches: typed CSV scan, ingestion stamps, partitioned batch storage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starfold.session import open_writers

CORRUPT_COL = "_corrupt_record"
BATCH_COL = "_batch_date"


def all_string_schema(columns: Sequence[str], corrupt_col: str | None = CORRUPT_COL) -> StructType:
    """Every source column as a nullable string, plus the corrupt-line column,
    so raw values survive ingestion and typing happens later."""
    fields = [StructField(c, StringType(), True) for c in columns]
    if corrupt_col:
        fields.append(StructField(corrupt_col, StringType(), True))
    return StructType(fields)


# Fixed values of the sources' CSV dialect: a header that is checked against
# the schema, comma, double quotes doubled inside, lines that do not fit kept.
CSV_FORMAT = {"header": "true", "enforceSchema": "false", "sep": ",", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}


def read_raw_csv(spark: SparkSession, path: str, schema: StructType, corrupt_col: str = CORRUPT_COL,
                 dialect: dict[str, str] = CSV_FORMAT) -> DataFrame:
    """Raw text rows; a line that does not fit ``schema`` has its text in ``corrupt_col``."""
    return spark.read.options(columnNameOfCorruptRecord=corrupt_col, **dialect).csv(path, schema=schema)


def stamp_batch(df: DataFrame, source_name: str, batch_date: str) -> DataFrame:
    """Rows with the time of this load, their source's name and the batch they belong to."""
    stamps = {"_ingested_at": F.current_timestamp(), "_source_filename": F.lit(source_name),
              BATCH_COL: F.to_date(F.lit(batch_date))}
    return df.withColumns(stamps)


def batch_path(path: str, batch_date: str) -> str:
    return f"{path.rstrip('/')}/{BATCH_COL}={batch_date}"


def write_batch(df: DataFrame, path: str, batch_date: str | None = None, by: Sequence[str] = ()) -> int:
    """Write batches into their own folders of a table; other batches stay.

    With ``batch_date`` the rows are that batch, and replace its folder even
    if there are none. Without, each batch that ``df`` has rows of is
    replaced. Returns the number of rows, observed during the write. Rows are
    not shuffled by ``by``: each task writes to the folders that it has rows of.
    """
    obs = Observation("rows")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if batch_date is not None:
        out, path, mode = out.drop(BATCH_COL), batch_path(path, batch_date), "static"
    else:
        by, mode = [BATCH_COL, *by], "dynamic"
    open_writers(df.sparkSession)
    options = {"partitionOverwriteMode": mode, "compression": "zstd"}
    out.write.mode("overwrite").options(**options).partitionBy(*by).parquet(path)
    return obs.get["rows"]


def read_batch(spark: SparkSession, path: str, batch_date: str, schema: StructType | None = None) -> DataFrame:
    """One batch of a table: only its folder is listed and read.

    ``schema``: that of the rows written; without it the types of partition
    columns are guessed from the folders' names, and one with nothing but
    nulls has none.
    """
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(batch_path(path, batch_date))
    return df.withColumn(BATCH_COL, F.to_date(F.col(BATCH_COL)))


def split_corrupt(df: DataFrame, corrupt_col: str = CORRUPT_COL) -> tuple[DataFrame, DataFrame]:
    """``(clean rows, quarantined rows)`` by presence of the corrupt-line text."""
    bad = F.col(corrupt_col).isNotNull()
    return df.filter(~bad), df.filter(bad)
