"""Exact de-duplication by progressive refinement.

Rows are grouped by the length of their normalised text, then by a hash of
its first characters, then by the SHA-256 of all of it; only rows that share
a group go on to the next level. All groups are counts and maxima (partial
before the shuffle, so a group of a third of all rows is no hot key), and no
text goes through a shuffle. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm.base import staged, table, without_ids

#: Characters that do not count when texts are compared.
BLANKS = r"[ \t\n\x0B\f\r]+"
#: Code points of the normalised text that the second level hashes.
PREFIX_CHARS = 64


def normalised(text: str | Column) -> Column:
    """The text without ASCII blanks; null is empty."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(c, F.lit("")), BLANKS, "")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                digest_all: bool = False) -> DataFrame:
    """One row for each row of ``docs``: which of the equal texts stays.

    Texts are equal when their normalised forms are. Of equal texts the row
    with the most code points in its original text stays, then the one with
    the smallest id. Null, empty and blank texts are equal to each other. Any
    further columns of ``docs`` are ignored, whatever their names. Ids are
    expected to be unique but for repeated rows, which count in
    ``group_size`` and share one decision. A row with a null id stays, as
    nothing could name it: it counts in ``group_size``, never stands for
    another row, and its ``keep_id`` is null. An empty table gives an empty
    one.

    ``digest_all`` asks for the SHA-256 of every row; otherwise full contents
    are read again and hashed only in groups that survive the first two
    levels, and ``text_sha256`` of other rows is null.

    Columns: ``doc_id, keep_id, group_size, kept, text_sha256``.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"))
    rows = rows.select("doc_id", F.length(F.coalesce("_text", F.lit(""))).cast("long").alias("points"),
                       normalised("_text").alias("norm"))
    keys = [F.octet_length("norm").cast("long").alias("size"),
            F.xxhash64(F.substring("norm", 1, PREFIX_CHARS)).alias("head")]
    digest = F.sha2(F.col("norm").cast("binary"), 256).alias("sha")
    one = staged(rows.select("doc_id", "points", *keys, *([digest] if digest_all else [])), "dedup-keys")

    def repeated(of: DataFrame, *by: str) -> DataFrame:
        return of.groupBy(*by).agg(F.count("*").alias("n")).where("n > 1").select(*by)

    level = one.join(repeated(one, "size"), "size", "left_semi")
    heads = repeated(level, "size", "head")
    if digest_all:
        last = one.join(heads, ["size", "head"], "left_semi")
    else:
        heads = staged(heads, "dedup-heads")
        again = rows.select("doc_id", "points", *keys, "norm").join(heads, ["size", "head"], "left_semi")
        last = staged(again.select("doc_id", "points", "size", "head", digest), "dedup-full")
    best = F.max(F.when(F.col("doc_id").isNotNull(), F.struct("points", (-F.col("doc_id")).alias("neg"))))
    groups = last.groupBy("sha").agg(best.alias("best"), F.count("*").alias("n")).where("n > 1")
    # Stored, so that the join below is free to split a text that very many rows share.
    groups = staged(groups.select("sha", (-F.col("best.neg")).alias("keep_id"), "n"), "dedup-groups")
    found = one if digest_all else last.select("doc_id", "sha").unionByName(
        one.join(heads, ["size", "head"], "left_anti").select("doc_id", F.lit(None).cast("string").alias("sha")))
    named = F.col("doc_id").isNotNull()
    return found.join(groups, "sha", "left").select(
        "doc_id",
        F.when(named, F.coalesce("keep_id", "doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (~named | F.coalesce(F.col("keep_id") == F.col("doc_id"), F.lit(True))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_dedup` keeps, with all their columns."""
    return without_ids(docs, exact_dedup(docs, id_col, text_col).where("not kept"), id_col)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays for it, and its digest."""
    return exact_dedup(table(spark, sf_dir, "documents"), digest_all=True)


SQL = {"op3_exact_dedup": r"""
    WITH d AS (
        SELECT doc_id, length(coalesce(text, '')) AS points,
               sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS sha
        FROM documents)
    SELECT doc_id,
           first_value(doc_id) OVER (PARTITION BY sha ORDER BY points DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY sha) AS group_size,
           first_value(doc_id) OVER (PARTITION BY sha ORDER BY points DESC, doc_id) = doc_id AS kept,
           sha AS text_sha256
    FROM d"""}
QUERIES = {"op3_exact_dedup": op3_exact_dedup}
