"""Line de-duplication: hashes in ranges, a secondary sort, keep bitmaps.

Every line becomes a 128-bit hash of its key with its document and position;
no text goes with it. Hashes are dealt to ranges and each range is sorted by
hash, then document (largest first) and position, so that one pass over the
stream sees a key's first document before all others and drops what follows.
A key on very many lines would be one long stream in one task: such keys are
counted first (partial aggregates), decided by an aggregate of their own and
never sorted. What comes out is, for each document, a keep bitmap as
alternating run lengths. DataFrame functions only.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starfold.llm.base import staged, table

#: Characters that do not count at either end of a line.
BLANKS = " \t\n\x0b\f\r"
#: Code points that a key must have, and documents that must hold it, before its lines go.
MIN_CHARS, MIN_DOCS = 40, 5
#: Keys of more lines than this are decided by an aggregate instead of a sorted stream; the result is the same.
STREAM_LINES = 2_000


def lines_of(text: str | Column) -> Column:
    """The text cut at line feeds; null or empty is one empty line."""
    c = F.col(text) if isinstance(text, str) else text
    return F.split(F.coalesce(c, F.lit("")), "\n", -1)


def line_key(line: str | Column) -> Column:
    """The line without ASCII blanks at its ends, A-Z in lower case (other letters as they are)."""
    c = F.btrim(F.col(line) if isinstance(line, str) else line, F.lit(BLANKS))
    plain = F.octet_length(c) == F.length(c)  # in ASCII, lower() changes A-Z only, and is faster
    return F.when(plain, F.lower(c)).otherwise(F.translate(c, string.ascii_uppercase, string.ascii_lowercase))


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.withColumn("digest", F.xxhash64(F.coalesce("text", F.lit(""))))


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, digest, pos, h1, h2`` for each line whose key has ``min_chars`` code points or more.

    ``digest`` tells rows of one id with different texts apart; ``pos``
    counts a text's lines from 0.
    """
    rows = _documents(docs, id_col, text_col)
    rows = rows.select("doc_id", "digest", F.posexplode(lines_of("text")).alias("pos", "line"))
    # No key is longer than its line: short lines go before their keys are made.
    rows = rows.where(F.length("line") >= min_chars).select("doc_id", "digest", "pos", line_key("line").alias("key"))
    return rows.where(F.length("key") >= min_chars).select(
        "doc_id", "digest", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def repeated_lines(lines: DataFrame, min_docs: int = MIN_DOCS, stream_lines: int = STREAM_LINES) -> DataFrame:
    """``doc_id, digest, pos`` of the lines that go, from a stored table of :func:`line_hashes`.

    A key held by ``min_docs`` documents or more keeps its lines only in the
    largest id that holds it. Rows of one id are one document; null ids
    together are one document, below all others.
    """
    n = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = staged(lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") > stream_lines)
                  .select("h1", "h2"), "line-many")
    # Keys of few lines: ranges of hashes, sorted by document and position within.
    few = lines.join(many, ["h1", "h2"], "left_anti").repartitionByRange(n, "h1", "h2")
    order = [F.col("doc_id").desc_nulls_last(), F.col("pos")]
    few = few.sortWithinPartitions("h1", "h2", *order)
    key = Window.partitionBy("h1", "h2")
    few = few.select("doc_id", "digest", "pos", "h1", "h2", F.dense_rank().over(key.orderBy(order[0])).alias("nth"))
    few = few.withColumn("docs", F.max("nth").over(key)).where((F.col("nth") > 1) & (F.col("docs") >= min_docs))
    # Keys of many lines: one row for each document, then partial counts.
    held = lines.join(many, ["h1", "h2"], "left_semi").groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
    held = held.groupBy("h1", "h2").agg(F.sum("one").alias("docs"), F.max("doc_id").alias("last"))
    held = staged(held.where(F.col("docs") >= min_docs), "line-held")
    lot = lines.join(held, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("last")))
    return few.select("doc_id", "digest", "pos").union(lot.select("doc_id", "digest", "pos"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                 min_docs: int = MIN_DOCS, stream_lines: int = STREAM_LINES) -> DataFrame:
    """``doc_id, digest, gone, n_dropped`` for each document that loses lines.

    ``gone`` is the keep bitmap, compressed to alternating run lengths: so
    many lines stay, so many go, so many stay, ... ; the lines after the last
    run stay. Null, empty and blank texts lose nothing; an empty table gives
    an empty one; further columns of ``docs`` are ignored, whatever their
    names.
    """
    lines = staged(line_hashes(docs, id_col, text_col, min_chars), "line-hashes")
    gone = repeated_lines(lines, min_docs, stream_lines)
    gone = gone.groupBy("doc_id", "digest").agg(F.sort_array(F.collect_set("pos")).alias("at"))  # one text's lines
    before = lambda a, i: F.when(i == 0, F.lit(-1)).otherwise(F.get(a, i - 1))
    first = F.filter("at", lambda p, i: (i == 0) | (F.get("at", i - 1) != p - 1))
    last = F.filter("at", lambda p, i: (i == F.size("at") - 1) | (F.get("at", i + 1) != p + 1))
    gone = gone.select("doc_id", "digest", first.alias("first"), last.alias("last"), F.size("at").alias("n_dropped"))
    runs = F.transform("first", lambda p, i: F.array(p - before(F.col("last"), i) - 1, F.get("last", i) - p + 1))
    return gone.select("doc_id", "digest", F.flatten(runs).alias("gone"), F.col("n_dropped").cast("long"))


def kept_text(text: str | Column, gone: str | Column) -> Column:
    """The lines that a keep bitmap leaves, joined by line feeds; a null bitmap leaves all."""
    t, g = (F.col(c) if isinstance(c, str) else c for c in (text, gone))
    lines = lines_of(t)
    # Where each run of kept lines begins: after all runs before it.
    begin = lambda i: F.aggregate(F.slice(g, 1, i), F.lit(0), lambda a, x: a + x)
    runs = F.transform(F.sequence(F.lit(0), F.size(g), F.lit(2)), lambda i: F.slice(
        lines, begin(i) + 1, F.coalesce(F.get(g, i), F.size(lines))))
    return F.when(g.isNull(), F.coalesce(t, F.lit(""))).otherwise(F.array_join(F.flatten(runs), "\n"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
               min_docs: int = MIN_DOCS, stream_lines: int = STREAM_LINES) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, n_lines, n_dropped, gone, kept``.

    ``gone`` is the keep bitmap of :func:`keep_bitmaps` (null where all lines
    stay), ``kept`` the text that it leaves (empty for a null text). Repeated
    rows get the same answer each.
    """
    maps = staged(keep_bitmaps(docs, id_col, text_col, min_chars, min_docs, stream_lines), "line-bitmaps")
    rows = _documents(docs, id_col, text_col)
    same = rows["doc_id"].eqNullSafe(maps["doc_id"]) & (rows["digest"] == maps["digest"])
    return rows.join(maps, same, "left").select(
        rows["doc_id"], F.size(lines_of("text")).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "gone", kept_text("text", "gone").alias("kept"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its number of lines, of dropped ones, and the digest of what stays."""
    return line_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


SQL = {"op12_line_dedup": r"""
    WITH cut AS (
        SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    l AS (
        SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM cut),
    k AS (
        SELECT doc_id, pos, line,
               translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
        FROM l),
    g AS (
        SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40
        GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
    j AS (
        SELECT k.doc_id, pos, line, g.last IS NOT NULL AND k.doc_id <> g.last AS gone
        FROM k LEFT JOIN g ON k.key = g.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM j GROUP BY doc_id"""}
QUERIES = {"op12_line_dedup": op12_line_dedup}
