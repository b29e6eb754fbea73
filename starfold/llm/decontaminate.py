"""Find test items inside documents by size-partitioned MinHash containment.

Documents are partitioned by the number of their shingles, in powers of two.
A document of a partition with up to ``2**c`` shingles gets a one-permutation
MinHash signature of ``2**(c + LOAD_BITS)`` bins: the smallest hash in each
bin. Bins grow with the document, so that a short item inside a very long
text keeps its chance: with at most ``2**-LOAD_BITS`` shingles to a bin, a
shingle that a document shares with an item is the smallest of its bin with a
probability of at least ``1 - 2**-(LOAD_BITS + 1)`` on either side. An item
and a document that agree in one bin are a candidate pair. At a load of 1/8,
an item needs only eight shared shingles for a miss to be rarer than 1e-7;
items that need fewer are looked for by all their shingles instead, so
nothing rests on chance there. Candidate pairs are decided by the exact
number of distinct shingles they share.

Before hashes leave the scan, a bit mask of fixed size (128 KB) of the items'
shingles drops those that no item has; a crowded mask drops less and changes
no result. DataFrame functions only; no text goes through a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm.base import staged, table, without_ids

WORDS = 5
THRESHOLD = (4, 5)  # shared shingles / shingles of the item
LOAD_BITS = 3
MASK_BITS = 20
#: Items that need fewer shared shingles than this skip the signature.
LEAST_FOR_SIGNATURE = 8
#: What separates words: everything but letters, marks and digits.
NOT_WORD = r"[^\p{L}\p{M}\p{N}]+"


def words(text: str) -> Column:
    """Lower-cased words of a text; null gives none."""
    return F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), NOT_WORD), "")


def shingle_hashes(df: DataFrame, text: str, k: int = WORDS, short: list[int] | None = None) -> DataFrame:
    """``df`` with ``h``: sorted distinct 64-bit hashes of all runs of ``k`` words.

    A text with fewer words has its whole sequence as one; without words ``h``
    is empty. With ``short`` also ``s``: distinct hashes of all runs of each
    of these smaller numbers of words.
    """
    def runs(n: int) -> Column:
        at = F.sequence(F.lit(0), F.greatest(F.size("_w") - F.lit(n), F.lit(0)))
        return F.transform(at, lambda i: F.xxhash64(*[F.get(F.col("_w"), i + F.lit(j)) for j in range(n)]))

    none = F.array().cast("array<bigint>")
    df = df.withColumn("_w", words(text))
    df = df.withColumn("h", F.when(F.size("_w") > 0, F.sort_array(F.array_distinct(runs(k)))).otherwise(none))
    if short is not None:
        each = [F.when(F.size("_w") >= n, runs(n)).otherwise(none) for n in short]
        df = df.withColumn("s", F.array_distinct(F.concat(none, *each)))
    return df.drop("_w")


def _bins(n: Column) -> Column:
    """Bits of the bin number for a set of ``n`` shingles."""
    return (F.ceil(F.log2(F.greatest(n, F.lit(1)))) + F.lit(LOAD_BITS)).cast("int")


def _is_min(h: Column, x: Column, i: Column, bits: Column) -> Column:
    """Is the i-th of the sorted hashes the first of its bin (its leading ``bits``)?"""
    shift = F.lit(64) - bits
    right = lambda c: F.call_function("shiftrightunsigned", c, shift)
    return (i == 0) | (right(x) != right(F.get(h, i - F.lit(1))))


def _mask(shingles: DataFrame) -> Column:
    """The items' shingles as a constant array of 2**MASK_BITS bits, 64 to a number."""
    bit = F.col("h").bitwiseAND(F.lit((1 << MASK_BITS) - 1))
    rows = (shingles.select(F.shiftright(bit, 6).cast("int").alias("at"),
                            F.expr(f"shiftleft(1L, cast((h & {(1 << MASK_BITS) - 1}) & 63 as int))").alias("bit"))
            .groupBy("at").agg(F.bit_or("bit").alias("bits")).collect())  # at most 2**(MASK_BITS - 6) rows
    out = ["0"] * (1 << (MASK_BITS - 6))
    for r in rows:
        out[r["at"]] = str(r["bits"])
    return F.split(F.lit(",".join(out)), ",").cast("array<bigint>")


def containment(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                item_col: str = "item_id", item_text: str = "text", k: int = WORDS,
                threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """Pairs of a document and an item of which it holds enough shingles.

    Shingles are runs of ``k`` lower-cased words (letters, marks and digits);
    a pair is returned when ``shared / shingles of the item`` is at least
    ``threshold``. An item of fewer than ``k`` words is one shingle, its whole
    sequence, and is found wherever a document holds it. Items and documents without words, or with a null text,
    are in no pair. Rows with one id are one document (or item) with the
    shingles of all of them; a null id is in no pair. Further columns are
    ignored, whatever their names; an empty table on either side gives none.

    Columns: ``doc_id, item_id, n_item, n_shared, containment``.
    """
    num, den = threshold
    lengths = items.where(F.col(item_col).isNotNull()).select(F.size(words(item_text)).alias("n")).where(F.col("n").between(1, k - 1))
    short = sorted(r["n"] for r in lengths.distinct().collect())  # fewer than k numbers
    i = shingle_hashes(items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("_t"))
                       .where("item_id is not null"), "_t", k)
    i = i.select("item_id", F.explode("h").alias("h")).distinct()
    sizes = i.groupBy("item_id").agg(F.count("*").alias("n_item"))
    i = staged(i.join(sizes, "item_id"), "items")
    mask = _mask(i)
    low = (1 << MASK_BITS) - 1
    d = shingle_hashes(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t"))
                       .where("doc_id is not null"), "_t", k, short)
    d = d.select("doc_id", "h", "s", _bins(F.size("h")).alias("bits"))
    h, bits = F.col("h"), F.col("bits")

    def known(x: Column) -> Column:
        word = F.get(mask, F.shiftright(x.bitwiseAND(F.lit(low)), 6).cast("int"))
        return F.getbit(word, x.bitwiseAND(F.lit(63)).cast("int")) == 1

    hits = F.filter(
        F.transform(h, lambda x, n: F.when(known(x), F.struct(x.alias("h"), _is_min(h, x, n, bits).alias("low")))),
        lambda s: s.isNotNull(),
    )
    if short:  # these are never the smallest of a bin: short items are looked for by their one shingle
        hits = F.concat(hits, F.transform(F.filter("s", known), lambda x: F.struct(x.alias("h"), F.lit(False).alias("low"))))
    d = d.select("doc_id", "bits", F.explode(hits).alias("s")).select("doc_id", "bits", "s.h", "s.low")
    d = staged(d, "hits")

    # An item's signature for each size a document can have.
    sizes = F.explode(F.sequence(F.lit(LOAD_BITS), F.lit(LOAD_BITS + 31))).alias("bits")
    need = F.ceil(F.col("n_item") * F.lit(num) / F.lit(den))
    signature = (
        i.where(need >= LEAST_FOR_SIGNATURE).select("item_id", "h", sizes)
        .groupBy("item_id", "bits", F.expr("shiftrightunsigned(h, 64 - bits)").alias("bin")).agg(F.min("h").alias("h"))
    )
    candidates = d.where("low").join(signature, ["bits", "h"]).select("doc_id", "item_id").union(
        d.join(i.where(need < LEAST_FOR_SIGNATURE), "h").select("doc_id", "item_id")
    ).distinct()
    shared = (d.select("doc_id", "h").distinct().join(i, "h")
              .join(candidates, ["doc_id", "item_id"], "left_semi")
              .groupBy("doc_id", "item_id").agg(F.first("n_item").alias("n_item"), F.count("*").alias("n_shared")))
    return shared.where(F.col("n_shared") * den >= F.col("n_item") * num).select(
        "doc_id", "item_id", "n_item", "n_shared", (F.col("n_shared") / F.col("n_item")).alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    return without_ids(docs, containment(docs, items, id_col, **kw), id_col)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item it contains."""
    return containment(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = r"""SELECT {id}, list_filter(regexp_split_to_array(lower(coalesce(text, '')),
              '[^\p{{L}}\p{{M}}\p{{N}}]+'), lambda x: x <> '') AS w FROM {table}"""
_SET = r"""SELECT {id}, unnest(list_distinct(CASE WHEN len(w) >= 5
               THEN list_transform(range(1, len(w) - 3), lambda i: list_aggregate(w[i:i+4], 'string_agg', ' '))
               WHEN len(w) > 0 THEN [list_aggregate(w, 'string_agg', ' ')] ELSE [] END)) AS s
        FROM (""" + _WORDS + ")"
SQL = {"op10_decontaminate": f"""
    WITH i AS ({_SET.format(id="item_id", table="benchmark")}),
    n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id),
    few AS (SELECT DISTINCT len(w) AS k FROM ({_WORDS.format(id="item_id", table="benchmark")}) q WHERE len(w) BETWEEN 1 AND 4),
    d AS ({_SET.format(id="doc_id", table="documents")}
        UNION SELECT doc_id, unnest([list_aggregate(w[j:j+k-1], 'string_agg', ' ') for j in range(1, len(w) - k + 2)]) AS s
        FROM ({_WORDS.format(id="doc_id", table="documents")}) q, few WHERE len(w) >= k)
    SELECT doc_id, item_id, n_item, count(*) AS n_shared, count(*) / n_item AS containment
    FROM d JOIN i USING (s) JOIN n USING (item_id)
    GROUP BY doc_id, item_id, n_item HAVING count(*) * 5 >= n_item * 4"""}
QUERIES = {"op10_decontaminate": op10_decontaminate}
