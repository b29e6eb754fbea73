"""Hard-negative mining: angular triangle filtering before integer scores.

Every row stores its angles to a few reference directions and its norm. For
an anchor and a row, each direction bounds the angle between the two from
both sides (the triangle inequality on the sphere); the tightest interval of
cosines, times both norms and widened for rounding, holds their score. Only
rows whose interval reaches a window that is asked for get an integer score.

Rows are dealt evenly into blocks by a hash of their id. An anchor goes to
every block; a task holds one block at a time and lets the anchors stream
past it, and sends on the few best rows of each. Neither the rows nor the
anchors are ever together in one task or on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starfold.llm.base import staged, table
from starfold.llm.vectors import integers, packed, padded, unpacked, usable, width

SCALE, POSITIVES, NEGATIVES = 256, 5, 5
#: Scores of negatives, in hundredths of the positive's score.
LOW, HIGH = 80, 100
#: Reference directions, chosen from a sample of so many rows (by a hash of their id).
REFERENCES, SAMPLE = 16, 2_048
#: A block holds so many bytes of vectors at most, and is not cut below so many rows.
BLOCK_BYTES, BLOCK_ROWS = 1 << 25, 512
#: Angles are right to this; it covers the arc cosine's error next to 1.
ANGLE_ERROR = 1e-6


def references(sample: np.ndarray, n: int = REFERENCES) -> np.ndarray:
    """Unit directions out of a sample of vectors, each the one farthest from those before it."""
    x = sample[np.any(sample != 0, axis=1)].astype(np.float64)
    x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
    chosen: list[int] = []
    near = np.full(len(x), -2.0)  # the largest cosine to a chosen direction
    while len(chosen) < min(n, len(x)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, x @ x[chosen[-1]])
        if near.min() > 1 - 1e-9:  # nothing but copies of the chosen ones is left
            break
    return x[chosen]


def angles(q: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angles of the rows to each direction, and the rows' norms."""
    x = q.astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    cosine = (x @ directions.T) / np.where(norm, norm, 1)[:, None]
    return np.arccos(np.clip(cosine, -1, 1)), norm


def bounds(anchor_angles: np.ndarray, anchor_norm: float, row_angles: np.ndarray,
           row_norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of an anchor's integer scores with rows (``row_angles``: directions x rows)."""
    least, most = np.zeros(len(row_norm)), np.full(len(row_norm), np.pi)
    if len(anchor_angles):
        least = np.abs(row_angles - anchor_angles[:, None]).max(axis=0)
        both = row_angles + anchor_angles[:, None]
        most = np.minimum(both, 2 * np.pi - both).min(axis=0)
    size = row_norm * anchor_norm
    high = size * np.cos(np.maximum(least - 2 * ANGLE_ERROR, 0))
    low = size * np.cos(np.minimum(most + 2 * ANGLE_ERROR, np.pi))
    slack = size * 1e-9 + 1
    return np.floor(low - slack), np.ceil(high + slack)


class Block:
    """The rows of one block, or a run of anchors."""

    def __init__(self, parts: list[pa.RecordBatch], dim: int, many: int):
        b = pa.Table.from_batches(parts).combine_chunks()
        col = lambda name: b.column(name).combine_chunks() if b.num_rows else b.column(name)
        self.id = b.column("vec_id").to_numpy()
        self.labels = b.column("label").to_pylist()
        self.q = unpacked(col("q"), dim)
        self.angles = unpacked(col("angles"), many, np.float64)
        self.norm = b.column("norm").to_numpy()

    def ready(self) -> Block:
        """Prepared for scoring: labels as numbers, angles by direction, vectors as floats where those are exact."""
        self.code_of = {v: i for i, v in enumerate(dict.fromkeys(self.labels))}
        code = np.array([self.code_of[v] for v in self.labels], np.int64)
        self.rows_of = [np.flatnonzero(code == i) for i in range(len(self.code_of))]
        self.code, self.by_direction = code, np.ascontiguousarray(self.angles.T)
        self.largest = int(np.abs(self.q).max(initial=0))
        self.exact = self.q.astype(np.float64)
        self.whole = None
        return self

    def scores(self, rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Integer inner products of an anchor with some rows."""
        if self.largest * int(np.abs(anchor).max(initial=0)) * len(anchor) < 1 << 53:  # every sum is a whole float
            return (self.exact[rows] @ anchor.astype(np.float64)).astype(np.int64)
        if self.whole is None:
            self.whole = self.q.astype(np.int64)
        return self.whole[rows] @ anchor.astype(np.int64)


def _first(rows: np.ndarray, score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Positions of the first ``n`` by falling score, then rising id."""
    if len(rows) > 4 * n:
        cut = np.partition(score, len(score) - n)[len(score) - n]
        some = np.flatnonzero(score >= cut)
    else:
        some = np.arange(len(rows))
    return some[np.lexsort((ids[rows[some]], -score[some]))[:n]]


def best_of_label(block: Block, anchors: Block, i: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the first ``n`` rows of the anchor's label in the block, itself apart."""
    code = block.code_of.get(anchors.labels[i])
    rows = block.rows_of[code] if code is not None else np.zeros(0, np.int64)
    rows = rows[block.id[rows] != anchors.id[i]]
    if len(rows) > n:
        _, high = bounds(anchors.angles[i], anchors.norm[i], block.by_direction[:, rows], block.norm[rows])
        some = np.argpartition(-high, n)[:n]
        least = block.scores(rows[some], anchors.q[i]).min()
        rows = rows[high >= least]  # no other row can be among the first
    score = block.scores(rows, anchors.q[i])
    pick = _first(rows, score, block.id, n)
    return block.id[rows[pick]], score[pick]


def best_in_windows(block: Block, anchors: Block, i: int, windows: list[tuple[int, int]], n: int, low: int, high: int):
    """For each positive ``(id, score)``: ids and scores of the first ``n`` rows of other labels inside its window."""
    code = block.code_of.get(anchors.labels[i], -1)
    least, most = bounds(anchors.angles[i], anchors.norm[i], block.by_direction, block.norm)
    reach = np.zeros(len(block.id), bool)
    for _, p in windows:
        reach |= (100 * most >= low * p) & (100 * least <= high * p)
    rows = np.flatnonzero(reach & (block.code != code))
    score = block.scores(rows, anchors.q[i])
    for positive, p in windows:
        # low * p <= 100 * score <= high * p, without leaving 64 bits
        inside = np.flatnonzero((score >= -(-low * p // 100)) & (score <= high * p // 100))
        pick = inside[_first(rows[inside], score[inside], block.id, n)]
        yield positive, p, block.id[rows[pick]], score[pick]


def _passing(work: Callable[[Block, Block, pa.RecordBatch], dict], dim: int, many: int, schema: pa.Schema):
    """Blocks' rows, then the anchors that meet them, as one stream for each task."""

    def run(batches: Iterator[pa.RecordBatch]):
        number, parts, block = None, [], None
        for b in batches:
            at, kind = b.column("block").to_numpy(), b.column("kind").to_numpy()
            cut = np.flatnonzero(np.diff(at.astype(np.int64) * 2 + kind, prepend=-1))
            for begin, end in zip(cut, [*cut[1:], b.num_rows], strict=True):
                if at[begin] != number:
                    number, parts, block = at[begin], [], None
                piece = b.slice(begin, end - begin)
                if kind[begin] == 0:
                    parts.append(piece)
                elif parts:
                    block = block or Block(parts, dim, many).ready()
                    yield pa.RecordBatch.from_pydict(work(block, Block([piece], dim, many), piece), schema)

    return run


def _meet(rows: DataFrame, anchors: DataFrame, blocks: int, work, dim: int, many: int, schema: pa.Schema, ddl: str) -> DataFrame:
    """``work`` on every block and all anchors, which go to each block."""
    right = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("kind", F.lit(1))
    left = rows.withColumn("kind", F.lit(0))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = left.unionByName(right, allowMissingColumns=True).repartitionByRange(n, "block")
    return both.sortWithinPartitions("block", "kind").mapInArrow(_passing(work, dim, many, schema), ddl)


def stored(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> tuple[DataFrame, int, int, int]:
    """A stored table ``vec_id, label, q, angles, norm, block``, and the numbers of dimensions, directions and blocks."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("v", scale))
    rows = rows.select("vec_id", "label", integers("v", scale).alias("v"))
    # Of repeated ids one row: the smallest label, then the smallest vector.
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("one")).select("vec_id", "one.*")
    rows = staged(rows, "vector-rows")
    dim, total = width(rows, "v"), rows.count()
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").toPandas()["v"]
    matrix = np.zeros((len(sample), dim), np.int64)
    for x, v in zip(matrix, sample, strict=True):
        x[: len(v)] = v
    shared = rows.sparkSession.sparkContext.broadcast(references(matrix))  # 16 directions

    def place(batches):
        for b in batches:
            q = padded(b.column(2), dim)
            angle, norm = angles(q, shared.value)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), packed(q), packed(angle), pa.array(norm)],
                                             ["vec_id", "label", "q", "angles", "norm"])

    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-total * dim * 8 // BLOCK_BYTES), min(spread, -(-total // BLOCK_ROWS)))
    kind = dict(rows.dtypes)["label"]
    rows = rows.mapInArrow(place, f"vec_id long, label {kind}, q binary, angles binary, norm double")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    return staged(rows, "vector-angles"), dim, len(shared.value), blocks


def hard_negatives(df: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding",
                   label_col: str = "label", scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH) -> DataFrame:
    """Hard negatives of each anchor and positive.

    Components become ``floor(scale * x)``; a score is the integer inner
    product, higher ones first, ties by the smaller id. An anchor (a row that
    meets ``is_anchor``, a condition on ``vec_id`` and ``label``) has as
    positives the first ``positives`` other rows of its label; to each, the
    first ``negatives`` rows of other labels whose score is ``low`` to
    ``high`` hundredths of the positive's. A negative score has no such row.

    Rows with a null id, label, vector or component, with a component that is
    not finite or is 2**27 or more after scaling, take no part. Of rows with
    the same id the one with the smallest label, then vector, takes part.
    Missing components of shorter vectors are zeros. Empty tables and tables
    without anchors give an empty one; further columns are ignored.

    Columns: ``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``.
    """
    rows, dim, many, blocks = stored(df, id_col, vector_col, label_col, scale)
    anchors = rows.where(is_anchor).drop("block")
    kept = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64())])

    def search(block, mine, _):
        out = {k: [] for k in kept.names}
        for i, anchor in enumerate(mine.id.tolist()):
            ids, score = best_of_label(block, mine, i, positives)
            out["anchor_id"] += [anchor] * len(ids)
            out["positive_id"] += ids.tolist()
            out["positive_score"] += score.tolist()
        return out

    found = _meet(rows, anchors, blocks, search, dim, many, kept, "anchor_id long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor_id").orderBy(F.col("positive_score").desc(), "positive_id")
    found = found.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives)
    found = staged(found.select("anchor_id", "positive_id", "positive_score"), "positives")

    windows = found.groupBy("anchor_id").agg(  # five at most for each anchor
        F.sort_array(F.collect_list(F.struct("positive_id", "positive_score"))).alias("windows"))
    asked = anchors.join(windows, anchors["vec_id"] == windows["anchor_id"]).drop("anchor_id")
    full = pa.schema([*kept, ("negative_id", pa.int64()), ("negative_score", pa.int64())])

    def mine_windows(block, mine, piece):
        out = {k: [] for k in full.names}
        for i, (anchor, asked_for) in enumerate(zip(mine.id.tolist(), piece.column("windows").to_pylist(), strict=True)):
            pairs = [(w["positive_id"], w["positive_score"]) for w in asked_for]
            for positive, p, ids, score in best_in_windows(block, mine, i, pairs, negatives, low, high):
                for k, v in (("anchor_id", anchor), ("positive_id", positive), ("positive_score", p)):
                    out[k] += [v] * len(ids)
                out["negative_id"] += ids.tolist()
                out["negative_score"] += score.tolist()
        return out

    near = _meet(rows, asked, blocks, mine_windows, dim, many, full,
                 "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    near = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return near.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of all vectors whose id is divisible by 100; ids divisible by 7 carry a changed label."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", changed), F.col("vec_id") % 100 == 0)


SQL = {"op11_hard_negatives": """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               [floor(256 * x::DOUBLE) for x in embedding] AS q
        FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    s AS MATERIALIZED (
        SELECT a.vec_id AS anchor_id, v.vec_id AS other_id, a.label = v.label AS same, list_inner_product(a.q, v.q)::BIGINT AS score
        FROM v AS a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 100 = 0),
    p AS (
        SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
    SELECT p.anchor_id, positive_id, row_number() OVER w AS rank, other_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same
    WHERE 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id)
    QUALIFY row_number() OVER w <= 5"""}
QUERIES = {"op11_hard_negatives": op11_hard_negatives}
