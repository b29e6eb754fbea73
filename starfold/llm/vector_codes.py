"""Vector compression: codes of integer codebooks by Walsh-Hadamard distances.

Vectors become integers and are cut into equal parts; each part position has
a codebook of up to 16 entries, refined by rounds of assignment and mean.
Parts and entries are zero-padded to a power of two, ``L``, and go through an
integer Walsh-Hadamard transform, which multiplies every squared distance by
exactly ``L``. Squared differences are summed coefficient by coefficient in
sequency order, where much of a difference comes early; an entry whose sum so
far exceeds the whole distance of another one is out. All of it is in 64-bit
integers. A round sends the codebooks out and gets sums for each entry back,
which are as many for any number of vectors.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm.base import staged, table
from starfold.llm.vectors import integers, packed, padded, unpacked, usable, width

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of the rows of ``x`` (zero-padded to a power of two), in sequency order."""
    n, d = x.shape
    size = 1 << max(d - 1, 0).bit_length()
    out = np.zeros((n, size), np.int64)
    out[:, :d] = x
    half = 1
    while half < size:
        pair = out.reshape(n, size // (2 * half), 2, half)
        out = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(n, size)
        half *= 2
    return out[:, sequency(size)]


def sequency(size: int) -> np.ndarray:
    """The transform's rows by ascending number of sign changes: the bit-reversed Gray code of that number."""
    rank = np.arange(size)
    gray, out = rank ^ (rank >> 1), np.zeros(size, np.int64)
    for _ in range(size.bit_length() - 1):
        out, gray = (out << 1) | (gray & 1), gray >> 1
    return out


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of coefficients: its nearest entry (ties: the lowest index) and their distance times ``L``."""
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    so_far = (x[:, :1] - entries[:, 0]) ** 2
    # The whole distance of the entry that is nearest in the first coefficient is the one to beat.
    best = ((x - entries[so_far.argmin(axis=1)]) ** 2).sum(axis=1)
    row, entry = np.nonzero(so_far <= best[:, None])
    total = so_far[row, entry]
    for i in range(1, x.shape[1]):
        total = total + (x[row, i] - entries[entry, i]) ** 2
        alive = total <= best[row]
        row, entry, total = row[alive], entry[alive], total[alive]
    begin = np.flatnonzero(np.diff(row, prepend=-1))  # of every row the nearest entry is alive
    least = np.minimum.reduceat(total, begin)
    hit = np.flatnonzero(total == np.repeat(least, np.diff(np.append(begin, len(row)))))
    first = hit[np.unique(row[hit], return_index=True)[1]]
    return entry[first], total[first]


class Codebooks:
    """Entries (parts x entries x length of a part) and their coefficients."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.coefficients = [transform(e) for e in entries]

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and squared distance for each row and part of ``x`` (rows x dimensions)."""
        parts, _, d = self.entries.shape
        index, error = np.zeros((len(x), parts), np.int64), np.zeros((len(x), parts), np.int64)
        for p, e in enumerate(self.coefficients):
            index[:, p], scaled = nearest(transform(x[:, p * d : (p + 1) * d]), e)
            error[:, p] = scaled // e.shape[1]
        return index, error

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int, parts: int) -> tuple[DataFrame, int]:
    """Stored ``vec_id, label, q`` of the usable rows, and the length of a part."""
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    part = -(-width(rows, "v") // parts)
    # With components below this, no distance times L exceeds 63 bits.
    limit = (1 << 30) >> max(part - 1, 0).bit_length()
    rows = rows.where(usable("v", scale, limit)).select("vec_id", "label", integers("v", scale).alias("v"))

    def pack(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), packed(padded(b.column(2), part * parts))],
                                             ["vec_id", "label", "q"])

    kinds = dict(rows.dtypes)
    return staged(rows.mapInArrow(pack, f"vec_id {kinds['vec_id']}, label {kinds['label']}, q binary"), "vectors"), part


def fit(rows: DataFrame, part: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of a stored table of :func:`vectors`: from the smallest ids (equal ids: by vector), refined in rounds."""
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(entries).select("q").collect()
    first = np.array([np.frombuffer(r["q"], np.int32) for r in start], np.int64).reshape(len(start), parts, part)
    books = Codebooks(first.transpose(1, 0, 2))
    if not start:
        return books
    for _ in range(rounds):
        shared = rows.sparkSession.sparkContext.broadcast(books)  # 128 entries

        def sums(batches, shared=shared):
            held = shared.value.entries
            count, total = np.zeros(held.shape[:2], np.int64), np.zeros(held.shape, np.int64)
            for b in batches:
                x = unpacked(b.column(0), parts * part).astype(np.int64)
                index, _ = shared.value.assign(x)
                for p in range(parts):
                    own = index[:, p] == np.arange(held.shape[1])[:, None]
                    count[p] += own.sum(axis=1)
                    total[p] += own.astype(np.int64) @ x[:, p * part : (p + 1) * part]
            p, e = np.nonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(p), pa.array(e), pa.array(count[p, e]), pa.array(total[p, e].tolist(), pa.list_(pa.int64()))],
                ["part", "entry", "n", "sums"])

        each = rows.select("q").mapInArrow(sums, "part long, entry long, n long, sums array<long>")
        got = each.select("part", "entry", "n", F.posexplode_outer("sums").alias("at", "x")).groupBy("part", "entry", "at")
        new = books.entries.copy()
        for r in got.agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect():  # at most as many rows as the codebooks have numbers
            if r["at"] is not None:
                new[r["part"], r["entry"], r["at"]] = r["x"] // r["n"]
        shared.unpersist()
        books = Codebooks(new)
    return books


def encode(rows: DataFrame, part: int, books: Codebooks) -> DataFrame:
    """``vec_id, label, code, error`` for each row of a stored table of :func:`vectors`.

    ``code``: two hex digits for each part's entry; ``error``: squared
    distances summed over the parts.
    """
    kinds, shared = dict(rows.dtypes), rows.sparkSession.sparkContext.broadcast(books)
    parts = books.entries.shape[0]

    def run(batches):
        for b in batches:
            index, error = shared.value.assign(unpacked(b.column(2), parts * part).astype(np.int64))
            code = [bytes(x).hex() for x in index.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(code, pa.string()), pa.array(error.sum(axis=1))],
                                             ["vec_id", "label", "code", "error"])

    return rows.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def vector_codes(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Codes, errors and errors of each label: ``vec_id, code, error, label_error, codebooks_sha256``.

    Rows whose vector is null or holds a null or non-finite component are
    left out, as are those with a component of 2**30 / L or more after
    scaling (``L``: a part's length as a power of two), whose distances
    would not fit in 64 bits. Vectors shorter than the longest, and lengths
    that ``parts`` does not divide, are filled with zeros at the end. Equal
    ids and null ids are coded row by row; null ids come last among the
    smallest. With fewer rows than ``entries`` there are as many entries as
    rows. An empty table gives an empty one; further columns are ignored.
    ``entries`` must be 256 or fewer.
    """
    if not 0 < entries <= 256:
        raise ValueError(f"entries must be between 1 and 256, got {entries}")
    rows, part = vectors(df, id_col, vector_col, label_col, scale, parts)
    books = fit(rows, part, parts, entries, rounds)
    coded = staged(encode(rows, part, books), "vector-codes")
    each = staged(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    return coded.join(each, coded["label"].eqNullSafe(each["label"])).select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code."""
    return vector_codes(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """The rounds one after the other, as plain sums over parts."""
    nearest = """SELECT p.vec_id, p.label, p.part, p.x, min({{'d': list_sum(
            [(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(p.x, e.c)]), 'entry': e.entry}}) AS best
        FROM p JOIN e{0} e ON p.part = e.part GROUP BY p.vec_id, p.label, p.part, p.x"""
    steps = []
    for i in range(ROUNDS):
        steps.append(f"""a{i} AS MATERIALIZED ({nearest.format(i)}),
    m{i} AS MATERIALIZED (
        SELECT part, entry, list(floor_mean ORDER BY i) AS c FROM (
            SELECT part, best.entry AS entry, i,
                   (sum(x[i]) - ((sum(x[i]) % count(*)) + count(*)) % count(*)) // count(*) AS floor_mean
            FROM a{i}, range(1, {64 // PARTS + 1}) t(i) GROUP BY part, best.entry, i) GROUP BY part, entry),
    e{i + 1} AS MATERIALIZED (
        SELECT e.part, e.entry, coalesce(m.c, e.c) AS c FROM e{i} e LEFT JOIN m{i} m ON e.part = m.part AND e.entry = m.entry)""")
    return f"""
    WITH v AS (
        SELECT vec_id, label, [floor({SCALE} * x::DOUBLE)::HUGEINT for x in embedding] AS q FROM embeddings
        WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
    p AS MATERIALIZED (
        SELECT vec_id, label, part, q[part * {64 // PARTS} + 1 : (part + 1) * {64 // PARTS}] AS x FROM v, range({PARTS}) t(part)),
    e0 AS MATERIALIZED (
        SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS c FROM p
        QUALIFY row_number() OVER (PARTITION BY part ORDER BY vec_id) <= {ENTRIES}),
    {", ".join(steps)},
    last AS MATERIALIZED ({nearest.format(ROUNDS)}),
    r AS (
        SELECT vec_id, label, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error
        FROM last GROUP BY vec_id, label)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
           (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM e{ROUNDS}) AS codebooks_sha256
    FROM r"""


SQL = {"op13_vector_codes": _sql()}
QUERIES = {"op13_vector_codes": op13_vector_codes}
