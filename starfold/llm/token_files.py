"""Token ids in binary files: frequency ranks, byte-aligned, with control bytes.

A file is a row of blocks of whole documents in ascending order of their ids.
Each block has its ids ranked by frequency (ties: smaller id first), so that
the most frequent 256 take one byte. Ranks are written in one to four bytes,
least byte first; the lengths, two bits each, four to a byte, are kept apart
in control bytes. Decoding looks up, for each control byte, how many bytes
its four values take and where their bytes are, and gathers whole blocks.

Block: magic; five 64-bit numbers (documents, tokens, distinct ids, data
bytes of the ranks, data bytes of the table); document ids; tokens of each
document; control and data bytes of the table (ids in order of rank);
control and data bytes of the ranks. All little-endian.

Texts are cut before a blank that stands alone, where the tokenizer cuts them
too, and each distinct piece is encoded once by a worker.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starfold.llm import tokens as T
from starfold.llm.base import staged, table
from starfold.llm.files import new_file, qualified, read_file
from starfold.llm.spans import SpanCache, gather
from starfold.session import scratch_path

MAGIC = b"RVB1"
END_ID = 2
#: Tokens after which a block is closed.
BLOCK_TOKENS = 1 << 19
#: Bytes of text that are encoded together.
SLICE = 1 << 20
#: Pieces and ids that a worker holds.
HELD, HELD_IDS = 1 << 20, 1 << 23
NO_ID = -(1 << 63)

# --- the code ------------------------------------------------------------

_CODES = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3
#: For each control byte, the number of data bytes, and for each of 16 output bytes the place of its input (16: none).
TAKES = (_CODES + 1).sum(axis=1)
PLACES = np.full((256, 4, 4), 16, dtype=np.int64)
for _j in range(4):
    _before = (_CODES[:, :_j] + 1).sum(axis=1)
    for _b in range(4):
        PLACES[:, _j, _b] = np.where(_b <= _CODES[:, _j], _before + _b, 16)
PLACES = PLACES.reshape(256, 16)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit numbers."""
    v = values.astype("<u4")
    code = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4) <= code[:, None]]
    code = np.pad(code, (0, -len(code) % 4)).reshape(-1, 4)
    return (code << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1).astype(np.uint8).tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers of :func:`pack`."""
    c = np.frombuffer(control, dtype=np.uint8)
    padded = np.zeros(len(data) + 17, dtype=np.uint8)
    padded[: len(data)] = np.frombuffer(data, dtype=np.uint8)
    out = np.empty((len(c), 16), dtype=np.uint8)
    take = TAKES[c]
    begin = np.cumsum(take) - take
    for i in range(0, len(c), 1 << 16):
        part = PLACES[c[i : i + (1 << 16)]]
        out[i : i + (1 << 16)] = np.where(part < 16, padded[begin[i : i + (1 << 16), None] + part], 0)
    return out.reshape(-1).view("<u4")[:n]


def write_block(out, ids: list[int], sizes: list[int], tokens: np.ndarray) -> int:
    """Write one block; its length in bytes."""
    values, inverse, count = np.unique(tokens, return_inverse=True, return_counts=True)
    order = np.lexsort((values, -count))
    rank = np.empty(len(values), dtype=np.uint32)
    rank[order] = np.arange(len(values), dtype=np.uint32)
    names, given = pack(values[order]), pack(rank[inverse])
    head = np.array([len(ids), len(tokens), len(values), len(given[1]), len(names[1])], dtype="<i8")
    parts = [MAGIC, head.tobytes(), np.array(ids, "<i8").tobytes(), np.array(sizes, "<i8").tobytes(), *names, *given]
    for p in parts:
        out.write(p)
    return sum(map(len, parts))


def read_blocks(f) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Document ids, sizes and token ids of each block of an open file."""
    while magic := f.read(4):
        if magic != MAGIC:
            raise ValueError("not a token file, or a damaged one")
        docs, n, names, data, name_data = np.frombuffer(f.read(40), "<i8").tolist()
        ids, sizes = (np.frombuffer(f.read(8 * docs), "<i8") for _ in range(2))
        values = unpack(f.read(-(-names // 4)), f.read(name_data), names)
        ranks = unpack(f.read(-(-n // 4)), f.read(data), n)
        yield ids, sizes, values[ranks]


# --- encoding texts ------------------------------------------------------

_GRAPHIC = np.zeros(256, dtype=bool)
_GRAPHIC[0x21:0x7F] = True
_LEAD = _GRAPHIC.copy()  # first byte of a character that is no white space for sure
_LEAD[0xC3:0xE1] = _LEAD[0xE4:0xF5] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_WORD = _LETTER.copy()  # letters, and characters of two bytes that are no white space
_WORD[0x80:0xC0] = _WORD[0xC3:0xE0] = True
_POINT = np.zeros(256, dtype=bool)
_POINT[[ord(c) for c in ".,;:!?"]] = True


class Encoder:
    """Token ids of many texts with a tokenizer file, each distinct piece encoded once.

    The byte-level tokenizer never merges across these places, so pieces can
    be encoded on their own: before a blank between two characters that are
    not white space, before a point or comma after a letter, and on either
    side of a line feed between such.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.cache = SpanCache(HELD, HELD_IDS)
        self.bytes_of = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, dtype=np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.bytes_of[i] = len(token)  # a character for each byte

    @staticmethod
    def cuts(buf: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Where pieces begin in the joined texts, whose ends are given."""
        before, at, after = buf[:-2], buf[1:-1], buf[2:]
        solid = _GRAPHIC[before]
        two = np.zeros(len(before), dtype=bool)
        two[1:] = (before[1:] >= 0x80) & (buf[:-3] >= 0xC3) & (buf[:-3] < 0xE0)
        solid |= two
        alone = solid & _LEAD[after]
        first = (at == 0x20) & alone
        first |= _POINT[at] & _LETTER[before]
        feed = (at == 0x0A) & _GRAPHIC[before] & _GRAPHIC[after]
        first |= feed
        mark = np.zeros(len(buf) + 1, dtype=bool)
        mark[1:-2] = first
        mark[2:-1] |= feed
        mark[0] = True
        mark[ends] = True
        mark[-1] = False
        return np.flatnonzero(mark)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and the number of ids of each."""
        size = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        ends = np.cumsum(size)
        raw = b"".join(texts)
        if not raw:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        buf = np.frombuffer(raw, dtype=np.uint8)
        begin = self.cuts(buf, ends) if len(buf) > 2 else np.unique(np.concatenate([[0], ends[ends < len(buf)]]))
        end = np.append(begin[1:], len(buf))
        flat, at, many = self.cache.sequences(
            T.span_hashes(buf, begin, end) ^ T.mix((end - begin).astype(np.uint64)),
            lambda new: self._pieces(raw, buf, begin[new], end[new]))
        total = np.concatenate([[0], np.cumsum(many)])
        cut = np.searchsorted(begin, np.concatenate([[0], ends]))
        return gather(flat, at, many), np.diff(total[cut])

    def _pieces(self, raw: bytes, buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        spans = [raw[a:b] for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
        size = end - begin
        # A blank and letters: such pieces can stand side by side in one text.
        good = np.concatenate([[0], np.cumsum(_WORD[buf])])
        plain = (buf[begin] == 0x20) & (size > 1) & (good[end] - good[np.minimum(begin + 1, len(buf))] == size - 1)
        ids: list[list[int] | np.ndarray] = [[]] * len(spans)
        joined = np.flatnonzero(plain)
        for i in range(0, len(joined), 4096):
            part = joined[i : i + 4096]
            got = np.array(self.tokenizer.encode(b"".join(spans[j] for j in part).decode(), add_special_tokens=False).ids)
            edge = np.searchsorted(np.cumsum(self.bytes_of[got]), np.cumsum(size[part]))
            for j, x in zip(part.tolist(), np.split(got, edge[:-1] + 1), strict=True):
                ids[j] = x
        alone = np.flatnonzero(~plain)
        for i in range(0, len(alone), 4096):
            part = alone[i : i + 4096]
            got = self.tokenizer.encode_batch([spans[j].decode("utf-8", "replace") for j in part], add_special_tokens=False)
            for j, e in zip(part.tolist(), got, strict=True):
                ids[j] = e.ids
        many = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        return np.concatenate([np.zeros(0, np.int64), *[np.asarray(x, np.int64) for x in ids]]), many


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _encoded(batches, path: str, end_id: int | None) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """Document ids, flat token ids and the number of tokens of each text, a slice at a time."""
    for batch in batches:
        names = batch.column(0).to_pylist()
        for a, b, texts in T.parts(batch.column(1), SLICE):
            flat, many = encoder(path).encode(texts)
            if end_id is not None:
                flat = np.insert(flat, np.cumsum(many), end_id)
                many = many + 1
            yield names[a:b], flat, many


# --- files ---------------------------------------------------------------


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = END_ID,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the ids of all texts into files under ``folder``; returns the list of files, in order.

    Whole texts; a null text counts as empty and gets the end id alone. A
    null document id is kept (as null) and comes first. Repeated rows are
    written each; further columns are ignored. An empty table gives no file.

    Columns: ``file_no, uri, n_docs, n_tokens, n_bytes``.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")
    folder = qualified(docs.sparkSession, folder)

    def write(batches):
        number = TaskContext.get().partitionId()
        out = uri = None
        docs = tokens = written = pending = 0
        ids: list[int] = []
        sizes: list[int] = []
        held: list[np.ndarray] = []
        for names, flat, many in _encoded(batches, tokenizer, end_id):
            if out is None:
                uri, out = new_file(folder, f"tokens-{number:06d}", ".rvb")
            for name, n, part in zip(names, many.tolist(), np.split(flat, np.cumsum(many)[:-1]), strict=True):
                ids.append(NO_ID if name is None else name)
                sizes.append(n)
                held.append(part)
                pending += n
                if pending >= BLOCK_TOKENS:
                    written += write_block(out, ids, sizes, np.concatenate(held))
                    ids, sizes, held, pending = [], [], [], 0
            docs += len(names)
            tokens += len(flat)
        if out is not None:
            if ids:
                written += write_block(out, ids, sizes, np.concatenate(held))
            out.close()
            yield pa.RecordBatch.from_pylist([{"file_no": number, "uri": uri, "n_docs": docs, "n_tokens": tokens,
                                               "n_bytes": written}])

    return staged(rows.mapInArrow(write, "file_no long, uri string, n_docs long, n_tokens long, n_bytes long"), "token-files")


def read_token_files(files: DataFrame) -> DataFrame:
    """Documents of the files that :func:`write_token_files` lists.

    Columns: ``doc_id, start`` (ids of all documents before it), ``n_tokens,
    ids_crc32`` (of the ids as little-endian unsigned 32-bit numbers).
    """
    order = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    rows = files.select("uri", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("before"))
    rows = rows.repartition(max(1, files.count()))

    def read(batches):
        for batch in batches:
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with read_file(uri) as f:
                    for ids, sizes, tokens in read_blocks(f):
                        cut = np.concatenate([[0], np.cumsum(sizes)])
                        data = memoryview(tokens.astype("<u4").tobytes())
                        crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids, mask=ids == NO_ID), pa.array(cut[:-1] + start), pa.array(sizes), pa.array(crc, pa.int64())],
                            ["doc_id", "start", "n_tokens", "ids_crc32"])
                        start += len(tokens)

    return rows.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op4_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """Every document's tokens, written to files and read back."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return read_token_files(write_token_files(table(spark, sf_dir, "documents"), scratch_path(spark, "tokens"), tokenizer))


QUERIES = {"op4_token_files": op4_token_files}
SQL: dict[str, str] = {}
