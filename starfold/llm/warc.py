"""Web archives with a two-level capture index.

Records are written one gzip member each, so that any of them can be read on
its own. Of pages with equal payloads one holds the payload, the others are
revisit records that refer to it. The index has a line for each capture,
under the page's address with its host reversed (``org,example)/path``), so
that the pages of a domain stand together: lines are sorted by Spark's range
partitioning (by address and page, so that neither one host nor one address
is a hot key), cut into blocks of ``BLOCK_LINES``, and compressed. A sparse
directory holds the first key and the place of each block. A lookup searches
the directory by bisection, reads one block's range of bytes, searches in it,
and reads the record's range of bytes.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm.base import staged, table
from starfold.llm.files import new_file, qualified, read_file
from starfold.session import scratch_path

#: Payloads of fewer bytes are always stored.
LEAST_REVISIT = 100
BLOCK_LINES = 2_048
#: An archive is closed, and another one begun, beyond this many bytes.
ARCHIVE_BYTES = 1 << 29
LEVEL = 4
DATE = "1970-01-01T00:00:00Z"  # the pages table has no time of capture
OPEN_FILES = 64

# Fixed values of the WARC format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreservation.org/warc/1.1/revisit/identical-payload-digest"

PLACE = "page_id long, key string, uri string, offset long, length long, record_type string"


def url_key(url: str | Column) -> Column:
    """The address with its host reversed and in lower case: ``org,example)/path?query``.

    Scheme, user, port, a leading ``www.`` and the fragment do not count. A
    null address, or one without a host, stands as it is behind ``)``.
    """
    u = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    host = F.lower(F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    host = F.regexp_replace(F.rtrim(host, F.lit(".")), r"^www\.", "")
    rest = F.regexp_replace(F.regexp_replace(u, r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def _header(fields: dict[str, str]) -> bytes:
    lines = [f"{k}: {re.sub(r'[\x00-\x1f\x7f]', lambda m: f'%{ord(m[0]):02X}', v)}" for k, v in fields.items()]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass")


def _name(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def record(page: int | None, url: str | None, payload: bytes, digest: str, first: int | None) -> bytes:
    """A page's record; ``first``: the page that holds the payload, null if this one does."""
    http = _header({"Content-Type": "text/html; charset=utf-8", "Content-Length": str(len(payload))})
    block = b"HTTP/1.1 200 OK\r\n" + http + b"\r\n\r\n" + (payload if first is None else b"")
    fields = {"WARC-Type": "response" if first is None else "revisit", "WARC-Record-ID": _name(page), "WARC-Date": DATE}
    if url is not None:
        fields["WARC-Target-URI"] = url
    if first is not None:
        fields |= {"WARC-Refers-To": _name(first), "WARC-Profile": REVISIT_PROFILE}
    fields |= {"WARC-Payload-Digest": f"sha256:{digest}", "Content-Type": "application/http;msgtype=response",
               "Content-Length": str(len(block))}
    return VERSION + b"\r\n" + _header(fields) + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Capture:
    """What a record says."""

    page: int | None
    url: str | None
    kind: str
    digest: str
    size: int
    payload: bytes
    refers_to: int | None


def _fields(head: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in head.decode("utf-8", "surrogatepass").split("\r\n")[1:] if ": " in line)


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def parse(data: bytes) -> Capture:
    """A record, uncompressed. The digest of a stored payload is computed from it."""
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(VERSION):
        raise ValueError("not a WARC record")
    f = _fields(head)
    block = rest[: int(f["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated, size = f["WARC-Payload-Digest"].removeprefix("sha256:"), int(_fields(http)["Content-Length"])
    if f["WARC-Type"] == "response":
        digest = hashlib.sha256(payload).hexdigest()
        if digest != stated or size != len(payload):
            raise ValueError(f"damaged payload in {f['WARC-Record-ID']}")
    return Capture(_page(f["WARC-Record-ID"]), f.get("WARC-Target-URI"), f["WARC-Type"], stated, size, payload,
                   _page(f.get("WARC-Refers-To")))


class Reader:
    """Reads byte ranges of files; keeps a few of them open."""

    def __init__(self):
        self.open: OrderedDict[str, object] = OrderedDict()

    def range(self, uri: str, offset: int, length: int) -> bytes:
        if uri not in self.open:
            self.open[uri] = read_file(uri)
            if len(self.open) > OPEN_FILES:
                self.open.popitem(last=False)[1].close()
        self.open.move_to_end(uri)
        return bytes(self.open[uri].read_at(length, offset))

    def record(self, uri: str, offset: int, length: int) -> Capture:
        return parse(gzip.decompress(self.range(uri, offset, length)))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   text_col: str = "html") -> DataFrame:
    """Write a record for each row under ``folder``; returns where each record is.

    The payload is the text in UTF-8, null and empty ones have none. Of equal
    payloads of at least ``LEAST_REVISIT`` bytes the one with the smallest id
    is stored (all rows with that id, if rows are repeated), the others are
    revisit records; a payload whose pages all have no id is stored each
    time. Null addresses are left out of the record. Further columns are
    ignored; an empty table writes nothing.

    Columns: ``page_id, key, uri, offset, length, record_type``.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("key", url_key("url"))
    shared = (rows.where(F.octet_length("payload") >= LEAST_REVISIT).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null"))
    # Stored, so that the join is free to split a payload that very many pages share.
    rows = rows.join(staged(shared.select("digest", "first"), "payloads"), "digest", "left")
    rows = rows.select("page_id", "url", "payload", "digest", "key",
                       F.when(F.col("page_id").isNull() | (F.col("first") != F.col("page_id")), F.col("first")).alias("first"))

    folder = qualified(pages.sparkSession, folder)

    def write(batches):
        out = uri = None
        at = 0
        for batch in batches:
            places = []
            for r in batch.to_pylist():
                if out is None:
                    uri, out = new_file(folder, f"archive-{TaskContext.get().partitionId():06d}", ".warc.gz")
                    at = 0
                data = gzip.compress(record(r["page_id"], r["url"], r["payload"], r["digest"], r["first"]), LEVEL, mtime=0)
                out.write(data)
                places.append((r["page_id"], r["key"], uri, at, len(data), "response" if r["first"] is None else "revisit"))
                at += len(data)
                if at > ARCHIVE_BYTES:
                    out.close()
                    out = None
            if places:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*places, strict=True), _PLACE_TYPES, strict=True)], _PLACE_NAMES)
        if out is not None:
            out.close()

    return staged(rows.mapInArrow(write, PLACE), "captures")


_PLACE_NAMES = ["page_id", "key", "uri", "offset", "length", "record_type"]
_PLACE_TYPES = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Write the sorted lines of ``captures`` in compressed blocks; returns the sparse directory.

    Columns: ``shard, block`` (their order), ``first_key, last_key, uri, offset, length, n_lines``.
    """
    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = captures.select(*_PLACE_NAMES).repartitionByRange(n, "key", "page_id", "uri", "offset")
    rows = rows.sortWithinPartitions("key", "page_id", "uri", "offset")

    folder = qualified(captures.sparkSession, folder)

    def write(batches):
        shard = TaskContext.get().partitionId()
        out = uri = None
        at = block = 0
        for lines in _blocks(batches):
            if out is None:
                uri, out = new_file(folder, f"index-{shard:06d}", ".cdxz")
            data = zlib.compress("\n".join(json.dumps(x, ensure_ascii=False) for x in lines).encode("utf-8", "surrogatepass"), 6)
            out.write(data)
            yield pa.RecordBatch.from_pylist([{"shard": shard, "block": block, "first_key": lines[0][1], "last_key": lines[-1][1],
                                               "uri": uri, "offset": at, "length": len(data), "n_lines": len(lines)}])
            at += len(data)
            block += 1
        if out is not None:
            out.close()

    return staged(rows.mapInArrow(write, "shard long, block long, first_key string, last_key string, uri string, "
                                         "offset long, length long, n_lines long"), "directory")


def _blocks(batches) -> Iterator[list[tuple]]:
    held: list[tuple] = []
    for batch in batches:
        held += zip(*(c.to_pylist() for c in batch.columns), strict=True)
        while len(held) >= BLOCK_LINES:
            yield held[:BLOCK_LINES]
            held = held[BLOCK_LINES:]
    if held:
        yield held


def _lines(reader: Reader, uri: str, offset: int, length: int) -> list[list]:
    data = zlib.decompress(reader.range(uri, offset, length)).decode("utf-8", "surrogatepass")
    return [json.loads(x) for x in data.split("\n")]


_READ_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
_READ_NAMES = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "key"]


class Blocks:
    """A sorted run of index blocks, searched by bisection: first their first keys, then one block's lines."""

    def __init__(self, reader: Reader):
        self.reader, self.rows, self.firsts = reader, [], []
        self.held: tuple[int, list, list] = (-1, [], [])  # the block read last, its lines and their keys

    def add(self, first: str, last: str, uri: str, offset: int, length: int) -> None:
        self.rows.append((last, uri, offset, length))
        self.firsts.append(first)

    def places(self, key: str) -> Iterator[list]:
        """The index lines of a key; a key's lines may go on in the next blocks."""
        for i in range(max(bisect_left(self.firsts, key) - 1, 0), bisect_right(self.firsts, key)):
            if self.rows[i][0] >= key:
                if self.held[0] != i:
                    lines = _lines(self.reader, *self.rows[i][1:])
                    self.held = i, lines, [x[1] for x in lines]
                _, lines, keys = self.held
                yield from lines[bisect_left(keys, key) : bisect_right(keys, key)]


def lookup(wanted: DataFrame, directory: DataFrame, key_col: str = "key") -> DataFrame:
    """The captures of all keys of ``wanted``, read from their records.

    Each key goes to the shards of the index whose range holds it (several,
    if the key has very many captures); a task takes a shard's part of the
    directory, then the keys that are wanted from it in order, bisects the
    directory, reads one block, bisects that, and reads the records' ranges
    of bytes. Repeated keys count once; null and unknown keys, and an empty
    index, give nothing.

    Columns: ``page_id, payload_bytes, payload_digest, record_type, refers_to, key``.
    """
    spark = directory.sparkSession
    # A row for each shard, as many as the partitions that wrote the index.
    ranges = directory.groupBy("shard").agg(F.min("first_key").alias("first"), F.max("last_key").alias("last")).orderBy("shard").collect()
    shared = spark.sparkContext.broadcast(([r["first"] for r in ranges], [r["last"] for r in ranges], [r["shard"] for r in ranges]))

    def deal(batches):
        firsts, lasts, shards = shared.value
        for batch in batches:
            rows = [(shards[i], key) for key in batch.column(0).to_pylist()
                    for i in range(bisect_left(lasts, key), bisect_right(firsts, key))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())],
                                             ["shard", "key"])

    keys = wanted.select(F.col(key_col).alias("key")).where("key is not null").distinct().mapInArrow(deal, "shard long, key string")
    blocks = directory.select("shard", F.lit(0).alias("kind"), "block", F.col("first_key").alias("key"), "last_key", "uri", "offset", "length")
    asked = keys.select("shard", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("block"), "key")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = blocks.unionByName(asked, allowMissingColumns=True).repartitionByRange(n, "shard")

    def read(batches):
        reader = Reader()
        shard, run, found = None, Blocks(reader), []

        def records(lines):
            out = []
            for _, key, uri, at, size, _ in sorted(lines, key=lambda x: x[2:4]):
                c = reader.record(uri, at, size)
                out.append((c.page, c.size, c.digest, c.kind, c.refers_to, key))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _READ_TYPES, strict=True)], _READ_NAMES)

        for batch in batches:
            for at, kind, _, key, last, uri, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != shard:
                    shard, run = at, Blocks(reader)
                if kind == 0:
                    run.add(key, last, uri, offset, length)
                    continue
                for line in run.places(key):
                    found.append(line)
                    if len(found) == BLOCK_LINES:
                        yield records(found)
                        found = []
        if found:
            yield records(found)

    return both.sortWithinPartitions("shard", "kind", "block", "key").mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, key string")


class CaptureIndex:
    """Lookups of single keys from the driver, for an index whose directory fits there."""

    def __init__(self, directory: DataFrame):
        self.reader = Reader()
        self.run = Blocks(self.reader)
        for b in directory.orderBy("shard", "block").collect():  # a row for BLOCK_LINES captures
            self.run.add(b["first_key"], b["last_key"], b["uri"], b["offset"], b["length"])

    def places(self, key: str) -> list[list]:
        """The index lines of a key; none if it was not captured."""
        return list(self.run.places(key))

    def captures(self, key: str) -> list[Capture]:
        """The records of a key; a revisit comes without its payload."""
        return [self.reader.record(*x[2:5]) for x in self.places(key)]


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive, looked up by its address in the index, and read back."""
    pages = table(spark, sf_dir, "pages")
    directory = write_index(write_archives(pages, scratch_path(spark, "archives")), scratch_path(spark, "captures"))
    return lookup(pages.select(url_key("url").alias("key")), directory)


QUERIES = {"op8_warc": op8_warc}
SQL = {"op8_warc": r"""
    WITH p AS (
        SELECT page_id, coalesce(html, '') AS html, url FROM pages),
    d AS (
        SELECT page_id, url, octet_length(encode(html)) AS payload_bytes, sha256(html) AS payload_digest FROM p),
    f AS (
        SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to,
           array_to_string(list_reverse(string_split(regexp_replace(rtrim(lower(regexp_extract(coalesce(url, ''),
               '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '.'), '^www\.', ''), '.')), ',') || ')' ||
           regexp_replace(regexp_replace(coalesce(url, ''), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', '') AS key
    FROM f"""}
