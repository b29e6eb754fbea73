"""Tables published together by one small version file.

A version is a file ``_versions/<number>.json`` that names, for each table
and part of it, the pieces its rows are in. A piece is a folder that is
written once and never changed, with its schema, number of rows, the sum of
its rows' hashes, and the range of chosen columns. A part is known by its
value's type and text, so that a missing value is a part like any other. A
new version is published by putting its finished file in place only if no
other file is there: of several writers one succeeds. Whoever reads sees all
tables of one version, and a run that fails before leaves the old one whole.
Pieces that a batch does not touch are named again, not written again.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable, Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starfold.functions.columns import digest, exact_sum
from starfold.session import open_writers
from starfold.sources.tables import stored

#: A piece: ``path, schema, rows, sum, range``.
Piece = dict
#: A table's parts: key of the part to its pieces.
Parts = dict[str, list[Piece]]
#: Number of rows and sum of their hashes.
Totals = tuple[int, int]

ALL = json.dumps(["all", "all"])
#: File systems whose rename would replace a file, but which can create one exclusively.
EXCLUSIVE_CREATE = ("s3a", "gs")


class VersionConflict(RuntimeError):
    """Another run has published in the meantime."""


class LostRows(RuntimeError):
    """What was staged is not the stored rows without the replaced ones and with the batch."""


def part_key(kind: str, value) -> str:
    """A part's key: the type of its column and the text of its value; null has no text."""
    text = None if value is None else str(value).lower() if isinstance(value, bool) else str(value)
    return json.dumps([kind, text])


def row_hash(df: DataFrame) -> Column:
    """A 64-bit hash of a row that depends on its columns' values, not on their order, nor on columns that are null."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns) if not c.startswith("_part_")])


def _hashed(df: DataFrame) -> DataFrame:
    """Rows with their hash, for :func:`_sums`."""
    return df.withColumn("_row_hash", row_hash(df))


def _sums() -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), exact_sum("_row_hash").alias("sum")]


def totals(parts: Parts) -> dict[str, Totals]:
    """Rows and sum of hashes of each part, from what is recorded."""
    return {k: (sum(p["rows"] for p in v), sum(int(p["sum"]) for p in v)) for k, v in parts.items()}


def _text(value):
    return value.isoformat() if isinstance(value, (dt.date, dt.datetime)) else value


class VersionedTables:
    def __init__(self, spark: SparkSession, root: str, number: int | None = None):
        """The newest version under ``root``, or an older one by its number."""
        self.spark, self.root = spark, root.rstrip("/")
        self.number, self.tables, self.info = self._load(number)
        self.staging = f"{self.root}/data/{self.number + 1:08d}-{uuid.uuid4().hex[:12]}"

    # --- files ------------------------------------------------------------

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _listed(self, folder: str) -> list:
        fs = self._fs(folder)
        return list(fs.listStatus(self._path(folder))) if fs.exists(self._path(folder)) else []

    def versions(self) -> dict[int, float]:
        """Numbers of all versions, with the times they were published."""
        found = {s.getPath().getName(): s.getModificationTime() / 1000 for s in self._listed(f"{self.root}/_versions")}
        return {int(n[:-5]): t for n, t in sorted(found.items()) if n.endswith(".json") and n[:-5].isdigit()}

    def _state(self, number: int) -> dict:
        text = self.spark.read.option("wholetext", True).text(f"{self.root}/_versions/{number:08d}.json").first()[0]
        return json.loads(text)

    def _load(self, number: int | None) -> tuple[int, dict[str, Parts], dict]:
        if number is None:
            numbers = self.versions()
            if not numbers:
                return 0, {}, {}
            number = max(numbers)
        state = self._state(number)
        return number, state["tables"], state["info"]

    # --- reading ----------------------------------------------------------

    def read(self, table: str, parts: Iterable[str] | None = None, between: dict | None = None) -> DataFrame | None:
        """A published table, or some of its parts (by key); None if there is none of it.

        ``between``: column to (least, most); pieces whose recorded range lies
        outside are not read. Rows of the others are not filtered.
        """
        return self.frame(self.tables.get(table, {}), parts, between)

    def frame(self, table: Parts, parts: Iterable[str] | None = None, between: dict | None = None) -> DataFrame | None:
        """The rows of some parts, each piece under its own schema.

        Columns that a piece does not have are null; a column that has
        different types in two pieces is an error.
        """
        wanted = set(table) if parts is None else set(parts)
        pieces = [p for key, held in table.items() if key in wanted for p in held if _meets(p, between or {})]
        if not pieces:
            return None
        groups: dict[str, list[str]] = {}
        for p in pieces:
            groups.setdefault(json.dumps(p["schema"]), []).append(p["path"])
        kinds: dict[str, str] = {}
        frames = []
        for schema, paths in reversed(groups.items()):  # the newest columns first
            fields = StructType.fromJson(json.loads(schema))
            for f in fields:
                if kinds.setdefault(f.name, f.dataType.simpleString()) != f.dataType.simpleString():
                    raise ValueError(f"column {f.name} is {kinds[f.name]} in one piece and {f.dataType.simpleString()} in another")
            # Folders are named one by one, some below a name with "=": nothing is to be inferred from them.
            frames.append(self.spark.read.option("recursiveFileLookup", True).schema(fields).parquet(*paths))
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f, allowMissingColumns=True)
        return out

    # --- writing ----------------------------------------------------------

    def _piece(self, path: str, df: DataFrame, found, ranges: Iterable[str]) -> Piece:
        return {"path": path, "schema": json.loads(df.schema.json()), "rows": found["rows"], "sum": str(found["sum"] or 0),
                "range": {c: [_text(found[f"min_{c}"]), _text(found[f"max_{c}"])] for c in ranges}}

    def stage(self, df: DataFrame, table: str, part: str = ALL, ranges: Iterable[str] = ()) -> Parts:
        """Write ``df`` as one piece of a table of the next version; its totals are those of the files written."""
        path = f"{self.staging}/{table}/all-{uuid.uuid4().hex[:8]}"
        df.write.option("compression", "zstd").parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        found = _hashed(back).agg(*_sums(), *_extremes(ranges)).first()
        return {part: [self._piece(path, df, found, ranges)]}

    def stage_by(self, df: DataFrame, table: str, column: str | Column, kind: str | None = None,
                 ranges: Iterable[str] = ()) -> Parts:
        """Write ``df`` with a part for each value of ``column`` (a column's name, or an expression of type ``kind``).

        Only the parts' totals reach the driver: one row for each part.
        """
        path = f"{self.staging}/{table}/by-{uuid.uuid4().hex[:8]}"
        kind = kind or dict(df.dtypes)[column]
        value = F.col(column) if isinstance(column, str) else column
        # A prefix keeps null, the empty text and the text "null" apart in the folders' names.
        name = F.when(value.isNull(), F.lit("null")).otherwise(F.concat(F.lit("v"), value.cast("string")))
        open_writers(self.spark)
        df.withColumn("_part_", name).write.option("compression", "zstd").partitionBy("_part_").parquet(path)
        back = self.spark.read.schema(StructType([*df.schema, StructField("_part_", StringType())])).parquet(path)
        found = {r["_part_"]: r for r in _hashed(back).groupBy("_part_").agg(*_sums(), *_extremes(ranges)).collect()}
        out: Parts = {}
        for s in self._listed(path):
            folder = s.getPath().getName()
            if s.isDirectory() and folder.startswith("_part_="):
                text = unquote(folder.removeprefix("_part_="))
                key = part_key(kind, None if text == "null" else text[1:])
                out[key] = [self._piece(f"{path}/{folder}", df, found[text], ranges)]
        return dict(sorted(out.items()))

    def upsert(self, new: Parts, table: str, keys: list[str], column: str | Column, kind: str | None = None,
               ranges: Iterable[str] = ()) -> Parts:
        """A table's parts with the staged rows ``new`` put in by key: earlier rows of the same key go.

        ``column`` (and ``kind``) are those that ``new`` was staged by; a key
        must stay in its part. Of earlier parts only those that ``new`` has
        rows of are looked at, by their key columns, and only those that lose
        rows are written again. What stays of them must be the earlier rows
        less the replaced ones, in number and in sum of hashes; or
        :class:`LostRows` is raised and nothing can be published. Keys meet as
        two 64-bit hashes, in one pass over the earlier parts that stores the
        replaced rows' hashes; a second one writes the rows that stay.
        """
        out = dict(self.tables.get(table, {}))
        earlier = self.frame(out, new)
        if earlier is not None:
            kind = kind or dict(earlier.dtypes)[column]
            value = (F.col(column) if isinstance(column, str) else column).cast("string")
            short = [c.alias(name) for c, name in zip(digest(*keys), ("_k1", "_k2"), strict=True)]
            mine = self.frame(new).select(*short).distinct()
            narrow = earlier.select(*short, value.alias("part"), row_hash(earlier).alias("hash"))
            lost = stored(narrow.join(mine, ["_k1", "_k2"], "left_semi"), f"replaced-{table}")
            gone = lost.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), exact_sum("hash").alias("sum"))
            gone = {json.dumps([kind, r["part"]]): (r["rows"], int(r["sum"])) for r in gone.collect()}
            hit = list(gone)
            if hit:
                earlier = self.frame(out, hit)
                same = [a == lost[b] for a, b in zip(digest(*[earlier[k] for k in keys]), ("_k1", "_k2"), strict=True)]
                rest = self.stage_by(earlier.join(lost, same, "left_anti"), table, column, kind, ranges)
                left = totals(rest)
                for key, (rows, total) in totals({k: out[k] for k in hit}).items():
                    kept, replaced = left.get(key, (0, 0)), gone[key]
                    if (kept[0] + replaced[0], kept[1] + replaced[1]) != (rows, total):
                        raise LostRows(f"{table} {key}: {rows} rows stored, {replaced[0]} replaced, {kept[0]} staged again")
                    out[key] = rest.get(key, [])
        for key, pieces in new.items():
            out[key] = out.get(key, []) + pieces
        self.proven(table, out, new)
        return out

    def proven(self, table: str, out: Parts, new: Parts) -> None:
        """Does every part hold the new pieces, and every part stored before still exist? :class:`LostRows` if not."""
        for key, pieces in new.items():
            if any(p not in out.get(key, []) for p in pieces):
                raise LostRows(f"{table} {key}: staged rows are missing")
        lost = set(self.tables.get(table, {})) - set(out)
        if lost:
            raise LostRows(f"{table}: parts {sorted(lost)} are missing")

    def audit(self, table: str) -> None:
        """Read a published table and compare its rows with what is recorded; :class:`LostRows` if they differ."""
        for key, want in totals(self.tables.get(table, {})).items():
            df = self.frame(self.tables[table], [key])
            got = (0, 0) if df is None else _hashed(df).agg(*_sums()).first()
            if (got[0], int(got[1] or 0)) != want:
                raise LostRows(f"{table} {key}: {want[0]} rows recorded, {got[0]} found")

    def publish(self, tables: dict[str, Parts], **info) -> int:
        """Make ``tables`` (with those not named staying as they are) the newest version.

        Raises :class:`VersionConflict` if another run has published in the
        meantime; of any number of racing runs one succeeds.
        """
        state = {"tables": self.tables | tables, "info": self.info | info}
        folder = f"{self.root}/_versions"
        fs = self._fs(folder)
        fs.mkdirs(self._path(folder))
        target = f"{folder}/{self.number + 1:08d}.json"
        if not self._put(fs, f"{folder}/.{uuid.uuid4().hex}", target, json.dumps(state).encode()):
            raise VersionConflict(f"version {self.number + 1} of {self.root} exists already")
        self.number, self.tables, self.info = self.number + 1, state["tables"], state["info"]
        self.staging = f"{self.root}/data/{self.number + 1:08d}-{uuid.uuid4().hex[:12]}"
        return self.number

    def _put(self, fs, made: str, target: str, data: bytes) -> bool:
        """A whole file at ``target`` unless there is one: in one step that only one writer can do."""

        def write(path: str) -> None:
            out = fs.create(self._path(path), False)
            out.write(bytearray(data))
            out.close()

        scheme = fs.getUri().getScheme()
        if scheme in EXCLUSIVE_CREATE:
            try:
                write(target)
            except Exception as e:
                if "exist" in str(e).lower() or "precondition" in str(e).lower():
                    return False
                raise
            return True
        write(made)
        if scheme != "file":  # a rename onto a file fails, in one step of the file system
            ok = not fs.exists(self._path(target)) and fs.rename(self._path(made), self._path(target))
        else:  # a local rename would replace the file; a link does not
            java = self.spark._jvm.java.nio.file
            local = lambda p: java.Paths.get(self._path(p).toUri().getPath(), self.spark._sc._gateway.new_array(self.spark._jvm.String, 0))
            try:
                java.Files.createLink(local(target), local(made))
                ok = True
            except Exception as e:
                if "FileAlreadyExists" not in str(e):
                    raise
                ok = False
        fs.delete(self._path(made), False)
        return bool(ok)

    # --- upkeep -----------------------------------------------------------

    def compacted(self, table: str, pieces: int = 8) -> Parts:
        """The table's parts, those of more than ``pieces`` pieces written again as one piece with the same totals."""
        out = dict(self.tables.get(table, {}))
        for key, held in out.items():
            if len(held) > pieces:
                ranges = list(held[-1]["range"])
                whole = self.stage(self.frame(out, [key]), table, key, ranges)
                if totals(whole) != totals({key: held}):
                    raise LostRows(f"{table} {key}: compaction changes the rows")
                out[key] = whole[key]
        return out

    def collect(self, keep: int = 10, retention: float = 7 * 24 * 3600, now: Callable[[], float] = time.time) -> list[str]:
        """Delete what no version needs; returns the deleted folders and version files.

        The newest ``keep`` versions and all younger than ``retention``
        seconds stay with every piece that they name; so do pieces younger
        than that, which a running batch may be about to publish. Version
        files go before the pieces that only they name.
        """
        old = now() - retention
        versions = self.versions()
        stay = set(sorted(versions)[-max(keep, 1) :]) | {n for n, t in versions.items() if t >= old}
        live = {p["path"] for n in stay for parts in self._state(n)["tables"].values() for held in parts.values() for p in held}
        gone = [f"{self.root}/_versions/{n:08d}.json" for n in versions if n not in stay]
        for staging in self._listed(f"{self.root}/data"):
            own = f"{self.root}/data/{staging.getPath().getName()}"
            if any(p.startswith(f"{own}/") for p in live):  # of a live batch, only its dead pieces
                for table in self._listed(own):
                    for piece in self._listed(f"{own}/{table.getPath().getName()}"):
                        path = f"{own}/{table.getPath().getName()}/{piece.getPath().getName()}"
                        inner = [f"{path}/{x.getPath().getName()}" for x in self._listed(path) if x.isDirectory()]
                        gone += [x for x in inner or [path] if x not in live and piece.getModificationTime() / 1000 < old]
            elif staging.getModificationTime() / 1000 < old:
                gone.append(own)
        for path in gone:
            self._fs(path).delete(self._path(path), True)
        return gone


def _extremes(ranges: Iterable[str]) -> list[Column]:
    return [f(c).alias(f"{name}_{c}") for c in ranges for name, f in (("min", F.min), ("max", F.max))]


def _meets(piece: Piece, between: dict) -> bool:
    """Can a piece hold rows whose columns lie in ``between``? Yes, where nothing is recorded."""
    for c, (low, high) in between.items():
        if c in piece["range"]:
            least, most = piece["range"][c]
            if least is None or most < _text(low) or least > _text(high):
                return False
    return True
