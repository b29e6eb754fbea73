"""N-gram Jaccard self-join over a prefix tree.

1. Each text becomes its set of distinct shingle hashes. Equal sets are one
   set from here on, standing under its smallest id.
2. Blocks. Two linked sets differ in at most ``D`` shingles, a number that
   follows from their sizes and the threshold. When the hash range is cut
   into more than ``D`` segments, at least one segment is the same in both.
   There are more segments than ``D + 1``, so linked sets agree in several of
   them: in more than their slack, a number known for each set. Pairs that
   agree in as many get into one block (connected components). A passage or
   line that texts share makes few segments equal and does not bring them
   together. A segment found in more than ``HOT`` sets is not paired:
   it lowers, for the sets that have it, the number of others to agree in,
   and where nothing is left of that number, sets that share it go into one
   block without being paired. So large groups of copies stay together.
3. Each block's sets are stored once in a prefix tree, in one order for all
   of them (most frequent shingle first, so that similar sets share long
   paths). A set walks down all branches at once, level by level; the overlap
   of a shared path is counted once, and a subtree is left when even its
   remaining length cannot reach the overlap that the threshold asks for.
4. Links give the components.

A block larger than ``BLOCK_ROWS`` or ``BLOCK_SHINGLES`` is cut into parts,
and each pair of parts is a task of its own. Only links that join two
groups within a task are returned, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm import tokens as T
from starfold.llm.base import spread, staged, table, without_ids
from starfold.llm.graph import components

#: A segment in more sets than this is a common one.
HOT = 8
SLACK, LOW32 = (1 << 24) - 1, (1 << 32) - 1
#: A task compares at most two parts of this size.
BLOCK_ROWS = 4_000
BLOCK_SHINGLES = 4_000_000


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and plain shingle hashes of each text of a batch (column 1)."""
    texts = T.utf8(batch.column(1))
    for a, b in T.slices(texts):
        w = T.Words(texts[a:b])
        yield from zip(range(a, b), T.shingles(w.hashes(), w.first, k), strict=True)


def size_class(n: int, num: int, den: int) -> tuple[int, int]:
    """Number and upper bound of the class of size ``n``; bounds grow by ``den / num``."""
    c, top = 0, 1
    while top < n:
        c, top = c + 1, max(top + 1, top * den // num)
    return c, top


def segments(s: np.ndarray, num: int, den: int) -> list[tuple[np.ndarray, int, int]]:
    """For each class a sorted set is cut for: hashes of its segments, the class, and its slack.

    Linked sets have more segments of one class in common than the slack of
    either.

    A pair is matched in the size class of its larger set. A set is cut for
    its own class and for those that sets up to ``den / num`` times as large
    can be in. Sets of a class of up to ``top`` shingles differ in at most
    ``D = 2 * top * (den - num) / (den + num)``, and each difference spoils
    one segment: if one of the two has more than ``D`` segments that are not
    empty, one of those is whole in both. A set with fewer also puts out its
    empty ones, for others like it.
    """
    out = []
    n = len(s)
    c, top = size_class(n, num, den)
    while True:
        most = 2 * top * (den - num) // (den + num)
        m = most + 1 + most // 4
        of = ((s >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        begin = np.flatnonzero(np.diff(of.astype(np.int64), prepend=-1))
        of = of[begin]
        salt = T.mix((of << np.uint64(16)) + np.uint64(c + 1))
        cut = T.mix(np.add.reduceat(T.mix(s), begin) ^ salt)
        if len(begin) <= most:
            empty = np.setdiff1d(np.arange(m, dtype=np.uint64), of)
            cut = np.concatenate([cut, T.mix(T.mix((empty << np.uint64(16)) + np.uint64(c + 1)))])
        out.append((cut, c, max(len(begin) - most - 1, 0)))
        if top >= n * den // num:
            return out
        c, top = c + 1, max(top + 1, top * den // num)


def _ragged(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *(len(p) for p in parts)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *parts])))


class PrefixTree:
    """Sets of numbers as a path-compressed prefix tree in flat arrays."""

    def __init__(self, sets: list[np.ndarray]):
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].tobytes())
        # Equal prefixes are neighbours after sorting by the bytes of the numbers.
        edges: list[np.ndarray] = []
        kids: list[list[int]] = [[]]
        self.rows: list[list[int]] = [[]]  # sets that end at a node
        least, most = [0], [0]
        path: list[tuple[int, int]] = [(0, 0)]  # (node, depth) from the root down
        before = np.zeros(0, dtype=np.int64)
        edges.append(before)
        for i in self.order:
            s = sets[i]
            m = min(len(s), len(before))
            differ = np.flatnonzero(s[:m] != before[:m])
            common = int(differ[0]) if len(differ) else m
            last = None
            while path[-1][1] > common:
                last = path.pop()
            node, depth = path[-1]
            if depth < common:  # cut the last edge in two
                child = last[0]
                keep = common - depth
                mid = len(edges)
                edges.append(edges[child][:keep])
                edges[child] = edges[child][keep:]
                kids[node][-1] = mid
                kids.append([child])
                self.rows.append([])
                path.append((mid, common))
                node = mid
            if common < len(s):
                new = len(edges)
                edges.append(s[common:])
                kids.append([])
                self.rows.append([])
                kids[node].append(new)
                path.append((new, len(s)))
                node = new
            self.rows[node].append(i)
            before = s
        n = len(edges)
        self.depth = np.zeros(n, dtype=np.int64)
        least, most = np.full(n, 1 << 62), np.zeros(n, dtype=np.int64)
        walk = [0]
        for v in walk:
            for c in kids[v]:
                self.depth[c] = self.depth[v] + len(edges[c])
                walk.append(c)
        for v in reversed(walk):  # sizes of the sets below each node
            if self.rows[v]:
                least[v] = most[v] = self.depth[v]
            for c in kids[v]:
                least[v], most[v] = min(least[v], least[c]), max(most[v], most[c])
        # Children of a node are neighbours when nodes are numbered breadth first.
        number = np.empty(n, dtype=np.int64)
        number[walk] = np.arange(n)
        self.least, self.most, self.depth = least[walk], most[walk], self.depth[walk]
        self.rows = [self.rows[v] for v in walk]
        self.ends = np.array([bool(r) for r in self.rows])
        count = np.array([len(kids[v]) for v in walk])
        self.first = np.concatenate([[1], 1 + np.cumsum(count)[:-1]]).astype(np.int64)
        self.count = count
        size = np.array([len(edges[v]) for v in walk], dtype=np.int64)
        self.begin = np.concatenate([[0], np.cumsum(size)[:-1]])
        self.size = size
        flat = np.concatenate([edges[v] for v in walk])
        self.universe, self.flat = np.unique(flat, return_inverse=True)
        self.mark = np.zeros(len(self.universe) + 1, dtype=np.int64)

    def search(self, s: np.ndarray, num: int, den: int) -> list[int]:
        """Sets of the tree with ``den * common >= num * union`` to ``s``."""
        n = len(s)
        at = np.searchsorted(self.universe, s)
        at = at[(at < len(self.universe)) & (self.universe[np.minimum(at, len(self.universe) - 1)] == s)]
        self.mark[at] = 1
        found: list[int] = []
        nodes, common = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
        while len(nodes):
            many = self.count[nodes]
            total = int(many.sum())
            if not total:
                break
            offset = np.arange(total) - np.repeat(np.cumsum(many) - many, many)
            kid = np.repeat(self.first[nodes], many) + offset
            up = np.repeat(common, many)
            # Before an edge is read: the rest of the subtree's longest set and of s, all in common.
            ok = self._reach(kid, up, np.minimum(self.most[kid] - self.depth[kid] + self.size[kid], n - up), n, num, den)
            kid, up = kid[ok], up[ok]
            if not len(kid):
                break
            size = self.size[kid]
            where = np.repeat(self.begin[kid] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
            got = np.add.reduceat(self.mark[self.flat[where]], np.cumsum(size) - size)
            common = up + got
            ok = self._reach(kid, common, np.minimum(self.most[kid] - self.depth[kid], n - common), n, num, den)
            nodes, common = kid[ok], common[ok]
            end = self.ends[nodes]
            for v, o in zip(nodes[end].tolist(), common[end].tolist(), strict=True):
                if den * o >= num * (n + int(self.depth[v]) - o):
                    found.extend(self.rows[v])
        self.mark[at] = 0
        return found

    def _reach(self, node, common, rest, n, num, den):
        """Can a set below ``node`` still be linked? Its overlap is at most ``common + rest``, its size at least ``least``."""
        best = common + rest
        return (den * best >= num * (n + np.maximum(self.least[node], best) - best)) & (den * self.most[node] >= num * n)


def _links(left: list[np.ndarray], right: list[np.ndarray] | None, num: int, den: int) -> Iterator[tuple[int, int]]:
    """Links (positions in left + right) that join groups; ``right`` None: within ``left``."""
    # The walk is short when similar sets share their paths: most frequent first.
    every = left + (right or [])
    values, code, count = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), dtype=np.int64)
    rank[np.lexsort((values, -count))] = np.arange(len(values))
    ends = np.cumsum([len(s) for s in every])[:-1]
    every = [np.sort(x) for x in np.split(rank[code], ends)]
    left, right = every[: len(left)], every[len(left) :] if right else None
    tree = PrefixTree(left)
    probes = left if right is None else right
    shift = 0 if right is None else len(left)
    root = list(range(len(left) + (len(right) if right is not None else 0)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, s in enumerate(probes):
        for j in tree.search(s, num, den):
            a, b = find(i + shift), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                yield i + shift, j


def _runs(batches, keys: int) -> Iterator[tuple[tuple, list]]:
    """Rows (as column lists) of each run of equal leading ``keys`` columns of a sorted stream."""
    key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)]
        change = np.zeros(batch.num_rows, dtype=bool)
        change[0] = True
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        at = np.flatnonzero(change).tolist() + [batch.num_rows]
        for a, b in zip(at[:-1], at[1:], strict=True):
            now = tuple(c[a] for c in cols)
            if now != key and held:
                yield key, held
                held = []
            key = now
            held.append(batch.slice(a, b - a))
    if held:
        yield key, held


def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                 threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """One row for each document: its set size and its component of similar texts.

    Two documents are linked when the Jaccard similarity of their sets of
    ``k``-word shingles is at least ``num / den``. Words are runs without
    ASCII blanks, A-Z in lower case. A text of fewer words has its whole
    sequence as one shingle; null, empty and blank texts have an empty set
    and are linked with nothing. Rows with one id and one text count as one
    node; a null id is dropped from links and returned with a null component.
    Further columns are ignored, whatever their names; an empty table gives an
    empty one.

    Columns: ``doc_id, n_shingles, component_id`` (the smallest id reachable).
    """
    num, den = threshold
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def summaries(batches):
        for batch in batches:
            sets = [s for _, s in _sets(batch, k)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_signature(s) if len(s) else None for s in sets], pa.binary())], ["doc_id", "n", "sig"])

    def cut(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for rows in _chunks(((ids[i], s) for i, s in _sets(batch, k) if len(s) and ids[i] is not None), 2048):
                segs = [(x, len(s) << 32 | c << 24 | min(slack, SLACK), i) for i, s in rows for x, c, slack in segments(s, num, den)]
                many = np.array([len(x) for x, _, _ in segs])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([x for x, _, _ in segs]).astype(np.int64)),
                     *(pa.array(np.repeat(np.array([x[j] for x in segs], dtype=np.int64), many)) for j in (1, 2))],
                    ["seg", "size", "rep"])

    one = staged(d.mapInArrow(summaries, "doc_id long, n long, sig binary"), "sets")
    reps = one.where("sig is not null").groupBy("sig").agg(F.min("doc_id").alias("rep"))
    reps = staged(reps.where("rep is not null"), "reps")
    postings = d.mapInArrow(cut, "seg long, size long, rep long")

    near = spread(postings, "seg").sortWithinPartitions("seg", "size", "rep").mapInArrow(
        lambda batches: _neighbours(batches, num, den), "hot int, a long, b long, ca long, cb long, n long")
    near = staged(near, "near")
    hot = near.where("hot = 1").select("a", "b", "ca")
    has = hot.groupBy("a", "ca").agg(F.count("*").alias("h"))  # common segments of a set in a class
    slack = lambda c: F.col(c).bitwiseAND(F.lit(SLACK))
    made_of = hot.join(has.where(F.col("h") > slack("ca")).select("a", "ca"), ["a", "ca"], "left_semi")
    hubs = made_of.groupBy("b").agg(F.min("a").alias("hub"))
    pairs = near.where("hot = 0").groupBy("a", "b", "ca", "cb").agg(F.sum("n").alias("n"))
    pairs = pairs.join(has.withColumnRenamed("h", "ha"), ["a", "ca"], "left").join(
        has.select(F.col("a").alias("b"), F.col("ca").alias("cb"), F.col("h").alias("hb")), ["b", "cb"], "left")
    for c, h in (("ca", "ha"), ("cb", "hb")):
        pairs = pairs.where(F.col("n") > slack(c) - F.coalesce(h, F.lit(0)))
    near = pairs.select(F.col("a").alias("src"), F.col("b").alias("dst")).union(
        made_of.join(hubs, "b").where("a <> hub").select("a", "hub"))
    blocks = components(near).select(F.col("id").alias("rep"), F.col("comp").alias("block")).join(reps, "rep")
    alone = blocks.groupBy("block").agg(F.count("*").alias("c")).where("c > 1").select("block")
    blocks = staged(blocks.select("rep", "block").join(alone, "block"), "blocks")

    # Parts of large blocks; every pair of parts, and each part with itself, is a task.
    size = blocks.join(one.select(F.col("doc_id").alias("rep"), "n").distinct(), "rep")
    parts = size.groupBy("block").agg(F.greatest(F.ceil(F.count("*") / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_SHINGLES))
                                      .cast("int").alias("parts"))
    members = blocks.join(parts, "block").withColumn("part", F.pmod(F.xxhash64("rep"), "parts").cast("int"))
    texts = d.join(members, d["doc_id"] == members["rep"]).select("rep", "text", "block", "part", "parts")

    def full(batches):
        for batch in batches:
            sets = [s.astype(np.int64) for _, s in _sets(batch, k)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in (0, 2, 3, 4)), _ragged(sets)],
                                             ["rep", "block", "part", "parts", "tokens"])

    sets = texts.mapInArrow(full, "rep long, block long, part int, parts int, tokens array<long>")
    tasks = sets.select("block", F.explode(F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda o: F.struct(F.least(o, "part").alias("i"), F.greatest(o, "part").alias("j")))).alias("x"),
        "part", "rep", "tokens").select("block", "x.i", "x.j", "part", "rep", "tokens")
    tasks = spread(tasks, "block", "i", "j").sortWithinPartitions("block", "i", "j", "part", "rep")

    def compare(batches):
        for (_, i, j), held in _runs(batches, 3):
            rep, part, rows = [], [], []
            for b in held:
                part += b.column(3).to_pylist()
                rep += b.column(4).to_pylist()
                rows += list(_unpack(b.column(5)))
            twice = next((x for x in range(1, len(part)) if part[x] != part[x - 1]), len(part))
            right = rows[twice:] if i != j else None
            found = list(_links(rows[:twice], right, num, den)) if i == j or right else []
            yield pa.RecordBatch.from_arrays(
                [pa.array([rep[a] for a, _ in found], pa.int64()), pa.array([rep[b] for _, b in found], pa.int64())],
                ["src", "dst"])

    links = components(tasks.mapInArrow(compare, "src long, dst long"))
    comps = reps.join(links.withColumnRenamed("id", "rep"), "rep", "left").select(
        "sig", F.coalesce("comp", "rep").alias("component_id"))
    return one.select("doc_id", F.col("n").alias("n_shingles"), "sig").join(comps, "sig", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _chunks(rows, n: int) -> Iterator[list]:
    held = []
    for x in rows:
        held.append(x)
        if len(held) == n:
            yield held
            held = []
    if held:
        yield held


def _neighbours(batches, num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Runs of sets with an equal segment, from postings sorted by segment and size.

    A run ends where sizes have a gap that no link can span. Of runs of up to
    HOT sets, their pairs (0, set, set, class and slack of each, how often);
    of a longer one, its members (1, set, number of the run, class and slack).
    """
    empty = np.zeros(0, dtype=np.int64)
    held = (empty, empty, empty)  # the last run, which may go on; of a common one only its last member
    common: int | None = None  # the number of the held run, if it is a common one

    def out(hot, a, b, ca, cb, n):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), hot, np.int32)), *map(pa.array, (a, b, ca, cb, n))],
                                          ["hot", "a", "b", "ca", "cb", "n"])

    def runs(seg, size, rep, last):
        nonlocal held, common
        n = size >> 32
        first = np.ones(len(seg), dtype=bool)
        first[1:] = (seg[1:] != seg[:-1]) | (den * n[:-1] < num * n[1:])
        begin = np.flatnonzero(first)
        many = np.diff(np.append(begin, len(seg)))
        number = T.mix(seg[begin].astype(np.uint64) ^ T.mix(rep[begin].astype(np.uint64))).astype(np.int64)
        hot = many > HOT
        skip = 0
        if common is not None:  # its last member stands first, and is out already
            number[0], hot[0], skip = common, True, 1
        common = None
        stay = len(seg)
        if not last:
            if hot[-1]:
                common = int(number[-1])
            else:
                stay = int(begin[-1])
            keep = slice(len(seg) - 1, None) if common is not None else slice(stay, None)
            held = (seg[keep], size[keep], rep[keep])
        else:
            held = (empty, empty, empty)
        member = np.repeat(np.arange(len(begin)), many)[:stay]
        is_hot = hot[member]
        is_hot[:skip] = False
        at = np.flatnonzero(is_hot)
        if len(at):
            none = np.zeros(len(at), np.int64)
            yield out(1, rep[at], number[member[at]], size[at] & LOW32, none, none)
        found = []
        cold = ~hot[member]
        for step in range(1, HOT):
            at = np.flatnonzero(cold[: len(member) - step] & (member[step:] == member[: len(member) - step]))
            if not len(at):
                break
            x, y = np.where(rep[at] > rep[at + step], (at, at + step), (at + step, at))
            found.append(np.stack([rep[x], rep[y], size[x] & LOW32, size[y] & LOW32], axis=1))
        if found:
            pairs, n = np.unique(np.concatenate(found), axis=0, return_counts=True)
            pairs, n = pairs[pairs[:, 0] != pairs[:, 1]], n[pairs[:, 0] != pairs[:, 1]]
            yield out(0, *pairs.T, n)

    for batch in batches:
        if batch.num_rows:
            cols = [np.concatenate([h, batch.column(i).to_numpy()]) for i, h in enumerate(held)]
            yield from runs(*cols, False)
    if len(held[0]):
        yield from runs(*held, True)


def _signature(s: np.ndarray) -> bytes:
    from hashlib import blake2b

    return blake2b(s.tobytes(), digest_size=16).digest()


def _unpack(column: pa.Array) -> Iterator[np.ndarray]:
    values, ends = column.values.to_numpy(), column.offsets.to_numpy()
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        yield values[a:b]


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """Of each component of similar texts the row with the smallest id stays, with all its columns."""
    gone = similar_sets(docs, id_col, text_col, **kw).where("component_id <> doc_id")
    return without_ids(docs, gone, id_col)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by four-word shingles at a similarity of 0.85."""
    return similar_sets(table(spark, sf_dir, "documents"), k=4, threshold=(85, 100))


QUERIES = {"op2_ngram_join": op2_ngram_join}
SQL: dict[str, str] = {}
