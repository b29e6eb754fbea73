"""Cross-entropy difference: is a text more like a target corpus than like everything?

Two word models, one of the target texts and one of all texts, are matched:
same vocabulary, same order (two words), same smoothing. A text's score is
the mean over its words of the loss under the target model minus the loss
under the background model; below zero means closer to the target. A text
that the models were learned from is scored by models without it: its own
counts come off both, or a score would say what was learned from, not what it
is like.

The vocabulary is every word of the corpus, and the counts of words and word
pairs are exact and over all texts. Both grow with the corpus, so no task and
no driver holds them. Texts are dealt into slices, which are stored; a slice
sends each of its distinct words and pairs once, with its own counts, to the
bucket of the key's hash. A bucket adds up what all slices sent and answers
each slice with the sums of its keys, with which the slice scores its texts.
A frequent pair makes one entry for each slice, not for each place it has.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm import tokens as T
from starfold.llm.base import staged, table
from starfold.llm.toxicity import NOT_WORD

#: Weight of the pair's own frequency against that of the single word.
OWN = 0.75
#: Distinct words that a task counts before it hands them on.
HELD = 1 << 20
#: Words of texts that are scored together.
TOGETHER = 1 << 17
#: Bytes of text of a slice (a longer text is a slice of its own).
SLICE = 1 << 24
#: A slice (``bucket`` -1), what it sends to a bucket, or what a bucket answers.
ROW = "slice long, bucket int, kind int, a binary, b binary, c binary, d binary, e binary"
PAIRS, WORDS = 0, 1

_A, _B = (np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
_ZSTD = "zstd"


def _words(batch: pa.RecordBatch, column: int):
    texts = T.utf8(batch.column(column))
    for a, b in T.slices(texts):
        yield a, b, T.Words(texts[a:b], blank=NOT_WORD)


def vocabulary(docs: DataFrame, size: int) -> np.ndarray:
    """Sorted hashes of the most frequent words (ties: smaller hash first), from counts of all words of ``text``."""

    def count(batches):
        keys, seen = np.zeros(0, np.uint64), np.zeros(0, np.int64)

        def out():
            for i in range(0, len(keys), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + (1 << 16)].view(np.int64)), pa.array(seen[i : i + (1 << 16)])],
                                                 ["word", "n"])

        for batch in batches:
            for _, _, w in _words(batch, 0):
                one, n = np.unique(w.hashes(), return_counts=True)
                keys, back = np.unique(np.concatenate([keys, one]), return_inverse=True)
                seen = np.bincount(back, np.concatenate([seen, n]), len(keys)).astype(np.int64)
            if len(keys) > HELD:
                yield from out()
                keys, seen = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        yield from out()

    words = docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = words.orderBy(F.col("n").desc(), "word").limit(size - 1).collect()  # the vocabulary's size
    return np.sort(np.array([r["word"] for r in top], dtype=np.int64).view(np.uint64))


def pack(x: np.ndarray) -> bytes:
    """Numbers from 0 as compressed byte planes, as many as the largest needs."""
    x = x.astype("<u8")
    planes = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
    data = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :planes].T).tobytes()
    return np.array([len(x), planes], "<u8").tobytes() + (pa.compress(data, _ZSTD, asbytes=True) if data else b"")


def unpack(data: bytes) -> np.ndarray:
    n, planes = np.frombuffer(data, "<u8", 2).astype(int).tolist()
    out = np.zeros((n, 8), dtype=np.uint8)
    if n and planes:
        flat = np.frombuffer(pa.decompress(data[16:], n * planes, _ZSTD, asbytes=True), np.uint8)
        out[:, :planes] = flat.reshape(planes, n).T
    return out.reshape(-1).view("<u8")


def _batch(*rows: tuple) -> pa.RecordBatch:
    cols = list(zip(*(r + (None,) * (8 - len(r)) for r in rows), strict=True))
    kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 5]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                      ["slice", "bucket", "kind", "a", "b", "c", "d", "e"])


def _slices(rows: DataFrame, known) -> DataFrame:
    """Slices of rows ``doc_id, text, target``: ids, marks, numbers of words, distinct words, the texts as places in them.

    Word 0 stands before the first word of a text and for words that are not
    in ``known`` (a broadcast of sorted hashes; none: all words are known).
    """

    def cut(batches):
        part, n, held, size = TaskContext.get().partitionId(), 0, [], 0

        def out():
            ids = pa.concat_arrays([h[0] for h in held])
            target = np.concatenate([h[1] for h in held])
            w = T.Words([t for h in held for t in h[2]], blank=NOT_WORD)
            h = w.hashes()
            if known is not None:
                at = np.minimum(np.searchsorted(known.value, h), max(len(known.value) - 1, 0))
                h = np.where(known.value[at] == h, h, np.uint64(0)) if len(known.value) else np.zeros_like(h)
            words, back, many = np.unique(h, return_inverse=True, return_counts=True)
            many[words == 0] = len(h) + 1
            order = np.argsort(-many, kind="stable")
            place = np.empty(len(words), dtype=np.int64)
            place[order] = np.arange(len(words))
            words = words[order]
            if not len(words) or words[0]:
                words, place = np.concatenate([[np.uint64(0)], words]), place + 1
            marks = target + 2 * np.array(ids.is_null())
            return _batch((part << 32 | n, -1, 0, pack(ids.fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64)), pack(marks),
                           pack(np.diff(w.first)), words.tobytes(), pack(place[back])))

        for batch in batches:
            texts = T.utf8(batch.column(1))
            target = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            for a, b in T.slices(texts, SLICE):
                more = sum(map(len, texts[a:b])) + b - a
                if held and size + more > SLICE:
                    yield out()
                    n, held, size = n + 1, [], 0
                held.append((batch.column(0)[a:b], target[a:b], texts[a:b]))
                size += more
        if held:
            yield out()

    return rows.mapInArrow(cut, ROW)


class Slice:
    """A stored slice and its keys: distinct pairs and words, each kind in the order of its hashes."""

    def __init__(self, row: dict):
        self.ids, self.marks, self.size, now = (unpack(row[c]).astype(np.int64) for c in ("a", "b", "c", "e"))
        self.words = np.frombuffer(row["d"], np.uint64)
        self.first = np.concatenate([[0], np.cumsum(self.size)])
        before = np.concatenate([[0], now[:-1]])[: len(now)]
        before[self.first[:-1][self.first[:-1] < len(now)]] = 0
        self.now, self.before = now, before
        pairs, back = np.unique(before * len(self.words) + now, return_inverse=True)
        self.one, self.two = pairs // len(self.words), pairs % len(self.words)
        key = T.mix(T.mix(self.words[self.one] + _A) ^ (self.words[self.two] * _B))
        order = np.argsort(key, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.one, self.two, self.pair = self.one[order], self.two[order], place[back]
        self.by_word = np.argsort(T.mix(self.words), kind="stable")
        self.keys = {PAIRS: key[order], WORDS: T.mix(self.words)[self.by_word]}

    def counts(self) -> dict[int, np.ndarray]:
        """Under target and all texts (rows) the counts of the pairs; of the words, and of the words as the word before."""
        hit = np.repeat((self.marks & 1).astype(bool), self.size)
        n = len(self.words)
        count = lambda x, size: [np.bincount(x[hit], minlength=size), np.bincount(x, minlength=size)]
        words = np.array(count(self.now, n) + count(self.before, n))
        return {PAIRS: np.array(count(self.pair, len(self.one))), WORDS: words[:, self.by_word]}


    def parts(self):
        """Ranges of texts of about ``TOGETHER`` words (a longer text is one of its own)."""
        begin = 0
        for i in range(1, len(self.size) + 1):
            if i == len(self.size) or self.first[i + 1] - self.first[begin] > TOGETHER:
                yield begin, i
                begin = i


def _own(text: np.ndarray, values: np.ndarray, kinds: int) -> np.ndarray:
    """For each place: how often its text has the value that stands there (one of ``kinds``)."""
    _, back, many = np.unique(text * kinds + values, return_inverse=True, return_counts=True)
    return many[back]


def _cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where in sorted keys each bucket begins; the hash range is cut into equal parts."""
    edges = np.array([(i << 64) // buckets for i in range(buckets)], dtype=np.uint64)
    return np.append(np.searchsorted(keys, edges), len(keys))


def _send(slices: DataFrame, buckets: int, learn: bool, ask: bool) -> DataFrame:
    """What slices send to each bucket: sorted keys, their counts (``learn``), whether they want an answer."""

    def send(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                s = Slice(row)
                counts = s.counts() if learn else {}
                for kind, keys in s.keys.items():
                    cut = _cuts(keys, buckets).tolist()
                    yield _batch(*((row["slice"], j, kind, pack(np.diff(keys[a:b], prepend=np.uint64(0))),
                                    pack(counts[kind][:, a:b].reshape(-1)) if learn else None, b"1" if ask else None)
                                   for j, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True))))

    return slices.mapInArrow(send, ROW)


def _groups(batches, *names: str):
    """Rows of sorted batches, those with equal ``names`` together."""
    key, held = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            now = tuple(batch.column(n)[i].as_py() for n in names)
            if held and now != key:
                yield key, held
                held = []
            key = now
            held.append(batch.slice(i, 1).to_pylist()[0])
    if held:
        yield key, held


def _answer(batches):
    """A bucket's sums over all slices, for each slice that asks: those of its keys; of the bucket: distinct words, their counts."""
    for (bucket, kind), rows in _groups(batches, "bucket", "kind"):
        parts = [np.cumsum(unpack(r["a"]), dtype=np.uint64) for r in rows]
        one, back = np.unique(np.concatenate(parts), return_inverse=True)
        ends = np.cumsum([0, *map(len, parts)]).tolist()
        total = np.zeros((4 if kind == WORDS else 2, len(one)), dtype=np.int64)
        for r, a, b in zip(rows, ends[:-1], ends[1:], strict=True):
            if r["b"] is not None:
                total[:, back[a:b]] += unpack(r["b"]).astype(np.int64).reshape(len(total), -1)  # a slice names a key once
        own = [int(((total[1] > 0) & (one != T.mix(np.zeros(1, np.uint64))[0])).sum()), *total[:2].sum(axis=1).tolist()]
        for r, a, b in zip(rows, ends[:-1], ends[1:], strict=True):
            if r["c"] is not None:
                yield _batch((r["slice"], bucket, kind, pack(total[:, back[a:b]].reshape(-1)), pack(np.array(own))))


@dataclass
class Models:
    """The texts both models are learned from, as stored slices with their marks; counts are added up where they are asked for."""

    docs: DataFrame
    slices: DataFrame
    known: object
    size: int | None


def fit(docs: DataFrame, targets: DataFrame, size: int | None = None) -> Models:
    """Models of the texts of ``targets`` (a table of ``doc_id``) and of all texts of ``docs`` (``doc_id, text``).

    The vocabulary is all words; with ``size`` it is that many symbols, one
    for all but the most frequent words. Null texts have no words. An empty
    target corpus makes every word equally likely in it.
    """
    known = docs.sparkSession.sparkContext.broadcast(vocabulary(docs, size)) if size else None  # as large as the caller says
    marks = targets.select(F.col("doc_id").alias("_id")).where("_id is not null").distinct().withColumn("_hit", F.lit(True))
    # The marks grow with the corpus: one plan for every size, a merge join.
    rows = docs.select("doc_id", "text").join(marks.hint("merge"), F.col("doc_id") == F.col("_id"), "left")
    rows = rows.select(F.col("doc_id").cast("long"), "text", F.coalesce("_hit", F.lit(False)).alias("target"))
    return Models(docs, staged(_slices(rows, known), "lm_slices"), known, size)


def score(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, target_loss, background_loss, score`` for each row, over whole texts.

    Losses are means over words (natural logarithm): a pair's share after the
    word before, mixed with the word's share overall, to whose count one is
    added. A word that the models have not seen has the count zero, and after
    it words have their share overall. If ``docs`` is the table that the
    models were learned from, each row is scored without its own counts (of
    repeated rows each without one of them). A null text, or one without words, has
    zero words and null losses and score. Repeated rows are scored each;
    further columns are ignored, whatever their names.
    """
    size, buckets = models.size, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if docs is models.docs and (id_col, text_col) == ("doc_id", "text"):
        asked, sent, learned = models.slices, _send(models.slices, buckets, True, True), True
    else:
        learned = False
        rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.lit(False).alias("target"))
        asked = staged(_slices(rows, models.known), "lm_asked")
        sent = _send(models.slices, buckets, True, False).union(_send(asked, buckets, False, True))

    def run(batches):
        for _, rows in _groups(batches, "slice"):
            s = Slice(rows[0])
            got, own = {}, np.zeros(3, dtype=np.int64)
            for kind, many in ((PAIRS, 2), (WORDS, 4)):
                answers = [r for r in rows[1:] if r["kind"] == kind]
                got[kind] = np.concatenate([unpack(r["a"]).astype(np.int64).reshape(many, -1) for r in answers], axis=1)
            own = sum(unpack(r["b"]).astype(np.int64) for r in rows[1:] if r["kind"] == WORDS)
            words = np.empty_like(got[WORDS])
            words[:, s.by_word] = got[WORDS]
            n, mean = s.size, np.full((2, len(s.size)), np.nan)
            for begin, end in s.parts():  # memory for places is that of a few texts
                many = n[begin:end]
                at = slice(s.first[begin], s.first[end])
                now, before, pair = s.now[at], s.before[at], s.pair[at]
                text = np.repeat(np.arange(len(many)), many)
                mine = (0, 0, 0)
                if learned:
                    mine = (_own(text, pair, len(s.one)), _own(text, now, len(s.words)), _own(text, before, len(s.words)))
                for j in (0, 1):
                    # The target model has a text's counts only if it is one of its texts.
                    of = ((s.marks[begin:end] & 1 if j == 0 else np.ones_like(many)) * learned)[text]
                    single = words[j][now] - of * mine[1] + 1.0
                    single /= own[1 + j] + (size or own[0] + 1) - of * many[text]
                    prior = words[2 + j][before] - of * mine[2]
                    share = np.divide(got[PAIRS][j][pair] - of * mine[0], prior, out=single.copy(), where=prior > 0)
                    total = np.bincount(text, -np.log(OWN * share + (1 - OWN) * single), len(many))
                    mean[j, begin:end] = np.divide(total, many, out=np.full(len(many), np.nan), where=many > 0)
            none = n == 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(s.ids, mask=s.marks > 1), pa.array(n), *(pa.array(m, mask=none) for m in (*mean, mean[0] - mean[1]))],
                ["doc_id", "n_words", "target_loss", "background_loss", "score"])

    answers = sent.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(_answer, ROW)
    rows = asked.union(answers).repartition(buckets, "slice").sortWithinPartitions("slice", "bucket")
    return rows.mapInArrow(run, "doc_id long, n_words long, target_loss double, background_loss double, score double")


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's cross-entropy difference; target: documents labelled as good."""
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels").where("quality = 1")))


QUERIES = {"op7_lm_score": op7_lm_score}
SQL: dict[str, str] = {}
