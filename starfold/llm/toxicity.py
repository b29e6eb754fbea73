"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A text is cut into overlapping windows of ``WINDOW`` words. Each word enters
as the sum of a word vector and the mean of the vectors of its character
runs of three to five (with the word's ends marked), all from one hashed
table. A gated recurrent network reads the window forwards, another one
backwards; attention pools their states; a logistic unit gives the window's
score. A text scores as its highest window.

Training is plain numpy on the driver over a bounded sample: a text labelled
clean has only clean windows, of a toxic one the window that scores highest
is the toxic one. At the end the scores are calibrated on the sample's texts.
Scoring is one pass over all texts, with no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starfold.llm import tokens as T
from starfold.llm.base import fold, table, without_ids

#: Windows begin every ``STRIDE`` words, so that a passage of up to 20 words is whole in one of them.
WINDOW, STRIDE = 40, 20
ROWS, DIM, HIDDEN = 1 << 18, 16, 8
RUNS = (3, 4, 5)
#: Bounds of the training sample: texts of each label, characters of a text that may be in it, and of all texts of a label.
SAMPLE = {1: 1_500, 0: 3_500}
SAMPLE_CHARS = 20_000
SAMPLE_TOTAL = {1: 3_000_000, 0: 6_000_000}
EPOCHS, BATCH, RATE = 5, 512, 0.01
#: Word vectors learn more slowly than the network, so that it does not learn the sample by heart.
EMB_RATE = 0.4
THRESHOLD = 0.7
#: Weight of the calibration's prior (slope 1, shift 0).
PRIOR = 0.02
#: Word types are prepared in parts of this many.
PART = 8_192
#: Texts are scored in slices of this many bytes; those to learn from are prepared in slices of the other.
SLICE, TRAIN_SLICE = 1 << 22, 1 << 19
#: Windows that go through the network together.
TOGETHER = 1_024

#: Words are runs of ASCII letters and digits and of bytes of other characters.
NOT_WORD = np.ones(256, dtype=bool)
NOT_WORD[128:] = NOT_WORD[48:58] = NOT_WORD[65:91] = NOT_WORD[97:123] = False


def features(words: T.Words, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the hashed table for the words ``pick``: (word row, flat rows of character runs, begin of each word's)."""
    parts = [_features(words, pick[i : i + PART]) for i in range(0, len(pick), PART)]
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    count = np.concatenate([x[2] for x in parts])
    return np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts]), np.cumsum(count) - count


def _features(words: T.Words, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    begin, size = words.start[pick], words.end[pick] - words.start[pick]
    # The picked words side by side, each between two marks (a byte that no word holds).
    room = size + 2
    at = np.cumsum(room) - room
    flat = np.full(int(room.sum()) + max(RUNS), 0x20, dtype=np.uint8)
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    flat[np.repeat(at + 1, size) + inner] = words.buf[np.repeat(begin, size) + inner]
    row = (words.hashes()[pick] % np.uint64(ROWS)).astype(np.int64)
    starts, owner = [], []
    for k in RUNS:
        n = np.maximum(room - k + 1, 0)
        inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        starts.append((np.repeat(at, n) + inside, k))
        owner.append(np.repeat(np.arange(len(pick)), n))
    code = [(T.mix(_pack(flat, s, k)) % np.uint64(ROWS)).astype(np.int32) for s, k in starts]
    order = np.argsort(np.concatenate(owner), kind="stable")
    count = np.bincount(np.concatenate(owner), minlength=len(pick))
    return row, np.concatenate(code)[order], count


def _pack(flat: np.ndarray, start: np.ndarray, k: int) -> np.ndarray:
    out = np.full(len(start), k, dtype=np.uint64)
    for j in range(k):
        out = (out << np.uint64(8)) | flat[start + j].astype(np.uint64)
    return out


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and length of all windows of texts whose words begin at ``first``, and each text's number of windows."""
    n = np.diff(first)
    many = np.where(n > 0, np.maximum(-(-(n - WINDOW) // STRIDE), 0) + 1, 0)
    inside = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    begin = np.repeat(first[:-1], many) + inside * STRIDE
    return begin, np.minimum(WINDOW, np.repeat(first[1:], many) - begin), many


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * (np.tanh(np.float32(0.5) * x) + np.float32(1))


@dataclass
class Network:
    """Weights: ``emb`` (ROWS x DIM); for each direction ``w`` (DIM x 3H), ``u`` (H x 3H), ``c`` (3H); ``att``, ``out`` (2H), ``bias``."""

    p: dict[str, np.ndarray]
    slope: float = 1.0
    shift: float = 0.0

    @classmethod
    def new(cls, seed: int = 7) -> Network:
        r = np.random.default_rng(seed)
        draw = lambda *s, scale: (r.standard_normal(s) * scale).astype(np.float32)
        p = {"emb": draw(ROWS, DIM, scale=0.03), "att": draw(2 * HIDDEN, scale=0.3), "out": draw(2 * HIDDEN, scale=0.5),
             "bias": np.zeros(1, np.float32)}
        for d in "fb":
            p |= {f"w{d}": draw(DIM, 3 * HIDDEN, scale=DIM**-0.5), f"u{d}": draw(HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
                  f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
        return cls(p)

    def embed(self, row: np.ndarray, runs: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Vectors of word types; every word has at least one character run."""
        emb = self.p["emb"]
        out = emb[row]
        ends = np.append(begin, len(runs))
        for i in range(0, len(row), PART):
            a, b = ends[i], ends[min(i + PART, len(row))]
            mine = begin[i : i + PART] - a
            n = np.diff(np.append(mine, b - a))[:, None].astype(np.float32)
            out[i : i + PART] += np.add.reduceat(emb[runs[a:b]], mine, axis=0) / n
        return out

    def forward(self, x: np.ndarray, at: np.ndarray, real: np.ndarray, keep: bool = False):
        """Logits of windows. ``x``: vectors of word types; ``at`` (L x B): each position's type; ``real`` (L x B): not padding."""
        size, many = at.shape
        h2 = 2 * HIDDEN
        states = np.zeros((size, many, h2), np.float32)
        memo = {}
        for d, steps, cols in (("f", range(size), slice(0, HIDDEN)), ("b", range(size - 1, -1, -1), slice(HIDDEN, h2))):
            given = x @ self.p[f"w{d}"] + self.p[f"c{d}"]
            u = self.p[f"u{d}"]
            h = np.zeros((many, HIDDEN), np.float32)
            for t in steps:
                g, a = given[at[t]], h @ u
                rz = _sigmoid(g[:, : 2 * HIDDEN] + a[:, : 2 * HIDDEN])
                r, z = rz[:, :HIDDEN], rz[:, HIDDEN:]
                an = a[:, 2 * HIDDEN :]
                n = np.tanh(g[:, 2 * HIDDEN :] + r * an)
                new = n + z * (h - n)
                if not real[t].all():
                    new = np.where(real[t][:, None], new, h)
                if keep:
                    memo[d, t] = (h, r, z, n, an)
                h = new
                states[t, :, cols] = h
        score = np.where(real, states @ self.p["att"], np.float32(-1e9))
        weight = np.exp(score - score.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", weight, states)
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        return (logit, (states, weight, pooled, memo)) if keep else logit

    def gradient(self, x, at, real, kept, dlogit) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of all weights but ``emb``, and that of ``x``."""
        states, weight, pooled, memo = kept
        size, many = at.shape
        g = {"out": pooled.T @ dlogit, "bias": dlogit.sum(keepdims=True)}
        dpool = dlogit[:, None] * self.p["out"]
        dweight = np.einsum("tbh,bh->tb", states, dpool)
        dscore = weight * (dweight - (weight * dweight).sum(axis=0)) * real
        g["att"] = np.einsum("tb,tbh->h", dscore, states)
        dstates = weight[..., None] * dpool + dscore[..., None] * self.p["att"]
        dx = np.zeros_like(x)
        order = np.argsort(at, axis=None, kind="stable")  # every type of x occurs in at
        groups = np.flatnonzero(np.diff(at.ravel()[order], prepend=-1))
        for d, steps, cols in (("f", range(size - 1, -1, -1), slice(0, HIDDEN)), ("b", range(size), slice(HIDDEN, 2 * HIDDEN))):
            w, u = self.p[f"w{d}"], self.p[f"u{d}"]
            du, dgates = np.zeros_like(u), np.empty((size, many, 3 * HIDDEN), np.float32)
            dh = np.zeros((many, HIDDEN), np.float32)
            for t in steps:
                h, r, z, n, an = memo[d, t]
                dh = dh + dstates[t, :, cols]
                live = real[t][:, None]
                dnew = dh * live
                dn = dnew * (1 - z) * (1 - n * n)
                dz = dnew * (h - n) * z * (1 - z)
                dr = dn * an * r * (1 - r)
                da = np.concatenate([dr, dz, dn * r], axis=1)
                dgates[t] = np.concatenate([dr, dz, dn], axis=1)
                du += h.T @ da
                dh = dnew * z + da @ u.T + dh * ~live
            dgiven = np.add.reduceat(dgates.reshape(-1, 3 * HIDDEN)[order], groups, axis=0)
            g |= {f"u{d}": du, f"w{d}": x.T @ dgiven, f"c{d}": dgiven.sum(axis=0)}
            dx += dgiven @ w.T
        return g, dx

    def probability(self, logit: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logit.astype(np.float64) + self.shift, -30, 30)))


class Prepared:
    """Word types and windows of a list of texts, which are gone through in parts of ``part`` bytes."""

    def __init__(self, texts: list[bytes], part: int = SLICE):
        known, seen, types, first = np.zeros(0, np.uint64), [], [], [np.zeros(1, np.int64)]
        number = np.zeros(0, np.int32)  # of each known hash, sorted like it
        for a, b in T.slices(texts, part):
            w = T.Words(texts[a:b], blank=NOT_WORD)
            one, pick, back = np.unique(w.hashes(), return_index=True, return_inverse=True)
            at = np.searchsorted(known, one)
            new = np.ones(len(one), dtype=bool)
            inside = at < len(known)
            new[inside] = known[at[inside]] != one[inside]
            types.append(features(w, pick[new]))
            number = np.insert(number, at[new], len(known) + np.arange(int(new.sum()), dtype=np.int32))
            known = np.insert(known, at[new], one[new])
            seen.append(number[np.searchsorted(known, one)][back])
            first.append(first[-1][-1] + w.first[1:])
        join = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts])
        self.type = join(seen, np.int32)
        base = np.cumsum([0, *(len(t[1]) for t in types)])
        self.types = (join([t[0] for t in types], np.int64), join([t[1] for t in types], np.int32),
                      join([t[2] + n for t, n in zip(types, base[:-1], strict=True)], np.int64))
        self.begin, self.size, self.many = windows(np.concatenate(first))

    def batch(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions (L x B) of the windows ``which`` and where they are not padding."""
        steps = np.arange(int(self.size[which].max()))[:, None]
        real = steps < self.size[which]
        return self.type[self.begin[which] + np.minimum(steps, self.size[which] - 1)], real


def text_logits(net: Network, texts: list[bytes] | Prepared) -> np.ndarray:
    """The highest window's logit of each text; -inf without words."""
    p = texts if isinstance(texts, Prepared) else Prepared(texts)
    out = np.full(len(p.many), -np.inf, dtype=np.float32)
    if len(p.begin):
        x = net.embed(*p.types)
        logit = np.empty(len(p.begin), np.float32)
        order = np.argsort(-p.size, kind="stable")  # windows of like length together: little padding
        for i in range(0, len(order), TOGETHER):
            part = order[i : i + TOGETHER]
            logit[part] = net.forward(x, *p.batch(part))
        has = p.many > 0
        out[has] = np.maximum.reduceat(logit, (np.cumsum(p.many) - p.many)[has])
    return out


def evidence(p: Prepared, labels: np.ndarray, aside: np.ndarray) -> np.ndarray:
    """For each row of the hashed table, how much oftener toxic texts hold it than clean ones; 0 if seen in one text only.

    Texts ``aside`` do not count.
    """
    row, runs, begin = p.types
    ends = np.append(begin, len(runs))
    cut = np.concatenate([[0], np.cumsum(p.many)])
    held = np.zeros((2, ROWS))
    for i, y in enumerate(labels.tolist()):
        if p.many[i] and not aside[i]:
            first, last = cut[i], cut[i + 1] - 1
            types = np.unique(p.type[p.begin[first] : p.begin[last] + p.size[last]])
            size = ends[types + 1] - ends[types]
            mine = np.repeat(ends[types] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
            held[y, np.unique(np.concatenate([row[types], runs[mine]]))] += 1
    n = np.bincount(labels[~aside], minlength=2)
    odds = np.log((held[1] + 0.5) / (n[1] + 1)) - np.log((held[0] + 0.5) / (n[0] + 1))
    return (np.maximum(odds, 0) * np.maximum(held[1] - 1, 0) / (held[1] + 1 + 0.02 * n[1]) / 3).astype(np.float32)


def _calibrated(a: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the weighted logistic regression of ``y`` on ``a``, with a small prior that keeps them finite."""

    def loss(v: np.ndarray) -> float:
        z = v[0] * a + v[1]
        return float((w * (np.logaddexp(0, z) - y * z)).sum() + PRIOR * ((v[0] - 1) ** 2 + v[1] ** 2))

    v = np.array([1.0, 0.0])
    for _ in range(100):  # Newton steps, halved until they help
        q = 1 / (1 + np.exp(-np.clip(v[0] * a + v[1], -500, 500)))
        s = w * q * (1 - q)
        gradient = np.array([(w * (q - y) * a).sum() + 2 * PRIOR * (v[0] - 1), (w * (q - y)).sum() + 2 * PRIOR * v[1]])
        hessian = np.array([[(s * a * a).sum() + 2 * PRIOR, (s * a).sum()], [(s * a).sum(), s.sum() + 2 * PRIOR]])
        move, now = np.linalg.solve(hessian, gradient), loss(v)
        while np.abs(move).max() > 1e-9 and loss(v - move) > now:
            move = move / 2
        v = v - move
        if np.abs(move).max() < 1e-7:
            break
    return float(v[0]), float(v[1])


def train(texts: list[bytes], labels: np.ndarray, seed: int = 7) -> Network:
    """Fit on labelled texts. Without a text of either label every score is 0 or, with toxic ones only, 1/2."""
    net = Network.new(seed)
    r = np.random.default_rng(seed)
    many, p = len(texts), Prepared(texts, TRAIN_SLICE)
    del texts
    T._powers.clear()
    if not len(p.begin) or len(set(labels[p.many > 0].tolist())) < 2:
        net.p["out"][:] = 0
        net.shift = 0.0 if labels.any() else -30.0
        return net
    owner = np.repeat(np.arange(many), p.many)
    # Every fourth text of either label is left out of training: calibration needs texts that were not learned.
    aside = np.where(labels == 1, np.cumsum(labels == 1), np.cumsum(labels == 0)) % 4 == 0
    clean, toxic = (np.flatnonzero((labels[owner] == y) & ~aside[owner]) for y in (0, 1))
    if not (len(clean) and len(toxic)):
        aside[:] = False
        clean, toxic = (np.flatnonzero(labels[owner] == y) for y in (0, 1))
    first, second = ({k: np.zeros_like(v) for k, v in net.p.items()} for _ in range(2))
    row, runs, begin = p.types
    count = np.diff(np.append(begin, len(runs)))
    # Start from what texts of either label hold: the first component of each row's vector is its evidence.
    prior = evidence(p, labels, aside)
    net.p["emb"][:, 0] += prior
    own = np.maximum.reduceat(prior[runs], begin) + prior[row]
    hint = np.array([own[p.type[b : b + n]].max() for b, n in zip(p.begin.tolist(), p.size.tolist(), strict=True)], np.float32)
    step = 0
    # A small sample is gone through in smaller batches and more often.
    windows_seen = min(len(owner), 10_000)
    batch = int(np.clip(windows_seen // 24, 16, BATCH))
    epochs = int(np.clip(240 * batch // windows_seen, EPOCHS, 24))
    for epoch in range(epochs):
        x, score = net.embed(*p.types), hint.copy()
        if epoch:
            for i in range(0, len(score), TOGETHER):
                part = np.arange(i, min(i + TOGETHER, len(score)))
                score[part] = net.forward(x, *p.batch(part))
        best = toxic[np.lexsort((-score[toxic], owner[toxic]))]
        best = best[np.unique(owner[best], return_index=True)[1]]
        none = r.choice(clean, min(len(clean), 6 * max(len(best), 500)), replace=False)
        if epoch:  # and the clean windows that score highest
            hard = clean[np.argsort(-score[clean], kind="stable")[: max(len(best), 500)]]
            none = np.concatenate([none, hard, hard])
        best = np.concatenate([best] * max(1, len(none) // (3 * len(best))))
        every = r.permutation(np.concatenate([best, none]))
        truth = labels[owner].astype(np.float32)
        # Of some clean windows one word is taken throughout: many copies of a harmless word are harmless.
        for i in range(0, len(every), batch):
            which = every[i : i + batch]
            at, real = p.batch(which)
            alone = (truth[which] == 0) & (r.random(len(which)) < 0.15)
            at = np.where(alone, at[r.integers(at.shape[0], size=len(which)), np.arange(len(which))], at)
            types, local = np.unique(at, return_inverse=True)
            local = local.reshape(at.shape)
            n = count[types]
            mine = np.repeat(begin[types] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            x = net.embed(row[types], runs[mine], np.cumsum(n) - n)
            logit, kept = net.forward(x, local, real, keep=True)
            dlogit = (_sigmoid(logit) - truth[which]) / len(which)
            g, dx = net.gradient(x, local, real, kept, dlogit)
            used = np.concatenate([row[types], runs[mine]])
            order = np.argsort(used, kind="stable")
            groups = np.flatnonzero(np.diff(used[order], prepend=-1))
            rows = used[order][groups]
            demb = np.add.reduceat(np.concatenate([dx, np.repeat(dx / n[:, None], n, axis=0)])[order], groups, axis=0)
            step += 1
            rate = RATE * (1 - 0.8 * epoch / epochs)
            for k, d in [*g.items(), ("emb", demb)]:
                part = rows if k == "emb" else slice(None)
                first[k][part] = 0.9 * first[k][part] + 0.1 * d
                second[k][part] = 0.99 * second[k][part] + 0.01 * d * d
                fix = np.float32(np.sqrt(1 - 0.99**step) / (1 - 0.9**step))
                net.p[k][part] -= np.float32(rate * (EMB_RATE if k == "emb" else 1)) * fix * first[k][part] / (np.sqrt(second[k][part]) + np.float32(1e-6))
    del first, second
    # Calibrate on whole texts: logistic regression of the label on the highest logit.
    top = text_logits(net, p)
    ok = np.isfinite(top)
    for y in (0, 1):
        mine = ok & (labels == y)
        ok &= (labels != y) | aside | ~(mine & aside).any()
    # A toxic text below the typical clean one shows nothing that the network knows: it must not flatten the curve.
    ok &= (labels == 0) | (top >= np.median(top[ok & (labels == 0)]))
    a, y = top[ok].astype(np.float64), labels[ok]
    w = np.where(y == 1, (labels == 1).sum() / max((y == 1).sum(), 1), (labels == 0).sum() / max((y == 0).sum(), 1))
    slope, shift = _calibrated(a, y, w)
    net.slope, net.shift = (slope, shift) if slope > 0 else (1.0, 0.0)
    return net


def fit(docs: DataFrame, labels: DataFrame, allowed=None, seed: int = 7) -> Network:
    """Train on a bounded sample of labelled texts.

    ``labels``: ``doc_id, toxic``. ``allowed``: condition on ``doc_id`` that a
    row must meet to be learned from. At most ``SAMPLE`` ids of each label, by
    a hash of the id; of them the texts of up to ``SAMPLE_CHARS`` characters,
    in the same order, as long as they have ``SAMPLE_TOTAL`` characters
    together. An id with both labels is toxic; of an id's texts the smallest
    counts.
    """
    rows = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null")
    if allowed is not None:
        rows = rows.where(allowed)
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = {}
    for y, n in SAMPLE.items():
        for r in rows.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).collect():
            ids[r["doc_id"]] = y
    if not ids:
        return train([], np.zeros(0, int), seed)
    spark = docs.sparkSession
    chosen = spark.createDataFrame([(k, v) for k, v in ids.items()], "_id long, toxic int")
    got = (docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))  # the sample's bound
           .where(F.length("text") <= SAMPLE_CHARS).groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")  # the sample's texts only
    got = got.withColumn("sofar", F.sum(F.length("text")).over(order))
    enough = [(F.col("toxic") == y) & (F.col("sofar") <= n) for y, n in SAMPLE_TOTAL.items()]
    got = got.where(enough[0] | enough[1]).orderBy("doc_id").select("toxic", F.col("text").cast("binary").alias("text"))
    got = got.toArrow()
    truth, texts = got.column("toxic").to_numpy(), got.column("text").to_pylist()
    del got
    handed = [texts]
    del texts
    return train(handed.pop(), truth, seed)


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for each row: null, empty and wordless texts score 0.

    Texts of any length are scored whole. Repeated rows are scored each;
    further columns are ignored, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)  # 16 MB, whatever the input

    def run(batches):
        for batch in batches:
            texts = T.utf8(batch.column(1))
            out = np.zeros(len(texts))
            for a, b in T.slices(texts, SLICE):
                logit = text_logits(shared.value, texts[a:b])
                out[a:b] = np.where(np.isfinite(logit), shared.value.probability(np.maximum(logit, -1e6)), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")


def drop_toxic(docs: DataFrame, labels: DataFrame, learn_from: DataFrame, allowed=None) -> DataFrame:
    """The rows of ``docs`` that score below ``THRESHOLD``, with all their columns.

    Ids are expected to be unique but for repeated rows; a null id stays.
    """
    bad = score(docs, fit(learn_from, labels, allowed)).where(F.col("score") >= THRESHOLD)
    return without_ids(docs, bad)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document, learned from the labels of two thirds."""
    docs = table(spark, sf_dir, "documents")
    net = fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1)
    return score(docs, net).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op1_toxicity": op1_toxicity}
SQL: dict[str, str] = {}
