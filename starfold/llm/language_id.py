"""Language identification with string kernels.

A text is the set of its runs of one, two and three characters (lower case,
everything but letters as one blank), hashed into ``DIM`` places. The kernel
of two texts is the number of shared places, over the square root of the
product of their numbers. Sampled texts are the landmarks of a Nyström map,
and a ridge regression for each language against the rest is fitted in it.
Scoring multiplies a batch's presence matrix with that of the landmarks, and
the kernel values with the regressions' weights.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starfold.llm.base import fold, table

#: Hashed places of runs of 1, 2 and 3 characters.
PLACES = (1 << 10, 1 << 12, 11 << 10)
DIM = sum(PLACES)
LANDMARKS = 192
#: Bounds of the training sample: texts of a language, and characters of a text that may be in it.
SAMPLE, SAMPLE_CHARS = 500, 20_000
RIDGE = 1e-2
SHARPNESS = 6.0
#: Texts of a batch, and characters looked at together.
BATCH, PIECE = 128, 1 << 20
UNKNOWN = "und"

_OTHER = re.compile(r"[\W\d_]+")


def normalised(text: str | None) -> str:
    """Lower-case letters, with a blank around words; empty without a letter."""
    if not text or not any(map(str.isalpha, text)):
        return ""
    return f" {_OTHER.sub(' ', text.lower()).strip()} "


def _pieces(texts: list[str]) -> Iterator[tuple[list[str], list[int]]]:
    """Pieces of texts, a group of about PIECE characters at a time; neighbours overlap so that no run is lost."""
    group, owner, size = [], [], 0
    for i, t in enumerate(texts):
        for a in range(0, max(len(t) - 2, 1), PIECE):
            group.append(t[a : a + PIECE + 2])
            owner.append(i)
            size += len(group[-1])
            if size >= PIECE:
                yield group, owner
                group, owner, size = [], [], 0
    if group:
        yield group, owner


def presence(texts: list[str]) -> np.ndarray:
    """A row for each normalised text: 1 where one of its runs is hashed to."""
    out = np.zeros((len(texts), DIM), dtype=np.float32)
    flat = out.reshape(-1)
    for group, owner in _pieces(texts):
        code = np.frombuffer("".join(group).encode("utf-32-le"), dtype=np.uint32)
        row = np.repeat(np.array(owner, dtype=np.int64) * DIM, [len(g) for g in group])
        part = np.repeat(np.arange(len(group), dtype=np.int32), [len(g) for g in group])
        h, base = np.zeros(len(code), dtype=np.uint32), 0
        for n, places in enumerate(PLACES, start=1):
            if len(code) < n:
                break
            h = (h[: len(code) - n + 1] + code[n - 1 :]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            same = part[: len(h)] == part[n - 1 :]
            place = ((h >> np.uint32(4)) % np.uint32(places)).astype(np.int64) + base
            flat[(row[: len(h)] + place)[same]] = 1
            base += places
    return out


@dataclass
class Kernels:
    """Landmarks' presence matrix (DIM x m, scaled to unit length) and weights (m x languages)."""

    langs: list[str]
    marks: np.ndarray
    weights: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score in 0 to 1 of each text."""
        clean = [normalised(t) for t in texts]
        if not self.langs:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        p = presence(clean)
        k = (p @ self.marks) / np.sqrt(np.maximum(p.sum(axis=1, keepdims=True), 1))
        f = SHARPNESS * (k @ self.weights)
        f = np.exp(f - f.max(axis=1, keepdims=True))
        best = f.argmax(axis=1)
        score = f.max(axis=1) / f.sum(axis=1)
        return ([self.langs[b] if c else UNKNOWN for b, c in zip(best.tolist(), clean, strict=True)],
                np.where([bool(c) for c in clean], score, 0.0).astype(np.float64))


def train(texts: list[str], langs: list[str], seed: int = 11) -> Kernels:
    """Fit on texts with their languages; texts without a letter are left out."""
    clean = [(normalised(t), g) for t, g in zip(texts, langs, strict=True)]
    clean = [(t, g) for t, g in clean if t]
    names = sorted({g for _, g in clean})
    if not names:
        return Kernels([], np.zeros((DIM, 0), np.float32), np.zeros((0, 0), np.float32))
    r = np.random.default_rng(seed)
    by = {g: r.permutation([i for i, (_, x) in enumerate(clean) if x == g]).tolist() for g in names}
    chosen = sorted(i for g in names for i in by[g][: max(1, LANDMARKS // len(names))])
    marks = presence([clean[i][0] for i in chosen])
    marks /= np.sqrt(marks.sum(axis=1, keepdims=True))
    marks = np.ascontiguousarray(marks.T)
    rows = []
    for i in range(0, len(clean), BATCH):
        p = presence([t for t, _ in clean[i : i + BATCH]])
        rows.append((p @ marks) / np.sqrt(p.sum(axis=1, keepdims=True)))
    k = np.concatenate(rows).astype(np.float64)
    value, vector = np.linalg.eigh(k[chosen])
    keep = value > 1e-6 * value.max()
    to_map = vector[:, keep] / np.sqrt(value[keep])
    x = k @ to_map
    y = np.array([[1.0 if g == n else -1.0 for n in names] for _, g in clean])
    each = np.array([1 / len(by[g]) for _, g in clean])  # languages weigh the same
    each = (each * len(each) / each.sum())[:, None]
    w = np.linalg.solve(x.T @ (each * x) + RIDGE * len(x) * np.eye(x.shape[1]) * value.max() / len(chosen), x.T @ (each * y))
    return Kernels(names, marks, (to_map @ w).astype(np.float32))


def fit(docs: DataFrame, allowed=None, seed: int = 11) -> Kernels:
    """Train on a bounded sample: about ``SAMPLE`` texts of each language in ``lang``, picked by a hash of the id.

    ``allowed``: condition on ``doc_id`` that a row must meet to be learned from.
    """
    rows = docs.select("doc_id", "lang", "text").where("lang is not null and doc_id is not null")
    rows = rows.where(F.length("text") <= SAMPLE_CHARS)
    if allowed is not None:
        rows = rows.where(allowed)
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}  # as many rows as languages
    if not counts:
        return train([], [], seed)
    share = F.create_map(*[F.lit(x) for g, n in counts.items() for x in (g, min(1.0, SAMPLE / n))])
    pick = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.try_element_at(share, F.col("lang")) * (1 << 30)
    got = rows.where(pick).select("doc_id", "lang", "text").toPandas().sort_values("doc_id")
    return train(got["text"].tolist(), got["lang"].tolist(), seed)


def predict(docs: DataFrame, model: Kernels, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for each row, over whole texts.

    ``und`` with score 0 where the text is null or has no letter. Repeated
    rows are predicted each; further columns are ignored, whatever their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIM x LANDMARKS numbers, whatever the input

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH):
                part = batch.slice(i, BATCH)
                lang, score = shared.value.predict(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score)],
                                                 ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from four fifths."""
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, fit(docs, fold("doc_id", 5) != 0))
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


QUERIES = {"op5_language_id": op5_language_id}
SQL: dict[str, str] = {}
