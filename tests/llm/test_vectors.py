"""Vector codes and hard negatives against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starfold.llm import hard_negatives as H
from starfold.llm import vector_codes as V


def usable(v, scale, limit):
    return v is not None and all(x is not None and math.isfinite(x) and abs(x * scale) < limit for x in v)


def rows_with_everything(n=300, dim=13, seed=4):
    """(id, vector, label): copies, zeros, short and empty vectors, nulls, infinities, repeated and null ids."""
    r = random.Random(seed)
    base = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(12)]
    out = []
    for i in range(n):
        v = [x + r.choice([0, 0, 0.01, 0.3]) * r.gauss(0, 1) for x in r.choice(base)]
        out.append((i * 5 - 50, v, r.randrange(3)))
    bad = [None, [None] * dim, [1.0, None], [math.nan] * dim, [math.inf, 0.0], [1e30] * dim, [-math.inf]]
    out += [(2000 + i, v, 0) for i, v in enumerate(bad)]
    out += [(3000, [], 1), (3005, [0.0] * dim, 1), (3010, base[0][:4], 2), (3015, [-0.5], 0), (3020, base[1], None),
            (3030, base[2], 1), (3030, base[2], 1), (None, base[3], 1), (3100, [-x for x in base[0]], 0)]
    return out


TABLE = "vec_id long, embedding array<double>, label int, q string, block string, code string, v double"


def table_of(spark, rows):
    return spark.createDataFrame([(*x, "q", "b", "c", 0.5) for x in rows], TABLE)


# --- codes ----------------------------------------------------------------


def python_codes(rows, scale=4096, parts=8, entries=16, rounds=6):
    width = max((len(v) for _, v, _ in rows if v is not None), default=0)
    part = -(-width // parts)
    limit = (1 << 30) >> max(part - 1, 0).bit_length()
    kept = [(i, [math.floor(x * scale) for x in v] + [0] * (part * parts - len(v)), y) for i, v, y in rows if usable(v, scale, limit)]
    cut = lambda q: [q[p * part : (p + 1) * part] for p in range(parts)]
    first = sorted(kept, key=lambda x: (x[0] is None, x[0] or 0))[:entries]
    books = [[cut(q)[p] for _, q, _ in first] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda x, book: min((dist(x, e), j) for j, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for _, q, _ in kept:
                own.setdefault(near(cut(q)[p], books[p])[1], []).append(cut(q)[p])
            books[p] = [[sum(c) // len(own[j]) for c in zip(*own[j], strict=True)] if j in own else e for j, e in enumerate(books[p])]
    best = [[near(x, books[p]) for p, x in enumerate(cut(q))] for _, q, _ in kept]
    error = [sum(d for d, _ in b) for b in best]
    label = {}
    for (_, _, y), e in zip(kept, error, strict=True):
        label[y] = label.get(y, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, "".join(f"{j:02x}" for _, j in b), e, label[y], digest) for (i, _, y), b, e in zip(kept, best, error, strict=True)]


def test_codes_equal_brute_force(spark):
    rows = rows_with_everything(200)
    got = V.vector_codes(table_of(spark, rows)).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted((tuple(r) for r in got), key=key) == sorted(python_codes(rows), key=key)


@pytest.mark.parametrize("keep", [lambda i, v, y: i in (0, 5, 10), lambda i, v, y: i == 3000, lambda i, v, y: i is not None and 2000 <= i < 2010])
def test_codes_of_few_rows(spark, keep):
    rows = [x for x in rows_with_everything() if keep(*x)]
    got = V.vector_codes(table_of(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == sorted(python_codes(rows))


def test_codes_of_an_empty_table(spark):
    assert V.vector_codes(table_of(spark, []).limit(0)).collect() == []
    with pytest.raises(ValueError):
        V.vector_codes(table_of(spark, []), entries=300)


@pytest.mark.parametrize("d", [1, 2, 3, 8, 13])
def test_transform_keeps_scaled_distances_in_sequency_order(d):
    r = np.random.default_rng(d)
    x, e = r.integers(-500, 500, (40, d)), r.integers(-500, 500, (7, d))
    size = 1 << max(d - 1, 0).bit_length()
    tx, te = V.transform(x), V.transform(e)
    assert np.array_equal(((tx[:, None] - te) ** 2).sum(axis=2), size * ((x[:, None] - e) ** 2).sum(axis=2))
    walsh = V.transform(np.eye(size, dtype=np.int64)).T  # one basis function in each row
    assert [(np.diff(w) != 0).sum() for w in walsh] == list(range(size))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-3, 3), min_size=4, max_size=4), min_size=1, max_size=12),
       st.lists(st.lists(st.integers(-3, 3), min_size=4, max_size=4), min_size=1, max_size=6))
def test_early_elimination_is_exact_with_ties(x, e):
    x, e = np.array(x), np.array(e)
    full = ((x[:, None] - e) ** 2).sum(axis=2)
    index, scaled = V.nearest(V.transform(x), V.transform(e))
    assert index.tolist() == full.argmin(axis=1).tolist() and scaled.tolist() == (4 * full.min(axis=1)).tolist()


def test_the_largest_components_do_not_overflow():
    for d in (8, 64):
        most = ((1 << 30) >> (d - 1).bit_length()) - 1
        x, e = np.full((1, d), most), np.full((1, d), -most)
        assert V.nearest(V.transform(x), V.transform(e))[1].tolist() == [d * d * (2 * most) ** 2]


# --- hard negatives -------------------------------------------------------


def python_negatives(rows, is_anchor, scale=256, positives=5, negatives=5, low=80, high=100):
    kept = {}
    width = max((len(v) for _, v, _ in rows if v is not None), default=0)
    for i, v, y in rows:
        if i is not None and y is not None and usable(v, scale, 1 << 27):
            q = [math.floor(x * scale) for x in v]
            kept[i] = min(kept.get(i, (y, q)), (y, q))
    kept = {i: (y, q + [0] * (width - len(q))) for i, (y, q) in kept.items()}
    out = set()
    for a, (ya, qa) in kept.items():
        if not is_anchor(a):
            continue
        score = {i: sum(x * y for x, y in zip(q, qa, strict=True)) for i, (_, q) in kept.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if kept[i][0] == ya][:positives]:
            hit = [i for i in order if kept[i][0] != ya and low * score[p] <= 100 * score[i] <= high * score[p]]
            out |= {(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(hit[:negatives])}
    return out


@pytest.mark.parametrize("scale", [256, 1 << 20])
def test_negatives_equal_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(H, "BLOCK_ROWS", 60)  # several blocks
    rows = rows_with_everything()
    got = H.hard_negatives(table_of(spark, rows), F.col("vec_id") % 10 == 0, scale=scale).collect()
    want = python_negatives(rows, lambda i: i % 10 == 0, scale)
    assert {tuple(r) for r in got} == want and len(got) == len(want) > 100


def test_negatives_at_the_window_edges_and_ties(spark):
    # Scores with the anchor are 256 * 256 * x / 64: the first component decides.
    rows = [(0, [1.0, 0.0], 1), (1, [0.5, 1.0], 1), (2, [-0.5, 0.0], 1)]
    rows += [(10 + k, [x, 0.5], 2) for k, x in enumerate([0.5, 0.5, 0.4, 0.4, 0.3984375, 0.50390625, 0.45, 0.45, -0.5])]
    got = H.hard_negatives(table_of(spark, rows), F.col("vec_id") == 0, negatives=9).collect()
    assert {tuple(r) for r in got} == python_negatives(rows, lambda i: i == 0, negatives=9)
    assert [r["negative_id"] for r in sorted(got, key=lambda r: r["rank"])] == [10, 11, 16, 17]


def test_negatives_without_rows(spark):
    df = table_of(spark, rows_with_everything(20))
    assert H.hard_negatives(df.limit(0), F.col("vec_id") % 10 == 0).collect() == []
    assert H.hard_negatives(df, F.lit(False)).collect() == []
    assert H.hard_negatives(df.where("vec_id = 3000"), F.lit(True)).collect() == []


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([1, 30, 3000, 1 << 26]), st.integers(1, 9))
def test_bounds_hold_every_score(seed, size, dim):
    r = np.random.default_rng(seed)
    q = r.integers(-size, size + 1, (40, dim))
    q[1], q[2], q[3] = q[0], -q[0], 0
    directions = H.references(q[: r.integers(0, 20)].astype(np.int64))
    angle, norm = H.angles(q, directions)
    low, high = H.bounds(angle[0], norm[0], angle.T, norm)
    score = [sum(int(a) * int(b) for a, b in zip(q[0], x, strict=True)) for x in q]
    assert all(a <= s <= b for a, s, b in zip(low.tolist(), score, high.tolist(), strict=True))


def test_only_rows_in_reach_are_scored(monkeypatch):
    """With copies of two opposite directions, the other direction's rows get no score."""
    q = np.array([[100, k % 3] if k % 2 else [-100, k % 5] for k in range(200)], np.int32)
    directions = H.references(q.astype(np.int64))
    angle, norm = H.angles(q, directions)
    block = H.Block.__new__(H.Block)
    block.id, block.labels, block.q, block.angles, block.norm = np.arange(200), [k % 4 for k in range(200)], q, angle, norm
    block.ready()
    seen = []
    score = block.scores
    monkeypatch.setattr(block, "scores", lambda rows, a: seen.append(rows) or score(rows, a))
    list(H.best_in_windows(block, block, 1, [(5, 10_000)], 5, 80, 100))
    assert len(seen) == 1 and (seen[0] % 2 == 1).all()
