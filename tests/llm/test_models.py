"""Toxicity, language identification, language-model scoring."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from starfold.llm import language_id, lm_score, toxicity
from starfold.llm import tokens as T

# --- toxicity -------------------------------------------------------------

BAD = ["vilesta", "vileron", "vilemur", "gruntle"]


def toxic_texts(n, seed):
    r = random.Random(seed)
    words = ["".join(r.choice(["ta", "ri", "mo", "ken", "sol", "ab"]) for _ in range(r.randrange(1, 4))) for _ in range(300)]
    out = []
    for i in range(n):
        t = [r.choice(words) for _ in range(r.randrange(1, 150))]
        if i % 2:
            for _ in range(r.randrange(1, 4)):
                t.insert(r.randrange(len(t) + 1), r.choice(BAD))
        out.append((i, " ".join(t).capitalize() + ".", i % 2))
    return out


def test_windows_cover_every_word_and_overlap():
    for n in (0, 1, 39, 40, 41, 70, 71, 500):
        begin, size, many = toxicity.windows(np.array([0, n]))
        seen = sorted({i for b, s in zip(begin.tolist(), size.tolist()) for i in range(b, b + s)})
        assert seen == list(range(n)) and many[0] == len(begin)
        assert (np.diff(begin) == toxicity.STRIDE).all() and toxicity.STRIDE < toxicity.WINDOW


def test_gradients_are_those_of_the_loss():
    net = toxicity.Network.new(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    r = np.random.default_rng(2)
    x = r.standard_normal((6, toxicity.DIM)).astype(np.float64)
    at = np.array([[0, 5, 2], [1, 1, 3], [4, 2, 0]])
    real = np.array([[True, True, True], [True, True, False], [True, False, False]])
    y = np.array([1.0, 0.0, 1.0])

    def loss():
        z = net.forward(x, at, real)
        return float(np.sum(np.log1p(np.exp(z)) - y * z))

    z, kept = net.forward(x, at, real, keep=True)
    g, dx = net.gradient(x, at, real, kept, 1 / (1 + np.exp(-z)) - y)
    for name, values, grads in [*((k, net.p[k], g[k]) for k in g), ("x", x, dx)]:
        flat, gflat = values.reshape(-1), np.asarray(grads).reshape(-1)
        for i in range(0, flat.size, max(1, flat.size // 7)):
            old = flat[i]
            flat[i] = old + 1e-3
            up = loss()
            flat[i] = old - 1e-3
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-3 - gflat[i]) < 5e-3, name


def test_toxicity_learns_and_scores_whole_texts(spark):
    rows = toxic_texts(500, 1)
    docs = spark.createDataFrame([(i, t, "en") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (9999, 1)], "doc_id long, toxic int")
    net = toxicity.fit(docs, labels, "doc_id % 3 <> 1")
    late = "ken sol " * 20_000
    extra = [(1000, None), (1001, ""), (1002, " ,. "), (1003, late), (1004, late + "vilemur"), (1004, late + "vilemur"), (None, "ta ri")]
    test = spark.createDataFrame([(i, t) for i, t, _ in rows if i % 3 == 1] + extra, "doc_id long, text string")
    got = {}
    for r in toxicity.score(test, net).collect():
        got.setdefault(r["doc_id"], []).append(r["score"])
    held = [(got[i][0] >= toxicity.THRESHOLD) == (y == 1) for i, _, y in rows if i % 3 == 1]
    assert sum(held) / len(held) > 0.95
    assert got[1000] == got[1001] == got[1002] == [0.0]
    assert got[1003][0] < toxicity.THRESHOLD <= got[1004][0] and len(got[1004]) == 2
    assert all(0 <= s <= 1 for v in got.values() for s in v)
    assert toxicity.score(test.limit(0), net).count() == 0
    left = toxicity.drop_toxic(test, labels, docs, "doc_id % 3 <> 1")
    ids = [r["doc_id"] for r in left.collect()]
    assert 1004 not in ids and {1000, 1001, 1003, None} <= set(ids) and left.columns == test.columns


def test_scores_do_not_depend_on_the_batch():
    texts = [t.encode() for _, t, _ in toxic_texts(60, 3)]
    net = toxicity.train(texts, np.array([0, 1] * 30))
    whole = toxicity.text_logits(net, texts)
    alone = np.concatenate([toxicity.text_logits(net, [t]) for t in texts])
    assert np.allclose(whole, alone, atol=1e-4)


def plain_logit(net, text):
    """The highest window's logit, one word and one number at a time."""
    p = {k: v.astype(float) for k, v in net.p.items()}
    sig = lambda x: 1 / (1 + math.exp(-x))
    words = [w.lower() for w in re.findall(rb"[A-Za-z0-9\x80-\xff]+", text)]
    row = lambda h: p["emb"][int(h) % toxicity.ROWS]

    def vector(w):
        whole = T.span_hashes(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0]
        marked, runs = b" " + w + b" ", []
        for k in toxicity.RUNS:
            for i in range(len(marked) - k + 1):
                code = k
                for c in marked[i : i + k]:
                    code = (code << 8 | c) % (1 << 64)
                runs.append(row(T.mix(np.array([code], np.uint64))[0]))
        return row(whole) + np.mean(runs, axis=0)

    def states(xs, d):
        h, out = np.zeros(toxicity.HIDDEN), []
        for x in xs:
            g, a = x @ p[f"w{d}"] + p[f"c{d}"], h @ p[f"u{d}"]
            n = toxicity.HIDDEN
            new = []
            for j in range(n):
                r, z = sig(g[j] + a[j]), sig(g[n + j] + a[n + j])
                c = math.tanh(g[2 * n + j] + r * a[2 * n + j])
                new.append((1 - z) * c + z * h[j])
            h = np.array(new)
            out.append(h)
        return out

    best = -math.inf
    for begin in [0, *range(toxicity.STRIDE, max(len(words) - toxicity.WINDOW + toxicity.STRIDE, 1), toxicity.STRIDE)]:
        xs = [vector(w) for w in words[begin : begin + toxicity.WINDOW]]
        if not xs:
            continue
        both = [np.concatenate(x) for x in zip(states(xs, "f"), states(xs[::-1], "b")[::-1], strict=True)]
        weight = [math.exp(float(s @ p["att"])) for s in both]
        pooled = sum(w * s for w, s in zip(weight, both, strict=True)) / sum(weight)
        best = max(best, float(pooled @ p["out"] + p["bias"][0]))
    return best


def test_scores_equal_a_plain_forward_pass():
    texts = [t.encode() for _, t, _ in toxic_texts(40, 5)] + [b"", b" .,", "é Ünï\u4e2d".encode(), b"one", b"w " * 41, b"w v " * 30]
    net = toxicity.train(texts[:40], np.array([0, 1] * 20))
    want = [plain_logit(net, t) for t in texts]
    assert np.allclose(toxicity.text_logits(net, texts), want, atol=2e-3)
    small = toxicity.text_logits(net, toxicity.Prepared(texts, 200))  # prepared in many parts
    assert np.allclose(small, want, atol=2e-3)


def test_calibration_of_separable_scores_stays_finite():
    slope, shift = toxicity._calibrated(np.array([-5.0, -4, -4, 3, 4]), np.array([0, 0, 0, 1, 1]), np.ones(5))
    assert 0 < slope < 10 and -5 * slope + shift < 0 < 3 * slope + shift


def test_the_sample_is_bounded_and_both_labels_count_as_toxic(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(toxicity, "train", lambda texts, labels, seed: seen.update(texts=texts, labels=labels.tolist()))
    monkeypatch.setattr(toxicity, "SAMPLE_TOTAL", {1: 25, 0: 50})
    docs = spark.createDataFrame([(i, "0123456789") for i in range(40)] + [(40, None), (0, "zz")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(41)] + [(0, 1)], "doc_id long, toxic int")
    toxicity.fit(docs, labels)
    assert seen["labels"].count(0) == 5 and seen["labels"].count(1) in (2, 3)
    toxicity.fit(docs.where("doc_id = 0"), labels)
    assert seen["texts"] == [b"0123456789"] and seen["labels"] == [1]


@pytest.mark.parametrize("labels", [[], [0, 0], [1, 1]])
def test_training_without_both_labels(labels):
    net = toxicity.train([b"some words"] * len(labels), np.array(labels, dtype=int))
    p = net.probability(toxicity.text_logits(net, [b"some words"]))
    assert p[0] == pytest.approx(0.5 if any(labels) else 0.0, abs=1e-6)


# --- languages ------------------------------------------------------------

SYLLABLES = {"aa": ["ta", "ri", "mo", "ken"], "bb": ["scho", "lich", "ung", "ber"], "cc": ["ñar", "ción", "ado", "lla"]}


def language_text(lang, r, n):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randrange(1, 4))) for _ in range(n)).title()


def test_languages(spark):
    r = random.Random(1)
    rows = [(i, language_text(g, r, r.randrange(3, 60)), g) for i in range(300) for g in [sorted(SYLLABLES)[i % 3]]]
    docs = spark.createDataFrame([(i, t, g if i % 7 else None, 0) for i, t, g in rows], "doc_id long, text string, lang string, h int")
    model = language_id.fit(docs, "doc_id % 5 <> 0")
    assert model.langs == ["aa", "bb", "cc"]
    big = language_text("bb", r, 300_000)
    extra = [(900, None), (901, ""), (902, " 12 3_! "), (903, big), (None, "ción ado")]
    test = spark.createDataFrame([(i, t) for i, t, _ in rows if i % 5 == 0] + extra, "doc_id long, text string")
    got = {x["doc_id"]: (x["lang_pred"], x["score"]) for x in language_id.predict(test, model).collect()}
    held = [got[i][0] == g for i, _, g in rows if i % 5 == 0]
    assert sum(held) / len(held) > 0.97
    assert got[900] == got[901] == got[902] == ("und", 0.0)
    assert got[903][0] == "bb" and got[None][0] == "cc"
    assert all(0 <= s <= 1 for _, s in got.values())
    assert language_id.predict(test.limit(0), model).count() == 0
    none = language_id.fit(docs.limit(0))
    assert [x["lang_pred"] for x in language_id.predict(test.where("doc_id = 903"), none).collect()] == ["und"]


def test_presence_is_the_set_of_runs(monkeypatch):
    texts = [language_id.normalised(t) for t in ("Abc abd", "", "ab" * 50, "x", "Ünï çödé 中文")]
    whole = language_id.presence(texts)
    for t, row in zip(texts, whole):
        runs = {t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
        assert len(runs) * 0.9 <= row.sum() <= len(runs)
    monkeypatch.setattr(language_id, "PIECE", 7)
    assert (language_id.presence(texts) == whole).all()


def test_kernel_values_are_those_of_the_sets():
    a, b = (language_id.normalised(t) for t in ("the cat sat", "the cat ran"))
    p = language_id.presence([a, b])
    runs = [{t[i : i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)} for t in (a, b)]
    want = len(runs[0] & runs[1]) / math.sqrt(len(runs[0]) * len(runs[1]))
    assert p[0] @ p[1] / math.sqrt(p[0].sum() * p[1].sum()) == pytest.approx(want, abs=0.02)


# --- language models ------------------------------------------------------


def test_cross_entropy_difference_equals_brute_force(spark):
    r = random.Random(8)
    rows = [(i, " ".join(f"w{min(r.randrange(60), r.randrange(60))}" for _ in range(r.randrange(0, 80)))) for i in range(150)]
    rows += [(500, None), (501, " . "), (502, "W1 w1, é-w2")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n int")
    targets = spark.createDataFrame([(i,) for i in range(0, 60)] + [(0,), (None,), (7777,)], "doc_id long")
    size = 20
    got = {x["doc_id"]: x for x in lm_score.score(docs, lm_score.fit(docs, targets, size)).collect()}

    pattern = re.compile(rb"[A-Za-z0-9\x80-\xff]+")
    words = {i: [w.lower() for w in pattern.findall((t or "").encode())] for i, t in rows}
    count = Counter(w for v in words.values() for w in v)
    code = {w: int(T.Words([w], blank=toxicity.NOT_WORD).hashes().view(np.int64)[0]) for w in count}
    number = {w: n + 1 for n, w in enumerate(sorted(count, key=lambda w: (-count[w], code[w]))[: size - 1])}

    def model(ids):
        pairs = np.zeros((size, size))
        for i in ids:
            before = 0
            for w in words.get(i, []):
                pairs[before, number.get(w, 0)] += 1
                before = number.get(w, 0)
        one = pairs.sum(axis=0) + 1
        one /= one.sum()
        return lambda b, w: -math.log(0.75 * (pairs[b, w] / pairs[b].sum() if pairs[b].sum() else one[w]) + 0.25 * one[w])

    for i, v in words.items():
        target, background = model(set(range(60)) - {i}), model(set(words) - {i})  # a text's own counts are left out
        assert got[i]["n_words"] == len(v)
        if not v:
            assert got[i]["score"] is None and got[i]["target_loss"] is None
            continue
        sums, before = [0.0, 0.0], 0
        for w in v:
            n = number.get(w, 0)
            sums = [s + m(before, n) for s, m in zip(sums, (target, background))]
            before = n
        assert got[i]["target_loss"] == pytest.approx(sums[0] / len(v), rel=1e-5)
        assert got[i]["score"] == pytest.approx((sums[0] - sums[1]) / len(v), abs=1e-5)


def test_language_models_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long")
    models = lm_score.fit(docs, none)
    assert len({r["score"] for r in lm_score.score(docs, models).collect()}) == 1
    assert lm_score.score(docs.limit(0), lm_score.fit(docs.limit(0), none)).count() == 0


def test_scores_tell_likeness_not_membership(spark):
    """Held-out texts of the target's kind score like those learned from, texts of another kind do not."""
    r = random.Random(9)
    names = {"a": [f"a{i}" for i in range(400)], "b": [f"b{i}" for i in range(400)]}
    text = lambda k: " ".join(r.choice(names[k] if r.random() < 0.4 else names["a"] + names["b"]) for _ in range(60))
    rows = [(i, text("a" if i % 3 else "b")) for i in range(450)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kind = {i: "b" if i % 3 == 0 else "learned" if i % 2 else "held out" for i, _ in rows}
    targets = spark.createDataFrame([(i,) for i, k in kind.items() if k == "learned"], "doc_id long")
    got = {k: [] for k in ("learned", "held out", "b")}
    for x in lm_score.score(docs, lm_score.fit(docs, targets)).collect():
        got[kind[x["doc_id"]]].append(x["score"])
    more = lambda x, y: np.mean([a > b for a in got[x] for b in got[y]])
    assert 0.4 < more("held out", "learned") < 0.6
    assert more("b", "learned") > 0.9 and more("b", "held out") > 0.9


def test_every_word_and_pair_is_modelled(spark):
    r = random.Random(4)
    rows = [(i, " ".join(f"w{min(r.randrange(3000), r.randrange(3000))}" for _ in range(60))) for i in range(200)]
    rows += [(500, None), (501, "rare1 only rare2 twice rare2"), (None, "w1 w2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    other = spark.createDataFrame([(900, "w1 never seen w2 w5"), (901, rows[3][1]), (902, "")], "doc_id long, text string")
    models = lm_score.fit(docs, spark.createDataFrame([(i,) for i in range(50)], "doc_id long"))

    def learned(ids):
        now, before, pairs = Counter(), Counter(), Counter()
        for i, t in rows:
            v = (t or "").split()
            if i in ids:
                now.update(v)
                pairs.update(zip(["", *v], v))
                before.update(["", *v][: len(v)])
        return now, before, pairs

    both = learned(range(50)), learned({i for i, _ in rows})
    size = len(both[1][0]) + 1
    assert size > 1_500
    for table in (docs, other):
        texts = {r["doc_id"]: (r["text"] or "").split() for r in table.collect()}
        got = {r["doc_id"]: r for r in lm_score.score(table, models).collect()}
        assert set(got) == set(texts)
        for i, v in texts.items():
            assert got[i]["n_words"] == len(v) and (got[i]["score"] is None) == (not v)
            for name, (now, before, pairs), of in zip(("target_loss", "background_loss"), both, (range(50), texts)):
                loss = 0.0
                if table is docs and i in of:  # a text's own counts are left out
                    alone = learned({i})
                    now, before, pairs = now - alone[0], before - alone[1], pairs - alone[2]
                for b, w in zip(["", *v], v):
                    one = (now[w] + 1) / (now.total() + size)
                    loss -= math.log(0.75 * (pairs[b, w] / before[b] if before[b] else one) + 0.25 * one)
                assert not v or got[i][name] == pytest.approx(loss / len(v), rel=1e-9)
