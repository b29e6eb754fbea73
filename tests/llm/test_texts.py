"""Words, shingles, components, exact and near copies, decontamination."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starfold.llm import decontaminate, exact_dedup, tokens, trie_join
from starfold.llm.base import fold
from starfold.llm.graph import components

BLANK = re.compile(rb"[^\x20\x09-\x0d]+")


def lower(data: bytes) -> bytes:
    return bytes(c + 32 if 65 <= c <= 90 else c for c in data)


def python_sets(rows, k):
    out = {}
    for i, t in rows:
        w = [lower(x) for x in BLANK.findall((t or "").encode())]
        out[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    return out


def python_components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_texts(n=120, seed=3, vocabulary=400):
    """Texts, most of them changed copies of a few, with a shared passage in many."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(vocabulary)}"
    base = [[word() for _ in range(r.randrange(3, 120))] for _ in range(12)]
    shared = [word() for _ in range(30)]
    out = []
    for i in range(n):
        t = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 5])):
            t[r.randrange(len(t))] = word()
        if i % 4 == 0:
            t += shared
        out.append((i + 5, "  ".join(t) if i % 3 else "\n".join(t).upper()))
    return out


def test_words_match_the_pattern_and_hashes_depend_on_bytes_only():
    texts = ["", " ", "a", " A\tb\x0bB  é\x00x \r\n", "x" * 5000 + " y", "the the"]
    w = tokens.Words([t.encode() for t in texts])
    got = [bytes(w.buf[a:b]) for a, b in zip(w.start, w.end)]
    want = [lower(x) for t in texts for x in BLANK.findall(t.encode())]
    assert got == want
    assert np.diff(w.first).tolist() == [len(BLANK.findall(t.encode())) for t in texts]
    same = {}
    for g, h in zip(got, w.hashes().tolist()):
        assert same.setdefault(g, h) == h
    assert len(set(same.values())) == len(same)


def test_hashes_do_not_depend_on_slices(monkeypatch):
    texts = [(" ".join(f"word{i * j}" for i in range(50))).encode() for j in range(40)]
    whole = tokens.Words(texts).hashes()
    monkeypatch.setattr(tokens, "SLICE_BYTES", 100)
    assert (tokens.Words(texts).hashes() == whole).all()


@pytest.mark.parametrize("k", [1, 4, 5])
def test_shingles_are_the_distinct_runs(k):
    texts = ["", "a", "a b c", "a b c d e f", "x y x y x y x y", " ".join("ab"[i % 2] for i in range(99))]
    w = tokens.Words([t.encode() for t in texts])
    sizes = [len(s) for s in tokens.shingles(w.hashes(), w.first, k)]
    assert sizes == [len(s) for s in python_sets(enumerate(texts), k).values()]


def test_fold_is_crc32_of_the_text(spark):
    rows = spark.createDataFrame([(i,) for i in (0, 7, -3, 123456789)], "doc_id long")
    for r in rows.select("doc_id", fold("doc_id", 3).alias("f")).collect():
        assert r["f"] == zlib.crc32(str(r["doc_id"]).encode()) % 3


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(3, 2), (2, 1), (1, 0), (9, 8)], [(i, i + 1) for i in range(40)],
                                   [(0, i) for i in range(1, 30)] + [(None, 4)]])
def test_components(spark, edges):
    got = {r["id"]: r["comp"] for r in components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    assert got == python_components({x for e in real for x in e}, real)


# --- exact copies ---------------------------------------------------------

EXACT = [(1, "a b"), (2, "ab"), (3, " a\tb\x0b"), (4, None), (5, ""), (6, "\n \r"), (7, "x" * 200), (8, "x" * 199 + " x"),
         (9, "x" * 64 + "y"), (10, "x" * 64 + "z"), (11, "é"), (12, "é "), (2, "ab"), (None, "null id"),
         (None, "a    b    "), (None, "null id "), (20, "q" * 70), (None, "q" * 69 + "     q")]


@pytest.mark.parametrize("digest_all", [True, False])
def test_exact_dedup_equals_brute_force(spark, digest_all):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in EXACT], "doc_id long, text string, keep_id string, size int")
    got = exact_dedup.exact_dedup(docs, digest_all=digest_all).collect()
    groups = {}
    for i, t in EXACT:
        groups.setdefault(re.sub(r"[\x20\x09-\x0d]", "", t or ""), []).append((-len(t or ""), i))
    want = Counter()
    for rows in groups.values():
        best = min((x for x in rows if x[1] is not None), default=(0, None))[1]  # a null id stands for no other row
        want.update((i, best if i is not None else None, len(rows), i is None or i == best) for _, i in rows)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in got) == want
    if digest_all:
        assert all(len(r["text_sha256"]) == 64 for r in got)


def test_drop_exact_copies_keeps_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in EXACT], "doc_id long, text string, gone string, gone_ int")
    left = exact_dedup.drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 0, 0, 0, 3, 6, 8, 9, 10, 11, 12, 20]
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0


# --- near copies ----------------------------------------------------------


def brute_links(sets, num, den):
    ids = sorted(sets)
    return [(a, b) for n, a in enumerate(ids) for b in ids[:n]
            if sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]


@pytest.mark.parametrize(("k", "num", "den", "rows", "hot"), [(4, 85, 100, None, 8), (5, 4, 5, None, 2), (2, 1, 2, None, 8), (4, 85, 100, 7, 1)])
def test_similar_sets_equal_brute_force(spark, monkeypatch, k, num, den, rows, hot):
    monkeypatch.setattr(trie_join, "HOT", hot)
    if rows:  # large blocks: parts and pairs of parts
        monkeypatch.setattr(trie_join, "BLOCK_ROWS", rows)
    texts = near_texts() + [(0, None), (1, ""), (2, " \n"), (3, "one two"), (4, "ONE  two"), (1000, "one")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in texts], "doc_id long, text string, rep int")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in trie_join.similar_sets(docs, k=k, threshold=(num, den)).collect()}
    sets = python_sets(texts, k)
    comps = python_components(sets, brute_links(sets, num, den))
    assert got == {i: (len(s), comps[i]) for i, s in sets.items()}
    assert len(set(comps.values())) < len(comps)


def test_similar_sets_at_the_exact_threshold(spark):
    # 17 of 20 shingles shared: exactly 0.85; 16 of 19: less.
    base = [f"a{i}" for i in range(23)]
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(base[:20])), (3, " ".join(base[:19]))], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in trie_join.similar_sets(docs, k=4, threshold=(85, 100)).collect()}
    assert got == {1: 1, 2: 1, 3: 1}  # 3 and 2: 16 of 17
    docs = docs.where("doc_id <> 2")
    got = {r["doc_id"]: r["component_id"] for r in trie_join.similar_sets(docs, k=4, threshold=(85, 100)).collect()}
    assert got == {1: 1, 3: 3}


def test_similar_sets_edge_cases(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e")], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in trie_join.similar_sets(docs).collect())
    assert got == [(0, 1), (1, 1), (1, 1)]
    assert trie_join.similar_sets(docs.limit(0)).count() == 0
    kept = trie_join.drop_similar(spark.createDataFrame([(1, "a b", "x"), (2, "a b", "y")], "doc_id long, text string, sig string"))
    assert [tuple(r) for r in kept.collect()] == [(1, "a b", "x")]


def test_linked_sets_have_an_equal_segment():
    r = np.random.default_rng(1)
    for _ in range(400):
        n = int(r.integers(1, 200))
        a = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
        b = np.unique(np.concatenate([a[r.random(len(a)) > 0.06], r.integers(0, 1 << 63, max(1, n // 20)).astype(np.uint64)]))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 85 * (len(a) + len(b) - common):
            more = {c: (x, slack) for x, c, slack in trie_join.segments(b, 85, 100)}
            c = max(trie_join.size_class(len(a), 85, 100)[0], trie_join.size_class(len(b), 85, 100)[0])
            (x, slack), = ((x, slack) for x, d, slack in trie_join.segments(a, 85, 100) if d == c)
            assert np.isin(x, more[c][0]).sum() > max(slack, more[c][1])


@pytest.mark.parametrize("step", [1, 3, 1000])
def test_runs_do_not_depend_on_batches(step):
    import pyarrow as pa

    r = random.Random(step)
    rows = sorted((r.randrange(12), r.choice([10, 11, 40]) << 32 | 5, i) for i in range(200))
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + step])], ["seg", "size", "rep"])
               for i in range(0, len(rows), step)]

    def total(parts):
        out = Counter()
        for b in trie_join._neighbours(parts, 85, 100):
            for x in b.to_pylist():
                out[tuple(x.values())[:5]] += x["n"]
        return out

    got = total(batches)
    assert got == total([pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["seg", "size", "rep"])])
    runs = {}
    for seg, size, i in rows:
        runs.setdefault((seg, size >> 32 == 40), []).append(i)
    assert {x[1] for x in got if x[0] == 1} == {i for v in runs.values() if len(v) > trie_join.HOT for i in v}
    assert {x[1:3] for x in got if x[0] == 0} == {(max(i, j), min(i, j)) for v in runs.values() if len(v) <= trie_join.HOT
                                                  for i in v for j in v if i != j}


def test_prefix_tree_search_is_exact():
    r = np.random.default_rng(5)
    sets = [np.unique(r.integers(0, 60, r.integers(1, 40))) for _ in range(150)]
    sets += [sets[0], sets[1][:-1] if len(sets[1]) > 1 else sets[1]]
    tree = trie_join.PrefixTree(sets)
    for s in sets:
        want = [j for j, x in enumerate(sets) if 10 * len(np.intersect1d(s, x)) >= 4 * len(np.union1d(s, x))]
        assert sorted(tree.search(s, 4, 10)) == want


# --- decontamination ------------------------------------------------------


def python_containment(docs, items, num=4, den=5):
    words = lambda t: [x for x in re.split(r"[^\w]+|_", (t or "").lower()) if x]
    short = {len(words(t)) for i, t in items if i is not None} & {1, 2, 3, 4}

    def sets(rows, lengths):
        out = {}
        for i, t in rows:
            w = words(t)
            s = {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
            s |= {tuple(w[j : j + n]) for n in lengths for j in range(len(w) - n + 1)}
            if i is not None:
                out.setdefault(i, set()).update(s)
        return out

    d, t = sets(docs, short), sets(items, [])
    return {(a, b, len(y), len(x & y)) for a, x in d.items() for b, y in t.items() if y and den * len(x & y) >= num * len(y)}


def contamination_case(seed=4):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([1, 3, 4, 5, 6, 9, 15, 20, 40, 60, 60])]
    docs = []
    for i in range(60):
        body = [word() for _ in range(r.choice([0, 3, 30, 400, 6000]))]
        if i % 2:
            passage = r.choice(items)[1].split()
            if i % 3 == 0 and len(passage) > 12:
                passage[r.randrange(len(passage))] = "changed"
            at = r.randrange(len(body) + 1)
            body[at:at] = [x.title() for x in passage]
        docs.append((i, ", ".join(body) + "."))
    return docs, items


def test_containment_equals_brute_force(spark):
    docs, items = contamination_case()
    docs += [(100, None), (101, ""), (102, "..."), (None, items[8][1])]
    items += [(50, None), (51, ""), (52, "?!"), (None, "w1 w2 w3 w4 w5")]
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, item_id string")
    t = spark.createDataFrame([(i, t, 0.5) for i, t in items], "item_id long, text string, h double")
    got = decontaminate.containment(d, t).collect()
    want = python_containment(docs, items)
    assert {(r["doc_id"], r["item_id"], r["n_item"], r["n_shared"]) for r in got} == want
    assert len(got) == len(want) > 10
    left = decontaminate.drop_contaminated(d, t)
    assert {r["doc_id"] for r in left.collect()} == {i for i, _ in docs} - {w[0] for w in want}
    assert left.columns == d.columns


def test_dropping_stages_take_clashing_columns(spark):
    words = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, words, "a", 1, 0), (2, words + " x", "b", 2, 0), (3, "other text", "c", 3, 0)],
                                 "doc_id long, text string, gone string, _bad int, component_id int")
    left = trie_join.drop_similar(docs, k=5, threshold=(80, 100))
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [1, 3]
    items = docs.where("doc_id = 3").select(F.col("doc_id").alias("item_id"), "text", "gone")
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [1, 2]


def test_short_items_are_found_inside_longer_texts(spark):
    docs = spark.createDataFrame([(1, "The quick, brown fox jumps over the lazy dog."), (2, "brown fox"), (3, "fox brown jumps " * 9),
                                  (4, "jumps"), (5, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "Brown FOX jumps"), (2, "jumps"), (3, "brown fox"), (4, "over the lazy dog")],
                                  "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.containment(docs, items).collect()}
    assert got == {(1, 1), (1, 2), (1, 3), (1, 4), (2, 3), (3, 2), (4, 2)}


def test_containment_of_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    t = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert decontaminate.containment(d.limit(0), t).count() == 0
    assert decontaminate.containment(d, t.limit(0)).count() == 0
    assert decontaminate.containment(d, t).count() == 1


def test_native_plans_run_no_python(spark, capsys):
    d = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    exact_dedup.exact_dedup(d, digest_all=True).explain()
    decontaminate.containment(d, d.withColumnRenamed("doc_id", "item_id")).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
