"""Token files, pieces, archives, URL lists."""

import datetime as dt
import gzip
import hashlib
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starfold.llm import pieces, token_files, url_filter, warc
from starfold.llm.files import read_file
from starfold.llm.spans import SpanCache, gather

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
BPE = public.path("byte_bpe_50k.json")

ODD = list("ab Zé.,;'s\n\t 　ñ1·’́中 \x1c\x85▁<>0x") + ["<|endoftext|>", "'ll", "...", "!?", "  ", "the ", "tion"]


def odd_texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randrange(0, 60))) for _ in range(n)] + ["", " ", "\n", " a", "a ", "a" * 300]


# --- token files ----------------------------------------------------------


def test_pack_round_trip():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 4, 5, 1000):
        for bits in (1, 8, 9, 16, 17, 24, 25, 32):
            v = r.integers(0, 1 << bits, n)
            control, data = token_files.pack(v)
            assert len(control) == -(-n // 4) and (token_files.unpack(control, data, n) == v).all()


def test_encoder_equals_the_library():
    texts = odd_texts(3000, 2)
    flat, many = token_files.Encoder(BPE).encode([t.encode() for t in texts])
    got = np.split(flat, np.cumsum(many)[:-1])
    want = tokenizers.Tokenizer.from_file(BPE).encode_batch(texts, add_special_tokens=False)
    assert [g.tolist() for g in got] == [w.ids for w in want]


def test_token_files_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_TOKENS", 500)
    texts = odd_texts(200, 3)
    rows = [(i * 7 % 1009, t) for i, t in enumerate(texts)] + [(2000, None), (2001, "x " * 3000), (2001, "x " * 3000), (None, "lost")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, start int")
    files = token_files.write_token_files(docs, f"file://{tmp_path}", BPE)
    got = token_files.read_token_files(files).collect()
    plain = tokenizers.Tokenizer.from_file(BPE)
    at, want = 0, []
    for i, t in sorted(rows, key=lambda x: (x[0] is not None, x[0])):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda x: x[1]) == want
    assert sum(r["n_docs"] for r in files.collect()) == len(rows)
    none = token_files.write_token_files(docs.limit(0), f"file://{tmp_path}", BPE)
    assert none.count() == 0 and token_files.read_token_files(none).count() == 0


def test_ranks_are_by_frequency_and_damage_is_noticed(tmp_path):
    path = tmp_path / "one.rvb"
    with open(path, "wb") as f:
        token_files.write_block(f, [1, 2], [3, 4], np.array([9, 9, 5, 9, 5, 70000, 3]))
    with read_file(str(path)) as f:
        (ids, sizes, tokens), = token_files.read_blocks(f)
    assert ids.tolist() == [1, 2] and sizes.tolist() == [3, 4] and tokens.tolist() == [9, 9, 5, 9, 5, 70000, 3]
    path.write_bytes(b"XXXX" + path.read_bytes()[4:])
    with pytest.raises(ValueError), read_file(str(path)) as f:
        list(token_files.read_blocks(f))


# --- pieces ---------------------------------------------------------------

MODEL = pieces.default_model()


def test_without_dropout_pieces_are_the_library_s():
    import sentencepiece

    texts = [t for t in odd_texts(2000, 4) if "▁" not in t]
    flat, many = pieces.Model(MODEL).encode(texts, np.zeros(len(texts), np.uint64), 0.0)
    want = sentencepiece.SentencePieceProcessor(model_file=MODEL).encode(texts, num_threads=1)
    assert [g.tolist() for g in np.split(flat, np.cumsum(many)[:-1])] == want


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.5, 1.0])
def test_decoding_restores_every_text(rate):
    texts = odd_texts(1500, 5) + ["a▁b", "▁", "😀 é", "\x00"]
    m = pieces.Model(MODEL)
    flat, many = m.encode(texts, np.arange(len(texts), dtype=np.uint64), rate)
    assert m.decode(flat, many) == [t.encode() for t in texts]


def test_rows_and_agenda_agree_and_keys_differ(monkeypatch):
    texts = odd_texts(300, 6) + ["the information of international nations " * 20]
    keys = np.arange(len(texts), dtype=np.uint64)
    rows, n = pieces.Model(MODEL).encode(texts, keys, 0.3)
    other, _ = pieces.Model(MODEL).encode(texts, keys + np.uint64(1), 0.3)
    monkeypatch.setattr(pieces, "TOGETHER", 0)
    agenda, m = pieces.Model(MODEL).encode(texts, keys, 0.3)
    assert rows.tolist() == agenda.tolist() and n.tolist() == m.tolist()
    assert rows.tolist() != other.tolist()


def test_skipping_follows_the_rate():
    word = np.arange(20_000, dtype=np.uint64)
    for rate in (0.0, 0.1, 0.5, 1.0):
        share = pieces.skipped(pieces.T.mix(word), 0, 1, 2, rate).mean()
        assert abs(share - rate) < 0.02


def test_encode_and_decode_tables(spark):
    rows = [(i, t, "x") for i, t in enumerate(odd_texts(100, 7))] + [(500, None, None), (None, "no id", "x"), (3, "twice", "x"), (3, "twice", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, pieces string")
    got = pieces.encode(docs, MODEL, 0.2)
    back = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in pieces.decode(got, MODEL).collect())
    assert back == sorted((i is None, i or 0, t or "") for i, t, _ in rows)
    trip = pieces.round_trip(docs, MODEL, 0.2, keep=True).collect()
    assert all(r["restored"] and r["n_pieces"] == len(r["pieces"]) for r in trip)
    assert all(r["ids_crc32"] == zlib.crc32(np.array(r["pieces"], "<u4").tobytes()) for r in trip)
    assert pieces.encode(docs.limit(0), MODEL).count() == 0
    again = {r["doc_id"]: r["pieces"] for r in pieces.encode(docs.repartition(7), MODEL, 0.2).collect()}
    assert all(again[r["doc_id"]] == r["pieces"] for r in trip if r["doc_id"] not in (3, None))


def test_every_occurrence_draws_its_own_skips(spark):
    word = "internationalization"
    rows = [(0, " ".join([word] * 500)), *((i, word) for i in range(1, 501))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: tuple(r["pieces"]) for r in pieces.encode(docs, MODEL, 0.1).collect()}
    m = pieces.Model(MODEL)
    words, cuts = [], got[0]
    begin = [i for i, p in enumerate(cuts) if m.names[p].startswith(pieces.MARK)] + [len(cuts)]
    words = [cuts[a:b] for a, b in zip(begin, begin[1:])]
    assert len(words) == 500 and len(set(words)) > 20
    assert len({got[i] for i in range(1, 501)}) > 20
    # With one candidate merge, the rate is the share of occurrences that are cut.
    pair = next(n for n, p in enumerate(m.names) if len(p) == 2 and p[0] == pieces.MARK and p[1].isalpha())
    flat, _ = m.encode([" ".join([m.names[pair][1]] * 20_000)], np.zeros(1, np.uint64), 0.1)
    assert abs((flat != pair).sum() / 2 / 20_000 - 0.1) < 0.01


# --- archives -------------------------------------------------------------

PAGES = [
    (1, "http://www.Example.org:80/a/b?x=1#top", "same " * 40), (2, "https://user@sub.example.org/", "same " * 40),
    (3, "http://example.org/a", "short"), (4, "http://example.org/b", "short"), (5, None, None), (6, "no address", ""),
    (7, "http://example.org/a\r\nX: y", "é\r\n\r\nWARC/1.1 " * 30), (8, "http://example.com./q", "long " * 50_000),
    (9, "http://example.org/a", "same " * 40), (9, "http://example.org/a", "same " * 40), (None, "http://example.org/z", "same " * 40),
]


def test_archives_read_back_through_the_index(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    pages = spark.createDataFrame([(*p, 5) for p in PAGES], "page_id long, url string, html string, digest int")
    places = warc.write_archives(pages, f"file://{tmp_path}/w")
    directory = warc.write_index(places, f"file://{tmp_path}/i")
    wanted = pages.select(warc.url_key("url").alias("key"))
    got = warc.lookup(wanted, directory).collect()
    want = []
    for i, _, html in PAGES:
        data = (html or "").encode()
        first = min(j for j, _, h in PAGES if h == html and j is not None)
        again = len(data) >= 100 and first != i
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first if again else None))
    key = lambda x: (x[0] is None, x[0] or 0)
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)

    # Only what is asked for is read: unknown, null and repeated keys among it.
    some = spark.createDataFrame([("org,example)/a", 1), ("org,example)/a", 2), ("", 3), ("zz", 4), (None, 5), (")", 6)], "key string, uri int")
    assert sorted(r["page_id"] for r in warc.lookup(some, directory).collect()) == [3, 5, 9, 9]
    assert {r["key"] for r in warc.lookup(some, directory).collect()} == {"org,example)/a", ")"}

    index = warc.CaptureIndex(directory)
    assert [c.page for c in index.captures("org,example)/a")] == [3, 9, 9]
    found = index.captures("org,example)/a/b?x=1")
    assert [(c.page, c.kind, c.payload.decode()) for c in found] == [(1, "response", "same " * 40)]
    assert [c.page for c in index.captures("org,example,sub)/")] == [2]
    assert [c.page for c in index.captures("com,example)/q")] == [8]
    assert [c.page for c in index.captures(")")] == [5] and [c.page for c in index.captures(")no address")] == [6]
    assert index.captures("org,example)/nothing") == [] and index.captures("") == [] and index.captures("zz") == []
    for r in places.collect():  # each record is a gzip member of its own
        with read_file(r["uri"]) as f:
            assert gzip.decompress(f.read_at(r["length"], r["offset"])).startswith(b"WARC/1.1\r\nWARC-Type: " + r["record_type"].encode())


def test_an_address_of_very_many_captures_is_spread_over_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    rows = [(i, "http://hot.org/" if i % 3 else f"http://site{i}.org/", f"page {i}") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    directory = warc.write_index(warc.write_archives(pages, str(tmp_path / "w")), str(tmp_path / "i"))
    hot = directory.where("first_key <= 'org,hot)/' and last_key >= 'org,hot)/'")
    assert hot.select("shard").distinct().count() > 2
    got = warc.lookup(pages.select(warc.url_key("url").alias("key")), directory).collect()
    assert sorted(r["page_id"] for r in got) == list(range(300))
    one = spark.createDataFrame([("org,hot)/",)], "key string")
    assert sorted(r["page_id"] for r in warc.lookup(one, directory).collect()) == [i for i in range(300) if i % 3]


def test_archives_of_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    directory = warc.write_index(warc.write_archives(pages, str(tmp_path)), str(tmp_path))
    assert warc.lookup(pages.select(F.col("url").alias("key")), directory).count() == 0 and warc.CaptureIndex(directory).captures("x") == []


def test_damaged_payload_is_noticed():
    data = warc.record(1, "http://a/", b"payload", hashlib.sha256(b"payload").hexdigest(), None)
    assert warc.parse(data).payload == b"payload"
    with pytest.raises(ValueError):
        warc.parse(data.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"))


# --- URL lists ------------------------------------------------------------


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def python_judgement(url, when, log):
    host, _, path = (url or "").partition("://")[2].partition("/")
    host = host.lower()
    if not host or when is None:
        return False, None, None
    labels, parts = host.split("."), [p for p in path.split("?")[0].split("/") if p]
    names = {".".join(labels[i:]) for i in range(len(labels))} | {"/".join([host, *parts[:i]]) for i in range(1, len(parts) + 1)}
    best = None
    for p in names:
        past = sorted((s, a) for q, a, s in log if q == p and s is not None and s <= when and a in url_filter.ACTIONS)
        if past:
            since = past[-1][0]
            action = min(a for s, a in past if s == since)
            if action != "remove":
                best = max(best or (0, "", "", day(0)), (len(p), p, action, since))
    return (best[2] == "block", best[1], best[3]) if best else (False, None, None)


def test_list_join_equals_brute_force(spark):
    r = random.Random(9)
    hosts = ["a.com", "x.a.com", "y.x.a.com", "b.org", "c.net"]
    log = [(r.choice(hosts) + r.choice(["", "/p", "/p/q"]), r.choice(["block", "block", "allow", "remove"]), day(r.randrange(300)))
           for _ in range(120)]
    log += [("a.com", "block", day(50)), ("a.com", "allow", day(50)), (None, "block", day(1)), ("b.org", "burn", day(1)), ("c.net", "block", None)]
    captures = [(i, f"http://{r.choice(hosts).upper()}/" + r.choice(["", "p", "p/q/r", "p?x#y", "z"]), day(r.randrange(330))) for i in range(400)]
    captures += [(900, None, day(3)), (901, "nothing", day(3)), (902, "http://a.com/", None), (903, "http:///p", day(9)),
                 (None, "http://a.com/p", day(60)), (904, "http://b.org/p", day(100)), (904, "http://b.org/p", day(100))]
    c = spark.createDataFrame([(*x, "z") for x in captures], "page_id long, url string, fetched date, action string")
    e = spark.createDataFrame(log, "pattern string, action string, since date")
    got = sorted((str(r["page_id"]), str(r["fetched"]), r["blocked"], r["pattern"], r["since"]) for r in url_filter.list_join(c, e).collect())
    want = sorted((str(i), str(w), *python_judgement(u, w, log)) for i, u, w in captures)
    assert list(map(str, got)) == list(map(str, want))
    assert sum(x[2] for x in want) > 30


def test_list_join_of_empty_tables(spark):
    c = spark.createDataFrame([(1, "http://a.com/", day(1))], "page_id long, url string, fetched date")
    e = spark.createDataFrame([("a.com", "block", day(0))], "pattern string, action string, since date")
    assert [r["blocked"] for r in url_filter.list_join(c, e.limit(0)).collect()] == [False]
    assert url_filter.list_join(c.limit(0), e).count() == 0
    assert [r["blocked"] for r in url_filter.list_join(c, e).collect()] == [True]


# --- memory of a worker -----------------------------------------------------


def peak_mb(run) -> float:
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def distinct_words(n: int) -> list[str]:
    return [" ".join(f"{x:x}" for x in range(i, i + 1000)) for i in range(1 << 20, (1 << 20) + 1000 * n, 1000)]


@pytest.mark.parametrize("encoded", [lambda b: token_files._encoded(b, BPE, 2), lambda b: pieces._encoded(b, MODEL, 0.1, 7)])
def test_a_batch_is_encoded_in_small_parts(encoded):
    """16 MB of text in one batch; all of it at hand as bytes and strings would be 32 MB, a slice's arrays far more."""
    list(encoded([pa.record_batch([pa.array([1]), pa.array(["warm up"])], names=["id", "text"])]))
    texts = [t.replace("1", "the ") for t in distinct_words(10)] * 140
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    assert batch.column(1).nbytes > 14e6
    assert peak_mb(lambda: [None for _ in encoded([batch])]) < 100


def test_kept_spans_are_bounded_and_those_asked_for_again_stay():
    cache = SpanCache(limit=1000, ids=5000)
    asked = 0

    def encode(at):
        nonlocal asked
        asked += (keys[at] < 10).sum()
        return np.repeat(keys[at], 3).astype(np.int64), np.full(len(at), 3)

    for i in range(50):
        keys = np.concatenate([np.arange(10), np.arange(100) + 100 * (i + 1)]).astype(np.uint64)
        flat, begin, size = cache.sequences(keys, encode)
        assert (gather(flat, begin, size) == np.repeat(keys, 3)).all()
        assert len(cache.keys) <= 1000 and len(cache.flat) <= 5000 + 3 * len(keys)
        assert len(cache.keys) == len(cache.again) == len(cache.begin) == len(cache.size)
    assert asked == 10  # the common ones were encoded once


def test_kept_spans_are_bounded_in_ids():
    cache = SpanCache(limit=1000, ids=5000)
    for i in range(20):
        keys = np.array([i, i + 1], dtype=np.uint64)
        flat, begin, size = cache.sequences(keys, lambda at: (np.repeat(keys[at], 2000).astype(np.int64), np.full(len(at), 2000)))
        assert (gather(flat, begin, size) == np.repeat(keys, 2000)).all()
        assert len(cache.flat) <= 5000 + 2 * 2000
