"""Line de-duplication against brute force."""

import hashlib
import random
import re
from itertools import groupby

import pytest

from starfold.llm import line_dedup
from starfold.llm.base import staged

ENDS = re.compile(r"^[ \t\n\x0b\f\r]+|[ \t\n\x0b\f\r]+$")


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in ENDS.sub("", line))


def brute_force(rows, min_chars=40, min_docs=5):
    """For each row: (id, lines, dropped lines, kept text)."""
    low = lambda i: (i is not None, i or 0)
    held = {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                held.setdefault(key(x), set()).add(i)
    last = {k: max(v, key=low) for k, v in held.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in last or last[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def line_texts(n=60, seed=5):
    r = random.Random(seed)
    common = [f"Common  line {i}: " + "xÉİy " * r.randrange(4, 12) for i in range(15)]
    out = []
    for i in range(n):
        lines = []
        for _ in range(r.choice([0, 1, 3, 12, 60])):
            x = r.choice(common) if r.random() < 0.5 else f"line of its own {r.random()} " * r.randrange(1, 4)
            x = x.upper() if r.random() < 0.1 else x
            lines.append(r.choice(["", " ", "\t\r", " "]) + x + r.choice(["", "\r", "\x0b "]))
            if r.random() < 0.2:
                lines.append("short")
        lines[len(lines) // 2 : len(lines) // 2] = [common[0]]
        out.append((i * 3 - 7, "\n".join(lines)))
    out += [(500, None), (501, ""), (502, "\n\n"), (503, common[0]), (503, common[0]), (504, "\n".join([common[0]] * 5)),
            (505, common[1] + "\n"), (505, "another text of the same id\n" + common[1]),
            (None, common[0] + "\nnull id"), (None, common[0]), (506, common[0] + "\n" + "long text " * 50_000)]
    return out


@pytest.mark.parametrize("stream_lines", [0, 20, 10_000])
def test_line_dedup_equals_brute_force(spark, stream_lines):
    rows = line_texts()
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, digest string, pos int")
    got = line_dedup.line_dedup(docs, stream_lines=stream_lines).collect()
    want = brute_force(rows)
    order = lambda x: (x[0] is None, x[0] or 0, x[3])
    assert sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in got), key=order) == sorted(want, key=order)
    assert sum(w[2] for w in want) > 100
    for r in got:  # the bitmap is alternating run lengths, kept lines first
        assert (r["gone"] is None) == (r["n_dropped"] == 0)
        assert r["gone"] is None or (sum(r["gone"][1::2]) == r["n_dropped"] and all(x > 0 for x in r["gone"][1:]))


def test_the_largest_id_keeps_all_its_lines(spark):
    line = "a line that is longer than forty code points, really"
    docs = spark.createDataFrame([(i, f"{line}\nown {i}\n {line.upper()}") for i in range(5)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in line_dedup.line_dedup(docs).collect()}
    assert got[4]["kept"] == f"{line}\nown 4\n {line.upper()}" and got[4]["gone"] is None
    assert got[0]["kept"] == "own 0" and got[0]["gone"] == [0, 1, 1, 1]
    assert all(r["n_dropped"] == 0 for r in line_dedup.line_dedup(docs.where("doc_id > 0")).collect())
    assert line_dedup.line_dedup(docs.limit(0)).count() == 0


def test_a_key_on_most_lines_is_never_sorted(spark):
    docs = spark.createDataFrame([(i, "the same line again and again, in every document\nown") for i in range(300)],
                                 "doc_id long, text string")
    lines = staged(line_dedup.line_hashes(docs), "lines")
    got = {r["doc_id"] for r in line_dedup.repeated_lines(lines, stream_lines=50).collect()}
    assert got == set(range(299))


def test_bitmaps_leave_the_right_lines(spark):
    r = random.Random(2)
    rows = []
    for i in range(200):
        keep = [r.random() < 0.6 for _ in range(r.randrange(1, 30))]
        runs = [len(list(g)) for _, g in groupby(keep)]
        runs = runs if keep[0] else [0, *runs]
        rows.append((i, "\n".join(f"l{j}" for j in range(len(keep))), runs, "\n".join(f"l{j}" for j, k in enumerate(keep) if k)))
    df = spark.createDataFrame(rows, "id int, text string, gone array<int>, want string")
    assert df.where(line_dedup.kept_text("text", "gone") != df["want"]).count() == 0


def test_the_plan_streams_sorted_ranges_without_python(spark, capsys):
    docs = spark.createDataFrame([(1, "a\nb")], "doc_id long, text string")
    lines = staged(line_dedup.line_hashes(docs), "lines")
    line_dedup.repeated_lines(lines).explain()
    plan = capsys.readouterr().out
    assert plan.count("rangepartitioning") == 1 and "hashpartitioning" not in plan  # the windows use the ranges
    line_dedup.line_dedup(docs).explain()
    assert not re.search("Python|Pandas|Arrow", plan + capsys.readouterr().out)


def test_digest_of_the_query(spark, tmp_path):
    rows = line_texts(20)
    spark.createDataFrame([x for x in rows if x[0] is not None], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = line_dedup.op12_line_dedup(spark, str(tmp_path)).collect()
    want = {(w[0], w[1], w[2], hashlib.sha256(w[3].encode()).hexdigest()) for w in brute_force([x for x in rows if x[0] is not None])}
    assert {tuple(r) for r in got} == want
