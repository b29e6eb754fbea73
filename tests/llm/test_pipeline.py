"""The corpus pipeline and the registration of the corpus queries."""

import importlib
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from starfold.llm import pieces, toxicity
from starfold.llm.base import fold, table
from starfold.llm.queries import QUERIES, SQL

from .test_texts import brute_links, python_components, python_containment, python_sets

SF = "/root/testdata/sf0.001"


def test_stages_and_queries_are_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_join", "decontamination", "pieces"]
    names = __spark_entry__.queries()
    assert {*QUERIES, "pipeline"} <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert set(SQL) <= set(__spark_entry__.oracle_sql())


def test_entry_without_the_corpus_part(monkeypatch):
    for name in list(sys.modules):
        if name == "corpus_pipeline" or name.startswith("starfold.llm"):
            monkeypatch.delitem(sys.modules, name)

    class Hidden:
        def find_spec(self, name, path=None, target=None):
            if name == "corpus_pipeline" or name.startswith("starfold.llm"):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    monkeypatch.setattr(sys, "meta_path", [Hidden(), *sys.meta_path])
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    entry = importlib.import_module("__spark_entry__")
    assert entry.queries() and not any(n.startswith("op") or n == "pipeline" for n in entry.queries())


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's rows, by brute force but for the classifier."""
    docs = {r["doc_id"]: r for r in table(spark, SF, "documents").collect()}
    net = toxicity.fit(table(spark, SF, "documents"), table(spark, SF, "labels"), fold("doc_id", 3) != 1)
    score = dict(zip(docs, net.probability(toxicity.text_logits(net, [(r["text"] or "").encode() for r in docs.values()]).clip(-1e6)),
                     strict=True))
    kept = [{i for i in docs if score[i] < toxicity.THRESHOLD}]
    best = {}
    for i in kept[-1]:
        text = docs[i]["text"] or ""
        key = "".join(text.translate({c: None for c in (0x20, *range(9, 14))}))
        best[key] = min(best.get(key, (1, 0)), (-len(text), i))
    kept.append({i for _, i in best.values()})
    sets = python_sets([(i, docs[i]["text"]) for i in kept[-1]], 5)
    comps = python_components(sets, brute_links(sets, 4, 5))
    kept.append({i for i in sets if comps[i] == i})
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    bad = {x[0] for x in python_containment([(i, docs[i]["text"]) for i in kept[-1]], items)}
    kept.append(kept[-1] - bad)
    return docs, kept


def test_each_stage_equals_brute_force(spark, stages):
    docs, kept = stages
    frame = table(spark, SF, "documents")
    for (name, stage), want in zip(corpus_pipeline.STAGES[:-1], kept, strict=True):
        got = stage(spark, frame, SF)
        assert got.columns == frame.columns
        rows = {r["doc_id"]: r for r in got.collect()}
        assert set(rows) == want, name
        assert all(rows[i] == docs[i] for i in rows)
        frame = table(spark, SF, "documents").where(F.col("doc_id").isin(list(want)))
    assert len(kept[1]) < len(kept[0]) and len(kept[2]) < len(kept[1]) and len(kept[3]) < len(kept[2])


def test_the_pipeline_is_its_stages(spark, stages):
    docs, kept = stages
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in rows} == kept[-1] and len(rows) == len(kept[-1])
    m = pieces.Model(pieces.default_model())
    for r in rows[:50]:
        import numpy as np

        assert r["restored"]
        assert m.decode(np.array(r["pieces"]), np.array([r["n_pieces"]])) == [(docs[r["doc_id"]]["text"] or "").encode()]


def test_stages_take_an_empty_table_and_nulls(spark, tmp_path):
    empty = table(spark, SF, "documents").limit(0)
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", None, "s", 0), (None, "a b c", "en", "s", 5)], empty.schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name
    for name, stage in corpus_pipeline.STAGES[2:]:
        assert stage(spark, odd, SF).count() == 3, name
    assert corpus_pipeline.exact_copies(spark, odd, SF).count() == 2  # null and empty are one text


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = QUERIES[name](spark, SF)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({SQL[name]}) q").fetchall()
    assert sorted(map(str, (tuple(r[c] for c in cols) for r in got.collect()))) == sorted(map(str, map(tuple, want)))
