"""Registered queries against their oracles, and the pipeline against its stages done plainly."""

import os
import re
from collections import Counter

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from helpers_llm import awkward_documents, no_documents

import __spark_entry__ as entry_mod
from panelscope.llm import bpe
from panelscope.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def test_registered_queries():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(QUERIES) <= set(q) and "pipeline" in q and set(ORACLES) <= set(o)
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    con.execute(f"CREATE VIEW result AS {ORACLES[name]}")
    rel = con.sql("SELECT * FROM result")
    df = QUERIES[name](spark, SF)
    assert sorted(df.columns) == sorted(rel.columns)
    order = sorted(df.columns)
    assert Counter(tuple(r[c] for c in order) for r in df.collect()) == Counter(tuple(r[rel.columns.index(c)] for c in order) for r in rel.fetchall())


def run_stages(spark, docs):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, SF)
        docs = spark.createDataFrame(rows.collect(), rows.schema)  # written and read again
        out.append(docs)
    return out


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    good, lone, masked, mixed, tokens = run_stages(spark, docs)
    assert all(d.columns == docs.columns for d in (good, lone, masked, mixed))
    kept = {r.doc_id for r in QUERIES["op1_quality_rules"](spark, SF).where("kept").collect()}
    assert {r.doc_id for r in good.collect()} == kept
    sets = {}
    for r in lone.collect():
        w = r.text.encode().lower().split()
        sets[r.doc_id] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
    ids = sorted(sets)
    assert not any(5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]) for i, a in enumerate(ids) for b in ids[:i])
    all_sets = {}
    for r in good.collect():
        w = r.text.encode().lower().split()
        all_sets[r.doc_id] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
    for d in set(all_sets) - set(ids):  # what went is close to something with a smaller id
        assert any(5 * len(all_sets[d] & s) >= 4 * len(all_sets[d] | s) for e, s in all_sets.items() if e != d)
    text = {r.doc_id: r.text for r in masked.collect()}
    assert set(text) == set(ids)
    assert not any(re.search(r"[A-Za-z0-9]@[A-Za-z0-9-]+\.[a-z]", t) for t in text.values()) and any("<EMAIL>" in t or "<PHONE>" in t for t in text.values())
    copies = Counter(r.doc_id for r in mixed.collect())
    assert set(copies) <= set(text) and max(copies.values()) <= 3
    assert sum(len(text[d].split()) * n for d, n in copies.items()) == pytest.approx(sum(len(t.split()) for t in text.values()), rel=0.02)
    rows = tokens.collect()
    assert Counter(r.doc_id for r in rows) == copies and all(r.round_trip and r.n_tokens == len(r.tokens) // 4 for r in rows)
    with open(os.path.join(corpus_pipeline.TOKENIZER_DIR, corpus_pipeline.BPE_FILE), encoding="utf-8") as f:
        t = bpe.tokenizer(f.read())
    assert all(t.decode(bytes(r.tokens)) == text[r.doc_id] for r in rows)
    assert before.keys() >= copies.keys()


def test_run_is_the_stages_in_order(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and [names[0], names[2]] == ["quality rules", "pii"]
    out = corpus_pipeline.run(spark, SF)
    stages = run_stages(spark, spark.read.parquet(f"{SF}/documents.parquet"))
    assert Counter((r.doc_id, bytes(r.tokens)) for r in out.collect()) == Counter((r.doc_id, bytes(r.tokens)) for r in stages[-1].collect())


def test_pipeline_takes_awkward_and_empty_documents(spark):
    out = run_stages(spark, awkward_documents(spark))
    assert out[3].columns == awkward_documents(spark).columns and np.all([r.round_trip for r in out[-1].collect()])
    assert run_stages(spark, no_documents(spark))[-1].collect() == []
