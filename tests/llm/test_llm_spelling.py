"""Spelling variants (operator 13) against edits tried one by one."""

import os
import re
import zlib
from collections import Counter

import pytest
from helpers_llm import DOC_SCHEMA, awkward_documents, no_documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelscope.llm import spelling
from panelscope.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))


def brute_words(docs, drop, min_letters, min_count):
    count = Counter()
    for id_, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if id_ is None else id_}:{run}".encode())
            if drop and h % drop == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= min_letters and n >= min_count}


def brute(words, factor=5, letters=LETTERS):
    form, near = {}, {}
    for w in words:
        edits = {w[:i] + w[i + 1:] for i in range(len(w))}
        edits |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters} | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        found = sorted((edits - {w}) & words.keys(), key=lambda x: (-words[x], x))
        near[w] = len(found)
        form[w] = found[0] if found and words[found[0]] >= factor * words[w] else None
    out = Counter()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w, form[w], root, n, near[w], words[form[w]] if form[w] else None] += 1
    return out


def rows(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_query_equals_edits(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert rows(QUERIES["op13_spelling_variants"](spark, SF)) == brute(brute_words(docs, 199, 6, 5))


def test_chains_ties_and_runs_of_a_letter(spark):
    counts = {"aaaaaa": 3, "aaaaaaa": 20, "aaaaaaaa": 120, "abaaaa": 20, "letter": 7, "leter": 1, "lettre": 40, "lettér": 40, "better": 35, "bettor": 200}
    text = " ".join(w for w, n in counts.items() for _ in range(n))
    docs = spark.createDataFrame([(1, text, "en", "s", 0)], DOC_SCHEMA)
    got = rows(spelling.group_variants(docs, min_letters=1, min_count=1))
    assert got == brute(counts)
    assert ("aaaaaa", "aaaaaaa", "aaaaaaaa", 3, 2, 20) in got


@given(st.lists(st.text("abé", min_size=1, max_size=7), min_size=1, max_size=60, unique=True), st.integers(1, 9))
@settings(max_examples=6, deadline=None)
def test_nodes_are_the_prefixes_in_any_ranges(words, parts):
    spark = test_nodes_are_the_prefixes_in_any_ranges.spark
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = spelling.number_nodes(spark.createDataFrame([(w,) for w in words], "word string"), "word", "nodes").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    of = {}
    for r in got:
        assert len(r.nodes) == len(r.word) + 1
        for d, node in enumerate(r.nodes):
            assert of.setdefault(node, r.word[:d]) == r.word[:d]
    assert len(of) == len(set(of.values())) and sorted(r.word for r in got) == sorted(words)


@pytest.fixture(autouse=True)
def _session(spark):
    test_nodes_are_the_prefixes_in_any_ranges.spark = spark


def test_awkward_and_empty(spark):
    docs = awkward_documents(spark)
    plain = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    words = brute_words(plain, 3, 3, 2)
    long_ = max(words, key=len, default="")
    got = rows(spelling.group_variants(docs, min_letters=3, min_count=2, drop=3))
    assert got == brute(words) and len(long_) < 100
    assert rows(spelling.group_variants(docs, min_letters=3, min_count=1)) == brute({w: n for w, n in brute_words(plain, 0, 3, 1).items() if len(w) < 1000}) + Counter(
        {(w, None, w, n, 0, None): 1 for w, n in brute_words(plain, 0, 3, 1).items() if len(w) >= 1000})
    assert rows(spelling.group_variants(no_documents(spark))) == Counter()


def test_factor_must_grow(spark):
    with pytest.raises(ValueError):
        spelling.group_variants(no_documents(spark).select(F.col("doc_id"), F.col("text")), factor=1)
