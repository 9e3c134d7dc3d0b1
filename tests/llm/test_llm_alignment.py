"""Alignment of two tokenizers (operator 12) against a plain version on whole texts."""

import hashlib
import os
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from helpers_llm import DOC_SCHEMA, awkward_documents, no_documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelscope.llm import alignment
from panelscope.llm.bpe import byte_characters
from panelscope.llm.queries import BPE_FILE, PIECE_FILE, QUERIES, TOKENIZER_DIR

SF = "/root/testdata/sf0.001"
A, B = os.path.join(TOKENIZER_DIR, BPE_FILE), os.path.join(TOKENIZER_DIR, PIECE_FILE)


class Plain:
    """Whole texts, without cuts into stretches."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        chars = byte_characters()
        self.spell_a = {i: bytes(chars[c] for c in x) for x, i in self.a.get_vocab().items() if all(c in chars for c in x)}

    def spell_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        x, y = [self.spell_a[i] for i in a], [self.spell_b(i) for i in b]
        whole = (" " + text).encode()
        if b"".join(x) != whole or b"".join(y) != whole:
            return []
        ends_a, ends_b = np.cumsum([len(t) for t in x]), np.cumsum([len(t) for t in y])
        out, i, j = [], 0, 0
        for end in sorted(set(ends_a.tolist()) & set(ends_b.tolist())):
            p, q = int(np.searchsorted(ends_a, end)) + 1, int(np.searchsorted(ends_b, end)) + 1
            out.append((a[i:p], b[j:q]))
            i, j = p, q
        return out

    def report(self, docs):
        found = [(d, self.groups(t)) for d, t in docs]
        links = [[(g[0][-1], g[1][-1]) for g in gs] for _, gs in found]
        count = Counter(x for ls in links for x in ls)
        top = Counter()
        for (a, b), n in count.items():
            top[b] = max(top[b], n)
        out = Counter()
        for (d, gs), ls in zip(found, links):
            text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs)
            out[d, sum(len(g[0]) for g in gs), sum(len(g[1]) for g in gs), len(gs), len(ls), sum(count[x] == top[x[1]] for x in ls),
                sum(count[x] for x in ls), hashlib.sha256(text.encode()).hexdigest() if gs else ""] += 1
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def rows(df):
    assert df.columns == COLUMNS
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_query_equals_whole_texts(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert rows(QUERIES["op12_alignment"](spark, SF)) == plain.report([tuple(r) for r in docs])


@pytest.mark.parametrize("size", [1, 7, 100])
def test_long_texts_are_composed_of_ranges(spark, plain, size):
    texts = ["One two  three.\nFour 五六 🙂 five\n\n six" * 3, "x" * 300, "a b", " lead", "trail ", "Élan vital ça va"]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], DOC_SCHEMA)
    assert rows(alignment.link_report(docs, A, B, size=size)) == plain.report(list(enumerate(texts)))


def test_ranges_of_long_prose(spark, plain):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if r.text and len(r.text) > 3000][:12]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], DOC_SCHEMA)
    assert rows(alignment.link_report(docs, A, B, size=500)) == plain.report(list(enumerate(texts)))


def test_awkward_and_empty(spark, plain):
    docs = awkward_documents(spark)
    assert rows(alignment.link_report(docs, A, B)) == plain.report([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert rows(alignment.link_report(no_documents(spark), A, B)) == Counter()
    assert alignment.align(no_documents(spark), A, B).collect() == []


def test_special_strings_and_underlines(spark, plain):
    texts = ["<s> a </s> <|endoftext|> <0x41> x", "low ▁ line", "a b c　 d e", "tab\there  two\n\nlines \x1c x\x85y", "\x00 zero", "don't we'll I'm  's"]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], DOC_SCHEMA)
    want = plain.report(list(enumerate(texts)))
    assert rows(alignment.link_report(docs, A, B)) == want
    assert next(r for r in want if r[0] == 1)[1:4] == (0, 0, 0)


def test_groups_are_returned_whole(spark, plain):
    text = "Thntblere of then, edtioner."
    docs = spark.createDataFrame([(1, text, "en", "s", 0)], DOC_SCHEMA)
    want = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in plain.groups(text))
    assert alignment.align(docs, A, B).first().groups == want == alignment.align(docs, A, B, size=3).first().groups


ids = st.lists(st.binary(min_size=1, max_size=2), max_size=3).map(b",".join)
open_ = st.tuples(st.just(0), ids, ids, st.just(b""), st.just(b""), st.just(b""))
cut = st.tuples(st.integers(1, 3), ids, ids, st.sampled_from([b"", b"1|2", b"1|2;3|4"]), ids, ids)


@given(*[st.one_of(open_, cut)] * 3)
@settings(max_examples=200, deadline=None)
def test_compose_is_associative_with_a_one(f, g, h):
    c = alignment.compose
    assert c(c(f, g), h) == c(f, c(g, h))
    assert c(f, alignment.EMPTY) == f == c(alignment.EMPTY, f)


@given(st.text(alphabet="ab \né一.'", max_size=40))
@settings(max_examples=60, deadline=None)
def test_any_text_equals_the_whole(text):
    p, q = _PAIR.setdefault("p", Plain()), _PAIR.setdefault("q", None)
    if q is None:
        with open(A, "rb") as f, open(B, "rb") as g:
            q = _PAIR["q"] = alignment.Pair(f.read(), g.read())
    (n_a, n_b, n, groups, _), = q.align([text])
    want = p.groups(text)
    assert groups.decode() == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in want) and n == len(want)


_PAIR = {}


def test_stretches_are_encoded_in_few_texts():
    """Many stretches take few calls' worth of texts, and a stretch that is not spelled takes none of its neighbours along."""
    with open(A, "rb") as f, open(B, "rb") as g:
        q = alignment.Pair(f.read(), g.read())
    seen, words = [], [f"word{i}x" for i in range(3000)] + ["Élan", "五六", "🙂", "don't", "<|endoftext|>", "tab\there"]

    class Counted:
        def encode_batch_fast(self, texts, add_special_tokens):
            seen.extend(texts)
            return whole.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    whole, q.a = q.a, Counted()
    found = q.entries(words)
    assert len(seen) < 20
    apart = [q.entries([w])[0] for w in words]
    assert found == apart and all(found)
    mixed = ["one", "low▁line", " lead", "", "two", "trail ", "　wide", "three"]
    assert q.entries(mixed) == [q.entries([w])[0] for w in mixed] and [bool(x) for x in q.entries(mixed)] == [True, False, *[bool(q.entries([w])[0]) for w in mixed[2:]]]
