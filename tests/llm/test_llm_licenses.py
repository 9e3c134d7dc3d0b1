"""Licence scan (operator 11) against plain searches of the same templates."""

import os
import re
from collections import Counter

import numpy as np
import pytest
from helpers_llm import DOC_SCHEMA, awkward_documents, no_documents
from hypothesis import given, settings
from hypothesis import strategies as st

from panelscope.llm import licenses
from panelscope.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def places(ws, phrase):
    return [i for i in range(len(ws)) if ws[i:i + len(phrase)] == phrase]


def statistics(ws, sequences):
    """Length of the longest sequence ending at each word that a template has, by trying them all."""
    pieces = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    longest = max((len(s) for s in sequences), default=0)
    return [next((n for n in range(min(i + 1, longest), 0, -1) if tuple(ws[i + 1 - n:i + 1]) in pieces), 0) for i in range(len(ws))]


def brute(docs, rules=licenses.Rules()):
    """The report, with chains by trying all predecessors of every match in every template."""
    templates = [words(t) for _, t in rules.templates]
    phrases = [words(p) for p in rules.phrases]
    out = Counter()
    for id_, text in docs:
        ws = words(text)
        base = [(i, label) for (p, label) in zip(phrases, rules.phrases.values()) for i in places(ws, p)]
        stat = statistics(ws, templates + phrases)
        found = []
        for t, template in enumerate(templates):
            ms = [(i + 1 - stat[i], k, stat[i]) for i in range(len(ws)) if stat[i] >= rules.min_match and (i + 1 == len(ws) or stat[i + 1] != stat[i] + 1)
                  for k in places(template, ws[i + 1 - stat[i]:i + 1])]
            best = []
            for s, a, n in ms:
                top = (n, None, s)
                for j, (s2, a2, n2) in enumerate(ms[:len(best)]):
                    if s2 + n2 < s + n and a2 + n2 < a + n and s - s2 - n2 <= rules.max_gap and a - a2 - n2 <= rules.max_gap:
                        total = best[j][0] + min(n, s + n - s2 - n2, a + n - a2 - n2)
                        if total > top[0]:
                            top = (total, j, best[j][2])
                best.append(top)
            before = {b[1] for b in best}
            found += [(-b[0], -b[0] / len(template), b[2], t, ms[k][0] + ms[k][2]) for k, b in enumerate(best) if k not in before]
        score = max((-f[1] for f in found), default=0.0)
        taken = []
        for f in sorted(f for f in found if -f[1] >= rules.min_coverage):
            if all(f[4] <= g[2] or g[4] <= f[2] for g in taken):
                taken.append(f)
        at = [i for i, _ in base]
        labels = {x for _, x in base}
        out[id_, len(ws), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)),
            ",".join(sorted(labels | {rules.templates[f[3]][0] for f in taken})), score] += 1
    return out


def rows(df):
    assert df.columns == COLUMNS
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_query_equals_plain_searches(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = rows(QUERIES["op11_license_scan"](spark, SF))
    assert got == brute(docs) and any("cc-by-nc" in r[6] for r in got)


def test_every_template_is_found_in_prose(spark):
    prose = "some prose of the work with a license and the software for any purpose "
    texts = [prose + t + " " + prose for _, t in licenses.TEMPLATES]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], DOC_SCHEMA)
    got = {r.doc_id: r for r in licenses.license_spans(docs).collect()}
    for k, (label, t) in enumerate(licenses.TEMPLATES):
        r = got[k]
        assert (r.label, r.first_word, r.end_word, r.coverage) == (label, len(words(prose)), len(words(prose)) + len(words(t)), 1.0), t
    assert rows(licenses.license_report(docs)) == brute(list(enumerate(texts)))


def test_filled_and_damaged_notices(spark):
    rng = np.random.default_rng(5)
    texts = []
    for label, t in licenses.TEMPLATES:
        ws = t.split()
        for k in sorted(rng.choice(len(ws), len(ws) // 20, replace=False))[::-1]:
            ws[k:k + 1] = [ws[k], "Example Ltd"] if k % 2 else ["changed"]
        texts.append("Words before. " + "\n".join(" ".join(ws[i:i + 9]) for i in range(0, len(ws), 9)) + "\nwords behind")
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], DOC_SCHEMA)
    got = rows(licenses.license_report(docs))
    assert got == brute(list(enumerate(texts)))
    long_ = {k for k, (_, t) in enumerate(licenses.TEMPLATES) if len(t.split()) > 40}
    assert all(licenses.TEMPLATES[r[0]][0] in r[6] for r in got if r[0] in long_)


@pytest.mark.parametrize("size", [1, 17, 200])
def test_blocks_change_nothing(monkeypatch, size):
    scanner = licenses.Scanner(licenses.Rules())
    texts = [t for _, t in licenses.TEMPLATES] + ["", None, " .. ", "mit license" * 3, "THE MIT LICENSE. MIT LICENSE, general public license é license"]
    texts.append(" and ".join(t for _, t in licenses.TEMPLATES))
    whole = [(f.n, sorted(f.phrases), {t: m for t, m in f.matches.items() if m}) for f in licenses.scan(scanner, texts)]
    monkeypatch.setattr(licenses, "BLOCK_BYTES", size)
    assert [(f.n, sorted(f.phrases), {t: m for t, m in f.matches.items() if m}) for f in licenses.scan(scanner, texts)] == whole


word = st.sampled_from(["a", "b", "c", "dd", "é", "x"])


@given(st.lists(st.lists(word, min_size=1, max_size=7), min_size=1, max_size=4), st.lists(word, max_size=30), st.integers(1, 9))
@settings(max_examples=150, deadline=None)
def test_matching_statistics(templates, text, block):
    rules = licenses.Rules(templates=tuple((str(k), " ".join(t)) for k, t in enumerate(templates)), phrases={"a b": "ab", "c": "c", "dd a b": "dab"}, min_match=2)
    scanner = licenses.Scanner(rules)
    sequences = templates + [words(p) for p in rules.phrases]
    raw = np.frombuffer(" ".join(text).encode(), np.uint8)
    edge = np.diff(licenses._WORD[raw].astype(np.int8), prepend=0, append=0)
    numbers = scanner.numbered(raw, np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)) if text else np.zeros(0, int)
    assert scanner.stream(numbers, np.zeros(1, int), (0, 0))[1].tolist() == statistics(text, sequences)
    (found,) = licenses.scan(scanner, [" ".join(text)])
    assert sorted(found.phrases) == sorted((i, k) for k, p in enumerate(rules.phrases) for i in places(text, words(p)))


def test_awkward_and_empty(spark):
    docs = awkward_documents(spark)
    plain = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert rows(licenses.license_report(docs)) == brute(plain)
    assert rows(licenses.license_report(no_documents(spark))) == Counter()
    many = spark.createDataFrame([(1, "released under the mit license " * 20000, "en", "s", 0)], DOC_SCHEMA)
    assert tuple(licenses.license_report(many).first()) == (1, 100000, 20000, 3, 99998, "mit", "mit", 1.0)
