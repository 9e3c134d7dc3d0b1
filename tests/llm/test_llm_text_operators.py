"""Quality rules, near-dedup, PII, tokens, mixing, repeats and scores against brute force."""

import hashlib
import json
import os
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers_llm import awkward_documents, no_documents, prose
from pyspark.sql import functions as F

from panelscope.llm import bpe, lm, mixing, neardup, pii, quality, repeats
from panelscope.llm.components import components
from panelscope.llm.queries import BPE_FILE, TOKENIZER_DIR
from panelscope.llm.shingles import shingle_sets

BPE = os.path.join(TOKENIZER_DIR, BPE_FILE)
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, texts, sources=None):
    rows = [(i, t, "en", (sources or {}).get(i, "s"), len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


# ------------------------------------------------------------------ quality rules

def brute_base(text):
    words = SPACE.findall(text or "")
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i:i + 5])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [l for l in (text or "").split("\n") if SPACE.search(l)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_base_rules_match_brute_force(spark):
    rnd = random.Random(3)
    texts = [None, "", "a b c d e a b c d e", "a a a a a a a", "x\nx\n \nx #*$", "é 🙂 z"]
    texts += ["".join(rnd.choice(["a", "b", "c ", " ", "\n", "#", "a b c d e "]) for _ in range(rnd.randint(0, 80))) for _ in range(300)]
    got = {r.doc_id: r for r in quality.quality_report(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        want = brute_base(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])


def test_frequent_lines_are_removed_and_depleted_documents_rejected(spark):
    rnd = random.Random(1)
    words = [f"w{i}" for i in range(3000)]
    texts, sources = [], {}
    for i in range(120):
        own = prose(words, 40, rnd)
        texts.append(f"Share  THIS page with all of your many friends now\n{own}" if i % 2 else own)
        sources[i] = "hot"
    texts.append("share this page with all of your many friends now\nshare this page with all of your many friends now, ok then")
    sources[120] = "hot"
    texts.append("share this page with all of your many friends now\nbye")
    sources[121] = "hot"
    copy = prose(words, 30, rnd)
    texts += [copy] * 60  # copies of one text are one document: none of its lines is frequent
    sources |= {122 + k: "hot" for k in range(60)}
    texts.append("share this page with all of your many friends now\n" + prose(words, 5, rnd))
    sources[182] = "other"
    df = documents(spark, texts, sources)
    kept = {r.doc_id: r for r in quality.quality_report(df).collect()}
    assert all(kept[i].kept and (kept[i].n_removed_words > 0) == bool(i % 2) for i in range(120))
    assert not kept[121].kept and not kept[121].base_failed
    assert all(kept[122 + k].kept for k in range(60)) and kept[182].kept
    clean = {r.doc_id: r for r in quality.filter_documents(df).collect()}
    assert set(clean) == {i for i, r in kept.items() if r.kept}
    assert clean[1].text == texts[1].split("\n")[1] and clean[0].text == texts[0] and clean[1].n_chars == len(clean[1].text)
    assert clean[182].text == texts[182]


# ------------------------------------------------------------------ near-duplicates

def brute_components(texts, width, percent):
    def shingles(t):
        w = SPACE.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        return set() if not w else {tuple(w)} if len(w) < width else {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}
    sets = [shingles(t) for t in texts]
    top = list(range(len(texts)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x
    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return {(i, len(s), find(i), find(i) == i) for i, s in enumerate(sets)}


def family_texts(rnd):
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", " \n", "a b c", "A b c", "a b", "x"]
    for _ in range(12):
        base = prose(words, rnd.randint(20, 120), rnd).split()
        for _ in range(rnd.randint(1, 9)):
            own = list(base)
            for _ in range(rnd.randint(0, 4)):
                own[rnd.randrange(len(own))] = rnd.choice(words)
            texts.append(" ".join(own))
    passage = prose(words, 60, rnd)
    texts += [prose(words, 150, rnd) + " " + passage for _ in range(20)]
    return texts + texts[10:14]


@pytest.mark.parametrize("rounds", [1, 0])
def test_near_duplicates_match_brute_force(spark, monkeypatch, rounds):
    monkeypatch.setattr(neardup.link_components, "__defaults__", (rounds,))
    monkeypatch.setattr(neardup, "BLOCK_NODES", 3)  # many tiles
    texts = family_texts(random.Random(5))
    got = {tuple(r) for r in neardup.near_duplicates(documents(spark, texts), width=4).collect()}
    assert got == brute_components(texts, 4, 80)
    assert neardup.miss_probability() < 1e-6


def test_keep_one_keeps_one_of_each_group(spark):
    texts = family_texts(random.Random(6))
    want = {i for i, _, c, k in brute_components(texts, 5, 80) if k}
    assert {r.doc_id for r in neardup.keep_one(documents(spark, texts)).collect()} == want


def test_components_of_random_graphs(spark):
    rnd = random.Random(4)
    edges = [(rnd.randrange(120), rnd.randrange(120)) for _ in range(100)] + [(200 + i, 201 + i) for i in range(40)]
    top = {}

    def find(x):
        top.setdefault(x, x)
        while top[x] != x:
            x = top[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    want = {(x, find(x)) for e in edges for x in e if e[0] != e[1]}
    got = {tuple(r) for r in components(spark.createDataFrame([*edges, (None, 1), (5, None)], "u long, v long")).collect()}
    assert got == want | {(x, find(x)) for x in {find(a) for a, b in edges if a != b}}


def test_intersections_are_exact():
    rnd = np.random.default_rng(0)
    sets = [np.unique(rnd.integers(0, 60, rnd.integers(0, 40)).astype(np.uint64)) for _ in range(30)]
    got = neardup.intersections(sets[:18], sets[18:])
    assert all(got[i, j] == len(np.intersect1d(sets[i], sets[18 + j])) for i in range(18) for j in range(12))


def test_shingle_sets_follow_the_words():
    import pyarrow as pa
    texts = ["A b\tc\x0bd e", "a b c d e", "a  b c\nd  e", "a b c d f", None, "", "b c d e"]
    sets = {i: frozenset(s.tolist()) for i, s in shingle_sets(pa.array(texts), 4)}
    assert sets[0] == sets[1] == sets[2] != sets[3] and not sets[4] and not sets[5]
    assert len(sets[1]) == 2 and len(sets[1] & sets[3]) == 1 and sets[6] < sets[1]


# ------------------------------------------------------------------ PII

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute_spans(text):
    def fine(kind, m):
        digits = re.sub("[^0-9]", "", m)
        return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15}[kind]
    return sorted((m.start(), k, m.end()) for k, kind in enumerate(pii.KINDS) for m in re.finditer(PLAIN[kind], text or "") if fine(kind, m[0]))


def pii_texts():
    rnd = random.Random(5)
    parts = ["1", "2", "45", "255", "256", "0", ".", " ", "-", "+", "(", ")", "@", "a", "b.c", "_", "%", "é", "🙂", "com", "\n", "4111111111111111",
             "4111 1111 1111 1111", "a@b.co", "+1 (743) 555-3824", "1.2.3.4", " (743) 555-3824 ", "(at)"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(800)]
    return texts + [None, "", "9" * 200000, "a" * 200000 + "@", "1 " * 50000, "+1" * 3000, "call 743-555-3824 now or mail joe (at) site (dot) com"]


def test_base_spans_match_brute_force_and_stay(spark):
    texts = pii_texts()
    got = {r.doc_id: r for r in pii.pii_report(documents(spark, texts)).collect()}
    for i, t in enumerate(texts):
        want = brute_spans(t)
        written = [f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in want]
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(1 for _, x, _ in want if x == k) for k in range(4)]
        assert got[i].base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        assert set(written) <= set(got[i].spans.split(","))
    assert got[len(texts) - 1].spans == "phone:5:17,email:30:53"


def test_expectation_maximisation_finds_reliable_labelers(spark):
    rnd = random.Random(9)
    right = [0.95, 0.9, 0.6, 0.8]
    rows = []
    for _ in range(4000):
        truth = rnd.random() < 0.6
        rows.append((0, [(1 if (rnd.random() < p) == truth else -1) for p in right], [f"f:{truth and rnd.random() < 0.9}"], truth))
    df = spark.createDataFrame(rows, "rank int, votes array<int>, features array<string>, truth boolean")
    m = pii.labeler_model(df).first()
    assert m.prior == pytest.approx(0.6, abs=0.05)
    assert all(abs(p - w) < 0.06 and abs(q - (1 - w)) < 0.06 for p, q, w in zip(m.p, m.q, right))
    weights = pii.fit(df)
    assert weights["0 f:True"] > 1 and weights["0 f:False"] < -1
    held = [(r.rank, r.votes, r.features, r.truth) for r in df.limit(0).collect()] or rows[:500]
    scored = [(weights["0 "] + sum(weights[f"0 {f}"] for f in fs) > 0) == truth for _, _, fs, truth in held]
    assert sum(scored) / len(scored) > 0.9


def test_masking_replaces_spans(spark):
    texts = ["mail a@b.co, a@b.co and 4111111111111111!", "no data", None, "+14111111111111 x", "🙂é 1.2.3.4 🙂"]
    got = {r.doc_id: r for r in pii.mask_documents(documents(spark, texts)).collect()}
    assert got[0].text == "mail <EMAIL>, <EMAIL> and <CARD>!" and got[0].n_chars == len(got[0].text)
    assert got[1].text == "no data" and got[2].text is None and got[4].text == "🙂é <IP> 🙂"
    assert "4111" not in got[3].text


def test_native_operators_run_no_python(spark):
    docs = documents(spark, ["a b c", "x y"])
    for df in (quality.quality_report(docs), quality.filter_documents(docs), pii.pii_report(docs), pii.mask_documents(docs), mixing.mix_report(docs),
               mixing.mix_documents(docs)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())


# ------------------------------------------------------------------ BPE

def test_encoding_matches_the_library():
    from tokenizers import Tokenizer
    with open(BPE, encoding="utf-8") as f:
        ours = bpe.Tokenizer(json.load(f))
    theirs = Tokenizer.from_file(BPE)
    rnd = random.Random(1)
    parts = ["a", "aa", "e", " ", "  ", "\n", "the", "in", "ing", "s", "'s", "1", "00", "é", "ß", "́", "中", "🙂", "\x1c", "\x85", "​", "!", "...",
             "=", "<|endoftext|>", "\t", "ER", "\xa0", "\x00"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(4000)] + [c * n for c in "ae= -\n" for n in (1, 2, 3, 63, 65, 2000)]
    texts += ["a" + chr(c) + "b " + chr(c) for c in [*range(1, 0x3100), *range(0xFE00, 0x10000, 7), *range(0x1F300, 0x1F700, 3)]]
    for t in texts:
        ids = theirs.encode(t, add_special_tokens=False).ids
        packed = ours.encode(t)
        assert np.frombuffer(packed, "<u4").tolist() == ids, t
        assert ours.decode(packed) == theirs.decode(ids, skip_special_tokens=False)


def test_automaton_accepts_just_what_merging_makes():
    rnd = random.Random(2)
    for _ in range(60):
        tokens = {0: b"a", 1: b"b", 2: b"c"}
        merges, made = [], {b"a": 0, b"b": 1, b"c": 2}
        for _ in range(rnd.randint(1, 9)):
            x, y = rnd.choice(sorted(made)), rnd.choice(sorted(made))
            if x + y not in made:
                made[x + y] = len(tokens)
                merges.append((made[x], made[y], len(tokens)))
                tokens[len(tokens)] = x + y
        automaton = bpe.Automaton(tokens, merges)
        rank = {(a, b): i for i, (a, b, _) in enumerate(merges)}
        for _ in range(60):
            word = bytes(rnd.choice(b"abc") for _ in range(rnd.randint(0, 12)))
            ids = [made[bytes([x])] for x in word]
            while True:
                pairs = [(rank.get(p, 99), i) for i, p in enumerate(zip(ids, ids[1:]))]
                if not pairs or min(pairs)[0] == 99:
                    break
                _, i = min(pairs)
                ids[i:i + 2] = [made[tokens[ids[i]] + tokens[ids[i + 1]]]]
            assert automaton.encode(word) == ids, (merges, word)


def test_kept_words_age_without_changing_tokens(monkeypatch):
    rnd = random.Random(3)
    words = [" " + "".join(rnd.choice("aeinst") for _ in range(rnd.randint(1, 12))) for _ in range(300)]
    text = "".join(rnd.choice(words[:20] if rnd.random() < 0.7 else words) for _ in range(3000))
    with open(BPE, encoding="utf-8") as f:
        spec = json.load(f)
    plain = bpe.Tokenizer(spec)
    expected = plain.encode(text)
    assert not plain.words.old
    monkeypatch.setattr(bpe, "MAX_KEPT_BYTES", 40 * (bpe.ENTRY_BYTES + 40))
    aging = bpe.Tokenizer(spec)
    assert aging.encode(text) == expected
    assert aging.words.old and len(aging.words) + len(aging.words.old) <= 60 < len(plain.words)


def test_spark_round_trip(spark):
    docs = awkward_documents(spark)
    texts = [r.text for r in docs.select("text").collect()]
    tokens = bpe.encode(docs, BPE)
    assert tokens.count() == len(texts)
    assert Counter(r.text for r in bpe.decode(tokens, BPE).collect()) == Counter(t or "" for t in texts)
    assert all(r.round_trip for r in bpe.encode_documents(docs, BPE).collect())


# ------------------------------------------------------------------ mixing

def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(capped.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > cap * sizes[s]]
        if not above:
            return capped | share
        capped |= {s: cap * sizes[s] for s in above}


def test_mix_meets_targets(spark):
    rnd = random.Random(8)
    rows = []
    for i in range(2500):
        s = rnd.choice(["hot"] * 10 + ["b", "é", "Z", "tiny", None])
        if s == "tiny" and rnd.random() < 0.9:
            s = "hot"
        rows.append((i, " ".join(["w"] * rnd.choice([0, 1, 5, 30, 200])), "en", s, 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = [r.asDict() for r in mixing.mix_report(df, bucket_rows=100).collect()]
    assert sorted(map(str, out)) == sorted(str(r.asDict()) for r in mixing.mix_report(df.repartition(7), bucket_rows=100).collect())
    source = {r[0]: r[3] for r in rows}
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(r[1].split())
    want = brute_targets(sizes)
    taken = Counter()
    for r in out:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s]) and r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    assert all(abs(taken[s] - want[s]) <= max(0.01 * want[s], 200) for s in sizes)
    mixed = Counter(r.doc_id for r in mixing.mix_documents(df, bucket_rows=100).collect())
    assert all(mixed[r["doc_id"]] * r["size"] == r["taken"] for r in out if r["size"])


def test_hot_equal_rows_are_split(spark):
    df = spark.createDataFrame([(None, "a b", "en", "s", 1)] * 300 + [(i, "a b c d", "en", "t", 1) for i in range(200)], "doc_id long, text string, lang string, source string, n_chars long")
    out = mixing.mix_report(df).collect()
    assert len(out) == 500
    assert sum(r.taken for r in out if r.doc_id is None) == pytest.approx(next(r.target for r in out if r.doc_id is None), abs=2)


# ------------------------------------------------------------------ repeats

def brute_repeats(texts):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + 200] for b in data for i in range(len(b) - 199))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), sum(gone), sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1])), hashlib.sha256(kept).hexdigest(), kept))
    return out


def repeat_texts():
    rnd = random.Random(2)
    words = ["alpha", "be", "ga é", "🙂", "the ", " ", "x"]
    make = lambda n: "".join(rnd.choice(words) for _ in range(n))
    blocks = [make(80) for _ in range(6)]
    texts = ["".join(rnd.choice(blocks)[rnd.randint(0, 60):][:rnd.randint(100, 400)] if rnd.random() < 0.5 else make(rnd.randint(0, 60))
                     for _ in range(rnd.randint(0, 6))) for _ in range(200)]
    return texts + [None, "", "a" * 3000, "ab" * 300, blocks[0] * 3, "short", "short", texts[5], "q" * 199, "q" * 199]


@pytest.mark.parametrize("hot,part,slice_bytes", [(20_000, None, None), (3, None, None), (20_000, 700, 500)])
def test_repeats_match_brute_force(spark, hot, part, slice_bytes):
    texts = repeat_texts()
    want = brute_repeats(texts)
    if part is None:
        rows = repeats.repeats_report(documents(spark, texts), hot=hot).collect()
        assert {r.doc_id: tuple(r)[1:] for r in rows} == {i: w[:4] for i, w in enumerate(want)}
        if hot == 3:
            kept = repeats.remove_repeats(documents(spark, texts), hot=hot).collect()
            assert {r.doc_id: bytes(r.kept) for r in kept} == {i: w[4] for i, w in enumerate(want)}
        return
    # Long texts in parts: the anchors of the parts, cut contexts left out, are those of the whole.
    rnd = random.Random(1)
    raw = np.frombuffer(bytes(rnd.choice(b"abc") for _ in range(9000)), np.uint8)
    whole = set(zip(*(x.tolist() for x in repeats.anchors(raw, np.array([0, len(raw)]))[1:4])))
    parts = set()
    for s in range(0, len(raw) - 400, part):
        lo = max(0, s - 400)
        cut = raw[lo:s + part + 400]
        _, pos, gram, context, before, after = repeats.anchors(cut, np.array([0, len(cut)]))
        fits = (before == np.minimum(pos + lo, repeats.BEFORE)) & (after == np.minimum(len(raw) - pos - lo, repeats.LENGTH))
        parts |= set(zip((pos + lo)[fits].tolist(), gram[fits].tolist(), context[fits].tolist()))
    assert parts == whole


def test_hash_compared_merge_sort_sorts():
    rnd = np.random.default_rng(3)
    for n, alphabet in ((1, 2), (2, 2), (77, 2), (500, 3)):
        m = rnd.integers(1, 1 + alphabet, (n, 12)).astype(np.uint16)
        order, common = repeats.sorted_extensions(m)
        rows = [tuple(m[i]) for i in order]
        assert rows == sorted(map(tuple, m.tolist()))
        for k in range(1, n):
            l = next((i for i, (x, y) in enumerate(zip(rows[k - 1], rows[k])) if x != y), 12)
            assert common[k] == l


def test_colliding_hashes_fall_back_to_bytes(monkeypatch):
    m = np.random.default_rng(4).integers(1, 4, (60, 10)).astype(np.uint16)
    monkeypatch.setattr(repeats, "prefix_hashes", lambda x: np.zeros((len(x), x.shape[1] + 1), np.uint64))
    order, common = repeats.sorted_extensions(m)
    assert [tuple(m[i]) for i in order] == sorted(map(tuple, m.tolist())) and common.max() < 10


# ------------------------------------------------------------------ language model

def test_gradients_match_differences():
    rnd = np.random.default_rng(1)
    net = {n: w.astype(np.float64) + rnd.normal(0, 0.2, w.shape) for n, w in lm.fresh().items()}
    near = rnd.integers(0, 6, (40, len(lm.OFFSETS))).astype(np.int32)
    high, low = rnd.integers(0, lm.CLASSES, 40), rnd.integers(0, lm.CLASSES, 40)
    grad = lm.gradients(net, near, high, low)
    for name in net:
        at = (1, int(near[0, 1]), 3) if name == "embed" else (int(high[0]), 2) if name == "digit" else tuple(0 for _ in net[name].shape)
        old = net[name][at]
        ends = []
        for d in (1e-5, -1e-5):
            net[name][at] = old + d
            ends.append(-lm.log_probabilities(net, near, high, low).mean())
        net[name][at] = old
        assert grad[name][at] == pytest.approx((ends[0] - ends[1]) / 2e-5, abs=1e-7)


def test_predictions_are_a_distribution():
    net = lm.fresh()
    near = np.array([[1, 2, 3, 4]] * lm.CLASSES**2, np.int32)
    codes = np.arange(lm.CLASSES**2)
    assert np.exp(lm.log_probabilities(net, near, codes // lm.CLASSES, codes % lm.CLASSES)).sum() == pytest.approx(1, abs=1e-4)


def test_scores_prefer_ordered_text_on_held_out_documents(spark):
    rnd = random.Random(4)
    chain = {f"w{i}": [f"w{(7 * i + k) % 40}" for k in range(3)] for i in range(40)}

    def text():
        w, out = "w0", []
        for _ in range(120):
            out.append(w)
            w = rnd.choice(chain[w])
        return out
    train = documents(spark, [" ".join(text()) for _ in range(300)])
    net = lm.train(train.repartition(4))
    held = [text() for _ in range(40)]
    mixed = [rnd.sample(t, len(t)) for t in held]
    rows = lm.score(documents(spark, [" ".join(t) for t in held + mixed] + ["", None]), net).collect()
    mean = {r.doc_id: r.mean_log_probability for r in rows}
    assert sum(mean[i] > mean[40 + i] for i in range(40)) >= 38
    assert np.mean([mean[i] for i in range(40)]) > -np.log(lm.CLASSES**2) + 0.4
    by = {r.doc_id: r for r in rows}
    assert by[80].n_tokens == 0 and by[80].log_probability == 0 and by[80].mean_log_probability is None and by[81].n_tokens == 0
    assert by[3].log_probability == pytest.approx(by[3].mean_log_probability * by[3].n_tokens) and by[3].n_tokens == 120


def one_word(spark, model, words):
    rows = lm.score(documents(spark, words), model).collect()
    return {words[r.doc_id]: r.log_probability for r in rows}


def test_words_have_their_own_probabilities(spark, monkeypatch):
    monkeypatch.setattr(lm, "HOT", 50)
    words = [f"w{i}" for i in range(2000)]
    counts = Counter({w: 2 + i % 9 for i, w in enumerate(words)})
    counts["once"], counts["the"] = 1, 3000
    tokens = [w for w, c in counts.items() for _ in range(c)]
    random.Random(2).shuffle(tokens)
    docs = documents(spark, [" ".join(tokens[i:i + 50]) for i in range(0, len(tokens), 50)])
    model = lm.Model(lm.fresh(), lm.count_words(docs.repartition(3)))
    assert len(model.words.hot) == 1 and model.words.table.count() == 2000
    hashes = {w: int(lm.word_hashes(*lm.text_bytes(lm.pa.array([w])))[0][0]) for w in [*counts, "zqxjk"]}
    kinds = {w: (h >> 20) % lm.CLASSES**2 for w, h in hashes.items()}
    sizes, once = Counter(), Counter()
    for w, c in counts.items():
        sizes[kinds[w]] += c
        once[kinds[w]] += c == 1
    got = one_word(spark, model, [*counts, "zqxjk", "zqxjq"])
    near = np.full((1, len(lm.OFFSETS)), lm.INPUTS, np.int32)
    for w in words[:300] + ["the"]:
        k = kinds[w]
        of_class = float(lm.log_probabilities(model.net, near, np.array([k // lm.CLASSES]), np.array([k % lm.CLASSES]))[0])
        assert got[w] == pytest.approx(of_class + np.log(counts[w] / (sizes[k] + 1)), abs=1e-5), w
    same = next((a, b) for a in words for b in words if a != b and kinds[a] == kinds[b] and counts[a] > counts[b])
    assert got[same[0]] > got[same[1]] and got["zqxjk"] < min(got[w] for w in words) and got["zqxjk"] != got["zqxjq"]
    assert sum(np.exp(x) for x in got.values()) < 1


def test_training_rests_on_all_texts_whatever_the_splits(spark, monkeypatch):
    monkeypatch.setattr(lm, "PART_WORDS", 4000)
    losses = []
    one = lm._round
    monkeypatch.setattr(lm, "_round", lambda *a: (out := one(*a), losses.append(out[2]))[0])
    rnd = random.Random(6)
    texts = [" ".join(f"w{(3 * i + k) % 30}" for k in range(rnd.randint(20, 60))) for i in range(300)]
    docs = documents(spark, texts)
    net = lm.train(docs.repartition(12)).net
    rounds, fell = len(losses), losses[0] - losses[-1]
    other = lm.train(docs.orderBy(F.desc("doc_id")).coalesce(1)).net
    assert rounds > 2 and losses[:rounds] == losses[rounds:] and fell > 1
    assert all(np.array_equal(net[n], other[n]) for n in net)


# ------------------------------------------------------------------ awkward inputs

OPERATORS = {
    "quality": quality.quality_report, "filter": quality.filter_documents, "neardup": neardup.near_duplicates, "keep_one": neardup.keep_one,
    "pii": pii.pii_report, "mask": pii.mask_documents, "bpe": lambda d: bpe.encode_report(d, BPE), "mix": mixing.mix_report, "mixed": mixing.mix_documents,
    "repeats": repeats.repeats_report, "lm": lambda d: lm.score(d, lm.train(d)),
}
SUBSET = {"filter", "keep_one", "mixed"}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_awkward_documents(spark, name):
    docs = awkward_documents(spark)
    out = OPERATORS[name](docs)
    rows = out.collect()
    if name in SUBSET or name == "mask":
        assert out.columns == docs.columns
        assert all(r["key"] == "extra key" and r["_row"] == "extra _row" for r in rows)
    if name not in SUBSET:
        assert len(rows) == docs.count()
        assert Counter(r["doc_id"] for r in rows) == Counter(r.doc_id for r in docs.select("doc_id").collect())
    if name == "keep_one":
        assert Counter(r["doc_id"] for r in rows) == Counter([1, 2, None, 3, 4, 5, 6, 7, None, 8])


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_no_documents(spark, name):
    assert OPERATORS[name](no_documents(spark)).collect() == []


def test_all_null_rows(spark):
    docs = spark.createDataFrame([(None, None, None, None, None)] * 3, "doc_id long, text string, lang string, source string, n_chars long")
    for name, f in OPERATORS.items():
        assert len(f(docs).collect()) == (0 if name == "filter" else 3), name
    assert docs.agg(F.count("doc_id")).first()[0] == 0
