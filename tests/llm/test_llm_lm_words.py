"""Words of the language model: how they are found, spelled and counted, and blocks of a batch."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from panelscope.llm import lm

TEXTS = ["a Tree\tfell  ON the\x0bhouse", "", " é\n\rtree ", "the", "x" * 50 + "\x0cthe a"]


def batch(n, seed=0):
    rnd = np.random.default_rng(seed)
    near = rnd.integers(0, lm.INPUTS + 1, (n, len(lm.OFFSETS))).astype(np.int32)
    return near, rnd.integers(0, lm.CLASSES, n).astype(np.int32), rnd.integers(0, lm.CLASSES, n).astype(np.int32)


def test_arrays_of_single_steps_have_the_rows_of_a_block():
    trainer = lm.Trainer(lm.fresh(), lm.no_squares())
    trainer.learn(*batch(lm.BATCH))
    assert trainer.room.held["exp"].size < lm.BATCH * lm.CLASSES // 2 and trainer.room.held["part"].size < lm.BATCH * lm.HIDDEN // 2


@pytest.mark.parametrize("rows", [64, 1000])
def test_blocks_leave_the_sums_as_they_are(monkeypatch, rows):
    words = batch(2500, 5)
    loss, grad = lm.loss_and_gradients(lm.fresh(), *words, lm.Room())
    chances = lm.log_probabilities(lm.fresh(), *words)
    monkeypatch.setattr(lm, "ROWS", rows)
    other, same = lm.loss_and_gradients(lm.fresh(), *words, lm.Room())
    assert other == pytest.approx(loss, rel=1e-6) and all(np.allclose(grad[k], same[k], rtol=1e-4, atol=1e-8) for k in grad)
    assert np.allclose(lm.log_probabilities(lm.fresh(), *words), chances, rtol=1e-6)


@pytest.mark.parametrize("n", [0, 1, 5, 3000])
def test_places_of_hashes(n):
    rnd = np.random.default_rng(n)
    top = ~np.uint64(0)
    keys = np.unique(np.concatenate([rnd.integers(0, 1 << 64, n, np.uint64), rnd.integers(0, 1 << 20, n, np.uint64)]))  # many with equal upper bits
    words = np.concatenate([keys, keys + np.uint64(1), rnd.integers(0, 1 << 64, 500, np.uint64), np.array([0, top], np.uint64)])
    for known in (keys, np.append(keys, top)):
        place, found = lm.Places(known).find(words)
        assert found.tolist() == np.isin(words, known).tolist()
        assert np.array_equal(known[place[found]], words[found]) and place.max() <= len(known)


def test_chosen_words_are_spelled_alone():
    raw, offsets = lm.text_bytes(pa.array(TEXTS))
    words = [w.encode().lower() for t in TEXTS for w in t.split()]
    spelling = np.random.default_rng(2).integers(1, 1000, lm.BYTES * lm.BYTES)
    want = [sum(spelling[a * lm.BYTES + b] for a, b in zip([lm.EDGE, *w], [*w, lm.EDGE])) for w in words]
    for chosen in (np.arange(len(words)), np.array([1, 2, 5]), np.array([len(words) - 1]), np.array([], np.int64)):
        assert lm.spelling_costs(spelling, raw, offsets, chosen).tolist() == [want[i] for i in chosen]


def test_pairs_of_bytes_are_counted_inside_words(spark):
    pairs = Counter(p for t in TEXTS for w in t.split() for p in zip([lm.EDGE, *w.lower().encode()], [*w.lower().encode(), lm.EDGE]))
    counts = np.ones((lm.BYTES, lm.BYTES))
    for p, n in pairs.items():
        counts[p] += n
    want = np.ceil(-np.log(counts / counts.sum(axis=1, keepdims=True)) * lm.UNIT).astype(np.int64).ravel()
    known = lm.count_words(spark.createDataFrame([(t,) for t in [*TEXTS, None]], "text string"))
    assert np.array_equal(known.spelling, want)


def test_words_pack_and_unpack():
    codes = np.random.default_rng(1).integers(0, lm.INPUTS * lm.CLASSES**2, 100).astype(np.int32)
    assert np.array_equal(lm.unpacked(np.ascontiguousarray(lm.packed(codes)).ravel()), codes)
