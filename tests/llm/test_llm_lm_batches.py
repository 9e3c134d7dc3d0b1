"""Batches of the language model's trainer: their memory is used again, and their sums are those of the plain formulas."""

import tracemalloc

import numpy as np
import pytest

from panelscope.llm import lm


def batch(n, seed=0):
    rnd = np.random.default_rng(seed)
    near = rnd.integers(0, lm.INPUTS + 1, (n, len(lm.OFFSETS))).astype(np.int32)
    return near, rnd.integers(0, lm.CLASSES, n).astype(np.int32), rnd.integers(0, lm.CLASSES, n).astype(np.int32)


def plain(net, near, high, low):
    at, one = np.arange(len(high)), np.eye(lm.CLASSES)
    total = net["bias"] + sum(net["embed"][k][near[:, k]] for k in range(len(lm.OFFSETS)))
    hidden, second = np.tanh(total), np.tanh(total + net["digit"][high])
    a, b = hidden @ net["high"] + net["high_bias"], second @ net["low"] + net["low_bias"]
    a, b = (np.exp(x) / np.exp(x).sum(axis=1, keepdims=True) for x in (a, b))
    loss = -np.log(a[at, high] * b[at, low]).sum()
    da, db = (a - one[high]) / len(high), (b - one[low]) / len(high)
    d_second = db @ net["low"].T * (1 - second**2)
    d_total = da @ net["high"].T * (1 - hidden**2) + d_second
    digit, embed = np.zeros_like(net["digit"]), np.zeros_like(net["embed"])
    np.add.at(digit, high, d_second)
    for k in range(len(lm.OFFSETS)):
        np.add.at(embed[k], near[:, k], d_total)
    return loss, {"bias": d_total.sum(0), "high": hidden.T @ da, "high_bias": da.sum(0), "low": second.T @ db, "low_bias": db.sum(0), "digit": digit, "embed": embed}


def test_later_batches_ask_for_little_memory():
    trainer = lm.Trainer(lm.fresh(), lm.no_squares())
    words = batch(lm.BATCH)
    trainer.learn(*words)
    tracemalloc.start()
    trainer.learn(*words)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * 4 * lm.BATCH * lm.HIDDEN, peak  # three layers; ten before


@pytest.mark.parametrize("n", [1, 37, 1000])
def test_sums_are_the_plain_ones_in_a_room_used_before(n):
    room, net = lm.Room(), {k: w.astype(np.float64) for k, w in lm.fresh().items()}
    lm.loss_and_gradients(net, *batch(500, 3), room)
    near, high, low = batch(n, n)
    loss, grad = lm.loss_and_gradients(net, near, high, low, room)
    want_loss, want = plain(net, near, high, low)
    assert loss == pytest.approx(want_loss) and grad.keys() == want.keys()
    assert all(np.allclose(grad[k], want[k], atol=1e-12) for k in want)
    assert lm.log_probabilities(net, near, high, low, room).sum() == pytest.approx(-want_loss)
