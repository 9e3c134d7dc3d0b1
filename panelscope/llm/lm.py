"""Masked pseudo-likelihood of documents under a bidirectional window network (operator 9).

Every word is predicted from the words on both sides of it, itself masked, in two steps. The first is its class: words are
hashed to ``CLASSES`` squared classes, and embeddings of the ``len(OFFSETS)`` neighbours, one table per offset, are added and
squashed to a hidden vector; the high digit of the class is predicted from it, the low digit from it and the high digit, so
classes have a proper distribution at the cost of two small softmaxes.

The second is the word within its class, by the counts of all words of the corpus: a word that stands there twice or more has its
share of its class. What words that stand there once hold, and one more, is the share of all other words of the class, which are
spelled by byte pairs counted over the corpus. A spelling is not told to keep out of the vocabulary or of other classes, so the
probabilities of all words sum up to less than one, never to more. Costs are whole numbers of 1 / ``UNIT`` nats, so their sums are exact.

The sum of the log-probabilities of its words scores a document. The vocabulary grows with the corpus and stays a table, joined to
the documents' words; only words above a share of 1 / ``HOT`` of the corpus, no more than ``HOT`` of them, are broadcast.

Training goes over all documents, in parts of about ``PART_WORDS`` words. A text's part and its place there follow from a hash of text
and id, so neither files nor splits of the input have a say. In a round every part trains a copy of the network of the last round on
its own texts (Adagrad, numpy), and the copies and their sums of squares are averaged, weighted by words. Rounds go on until one
lowers the mean loss over all words, taken before each step of the first pass, by less than ``FALL`` nats. A part with few words
goes over them again within a round, up to ``STEPS`` steps. The sums are formed in two stages, by
block of parameters and group of parts, so no task gathers all copies. What comes to the driver and is broadcast is one network and
its squares, whose size is fixed by the constants here.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscope.llm.shingles import BASE, U64, mix, slices, text_bytes, word_hashes, word_spans
from panelscope.llm.stash import stash
from panelscope.session import ensure_checkpoint_dir

OFFSETS = (-2, -1, 1, 2)
INPUTS = 4096  # rows of an embedding table; one more stands for places outside the text
CLASSES = 16
HIDDEN = 16
BATCH = 16384
ROWS = 4096  # rows of a batch that are worked together, so that they stay in the processor's cache
SPARE = 16  # columns that arrays of ROWS have more, as rows that lie a power of two apart would drive each other out of the cache
RATE = 0.1
BLOCK = 1024
TASK_GROUPS = 32
PART_WORDS = 1 << 23
FED_WORDS = 1 << 18  # texts are handed to the trainer together up to so many words
FALL = 0.02
STEPS = 64
HOT = 1_000_000
UNIT = 1 << 24
EDGE = 256  # stands before the first and after the last byte of a word
BYTES = EDGE + 1
SPACES = [*range(9, 14), 32]
HELD = 1 << 20  # counts that a task holds before it hands them on


def shapes() -> dict[str, tuple[int, ...]]:
    return {"embed": (len(OFFSETS), INPUTS + 1, HIDDEN), "bias": (HIDDEN,), "high": (HIDDEN, CLASSES), "high_bias": (CLASSES,),
            "digit": (CLASSES, HIDDEN), "low": (HIDDEN, CLASSES), "low_bias": (CLASSES,)}


def fresh() -> dict[str, np.ndarray]:
    r = np.random.default_rng(7)
    return {n: (r.normal(0, 0.1, s) if len(s) > 1 else np.zeros(s)).astype(np.float32) for n, s in shapes().items()}


def flat(net: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([net[n].ravel() for n in shapes()])


def unflat(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for n, s in shapes().items():
        size = int(np.prod(s))
        out[n] = values[at:at + size].reshape(s).astype(np.float32)
        at += size
    return out


def codes_of(words: np.ndarray) -> np.ndarray:
    """All that the network sees of words: the input row in the low bits, the class above."""
    return (words % U64(INPUTS)).astype(np.int32) + class_of(words).astype(np.int32) * np.int32(INPUTS)


def examples(codes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours (tokens, offsets) and the two digits of each word's class."""
    n = len(codes)
    ids, classes = codes % INPUTS, codes // INPUTS
    near = np.full((len(OFFSETS), n), INPUTS, np.int32)
    for k, off in enumerate(OFFSETS):
        lo, hi = max(0, -off), min(n, n - off)
        if lo < hi:
            np.copyto(near[k, lo:hi], ids[lo + off:hi + off], where=rows[lo + off:hi + off] == rows[lo:hi])
    return near.T, classes // CLASSES, classes % CLASSES


def packed(codes: np.ndarray) -> np.ndarray:
    """Three bytes for each word."""
    return codes.astype("<i4").view(np.uint8).reshape(-1, 4)[:, :3]


def unpacked(values: np.ndarray) -> np.ndarray:
    out = values[2::3].astype(np.int32)
    for k in (1, 0):
        out <<= 8
        out |= values[k::3]
    return out


class Room:
    """Arrays that batches use one after the other, so that their memory is not asked for anew each time."""

    def __init__(self):
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, shape: tuple[int, ...], dtype: np.dtype) -> np.ndarray:
        size = math.prod(shape)
        if name not in self.held or self.held[name].size < size or self.held[name].dtype != dtype:
            self.held[name] = np.empty(size, dtype)
        return self.held[name][:size].reshape(shape)


def _log_sums(x: np.ndarray, room: Room) -> np.ndarray:
    """Of the exponentials in each column of logits that are bounded (hidden values lie between -1 and 1), so no shift is needed.

    Rows are added in pairs, in numpy's own order for 16 values.
    """
    half = len(x) // 2
    each = np.exp(x, out=room("exp", x.shape, x.dtype))
    sums = each[:half] + each[half:]
    while len(sums) > 1:
        sums = sums[::2] + sums[1::2]
    return np.log(sums[0])


def _tokens(near: np.ndarray, room: Room) -> np.ndarray:
    """The neighbours by offset, as the integers that index and count without a cast."""
    out = room("tokens", near.shape[::-1], np.dtype(np.intp))
    out[:] = near.T
    return out


def _layers(n: int, dtype: np.dtype, room: Room) -> tuple[np.ndarray, ...]:
    """Arrays for both hidden layers of ``n`` words, a word a row, and the logits of both digits, a word a column (and columns to spare)."""
    return (*(room(x, (n, HIDDEN), dtype) for x in ("hidden", "second")), *(room(x, (CLASSES, n + SPARE), dtype) for x in ("a", "b")))


def _tables(net: dict[str, np.ndarray], room: Room) -> list[np.ndarray]:
    """The embeddings by offset; the bias is added to the first, once for each row instead of each word."""
    return [np.add(net["embed"][0], net["bias"], out=room("table", net["embed"][0].shape, net["bias"].dtype)), *net["embed"][1:]]


def forward(net: dict[str, np.ndarray], tables: list[np.ndarray], tokens: np.ndarray, high: np.ndarray, layers: tuple[np.ndarray, ...],
            room: Room) -> tuple[np.ndarray, np.ndarray]:
    """Fills the layers of some words; returns what their logits are above the log-probabilities, for both digits."""
    hidden, second, a, b = layers
    part = room("part", hidden.shape, hidden.dtype)
    np.take(tables[0], tokens[0], axis=0, out=second, mode="clip")  # no index is outside; "raise" would copy
    for k in range(1, len(OFFSETS)):
        second += np.take(tables[k], tokens[k], axis=0, out=part, mode="clip")
    np.tanh(second, out=hidden)
    second += np.take(net["digit"], high, axis=0, out=part, mode="clip")
    np.tanh(second, out=second)
    for x, layer, name in ((a, hidden, "high"), (b, second, "low")):
        np.matmul(net[name].T, layer.T, out=x)
        x += net[f"{name}_bias"][:, None]
    return _log_sums(a, room), _log_sums(b, room)


def log_probabilities(net: dict[str, np.ndarray], near: np.ndarray, high: np.ndarray, low: np.ndarray, room: Room | None = None) -> np.ndarray:
    room = room or Room()
    tables, tokens, out = _tables(net, room), _tokens(near, room), np.empty(len(high), net["bias"].dtype)
    for s in range(0, len(high), ROWS):
        e = min(s + ROWS, len(high))
        at, (hidden, second, a, b) = np.arange(e - s), _layers(e - s, out.dtype, room)
        above_a, above_b = forward(net, tables, tokens[:, s:e], high[s:e], (hidden, second, a[:, :e - s], b[:, :e - s]), room)
        out[s:e] = (a[high[s:e], at] - above_a) + (b[low[s:e], at] - above_b)
    return out


def gradients(net: dict[str, np.ndarray], near: np.ndarray, high: np.ndarray, low: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean negative log-probability."""
    return loss_and_gradients(net, near, high, low, Room())[1]


def loss_and_gradients(net: dict[str, np.ndarray], near: np.ndarray, high: np.ndarray, low: np.ndarray, room: Room) -> tuple[float, dict[str, np.ndarray]]:
    """The summed negative log-probability, and the gradients of its mean."""
    n, dtype = len(high), net["bias"].dtype
    tables, tokens, high, low = _tables(net, room), _tokens(near, room), high.astype(np.intp), low.astype(np.intp)
    hidden, second, a, b = _layers(n, dtype, room)
    d_seconds, by_token = room("d_seconds", (n, HIDDEN), dtype), room("by_token", (HIDDEN, n + SPARE), np.dtype(np.float64))
    picked = [(x.ravel(), digit * x.shape[1] + np.arange(n)) for x, digit in ((a, high), (b, low))]
    chances, three = [np.empty(n, dtype) for _ in picked], np.zeros(HIDDEN + 2 * CLASSES, dtype)
    for s in range(0, n, ROWS):
        e = min(s + ROWS, n)
        layers = hidden[s:e], second[s:e], a[:, s:e], b[:, s:e]
        above = forward(net, tables, tokens[:, s:e], high[s:e], layers, room)
        for x, up, (values, places), chance in zip(layers[2:], above, picked, chances):
            x -= up
            chance[s:e] = values[places[s:e]]
            np.exp(x, out=x)
            values[places[s:e]] -= 1
            x /= n
        d_total, d_second = room("d_total", layers[0].shape, dtype), d_seconds[s:e]
        for d, x, w in ((d_total, layers[2], "high"), (d_second, layers[3], "low")):
            np.matmul(x.T, net[w].T, out=d)
        for d, layer in ((d_second, layers[1]), (d_total, layers[0])):
            d *= np.subtract(1, np.multiply(layer, layer, out=room("part", layer.shape, dtype)), out=room("part", layer.shape, dtype))
        d_total += d_second
        rows = room("three", (e - s + 1, len(three)), dtype)  # the sums so far are the first row: rows are added one after the other
        np.concatenate((d_total, layers[2].T, layers[3].T), axis=1, out=rows[1:])
        rows[0] = three
        three = np.einsum("ij->j", rows)
        by_token[:, s:e] = d_total.T  # bincount adds doubles, a column at a time
    loss = -float(sum(chance.sum(dtype=np.float64) for chance in chances))
    grad = {"high": hidden.T @ a[:, :n].T, "low": second.T @ b[:, :n].T}
    grad |= zip(("bias", "high_bias", "low_bias"), np.split(three, (HIDDEN, HIDDEN + CLASSES)))
    columns = room("columns", (len(OFFSETS), HIDDEN, INPUTS + 1), dtype)
    for h in range(HIDDEN):
        for k in range(len(OFFSETS)):
            columns[k, h] = np.bincount(tokens[k], by_token[h, :n], INPUTS + 1)
    embed = room("embed", net["embed"].shape, dtype)
    embed[:] = columns.transpose(0, 2, 1)
    return loss, grad | {"digit": _sums_by_digit(d_seconds, high, room), "embed": embed}


def _sums_by_digit(x: np.ndarray, digits: np.ndarray, room: Room) -> np.ndarray:
    """The rows of each digit added as doubles. There are few digits, so rows are brought together instead of counted by column."""
    order = np.argsort(digits.astype(np.uint8), kind="stable")
    rows = room("rows", x.shape, np.dtype(np.float64))
    rows[:] = np.take(x, order, axis=0, out=room("ordered", x.shape, x.dtype), mode="clip")
    ends = np.cumsum(np.bincount(digits, minlength=CLASSES))
    return np.array([np.ones(e - s) @ rows[s:e] for s, e in zip([0, *ends], ends)], x.dtype)


def no_squares() -> dict[str, np.ndarray]:
    return {n: np.full(s, 1e-6, np.float32) for n, s in shapes().items()}


class Trainer:
    """Adagrad over minibatches, from a network and its sums of squares; the last, smaller batch counts too."""

    def __init__(self, net: dict[str, np.ndarray], squares: dict[str, np.ndarray]):
        self.net, self.squares = net, squares
        self.seen, self.steps, self.loss = 0, 0, 0.0
        self.room = Room()

    def _step(self, grad: np.ndarray, squares: np.ndarray, values: np.ndarray) -> None:
        step = np.multiply(grad, grad, out=self.room("step", grad.shape, grad.dtype))
        squares += step
        np.sqrt(squares, out=step)
        grad *= RATE
        grad /= step
        values -= grad

    def learn(self, near: np.ndarray, high: np.ndarray, low: np.ndarray) -> None:
        for s in range(0, len(high), BATCH):
            e = s + BATCH
            loss, grad = loss_and_gradients(self.net, near[s:e], high[s:e], low[s:e], self.room)
            for n, g in grad.items():
                for part in zip(g, self.squares[n], self.net[n]) if g.ndim > 2 else [(g, self.squares[n], self.net[n])]:
                    self._step(*part)
            self.loss += loss
            self.steps += 1
        self.seen += len(high)


@dataclass
class Words:
    """Words within their classes: ``table`` (word, cost) has the vocabulary but for the hot words, whose sorted hashes and
    costs are here; ``other`` is the cost of leaving the vocabulary in each class, ``spelling`` that of each pair of bytes."""

    table: DataFrame
    hot: np.ndarray
    hot_costs: np.ndarray
    other: np.ndarray
    spelling: np.ndarray
    n_tokens: int


@dataclass
class Model:
    net: dict[str, np.ndarray]
    words: Words


def class_of(words: np.ndarray) -> np.ndarray:
    return (words >> U64(20)) % U64(CLASSES * CLASSES)


def _pairs(raw: np.ndarray, offsets: np.ndarray, chosen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of each byte and the one before it in its word, the first and past-the-last byte of the words, and codes of their ends.

    With ``chosen`` these words' bytes alone, one word after the other. Otherwise there are codes of the bytes between words, too.
    """
    lower, first, last = word_spans(raw, offsets)
    if chosen is not None:
        first, last = first[chosen], last[chosen]
        ends = np.cumsum(last - first)
        moved = first - np.concatenate([[0], ends[:-1]])
        lower = lower[np.arange(ends[-1]) + np.repeat(moved, last - first)]
        first, last = first - moved, ends
    codes = np.empty(len(lower), np.int32)
    codes[:1], codes[1:] = EDGE, lower[:-1]
    codes[first] = EDGE
    codes *= BYTES
    codes += lower
    return codes, first, last, lower[last - 1].astype(np.int32) * BYTES + EDGE


def spelling_costs(spelling: np.ndarray, raw: np.ndarray, offsets: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Of the chosen words (places, in order)."""
    if not len(chosen):
        return np.zeros(0, np.int64)
    codes, first, last, ends = _pairs(raw, offsets, chosen)
    sums = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(spelling[codes], out=sums[1:])
    return sums[last] - sums[first] + spelling[ends]


class Places:
    """Finds hashes among sorted distinct ones. It is kept where those with the same upper bits begin, so a search takes a few steps."""

    def __init__(self, keys: np.ndarray):
        bits = len(keys).bit_length() + 1
        self.shift = U64(64 - bits)
        self.starts = np.searchsorted(keys, np.arange(1 << bits, dtype=U64) << self.shift)
        self.keys = np.append(keys, ~U64(0))  # no hash is above it

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each word, at most the number of keys, and whether the word is there."""
        place = self.starts[(words >> self.shift).view(np.int64)]
        behind = np.flatnonzero(self.keys[place] < words)
        while len(behind):
            place[behind] += 1
            behind = behind[self.keys[place[behind]] < words[behind]]
        return place, (self.keys[place] == words) & (place < len(self.keys) - 1)


def _counts(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, of which there are some, and how often each stands."""
    keys = np.sort(keys)
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[at], np.diff(at, append=len(keys))


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sum of the counts of each."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(counts, at) if len(at) else counts


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def count_words(docs: DataFrame, *, text_col: str = "text") -> Words:
    """Counts of every word and every pair of bytes of the corpus, as costs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, held, size = np.zeros(BYTES * BYTES, np.int64), [], 0

        def rows(spelled: bool, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), spelled)), pa.array(keys.view(np.int64)), pa.array(counts)], ["spelled", "word", "n"])

        for batch in batches:
            for lo, hi in slices(batch.column(0)):
                raw, offsets = text_bytes(batch.column(0).slice(lo, hi - lo))
                words, _ = word_hashes(raw, offsets)
                if not len(words):
                    continue
                codes, _, _, ends = _pairs(raw, offsets)
                pairs += np.bincount(codes, minlength=len(pairs)) + np.bincount(ends, minlength=len(pairs))
                held.append(_counts(words))
                size += len(held[-1][0])
                if size >= HELD:
                    held = [_sums(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))]
                    size = len(held[0][0])
                    if size >= HELD // 2:
                        yield rows(False, *held[0])
                        held, size = [], 0
        if held:
            yield rows(False, *_sums(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held])))
        pairs.reshape(BYTES, BYTES)[:, SPACES] = 0  # bytes between words
        codes = np.flatnonzero(pairs)
        yield rows(True, codes, pairs[codes])

    counted = stash(_texts(docs, text_col).mapInArrow(run, "spelled boolean, word long, n long").groupBy("spelled", "word").agg(F.sum("n").alias("n")))
    words = counted.where("not spelled")
    pairs = np.ones((BYTES, BYTES))
    for r in counted.where("spelled").collect():
        pairs.ravel()[r["word"]] += r["n"]
    spelling = np.ceil(-np.log(pairs / pairs.sum(axis=1, keepdims=True)) * UNIT).astype(np.int64).ravel()
    kind = F.shiftrightunsigned("word", 20).bitwiseAND(F.lit(CLASSES * CLASSES - 1))
    totals, once = np.zeros(CLASSES * CLASSES, np.int64), np.zeros(CLASSES * CLASSES, np.int64)
    for r in words.groupBy(kind.alias("kind")).agg(F.sum("n").alias("n"), F.count(F.when(F.col("n") == 1, 1)).alias("once")).collect():
        totals[r["kind"]], once[r["kind"]] = r["n"], r["once"]
    logs = F.array(*[F.lit(math.log(n + 1)) for n in totals.tolist()])
    cost = F.ceil((F.get(logs, kind.cast("int")) - F.log(F.col("n").cast("double"))) * F.lit(float(UNIT))).cast("long")
    known = words.where("n > 1").select("word", "n", cost.alias("cost"))
    limit = int(totals.sum()) // HOT
    hot = known.where(F.col("n") > limit).select("word", "cost").toArrow()
    keys, costs = hot.column("word").to_numpy().view(U64), hot.column("cost").to_numpy()
    order = np.argsort(keys)
    other = np.ceil((np.log(totals + 1.0) - np.log(once + 1.0)) * UNIT).astype(np.int64)
    return Words(known.where(F.col("n") <= limit).select("word", "cost"), keys[order], costs[order], other, spelling, int(totals.sum()))


def train(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The network trained on every text, and the words counted over all. No words at all give the fresh network and spelled words."""
    words = count_words(docs, text_col=text_col)
    return Model(train_network(docs, words.n_tokens, id_col=id_col, text_col=text_col), words)


def _parts(docs: DataFrame, n_tokens: int, id_col: str, text_col: str) -> DataFrame:
    """(codes): the packed words of each text that has some. A partition is a part, in the order of a hash of text and id.

    Rows with equal texts and equal ids are in one part.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            for lo, hi in slices(column):
                words, rows = word_hashes(*text_bytes(column.slice(lo, hi - lo)))
                ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=hi - lo)) * 3])
                data = np.ascontiguousarray(packed(codes_of(words)))
                codes = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])
                out = pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), codes], ["place", "codes"])
                yield out.filter(pa.array(np.diff(ends) > 0))

    parts = max(1, -(-n_tokens // PART_WORDS))
    text = F.coalesce(F.col(text_col), F.lit(""))
    chosen = docs.select(F.xxhash64(text, F.col(id_col)).alias("place"), text.alias("text")).mapInArrow(encode, "place long, codes binary")
    dealt = chosen.repartitionById(parts, F.pmod("place", F.lit(parts)).cast("int")).sortWithinPartitions("place", "codes")
    ensure_checkpoint_dir(docs.sparkSession)
    return dealt.select("codes").checkpoint()


def train_network(docs: DataFrame, n_tokens: int, *, id_col: str = "doc_id", text_col: str = "text") -> dict[str, np.ndarray]:
    """Rounds over every text of ``docs``, which have ``n_tokens`` words. Texts without words teach nothing."""
    net, squares, last = fresh(), no_squares(), math.inf
    if not n_tokens:
        return net
    parts = _parts(docs, n_tokens, id_col, text_col)
    while True:
        net, squares, loss = _round(parts, net, squares)
        if loss > last - FALL:
            return net
        last = loss


def _round(parts: DataFrame, net: dict[str, np.ndarray], squares: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray], float]:
    """The averages of the networks that the parts train, and of their squares, and the mean loss."""
    shared = parts.sparkSession.sparkContext.broadcast((net, squares))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(*({n: w.copy() for n, w in x.items()} for x in shared.value))
        held, size = [], 0
        fed: list[tuple[np.ndarray, ...]] = []  # all of a part with few words

        def learn() -> None:
            rows = np.repeat(np.arange(len(held)), [len(x) // 3 for x in held])
            fed.append(examples(unpacked(np.concatenate(held)), rows))
            trainer.learn(*fed[-1])
            if trainer.steps >= STEPS:
                fed.clear()

        for batch in batches:
            for x in batch.column(0):
                held.append(np.frombuffer(x.as_buffer(), np.uint8))
                size += len(held[-1]) // 3
                if size >= FED_WORDS:
                    learn()
                    held, size = [], 0
        if held:
            learn()
        seen, loss = trainer.seen, trainer.loss
        while fed and trainer.steps < STEPS:
            for x in fed:
                trainer.learn(*x)
        if seen:
            values = np.concatenate([flat(trainer.net), flat(trainer.squares)]) * np.float32(seen)
            cuts = [values[s:s + BLOCK].astype("<f4").tobytes() for s in range(0, len(values), BLOCK)]
            part, n = TaskContext.get().partitionId(), len(cuts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(n, dtype=np.int32)), pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, seen, np.int64)),
                 pa.array(np.full(n, loss)), pa.array(cuts, pa.binary())], ["block", "part", "seen", "loss", "values"])

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")  # the same order of sums in every run
        total = np.sum([np.frombuffer(v, "<f4").astype(np.float64) for v in table.column("values").to_pylist()], axis=0)
        return pa.table({"block": table.column("block")[:1], "part": table.column("part")[:1], "seen": pa.array([sum(table.column("seen").to_pylist())], pa.int64()),
                         "loss": pa.array([sum(table.column("loss").to_pylist())], pa.float64()), "values": pa.array([total.astype("<f4").tobytes()], pa.binary())})

    schema = "block int, part int, seen long, loss double, values binary"
    partial = parts.mapInArrow(run, schema).groupBy("block", F.pmod("part", F.lit(TASK_GROUPS)).alias("group")).applyInArrow(add, schema)
    blocks = sorted(partial.groupBy("block").applyInArrow(add, schema).collect(), key=lambda r: r["block"])
    shared.destroy()
    mean = np.concatenate([np.frombuffer(r["values"], "<f4").astype(np.float64) / r["seen"] for r in blocks])
    return unflat(mean[:len(mean) // 2]), unflat(mean[len(mean) // 2:]), blocks[0]["loss"] / blocks[0]["seen"]


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_tokens, log_probability (summed over its words), mean_log_probability.

    Edge cases: null, empty and blank texts have no words, the sum 0 and a null mean; null and repeated ids give a row each; equal texts
    get equal scores; no rows give no rows; other columns are not read. Texts are scored whole.
    """
    known = model.words
    shared = docs.sparkSession.sparkContext.broadcast((model.net, known.hot, known.hot_costs, known.other, known.spelling))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each text, with what its hot words cost, and one for each of its other words, with what it costs to spell."""
        net, hot, hot_costs, other, spelling = shared.value
        room, places, hot_costs = Room(), Places(hot), np.append(hot_costs, 0)
        at = TaskContext.get().partitionId() << 40  # rows of the partition so far: the key of a text
        for batch in batches:
            column = batch.column(1)
            for lo, hi in slices(column):
                raw, offsets = text_bytes(column.slice(lo, hi - lo))
                words, rows = word_hashes(raw, offsets)
                near, high, low = examples(codes_of(words), rows)
                each = [log_probabilities(net, near[s:s + BATCH], high[s:s + BATCH], low[s:s + BATCH], room) for s in range(0, len(high), BATCH)]
                total = np.bincount(rows, np.concatenate(each).astype(np.float64), hi - lo) if each else np.zeros(hi - lo)
                counts = np.bincount(rows, minlength=hi - lo).astype(np.int64)
                place, found = places.find(words)
                sums, ends = np.concatenate([[0], np.cumsum(hot_costs[place] * found)]), np.cumsum(counts)
                costs = sums[ends] - sums[ends - counts]
                keys = at + np.arange(hi - lo, dtype=np.int64)
                yield rows_of(keys, mix(keys.astype(U64)).view(np.int64), np.ones(hi - lo, np.int64), costs, batch.column(0).slice(lo, hi - lo),
                              pa.array(counts), pa.array(total))
                rest = np.flatnonzero(~found)
                words, rows, spelled = words[rest], rows[rest], spelling_costs(spelling, raw, offsets, rest)
                order = np.argsort(words + rows.astype(U64) * BASE)  # brings equal words of a row together
                words, rows, spelled = words[order], rows[order], spelled[order]
                if len(words):
                    first = np.flatnonzero(np.concatenate([[True], (words[1:] != words[:-1]) | (rows[1:] != rows[:-1])]))
                    times = np.diff(np.append(first, len(words)))
                    words, rows, spelled = words[first], rows[first], spelled[first]
                    none = pa.nulls(len(words), pa.int64())
                    yield rows_of(keys[rows], words.view(np.int64), times, spelled + other[class_of(words).astype(np.int64)], none, none, pa.nulls(len(words), pa.float64()))
                at += hi - lo

    def rows_of(key, word, times, cost, *rest) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(word), pa.array(times, pa.int64()), pa.array(cost), *rest],
                                          ["key", "word", "times", "cost", "doc_id", "n_tokens", "classes"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    each = chosen.mapInArrow(run, "key long, word long, times long, cost long, doc_id long, n_tokens long, classes double")
    table = known.table.withColumnsRenamed({"word": "_word", "cost": "_cost"})
    joined = each.join(table, F.col("word") == F.col("_word"), "left")
    cost = F.when(F.col("n_tokens").isNull(), F.coalesce("_cost", "cost") * F.col("times")).otherwise(F.col("cost"))
    out = joined.groupBy("key").agg(F.sum(cost).alias("cost"), F.max("doc_id").alias(id_col), F.max("n_tokens").alias("n_tokens"), F.max("classes").alias("classes"))
    out = out.withColumn("log_probability", F.col("classes") - F.col("cost") / F.lit(float(UNIT)))
    return out.select(id_col, "n_tokens", "log_probability", F.when(F.col("n_tokens") > 0, F.col("log_probability") / F.col("n_tokens")).alias("mean_log_probability"))
