"""BPE encoding and decoding with a tokenization automaton (operator 6).

Compiling. The automaton reads tokens and accepts exactly the token sequences that the merge rules
make. It starts as one state with a loop for every byte. Each merge ``a b -> c`` adds one gadget, in
the order of the rules: the arcs labelled ``a`` are led to a copy of their target that has no arc
``b``, and every state that has an arc ``a`` gets an arc ``c`` to the target of the old arc ``b``. All
arcs with the same label lead to the same state at any time, so a state is written as the label that
leads to it, and a gadget as one entry: the copied state, the removed arc and the time of the copy.
An arc of a state is found by going back through the gadgets to the time when label or state were
made, and is then kept in the transition table.

Encoding. Text is cut into pre-split words, and the words' bytes run through the automaton: from the
state reached so far, the tokens that the next bytes spell are taken as arcs if the table has them, the
longest first. A position is reached by one path at most, so each is entered once; there is no merge loop,
and the cost is linear in the word for any word. Words are encoded once per Python worker and kept in a
bounded dictionary.

Decoding emits the labels' bytes of the arcs on the path and reads them as UTF-8.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscope.llm.shingles import slices
from panelscope.llm.worker import kept

#: Fixed values of byte-level BPE: the pattern that splits text before merging, and the bytes that are
#: written as themselves in vocabulary files; the others follow from U+0100 in order.
#: White space is the Unicode property, which leaves out U+001C to U+001F.
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
         r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
SELF_WRITTEN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: Bounds of what a worker keeps: bytes of words with their ids (with what Python needs for an entry), and arcs of about 120 bytes each.
MAX_KEPT_BYTES = 80 << 20
ENTRY_BYTES = 180
MAX_KEPT_LENGTH = 64
MAX_KEPT_ARCS = 250_000
#: Labels are looked up by lengths that labels with the same first bytes have; SHORT are those below that.
HEAD = 4
SHORT = tuple(range(HEAD - 1, 0, -1))


def byte_characters() -> dict[str, int]:
    others = [b for b in range(256) if b not in set(SELF_WRITTEN)]
    return {chr(b): b for b in SELF_WRITTEN} | {chr(256 + k): b for k, b in enumerate(others)}


class Automaton:
    """Deterministic automaton over token labels, built from ``merges`` gadget by gadget."""

    def __init__(self, tokens: dict[int, bytes], merges: Iterable[tuple[int, int, int]]):
        self.labels = tokens
        self.made: dict[int, int] = {}  # label -> time of its gadget; bytes are there from the start
        self.parts: dict[int, tuple[int, int]] = {}
        self.removed: dict[tuple[int, int], int] = {}  # (state, arc) -> time of the gadget that removed it
        self.arcs: dict[int, bool] = {}  # state << 32 | arc
        for time, (left, right, label) in enumerate(merges):
            self.gadget(time, left, right, label)
        self.spelled = {b: t for t, b in self.reachable().items()}
        lengths: dict[bytes, set[int]] = {}
        for b in self.spelled:
            lengths.setdefault(b[:HEAD], set(SHORT)).add(len(b))
        #: The first bytes -> lengths of the labels that begin with them, longest first; equal tuples are one.
        same: dict[tuple, tuple] = {}
        self.lengths = {b: same.setdefault(k, k) for b, k in ((b, tuple(sorted(k, reverse=True))) for b, k in lengths.items() if len(b) == HEAD)}

    def reachable(self) -> dict[int, bytes]:
        return {t: b for t, b in self.labels.items() if len(b) == 1 or t in self.made}

    def gadget(self, time: int, left: int, right: int, label: int) -> None:
        """Merge ``left right -> label``: nothing changes unless the state of ``left`` has the arc ``right``."""
        known = all(t in self.made or len(self.labels[t]) == 1 for t in (left, right))
        if label in self.made or not known or not self.has_arc(left, right, time):
            return
        self.removed[left, right] = time
        self.made[label], self.parts[label] = time, (left, right)

    def has_arc(self, state: int, arc: int, before: float = float("inf")) -> bool:
        """Whether ``state`` has ``arc`` once the gadgets made earlier than ``before`` are in."""
        while True:
            gone = self.removed.get((state, arc))
            if gone is not None and gone < before:
                return False
            new_state, new_arc = self.made.get(state, -1), self.made.get(arc, -1)
            if new_state == new_arc:
                # Two bytes; or a label after itself: its state is a copy of the right part's, made just
                # before the arc, which is there if the right part's state has the left part's arc.
                if new_state < 0:
                    return True
                state, arc, before = self.parts[state][1], self.parts[arc][0], new_state
            elif new_state > new_arc:
                state, before = self.parts[state][1], new_state  # a copy of the right part's state at that time
            else:
                arc, before = self.parts[arc][0], new_arc + 1  # added to the states that kept the left part's arc

    def arc(self, state: int, label: int) -> bool:
        key = state << 32 | label
        got = self.arcs.get(key)
        if got is None:
            if len(self.arcs) >= MAX_KEPT_ARCS:
                self.arcs.clear()
            got = self.arcs[key] = self.has_arc(state, label)
        return got

    def encode(self, word: bytes) -> list[int]:
        """The labels of the one accepted path that spells ``word``.

        A position is reached by one path only, so each is entered at most once; long labels are tried first,
        and shorter ones only if the path goes back to their start.
        """
        n, spelled, lengths, kept_arc, arc = len(word), self.spelled.get, self.lengths.get, self.arcs.get, self.arc
        if not n:
            return []
        entered = bytearray(n + 1)
        path: list[int] = []
        at, state, untried = 0, -1, iter(lengths(word[:HEAD], SHORT))
        back = []  # the open states before this one
        while True:
            for k in untried:
                j = at + k
                if j <= n and not entered[j]:
                    label = spelled(word[at:j])
                    if label is not None:
                        open_arc = state < 0 or kept_arc(state << 32 | label)
                        if open_arc or (open_arc is None and arc(state, label)):
                            path.append(label)
                            if j == n:
                                return path
                            break
            else:
                if not back:
                    return path
                path.pop()
                at, state, untried = back.pop()
                continue
            back.append((at, state, untried))
            entered[j] = 1
            at, state, untried = j, label, iter(lengths(word[j:j + HEAD], SHORT))


class Words(dict):
    """Packed ids of the words met so far, in two generations that share ``MAX_KEPT_BYTES``.

    When the young one is full the old one goes; words met again move back to the young one.
    """

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton, self.held, self.old = automaton, 0, {}

    def __missing__(self, word: str) -> bytes:
        packed = self.old.get(word)
        if packed is None:
            labels = self.automaton.encode(word.encode())
            packed = struct.pack(f"<{len(labels)}I", *labels)
        if len(word) <= MAX_KEPT_LENGTH:
            if 2 * self.held >= MAX_KEPT_BYTES:
                self.old = dict(self)
                self.clear()
                self.held = 0
            self.held += ENTRY_BYTES + 2 * len(word) + len(packed)
            self[word] = packed
        return packed


class Tokenizer:
    """A byte-level BPE vocabulary file compiled to an :class:`Automaton`."""

    def __init__(self, spec: dict):
        model = spec["model"]
        chars = byte_characters()
        vocab = {t: bytes(chars[c] for c in t) for t in model["vocab"]}
        ids = model["vocab"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.bytes_of = {i: vocab[t] for t, i in ids.items()}
        self.automaton = Automaton(self.bytes_of, [(ids[a], ids[b], ids[a + b]) for a, b in pairs])
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.split = regex.compile(SPLIT)
        self.special_split = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.words = Words(self.automaton)

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        if self.special_split is None or not any(t in text for t in self.special):
            return b"".join(map(self.words.__getitem__, self.split.findall(text)))
        out = []
        for k, part in enumerate(self.special_split.split(text)):
            out.append(np.array([self.special[part]], dtype="<u4").tobytes() if k % 2 else b"".join(map(self.words.__getitem__, self.split.findall(part))))
        return b"".join(out)

    def decode(self, packed: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(packed, dtype="<u4").tolist())).decode("utf-8", errors="replace")


def tokenizer(spec_json: str) -> Tokenizer:
    """The worker's compiled tokenizer, made once for a vocabulary."""
    return kept("bpe tokenizer", hashlib.sha256(spec_json.encode()).hexdigest(), lambda: Tokenizer(json.loads(spec_json)))


def _spec(docs: DataFrame, path: str):
    """The vocabulary file, read by the driver and broadcast: its size is fixed by the vocabulary."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec["model"]["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
        raise ValueError("the vocabulary is not byte-level BPE")
    if spec.get("normalizer") or spec["pre_tokenizer"].get("add_prefix_space") or spec["model"].get("ignore_merges"):
        raise ValueError("normalisers, prefix spaces and ignore_merges are not supported")
    return docs.sparkSession.sparkContext.broadcast(json.dumps(spec))


def sliced(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """The batches in parts of about a megabyte of the text column; what is made of a part goes before the next is read."""
    for batch in batches:
        for lo, hi in slices(batch.column(text)):
            yield batch.slice(lo, hi - lo)


def encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, tokens binary): the ids of each text, little-endian unsigned 32-bit.

    A null text is an empty text: no tokens. Repeated ids give a row each; other columns are not read;
    no rows give no rows. Texts are whole, whatever their length.
    """
    spec = _spec(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(spec.value)
        for batch in sliced(batches, 1):
            packed = [t.encode(x.as_py() or "") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["id", "tokens"])

    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, "id long, tokens binary").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, *, id_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """(id, text): the text that each row of token ids spells; bytes that are not UTF-8 become U+FFFD.

    Null tokens are no tokens: an empty text.
    """
    spec = _spec(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(spec.value)
        for batch in batches:
            texts = [t.decode(x.as_py() or b"") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    chosen = encoded.select(F.col(id_col).cast("long").alias("id"), F.col(tokens_col).alias("tokens"))
    return chosen.mapInArrow(run, "id long, text string").withColumnRenamed("id", id_col)


def encode_report(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encode, decode what came out, and digest both.

    Edge cases as in :func:`encode`.
    """
    spec = _spec(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(spec.value)
        for batch in sliced(batches, 1):
            n, ids, texts = [], [], []
            for x in batch.column(1):
                packed = t.encode(x.as_py() or "")
                n.append(len(packed) // 4)
                ids.append(hashlib.sha256(packed).hexdigest())
                texts.append(hashlib.sha256(t.decode(packed).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(texts)],
                                             ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)


def encode_documents(docs: DataFrame, path: str, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(id, source, n_tokens, tokens, round_trip): token ids of each document, decoded again for the check.

    Edge cases as in :func:`encode`.
    """
    spec = _spec(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(spec.value)
        for batch in sliced(batches, 2):
            packed, same = [], []
            for x in batch.column(2):
                text = x.as_py() or ""
                packed.append(t.encode(text))
                same.append(t.decode(packed[-1]) == text)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(p) // 4 for p in packed], pa.int64()),
                                              pa.array(packed, pa.binary()), pa.array(same, pa.bool_())],
                                             ["id", "source", "n_tokens", "tokens", "round_trip"])

    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, "id long, source string, n_tokens long, tokens binary, round_trip boolean").withColumnsRenamed(
        {"id": id_col, "source": source_col})
