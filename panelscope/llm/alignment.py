"""Alignment of two tokenizers by composing fragments (operator 12).

Tokenizer A (byte-level BPE) reads a space and the text, tokenizer B (sentencepiece BPE) the text, to which it adds that space
itself. Both spell the same bytes; where tokens of both end at the same byte, the bytes are cut, and the tokens between two cuts
are a group.

Fragments. The tokens that end in a range of bytes make a fragment: the tokens up to its first cut (open, tokens before the
range may belong to them), the closed groups between its cuts, and the tokens behind its last cut (open again). A range
without a cut is all open. ``compose`` joins two neighbouring fragments: what is open between them becomes one group. It is
associative, with the empty fragment as its one, so the fragments of a text can be composed in any grouping.

Texts. Both tokenizers treat the two sides of a single space between two other characters apart (A splits words there, no piece of
B has a space behind another character; both are checked on the vocabularies). The stretches between such places are encoded
once per worker, kept with their groups, and joined. A text of more than ``RANGE`` bytes is first cut at such places into pieces,
which other tasks encode; a piece gives a fragment for every range of ``RANGE`` bytes that it touches, and the fragments of a text
are composed in a tree, ``FAN`` neighbours by task and level, each level a shuffle by text and place.

Links. Every cut links the A and the B token that end there. Rows are blocks of documents: the links are numbers in the block's own
dictionary of id pairs. Corpus-wide counts are an aggregate over the blocks' dictionaries, and each block looks up each of its pairs
once. Nothing of the corpus is collected or broadcast; only the two vocabularies are.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscope.llm.bpe import byte_characters
from panelscope.llm.shingles import slices
from panelscope.llm.stash import stash
from panelscope.llm.worker import kept

#: Bytes of a range, and fragments that one task composes at a level of the tree.
RANGE = 1 << 16
FAN = 16
#: A block of documents is closed at so many links, or at so many bytes of written groups (if they are kept).
BLOCK_LINKS = 1 << 18
BLOCK_BYTES = 1 << 24
#: Stretches in each half of a worker's dictionary (about 500 bytes each), and the characters of the longest.
MAX_KEPT = 30_000
MAX_KEPT_LENGTH = 48
#: Characters of texts that are aligned together: their tokens stand in Python lists for a moment.
STEP = 1 << 19
#: Characters of stretches that tokenizer A encodes as one text.
RUN = 1 << 12

BLOCK = "part long, docs array<struct<id:long,n_a:long,n_b:long,n:long,groups:string>>, links binary, pairs binary, counts binary"
FRAGMENT = "row long, id long, at long, n long, a_head binary, b_head binary, closed binary, a_tail binary, b_tail binary, n_a long, n_b long, links binary"
SAFE = re.compile(rb"(?<=[!-~]) (?=[!-~])")

Fragment = tuple[int, bytes, bytes, bytes, bytes, bytes]
#: (cuts, A ids to the first cut, B ids to the first cut, closed groups, A ids behind the last cut, B ids behind the last cut)
EMPTY: Fragment = (0, b"", b"", b"", b"", b"")


def _join(x: bytes, y: bytes) -> bytes:
    return x + b"," + y if x and y else x or y


def compose(f: Fragment, g: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges."""
    if not f[0]:
        return (g[0], _join(f[1], g[1]), _join(f[2], g[2]), *g[3:])
    if not g[0]:
        return (*f[:4], _join(f[4], g[1]), _join(f[5], g[2]))
    between = _join(f[4], g[1]) + b"|" + _join(f[5], g[2])
    return (f[0] + g[0], f[1], f[2], b";".join(x for x in (f[3], between, g[3]) if x), g[4], g[5])


def written(f: Fragment) -> bytes:
    """The groups of a whole text's fragment."""
    return b";".join(x for x in (f[1] + b"|" + f[2], f[3]) if x) if f[0] else b""


def _ids(ids: Iterable[int]) -> bytes:
    return b",".join(b"%d" % i for i in ids)


def fragment(a: np.ndarray, a_ends: np.ndarray, b: np.ndarray, b_ends: np.ndarray) -> tuple[Fragment, np.ndarray, np.ndarray]:
    """The fragment of tokens with their ends (ascending, each token has bytes), and the A and B ids that its cuts link."""
    _, ka, kb = np.intersect1d(a_ends, b_ends, assume_unique=True, return_indices=True)
    if not len(ka):
        return (0, _ids(a), _ids(b), b"", b"", b""), a[:0], b[:0]
    groups = [_ids(x) + b"|" + _ids(y) for x, y in zip(np.split(a, ka + 1)[1:-1], np.split(b, kb + 1)[1:-1])]
    return ((len(ka), _ids(a[:ka[0] + 1]), _ids(b[:kb[0] + 1]), b";".join(groups), _ids(a[ka[-1] + 1:]), _ids(b[kb[-1] + 1:])),
            a[ka], b[kb])


def checked(a_file: bytes) -> bytes:
    """The file of tokenizer A, if it treats stretches apart; on the driver."""
    spec = json.loads(a_file)
    split = spec.get("pre_tokenizer") or {}
    if split.get("type") != "ByteLevel" or split.get("add_prefix_space") or split.get("use_regex") is False or spec.get("normalizer"):
        raise ValueError("tokenizer A must be byte-level with its own word pattern and no normaliser or added space")
    return a_file


class Pair:
    """Both tokenizers, from the bytes of their files, and the groups of stretches met before."""

    def __init__(self, a_file: bytes, b_file: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_str(a_file.decode())
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_file)
        chars = byte_characters()
        added = set(self.a.get_added_tokens_decoder())
        self.a_bytes = {i: x.encode() if i in added else bytes(chars[c] for c in x) for x, i in self.a.get_vocab().items()}
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if "▁" in piece.lstrip("▁"):
                raise ValueError("tokenizer B has a piece with a space behind another character")
            self.b_bytes.append(bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.n_b = len(self.b_bytes)
        self.a_sizes, self.b_sizes = np.zeros(max(self.a_bytes) + 1, np.int64), np.array([len(x) for x in self.b_bytes])
        for i, x in self.a_bytes.items():
            self.a_sizes[i] = len(x)
        self.items = [b"%d%c" % (i, c) for i in range(max(len(self.a_sizes), self.n_b)) for c in b",|;"]
        self.item_sizes = np.array([len(x) for x in self.items])
        self.link = np.dtype("<u4" if (max(self.a_bytes) + 1) * self.n_b <= 1 << 32 else "<u8")
        # stretches met lately, and those met before; what is met again moves to the first
        self.kept: dict[str, tuple[int, int, int, bytes, bytes] | bool] = {}
        self.older: dict[str, tuple[int, int, int, bytes, bytes] | bool] = {}

    def tokens(self, stretch: str, a: list[int], b: list[int]) -> bool:
        """Whether both spell the stretch with its space."""
        whole = b" " + stretch.encode()
        return b"".join([self.a_bytes[i] for i in a]) == whole and b"".join([self.b_bytes[i] for i in b]) == whole

    def entries(self, stretches: list[str]) -> list[tuple[int, int, int, bytes, bytes] | bool]:
        """(A tokens, B tokens, cuts, written groups, links) of each stretch, False where the tokens do not spell it.

        The stretches are aligned as one text, their ends being cuts; what is written for it is cut up again.
        """
        if not stretches:
            return []
        sizes = np.array([len(s.encode()) + 1 for s in stretches])
        whole, last = "".join([" " + s for s in stretches]).encode(), np.cumsum(sizes)
        flat_a = self.encode_runs(stretches)
        b = self.b.encode(stretches, num_threads=1)
        flat_b = list(chain.from_iterable(b))
        a_ids, b_ids = np.array(flat_a, np.int64), np.array(flat_b, np.int64)
        a_ends, b_ends = np.cumsum(self.a_sizes[a_ids]), np.cumsum(self.b_sizes[b_ids])
        a_last, b_last = np.searchsorted(a_ends, last), np.cumsum([len(x) for x in b]) - 1
        spelled = b"".join(map(self.a_bytes.__getitem__, flat_a)) == whole == b"".join(map(self.b_bytes.__getitem__, flat_b))
        if not (spelled and np.array_equal(a_ends[a_last], last) and np.array_equal(b_ends[b_last], last)):
            return self.entries_apart(stretches)
        n_a, n_b = np.diff(a_last, prepend=-1), np.diff(b_last, prepend=-1)
        _, ka, kb = np.intersect1d(a_ends, b_ends, assume_unique=True, return_indices=True)
        # an item is a token with what is written behind it; a group's A tokens come before its B tokens
        a_group = np.repeat(np.arange(len(ka)), np.diff(ka, prepend=-1))
        b_group = np.repeat(np.arange(len(kb)), np.diff(kb, prepend=-1))
        a_items, b_items = 3 * a_ids, 3 * b_ids
        a_items[ka] += 1
        b_items[kb] += 2
        items = np.empty(len(a_ids) + len(b_ids), np.int64)
        items[np.arange(len(a_ids)) + np.concatenate([[0], kb[:-1] + 1])[a_group]] = a_items
        items[np.arange(len(b_ids)) + ka[b_group] + 1] = b_items
        blob = b"".join(map(self.items.__getitem__, items.tolist()))
        ends = np.cumsum(self.item_sizes[items])[a_last + b_last + 1]
        links = (a_ids[ka] * self.n_b + b_ids[kb]).astype(self.link).tobytes()
        cuts = np.searchsorted(ka, a_last) + 1
        width, ends, cuts_ = self.link.itemsize, ends.tolist(), cuts.tolist()
        return [(x, y, k - k0, blob[e0:e - 1], links[k0 * width:k * width])
                for x, y, k0, k, e0, e in zip(n_a.tolist(), n_b.tolist(), [0] + cuts_, cuts_, [0] + ends, ends)]

    def entries_apart(self, stretches: list[str]) -> list[tuple[int, int, int, bytes, bytes] | bool]:
        """Entries of stretches of which some are not spelled, or do not add up to the text that they make together."""
        good = [self.tokens(*x) for x in zip(stretches, *self.encode(stretches))]
        if all(good) and len(stretches) == 1:  # cannot be: a stretch is its own text
            raise AssertionError("tokens of a stretch do not add up")
        rest = [s for s, g in zip(stretches, good) if g]
        half = len(rest) // 2 if all(good) else len(rest)
        found = iter(self.entries(rest[:half]) + self.entries(rest[half:]))
        return [next(found) if g else False for g in good]

    def encode_runs(self, stretches: list[str]) -> list[int]:
        """A's tokens of all stretches, encoded as texts of about ``RUN`` characters; those with white space at an end are texts of their own."""
        runs, held, size = [], [], 0
        for s in stretches:
            alone = not s or s[0].isspace() or s[-1].isspace()
            if held and (alone or size >= RUN):
                runs.append(" " + " ".join(held))
                held, size = [], 0
            if alone:
                runs.append(" " + s)
            else:
                held.append(s)
                size += len(s) + 1
        if held:
            runs.append(" " + " ".join(held))
        return list(chain.from_iterable([e.ids for e in self.a.encode_batch_fast(runs, add_special_tokens=False)]))

    def encode(self, stretches: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        return [e.ids for e in self.a.encode_batch_fast([" " + s for s in stretches], add_special_tokens=False)], self.b.encode(stretches)

    @staticmethod
    def stretches(text: str) -> list[str]:
        """The text between its single spaces; places where a space is not single, or next to other white space, are no cuts."""
        out, open_ = [], True  # whether the stretch before takes the next part, too
        for part in text.split(" "):
            odd = not part or part[0].isspace() or part[-1].isspace()
            if out and (odd or open_):
                out[-1].append(part)
            else:
                out.append([part])
            open_ = odd
        return [" ".join(x) for x in out]

    def align(self, texts: list[str]) -> list[tuple[int, int, int, bytes, bytes]]:
        """(A tokens, B tokens, cuts, written groups, links) of each text; zeros for an empty text or one that the tokens do not spell."""
        parts = [t.split(" ") if t else [] for t in texts]
        if len(self.kept) > MAX_KEPT:
            self.older, self.kept = self.kept, {}
        unknown = set().union(*parts) - self.kept.keys()
        odd = {p for p in unknown if not p or p[0].isspace() or p[-1].isspace()}
        if odd:
            for k, ps in enumerate(parts):
                if not odd.isdisjoint(ps):
                    parts[k] = self.stretches(texts[k])
            unknown = set().union(*parts) - self.kept.keys()
        again = unknown & self.older.keys()
        self.kept.update((s, self.older[s]) for s in again)
        new = sorted(unknown - again)
        once = {}
        for s, e in zip(new, self.entries(new)):
            (self.kept if len(s) <= MAX_KEPT_LENGTH else once)[s] = e
        out = []
        for ps in parts:
            found = list(map(self.kept.get, ps))
            if None in found:
                found = [once[p] if e is None else e for p, e in zip(ps, found)]
            if not found or False in found:
                out.append((0, 0, 0, b"", b""))
                continue
            n_a, n_b, n, groups, links = zip(*found)
            out.append((sum(n_a), sum(n_b), sum(n), b";".join(groups), b"".join(links)))
        return out


def pair(files: tuple[bytes, bytes]) -> Pair:
    """The worker's tokenizers, loaded once."""
    return kept("tokenizer pair", tuple(hashlib.md5(f).digest() for f in files), lambda: Pair(*files))


class _Block:
    """Documents of a task, written out as one row."""

    def __init__(self, link: np.dtype, digest: bool):
        self.link, self.digest = link, digest
        self.rows: list[tuple] = []
        self.links: list[bytes] = []
        self.n = self.size = 0

    def add(self, id_: int | None, n_a: int, n_b: int, n: int, groups: bytes, links: bytes) -> None:
        text = hashlib.sha256(groups).hexdigest() if self.digest and n else groups.decode()
        self.rows.append((id_, n_a, n_b, n, text))
        self.links.append(links)
        self.n, self.size = self.n + n, self.size + len(text)

    def full(self) -> bool:
        return self.n >= BLOCK_LINKS or self.size >= BLOCK_BYTES

    def flush(self, part: int) -> pa.RecordBatch:
        links = np.frombuffer(b"".join(self.links), self.link)
        pairs, codes, counts = np.unique(links, return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")  # frequent pairs get small numbers, whose bytes compress
        rank = np.empty(len(order), "<u4")
        rank[order] = np.arange(len(order), dtype="<u4")
        planes = np.ascontiguousarray(rank[codes.ravel()].view(np.uint8).reshape(-1, 4).T)
        ids, n_a, n_b, n, groups = zip(*self.rows)
        docs = pa.StructArray.from_arrays([pa.array(ids, pa.int64()), pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()), pa.array(n, pa.int64()),
                                           pa.array(groups, pa.string())], ["id", "n_a", "n_b", "n", "groups"])
        out = pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), docs),
             pa.array([pa.Codec("zstd", compression_level=1).compress(planes.tobytes(), asbytes=True)], pa.binary()),
             pa.array([pairs[order].astype("<u8").tobytes()], pa.binary()), pa.array([counts[order].astype("<i8").tobytes()], pa.binary())],
            ["part", "docs", "links", "pairs", "counts"])
        self.__init__(self.link, self.digest)
        return out



def _codes(blob: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.Codec("zstd").decompress(blob, decompressed_size=4 * n, asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def steps(texts: list[str]) -> Iterator[slice]:
    """Ranges of texts that are aligned together, of about ``STEP`` characters."""
    at, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= STEP or k == len(texts) - 1:
            yield slice(at, k + 1)
            at, size = k + 1, 0


def _short(texts: DataFrame, files, digest: bool) -> DataFrame:
    """Blocks of the documents (id, text) that one task encodes whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, part = pair(files.value), TaskContext.get().partitionId() << 32
        block = _Block(p.link, digest)
        for batch in batches:
            for lo, hi in slices(batch.column(1)):
                ids, rows = batch.column(0).slice(lo, hi - lo).to_pylist(), [t or "" for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                for at in steps(rows):
                    for id_, found in zip(ids[at], p.align(rows[at])):
                        block.add(id_, *found)
                    if block.full():
                        yield block.flush(part)
                        part += 1
        if block.rows:
            yield block.flush(part)

    return texts.mapInArrow(run, BLOCK)


def cut_text(data: bytes, size: int) -> Iterator[tuple[int, bytes]]:
    """Pieces of about ``size`` bytes that both tokenizers treat apart, with their places; the space between two is in none."""
    at = 0
    while True:
        cut = SAFE.search(data, at + size)
        yield at, data[at:cut.start()] if cut else data[at:]
        if not cut:
            return
        at = cut.end()


def _pieces(texts: DataFrame, size: int) -> DataFrame:
    """(row, id, at, piece) of the long documents (row, id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row, id_, text = (batch.column(c)[k].as_py() for c in range(3))
                for at, piece in cut_text(text.encode(), size):
                    yield pa.RecordBatch.from_arrays([pa.array([row], pa.int64()), pa.array([id_], pa.int64()), pa.array([at], pa.int64()),
                                                      pa.array([piece.decode()], pa.string())], ["row", "id", "at", "piece"])

    return texts.mapInArrow(run, "row long, id long, at long, piece string")


def _fragments(pieces: DataFrame, files, size: int) -> DataFrame:
    """The fragments of the ranges that each piece touches; ``n`` is -1 where the tokens do not spell the piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pair(files.value)
        for batch in batches:
            for k in range(batch.num_rows):
                row, id_, at, piece = (batch.column(c)[k].as_py() for c in range(4))
                (a,), (b,) = p.encode([piece])
                rows = []
                if p.tokens(piece, a, b):
                    a_ids, b_ids = np.array(a), np.array(b)
                    a_ends = at + np.cumsum([len(p.a_bytes[i]) for i in a])
                    b_ends = at + np.cumsum([len(p.b_bytes[i]) for i in b])
                    for r in range(at // size, (int(a_ends[-1]) - 1) // size + 1):
                        i = np.searchsorted(a_ends, [r * size, (r + 1) * size], "right")
                        j = np.searchsorted(b_ends, [r * size, (r + 1) * size], "right")
                        f, la, lb = fragment(a_ids[i[0]:i[1]], a_ends[i[0]:i[1]], b_ids[j[0]:j[1]], b_ends[j[0]:j[1]])
                        rows.append((row, id_, max(at, r * size), *f, int(i[1] - i[0]), int(j[1] - j[0]), (la * p.n_b + lb).astype(p.link).tobytes()))
                else:
                    rows.append((row, id_, at, -1, *[b""] * 5, 0, 0, b""))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _FRAGMENT_TYPES)], _FRAGMENT_NAMES)

    return pieces.mapInArrow(run, FRAGMENT)


_FRAGMENT_NAMES = [c.split()[0] for c in FRAGMENT.split(", ")]
_FRAGMENT_TYPES = [pa.binary() if c.endswith("binary") else pa.int64() for c in FRAGMENT.split(", ")]


def _compose_rows(rows: list[dict]) -> dict:
    rows = sorted(rows, key=lambda r: r["at"])
    out = dict(rows[0])
    if any(r["n"] < 0 for r in rows):
        return out | dict(n=-1, a_head=b"", b_head=b"", closed=b"", a_tail=b"", b_tail=b"", n_a=0, n_b=0, links=b"")
    f = EMPTY
    for r in rows:
        f = compose(f, tuple(r[c] for c in ("n", "a_head", "b_head", "closed", "a_tail", "b_tail")))
    return out | dict(zip(("n", "a_head", "b_head", "closed", "a_tail", "b_tail"), f)) | dict(
        n_a=sum(r["n_a"] for r in rows), n_b=sum(r["n_b"] for r in rows), links=b"".join(r["links"] for r in rows))


def _compose_level(fragments: DataFrame, span: int) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([_compose_rows(table.to_pylist())], pa.schema(zip(_FRAGMENT_NAMES, _FRAGMENT_TYPES)))

    return fragments.groupBy("row", F.floor(F.col("at") / span).alias("_span")).applyInArrow(run, FRAGMENT)


def _long(texts: DataFrame, files, digest: bool, size: int) -> DataFrame:
    """Blocks of one long document each."""
    pieces = stash(_pieces(texts, size))
    furthest = pieces.agg(F.max(F.col("at") + F.octet_length("piece"))).first()[0]
    fragments = stash(_fragments(pieces.repartition("row", "at"), files, size))
    span = size
    while span < (furthest or 0):
        span *= FAN
        fragments = _compose_level(fragments, span)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pair(files.value)
        for batch in batches:
            for r in batch.to_pylist():
                whole = r["n"] > 0
                block = _Block(p.link, digest)
                f = tuple(r[c] for c in ("n", "a_head", "b_head", "closed", "a_tail", "b_tail"))
                block.add(r["id"], r["n_a"], r["n_b"], max(r["n"], 0), written(f) if whole else b"", r["links"])
                yield block.flush(-1 - r["row"])

    return fragments.mapInArrow(run, BLOCK)


def align_blocks(docs: DataFrame, a_path: str, b_path: str, *, id_col: str = "doc_id", text_col: str = "text", digest: bool = False,
                 size: int = RANGE) -> DataFrame:
    """Blocks of aligned documents, written to the shared folder: see ``align`` and ``link_report``."""
    with open(a_path, "rb") as f, open(b_path, "rb") as g:  # on the driver, once
        files = docs.sparkSession.sparkContext.broadcast((checked(f.read()), g.read()))
    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    is_long = F.coalesce(F.octet_length("text") > size, F.lit(False))
    short = _short(chosen.where(~is_long), files, digest)
    rows = chosen.select(F.monotonically_increasing_id().alias("row"), "id", "text").where(is_long)
    return stash(short.unionByName(_long(rows, files, digest, size)))


def align(docs: DataFrame, a_path: str, b_path: str, *, id_col: str = "doc_id", text_col: str = "text", size: int = RANGE) -> DataFrame:
    """(id, n_a, n_b, n_groups, groups): the groups of each document as ``a1,a2|b1;a3|b2,b3``.

    Texts that are null, empty, or not spelled by the tokens of both (a U+2581, which B reads as a space) have no tokens: zeros and ''.
    Repeated rows and ids, and null ids, stay as they are; other columns are not used, whatever their names. No rows give none.
    A text's groups are one string, so a text is bounded as any Spark string is.
    """
    blocks = align_blocks(docs, a_path, b_path, id_col=id_col, text_col=text_col, size=size)
    d = blocks.select(F.explode("docs").alias("d"))
    return d.select(F.col("d.id").alias(id_col), "d.n_a", "d.n_b", F.col("d.n").alias("n_groups"), "d.groups")


def pair_rows(blocks: DataFrame, n_b: int) -> DataFrame:
    """(part, code, pair, n): each block's dictionary of linked pairs, ``pair`` being A id * ``n_b`` + B id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                pairs = np.frombuffer(batch.column(1)[k].as_py(), "<u8").astype(np.int64)
                n = np.frombuffer(batch.column(2)[k].as_py(), "<i8")
                for at in range(0, len(pairs), 1 << 16):
                    m = len(pairs[at:at + (1 << 16)])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(m, batch.column(0)[k].as_py())), pa.array(np.arange(at, at + m)),
                                                      pa.array(pairs[at:at + m]), pa.array(n[at:at + m])], ["part", "code", "pair", "n"])

    return blocks.select("part", "pairs", "counts").mapInArrow(run, "part long, code long, pair long, n long")


def pair_counts(rows: DataFrame, n_b: int) -> DataFrame:
    """(pair, total, best): links of each id pair in the corpus, and whether no pair with that B id has more."""
    counts = rows.groupBy("pair").agg(F.sum("n").alias("total")).withColumn("b", F.col("pair") % n_b)
    top = counts.groupBy("b").agg(F.max("total").alias("top"))
    return counts.join(top, "b").select("pair", "total", (F.col("total") == F.col("top")).alias("best"))


def link_report(docs: DataFrame, a_path: str, b_path: str, *, id_col: str = "doc_id", text_col: str = "text", size: int = RANGE) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256).

    A pair's count is the number of links that hold it in all documents, repeated rows included. ``n_best`` counts a document's links whose
    count is the highest of their B id, ``count_sum`` adds up the counts of its links. Edge cases as in ``align``; the digest of no groups is ''.
    """
    blocks = align_blocks(docs, a_path, b_path, id_col=id_col, text_col=text_col, digest=True, size=size)
    n_b = _n_pieces(b_path)
    rows = stash(pair_rows(blocks, n_b))
    looked = rows.select("part", "code", "pair").join(pair_counts(rows, n_b), "pair").select("part", "code", "total", "best")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        code = right.column("code").to_numpy()
        total, best = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        total[code], best[code] = right.column("total").to_numpy(), right.column("best").to_numpy().astype(np.int64)
        docs_ = pa.chunked_array([c.flatten() for c in left.column("docs").chunks]).combine_chunks() if left.num_rows else None
        if docs_ is None:
            return pa.Table.from_pylist([], _REPORT)
        n = docs_.field("n").to_numpy()
        codes = _codes(left.column("links")[0].as_py(), int(n.sum()))
        edges = np.concatenate([[0], np.cumsum(n)])
        sums = np.concatenate([[0], np.cumsum(total[codes])])
        bests = np.concatenate([[0], np.cumsum(best[codes])])
        return pa.Table.from_arrays([docs_.field("id"), docs_.field("n_a"), docs_.field("n_b"), docs_.field("n"), docs_.field("n"),
                                     pa.array(bests[edges[1:]] - bests[edges[:-1]]), pa.array(sums[edges[1:]] - sums[edges[:-1]]), docs_.field("groups")], schema=_REPORT)

    out = blocks.select("part", "docs", "links").groupBy("part").cogroup(looked.groupBy("part")).applyInArrow(
        run, "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
    return out.withColumnRenamed("id", id_col)


_REPORT = pa.schema([(c, pa.int64()) for c in ("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")] + [("groups_sha256", pa.string())])


def _n_pieces(b_path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
