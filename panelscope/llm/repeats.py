"""Removal of repeated byte strings with a hash-compared suffix sort (operator 8).

A byte goes if it is covered by a string of ``LENGTH`` bytes that starts anywhere else too. Texts that are equal are
one text from here on.

1. Anchors. Of the k-grams inside each window of ``LENGTH`` bytes, the one with the least hash is an anchor. Equal windows have
   equal anchors at equal places, so windows are compared only around anchors of equal hash, and there is an anchor about every
   90 bytes instead of a suffix at every byte. Anchors whose hash stands once in the corpus are done.
2. Contexts. All windows around an anchor lie in the bytes from ``LENGTH - K`` before it to ``LENGTH`` after it. Equal contexts
   are one class, and a class of two or more is repeated as a whole.
3. Suffix sort. The other classes meet the classes of their anchor. Prefix polynomial hashes of each context, and binary
   search in them, give the common extension of two contexts in a logarithmic number of steps; a mergesort with that
   comparison sorts the suffixes at the anchors, and the reversed prefixes. Neighbours' extensions are checked byte by byte,
   and if a hash ever collided the bytes are sorted instead. Cutting both orders at the lengths that a window at offset o needs
   gives two classes per context; windows are equal exactly if both are.
4. Covered intervals are merged per text, and the remaining bytes joined.

Buckets of classes are tasks of bounded size. An anchor that stands in more than ``HOT`` classes (the edge of a passage in very
many texts) is not gathered: its windows are counted by hash with a group-by.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelscope.llm.shingles import BASE, U64, _powers, mix, slices, text_bytes
from panelscope.llm.stash import stash

LENGTH = 200
K = 24
BEFORE = LENGTH - K
HOT = 20_000
BUCKET = 8192
#: A longer text is looked at in parts of this size, overlapping by a window.
PART = 4 << 20
LOW = U64((1 << 24) - 1)
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def anchors(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, position in the row, anchor hash, context hash, bytes before, bytes after) of the anchors of texts laid end to end."""
    n = len(raw)
    if n < LENGTH:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, U64)
    np.cumsum((raw.astype(U64) + U64(1)) * up[:n], out=sums[1:])
    grams = mix((sums[K:] - sums[:-K]) * down[:n - K + 1])
    least = (grams & ~LOW) | np.arange(len(grams), dtype=U64)
    width, span = 1, LENGTH - K + 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[:len(least) - (span - width)], least[span - width:])
    inside = np.zeros(len(least), np.int8)  # windows that lie in one text
    sizes = np.diff(offsets)
    long = np.flatnonzero(sizes >= LENGTH)
    marks = np.zeros(len(least) + 1, np.int32)
    np.add.at(marks, offsets[long], 1)
    np.add.at(marks, offsets[long + 1] - LENGTH + 1, -1)
    inside = np.cumsum(marks[:-1]) > 0
    chosen = (least[inside] & LOW).astype(np.int64)
    at = np.unique(chosen[np.r_[True, chosen[1:] != chosen[:-1]]]) if len(chosen) else chosen
    rows = np.searchsorted(offsets, at, "right") - 1
    before = np.minimum(at - offsets[rows], BEFORE)
    after = np.minimum(offsets[rows + 1] - at, LENGTH)
    lo, hi = at - before, at + after
    context = mix((sums[hi] - sums[lo]) * down[lo] + before.astype(U64) * U64(0x9FB21C651E98DF25) + after.astype(U64))
    return rows, at - offsets[rows], grams[at], context, before, after


def _parts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, start in it, bytes, offsets): slices of rows, and parts of long texts."""
    for lo, hi in slices(column):
        raw, offsets = text_bytes(column.slice(lo, hi - lo))
        if len(raw) <= PART:
            yield lo, 0, raw, offsets
            continue
        for s in range(0, max(1, len(raw) - 2 * LENGTH), PART):
            cut = raw[max(0, s - 2 * LENGTH):s + PART + 2 * LENGTH]
            yield lo, max(0, s - 2 * LENGTH), cut, np.array([0, len(cut)], np.int64)


def _anchor_table(docs: DataFrame) -> DataFrame:
    """(anchor, context, key, pos, before, after) from (key, text)."""
    names = ["anchor", "context", "key", "pos", "before", "after"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, column = batch.column(0).to_numpy(), batch.column(1)
            for first, start, raw, offsets in _parts(column):
                rows, pos, gram, context, before, after = anchors(raw, offsets)
                if start or len(offsets) == 2 and len(raw) < len(column[first].as_buffer()):
                    # Contexts cut by the border of a part are whole in the next part, as parts overlap.
                    size = len(column[first].as_buffer())
                    pos = pos + start
                    whole = (before == np.minimum(pos, BEFORE)) & (after == np.minimum(size - pos, LENGTH))
                    rows, pos, gram, context, before, after = (x[whole] for x in (rows, pos, gram, context, before, after))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), pa.array(context.view(np.int64)), pa.array(keys[first + rows]), pa.array(pos.astype(np.int32)),
                     pa.array(before.astype(np.int16)), pa.array(after.astype(np.int16))], names)

    return docs.mapInArrow(run, "anchor long, context long, key long, pos int, before short, after short")


def prefix_hashes(matrix: np.ndarray) -> np.ndarray:
    """hashes[r, l]: polynomial hash of the first l bytes of row r."""
    out = np.zeros((len(matrix), matrix.shape[1] + 1), U64)
    for l in range(matrix.shape[1]):
        out[:, l + 1] = out[:, l] * BASE + matrix[:, l]
    return out


def extension(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Longest common prefixes of rows a and b, by binary search in their prefix hashes."""
    low = np.zeros(len(a), np.int64)
    high = np.full(len(a), hashes.shape[1] - 1, np.int64)
    while np.any(low < high):
        mid = (low + high + 1) >> 1
        same = hashes[a, mid] == hashes[b, mid]
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def merge_sort(matrix: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Order of the rows: runs double in each pass; an element's place is its own index plus its rank in the other run.

    All ranks of a pass are found together, by binary search with hash-compared suffixes.
    """
    n, width = len(matrix), matrix.shape[1]
    order, run = np.arange(n), 1

    def not_after(a: np.ndarray, b: np.ndarray, strict: np.ndarray) -> np.ndarray:
        l = extension(hashes, a, b)
        at = np.minimum(l, width - 1)
        x, y = matrix[a, at], matrix[b, at]
        return np.where(l == width, ~strict, x < y)

    while run < n:
        i = np.arange(n)
        block, inner = i // run, i % run
        left = block % 2 == 0
        start = np.where(left, (block + 1) * run, (block - 1) * run)
        low, high = np.minimum(start, n), np.minimum(start + run, n)
        first = low.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            mid = (low[open_] + high[open_]) >> 1
            # Elements of the other run that stand before: smaller ones, and for the right run equal ones too.
            goes = not_after(order[mid], order[open_], left[open_])
            low[open_] = np.where(goes, mid + 1, low[open_])
            high[open_] = np.where(goes, high[open_], mid)
        place = (block // 2) * 2 * run + inner + (low - first)
        merged = np.empty(n, np.int64)
        merged[place] = order
        order, run = merged, 2 * run
    return order


def sorted_extensions(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of the rows, and each row's common prefix with the one before it, checked byte by byte."""
    hashes = prefix_hashes(matrix)
    order = merge_sort(matrix, hashes)
    common = np.zeros(len(order), np.int64)
    common[1:] = extension(hashes, order[:-1], order[1:])
    differ = matrix[order[1:]] != matrix[order[:-1]]
    true = np.where(differ.any(axis=1), differ.argmax(axis=1), matrix.shape[1])
    if not np.array_equal(true, common[1:]):  # a hash collided
        order = np.lexsort(matrix.T[::-1])
        differ = matrix[order[1:]] != matrix[order[:-1]]
        common[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), matrix.shape[1])
    return order, common


def repeated_offsets(left: np.ndarray, right: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest offset o at which the window from o before the anchor stands in another context too; (1, 0) if none.

    ``left`` holds the bytes before the anchor, nearest first, ``right`` those from it on, both padded with zeros.
    """
    n = len(before)
    right_order, right_common = sorted_extensions(right)
    left_order, left_common = sorted_extensions(left)
    least, greatest = np.full(n, LENGTH, np.int64), np.full(n, -1, np.int64)
    cut = np.zeros(n, np.int64)
    both = np.zeros(n, np.int64)
    for o in range(BEFORE + 1):
        cut[right_order] = np.cumsum(right_common < LENGTH - o)
        both[left_order] = np.cumsum(left_common < max(o, 1) if o else np.zeros(n, bool))
        fits = np.flatnonzero((before >= o) & (after >= LENGTH - o))
        _, where, counts = np.unique(cut[fits] * (n + 1) + both[fits], return_inverse=True, return_counts=True)
        hit = fits[counts[where] > 1]
        least[hit] = np.minimum(least[hit], o)
        greatest[hit] = o
    return np.where(greatest < 0, 1, least), np.where(greatest < 0, 0, greatest)


def _contexts(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(anchor, context, before, after, bytes) of the wanted (anchor, context, key, pos, before, after)."""
    per_text = wanted.groupBy("key").agg(F.collect_list(F.struct("anchor", "context", "pos", "before", "after")).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, at in zip(batch.column(0), batch.column(1)):
                data = bytes(text.as_buffer())
                rows = at.as_py()
                spans = [data[x["pos"] - x["before"]:x["pos"] + x["after"]] for x in rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[c] for x in rows], t) for c, t in (("anchor", pa.int64()), ("context", pa.int64()), ("before", pa.int16()), ("after", pa.int16()))]
                    + [pa.array(spans, pa.binary())], ["anchor", "context", "before", "after", "bytes"])

    return texts.join(per_text, "key").select("text", "at").mapInArrow(run, "anchor long, context long, before short, after short, bytes binary")


def _sorted_ranges(table: pa.Table) -> pa.Table:
    before, after = (table.column(c).to_numpy().astype(np.int64) for c in ("before", "after"))
    n = len(before)
    left, right = np.zeros((n, BEFORE), np.uint16), np.zeros((n, LENGTH), np.uint16)
    for i, b in enumerate(table.column("bytes").to_pylist()):
        x = np.frombuffer(b, np.uint8).astype(np.uint16) + 1
        left[i, :before[i]] = x[:before[i]][::-1]
        right[i, :after[i]] = x[before[i]:]
    least, greatest = repeated_offsets(left, right, before, after)
    some = np.flatnonzero(least <= greatest)
    return pa.table({"anchor": table.column("anchor").take(some), "context": table.column("context").take(some),
                     "least": pa.array(least[some].astype(np.int32)), "greatest": pa.array(greatest[some].astype(np.int32))})


def _counted_ranges(contexts: DataFrame) -> DataFrame:
    """The same for anchors of very many contexts: their windows counted by hash, with partial sums."""
    offsets = F.sequence(F.greatest(F.lit(0), LENGTH - F.col("after").cast("int")), F.least(F.col("before").cast("int"), F.lit(BEFORE)))
    windows = contexts.where(F.col("before") + F.col("after") >= LENGTH).select("anchor", "context", "before", "bytes", F.explode(offsets).alias("o"))
    windows = windows.select("anchor", "context", "o", F.unhex(F.md5(F.substring("bytes", F.col("before") - F.col("o") + 1, F.lit(LENGTH)))).alias("h"))
    often = windows.groupBy("anchor", "o", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return windows.join(often, ["anchor", "o", "h"], "left_semi").groupBy("anchor", "context").agg(F.min("o").alias("least"), F.max("o").alias("greatest"))


def _key(text: Column) -> Column:
    return F.xxhash64(text, F.length(text))


def covered(docs: DataFrame, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """(texts, intervals): (key, text) of the texts with shared anchors, and (key, spans) of covered byte ranges."""
    keyed = docs.select(_key(F.col("text")).alias("key"), "text").where(F.octet_length("text") >= LENGTH)
    table = _anchor_table(keyed)
    # A table of its own, and an exchange by place behind the join, let Spark split the places of a frequent anchor.
    shared = stash(table.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"))
    places = stash(table.join(shared, "anchor", "left_semi").repartition("key", "pos").distinct())
    classes = places.groupBy("anchor", "context", "before", "after").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "pos")).alias("first"))
    classes = stash(classes.select("anchor", "context", "before", "after", "n", "first.key", "first.pos"))
    groups = classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("g"), F.min("n").alias("few")).where("g > 1 and few = 1").select("anchor", "g")
    wanted = stash(classes.join(groups, "anchor").drop("n"))
    texts = stash(keyed.groupBy("key").agg(F.first("text").alias("text")).join(places.select("key").distinct(), "key", "left_semi"))
    contexts = _contexts(texts, wanted.where(F.col("g") <= hot))
    buckets = max(1, -(-wanted.count() // BUCKET))
    sorted_ = contexts.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(buckets)).alias("bucket")).applyInArrow(
        _sorted_ranges, "anchor long, context long, least int, greatest int")
    counted = _counted_ranges(_contexts(texts, wanted.where(F.col("g") > hot)))
    whole = classes.where("n > 1 and before + after >= %d" % LENGTH).select(
        "anchor", "context", F.greatest(F.lit(0), LENGTH - F.col("after").cast("int")).alias("least"), F.col("before").cast("int").alias("greatest"))
    ranges = whole.unionByName(sorted_).unionByName(counted).groupBy("anchor", "context").agg(F.min("least").alias("least"), F.max("greatest").alias("greatest"))
    spans = places.join(ranges, ["anchor", "context"]).select(
        "key", F.struct((F.col("pos") - F.col("greatest")).alias("lo"), (F.col("pos") + LENGTH - F.col("least")).alias("hi")).alias("span"))
    return texts, spans.groupBy("key").agg(F.sort_array(F.collect_set("span")).alias("spans"))


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s in spans:  # sorted by start
        if out and s["lo"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s["hi"]))
        else:
            out.append((s["lo"], s["hi"]))
    return out


def _cut(texts: DataFrame, intervals: DataFrame) -> DataFrame:
    """(key, n_removed, n_spans, kept): what is left of each text with covered bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, kept = [], [], []
            for text, found in zip(batch.column(1), batch.column(2)):
                data, at, left = bytes(text.as_buffer()), 0, []
                ranges = merged(found.as_py())
                for lo, hi in ranges:
                    left.append(data[at:lo])
                    at = hi
                left.append(data[at:])
                kept.append(b"".join(left))
                removed.append(len(data) - len(kept[-1]))
                spans.append(len(ranges))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                                             ["key", "n_removed", "n_spans", "kept"])

    return texts.join(intervals, "key").mapInArrow(run, "key long, n_removed long, n_spans long, kept binary")


def _outcome(docs: DataFrame, id_col: str, text_col: str, hot: int, carried: dict[str, Column]) -> DataFrame:
    """(_id, n_bytes, carried columns, copied, n_removed, n_spans, kept); kept is null for texts that lose all or nothing."""
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts, intervals = covered(rows, hot)
    placed = rows.select("_id", _key(F.col("text")).alias("key"), F.octet_length("text").cast("long").alias("n_bytes"),
                         *[c.alias(n) for n, c in carried.items()])
    sizes = rows.select(_key(F.col("text")).alias("key"), F.octet_length("text").alias("n")).where(F.col("n") >= LENGTH)
    copies = sizes.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key", F.lit(True).alias("copied"))
    out = placed.join(copies, "key", "left").join(_cut(texts, intervals), "key", "left")
    all_of_it = F.col("copied").isNotNull()
    return out.select("_id", "n_bytes", *carried, all_of_it.alias("copied"),
                      F.when(all_of_it, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
                      F.when(all_of_it, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"), "kept")


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept (the remaining bytes).

    Edge cases: a null text is empty, and empty and short texts lose nothing; texts that are equal and have ``LENGTH`` bytes or more lose
    everything; null and repeated ids give a row each; no rows give no rows; other columns are not read.
    """
    out = _outcome(docs, id_col, text_col, hot, {"_text": F.col("text").cast("binary")})
    kept = F.when(F.col("copied"), F.lit("").cast("binary")).otherwise(F.coalesce("kept", "_text"))
    return out.select(F.col("_id").alias(id_col), "n_bytes", "n_removed", "n_spans", kept.alias("kept"))


def repeats_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """As :func:`remove_repeats`, with kept_sha256 in place of the bytes."""
    out = _outcome(docs, id_col, text_col, hot, {"_sha": F.sha2("text", 256)})
    sha = F.when(F.col("copied"), F.lit(EMPTY_SHA)).otherwise(F.coalesce(F.sha2("kept", 256), F.col("_sha")))
    return out.select(F.col("_id").alias(id_col), "n_bytes", "n_removed", "n_spans", sha.alias("kept_sha256"))
