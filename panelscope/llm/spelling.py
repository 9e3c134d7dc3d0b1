"""Spelling variants by a dictionary of trie-node pairs (operator 13).

Words. Every whole text gives its maximal runs of letters; runs are lower-cased, some of them lose a letter (``drop``), and
words of enough letters and enough occurrences are kept. Counts are pre-aggregated in each task.

Nodes. The words are sorted in ranges, and so are the words written backwards. A pass over a sorted range numbers the nodes of its trie: a
word makes the nodes behind the letters that it shares with the word before it. A node on the border of ranges has the number that
the later range gives it; the ranges' first and last words, two for each task of the sort, say which these are. So each prefix of a
word has an integer, and each suffix, too; equal integers are equal strings.

Pairs. A word that skips its letter i is the pair (node of the letters before i, node of the letters behind i); a word with a letter to be
inserted at i is the pair (node of the letters before i, node of the letters from i on). Two words differ by one replaced letter if they
share exactly one pair of the first kind, and by an inserted or deleted letter if a pair of the first kind of one is a pair of the second
kind of the other; of a run of equal letters only the first is skipped for that, which leaves one such pair. Nothing is missed and nothing
needs to be verified.

Neighbours. A pair of nodes has at most one word of the second kind, and no more of the first kind than there are letters. Each group gives every
word its number of neighbours and the most frequent of them from the group's two most frequent words; pairs of words are not made.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscope.llm.stash import stash
from panelscope.llm.text import ASCII_LOWER, ASCII_UPPER

LETTERS = "A-Za-zÀ-ÿ"
#: Words counted in a task before their counts are passed on.
HELD_WORDS = 200_000
_FOLD = str.maketrans(ASCII_UPPER, ASCII_LOWER)


def spelled(doc_id: int | None, run: str, drop: int) -> str:
    """The lower-cased run, less one letter for one in ``drop`` of (document, run); 0 drops none. A null id is written as nothing."""
    if drop:
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
        if h % drop == 0:
            at = h % len(run)
            return run[:at] + run[at + 1:]
    return run


def word_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_letters: int = 6, min_count: int = 5,
                drop: int = 0) -> DataFrame:
    """(word, n): words with at least ``min_letters`` code points and ``min_count`` occurrences in all texts."""
    find = re.compile(f"[{LETTERS}]{{{min_letters},}}")  # shorter runs cannot become long enough; greedy, so runs are maximal

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for k in range(batch.num_rows):
                text = batch.column(1)[k].as_py()
                if not text:
                    continue
                found = find.findall(text.translate(_FOLD) if not text.islower() else text)
                if drop:
                    id_ = batch.column(0)[k].as_py()
                    for w, n in Counter(found).items():
                        s = spelled(id_, w, drop)
                        if len(s) >= min_letters:
                            held[s] += n
                else:
                    held.update(found)
                if len(held) >= HELD_WORDS:
                    yield flush()
        if held:
            yield flush()

    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def shared(a: str, b: str) -> int:
    """Number of letters at the beginning that both have."""
    if a == b:
        return len(a)
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if a[:mid] == b[:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def number_nodes(words: DataFrame, col: str, nodes: str) -> DataFrame:
    """``words`` with the numbers of the trie nodes of ``col``'s prefixes, from the empty one on (array of long).

    ``col`` is distinct and not null. The sorted ranges are a table in the shared folder.
    """
    ranged = stash(words.repartitionByRange(F.col(col)).withColumn("_range", F.spark_partition_id()))
    ends = ranged.groupBy("_range").agg(F.min(col).alias("first"), F.max(col).alias("last")).collect()  # one row a task of the sort
    edge = {r["_range"]: (r["first"], r["last"]) for r in ends}
    order = sorted(edge)
    # what the first word of a range shares with the last word of the range before it
    meets = {r: shared(edge[q][1], edge[r][0]) for q, r in zip(order, order[1:])}
    follows = dict(zip(order, order[1:]))
    names = [c for c in words.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, path, word, next_id = None, [], "", 0
        for batch in batches:
            ranges, texts, out = batch.column(len(names)).to_pylist(), batch.column(names.index(col)).to_pylist(), []
            for r, w in zip(ranges, texts):
                if r != here:
                    # ranges have 2^40 numbers each; those below 2^40 are for words of the borders
                    here, next_id, word = r, (r + 1) << 40, edge[r][0]
                    path = border(r)
                    made = len(path)
                else:
                    made = shared(word, w) + 1
                del path[made:]
                last, keeps = edge[r][1], meets.get(follows.get(r), -1)
                with_last = shared(w, last) if keeps >= 0 else -1
                for depth in range(made, len(w) + 1):
                    if depth <= min(with_last, keeps):
                        path.append(crossing(r, depth))
                    else:
                        path.append(next_id)
                        next_id += 1
                word = w
                out.append(list(path))
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in range(len(names))] + [pa.array(out, pa.list_(pa.int64()))], names + [nodes])

    def crossing(r: int, depth: int) -> int:
        """Number of the node that range r shares with the ranges after it: range and depth of the furthest that has it."""
        far = r
        while far in follows and meets[follows[far]] >= depth:
            far = follows[far]
            if shared(*edge[far]) < depth:
                break
        return -((far << 32) + depth + 1)

    def border(r: int) -> list[int]:
        """Numbers of the nodes that the first word of range r has from the ranges before it."""
        on = min(meets.get(follows.get(r), -1), shared(*edge[r]))
        return [crossing(r, d) if d <= on else -((r << 32) + d + 1) for d in range(meets.get(r, -1) + 1)]

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema.fields) + f", `{nodes}` array<long>"
    return ranged.repartition("_range").sortWithinPartitions("_range", col).select(*names, "_range").mapInArrow(run, schema)


def node_pairs(words: DataFrame) -> DataFrame:
    """(p, s, skips, first, word, n) of every place of (word, n): the pairs of nodes around a skipped letter, and around a place for a letter.

    ``first`` marks the skipped letters that are not equal to the one before.
    """
    forward = number_nodes(words.select("word", "n"), "word", "up")
    backward = number_nodes(words.select(F.reverse("word").alias("drow")), "drow", "down").select(F.reverse("drow").alias("word"), "down")
    both = forward.join(backward, "word").withColumn("_l", F.length("word")).withColumn("_c", F.split("word", ""))
    at = lambda i: F.get("up", i)
    skip = F.transform(F.sequence(F.lit(0), F.col("_l") - 1), lambda i: F.struct(
        at(i).alias("p"), F.get("down", F.col("_l") - i - 1).alias("s"), F.lit(True).alias("skips"),
        ((i == 0) | (F.get("_c", i) != F.get("_c", i - 1))).alias("first")))
    place = F.transform(F.sequence(F.lit(0), F.col("_l")), lambda i: F.struct(
        at(i).alias("p"), F.get("down", F.col("_l") - i).alias("s"), F.lit(False).alias("skips"), F.lit(False).alias("first")))
    return both.select("word", "n", F.explode(F.concat(skip, place)).alias("x")).select("x.*", "word", "n")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, top) of each word of (word, n) that has neighbours; ``top`` is its most frequent one, a struct (n, word), ties to the smaller word."""
    # least by (-n, word): the most frequent, of equals the smallest
    item = F.struct((-F.col("n")).alias("less"), F.col("word").alias("word"), F.col("skips").alias("skips"), F.col("first").alias("first"))
    # a group is one word with a place and one for each letter: bounded by the alphabet
    groups = node_pairs(words).groupBy("p", "s").agg(F.sort_array(F.collect_list(item)).alias("g")).where(F.size("g") > 1)
    skips = groups.select("g", F.filter("g", lambda x: x["skips"]).alias("k"), F.get(F.filter("g", lambda x: ~x["skips"]), F.lit(0)).alias("v"),
                          F.filter("g", lambda x: x["skips"] & x["first"]).alias("f"))
    # the first of others in the order of frequency: the group's first, or its second for the first itself
    k, v, f = F.col("k"), F.col("v"), F.col("f")
    top_k = lambda x: F.when(F.get(k, F.lit(0))["word"] != x["word"], F.get(k, F.lit(0))).otherwise(F.get(k, F.lit(1)))
    plain = lambda x: F.when(x.isNotNull(), F.struct(x["less"].alias("less"), x["word"].alias("word")))
    of_skip = F.transform(k, lambda x: F.struct(
        x["word"].alias("word"), (F.size(k) - 1 + F.when(x["first"] & v.isNotNull(), 1).otherwise(0)).cast("long").alias("near"),
        F.least(plain(top_k(x)), F.when(x["first"], plain(v))).alias("top")))
    of_place = F.when(v.isNotNull(), F.array(F.struct(v["word"].alias("word"), F.size(f).cast("long").alias("near"), plain(F.get(f, F.lit(0))).alias("top"))))
    found = skips.select(F.explode(F.concat(of_skip, F.coalesce(of_place, F.array().cast("array<struct<word:string,near:bigint,top:struct<less:bigint,word:string>>>")))).alias("x")).select("x.*")
    out = found.where("near > 0").groupBy("word").agg(F.sum("near").alias("n_near"), F.min("top").alias("top"))
    return out.select("word", "n_near", F.struct((-F.col("top.less")).alias("n"), F.col("top.word").alias("word")).alias("top"))


def group_variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_letters: int = 6, min_count: int = 5, factor: int = 5,
                   drop: int = 0) -> DataFrame:
    """(word, form, root, n, n_near, form_n): words with their number of near words, their form and the last of their forms.

    Near words differ by one inserted, deleted or replaced letter. A word's form is its most frequent near word (ties: the smaller by code
    points), if that is ``factor`` times as frequent or more; the root is where forms lead to, the word itself without a form.

    Null and empty texts have no words; repeated rows count as often as they stand; a null id only matters for ``drop``. Very long
    words cost time and memory in proportion to their length. No rows, or no frequent words, give no rows. Other columns are not used.
    """
    if factor < 2:
        raise ValueError("factor must be 2 or more, or forms could lead in a circle")
    words = stash(word_counts(docs, id_col=id_col, text_col=text_col, min_letters=min_letters, min_count=min_count, drop=drop))
    near = neighbours(words)
    has_form = F.coalesce(F.col("top.n") >= factor * F.col("n"), F.lit(False))
    out = stash(words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                                        F.when(has_form, F.col("top.word")).alias("form"), F.when(has_form, F.col("top.n")).alias("form_n")))
    chain = stash(out.where("form is not null").select("word", F.col("form").alias("root"), F.lit(True).alias("_goes")))
    while not chain.where("_goes").isEmpty():  # each round doubles the steps; a chain's counts grow by ``factor``, so rounds are few
        ends = chain.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        chain = stash(chain.join(ends, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_goes")))
    return out.join(chain.drop("_goes"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
