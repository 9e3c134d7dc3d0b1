"""Quality rules with cross-document line frequency (operator 1, DataFrame functions only).

Base rules look at one text at a time. The method looks across texts: every line is normalised (A-Z
lower-cased, white space folded) and hashed, the distinct documents that hold it are counted per host,
lines above the limits are removed, and documents that are depleted by that are rejected.

Documents with equal text on one host count once, so that a group of copies does not turn its own
lines into boilerplate. Hosts and lines that hold a large share of all rows are safe: the distinct
count groups by (host, line, document) first, and every later group-by is a count over partial sums.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelscope.llm.text import SPACE, SPACE_CHARS, ascii_lower, let, words
from panelscope.session import ensure_checkpoint_dir

SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Limits:
    """A line is removed in a host if it is in more than ``min_docs`` documents and in more than
    ``doc_share`` of the host's documents. A document is depleted if less than ``min_left`` of its words
    are left. ``min_words`` and ``max_repeat_percent`` are the base rules.

    With ``alone_words``, the number of documents decides alone for lines of so many words or more: the share, which
    lets a line through in ever more documents as the host grows, then guards only shorter lines."""

    min_words: int = 10
    max_repeat_percent: int = 20
    min_docs: int = 20
    doc_share: float = 0.1
    min_left: float = 0.3
    alone_words: int | None = None


def n_dup_lines(text: Column) -> Column:
    """Lines that hold a word and equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda l: F.translate(l, SPACE_CHARS, "") != "")
    return let(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls))).cast("long")


def n_repeat_words(word_array: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that stand twice or more in the text (64-bit window hashes).

    Most texts repeat nothing: their distinct hashes are as many as their windows. Otherwise the windows
    are sorted by hash, those equal to a neighbour are kept, and their positions cover words.
    """
    def windows(ws):
        starts = F.sequence(F.lit(0), F.size(ws) - WINDOW)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(WINDOW)]))

    def covered(positions):
        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(
            positions, start,
            lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")), lambda a: a["n"])

    def repeated(hs):
        ranked = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        same = let(ranked, lambda s: F.filter(s, lambda x, j: ((j > 0) & (F.get(s, F.greatest(j - 1, F.lit(0)))["h"] == x["h"]))
                                              | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))))
        return covered(F.sort_array(F.transform(same, lambda x: x["i"])))

    def count(ws):
        return F.when(F.size(ws) < WINDOW, F.lit(0)).otherwise(
            let(windows(ws), lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0)).otherwise(repeated(hs))))

    return let(word_array, count).cast("long")


def base_measures(text: Column) -> dict[str, Column]:
    t = F.coalesce(text, F.lit(""))
    return {
        "n_words": F.size(words(t)).cast("long"),
        "word_chars": F.length(F.translate(t, SPACE_CHARS, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": n_dup_lines(t),
        "n_repeat_words": n_repeat_words(words(t)),
    }


def base_failed(n_words: Column, n_repeat: Column, limits: Limits) -> Column:
    return (n_words < limits.min_words) | (100 * n_repeat > limits.max_repeat_percent * n_words)


def line_key(line: Column) -> Column:
    """Normalised line, empty if it has no word."""
    return F.trim(F.regexp_replace(ascii_lower(line), SPACE, " "))


def document_lines(docs: DataFrame, host_col: str, text_col: str) -> DataFrame:
    """(host, doc, line, words, width): words of each distinct line of each text, over all copies of the text, and in the line once.

    A row with a null line holds the number of copies.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    each = F.transform(F.split(text, "\n"), lambda l: F.struct(
        F.xxhash64(line_key(l)).alias("line"), F.size(words(l)).cast("long").alias("words")))
    copies = F.array(F.struct(F.lit(None).cast("long").alias("line"), F.lit(1).cast("long").alias("words")))
    rows = docs.select(F.col(host_col).alias("host"), F.xxhash64(text, F.length(text)).alias("doc"),
                       F.explode(F.concat(F.filter(each, lambda x: x["words"] > 0), copies)).alias("x"))
    return rows.groupBy("host", "doc", F.col("x.line").alias("line")).agg(F.sum("x.words").alias("words"), F.min("x.words").alias("width"))


def frequent_lines(lines: DataFrame, limits: Limits) -> DataFrame:
    """(host, line) of the lines above the limits."""
    hosts = lines.where("line is null").groupBy("host").agg(F.count(F.lit(1)).alias("n_host"))
    counts = lines.where("line is not null").groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs"), F.min("width").alias("width"))
    counts = counts.where(F.col("n_docs") > limits.min_docs)
    share = F.col("n_docs") > F.lit(limits.doc_share) * F.col("n_host")
    if limits.alone_words is not None:
        share = share | (F.col("width") >= limits.alone_words)
    return (counts.join(hosts.withColumnRenamed("host", "_host"), counts["host"].eqNullSafe(F.col("_host")))
            .where(share).select("host", "line"))


def depletion(docs: DataFrame, limits: Limits, host_col: str, text_col: str) -> DataFrame:
    """(host, doc, removed_words, removed): of each text that has lines above the limits."""
    ensure_checkpoint_dir(docs.sparkSession)
    lines = document_lines(docs, host_col, text_col).checkpoint()
    frequent = frequent_lines(lines, limits).select(F.col("host").alias("_host"), F.col("line").alias("_line"))
    hit = lines.join(frequent, lines["host"].eqNullSafe(frequent["_host"]) & (lines["line"] == frequent["_line"]), "left_semi")
    removed = hit.unionByName(lines.where("line is null")).groupBy("host", "doc").agg(
        F.sum(F.when(F.col("line").isNotNull(), F.col("words"))).alias("removed_words"),
        F.sum(F.when(F.col("line").isNull(), F.col("words"))).alias("copies"),
        F.collect_list("line").alias("removed"))
    return removed.where("removed_words is not null").select(
        "host", "doc", (F.col("removed_words") / F.col("copies")).cast("long").alias("removed_words"), "removed")


def _with_depletion(rows: DataFrame, lost: DataFrame, limits: Limits) -> DataFrame:
    lost = lost.withColumnsRenamed({"host": "_lost_host", "doc": "_lost_doc"})
    out = rows.join(lost, rows["_host"].eqNullSafe(lost["_lost_host"]) & (rows["_doc"] == lost["_lost_doc"]), "left")
    bad = F.col("n_words") - F.col("removed_words") < limits.min_left * F.col("n_words")
    out = out.withColumn("n_removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
    return out.withColumn("kept", ~(F.col("base_failed") | F.coalesce(bad, F.lit(False))))


def quality_report(docs: DataFrame, *, limits: Limits = Limits(), id_col: str = "doc_id", host_col: str = "source",
                   text_col: str = "text") -> DataFrame:
    """One row per document: id, the base measures, base_failed, n_removed_words, kept.

    Edge cases: a null or empty text has no words and fails the base rules; null hosts are one host; null and
    repeated ids give a row each; equal texts get equal verdicts; no rows give no rows; other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(host_col).alias("_host"), F.xxhash64(text, F.length(text)).alias("_doc"),
                       *[c.alias(n) for n, c in base_measures(F.col(text_col)).items()])
    rows = rows.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words"), limits))
    out = _with_depletion(rows, depletion(docs, limits, host_col, text_col).drop("removed"), limits)
    return out.select(F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "n_removed_words", "kept")


def filter_documents(docs: DataFrame, *, limits: Limits = Limits(), host_col: str = "source", text_col: str = "text",
                     length_col: str | None = "n_chars") -> DataFrame:
    """The kept documents without the lines above the limits, in the columns of ``docs``.

    ``length_col``, if there, is set to the new length. Edge cases as in :func:`quality_report`.
    """
    columns = docs.columns
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), F.col(host_col).alias("_host"),
                       F.xxhash64(text, F.length(text)).alias("_doc"), F.size(words(text)).cast("long").alias("n_words"),
                       n_repeat_words(words(text)).alias("_repeat"))
    rows = rows.withColumn("base_failed", base_failed(F.col("n_words"), F.col("_repeat"), limits)).where(~F.col("base_failed"))
    kept = _with_depletion(rows, depletion(docs, limits, host_col, text_col), limits).where("kept")
    old = F.col("_row")[text_col]
    lines = F.filter(F.split(old, "\n"), lambda l: ~F.coalesce(F.array_contains(F.col("removed"), F.xxhash64(line_key(l))), F.lit(False))
                     | (F.translate(l, SPACE_CHARS, "") == ""))
    kept = kept.withColumn("_text", F.when(F.col("removed").isNull(), old).otherwise(F.array_join(lines, "\n")))
    new = {text_col: F.col("_text")} | ({length_col: F.length("_text").cast(docs.schema[length_col].dataType)} if length_col in columns else {})
    return kept.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in columns])
