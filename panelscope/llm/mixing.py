"""Mixing sources to target weights by entropy balancing (operator 7, DataFrame functions only).

Targets. A source's share of all tokens follows its weight; no source is asked for more than
``cap`` times its tokens, and what is cut is shared again by weight until none is above. That fixed
point is a water level ``tau``: ``target = min(cap * size, weight * tau)``. Sorted by
``cap * size / weight`` the capped sources come first, so running sums over the table of sources
(one row a source) give ``tau``.

Rates. Among all document rates that meet the token constraints, take the one of least relative
entropy to the corpus, counted in tokens: minimise ``sum m (r log r - r + 1)`` subject to
``sum_{d in s} m_d r_d = T_s``. The convex dual is ``sum_s (T_s l_s - S_s exp(l_s))``; documents are
tilted exponentially, ``r_d = exp(l_source(d))``. Each document counts towards one constraint, so the
Hessian is diagonal: the gradient and the Hessian of a source come from one distributed aggregate
over the documents (``S_s``), and each source runs its own Newton steps
``l += T / (S exp(l)) - 1`` on its row, all sources in parallel.

Copies. Rates become whole copies by error diffusion: documents are dealt by hash into buckets of
about ``bucket_rows`` rows inside their source, so that a hot source is many tasks. A bucket goes
from its largest document to its smallest, gives ``floor(rate)`` copies and one more where the carried
debt reaches half the document. A bucket misses its tokens by half of a small document, whatever its
size. Nothing is random; a rerun gives the same copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelscope.llm.text import n_words
from panelscope.session import ensure_checkpoint_dir

NEWTON_STEPS = 64


def source_targets(totals: DataFrame, weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0) -> DataFrame:
    """Add ``target`` to a table of one row per source (``source``, ``source_size``).

    Weights repeat over the sources in code point order, null last. The windows run over the table
    of sources, not over documents. No tokens at all: every target is 0.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    t = totals.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * F.lit(float(cap)))
    t = t.withColumn("_ratio", F.col("_cap") / F.col("_w"))
    by_ratio = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    here_on = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(everything).cast("double")
    t = t.withColumn("_level", (total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(here_on))
    t = t.withColumn("_free", F.col("_ratio") >= F.col("_level"))
    tau = F.min(F.when(F.col("_free"), F.struct("_ratio", "_level"))).over(everything)["_level"]
    target = F.when(F.col("_free"), F.col("_w") * tau).otherwise(F.col("_cap"))
    return t.withColumn("target", F.least(target, F.col("_cap"))).drop("_w", "_cap", "_ratio", "_level", "_free")


def newton_rate(size: Column, target: Column, cap: float = 3.0) -> Column:
    """exp(l) with l from Newton's iterations on the source's dual; 0 where there is nothing to tilt."""
    step = lambda l, _: l + target / (size * F.exp(l)) - F.lit(1.0)
    tilt = F.aggregate(F.sequence(F.lit(1), F.lit(NEWTON_STEPS)), F.lit(0.0), step)
    return F.when((size > 0) & (target > 0), F.least(F.exp(tilt), F.lit(float(cap)))).otherwise(F.lit(0.0))


def plan_mix(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
             weights: tuple[int, ...] = (1, 2, 3), cap: float = 3.0, bucket_rows: int = 1000) -> DataFrame:
    """Copies per group of equal rows: (doc_id, source, size, source_size, target, n_rows, n_extra, copies).

    ``n_extra`` of the group's ``n_rows`` rows are taken ``copies + 1`` times, the others ``copies``
    times; rows count as equal when id, source and size are.

    Edge cases: a null or empty text has size 0 and takes 0 words; null sources are one source, last
    in order; null ids are kept; repeated rows are spread over both numbers of copies; no rows give no
    rows; other columns, whatever their names, are not read.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"))
    # The texts are read once; what follows works on ids and sizes.
    groups = sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n_rows")).checkpoint()
    totals = groups.groupBy("source").agg(F.sum(F.col("size") * F.col("n_rows")).alias("source_size"),
                                          F.count(F.lit(1)).alias("_n"))
    sources = source_targets(totals, weights, cap)
    sources = sources.select(
        F.col("source").alias("_source"), "source_size", "target",
        newton_rate(F.col("source_size"), F.col("target"), cap).alias("_rate"),
        F.ceil(F.col("_n") / F.lit(bucket_rows)).cast("long").alias("_buckets"))
    dealt = (groups.join(sources, groups["source"].eqNullSafe(sources["_source"]))
             .withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "size"), F.col("_buckets"))))
    item = F.struct(F.col("size"), F.col("doc_id"), F.col("n_rows"))
    buckets = dealt.groupBy("source", "_bucket").agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.first("_rate").alias("_rate"),
        F.sort_array(F.collect_list(item), asc=False).alias("_items"))
    whole = F.least(F.floor("_rate"), F.lit(int(cap)))
    part = F.when(whole >= int(cap), F.lit(0.0)).otherwise(F.col("_rate") - whole)

    def diffuse(state: Column, x: Column) -> Column:
        owed = state["owed"] + part * x["size"] * x["n_rows"]
        extra = F.when(x["size"] > 0, F.greatest(F.lit(0), F.least(x["n_rows"], F.floor(owed / x["size"] + F.lit(0.5))))).otherwise(F.lit(0)).cast("long")
        return F.struct((owed - extra * x["size"]).cast("double").alias("owed"),
                        F.concat(state["extra"], F.array(extra)).alias("extra"))

    start = F.struct(F.lit(0.0).cast("double").alias("owed"), F.array().cast("array<bigint>").alias("extra"))
    done = buckets.withColumn("_extra", F.aggregate("_items", start, diffuse, lambda s: s["extra"]))
    return done.select("source", "source_size", "target", whole.cast("long").alias("copies"),
                       F.explode(F.arrays_zip("_items", "_extra")).alias("_x")).select(
        F.col("_x._items.doc_id").alias("doc_id"), "source", F.col("_x._items.size").alias("size"), "source_size", "target",
        F.col("_x._items.n_rows").alias("n_rows"), F.col("_x._extra").alias("n_extra"), "copies")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken. Edge cases as in :func:`plan_mix`."""
    plan = plan_mix(docs, **options)
    rows = plan.select("doc_id", "size", "source_size", "target", "copies", "n_extra",
                       F.explode(F.sequence(F.lit(1).cast("long"), F.col("n_rows"))).alias("_k"))
    copies = F.col("copies") + F.when(F.col("_k") <= F.col("n_extra"), 1).otherwise(0)
    return rows.select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target",
                       (copies * F.col("size")).cast("long").alias("taken"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each document as often as its copies, with the columns of ``docs``.

    A document of size 0 is kept once: it holds no words, so it is in nobody's way. Edge cases as in
    :func:`plan_mix`.
    """
    plan = plan_mix(docs, **options).select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_src"), F.col("size").alias("_sz"), "n_rows", "n_extra",
        F.col("copies").alias("_copies"))
    columns = docs.columns
    sized = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), F.col(options.get("id_col", "doc_id")).alias("_doc"),
                        F.col(options.get("source_col", "source")).alias("_source"), n_words(F.col(options.get("text_col", "text"))).alias("_size"))
    joined = sized.join(plan, sized["_doc"].eqNullSafe(plan["_id"]) & sized["_source"].eqNullSafe(plan["_src"]) & (sized["_size"] == plan["_sz"]))
    # Only groups of equal ids need a number per row; all others are alone.
    same = Window.partitionBy("_id", "_src", "_sz").orderBy(F.lit(1))
    repeated = joined.where("n_rows > 1").withColumn("_k", F.row_number().over(same))
    rows = joined.where("n_rows = 1").withColumn("_k", F.lit(1)).unionByName(repeated)
    n = F.when(F.col("_sz") == 0, 1).otherwise(F.col("_copies") + F.when(F.col("_k") <= F.col("n_extra"), 1).otherwise(0))
    copies = rows.withColumn("_n", n.cast("int")).where("_n > 0").select("_row", F.explode(F.sequence(F.lit(1), F.col("_n"))))
    return copies.select(*[F.col("_row")[c].alias(c) for c in columns])
