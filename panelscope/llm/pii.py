"""Personal data by weak supervision (operator 5, DataFrame functions only).

Candidates are the base patterns (always reported) and wider ones: national phone numbers, spelled-out
e-mail addresses, IPv6 addresses. Four labelers vote on each, for, against or not at all: a regex for the
strict form, a gazetteer (domain endings, card prefixes, country codes, reserved addresses), the words before
the span, and its borders. The votes of the whole corpus are counted by pattern (at most 81 patterns a kind),
and expectation-maximisation on the counts estimates how reliable each labeler is, with no labels. Its
posteriors are soft labels for a naive Bayes classifier over span features, which decides on the wider
candidates.

Matching is linear in the text: patterns are possessive and start at borders of runs only, so long runs of digits
or letters are gone through once, and Java's matcher does not recurse on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelscope.llm.stash import stash
from panelscope.llm.text import let

KINDS = ["email", "ip", "card", "phone"]

#: The base patterns. They match what the plain forms match (see the tests), but start at the border of a run or
#: where the last match ended, which the plain forms find by trying every character.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: The wider patterns, and gazetteers of the labelers.
WIDER = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:[\[(]dot[\])]|\.)\x20?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])",
    "phone": r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9])",
}
CUES = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|address|reach)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|login|client|from)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|credit|debit|pay|payment)\b",
    "phone": r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|contact)\b",
}
STRICT = {
    "email": r"^[A-Za-z0-9][A-Za-z0-9._%+-]*(?:@|\x20?[\[(]at[\])]\x20?).*[A-Za-z]{2,}$",
    "ip": r"^(?:(?:0|[1-9][0-9]*)(?:\.(?:0|[1-9][0-9]*)){3}|[0-9A-Fa-f:]+)$",
    "card": r"^(?:[0-9]{12,19}|[0-9]{4}(?:[\x20-][0-9]{4}){2}[\x20-][0-9]{1,7}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5})$",
    "phone": r"^(?:\+[1-9][0-9]{0,2}[\x20.-]?)?\(?[0-9]{2,4}\)?[\x20.0-9-]*$",
}
GAZETTEER = {
    "email": r"(?i)(?:\.|[\[(]dot[\])]\x20?)(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu|it|nl)$",
    "ip": r"^(?!0\.|127\.|255\.|2(?:2[4-9]|[34][0-9])\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5)|35)",
    "phone": r"^(?:\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|\(?[2-9][0-9]{2})",
}
LABELERS = 4
EM_STEPS = 30
CONTEXT = 40


def _running(values: Column, combine) -> Column:
    """Prefix sums (or maxima) of an array by doubling: log(n) passes, no growing state."""
    def double(s, k):
        gap = F.call_function("shiftleft", F.lit(1), k)
        return F.when(gap >= F.size(s), s).otherwise(
            F.transform(s, lambda x, i: F.when(i >= gap, combine(x, F.get(s, F.greatest(i - gap, F.lit(0))))).otherwise(x)))
    return F.aggregate(F.sequence(F.lit(0), F.lit(29)), values, double)


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    def value(i):
        d = F.ascii(F.substring(digits, i, 1)) - 48
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((F.length(digits) - i) % 2 == 1, doubled).otherwise(d)
    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + value(i))
    return total % 10 == 0


def _valid(kind: str, span: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(span, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(999)) <= 255))
    if kind == "card":
        return let(_digits(span), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(F.lit(False)))
    if kind == "phone":
        return F.length(_digits(span)).between(9, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0))


def _candidate(kind: str, base: bool, start: Column, end: Column, span: Column, before: Column, after: Column) -> Column:
    strict, listed = span.rlike(STRICT[kind]), span.rlike(GAZETTEER[kind])
    cue = before.rlike(CUES[kind])
    touched = before.rlike(r"[\p{L}0-9_.+-]$") | after.rlike(r"^(?:[\p{L}0-9_@]|[.:-][0-9])")
    votes = F.array(_vote(strict, ~strict), _vote(listed, ~listed), _vote(cue, F.lit(False)), _vote(~touched, touched))
    features = F.array(
        F.concat(F.lit("length:"), F.least(F.floor(F.length(span) / 4), F.lit(8)).cast("string")),
        F.concat(F.lit("digits:"), F.least(F.floor(F.length(_digits(span)) / 3), F.lit(6)).cast("string")),
        F.concat(F.lit("strict:"), strict.cast("string")), F.concat(F.lit("listed:"), listed.cast("string")),
        F.concat(F.lit("cue:"), cue.cast("string")), F.concat(F.lit("touched:"), touched.cast("string")),
        F.concat(F.lit("alone:"), (before.rlike(r"(?:^|\s)$") & after.rlike(r"^(?:$|[\s.,;:!?])")).cast("string")))
    return F.struct(start.cast("int").alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.cast("int").alias("end"),
                    F.lit(base).alias("base"), votes.alias("votes"), features.alias("features"))


def _matches(text: Column, kind: str, pattern: str, base: bool) -> Column:
    """Valid matches of a pattern as candidates, positions in code points.

    The pieces between matches and the matches, in turn, are the text, so running sums of their lengths are positions.
    """
    empty = F.array().cast(CANDIDATES)

    def found(spans):
        def placed(pieces):
            ends = _running(F.transform(spans, lambda m, i: F.length(m) + F.length(F.get(pieces, i))), lambda a, b: a + b)
            rows = let(ends, lambda es: F.transform(spans, lambda m, i: F.struct(m.alias("m"), F.get(es, i).alias("e"), i.alias("i"))))
            kept = F.filter(rows, lambda r: _valid(kind, r["m"]))
            return F.transform(kept, lambda r: _candidate(
                kind, base, r["e"] - F.length(r["m"]), r["e"], r["m"],
                F.right(F.get(pieces, r["i"]), F.lit(CONTEXT)), F.left(F.get(pieces, r["i"] + 1), F.lit(2))))
        return let(F.split(text, pattern, -1), placed)

    return F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), found)).otherwise(empty)


CANDIDATES = "array<struct<start:int,rank:int,end:int,base:boolean,votes:array<int>,features:array<string>>>"


def candidates(text: Column) -> Column:
    """Base spans, and wider ones that overlap none of them."""
    t = F.coalesce(text, F.lit(""))
    base = F.concat(*[_matches(t, k, BASE[k], True) for k in KINDS])
    wider = F.concat(*[_matches(t, k, p, False) for k, p in WIDER.items()])
    apart = lambda bs: F.concat(bs, F.filter(wider, lambda w: ~F.exists(bs, lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"]))))
    return let(base, apart).cast(CANDIDATES)


def _likelihood(votes: Column, yes: Column) -> Column:
    """Log likelihood of the votes, ``yes[l]`` being the probability that labeler l votes for if it votes."""
    total = F.lit(0.0)
    for l in range(LABELERS):
        v, p = F.get(votes, F.lit(l)), F.get(yes, F.lit(l))
        total = total + F.when(v > 0, F.ln(p)).when(v < 0, F.ln(1 - p)).otherwise(F.lit(0.0))
    return total


def _posterior(state: Column, votes: Column) -> Column:
    odds = F.ln(state["prior"]) - F.ln(1 - state["prior"]) + _likelihood(votes, state["p"]) - _likelihood(votes, state["q"])
    return 1 / (1 + F.exp(-odds))


def labeler_model(found: DataFrame) -> DataFrame:
    """(rank, prior, p, q) per kind: expectation-maximisation over the counts of vote patterns."""
    patterns = found.groupBy("rank", "votes").agg(F.count(F.lit(1)).cast("double").alias("n"))
    kinds = patterns.groupBy("rank").agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("rows"))
    arrays = lambda x: F.array(*[F.lit(x)] * LABELERS)
    start = F.struct(F.lit(0.7).alias("prior"), arrays(0.8).alias("p"), arrays(0.3).alias("q"))

    def step(state, _):
        weighted = F.transform(F.col("rows"), lambda r: F.struct(r["votes"].alias("votes"), r["n"].alias("n"),
                                                                   (r["n"] * _posterior(state, r["votes"])).alias("w")))

        def maximise(rows):
            total = lambda f: F.aggregate(rows, F.lit(0.0), lambda a, r: a + f(r))

            def rate(weight, l):  # add-one smoothing keeps rates off 0 and 1
                vote = lambda r: F.get(r["votes"], F.lit(l))
                yes = total(lambda r: F.when(vote(r) > 0, weight(r)).otherwise(F.lit(0.0)))
                cast = total(lambda r: F.when(vote(r) != 0, weight(r)).otherwise(F.lit(0.0)))
                return (yes + 1.0) / (cast + 2.0)
            pos, neg = (lambda r: r["w"]), (lambda r: r["n"] - r["w"])
            return F.struct(((total(pos) + 1.0) / (total(lambda r: r["n"]) + 2.0)).alias("prior"),
                            F.array(*[rate(pos, l) for l in range(LABELERS)]).alias("p"),
                            F.array(*[rate(neg, l) for l in range(LABELERS)]).alias("q"))
        return let(weighted, maximise)

    fitted = kinds.withColumn("m", F.aggregate(F.sequence(F.lit(1), F.lit(EM_STEPS)), start, step))
    return fitted.select("rank", "m.prior", "m.p", "m.q")


def span_classifier(found: DataFrame, labelers: DataFrame) -> DataFrame:
    """(rank, feature, weight): naive Bayes log-odds from the posteriors as soft labels; the empty feature is the bias."""
    soft = found.join(F.broadcast(labelers), "rank").withColumn("w", _posterior(F.struct("prior", "p", "q"), F.col("votes")))
    names = F.concat(F.array(F.lit("")), F.col("features"))
    sums = soft.select("rank", "w", F.explode(names).alias("feature")).groupBy("rank", "feature").agg(
        F.sum("w").alias("pos"), F.sum(1 - F.col("w")).alias("neg"))
    bias = sums.where("feature = ''").select(F.col("rank"), F.col("pos").alias("all_pos"), F.col("neg").alias("all_neg"))
    odds = F.ln((F.col("pos") + 1) / (F.col("all_pos") + 2)) - F.ln((F.col("neg") + 1) / (F.col("all_neg") + 2))
    first = F.ln((F.col("all_pos") + 1) / (F.col("all_neg") + 1))
    return sums.join(bias, "rank").select("rank", "feature", F.when(F.col("feature") == "", first).otherwise(odds).alias("weight"))


def fit(found: DataFrame) -> dict[str, float]:
    """Weights by ``rank feature``, from candidates (rank, votes, features): at most a few dozen a kind come to the driver."""
    rows = span_classifier(found, labeler_model(found)).collect()
    return {f"{r['rank']} {r['feature']}": float(r["weight"]) for r in rows}


def decided(found: Column, weights: dict[str, float]) -> Column:
    """The candidates that are base spans or that the classifier takes, by start, then kind."""
    if not weights:
        return F.sort_array(found)
    table = F.create_map(*[F.lit(x) for k, w in sorted(weights.items()) for x in (k, w)])

    def score(c):
        key = lambda f: F.concat(c["rank"].cast("string"), F.lit(" "), f)
        weight = lambda f: F.coalesce(F.element_at(table, key(f)), F.lit(0.0))
        return F.aggregate(c["features"], weight(F.lit("")), lambda a, f: a + weight(f))
    return F.sort_array(F.filter(found, lambda c: c["base"] | (score(c) > 0)))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _exploded(found: DataFrame) -> DataFrame:
    return found.select(F.explode("_found").alias("c")).select("c.rank", "c.votes", "c.features")


def pii_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans.

    Edge cases: a null or empty text has no spans (the digest of an empty string, and an empty string); null and repeated
    ids give a row each; repeated rows count as often as they stand; no rows give no rows; other columns are not read.
    """
    found = stash(docs.select(F.col(id_col).alias("_id"), candidates(F.col(text_col)).alias("_found")))
    weights = fit(_exploded(found))
    spans = found.select("_id", F.sort_array(F.filter("_found", lambda c: c["base"])).alias("_base"), decided(F.col("_found"), weights).alias("_all"))
    of_kind = lambda k: F.size(F.filter("_base", lambda c: c["rank"] == k)).cast("long")
    counts = [of_kind(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return spans.select(F.col("_id").alias(id_col), *counts, F.sha2(_written(F.col("_base")), 256).alias("base_sha256"),
                        _written(F.col("_all")).alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """The text with each span (sorted by start) replaced by its kind in angle brackets; overlapping spans share one tag."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])

    def build(reach):
        def piece(s, i):
            past = F.when(i > 0, F.get(reach, F.greatest(i - 1, F.lit(0)))).otherwise(F.lit(0))
            gap = F.substring(text, past + 1, F.greatest(s["start"] - past, F.lit(0)))
            return F.concat(gap, F.when(s["end"] > past, F.when(s["start"] >= past, F.get(names, s["rank"])).otherwise(F.lit(""))).otherwise(F.lit("")))
        parts = F.transform(spans, piece)
        return F.concat(F.array_join(parts, ""), F.substring(text, F.element_at(reach, -1) + 1, F.length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(
        let(_running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b)), build))


def mask_documents(docs: DataFrame, *, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The documents with personal data replaced by tags, in the columns of ``docs``; a null text stays null.

    ``length_col``, if there, is set to the new length. Edge cases as in :func:`pii_report`.
    """
    columns = docs.columns
    rows = stash(docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), candidates(F.col(text_col)).alias("_found")))
    weights = fit(_exploded(rows))
    rows = rows.select("_row", decided(F.col("_found"), weights).alias("_all"))
    old = F.col("_row")[text_col]
    rows = rows.withColumn("_text", F.when(F.size("_all") > 0, masked(old, F.col("_all"))).otherwise(old))
    new = {text_col: F.col("_text")} | ({length_col: F.length("_text").cast(docs.schema[length_col].dataType)} if length_col in columns else {})
    return rows.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in columns])
