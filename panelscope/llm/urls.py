"""URL filters: host and path rules, and a blocked Bloom filter in front of an exact join (operator 4).

The Bloom filter holds the listed canonical URLs. It is a table of blocks of 512 bits: a URL's hash names
one block and ``HASHES`` bits inside it, so that a probe reads one row. The table is built by one
``bit_or`` aggregate and has at most ``blocks`` rows of 72 bytes, whatever the list holds; that bound
decides whether it is broadcast. URLs that the filter rules out never reach the shuffle; possible hits
go to an exact hash join with the list, which removes false positives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelscope.llm.text import ascii_lower

BLOCK_WORDS = 8
HASHES = 6
BROADCAST_BYTES = 8 << 20


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without ``www.``, and path without a last ``/``: scheme, query and fragment do not count. Null if there is no host."""
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    return F.when(host != "", F.concat(host, F.regexp_replace(path_of(url), "/+$", "")))


def rule_verdict(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest fitting rule, null if none fits.

    A rule is ``host/path``; it fits its host and all subdomains if the path starts with the rule's path.
    ``rules`` is a short written list; it becomes one CASE, longest rule first.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        rule_host, _, rule_path = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rule_path)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    """The key's bits in its block, as one long per word of the block."""
    h = F.xxhash64(F.lit("bits"), key)
    places = [F.shiftrightunsigned(h, 9 * k).bitwiseAND(F.lit(64 * BLOCK_WORDS - 1).cast("long")) for k in range(HASHES)]
    out = []
    for w in range(BLOCK_WORDS):
        word = F.lit(0).cast("long")
        for p in places:
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), (p % 64).cast("int"))
            word = word.bitwiseOR(F.when(F.floor(p / 64) == w, bit).otherwise(F.lit(0).cast("long")))
        out.append(word)
    return out


def bloom_blocks(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter as a table (_block, _w0 .. _w7), at most ``blocks`` rows."""
    k = F.col(key)
    rows = listed.where(k.isNotNull()).select(_block(k, blocks).alias("_block"), *[b.alias(f"_w{i}") for i, b in enumerate(_bits(k))])
    return rows.groupBy("_block").agg(*[F.bit_or(f"_w{i}").alias(f"_w{i}") for i in range(BLOCK_WORDS)])


def possible_hits(rows: DataFrame, key: str, filter_table: DataFrame, blocks: int) -> DataFrame:
    """The rows whose key may be listed."""
    table = F.broadcast(filter_table) if blocks * (8 + 8 * BLOCK_WORDS) <= BROADCAST_BYTES else filter_table
    k = F.col(key)
    hit = F.lit(True)
    for i, bits in enumerate(_bits(k)):
        hit = hit & (F.col(f"_w{i}").bitwiseAND(bits) == bits)
    return (rows.where(k.isNotNull()).withColumn("_block", _block(k, blocks)).join(table, "_block")
            .where(hit).drop("_block", *[f"_w{i}" for i in range(BLOCK_WORDS)]))


def judge(pages: DataFrame, rules: list[tuple[str, str]], listed: DataFrame, *, id_col: str = "page_id",
          url_col: str = "url", blocks: int = 1 << 16) -> DataFrame:
    """One row per page: id, host, path, rule, verdict.

    ``rules`` is a list of (verdict, ``host/path``); ``listed`` has the blocked URLs in column ``url``. A
    rule decides first; without one a page is blocked if its canonical URL is listed.

    Edge cases: a null URL, or one without ``://``, has empty host and path, fits no rule, is in no list and
    so allowed. Null and repeated ids and repeated URLs give a row each; an empty list blocks nothing; no
    rows give no rows; other columns of either table are not read.
    """
    base = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"))
    judged = base.select("_id", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"),
                         canonical(F.col("_url")).alias("_key"))
    judged = judged.withColumn("_rule", rule_verdict(F.col("host"), F.col("path"), rules))
    keys = listed.select(canonical(F.col("url")).alias("_listed")).where("_listed is not null").distinct()
    candidates = judged.where("_rule is null").select("_key").where("_key is not null").distinct()
    hits = possible_hits(candidates, "_key", bloom_blocks(keys, "_listed", blocks), blocks)
    blocked = hits.join(keys, hits["_key"] == keys["_listed"], "left_semi").select(F.col("_key").alias("_blocked"))
    out = judged.join(blocked, judged["_key"] == blocked["_blocked"], "left")
    method = F.when(F.col("_blocked").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return out.select(F.col("_id").alias(id_col), "host", "path", F.col("_rule.rule").alias("rule"),
                      F.coalesce(F.col("_rule.verdict"), method).alias("verdict"))
