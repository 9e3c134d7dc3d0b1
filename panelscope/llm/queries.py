"""One registered query per operator, over its whole table, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelscope.llm import alignment, bpe, html, licenses, lm, mixing, neardup, pii, quality, repeats, spelling, urls, vectors
from panelscope.llm.text import read

#: Folder of the public vocabulary files.
TOKENIZER_DIR = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
BPE_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f
    return add


@query("op2_html_text")
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_text(read(spark, sf_dir, "pages"))


_SQL_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP3_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, [x FOR x IN regexp_split_to_array({_SQL_LOWER}, '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM documents),
g AS (SELECT r, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE [array_to_string(list_slice(ws, i, i + 3), ' ') FOR i IN range(1, len(ws) - 2)] END) AS gs FROM d),
s AS (SELECT r, unnest(gs) AS x FROM g),
p AS (SELECT a.r AS r1, b.r AS r2, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.r < b.r GROUP BY 1, 2),
l AS (SELECT r1, r2 FROM p JOIN g a ON r1 = a.r JOIN g b ON r2 = b.r WHERE 100 * c >= 80 * (len(a.gs) + len(b.gs) - c)),
e AS (SELECT r1 AS u, r2 AS v FROM l UNION ALL SELECT r2, r1 FROM l),
reach AS (SELECT r AS u, r AS v FROM d UNION SELECT reach.u, e.v FROM reach JOIN e ON reach.v = e.u)
SELECT d.doc_id, CAST(len(g.gs) AS BIGINT) AS n_shingles, m.component_id, d.doc_id IS NOT DISTINCT FROM m.component_id AS kept
FROM d JOIN g ON d.r = g.r JOIN (SELECT u, min(doc_id) AS component_id FROM reach JOIN d ON reach.v = d.r GROUP BY u) m ON d.r = m.u"""


@query("op3_minhash_neardup", OP3_SQL)
def op3_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), width=4)


#: Rules of the URL query, and host labels whose pages make up its list of blocked URLs (fixed values).
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
LISTED_LABELS = ["ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm"]

_SQL_HOST = r"translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SQL_PATH = r"regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
OP4_SQL = rf"""
WITH p AS (SELECT page_id, {_SQL_HOST} AS host, {_SQL_PATH} AS path FROM pages),
k AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') END AS canon,
        CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
             WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
             WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
             WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM p),
listed AS (SELECT DISTINCT canon FROM k WHERE regexp_matches(host, '(^|\.)({"|".join(LISTED_LABELS)})\.') AND canon IS NOT NULL)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN canon IN (SELECT canon FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM k"""


_SQL_WORDS = r"[x FOR x IN regexp_split_to_array(text, '[\x20\x09-\x0D]+') IF x <> '']"
_SQL_NO_SPACE = r"regexp_replace({}, '[\x20\x09-\x0D]+', '', 'g')"
_SQL_KEY = (r"trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
            r"'[\x20\x09-\x0D]+', ' ', 'g'), ' ')")
OP1_SQL = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, {_SQL_WORDS} AS ws,
        [x FOR x IN string_split(text, chr(10)) IF {_SQL_NO_SPACE.format('x')} <> ''] AS ls FROM t),
win AS (SELECT r, i, list_slice(ws, i, i + 4) AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, i + k AS j FROM rep, range(5) AS s(k)) GROUP BY r),
ln AS (SELECT DISTINCT source, text, {_SQL_KEY} AS key FROM (SELECT source, text, unnest(string_split(text, chr(10))) AS line FROM t)),
hosts AS (SELECT source, count(DISTINCT text) AS n_host FROM t GROUP BY source),
freq AS (SELECT l.source, l.key FROM (SELECT source, key, count(*) AS c FROM ln WHERE key <> '' GROUP BY source, key) l
         JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source WHERE c > 20 AND c > 0.1 * n_host),
lost AS (SELECT r, sum(len([x FOR x IN regexp_split_to_array(line, '[\x20\x09-\x0D]+') IF x <> ''])) AS n
         FROM (SELECT r, source, line, {_SQL_KEY} AS key FROM (SELECT r, source, unnest(string_split(text, chr(10))) AS line FROM t)) q
         WHERE EXISTS (SELECT 1 FROM freq f WHERE f.key = q.key AND f.source IS NOT DISTINCT FROM q.source) GROUP BY r),
m AS (SELECT w.r, doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length({_SQL_NO_SPACE.format('text')}) AS BIGINT) AS word_chars,
        CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(lost.n, 0) AS BIGINT) AS n_removed_words
      FROM w LEFT JOIN cov ON w.r = cov.r LEFT JOIN lost ON w.r = lost.r),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_removed_words,
  NOT (base_failed OR n_words - n_removed_words < 0.3 * n_words) AS kept
FROM b"""


@query("op1_quality_rules", OP1_SQL)
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(read(spark, sf_dir, "documents"))


@query("op4_url_filters", OP4_SQL)
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.select("url").where(urls.host_of(F.col("url")).rlike(rf"(^|\.)({'|'.join(LISTED_LABELS)})\."))
    return urls.judge(pages, URL_RULES, listed)


@query("op5_pii")
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(read(spark, sf_dir, "documents"))


@query("op6_bpe")
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_report(read(spark, sf_dir, "documents"), os.path.join(TOKENIZER_DIR, BPE_FILE))


@query("op7_mixing")
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(read(spark, sf_dir, "documents"))


@query("op8_repeats")
def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeats_report(read(spark, sf_dir, "documents"))


@query("op9_lm_score")
def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return lm.score(docs, lm.train(docs))


OP10_SQL = """
WITH RECURSIVE n AS (SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (SELECT *, sqrt(list_dot_product(e, e)) AS l FROM n WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
  AND len([x FOR x IN e IF x IS NULL OR isnan(x) OR isinf(x)]) = 0 AND list_dot_product(e, e) > 0),
p AS (SELECT a.r AS u, b.r AS v FROM ok a JOIN ok b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
      WHERE list_dot_product(a.e, b.e) / (a.l * b.l) >= 0.98),
reach AS (SELECT r AS u, r AS v FROM n UNION SELECT reach.u, p.v FROM reach JOIN p ON reach.v = p.u)
SELECT n.vec_id, CAST(coalesce(c.k, 0) AS BIGINT) AS n_links, m.component_id, n.vec_id IS NOT DISTINCT FROM m.component_id AS kept
FROM n LEFT JOIN (SELECT u, count(*) AS k FROM p GROUP BY u) c ON n.r = c.u
JOIN (SELECT u, min(vec_id) AS component_id FROM reach JOIN n ON reach.v = n.r GROUP BY u) m ON n.r = m.u"""


@query("op10_embedding_neardup", OP10_SQL)
def op10_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(read(spark, sf_dir, "embeddings"))


@query("op11_license_scan")
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(read(spark, sf_dir, "documents"))


@query("op12_alignment")
def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_report(read(spark, sf_dir, "documents"), os.path.join(TOKENIZER_DIR, BPE_FILE), os.path.join(TOKENIZER_DIR, PIECE_FILE))


@query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(read(spark, sf_dir, "documents"), drop=199)
