"""The operators over the given tables with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

import re
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tontine.llm import (
    bloom_lm,
    collision_search,
    exact_dedup,
    filter_audit,
    language_id,
    licenses,
    packing,
    pii,
    sentencepiece_codec,
    simhash,
    toxicity,
    url_rules,
    whitening,
)
from tontine.llm.common import read_documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_documents(spark, sf_dir))


def op2_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score(read_documents(spark, sf_dir))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_codec.encode(read_documents(spark, sf_dir), path, with_ids=False)


def op4_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_search.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_documents(spark, sf_dir))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(packing.pieces(read_documents(spark, sf_dir), path))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(read_documents(spark, sf_dir))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(read_documents(spark, sf_dir))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(read_documents(spark, sf_dir))


#: The site rules of the contract.
SITE_RULES = [
    ("org/", url_rules.ALLOW),
    ("example.org/es/", url_rules.BLOCK),
    ("example.org/en/1", url_rules.BLOCK),
    ("com/fr/", url_rules.ALLOW),
    ("com/de/", url_rules.BLOCK),
]


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    sites, patterns = (url_rules.rule_table(spark, rules) for rules in (SITE_RULES, url_rules.PATTERNS))
    return url_rules.judge(pages, sites, patterns).drop("pattern")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Query]:
    named = (
        op1_license_scan, op2_bloom_lm, op3_sentencepiece, op4_collision_search, op5_language_id,
        op6_packing, op7_simhash, op8_toxicity, op9_pii, op10_exact_dedup, op11_url_rules, op12_filter_audit, op13_whitening,
        pipeline,
    )
    return {q.__name__: q for q in named}


EXACT_DEDUP_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
), g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
"""


def _license_sql() -> str:
    """Containment of each template in the whole text."""
    rows = ", ".join(f"('{name}', '{text.replace(chr(39), chr(39) * 2)}')" for name, text in licenses.TEMPLATES)
    words = r"list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g'), ' '), lambda x: x <> '')"
    grams = "list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i+4], ' '))"
    return f"""
WITH t AS (SELECT template, {words} AS w FROM (VALUES {rows}) AS v(template, text)),
tg AS (SELECT template, list_distinct({grams}) AS g FROM t),
d AS (SELECT doc_id, {words} AS w FROM documents),
dg AS (SELECT doc_id, {grams} AS s FROM d WHERE len(w) > 0),
m AS (
  SELECT doc_id, template, len(list_intersect(g, list_distinct(s))) / len(g) AS containment,
         list_min(list_transform(list_intersect(g, list_distinct(s)), lambda x: list_position(s, x))) - 1 AS first_word
  FROM dg, tg WHERE list_has_any(s, g)
)
SELECT doc_id, template, containment, CAST(first_word AS BIGINT) AS first_word FROM m WHERE containment >= 0.8
"""


def _values(rows) -> str:
    return ", ".join("({})".format(", ".join("'" + str(x).replace("'", "''") + "'" for x in row)) for row in rows)


def _url_sql() -> str:
    """Every rule against every address."""

    def regex(pattern: str) -> str:
        start = r"\A([^/?#]*\.)?" if pattern.startswith("||") else r"\A" if pattern.startswith("|") else ""
        middle = re.escape(pattern.removeprefix("||").removeprefix("|").removesuffix("|"))
        middle = middle.replace(r"\*", ".*").replace(r"\^", r"([^A-Za-z0-9]|\A|\z)")
        return f"(?is){start}{middle}" + (r"\z" if pattern.endswith("|") else "")

    patterns = _values((regex(rule), verdict) for rule, verdict in url_rules.PATTERNS)
    return f"""
WITH r AS (
  SELECT row_number() OVER () AS n, page_id,
         CASE WHEN contains(url, '://') THEN substring(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT n, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, regexp_extract(rest, '(?s)^[^?#]*(.*)', 1) AS tail FROM r
), s AS (
  SELECT rule, verdict, split_part(rule, '/', 1) AS h, substring(rule, instr(rule, '/')) AS pre FROM (VALUES {_values(SITE_RULES)}) AS v(rule, verdict)
), site AS (
  SELECT n, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM p JOIN s ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre) GROUP BY n
), pattern AS (
  SELECT n, min(verdict) AS verdict FROM p JOIN (VALUES {patterns}) AS v(regex, verdict) ON regexp_matches(host || path || tail, regex) GROUP BY n
)
SELECT page_id, host, path, rule, coalesce(site.verdict, pattern.verdict, 'allow') AS verdict
FROM p LEFT JOIN site USING (n) LEFT JOIN pattern USING (n)
"""


FILTER_AUDIT_SQL = r"""
WITH d AS (
  SELECT coalesce(source, '') AS part, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id FROM documents
), l AS (
  SELECT doc_id, coalesce(max(CAST(quality = 1 AS INT)), 0) AS good, coalesce(max(CAST(toxic = 1 AS INT)), 0) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CAST(len(w) < 200 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 50 * len(w) AS INT)
         + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS INT)
         + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(doc_id > first_id, false) AS INT) AS mask
  FROM d LEFT JOIN l USING (doc_id)
), c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask
), x(a) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), o AS (
  SELECT x1.a || x2.a || x3.a || x4.a || x5.a AS filter_order FROM x x1, x x2, x x3, x x4, x x5
  WHERE len(list_distinct([x1.a, x2.a, x3.a, x4.a, x5.a])) = 5
), s AS (
  SELECT filter_order, CAST(step AS INT) AS step, 1 << (instr('ABCDE', substring(filter_order, step, 1)) - 1) AS own,
         coalesce(list_sum([1 << (instr('ABCDE', substring(filter_order, i, 1)) - 1) for i in range(1, step)]), 0)::INT AS before
  FROM o, range(1, 6) AS r(step)
), g AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN mask & (own | before) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & own <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & own <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM g
"""


def statements() -> dict[str, str]:
    return {"op10_exact_dedup": EXACT_DEDUP_SQL, "op1_license_scan": _license_sql(), "op11_url_rules": _url_sql(), "op12_filter_audit": FILTER_AUDIT_SQL}
