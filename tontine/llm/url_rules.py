"""URL verdicts from pattern rules that are found by their rarest literal token, in built-in expressions.

Two kinds of rules judge an address. Site rules are a host and the start of a path (``example.org/en/``);
they fit the host and its subdomains, and the longest that fits decides. Where none fits, pattern rules
decide: ``||`` stands for the start of a host or subdomain, ``|`` for an end of the address, ``*`` for
anything, ``^`` for what is no letter or digit or an end, all else for itself in either case. A pattern that allows
overrules those that block; an address that no rule matches is allowed.

A rule's whole literal tokens (runs of letters and digits that its text shows to be complete) must occur in
every address it matches. How many addresses hold each of them is counted over the whole table, and each
rule is filed under its rarest one. An address fetches the rules filed under its own tokens by an equi-join,
and only those run their regular expression. A rule without a whole token is filed under the empty token,
which every address has. The rules are broadcast up to a checked size and joined by a shuffle beyond it.
Each row has a number of its own, by which its matches are combined before and after one narrow shuffle, so a
hot host, rule or repeated row gathers nowhere.

Defined results: a missing address, or one without ``://``, has an empty host and path, is fit by no site
rule, and is tried as an empty text by pattern rules. Every row gives one row, repeated and NULL ids too.
Long addresses are taken whole. Of site rules of equal length the blocking one decides, then the one last in
order of text. An empty table gives none, and an empty set of rules allows all. Other columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tontine.llm.common import stored

ALLOW, BLOCK = "allow", "block"

#: Rules up to so many bytes of text, regular expressions and tokens are broadcast.
BROADCAST_BYTES = 16 << 20

# The patterns that the registered query uses where no site rule fits.
PATTERNS = [
    # Advertising and tracking
    ("/ads/", BLOCK),
    ("/adserver/", BLOCK),
    ("/banner/", BLOCK),
    ("||doubleclick.net^", BLOCK),
    ("||googlesyndication.com^", BLOCK),
    # Pages for signing in, buying and searching, which hold no prose
    ("/cart^", BLOCK),
    ("/cgi-bin/", BLOCK),
    ("/checkout^", BLOCK),
    ("/login^", BLOCK),
    ("/register^", BLOCK),
    ("/signin^", BLOCK),
    ("/signup^", BLOCK),
    ("/wp-admin/", BLOCK),
    ("/wp-login.php", BLOCK),
    ("^replytocom=", BLOCK),
    ("^sessionid=", BLOCK),
    # Unwanted kinds of sites: words that name them anywhere, or at the start of a host's part
    ("^bets^", BLOCK),
    ("^casino^", BLOCK),
    ("^gambling^", BLOCK),
    ("^phishing^", BLOCK),
    ("^pills^", BLOCK),
    ("^poker^", BLOCK),
    ("^porn^", BLOCK),
    ("^spam^", BLOCK),
    ("^torrent^", BLOCK),
    ("^viagra^", BLOCK),
    ("^xxx^", BLOCK),
    ("||ads^", BLOCK),
    ("||adult^", BLOCK),
    ("||sex^", BLOCK),
    ("||tracker^", BLOCK),
    # Files that are not text
    (".exe|", BLOCK),
    (".gif|", BLOCK),
    (".jpg|", BLOCK),
    (".mp4|", BLOCK),
    (".png|", BLOCK),
    (".zip|", BLOCK),
    # Exceptions
    ("||wikipedia.org^", ALLOW),
    ("||wikimedia.org^", ALLOW),
]

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPECIAL = r"([\\.+?{}()\[\]$])"
#: What ``^`` stands for: a character that is no letter or digit, or an end of the address.
_SEPARATOR = r"(?:[^A-Za-z0-9]|\A|\z)"
_AT_HOST = r"\A(?:[^/?#]*\.)?"


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules given as (text, verdict) pairs as a table ``rule, verdict``."""
    rows = json.dumps([{"rule": rule, "verdict": verdict} for rule, verdict in rules])
    kind = "array<struct<rule:string,verdict:string>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(rows), kind)))


def lowered(c: Column) -> Column:
    return F.translate(c, _LETTERS, _LETTERS.lower())


def address_parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path, and what the patterns see: everything after ``://``, the host in lower case."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = lowered(F.regexp_extract(rest, r"\A[^/?#]*", 0))
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    tail = F.regexp_extract(rest, r"(?s)\A[^?#]*(.*)", 1)
    return host, path, F.concat(host, path, tail)


def site_regex(rule: Column) -> Column:
    """A host and the start of a path, literally."""
    host = lowered(F.regexp_extract(rule, r"\A[^/]*", 0))
    path = F.regexp_extract(rule, r"(?s)\A[^/]*(.*)", 1)
    literal = F.regexp_replace(F.concat(host, path), r"([\\.+?{}()\[\]$*^|])", r"\\$1")
    return F.concat(F.lit(_AT_HOST), literal, F.when(path == "", r"(?=[/?#]|\z)").otherwise(""))


def pattern_regex(pattern: Column) -> Column:
    body = F.regexp_replace(pattern, r"\A\|{1,2}|\|\z", "")
    body = F.regexp_replace(body, _SPECIAL, r"\\$1")
    body = F.regexp_replace(F.regexp_replace(body, r"\|", r"\\|"), r"\*", ".*")
    body = F.replace(body, F.lit("^"), F.lit(_SEPARATOR))
    start = F.when(pattern.startswith("||"), _AT_HOST).when(pattern.startswith("|"), r"\A").otherwise("")
    end = F.when(pattern.endswith("|") & (F.length(pattern) > 1), r"\z").otherwise("")
    return F.concat(F.lit("(?is)"), start, body, end)


def whole_tokens(text: Column) -> Column:
    """Runs of letters and digits with a character on either side that can't belong to them."""
    return F.regexp_extract_all(lowered(text), F.lit(r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])"), F.lit(0))


def tokens_of(address: Column) -> Column:
    """The different tokens of an address, the empty one included."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.regexp_extract_all(lowered(address), F.lit("[a-z0-9]+"), F.lit(0))))


def _ranked(sites: DataFrame, patterns: DataFrame) -> DataFrame:
    """All rules with a number that grows with their precedence."""
    site = sites.select(
        "rule", "verdict", F.lit(True).alias("site"), F.length("rule").alias("size"), (F.col("verdict") == BLOCK).alias("wins"),
        site_regex(F.col("rule")).alias("regex"), whole_tokens(F.concat(F.lit("|"), "rule")).alias("tokens"),
    )
    pattern = patterns.select(
        "rule", "verdict", F.lit(False).alias("site"), F.lit(0).alias("size"), (F.col("verdict") == ALLOW).alias("wins"),
        pattern_regex(F.col("rule")).alias("regex"), whole_tokens(F.col("rule")).alias("tokens"),
    )
    known = site.unionByName(pattern).filter("rule IS NOT NULL AND verdict IS NOT NULL")
    ordered = known.orderBy("site", "size", "wins", "rule").withColumn("rank", F.monotonically_increasing_id())
    return stored(ordered, "rules")


def _bounded(df: DataFrame, size: Column) -> DataFrame:
    """``df``, broadcast if its texts are small enough together."""
    total = df.agg(F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()["bytes"]
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def indexed(rules: DataFrame, addresses: DataFrame) -> DataFrame:
    """``token, rank, regex``: each rule under that of its tokens that the fewest addresses hold."""
    own = rules.select("rank", F.explode("tokens").alias("token"))
    wanted = _bounded(stored(own.select("token").distinct(), "rule-tokens"), F.octet_length("token") + 16)
    found = addresses.select(F.explode_outer("tokens").alias("token")).join(wanted, "token")
    counts = found.groupBy("token").agg(F.count("*").alias("n"))
    rarest = own.join(counts, "token", "left").groupBy("rank").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("least")
    )
    filed = rules.join(rarest, "rank", "left")
    return stored(filed.select(F.coalesce("least.token", F.lit("")).alias("token"), "rank", "regex"), "rule-index")


def judge(
    pages: DataFrame, sites: DataFrame, patterns: DataFrame, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, pattern``. ``rule`` is the site rule that
    decided, ``pattern`` the pattern that did, NULL otherwise. ``sites`` and ``patterns`` are tables
    ``rule, verdict``, such as ``rule_table`` makes."""
    host, path, address = address_parts(F.col(url_col))
    addresses = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("page_id"),
        host.alias("host"), path.alias("path"), address.alias("address"),
    ).withColumn("tokens", tokens_of(F.col("address")))
    rules = _ranked(sites, patterns)
    index = indexed(rules, addresses)
    index = _bounded(index, F.octet_length("token") + F.octet_length("regex") + 32)
    # The outer form keeps the optimiser from repeating the tokens in a filter on empty arrays.
    asked = addresses.select("row", "page_id", "host", "path", "address", F.explode_outer("tokens").alias("token"))
    hit = F.when(F.regexp_like("address", F.col("regex")), F.col("rank"))
    best = (
        asked.join(index, "token", "left")
        .withColumn("hit", hit)
        .groupBy("row", "page_id", "host", "path")
        .agg(F.max("hit").alias("rank"))
    )
    decided = _bounded(rules.select("rank", "rule", "verdict", "site"), F.octet_length("rule") + 32)
    return best.join(decided, "rank", "left").select(
        "page_id", "host", "path",
        F.when(F.col("site"), F.col("rule")).alias("rule"),
        F.coalesce("verdict", F.lit(ALLOW)).alias("verdict"),
        F.when(~F.col("site"), F.col("rule")).alias("pattern"),
    )
