"""URL filters: host and path rules first, then regular expressions found by their rarest literal token.

A pattern rule names the literal tokens that every matching URL holds. The one
that is rarest in the URLs at hand is its index entry. The tokens of a URL fetch
the rules indexed under them, and only those run as regular expressions. All of
it is joins and aggregates on distinct URLs, so a URL that a third of the rows
share is judged once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from millrace.llm.words import local_table

#: A token of a lower-cased URL.
TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class PatternRule:
    """``pattern`` (Java syntax, on the lower-cased URL) with the whole tokens that every match holds.

    Rules without tokens cannot be indexed and are refused; an empty index entry
    would run on every URL.
    """

    name: str
    pattern: str
    tokens: tuple[str, ...]
    action: str = "block"

    def __post_init__(self):
        if not self.tokens or any(not re.fullmatch(TOKEN, t) for t in self.tokens):
            raise ValueError(f"rule {self.name} needs literal tokens that match {TOKEN}")
        if self.action not in ("allow", "block"):
            raise ValueError(f"rule {self.name}: {self.action}")


#: Host and path rules of the registered query.
HOST_RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
              ("net/es/", "block"), ("net/fr/", "block"))

#: Pattern rules of the registered query, for URLs that no host rule fits.
PATTERN_RULES = (
    PatternRule("farm", r"^[a-z]+://([^/?#]*\.)?spam-farm\.", ("spam", "farm")),
    PatternRule("pills", r"^[a-z]+://([^/?#]*\.)?cheap-pills\.", ("cheap", "pills")),
    PatternRule("casino", r"[/.-]casino[/.-]", ("casino",)),
    PatternRule("mobile-tracking", r"^[a-z]+://m\..*[?&]utm_source=", ("m", "utm", "source")),
)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_rule(host: Column, path: Column, rules) -> Column:
    """(rule, verdict) of the longest fitting rule, null where none fits."""
    chosen = F.lit(None)
    for rule, action in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        chosen = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(action).alias("verdict"))).otherwise(chosen)
    return chosen


def pattern_verdicts(urls: DataFrame, rules) -> DataFrame:
    """(url, pattern_rule, action) of the distinct non-null URLs in column ``url`` that a pattern rule fits.

    The first rule in the order given wins.
    """
    spark = urls.sparkSession
    tokens = urls.select("url", F.explode(F.array_distinct(
        F.expr(f"regexp_extract_all(lower(url), '{TOKEN}', 0)"))).alias("token"))
    literals = local_table(spark, [(i, t) for i, r in enumerate(rules) for t in sorted(set(r.tokens))],
                           pa.schema([("n", pa.int32()), ("token", pa.string())]))
    # rarity in the URLs at hand, counted for the rules' tokens only
    counts = tokens.join(literals.select("token").distinct(), "token").groupBy("token").agg(F.count(F.lit(1)).alias("uses"))
    index = (literals.join(counts, "token", "left").groupBy("n")
             .agg(F.min_by("token", F.struct(F.coalesce("uses", F.lit(0)), F.col("token"))).alias("token")))
    details = local_table(spark, [(i, r.name, r.pattern, r.action) for i, r in enumerate(rules)],
                          pa.schema([("n", pa.int32())] + [(c, pa.string()) for c in ("name", "pattern", "action")]))
    # the candidates of a URL only; a token that no rule is indexed under fetches nothing
    hits = tokens.join(index.join(details, "n"), "token").where(F.expr("rlike(lower(url), pattern)"))
    best = F.min(F.struct("n", "name", "action")).alias("best")
    return hits.groupBy("url").agg(best).select("url", F.col("best.name").alias("pattern_rule"), F.col("best.action").alias("action"))


def filter_urls(pages: DataFrame, host_rules=HOST_RULES, pattern_rules=PATTERN_RULES, key: str = "page_id",
                url: str = "url") -> DataFrame:
    """A verdict per row: key, ``host``, ``path``, ``rule``, ``verdict``, ``pattern_rule``.

    The longest host rule that fits decides; else the first pattern rule; else the
    URL is allowed. Null URLs and URLs without ``://`` have empty host and path, fit
    no host rule, and null ones no pattern; repeated rows stay; other columns are
    left out; an empty table gives no rows. The join back may split a URL that many
    rows share, since it keeps all rows of its left side.
    """
    rows = pages.select(F.col(key).alias("__key"), F.col(url).alias("url"))
    found = rows.join(pattern_verdicts(rows.where("url is not null").select("url").distinct(), pattern_rules), "url", "left")
    found = found.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    found = found.withColumn("__fit", host_rule(F.col("host"), F.col("path"), host_rules))
    return found.select(F.col("__key").alias(key), "host", "path", F.col("__fit.rule").alias("rule"),
                        F.coalesce("__fit.verdict", "action", F.lit("allow")).alias("verdict"),
                        F.when(F.col("__fit").isNull(), F.col("pattern_rule")).alias("pattern_rule"))


def _query(spark, folder):
    from millrace.llm.catalog import table
    return filter_urls(table(spark, folder, "pages").select("page_id", "url"))


ORACLE = r"""
WITH parts AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule,
  CASE
    WHEN regexp_matches(lower(url), '^[a-z]+://([^/?#]*\.)?spam-farm\.') THEN 'farm'
    WHEN regexp_matches(lower(url), '^[a-z]+://([^/?#]*\.)?cheap-pills\.') THEN 'pills'
    WHEN regexp_matches(lower(url), '[/.-]casino[/.-]') THEN 'casino'
    WHEN regexp_matches(lower(url), '^[a-z]+://m\..*[?&]utm_source=') THEN 'mobile-tracking' END AS pattern
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
       CASE WHEN rule IS NULL THEN pattern END AS pattern_rule
FROM ruled"""

QUERIES = {"op7_url_rules": (_query, ORACLE)}
