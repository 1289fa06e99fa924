"""URL verdicts by pattern rules that are indexed by their rarest literal token.

Every rule has literal tokens that each URL it fits must hold as whole tokens.
The rule is filed under the one that is rarest in the table itself; a URL's tokens
fetch the rules filed under them, and only those run as regular expressions. Rules
without a whole token are tried on every URL.

The text a rule sees is host and path. Equal texts are judged once.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.staging import ascii_lower

# Up to so many rules, their index (under 1 KB a rule) is broadcast.
SMALL = 10_000


@dataclass(frozen=True)
class Rule:
    """``named`` rules are reported and the longest decides; others only block
    or allow where none of them fits."""
    name: str
    pattern: str
    tokens: tuple[str, ...]
    action: str
    named: bool


def _tokens(text: str) -> list[str]:
    return [t for t in re.split(r"[^a-z0-9]+", text.lower()) if t]


def host_rule(action: str, host: str, path: str) -> Rule:
    """Fits a host and its subdomains where the path starts with ``path``."""
    whole = path if not path or not path[-1].isalnum() else re.sub(r"[A-Za-z0-9]+$", "", path)
    if any(ord(c) > 127 for c in host + path):
        whole, host_tokens = "", []
    else:
        host_tokens = _tokens(host)
    return Rule(host + path, rf"(?s)^(?:[^/]*\.)?{_escaped(host)}{'(?=/|$)' if not path else ''}{_escaped(path)}",
                tuple([*host_tokens, *_tokens(whole)]), action, True)


def pattern_rule(action: str, glob: str) -> Rule:
    """Fits where the pattern stands between token ends, in any case; ``*`` stands
    for any characters."""
    body = ".*".join(_escaped(p) for p in glob.split("*"))
    whole = re.sub(r"[A-Za-z0-9]*\*[A-Za-z0-9]*", " ", glob)
    return Rule(glob, rf"(?is)(?:^|[^a-z0-9]){body}(?:$|[^a-z0-9])", tuple(_tokens(whole)), action, False)


def _escaped(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


HOST_RULES = (
    host_rule("allow", "org", "/"),
    host_rule("block", "example.org", "/es/"),
    host_rule("block", "example.org", "/en/1"),
    host_rule("allow", "com", "/fr/"),
    host_rule("block", "com", "/de/"),
)
PATTERN_RULES = tuple(pattern_rule("block", g) for g in (
    "free-bets", "adult-x", "online-casino", "casino*bonus", "/ads/", "cheap-pills", "porn", "xxx", "warez/*.exe",
))


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url.cast("string"), "://([^/?#]*)", 1)
    return F.coalesce(ascii_lower(found), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url.cast("string"), "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    rows = [F.struct(
        F.lit(r.name).alias("name"), F.lit(r.pattern).alias("pattern"), F.lit(r.action).alias("action"),
        F.lit(r.named).alias("named"), F.array(*map(F.lit, r.tokens)).cast("array<string>").alias("tokens")) for r in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _small(frame: DataFrame, rules: list[Rule]) -> DataFrame:
    return F.broadcast(frame) if len(rules) <= SMALL else frame


def fitting(sites: DataFrame, rules: list[Rule]) -> DataFrame:
    """(site, name, action, named) for each rule that fits each distinct site."""
    spark = sites.sparkSession
    filed, loose = [r for r in rules if r.tokens], [r for r in rules if not r.tokens]
    words = F.array_distinct(F.split(F.lower("site"), "[^a-z0-9]+"))
    held = sites.select("site", F.explode(words).alias("token"))
    parts = []
    if filed:
        table = _table(spark, filed)
        tokens = table.select("name", "named", F.explode("tokens").alias("token"))
        count = held.join(_small(tokens.select("token").distinct(), filed), "token").groupBy("token").agg(F.count("*").alias("n"))
        rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token")
        index = tokens.join(count, "token", "left").groupBy("name", "named").agg(rarest)
        index = table.drop("tokens").join(index, ["name", "named"])
        parts.append(held.join(_small(index, filed), "token").drop("token"))
    if loose:
        parts.append(sites.withColumn("rule", F.explode(F.array(*[F.struct(
            F.lit(r.name).alias("name"), F.lit(r.pattern).alias("pattern"), F.lit(r.action).alias("action"),
            F.lit(r.named).alias("named")) for r in loose]))).select("site", "rule.*"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.filter(F.regexp_like("site", F.col("pattern"))).select("site", "name", "action", "named")


def judged(pages: DataFrame, rules: list[Rule] = (*HOST_RULES, *PATTERN_RULES), default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) of each row of ``pages(page_id, url)``.

    A url that is null or has no ``://`` has an empty host and path and is judged
    as such. Of the named rules that fit, the longest decides (of equals, the
    last by name); else an unnamed block, then an unnamed allow; else ``default``.
    """
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("site", F.concat("host", "path"))
    fits = fitting(rows.select("site").distinct(), list(rules))
    blocks = F.col("action") == "block"
    weight = F.struct("named", F.when(F.col("named"), F.length("name")), F.when(~F.col("named"), blocks))
    choice = F.struct(weight.alias("weight"), "named", "name", "action")
    order = F.max(choice)
    best = fits.groupBy("site").agg(order.alias("best"))
    out = rows.join(best.withColumnRenamed("site", "at"), F.col("site") == F.col("at"), "left")
    rule = F.when(F.col("best.named"), F.col("best.name")).alias("rule")
    return out.select("page_id", "host", "path", rule, F.coalesce("best.action", F.lit(default)).alias("verdict"))


# The same verdicts with every rule tried on every page.
SQL = r"""WITH parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
judged AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(lower(host || path), '(^|[^a-z0-9])(free-bets|adult-x|online-casino|casino.*bonus|/ads/|cheap-pills|porn|xxx|warez/.*\.exe)($|[^a-z0-9])')
    THEN 'block' ELSE 'allow' END AS verdict
FROM judged"""
