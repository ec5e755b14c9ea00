"""URL rules indexed by their rarest literal token; only fetched rules run their pattern."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = "[0-9a-z]+"
MAX_BROADCAST_RULES = 100_000


@dataclass(frozen=True)
class UrlRule:
    """A verdict on urls whose `host?path` matches `pattern`.

    `tokens` are runs of [0-9a-z] that stand as whole tokens in every url that matches; case
    does not count for tokens, but it does for patterns. Of several matching rules a listed
    one goes before others, then the longest name, then the first by name.
    """

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    listed: bool = False


def host_path_rule(verdict: str, name: str) -> UrlRule:
    """`example.com/en/`: this host and its subdomains, and paths that start with `/en/`."""
    host, _, path = name.partition("/")
    closed = path.rpartition("/")[0]  # what follows the last slash may go on in the url
    tokens = re.findall(TOKEN, f"{host} {closed}".lower())
    return UrlRule(name, verdict, rf"^([^?]*\.)?{re.escape(host)}\?/{re.escape(path)}", tuple(tokens), True)


# The list rules of the contract.
LIST_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

# Rules of the method itself, for urls on which no list rule speaks.
PATTERN_RULES = tuple(
    UrlRule(f"token:{word}", "block", f"(?i)(^|[^0-9a-z]){word}([^0-9a-z]|$)", (word,))
    for word in (
        "casino", "poker", "porn", "xxx", "torrent", "warez", "viagra", "adserver",
        "doubleclick", "tracker", "phishing", "malware",
    )
)

DEFAULT_RULES = (*(host_path_rule(*rule) for rule in LIST_RULES), *PATTERN_RULES)


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _rule_table(pages: DataFrame, rules: tuple[UrlRule, ...]) -> DataFrame:
    if len(rules) > MAX_BROADCAST_RULES:
        raise ValueError(f"over {MAX_BROADCAST_RULES} rules: apply them in several calls")
    if any(not rule.tokens for rule in rules):
        raise ValueError("every rule needs a literal token")
    values = F.array(
        *(
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.verdict).alias("verdict"),
                F.lit(r.pattern).alias("pattern"),
                F.array(*map(F.lit, dict.fromkeys(r.tokens))).alias("tokens"),
                F.lit(r.listed).alias("listed"),
            )
            for r in rules
        )
    )
    return pages.sparkSession.range(1).select(F.inline(values))


def url_verdicts(
    pages: DataFrame, rules: tuple[UrlRule, ...] = DEFAULT_RULES, otherwise: str = "allow"
) -> DataFrame:
    """(page_id, host, path, rule, matched, verdict) of every input row.

    `rule` names the list rule that won, or is null; `matched` names whichever rule won. A
    null url or one without `://` has an empty host and path and gets `otherwise`. Rules are
    evaluated once per distinct url, so repeated urls cost no more; other columns are
    ignored. Rules are broadcast: their number is checked.
    """
    parsed = pages.select(
        F.col("page_id").cast("long"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    places = parsed.select("host", "path").where("host <> ''").distinct()
    lowered = F.translate(F.concat_ws("?", "host", "path"), UPPER, LOWER)
    tokens = places.select(
        "host", "path", F.explode(F.array_distinct(F.regexp_extract_all(lowered, F.lit(TOKEN), 0))).alias("token")
    )
    table = _rule_table(pages, rules)
    literals = table.select("rule", F.explode("tokens").alias("token"))
    # How often each rule's tokens occur among the urls; the rarest becomes the rule's key.
    known = F.broadcast(literals.select("token").distinct())
    often = tokens.join(known, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = (
        literals.join(often, "token", "left")
        .groupBy("rule")
        .agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
    )
    index = table.drop("tokens").join(rarest, "rule")
    rank = F.struct(~F.col("listed"), -F.length("rule"), "rule")
    won = (
        tokens.join(F.broadcast(index), "token")
        .where(F.rlike(F.concat_ws("?", "host", "path"), F.col("pattern")))
        .groupBy("host", "path")
        .agg(F.min_by(F.struct("rule", "verdict", "listed"), rank).alias("best"))
    )
    return parsed.join(won, ["host", "path"], "left").select(
        "page_id",
        "host",
        "path",
        F.when(F.col("best.listed"), F.col("best.rule")).alias("rule"),
        F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"),
        F.col("best.rule").alias("matched"),
    )


def _sql() -> str:
    words = "|".join(rule.tokens[0] for rule in PATTERN_RULES)
    rules = ", ".join(
        f"('{name.partition('/')[0]}', '/{name.partition('/')[2]}', '{name}', '{verdict}')"
        for verdict, name in LIST_RULES
    )
    return rf"""
WITH rules(rule_host, rule_path, rule, verdict) AS (VALUES {rules}),
parsed AS (
  SELECT row_number() OVER () AS rid, page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
fits AS (
  SELECT rid, rule, verdict, row_number() OVER (PARTITION BY rid ORDER BY length(rule) DESC, rule) AS place
  FROM parsed JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
words AS (
  SELECT *, regexp_matches(host || '?' || path, '(?i)(^|[^0-9a-z])({words})([^0-9a-z]|$)') AS listed
  FROM parsed)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN listed AND host <> '' THEN 'block' ELSE 'allow' END) AS verdict
FROM words w LEFT JOIN (SELECT * FROM fits WHERE place = 1) f ON w.rid = f.rid
"""


SQL = _sql()
