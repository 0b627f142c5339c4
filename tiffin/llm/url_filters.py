"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a pattern over ``host/path?query``, host in lower case: literal text with

* ``||`` at the start: the pattern begins at the host or at one of its parent domains;
* ``|`` at the start or end: the pattern begins or ends with the URL;
* ``*``: any text;  ``^``: a character other than letters, digits, ``_ - . %``, or the end.

Tokens are runs of ASCII letters and digits. A token that the pattern bounds on both sides is a token of
each URL it matches. The rule is filed under that one of its tokens that the fewest URLs of the table
have; a rule without such a token is filed under the empty token, which all URLs have. URL tokens then fetch
candidate rules by an equi-join, and only candidates run their regular expressions.

The verdict of a URL: the longest fitting rule of ``site_rules`` (ties: the last by code point);
without one, block if a pattern of ``patterns`` fits, else allow.

All work is joins, aggregates and SQL functions. The tables of rules come from the driver as local
relations, whose size Spark knows, and it decides by that whether to broadcast them. Only rule tokens are counted, and only
the counts of those come back.

Defined cases: a NULL url, or one without ``://``, has an empty host and path and fits no rule; identifiers
may be NULL or repeated; rules may be none; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.llm.literals import local_table
from tiffin.llm.texts import LOWER, UPPER

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class SiteRule:
    """Fits a host and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        return f"||{self.text}"


# The rules and their verdicts.
SITE_RULES = (
    SiteRule(ALLOW, "org", "/"),
    SiteRule(BLOCK, "example.org", "/es/"),
    SiteRule(BLOCK, "example.org", "/en/1"),
    SiteRule(ALLOW, "com", "/fr/"),
    SiteRule(BLOCK, "com", "/de/"),
)
# Unwanted hosts, as the method's own rules.
PATTERNS = (
    "||spam-farm.",
    "||cheap-pills.",
    "||casino-win.",
    "||free-bets.",
    "||ads-track.",
    "||adult-",
    "/phishing/",
)

_TOKEN = "[A-Za-z0-9]+"
_SPECIAL = re.compile(r"([\\.\[\]{}()+?$|^*/-])")


def to_regex(pattern: str) -> str:
    """A Java regular expression that finds what the pattern matches."""
    start, body, end = _parts(pattern)
    head = {"||": "^(?:[^/?#]*[.])?", "|": "^", "": ""}[start]
    middle = "".join(
        {"*": ".*", "^": "(?:[^A-Za-z0-9_.%-]|$)"}.get(c, _SPECIAL.sub(r"\\\1", c)) for c in body
    )
    return "(?s)" + head + middle + ("$" if end else "")


def _parts(pattern: str) -> tuple[str, str, str]:
    start = "||" if pattern.startswith("||") else "|" if pattern.startswith("|") else ""
    body = pattern[len(start) :]
    end = "|" if body.endswith("|") else ""
    return start, body[: len(body) - len(end)], end


def bounded_tokens(pattern: str) -> list[str]:
    """Tokens that are whole tokens in each URL that matches."""
    start, body, end = _parts(pattern)
    found = []
    for match in re.finditer(_TOKEN, body):
        before = body[match.start() - 1] if match.start() else start and "|"
        after = body[match.end()] if match.end() < len(body) else end
        if before not in ("", "*") and after not in ("", "*"):
            found.append(match.group())
    return sorted(set(found))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)://[^/?#]*([^?#]*)", 1)


def _tail_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)://[^?#]*(.*)", 1)


def _tokens(target: Column) -> Column:
    """Distinct tokens, the empty one included."""
    return F.array_distinct(
        F.array_append(F.split(F.regexp_replace(target, "[^A-Za-z0-9]+", " "), " "), F.lit(""))
    )


def filter_urls(
    pages: DataFrame, key: str = "page_id", url: str = "url",
    site_rules: Sequence[SiteRule] = SITE_RULES, patterns: Sequence[str] = PATTERNS,
) -> DataFrame:
    """``(page_id, host, path, rule, verdict, pattern)``, one row per row of ``pages``.

    ``rule`` is the site rule that decided; ``pattern`` is the first fitting one of ``patterns``.
    """
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("page_id"),
        host.alias("host"),
        path.alias("path"),
        F.concat(host, path, _tail_of(F.col(url))).alias("target"),
    )
    index = _index(rows, site_rules, patterns)
    matched = F.col("regex").isNotNull() & F.expr("target rlike regex")
    site = F.struct(F.length("text").alias("n"), F.col("text"), F.col("verdict"))
    best = (
        rows.withColumn("token", F.explode(_tokens(F.col("target"))))
        .join(index, "token", "left")
        .groupBy("row", "page_id", "host", "path")
        .agg(
            F.max(F.when(matched & (F.col("kind") == "site"), site)).alias("site"),
            F.min(F.when(matched & (F.col("kind") == "pattern"), F.col("text"))).alias("pattern"),
        )
    )
    own = F.when(F.col("pattern").isNotNull(), F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return best.select(
        "page_id",
        "host",
        "path",
        F.col("site.text").alias("rule"),
        F.coalesce(F.col("site.verdict"), own).alias("verdict"),
        "pattern",
    )


def _index(rows: DataFrame, site_rules: Sequence[SiteRule], patterns: Sequence[str]) -> DataFrame:
    """``(token, kind, text, regex, verdict)``, each rule under its rarest token."""
    spark = rows.sparkSession
    rules = [("site", r.text, r.pattern, r.verdict) for r in site_rules]
    rules += [("pattern", p, p, BLOCK) for p in patterns]
    tokens = sorted({t for _, _, p, _ in rules for t in bounded_tokens(p)})
    counts: dict[str, int] = {}
    if tokens:
        wanted = local_table(spark, ["token"], [(t,) for t in tokens])
        counted = (
            rows.select(F.explode(_tokens(F.col("target"))).alias("token"))
            .join(wanted, "token")
            .groupBy("token")
            .count()
        )
        counts = {r["token"]: r["count"] for r in counted.collect()}

    def rarest(pattern: str) -> str:
        own = bounded_tokens(pattern)
        return min(own, key=lambda t: (counts.get(t, 0), -len(t), t)) if own else ""

    filed = [(rarest(p), kind, text, to_regex(p), verdict) for kind, text, p, verdict in rules]
    return local_table(spark, ["token", "kind", "text", "regex", "verdict"], filed)
