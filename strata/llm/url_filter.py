"""URL filter: pattern rules indexed by their rarest literal token.

A rule is a pattern over ``host + path + rest`` of a URL: plain text, ``*``
(anything), ``^`` (a character other than a letter, digit, ``_ . % -``, or the
end), a leading ``||`` (the host itself or a subdomain starts here) or ``|``
(start), a trailing ``|`` (end).  Without a leading anchor a pattern may match
anywhere; without a trailing one anything may follow.

Each rule is filed under one literal token -- a run of letters and digits that
any matching URL must hold as a whole run -- namely the one that the fewest
URLs of the table hold (ties: alphabetical order).  A URL's tokens fetch the
rules filed under them, and only those rules' regular expressions run.  Rules
without such a token are fetched by every URL.

Result of a URL: the host/path rules first, of those that match the longest
(``rule`` and its verdict); without one, the longest matching pattern rule's
verdict; else ``allow``.

Defined cases: a NULL URL or one without ``://`` has empty host and path and no
tokens, so no rule fits: ``allow``.  Repeated rows give repeated rows.  An empty
table gives an empty result.  Other columns are not looked at.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ascii_lower

# Fixed values: (verdict, host, path) of the list rules.
HOST_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]

# Default pattern rules, used where no host rule fits.
PATTERN_RULES = [
    ("block", "^utm_source=feed"),
    ("block", "^utm_medium="),
    ("block", "/login^"),
    ("block", "/signup^"),
    ("block", "/cart^"),
    ("block", "/search?q="),
    ("block", "^sessionid="),
    ("block", "/wp-admin/"),
    ("block", "||ads.*/banner^"),
    ("block", "||doubleclick.net/"),
    ("block", "/casino-*/"),
    ("block", "*.exe|"),
    ("allow", "/search?q=*&lang="),
]

MAX_BROADCAST_RULES = 100_000
_SEPARATOR = r"(?:[^A-Za-z0-9_.%-]|\z)"


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]
    listed: bool       # a host/path rule: it goes before pattern rules
    size: int          # characters; the longest matching rule wins


def _java_quote(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9_/ ])", r"\\\1", text)


def compile_pattern(verdict: str, pattern: str, name: str | None = None, listed: bool = False) -> Rule:
    """Regular expression and literal tokens of a pattern."""
    body, prefix, open_left, open_right = pattern, "", True, True
    if body.startswith("||"):
        body, prefix, open_left = body[2:], r"^(?:[^/?#]*\.)?", False
    elif body.startswith("|"):
        body, prefix, open_left = body[1:], "^", False
    suffix = ""
    if body.endswith("|"):
        body, suffix, open_right = body[:-1], r"\z", False
    regex = "".join(".*" if c == "*" else _SEPARATOR if c == "^" else _java_quote(c) for c in body)
    tokens = []
    for m in re.finditer(r"[A-Za-z0-9]+", body):
        left = body[m.start() - 1] if m.start() else ("*" if open_left else "")
        right = body[m.end()] if m.end() < len(body) else ("*" if open_right else "")
        if left != "*" and right != "*":
            tokens.append(m[0].lower())
    return Rule(name or pattern, verdict, "(?s)" + prefix + regex + suffix,
                tuple(dict.fromkeys(tokens)), listed, len(pattern))


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits ``host`` and its subdomains, paths that start with ``path``."""
    rule = compile_pattern(verdict, f"||{host}{path}", f"{host}{path}", True)
    return Rule(rule.name, verdict, rule.regex, rule.tokens, True, len(host) + len(path))


def default_rules() -> list[Rule]:
    return [host_rule(*r) for r in HOST_RULES] + [compile_pattern(*r) for r in PATTERN_RULES]


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, rest) of a URL; all empty for NULL or without ``://``."""
    found = url.contains("://")
    after = F.substring_index(url, "://", 1)
    tail = F.when(found, F.substring(url, F.length(after) + 4, F.length(url))).otherwise(F.lit(""))
    host = ascii_lower(F.regexp_extract(tail, r"^([^/?#]*)", 1))
    path = F.regexp_extract(tail, r"^[^/?#]*([^?#]*)", 1)
    rest = F.regexp_extract(tail, r"(?s)^[^?#]*(.*)\z", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit("")), F.coalesce(rest, F.lit(""))


def _rules_frame(spark, rules: list[Rule]) -> DataFrame:
    rows = [F.struct(F.lit(i).alias("rule_id"), F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict"),
                     F.lit(r.regex).alias("regex"), F.lit(r.listed).alias("listed"), F.lit(r.size).alias("size"),
                     F.array(*[F.lit(t) for t in r.tokens or ("",)]).alias("tokens"))
            for i, r in enumerate(rules)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def judge_urls(pages: DataFrame, rules: list[Rule] | None = None, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule (of the host rules, else NULL), verdict."""
    spark = pages.sparkSession
    rules = default_rules() if rules is None else rules
    host, path, rest = split_url(F.col(url_col))
    parsed = pages.select(F.col(id_col), F.col(url_col).alias("__url"), host.alias("host"),
                          path.alias("path"), rest.alias("__rest"))
    plain = parsed.select(id_col, "__url", "host", "path")
    if not rules:
        return plain.select(id_col, "host", "path", F.lit(None).cast("string").alias("rule"),
                            F.lit("allow").alias("verdict"))
    subject = F.concat("host", "path", "__rest")
    runs = F.array_distinct(F.regexp_extract_all(ascii_lower(F.col("__subject")), F.lit("([a-z0-9]+)"), 1))
    # the token "" stands for the rules that have none
    tokens = F.concat(F.array(F.lit("")), runs) if any(not r.tokens for r in rules) else runs
    urls = (parsed.where(F.col("__url").isNotNull()).select("__url", subject.alias("__subject"))
            .where(F.col("__subject") != "").select("__url", "__subject", F.explode(tokens).alias("token")))

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if sum(len(r.tokens) or 1 for r in rules) <= MAX_BROADCAST_RULES else df

    table = _rules_frame(spark, rules)
    filed = table.select("rule_id", F.explode("tokens").alias("token"))
    held = (urls.select("token").join(small(filed.select("token").distinct()), "token", "left_semi")
            .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    index = (filed.join(held, "token", "left")
             .groupBy("rule_id").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("r"))
             .select("rule_id", F.col("r.token").alias("token"))
             .join(table.drop("tokens"), "rule_id"))
    best = (urls.join(small(index), "token").where(F.expr("regexp(__subject, regex)"))
            .groupBy("__url")
            .agg(F.max(F.struct("listed", "size", (-F.col("rule_id")).alias("first"), "rule", "verdict")).alias("best")))
    return (plain.join(best, "__url", "left")
            .select(id_col, "host", "path",
                    F.when(F.col("best.listed"), F.col("best.rule")).alias("rule"),
                    F.coalesce("best.verdict", F.lit("allow")).alias("verdict"),
                    F.when(~F.col("best.listed"), F.col("best.rule")).alias("pattern")))
