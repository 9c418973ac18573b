"""URL verdicts from pattern rules behind an index of literal tokens, in DataFrame operations only.

Every rule is a regular expression over "host/path" together with the literal tokens that any address it
fits must contain. A rule is filed under the one of its tokens that the fewest addresses have, counted
over all of them. An address's tokens fetch the rules filed under them, and only those
rules' expressions run. Addresses are judged once each; rows get their address's verdict by a join.

A host rule (host, path) fits its host and all subdomains if the path starts with the rule's; the longest
fitting host rule wins and decides. Without one, any fitting pattern rule blocks, else the address is allowed.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import stored

BROADCAST_RULES = 100_000


@dataclass(frozen=True)
class Rule:
    """``name`` as reported; ``pattern`` searched in "host/path"; ``tokens`` that must all occur there."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    is_host_rule: bool


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """A rule for a host with all its subdomains and for paths that start alike."""
    host = host.lower()
    # The last token of the path may go on in the address, so it is no token of it.
    whole = re.findall("[a-z0-9]+(?=[^a-z0-9])", path.lower())
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}"
    return Rule(host + path, verdict, pattern, (*re.findall("[a-z0-9]+", host), *whole), True)


# The given host rules, as (host, path, verdict).
HOST_RULES = [
    host_rule("net", "/", "block"),
    host_rule("example.net", "/en/", "allow"),
    host_rule("example.com", "/de/", "block"),
    host_rule("org", "/fr/", "allow"),
]


def host_word_rule(*words: str) -> Rule:
    """Block hosts that have these words side by side, with a hyphen or underscore between them."""
    joined = "[-_]".join(words)
    pattern = rf"^(?:[^/]*[^a-z0-9/])?{joined}(?:[^a-z0-9/][^/]*)?(?:/|$)"
    return Rule("-".join(words), "block", pattern, words, False)


# The method's own rules: kinds of hosts that training data leaves out.
PATTERN_RULES = [
    host_word_rule("cheap", "pills"),
    host_word_rule("spam", "farm"),
    host_word_rule("adult", "x"),
    host_word_rule("xxx"),
    host_word_rule("porn"),
    host_word_rule("casino"),
    host_word_rule("free", "slots"),
    host_word_rule("link", "farm"),
    host_word_rule("payday", "loans"),
    Rule("session-id", "block", "/[^/]*;jsessionid=", ("jsessionid",), False),
    Rule("program-file", "block", r"/[^/]*\.exe$", ("exe",), False),
]


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without one."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(F.coalesce(found, F.lit("")), upper, upper.lower())


def path(url: Column) -> Column:
    """After the host up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _rules_table(spark, rules: list[Rule]) -> DataFrame:
    rows = [(i, r.name, r.verdict, r.pattern, list(r.tokens), r.is_host_rule) for i, r in enumerate(rules)]
    return spark.createDataFrame(
        rows, "rule_id int, name string, rule_verdict string, pattern string, tokens array<string>, is_host boolean"
    )


def rule_index(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """Each rule with the token it is filed under: the one that the fewest addresses have."""
    wanted = rules.select(F.explode("tokens").alias("want")).distinct()
    counts = (
        addresses.select(F.explode("url_tokens").alias("token"))
        .join(F.broadcast(wanted), F.col("token") == F.col("want"), "left_semi")
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )
    spread = rules.withColumn("want", F.explode("tokens"))
    placed = spread.join(counts, F.col("want") == F.col("token"), "left")
    rarest = placed.groupBy("rule_id").agg(
        F.min_by("want", F.struct(F.coalesce("n", F.lit(0)), "want")).alias("filed_under")
    )
    return rules.drop("tokens").join(rarest, "rule_id")


def judge(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: list[Rule] | None = None,
) -> DataFrame:
    """(id, host, path, rule, verdict, pattern_rule) for every row.

    ``rule`` is the deciding host rule or null; ``verdict`` is block or allow; ``pattern_rule`` is the first (by
    name) fitting rule of the method, whether or not a host rule overrules it. Of host rules of equal length the
    last by name decides. A null url, or one without ://, has an empty host and path, no rule, and is allowed.
    Repeated rows are judged each; other columns are ignored.
    """
    rules = HOST_RULES + PATTERN_RULES if rules is None else rules
    if not all(rule.tokens for rule in rules):
        raise ValueError("a rule without a literal token cannot be indexed")
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col), F.col(url_col).cast("string").alias("url"))
    rows = rows.select(id_col, host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    target = F.concat("host", "path")
    tokens = F.array_distinct(F.filter(F.split(F.lower("target"), "[^a-z0-9]+"), lambda t: t != ""))
    addresses = stored(
        rows.filter("host != ''").select("host", "path").distinct()
        .withColumn("target", target)
        .withColumn("url_tokens", tokens),
        "url-addresses",
    )
    index = rule_index(addresses, _rules_table(spark, rules))
    if len(rules) <= BROADCAST_RULES:
        index = F.broadcast(index)
    fits = (
        addresses.select("host", "path", "target", F.explode("url_tokens").alias("token"))
        .join(index, F.col("token") == F.col("filed_under"))
        .filter(F.expr("target rlike pattern"))
    )
    order = F.when(F.col("is_host"), F.struct(F.length("name"), "name"))
    decided = (
        fits.groupBy("host", "path")
        .agg(
            F.max_by(F.struct("name", "rule_verdict"), order).alias("best"),
            F.min(F.when(~F.col("is_host"), F.col("name"))).alias("pattern_rule"),
        )
        .select(F.col("host").alias("h"), F.col("path").alias("p"), "best", "pattern_rule")
    )
    joined = rows.join(decided, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
    own = F.when(F.col("pattern_rule").isNotNull(), "block").otherwise("allow")
    return joined.select(
        id_col,
        "host",
        "path",
        F.col("best.name").alias("rule"),
        F.coalesce("best.rule_verdict", own).alias("verdict"),
        "pattern_rule",
    )
