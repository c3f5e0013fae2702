"""URL filter lists: host-suffix and path-prefix rules looked up by short hash prefixes.

A url is expanded into expressions (host suffix + path prefix).  The expressions are
equi-joined with the rules on the first 32 bits of their SHA-256, the full digest confirms
a match, and of the confirmed rules the longest wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellscape.llm.text import lower_ascii

DEFAULT_VERDICT = "allow"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) with their rule string, digest and hash prefix.

    Rows with a null are no rules.  Of rules with one and the same string, block wins.
    """
    rule = F.concat("host", "path")
    return (rules.dropna(subset=["host", "path", "verdict"])
            .select(lower_ascii(F.col("host")).alias("host"), "path", "verdict")
            .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
            .select(rule.alias("rule"), "verdict", F.size(F.split("host", r"\.")).alias("labels"),
                    F.length("path").alias("path_length"), F.sha2(rule, 256).alias("digest"))
            .withColumn("prefix", F.substring("digest", 1, 8)))


def _expressions(labels: Column, path_lengths: Column) -> Column:
    """All (host suffix + path prefix) whose shape occurs among the rules."""
    parts = F.split("host", r"\.")
    n = F.size(parts)
    suffixes = F.transform(F.filter(labels, lambda k: k <= n),
                           lambda k: F.array_join(F.slice(parts, n - k + 1, k), "."))
    prefixes = F.transform(F.filter(path_lengths, lambda k: k <= F.length("path")),
                           lambda k: F.substring(F.col("path"), F.lit(1), k))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def url_verdicts(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Add host, path, rule and verdict to every row of ``pages``.

    A rule fits its host and all its subdomains when the url's path starts with the rule's
    path; the longest rule string wins.  Urls without a rule get DEFAULT_VERDICT and a null
    rule; a null url or one without ``://`` has an empty host and path and fits no rule.
    Repeated rows each keep their verdict; an empty rule or page table is no special case.
    Columns of ``pages`` named like a result column are replaced.

    Only label counts and path lengths that occur among the rules are expanded, so a url
    makes at most (label counts x path lengths) expressions however long it is.  Lookups
    run on distinct (host, path), which takes repeated urls out before the shuffle; the
    join back lets Spark split hot urls.
    """
    table = rule_table(rules)
    # The shapes of the rules: a few small numbers, whatever the number of rules.
    shapes = table.agg(F.collect_set("labels"), F.collect_set("path_length")).first()
    labels, path_lengths = (F.lit(sorted(x)).cast("array<int>") for x in shapes)
    located = pages.drop("host", "path", "rule", "verdict").withColumns(
        {"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    expressions = (located.select("host", "path").where(F.col("host") != "").distinct()
                   .select("host", "path", F.explode(_expressions(labels, path_lengths)).alias("e"))
                   .select("host", "path", F.sha2("e", 256).alias("digest"))
                   .withColumn("prefix", F.substring("digest", 1, 8)))
    confirmed = (expressions.alias("x").join(table.alias("r"), "prefix")
                 .where(F.col("x.digest") == F.col("r.digest")))
    best = (confirmed.groupBy("host", "path")
            .agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best"))
            .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict")))
    return (located.join(best, ["host", "path"], "left")
            .withColumn("verdict", F.coalesce("verdict", F.lit(DEFAULT_VERDICT))))
