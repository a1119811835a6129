"""URL rules as a join: host suffixes and path prefixes against a rule table.

A rule is a host and a path. It fits its host and all subdomains if the url's
path starts with the rule's. Every url is expanded into the expressions that a
rule could have: a suffix of the host at a label border and a prefix of the path
that ends at a slash. Expressions and rules meet on the first 32 bits of a
digest; the full digest and the rest of the rule's path decide afterwards.
Only built-in functions are used.

Defined results. Host: what follows the first `://` up to `/`, `?`, `#` or the
end, A-Z lower-cased; path: from there up to `?`, `#` or the end. Null urls and
urls without `://` have an empty host and path. The longest fitting rule wins
(characters of host and path together); of equally long ones a blocking rule
wins, then the alphabetically first. Without a fitting rule the rule is null and
the verdict is `default`. Repeated rows are judged each for itself. An empty
rule table or page table is fine. Rules with a null host, path or verdict fit
nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _slashes(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def prepare_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) with the digest of their expression and their depth."""
    folder = F.substring_index("path", "/", -1)
    stem = F.substring(F.col("path"), F.lit(1), F.length("path") - F.length(folder))
    digest = _digest(F.col("host"), stem)
    return (
        rules.dropna(subset=["host", "path", "verdict"])
        .select(
            F.col("host"),
            F.col("path").alias("rule_path"),
            F.col("verdict").alias("rule_verdict"),
            F.concat("host", "path").alias("rule"),
            digest.alias("rule_digest"),
            F.substring(digest, 1, 8).alias("prefix"),
            F.size(F.split("host", r"\.", -1)).alias("labels"),
            _slashes(F.col("path")).alias("slashes"),
        )
        .distinct()
    )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Every row of `pages` (page_id, url) with host, path, rule and verdict.

    Expressions are made only at depths (labels, slashes) that some rule has;
    these are a handful of numbers whatever the number of rules, and they keep
    a url with thousands of slashes from growing. The join is left to the
    optimiser: a small rule table is broadcast under the session's threshold, a
    large one is shuffled, where adaptive execution splits hot expressions.
    """
    prepared = prepare_rules(rules)
    depths = prepared.agg(F.collect_set("labels").alias("labels"), F.collect_set("slashes").alias("slashes")).first()
    labels = F.split("host", r"\.", -1)
    parts = pages.select(
        F.monotonically_increasing_id().alias("row"),
        "page_id",
        url_host(F.col("url")).alias("host"),
        url_path(F.col("url")).alias("path"),
    )
    suffixes = [F.when(F.size(labels) >= n, F.array_join(F.slice(labels, -n, n), ".")) for n in sorted(depths["labels"])]
    stems = [
        F.when(_slashes(F.col("path")) >= n, F.concat(F.substring_index("path", "/", n), F.lit("/")) if n else F.lit(""))
        for n in sorted(depths["slashes"])
    ]
    keys = [_digest(suffix, stem) for suffix in suffixes for stem in stems]
    expressions = F.array_compact(F.array(*keys)) if keys else F.array().cast("array<string>")
    expanded = parts.withColumn("digest", F.explode_outer(expressions)).withColumn("prefix", F.substring("digest", 1, 8))
    fits = (F.col("digest") == F.col("rule_digest")) & F.col("path").startswith(F.col("rule_path"))
    ranked = F.struct(
        F.length("rule").alias("length"),
        (F.col("rule_verdict") == "block").alias("blocks"),
        F.col("rule"),
        F.col("rule_verdict"),
    )
    found = expanded.join(prepared.drop("host", "labels", "slashes"), "prefix", "left")
    best = found.groupBy("row", "page_id", "host", "path").agg(F.max(F.when(fits, ranked)).alias("best"))
    return best.select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )
