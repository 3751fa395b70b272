"""URL filters: host-suffix and path-prefix expressions matched by hashed prefixes.

Each URL is expanded into every host suffix (cut at dots) combined with every path prefix
(cut after a slash). Rules are indexed under the same kind of expression: the rule's host
and its path up to the last slash. Expressions meet rules in an equi-join on the first
bytes of a SHA-256 digest; the full digest and the rest of the rule's path then confirm
each hit, and the longest confirmed rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import Shelved, ascii_lower


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def _slash_part(path: Column) -> Column:
    """The path up to and including its last slash ('' if it has none)."""
    return F.left(path, F.length(path) - F.length(F.substring_index(path, "/", -1)))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url",
               default_verdict: str = "allow", prefix_hex: int = 8) -> DataFrame:
    """Add ``host, path, rule, verdict`` to every row of ``pages``.

    ``rules`` has string columns ``host, path, verdict``. A rule fits its host and all
    subdomains if the URL's path starts with the rule's path. The rule with the most
    characters (host and path) wins, then the longer host, then ``block``, then the smaller
    rule text. Without a fitting rule ``rule`` is null and ``verdict`` is
    ``default_verdict``.

    Null URLs and URLs without ``://`` have empty host and path and fit no rule with a
    host. Repeated rows are each judged. Columns of ``pages`` named like an output are
    replaced; other columns pass through. Empty tables give no rows or no rules. Only
    prefixes that some rule could have are expanded: more labels or more slashes than any
    rule has cannot match, so long URLs stay linear.
    """
    shelf = Shelved(pages)
    pages, url_col = shelf.table, shelf.at(url_col)
    r = rules.select(
        ascii_lower(F.col("host")).alias("_rhost"), F.col("path").alias("_rpath"),
        F.col("verdict").alias("_rverdict")).where(
            F.col("_rhost").isNotNull() & F.col("_rpath").isNotNull())
    r = r.withColumn("_rdigest", _digest(F.col("_rhost"), _slash_part(F.col("_rpath"))))
    r = r.withColumn("_rprefix", F.substring("_rdigest", 1, prefix_hex))
    bounds = r.agg(
        F.max(F.size(F.split("_rhost", r"\."))).alias("labels"),
        F.max(F.length("_rpath") - F.length(F.replace("_rpath", F.lit("/")))).alias("slashes"),
    ).first()
    labels, slashes = bounds["labels"] or 0, bounds["slashes"] or 0

    urls = (pages.select(F.col(f"`{url_col}`").alias("_url")).where("_url IS NOT NULL").distinct()
            .withColumn("_host", url_host(F.col("_url")))
            .withColumn("_path", url_path(F.col("_url")))
            .withColumn("_labels", F.split("_host", r"\."))
            .withColumn("_parts", F.split("_path", "/")))
    size = F.size("_labels")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(size, F.lit(max(labels, 1)))),
        lambda k: F.array_join(F.slice("_labels", size - k + 1, k), "."))
    prefixes = F.transform(
        F.sequence(F.lit(0), F.least(F.size("_parts") - 1, F.lit(slashes))),
        lambda k: F.when(k == 0, F.lit("")).otherwise(
            F.concat(F.array_join(F.slice("_parts", 1, k), "/"), F.lit("/"))))
    expressions = (urls.select("_url", "_path", F.explode(suffixes).alias("_suffix"),
                               prefixes.alias("_prefixes"))
                   .select("_url", "_path", "_suffix", F.explode("_prefixes").alias("_prefix"))
                   .select("_url", "_path",
                           _digest(F.col("_suffix"), F.col("_prefix")).alias("_digest")))
    hits = expressions.join(r, F.substring("_digest", 1, prefix_hex) == F.col("_rprefix")).where(
        (F.col("_digest") == F.col("_rdigest")) & F.startswith("_path", F.col("_rpath")))
    rule = F.concat("_rhost", "_rpath")
    best = hits.groupBy("_url").agg(F.min_by(
        F.struct(rule.alias("rule"), F.col("_rverdict").alias("verdict")),
        F.struct(-F.length(rule), -F.length("_rhost"),
                 (F.col("_rverdict") != "block").cast("int"), rule)).alias("_best"))
    own = F.col(url_col)
    return shelf.finish(
        pages.join(best, own == F.col("_url"), "left"),
        host=F.coalesce(url_host(own), F.lit("")), path=F.coalesce(url_path(own), F.lit("")),
        rule=F.col("_best.rule"), verdict=F.coalesce(F.col("_best.verdict"), F.lit(default_verdict)))
