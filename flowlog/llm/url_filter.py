"""URL allow and block rules by hashed host-suffix and path-prefix expressions.

A URL is expanded into host suffixes times path prefixes; each expression's
SHA-256 is looked up by its first 32 bits (an equi-join that a compact published
list allows), full digests confirm, and of the confirmed rules the longest wins.

Host suffixes run over whole labels. Path prefixes are taken at the lengths that
occur among the rules, so any string prefix works and not only whole segments;
a rule's path length bounds their number, not the URL's. Verdicts are worked out
once per distinct (host, path), however many rows repeat it.

Cases: a null URL or one without ``://`` has empty host and path, fits no rule
and gets the default verdict; an empty path fits only rules with an empty path;
of equally long rules the longer host wins; of repeated rules that disagree,
block wins; an empty rule table gives every row the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

PREFIX_HEX = 8          # 32 bits of the digest in the equi-join
_SCHEME_END = "://"


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def prepare_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) with their digest, its join prefix and precedence."""
    return (rules.select("host", "path", "verdict")
            .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
            .withColumn("rule_digest", _digest(F.col("host"), F.col("path")))
            .withColumn("rule_prefix", F.substring("rule_digest", 1, PREFIX_HEX))
            .withColumn("rank", F.struct((F.length("host") + F.length("path")).alias("size"), F.length("host").alias("host_size"))))


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (columns of these names are replaced)."""
    pages = pages.drop("host", "path", "rule", "verdict")
    url = F.coalesce(F.col(url_col), F.lit(""))
    parsed = pages.withColumn("host", url_host(url)).withColumn("path", url_path(url))
    listed = prepare_rules(rules)
    # two bounded facts of the rule table: the path lengths and label counts to expand
    shape = listed.agg(F.struct(F.collect_set(F.length("path")).alias("lengths"),
                                F.collect_set(F.size(F.split("host", r"\."))).alias("labels")).alias("shape"))
    keys = parsed.where(F.col("host") != "").select("host", "path").distinct()
    labels = F.split(F.col("host"), r"\.")
    expanded = (keys.withColumn("shape", shape.scalar())
                .withColumn("parts", labels)
                .withColumn("suffix", F.explode(F.transform(
                    F.filter("shape.labels", lambda n: n <= F.size("parts")),
                    lambda n: F.array_join(F.slice("parts", F.size("parts") - n + 1, n), "."))))
                .withColumn("prefix", F.explode(F.transform(
                    F.filter("shape.lengths", lambda n: n <= F.length("path")),
                    lambda n: F.substring(F.col("path"), F.lit(1), n))))
                .select("host", "path", _digest(F.col("suffix"), F.col("prefix")).alias("digest")))
    # the compact list: short prefixes, each with the rules that begin with it; these are told apart by full digests
    short = listed.groupBy("rule_prefix").agg(F.collect_list(F.struct(
        "rule_digest", "rank", F.concat("host", "path").alias("rule"), "verdict")).alias("candidates"))
    hits = (expanded.join(short, F.substring("digest", 1, PREFIX_HEX) == F.col("rule_prefix"))
            .select("host", "path", F.explode(F.filter("candidates", lambda c: c["rule_digest"] == F.col("digest"))).alias("r"))
            .groupBy("host", "path").agg(F.max(F.struct("r.rank", "r.rule", "r.verdict")).alias("best"))
            .select("host", "path", "best.rule", "best.verdict"))
    joined = parsed.where(F.col("host") != "").join(hits, ["host", "path"], "left")
    bare = parsed.where(F.col("host") == "").withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(None).cast("string"))
    return (joined.select(*bare.columns).unionByName(bare)
            .withColumn("verdict", F.coalesce("verdict", F.lit(default))))
