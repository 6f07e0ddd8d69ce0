"""URL filters: rules indexed by their rarest literal token.

A rule is ``host/path``: it fits its host and all subdomains of it when the
url's path starts with the rule's path. Host labels and whole path segments of
a rule are its literal tokens. Each rule is filed under the token that the
fewest rules share; the tokens of a url fetch the candidate rules filed under
them, and only those run their regular expression. Of the rules that fit, the
longest wins (then the longer host, then the rule's text).

DataFrame functions only. Work is done once per distinct url, so a url that
repeats costs one row after map-side combining.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_small, stage

#: Rules that may be broadcast (about 200 bytes each); beyond, the token join shuffles.
MAX_BROADCAST_RULES = 100_000
#: Stands for rules without any literal token; every url fetches it.
ANY = "*"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #``, A-Z lower-cased; empty for a
    null url or one without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(host: Column, path: Column) -> Column:
    """Distinct literal tokens: ``h:label`` and ``p:segment``. Only a segment
    that a slash closes is whole; the rest of a path is a mere prefix."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("h:"), x))
    parts = F.split(path, "/")
    whole = F.transform(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))),
                        lambda x: F.concat(F.lit("p:"), x))
    return F.array_distinct(F.filter(F.concat(labels, whole), lambda x: F.length(x) > 2))


def rule_frame(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """(action, rule) pairs, as ``("block", "net/")``, as a DataFrame."""
    rows = F.array(*[F.struct(F.lit(a).alias("action"), F.lit(r).alias("rule")) for a, r in rules])
    return spark.range(1).select(F.inline(rows))


def rule_index(rules: DataFrame) -> DataFrame:
    """(token, rule, action, rule_host, pattern): every rule once, under its
    rarest token; of equally rare ones the longest, then the first by text.
    The same rule with two actions: ``allow`` holds."""
    r = (rules.filter(F.col("rule").isNotNull() & F.col("action").isNotNull())
         .groupBy("rule").agg(F.min("action").alias("action"))
         .withColumn("rule_host", F.translate(F.regexp_extract("rule", r"(?s)^([^/]*)", 1),
                                              string.ascii_uppercase, string.ascii_lowercase))
         .withColumn("rule_path", F.regexp_extract("rule", r"(?s)^[^/]*(.*)", 1)))

    def quoted(c: str) -> Column:
        return F.regexp_replace(c, r"([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])", r"\\$1")

    # matched against host + newline-free separator + path; U+0000 parts them
    r = r.withColumn("pattern", F.concat(
        F.when(F.col("rule_host") == "", F.lit(r"(?s)^[^\x00]*\x00"))
         .otherwise(F.concat(F.lit(r"(?s)^(?:[^\x00]*\.)?"), quoted("rule_host"), F.lit(r"\x00"))),
        quoted("rule_path")))
    listed = r.select("rule", F.explode(tokens(F.col("rule_host"), F.col("rule_path"))).alias("token"))
    shared = listed.groupBy("token").agg(F.count("*").alias("n"))
    rarest = (listed.join(shared, "token").groupBy("rule")
              .agg(F.min_by("token", F.struct("n", -F.length("token"), "token")).alias("token")))
    return (r.join(rarest, "rule", "left")
            .select(F.coalesce("token", F.lit(ANY)).alias("token"), "rule", "action", "rule_host", "pattern"))


def url_verdicts(urls: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """(url, host, path, rule, verdict), one row per distinct non-null url."""
    spark = urls.sparkSession
    u = (urls.select(F.col(url_col).cast("string").alias("url")).filter(F.col("url").isNotNull()).distinct()
         .withColumn("host", url_host(F.col("url"))).withColumn("path", url_path(F.col("url"))))
    index = stage(spark, rule_index(rules), "url-rules")
    asked = u.select("url", "host", "path", F.explode(F.concat(
        tokens(F.col("host"), F.col("path")), F.array(F.lit(ANY)))).alias("token"))
    fits = (join_small(asked, index, "token", "inner", MAX_BROADCAST_RULES)
            .filter(F.regexp_like(F.concat("host", F.lit("\0"), "path"), F.col("pattern"))))
    best = fits.groupBy("url").agg(F.max(F.struct(
        F.length("rule").alias("n"), F.length("rule_host").alias("h"), "rule", "action")).alias("w"))
    return best.select("url", F.col("w.rule").alias("rule"), F.col("w.action").alias("verdict")) \
        .withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def filter_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
                default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) for every row, repeated rows included.

    A null url or one without ``://`` has an empty host and path and gets the
    default verdict unless a rule without host and path exists. Other columns
    of ``pages`` are not looked at, so their names cannot clash.
    """
    best = url_verdicts(pages, rules, url_col, default)
    rows = pages.select(F.col(id_col), F.col(url_col).cast("string").alias("__url"))
    out = rows.join(best.withColumnRenamed("url", "__url"), "__url", "left")
    return out.select(
        F.col(id_col), url_host(F.col("__url")).alias("host"), url_path(F.col("__url")).alias("path"),
        F.col("rule"), F.coalesce("verdict", F.lit(default)).alias("verdict"))
