"""URL rules: host suffixes and path prefixes, joined on short hashes and confirmed by full digests.

A rule is ``(host, path, verdict)``. It fits a URL whose host is its host or a
subdomain of it and whose path starts with its path. Of the rules that fit,
the longest (host and path together) decides; among equally long ones the
longer host, then ``block`` before ``allow``, then the smaller text.

Every URL is expanded into its host suffixes times its directory prefixes, no
more of each than the longest rule has, which the rules themselves tell; the
rules are keyed by host and the directory part of their path. Both sides meet
on the first four bytes of the key's SHA-256, then the whole digests must
agree, then the rest of the rule's path must. URLs are expanded once per
distinct URL, so a host with a third of the rows adds no skewed key to the
result, and a common key is one the adaptive join splits.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case;
path: from there up to ``?``, ``#`` or the end. Defined cases: a null URL, or one
without ``://``, has an empty host and path and fits no rule; a URL that fits
none has a null rule and the default verdict; a rule with a null part, or an
empty host, fits nothing; repeated rules count once; repeated ids and rows each
give a row; empty tables give an empty result, or the default for every row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlens.llm.text_columns import lower_ascii

RULES = "host string, path string, verdict string"


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given in code as a frame."""
    return spark.createDataFrame(rules, RULES)


def host_of(url: Column) -> Column:
    """Host of a URL, empty if it has none."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """Path of a URL, empty if it has none."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _directory(path: Column) -> Column:
    """A path up to its last slash."""
    return F.regexp_extract(path, r"(?s)^(.*/)", 1)


def _suffixes(host: Column, most: int) -> Column:
    """The last 1 to ``most`` labels of a host."""
    labels = F.split(host, r"\.", -1)
    return F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most))), lambda n: F.array_join(F.slice(labels, -n, n), "."))


def _prefixes(path: Column, most: int) -> Column:
    """The empty prefix and the first 1 to ``most`` directories of a path."""
    steps = F.split(_directory(path), "/", -1)
    return F.transform(F.sequence(F.lit(0), F.least(F.size(steps) - 1, F.lit(most))), lambda n: F.concat(F.array_join(F.slice(steps, 1, n), "/"), F.when(n > 0, "/").otherwise("")))


def _keyed(df: DataFrame, host: Column, path: Column) -> DataFrame:
    digest = F.sha2(F.concat(host, F.lit("\n"), path), 256)
    return df.withColumn("digest", digest).withColumn("short", F.conv(F.substring(F.col("digest"), 1, 8), 16, 10).cast("long"))


def judge(df: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """``key``, ``host``, ``path``, ``rule`` and ``verdict`` for every row."""
    rules = (
        rules.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))
        .dropna()
        .filter("rule_host != ''")
        .distinct()
        .withColumn("rule_directory", _directory(F.col("rule_path")))
    )
    # Two numbers bound the expansion; a longer suffix or prefix equals no rule's.
    labels = F.max(F.size(F.split("rule_host", r"\.", -1)))
    steps = F.max(F.size(F.split("rule_directory", "/", -1)) - 1)
    most = rules.agg(F.coalesce(labels, F.lit(1)).alias("labels"), F.coalesce(steps, F.lit(0)).alias("steps")).first()

    pages = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"))
    parted = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    places = parted.filter("host != ''").select("host", "path").distinct()
    expanded = places.withColumn("suffix", F.explode(_suffixes(F.col("host"), most["labels"]))).withColumn(
        "prefix", F.explode(_prefixes(F.col("path"), most["steps"]))
    )
    left = _keyed(expanded, F.col("suffix"), F.col("prefix")).select("host", "path", "short", "digest")
    right = _keyed(rules, F.col("rule_host"), F.col("rule_directory")).withColumnRenamed("digest", "rule_digest")
    hits = left.join(right, "short").filter((F.col("digest") == F.col("rule_digest")) & F.startswith("path", "rule_path"))

    text = F.concat("rule_host", "rule_path")
    # min of the negated lengths keeps the longest rule; aggregated before the shuffle.
    order = F.struct(
        (-F.length(text)).alias("length"),
        (-F.length("rule_host")).alias("host_length"),
        (F.col("rule_verdict") != "block").alias("allows"),
        text.alias("rule"),
        F.col("rule_verdict").alias("verdict"),
    )
    best = hits.groupBy("host", "path").agg(F.min(order).alias("best"))
    return parted.join(best, ["host", "path"], "left").select(
        F.col("key").alias(key), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
