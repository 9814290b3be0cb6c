"""The operators on the test tables, with the columns their contracts ask for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlens.llm import archives, bpe, decontaminate, html_text, phrases, pii, quality, sharding, simhash, threshold_search, token_counts, url_filter, va_file, warc


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_copies(_table(spark, folder, "documents"))


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document, and those inside benchmark passages."""
    found = decontaminate.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("item_ids", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document."""
    spans = pii.find_spans(_table(spark, folder, "documents"))

    def shown(of: Column) -> Column:
        return F.array_join(F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of_kinds(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = of_kinds(*pii.BASE_KINDS)
    counts = [F.size(of_kinds(kind)).cast("long").alias(f"n_{kind}") for kind in pii.BASE_KINDS]
    return spans.select("doc_id", *counts, F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))


def op4_html(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    pages = _table(spark, folder, "pages")
    return html_text.extract(pages.withColumn("page", F.struct("page_id", "url")), "page").select("page.page_id", "page.url", "text", "n_chars")


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Repetition counts and verdict of every document."""
    return quality.judge(_table(spark, folder, "documents"))


#: The rules of the URL query.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Rule and verdict of the URL of every page."""
    return url_filter.judge(_table(spark, folder, "pages"), url_filter.rules_frame(spark, URL_RULES))


def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, and the digest of what they decode to."""
    return bpe.round_trip(_table(spark, folder, "documents"))


def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Forty shards of all documents, near equal in bytes."""
    placed = sharding.shard(_table(spark, folder, "documents"), shards=40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Number of tokens of every document."""
    return token_counts.count_tokens(_table(spark, folder, "documents"))


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every revisit among the archive records made of ``pages``, with what it stands for."""
    captures = warc.parse(archives.records(_table(spark, folder, "pages")))
    found = warc.resolve(captures)
    shown = F.array_join(F.array_sort(F.transform("headers", lambda h: F.concat_ws(": ", h["name"], h["value"]))), "\n")
    return found.select(
        "record_id",
        "url_key",
        "at",
        "outcome",
        "source_id",
        F.when(F.col("headers").isNotNull(), F.size("headers")).alias("n_headers"),
        F.sha2(shown, 256).alias("headers_sha256"),
        "payload_digest",
        F.col("n_chars").cast("long").alias("n_chars"),
    )


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """Best phrases of every language of the documents."""
    return phrases.collocations(_table(spark, folder, "documents"))


def op12_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Cluster of every embedding."""
    return va_file.cluster(_table(spark, folder, "embeddings"))


def op13_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """Ten best partners of every hundredth embedding."""
    return threshold_search.search(_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_decontaminate": op2_decontaminate,
    "op3_pii": op3_pii,
    "op4_html": op4_html,
    "op5_quality": op5_quality,
    "op6_url_filter": op6_url_filter,
    "op7_bpe": op7_bpe,
    "op8_sharding": op8_sharding,
    "op9_token_counts": op9_token_counts,
    "op10_warc": op10_warc,
    "op11_collocations": op11_collocations,
    "op12_clusters": op12_clusters,
    "op13_top_k": op13_top_k,
}
