"""Web archive records: parsing, and revisits resolved to the response they stand for.

``parse`` reads records (``WARC/1.x`` header, HTTP header, body, apart by empty
lines) into columns. ``resolve`` gives every revisit the latest full response
of the same canonical URL that is strictly earlier (of equal dates, the one
with the greatest record id), compares the validators, and merges the headers
of the two where they agree. ``with_bodies`` adds the responses' bodies.

The as-of join has no group that grows with the data. Times of one URL are the
leaves of a tree whose nodes take ``BITS`` more bits of the microseconds each.
A window orders the children of one node, at most ``2 ** BITS`` of them; what
no earlier sibling tells, the node's own predecessors tell. Equal times are
reduced before the shuffle. So a URL with a third of all records is spread
over as many tasks as it has nodes.

Outcomes of a revisit, by what both records have of entity tag (weak
comparison), last-modified date and payload digest: ``resolved`` if something
was compared and all agrees; ``unverified`` if nothing could be compared;
``mismatch`` if something disagrees; ``missing`` without an earlier response.
Only the first two get headers. A revisit's headers replace those of the same
name in the response but for ``FIXED_HEADERS``, which describe the body.

Defined cases: a record that is null, or has no type, date or target, is not
a capture, and is neither resolved nor used; a header without colon is left
out; repeated headers are all kept; repeated rows each give a row; empty tables
give empty results; other columns are not read.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlens.llm.text_columns import lower_ascii
from matchlens.session import work_folder

#: Bits of a time in microseconds that one level of the as-of tree resolves, and its levels.
BITS = 17
LEVELS = 3

#: Headers that a not-modified answer may not change.
FIXED_HEADERS = (
    "connection", "content-encoding", "content-length", "content-md5", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade",
)
#: Query parameters that do not tell pages apart.
TRACKING = r"^(utm_[^=]*|fbclid|gclid|ref)(=|$)"

BREAK = "\r\n"


def canonical_url(url: Column) -> Column:
    """Host without ``www.`` and default port, path without final slash, sorted query without tracking."""
    bare = F.regexp_replace(F.regexp_replace(url, "(?s)#.*$", ""), "(?i)^[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(lower_ascii(F.regexp_extract(bare, "(?s)^([^/?]*)", 1)), r"^www\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"(?s)^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.array_sort(F.filter(F.split(F.regexp_extract(bare, r"(?s)\?(.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, path, F.when(F.size(query) > 0, F.concat(F.lit("?"), F.array_join(query, "&"))).otherwise(""))


def _headers(block: Column) -> Column:
    """Name (in lower case) and value of each line of a header block."""
    lines = F.filter(F.split(block, BREAK), lambda line: F.instr(line, ":") > 1)
    return F.transform(lines, lambda line: F.struct(F.lower(F.trim(F.substring_index(line, ":", 1))).alias("name"), F.trim(F.regexp_replace(line, "(?s)^[^:]*:", "")).alias("value")))


def _value(headers: str, name: str) -> Column:
    """The first value of a header, null if it is absent."""
    return F.get(F.filter(headers, lambda h: h["name"] == name), F.lit(0))["value"]


def parse(df: DataFrame, record: str = "record") -> DataFrame:
    """One row per record: type, id, url, url_key, at, headers, validators and body."""
    empty_line = BREAK + BREAK
    text = F.col(f"`{record}`").cast("string")
    split = df.select(text.alias("record")).withColumn("warc", F.substring_index("record", empty_line, 1))
    # Positions are 1-based; the HTTP part starts after the first empty line.
    split = split.withColumn("http", F.substring(F.col("record"), F.length("warc") + 5, F.length("record")))
    split = split.withColumn("http_head", F.substring_index("http", empty_line, 1)).withColumn(
        "body", F.substring(F.col("http"), F.length("http_head") + 5, F.length("http"))
    )
    read = split.withColumn("fields", _headers(F.col("warc"))).withColumn("headers", _headers(F.col("http_head")))
    return read.select(
        _value("fields", "warc-type").alias("type"),
        _value("fields", "warc-record-id").alias("record_id"),
        _value("fields", "warc-target-uri").alias("url"),
        canonical_url(_value("fields", "warc-target-uri")).alias("url_key"),
        F.unix_micros(F.try_to_timestamp(_value("fields", "warc-date"))).alias("at"),
        F.regexp_extract("http_head", r"^HTTP/[0-9.]+ +([0-9]{3})", 1).try_cast("int").alias("status"),
        "headers",
        _value("headers", "etag").alias("etag"),
        _value("headers", "last-modified").alias("last_modified"),
        _value("fields", "warc-payload-digest").alias("payload_digest"),
        "body",
    )


def _previous(times: DataFrame, level: int) -> DataFrame:
    """For each (url_key, node): the latest (at, record_id) of a response in a node before it, null if none."""
    parent = F.shiftright("node", BITS)
    if level == LEVELS - 1:
        # The nodes that are left last hours each: a URL has some thousand a year at most.
        before = Window.partitionBy("url_key").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
        return times.select("url_key", "node", F.last("found", ignorenulls=True).over(before).alias("previous"))
    before = Window.partitionBy("url_key", parent).orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    near = times.withColumn("near", F.last("found", ignorenulls=True).over(before)).withColumn("parent", parent)
    above = times.groupBy("url_key", parent.alias("node")).agg(F.max("found").alias("found"))
    far = _previous(above, level + 1).select("url_key", F.col("node").alias("parent"), F.col("previous").alias("far"))
    return near.join(far, ["url_key", "parent"], "left").select("url_key", "node", F.coalesce("near", "far").alias("previous"))


def resolve(captures: DataFrame) -> DataFrame:
    """Every revisit of ``captures`` (rows of ``parse``) with its outcome, source and merged headers."""
    meta = ["record_id", "headers", "etag", "last_modified", "payload_digest"]
    folder = f"{work_folder(captures.sparkSession)}/captures-{uuid4().hex}"
    # Everything but the bodies, parsed once and read by each branch below.
    light = captures.select("type", "url", "url_key", "at", "status", *meta, F.length("body").alias("length"))
    light.write.parquet(folder)
    captures = captures.sparkSession.read.parquet(folder)
    kept = captures.filter(F.col("type").isin("response", "revisit") & F.col("at").isNotNull() & F.col("url_key").isNotNull() & F.col("record_id").isNotNull())
    full = (F.col("type") == "response") & F.col("status").between(200, 299)
    events = kept.filter(full | (F.col("type") == "revisit"))
    found = F.when(full, F.struct("at", "record_id"))
    times = events.groupBy("url_key", F.col("at").alias("node")).agg(F.max(found).alias("found"))
    previous = _previous(times, 0).select("url_key", F.col("node").alias("at"), F.col("previous.record_id").alias("source_id"))

    sources = kept.filter(full).select(F.col("url_key").alias("source_key"), *(F.col(c).alias(f"source_{c}") for c in meta), F.col("length").alias("source_length"))
    # Responses may repeat; one row per id is enough to merge from.
    sources = sources.groupBy("source_key", "source_record_id").agg(*(F.first(c).alias(c) for c in sources.columns[2:]))
    revisits = kept.filter("type = 'revisit'").select("url", "url_key", "at", *meta)
    joined = revisits.join(previous, ["url_key", "at"], "left").join(
        sources, (F.col("url_key") == F.col("source_key")) & (F.col("source_id") == F.col("source_record_id")), "left"
    )

    def bare(tag: str) -> Column:
        return F.regexp_replace(tag, "^W/", "")

    pairs = [(bare("etag"), bare("source_etag"))] + [(F.col(c), F.col(f"source_{c}")) for c in ("last_modified", "payload_digest")]
    verdicts = F.array(*(a == b for a, b in pairs))
    outcome = (
        F.when(F.col("source_record_id").isNull(), "missing")
        .when(F.exists(verdicts, lambda v: F.coalesce(~v, F.lit(False))), "mismatch")
        .when(F.exists(verdicts, lambda v: F.coalesce(v, F.lit(False))), "resolved")
        .otherwise("unverified")
    )
    allowed = F.filter("headers", lambda h: ~h["name"].isin(*FIXED_HEADERS))
    names = F.transform(allowed, lambda h: h["name"])
    stay = F.filter("source_headers", lambda h: ~F.array_contains("names", h["name"]))
    usable = F.col("outcome").isin("resolved", "unverified")
    return (
        joined.withColumn("outcome", outcome)
        .withColumn("allowed", allowed)
        .withColumn("names", names)
        .select(
            "record_id",
            "url",
            "url_key",
            "at",
            "outcome",
            F.col("source_record_id").alias("source_id"),
            F.when(usable, F.concat(stay, F.col("allowed"))).alias("headers"),
            F.when(usable, F.col("source_payload_digest")).alias("payload_digest"),
            F.when(usable, F.col("source_length")).alias("n_chars"),
        )
    )


def with_bodies(resolved: DataFrame, captures: DataFrame) -> DataFrame:
    """The resolved revisits with the bodies of their sources; null where there is none.

    Bodies move through a shuffle, which ``resolve`` alone avoids.
    """
    full = captures.filter((F.col("type") == "response") & F.col("status").between(200, 299))
    bodies = full.groupBy(F.col("url_key"), F.col("record_id").alias("source_id")).agg(F.first("body").alias("body"))
    usable = F.col("outcome").isin("resolved", "unverified")
    return resolved.withColumn("source", F.when(usable, F.col("source_id"))).join(
        bodies.withColumnRenamed("source_id", "source"), ["url_key", "source"], "left"
    ).drop("source")
