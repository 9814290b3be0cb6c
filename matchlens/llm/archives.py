"""Archive records made of the pages table, as a crawler that asks again would have written them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIRST = "2024-01-01 00:00:00"


def records(pages: DataFrame) -> DataFrame:
    """One ``record`` per capture of a page: 2 to 5 captures, from its id and URL.

    The first capture is a full response (a not-modified answer for every
    eleventh page), the fourth is a full response with a changed body, the
    others are not-modified answers; some of those carry a wrong entity tag,
    or none, or no validator at all.
    """
    p, j = F.col("page_id"), F.col("j")
    captures = pages.withColumn("j", F.explode(F.sequence(F.lit(0), (F.coalesce(p, F.lit(0)) % 4 + 1).cast("int"))))
    response = ((j == 0) & (p % 11 != 0)) | (j == 3)
    seconds = (p % 97) * 3600 + j * ((1 + p % 3) * 86400 + 7)
    version = F.when(response, F.when(j == 3, 1).otherwise(0)).otherwise(F.when(j > 3, 1).otherwise(0))
    body = F.concat(F.coalesce(F.col("html"), F.lit("")), F.when(j == 3, F.lit("<!-- changed -->")).otherwise(""))
    date = F.date_format(F.timestamp_seconds(F.unix_timestamp(F.lit(FIRST)) + seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    etag = F.when(~response & (p % 13 == 5), F.lit('"other"')).otherwise(F.concat(F.when(j % 2 == 1, "W/").otherwise(""), F.lit('"'), p, F.lit("-"), version, F.lit('"')))
    bare = ~response & (p % 7 == 3)

    def lines(*parts: Column) -> Column:
        return F.concat(F.array_join(F.array_compact(F.array(*parts)), "\r\n"), F.lit("\r\n\r\n"))

    head = lines(
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(response, "response").otherwise("revisit")),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), p, F.lit(":"), j, F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.concat(F.lit("WARC-Date: "), date),
        F.when(response, F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.sha2(body, 256))),
        F.when(~response, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/server-not-modified")),
    )
    http = lines(
        F.when(response, "HTTP/1.1 200 OK").otherwise("HTTP/1.1 304 Not Modified"),
        F.concat(F.lit("Date: "), date),
        F.when(~bare, F.concat(F.lit("ETag: "), etag)),
        F.when(response, F.lit("Content-Type: text/html; charset=utf-8")),
        F.when(response, F.lit("Server: origin")),
        F.when(~response, F.lit("Content-Length: 0")),
        F.concat(F.lit("Cache-Control: max-age="), j),
    )
    return captures.select(F.concat(head, http, F.when(response, body).otherwise("")).alias("record"))
