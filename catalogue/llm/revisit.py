"""Not-modified revisits resolved to the capture they stand for.

A crawler that meets an unchanged page stores a revisit record (status 304, headers only). Each is joined, as of its
time, to the latest earlier full response of the same canonical URL; the validators of the two are compared, and the
response's headers are merged with those that a 304 may update.

The as-of join never gathers a URL: rows meet in (URL, time bucket), and what an earlier bucket knew last is carried
over bucket by bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: width of a time bucket in milliseconds
BUCKET_MS = 86_400_000
# fixed values: headers that a 304 response may update, in lower case
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary")
#: query parameters that do not change a page
TRACKING = r"^(utm_[a-z]+|fbclid|gclid|msclkid|ref|sessionid|jsessionid|phpsessid|sid)(=|$)"
URL = r"(?i)^[a-z][a-z0-9+.-]*://(?:[^@/?#]*@)?([^:/?#]+)(?::(\d+))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def canonical_url(url: Column) -> Column:
    """Host without user, ``www.`` and default port, path without a closing slash, other parameters in order.

    http and https count as one, fragments and tracking parameters are dropped. What is no URL with a host stays as it
    is, without white space around it; null stays null.
    """
    raw = F.trim(url)
    host = F.regexp_replace(F.lower(F.regexp_extract(raw, URL, 1)), r"^www\d*\.", "")
    port = F.regexp_extract(raw, URL, 2)
    path = F.regexp_replace(F.regexp_replace(F.regexp_extract(raw, URL, 3), "/{2,}", "/"), "/$", "")
    parameters = F.filter(F.split(F.regexp_extract(raw, URL, 4), "&"), lambda p: (p != "") & ~F.lower(p).rlike(TRACKING))
    query = F.array_join(F.array_sort(parameters), "&")
    built = F.concat(host, F.when(port.isin("", "80", "443"), "").otherwise(F.concat(F.lit(":"), port)), path,
                     F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    return F.when(raw.rlike(URL), built).otherwise(raw)


def _header(headers: str | Column, name: str) -> Column:
    return F.try_element_at(headers, F.lit(name))


def _lowered(headers: Column) -> Column:
    """Header names in lower case; of names that differ in case only, the one that sorts first counts."""
    pairs = F.transform(F.array_sort(F.map_entries(headers)), lambda e: F.struct(F.lower(e.key).alias("key"), e.value.alias("value")))
    first = F.filter(pairs, lambda e, i: F.array_position(F.transform(pairs, lambda p: p.key), e.key) == i + 1)
    return F.map_from_entries(first)


def resolve(records: DataFrame, bucket_ms: int = BUCKET_MS) -> DataFrame:
    """One row per revisit: record_id, canonical_url, ts, outcome, refers_to, refers_ts, payload_digest, headers.

    ``records`` has record_id, kind ('response' or 'revisit'), url, ts (milliseconds), status, payload_digest and
    headers (a map). A full response has status 200. outcome is

        resolved     the latest earlier full response has the same entity tag (compared weakly), or without tags on
                     both sides the same Last-Modified, or without those the same payload digest
        changed      that response's validators differ
        unverified   there is nothing on both sides to compare
        missing      there is no earlier full response, or the revisit has no URL or time

    Only a resolved row has payload_digest and headers: the response's, updated by the permitted ones of the revisit.
    Of several responses at one time the one whose record_id sorts last counts; a response at the revisit's own time
    is not earlier. A null map has no headers. Repeated revisits keep a row each; an empty table gives no rows;
    further columns are ignored.
    """
    rows = records.select("record_id", "kind", canonical_url(F.col("url")).alias("canonical_url"), F.col("ts").cast("long").alias("ts"),
                          "status", "payload_digest", _lowered(F.coalesce("headers", F.create_map().cast("map<string,string>"))).alias("headers"))
    placed = rows.where("canonical_url IS NOT NULL AND ts IS NOT NULL").withColumn("_bucket", F.floor(F.col("ts") / bucket_ms))
    full = (F.col("kind") == "response") & (F.col("status") == 200)
    at = F.when(full, F.struct("ts", "record_id"))
    what = F.struct("record_id", "ts", "payload_digest", "headers")
    inside = Window.partitionBy("canonical_url", "_bucket").orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_near", F.max_by(what, at).over(inside))
    # one row per URL and bucket from here on
    last = placed.where(full).groupBy("canonical_url", "_bucket").agg(F.max_by(what, at).alias("_last"))
    asked = placed.where("kind = 'revisit'").groupBy("canonical_url", "_bucket").agg(F.lit(1).alias("_asked"))
    before = Window.partitionBy("canonical_url").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = asked.join(last, ["canonical_url", "_bucket"], "full").withColumn("_far", F.last("_last", ignorenulls=True).over(before))
    carried = carried.where("_asked = 1").select("canonical_url", "_bucket", "_far")
    found = placed.where("kind = 'revisit'").join(carried, ["canonical_url", "_bucket"], "left")
    found = found.withColumn("to", F.coalesce("_near", "_far")).drop("_near", "_far", "_bucket")
    nowhere = rows.where("kind = 'revisit' AND (canonical_url IS NULL OR ts IS NULL)")
    found = found.unionByName(nowhere.withColumn("to", F.lit(None).cast(found.schema["to"].dataType)))

    def both(mine: Column, theirs: Column) -> Column:
        return mine.isNotNull() & theirs.isNotNull()

    theirs = F.col("to.headers")
    tag, their_tag = (F.regexp_replace(_header(h, "etag"), "^W/", "") for h in ("headers", theirs))
    when, their_when = _header("headers", "last-modified"), _header(theirs, "last-modified")
    digest, their_digest = F.col("payload_digest"), F.col("to.payload_digest")
    same = F.when(both(tag, their_tag), tag == their_tag).when(both(when, their_when), when == their_when).when(
        both(digest, their_digest), digest == their_digest)
    outcome = F.when(F.col("to").isNull(), "missing").when(same.isNull(), "unverified").when(same, "resolved").otherwise("changed")
    found = found.withColumn("outcome", outcome)
    update = F.map_filter("headers", lambda k, _: k.isin(*PERMITTED))
    merged = F.map_concat(F.map_filter(theirs, lambda k, _: ~F.map_contains_key(update, k)), update)
    good = F.col("outcome") == "resolved"
    return found.select("record_id", "canonical_url", "ts", "outcome", F.col("to.record_id").alias("refers_to"), F.col("to.ts").alias("refers_ts"),
                        F.when(good, their_digest).alias("payload_digest"), F.when(good, merged).alias("headers"))


def header_text(headers: Column) -> Column:
    """Headers as sorted lines, for comparison and storage."""
    return F.array_join(F.array_sort(F.transform(F.map_entries(headers), lambda e: F.concat(e.key, F.lit(": "), e.value))), "\n")


def attach_payload(resolved: DataFrame, payloads: DataFrame) -> DataFrame:
    """Resolved revisits with the payload of the response each refers to; payloads has record_id and payload."""
    return resolved.join(payloads.select(F.col("record_id").alias("refers_to"), "payload"), "refers_to", "left")
