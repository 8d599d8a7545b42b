"""Not-modified revisits of web captures, resolved to the page they stand for.

A revisit record (a 304 answer) has headers but no body. It is joined as-of, by
canonical URL, to the latest earlier full response; its validators are checked
against that response; where they agree, the permitted headers of the revisit
update those of the response, and the response's body is the revisit's body.

The as-of join runs in time buckets of a URL, so a URL that holds a third of
all captures is spread over many tasks: inside a bucket the last response is a
running window; across buckets only one closing response per bucket is carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_SECONDS = 3600
# Query parameters that name a visit, not a page (fixed list).
VISIT_PARAMS = r"(?:utm_[a-z]+|gclid|fbclid|sessionid)"
# Headers that a 304 answer must not change: those of the body and of the connection (fixed list).
NOT_MERGED = ["connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
              "proxy-authenticate", "proxy-authorization", "set-cookie", "te", "trailer", "transfer-encoding", "upgrade"]


def canonical_url(url: Column) -> Column:
    """Host in lower case without www and default port, then path and query
    without fragment, visit parameters and closing slashes; no scheme. Null
    stays null."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    host = F.lower(F.regexp_extract(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^www[0-9]*\.", ""), r":(?:80|443)$", "")
    rest = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*", "")
    rest = F.regexp_replace(rest, rf"&{VISIT_PARAMS}=[^&]*", "")
    rest = F.regexp_replace(rest, rf"\?{VISIT_PARAMS}=[^&]*&", "?")
    rest = F.regexp_replace(rest, rf"\?{VISIT_PARAMS}=[^&]*$", "")
    return F.concat(host, F.regexp_replace(rest, r"/+$", ""))


def lower_names(headers: Column) -> Column:
    """Header names in lower case; of names that then agree the last stays. Null: none."""
    entries = F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    return F.map_from_entries(F.transform(names, lambda n: F.struct(
        n.alias("key"), F.element_at(F.filter(entries, lambda e: F.lower(e["key"]) == n), -1)["value"].alias("value"))))


def merge_headers(stored_headers: Column, update: Column) -> Column:
    """Stored headers, updated by the permitted ones of a 304 answer (names in lower case)."""
    permitted = F.map_filter(update, lambda k, v: ~k.isin(NOT_MERGED))
    return F.map_concat(F.map_filter(stored_headers, lambda k, v: ~F.map_contains_key(permitted, k)), permitted)


def _strong(tag: Column) -> Column:
    return F.regexp_replace(F.trim(tag), r"^W/", "")


def resolve_revisits(captures: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Captures (record_id, url, ts, kind, headers) -> one row per revisit.

    Columns: record_id, canonical, ts, status, response_id, headers. ``ts`` is
    in whole seconds; kind is 'response' or 'revisit', others are left out.
    Earlier means strictly earlier; of responses at one time the largest id
    counts. status: 'resolved' (validators agree: entity tag by weak
    comparison, else Last-Modified), 'changed' (they differ), 'unverified' (the
    revisit names no validator that the response has), 'orphan' (no earlier
    response, or no URL or time). headers are merged where resolved, else the
    revisit's own. Repeated rows are resolved each for itself; an empty table
    gives an empty result; other columns are not read.
    """
    rows = captures.where(F.col("kind").isin("response", "revisit")).select(
        "record_id", canonical_url(F.col("url")).alias("canonical"), F.col("ts").cast("long").alias("ts"), "kind",
        lower_names(F.col("headers")).alias("headers"))
    lost = rows.where("kind = 'revisit' and (canonical is null or ts is null)").select(
        "record_id", "canonical", "ts", "headers", F.lit(None).cast("struct<response_id:bigint,h:map<string,string>>").alias("found"))
    rows = rows.where("canonical is not null and ts is not null").withColumn(
        "bucket", F.floor(F.col("ts") / bucket_seconds))
    response = F.when(F.col("kind") == "response", F.struct(
        F.col("record_id").cast("long").alias("response_id"), F.col("headers").alias("h")))
    # a revisit sorts before a response of the same second: strictly earlier only
    order = Window.partitionBy("canonical", "bucket").orderBy(
        "ts", (F.col("kind") == "response").cast("int"), "record_id")
    inside = rows.withColumn("own", F.last(response, ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    closing = rows.where("kind = 'response'").groupBy("canonical", "bucket").agg(
        F.max_by(F.struct(F.col("record_id").cast("long").alias("response_id"), F.col("headers").alias("h")),
                 F.struct("ts", "record_id")).alias("tail"))
    # per URL one row a bucket: the closing response of the latest earlier bucket
    open_buckets = inside.where("kind = 'revisit' and own is null").select("canonical", "bucket").distinct()
    timeline = closing.join(open_buckets.withColumn("asked", F.lit(True)), ["canonical", "bucket"], "full")
    before = Window.partitionBy("canonical").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = timeline.withColumn("carry", F.last("tail", ignorenulls=True).over(before)).where("asked").select(
        "canonical", "bucket", "carry")
    visits = inside.where("kind = 'revisit'")
    found = visits.join(carried, ["canonical", "bucket"], "left").select(
        "record_id", "canonical", "ts", "headers", F.coalesce("own", "carry").alias("found"))
    found = found.union(lost)
    mine, theirs = F.col("headers"), F.col("found.h")
    tag, their_tag = mine["etag"], theirs["etag"]
    date, their_date = mine["last-modified"], theirs["last-modified"]
    status = (F.when(F.col("found").isNull(), "orphan")
              .when(tag.isNotNull() & their_tag.isNotNull(),
                    F.when(_strong(tag) == _strong(their_tag), "resolved").otherwise("changed"))
              .when(date.isNotNull() & their_date.isNotNull(),
                    F.when(F.trim(date) == F.trim(their_date), "resolved").otherwise("changed"))
              .otherwise("unverified"))
    return found.withColumn("status", status).select(
        "record_id", "canonical", "ts", "status", F.col("found.response_id").alias("response_id"),
        F.when(F.col("status") == "resolved", merge_headers(theirs, mine)).otherwise(mine).alias("headers"))


def with_body(resolved: DataFrame, bodies: DataFrame) -> DataFrame:
    """Add ``body`` of the resolved rows from (response_id, body); null elsewhere."""
    wanted = F.when(F.col("status") == "resolved", F.col("response_id"))
    # rows without a body get spread-out keys: nulls would all meet in one task
    key = F.coalesce(wanted, -1 - F.abs(F.xxhash64("record_id") % 1_000_000))
    return resolved.withColumn("wanted", key).join(
        bodies.select(F.col("response_id").alias("wanted"), "body"), "wanted", "left").drop("wanted")


def captures_of(pages: DataFrame) -> DataFrame:
    """Captures derived from pages: one full response each, and 304 answers by
    rules on page_id (same tag, stale tag, date only, before any response, no
    validator). The table has no crawl times or headers of its own."""
    p = F.col("page_id")
    begin = F.lit(1_700_000_000) + (p % 997) * 3600
    http_date = lambda s: F.concat(F.date_format(F.timestamp_seconds(s), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    tag = F.concat(F.lit('"'), F.substring(F.md5("html"), 1, 16), F.lit('"'))
    changed = http_date(begin - (p % 89) * 60)

    def record(v, kind, after, when=None, **headers):
        pairs = [x for k, h in headers.items() for x in (F.lit(k.replace("_", "-")), h if isinstance(h, Column) else F.lit(h))]
        pairs += [F.lit("Date"), http_date(begin + after)]
        row = F.struct((p * 8 + v).alias("record_id"), F.lit(kind).alias("kind"), (begin + after).alias("ts"),
                       F.create_map(*pairs).alias("headers"))
        return row if when is None else F.when(when, row)

    records = F.array(
        record(0, "response", 0, Content_Type="text/html; charset=utf-8", ETag=tag, Last_Modified=changed,
               Content_Length=F.octet_length("html").cast("string"), Cache_Control="max-age=600"),
        record(1, "revisit", 86_400, ETag=F.when(p % 2 == 0, F.concat(F.lit("W/"), tag)).otherwise(tag),
               Content_Length="0", Cache_Control="max-age=1200"),
        record(2, "revisit", 172_800, p % 3 == 0, ETag='"stale"', Cache_Control="no-cache"),
        record(3, "revisit", 90_000, p % 5 == 0, Last_Modified=changed, Expires="0"),
        record(4, "revisit", -31_536_000, p % 7 == 0, ETag=tag),
        record(5, "revisit", 100_000, p % 11 == 0, Cache_Control="private"))
    return pages.select("url", F.explode(F.filter(records, lambda r: r.isNotNull())).alias("r")).select(
        F.col("r.record_id").alias("record_id"), "url", F.col("r.ts").alias("ts"), F.col("r.kind").alias("kind"),
        F.col("r.headers").alias("headers"))
