"""Not-modified revisit records of a web archive, resolved.

A revisit (304) record stores no body. It is joined as of its time, by
canonical url, to the latest earlier full (200) response; its validators
are checked against that response's, and where they agree, the stored
headers are updated by those of the 304 that may be updated (RFC 9111,
sections 3.2 and 4.3.4).

Outcomes: ``etag`` or ``last-modified`` (the validator that agreed),
``unvalidated`` (neither side has one), ``mismatch``, ``missing`` (no
earlier response). Null urls never match. Of responses at the same time
the one with the greatest record id is the latest; a response at the
revisit's own time is not earlier. Repeated revisits are resolved each.

A url's records are cut by ranges of time: the latest response inside a
range comes from a window, the one before it from a window over one row
per range. So a url with a third of all records is many small groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TIME_RANGES = 512
#: Headers of a 304 that don't update the stored response (fixed values).
NOT_UPDATED = (
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive", "proxy-authenticate",
    "proxy-authentication-info", "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade",
)


def canonical_url(url: Column) -> Column:
    """Scheme, user, www prefix, default port, fragment, tracking
    parameters and a final slash removed; host in lower case; the other
    parameters sorted. Null stays null."""
    rest = F.regexp_replace(F.regexp_replace(url, "(?s)#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.lower(F.regexp_extract(rest, "^[^/?]*", 0))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "(?s)^.*@", ""), "^www[0-9]*[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(rest, r"(?s)^[^?]*\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(utm_[^=]*|ref|fbclid|gclid|sessionid)(=|$)")))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    return F.concat(host, path, tail)


def header(entries: Column, name: str) -> Column:
    """The first value of a header in an array of (name, value)."""
    return F.get(F.filter(entries, lambda e: F.lower(e["name"]) == name), F.lit(0))["value"]


def resolved(records: DataFrame, ranges: int = TIME_RANGES) -> DataFrame:
    """(record_id, url, response_id, outcome, headers) of each 304 record
    of ``records`` (record_id long, url string, time long, status int,
    headers array<struct<name, value>>)."""
    rows = records.select("record_id", canonical_url(F.col("url")).alias("canon"), F.col("time").cast("long").alias("time"), "status", "headers")
    ends = rows.agg(F.min("time"), F.max("time")).first()
    first, width = ends[0] or 0, max(1, ((ends[1] or 0) - (ends[0] or 0)) // ranges + 1)
    rows = rows.withColumn("range", F.floor((F.col("time") - first) / width))
    full = (F.col("status") == 200) & F.col("canon").isNotNull() & F.col("time").isNotNull()
    response = F.when(full, F.struct("time", "record_id", "headers"))
    inside = Window.partitionBy("canon", "range").orderBy("time").rangeBetween(Window.unboundedPreceding, -1)
    near = rows.withColumn("near", F.max(response).over(inside)).where("status = 304")
    by_range = rows.where(full).groupBy("canon", "range").agg(F.max(F.struct("time", "record_id", "headers")).alias("last"))
    # ranges with revisits get a row too, so that the window sees them
    asked = rows.where("status = 304 and canon is not null").select("canon", "range").distinct()
    before = Window.partitionBy("canon").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    far = by_range.join(asked.withColumn("asked", F.lit(True)), ["canon", "range"], "full").withColumn("far", F.max("last").over(before)).where("asked").select("canon", "range", "far")
    found = near.join(far, ["canon", "range"], "left").withColumn("r", F.coalesce("near", "far"))

    stored = F.col("r.headers")
    opaque = lambda tag: F.regexp_replace(tag, "^W/", "")
    etag, old_etag = opaque(header(F.col("headers"), "etag")), opaque(header(stored, "etag"))
    changed, old_changed = header(F.col("headers"), "last-modified"), header(stored, "last-modified")
    outcome = (F.when(F.col("r").isNull(), "missing")
               .when(etag.isNotNull(), F.when(etag == old_etag, "etag").otherwise("mismatch"))
               .when(changed.isNotNull(), F.when(changed == old_changed, "last-modified").otherwise("mismatch"))
               .when(old_etag.isNull() & old_changed.isNull(), "unvalidated").otherwise("mismatch"))
    update = F.filter("headers", lambda e: ~F.lower(e["name"]).isin(*NOT_UPDATED))
    names = F.transform(update, lambda e: F.lower(e["name"]))
    merged = F.concat(F.filter(stored, lambda e: ~F.array_contains(names, F.lower(e["name"]))), update)
    agreed = F.col("outcome").isin("etag", "last-modified", "unvalidated")
    return found.withColumn("outcome", F.coalesce(outcome, F.lit("mismatch"))).select(
        "record_id", F.col("canon").alias("url"), F.when(agreed, F.col("r.record_id")).alias("response_id"), "outcome", F.when(agreed, merged).alias("headers"))


def crawl(pages: DataFrame) -> DataFrame:
    """A capture log derived from ``pages``: page p is fetched at second
    60 p and asked for again 30 s plus 0 to 4 hours later with a 304. One
    in 13 fetches fails; some responses lack one validator or both, some
    304s have a weak or an outdated tag."""
    p = F.col("page_id")
    pair = lambda name, value: F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 16), F.lit('"'))
    changed = F.when(p % 6 != 5, p * 60 - (p % 7) * 86400)
    has_tag = p % 4 != 1
    again = p * 60 + 30 + (p % 5) * 3600
    response = F.array(pair("ETag", F.when(has_tag, tag)), pair("Last-Modified", changed), pair("Content-Type", F.lit("text/html")),
                       pair("Content-Length", F.octet_length(F.coalesce("html", F.lit("")))), pair("Cache-Control", F.concat(F.lit("max-age="), (p % 10) * 60)), pair("Date", p * 60))
    sent = F.when(p % 11 == 0, F.lit('"old"')).when(p % 3 == 0, F.concat(F.lit("W/"), tag)).otherwise(tag)
    revisit = F.array(pair("etag", F.when(has_tag, sent)), pair("last-modified", changed), pair("cache-control", F.concat(F.lit("max-age="), (p % 10) * 120)),
                      pair("content-length", F.lit(0)), pair("date", again), pair("connection", F.lit("close")))
    both = F.array(
        F.struct((p * 2).alias("record_id"), (p * 60).alias("time"), F.when(p % 13 == 12, 503).otherwise(200).alias("status"), response.alias("headers")),
        F.struct((p * 2 + 1).alias("record_id"), again.alias("time"), F.lit(304).alias("status"), revisit.alias("headers")))
    out = pages.select("url", F.explode(both).alias("r")).select("r.record_id", "url", "r.time", "r.status", "r.headers")
    return out.withColumn("headers", F.filter("headers", lambda e: e["value"].isNotNull()))


def listing(found: DataFrame) -> DataFrame:
    """Resolved records with the page ids and the headers as sorted lines."""
    lines = F.array_sort(F.transform("headers", lambda e: F.concat(F.lower(e["name"]), F.lit(": "), e["value"])))
    half = lambda c: F.floor(F.col(c) / 2).cast("long")
    return found.select("record_id", half("record_id").alias("page_id"), "url", half("response_id").alias("response_page_id"), "outcome", F.array_join(lines, "\n").alias("headers"))


ORACLE = r"""
WITH u AS (SELECT page_id AS p, regexp_replace(regexp_replace(url, '(?s)#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest, '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS tag, strlen(coalesce(html, '')) AS len FROM pages),
v AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), '(?s)^.*@', ''), '^www[0-9]*[.]', ''), ':(80|443)$', '') AS host,
  regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
  list_sort([x FOR x IN string_split(regexp_extract(rest, '(?s)^[^?]*\?(.*)$', 1), '&') IF x <> '' AND NOT regexp_matches(x, '^(utm_[^=]*|ref|fbclid|gclid|sessionid)(=|$)')]) AS q FROM u),
c AS (SELECT p, host || path || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END AS url, tag, len,
  CASE WHEN p % 4 <> 1 THEN tag END AS etag, CASE WHEN p % 6 <> 5 THEN p * 60 - (p % 7) * 86400 END AS lm, p * 60 + 30 + (p % 5) * 3600 AS again FROM v),
a AS (SELECT *, CASE WHEN p % 4 <> 1 THEN CASE WHEN p % 11 = 0 THEN '"old"' WHEN p % 3 = 0 THEN 'W/' || tag ELSE tag END END AS sent FROM c),
j AS (SELECT a.p, a.url, a.sent, a.lm, a.again, max(struct_pack(t := r.p * 60, p := r.p)).p AS rp FROM a LEFT JOIN c r ON r.url = a.url AND r.p % 13 <> 12 AND r.p * 60 < a.again GROUP BY ALL),
k AS (SELECT j.*, r.etag AS oe, r.lm AS ol, r.len AS olen, CASE WHEN rp IS NULL THEN 'missing'
  WHEN sent IS NOT NULL THEN CASE WHEN regexp_replace(sent, '^W/', '') = r.etag THEN 'etag' ELSE 'mismatch' END
  WHEN j.lm IS NOT NULL THEN CASE WHEN j.lm = r.lm THEN 'last-modified' ELSE 'mismatch' END
  WHEN r.etag IS NULL AND r.lm IS NULL THEN 'unvalidated' ELSE 'mismatch' END AS outcome FROM j LEFT JOIN c r ON r.p = j.rp)
SELECT p * 2 + 1 AS record_id, p AS page_id, url, CASE WHEN outcome NOT IN ('missing', 'mismatch') THEN rp END AS response_page_id, outcome,
  CASE WHEN outcome NOT IN ('missing', 'mismatch') THEN array_to_string(list_sort([x FOR x IN ['etag: ' || coalesce(sent, oe), 'last-modified: ' || coalesce(lm, ol), 'content-type: text/html', 'content-length: ' || olen,
  'cache-control: max-age=' || (p % 10) * 120, 'date: ' || again] IF x IS NOT NULL]), chr(10)) END AS headers FROM k
"""
