"""Not-modified revisits of a web archive, resolved to the response they repeat.

A revisit record says that a page had not changed since an earlier capture. It is joined
as of its own time, by canonical URL, to the latest full response captured earlier. If
the validators agree, its headers are the response's, updated with those the revisit may
change; otherwise it stays unresolved and says why.

The as-of join runs in blocks of time: inside a block a window finds earlier responses,
and a second window, with one row per URL and block, carries the latest response into
later blocks. A URL captured very often is thereby spread over many tasks. Only keys go
through the windows; headers are joined to the result by record id.

Results for odd input: a record without URL or time, and a revisit without an earlier
response, is ``orphan``; equal times are not earlier; of responses of the same second
the one with the largest id counts; of responses with equal id, URL and time the one with
the least headers as text counts, so copies of a response are one; each repeated revisit
gives a row of its own, also where revisits of one id differ; NULL headers are empty ones;
an empty table gives an empty result; further columns do no harm; values of any length are
carried whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK_SECONDS = 3600

# Headers that a not-modified answer may not change in a stored response (RFC 9111, 3.1 and 3.2).
FIXED_HEADERS = (
    "connection content-encoding content-length content-range content-type keep-alive proxy-authenticate "
    "proxy-authentication-info proxy-authorization proxy-connection te trailer transfer-encoding upgrade"
).split()
# Query parameters that tell where a click came from, not what is shown.
TRACKING = ("fbclid", "gclid", "ref")


def canonical_url(url: Column) -> Column:
    """Host without ``www.`` and default port, path without last slash, sorted query without tracking.

    The scheme and the fragment do not count. Text without a scheme stays as it is.
    """
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    start = "^[A-Za-z][A-Za-z0-9+.-]*://"
    host = F.lower(F.regexp_extract(plain, start + "([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, "^www\\.", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(plain, start + "[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(plain, "\\?(.*)$", 1)
    name = lambda p: F.lower(F.regexp_extract(p, "^([^=]*)", 1))
    parts = F.filter(F.split(query, "&"), lambda p: (p != "") & ~name(p).startswith("utm_") & ~name(p).isin(*TRACKING))
    query = F.array_join(F.array_sort(parts), "&")
    whole = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return F.when(plain.rlike(start), whole).otherwise(plain)


def latest_earlier(records: DataFrame, block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """The response before each revisit, from (id, url_key, captured, is_response); captured in whole seconds.

    Returns revisit_id, response_id, response_at, and url_key and revisit_at of the revisit.
    """
    rows = records.filter(F.col("url_key").isNotNull() & F.col("captured").isNotNull())
    rows = rows.withColumn("block", F.floor(F.col("captured") / block_seconds))
    response = F.when(F.col("is_response"), F.struct("captured", "id"))
    blocks = rows.groupBy("url_key", "block").agg(F.max(response).alias("last"))
    ahead = Window.partitionBy("url_key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(F.col("url_key").alias("b_key"), F.col("block").alias("b_block"), F.max("last").over(ahead).alias("carried"))
    inside = Window.partitionBy("url_key", "block").orderBy("captured").rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("near", F.max(response).over(inside)).filter(~F.col("is_response"))
    rows = rows.join(blocks, (F.col("url_key") == F.col("b_key")) & (F.col("block") == F.col("b_block")))
    found = F.coalesce("near", "carried")
    return rows.select(
        F.col("id").alias("revisit_id"),
        found["id"].alias("response_id"),
        found["captured"].alias("response_at"),
        "url_key",
        F.col("captured").alias("revisit_at"),
    )


def _opaque(etag: Column) -> Column:
    return F.regexp_replace(etag, "^W/", "")


def resolve_revisits(records: DataFrame, block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """One row per revisit: record_id, url, captured, response_id, status, headers.

    ``records``: record_id long, url, captured long (seconds), kind (``response`` or
    ``revisit``), status_code int, headers map with names in lower case. Full responses
    are those with code 200. ``status`` is ``resolved`` (validators agree),
    ``unverified`` (the revisit names none), ``changed`` (they differ) or ``orphan``;
    headers are NULL for the last two.
    """
    empty = F.create_map().cast("map<string,string>")
    rows = records.select(
        F.col("record_id").alias("id"),
        "url",
        canonical_url(F.col("url")).alias("url_key"),
        "captured",
        ((F.col("kind") == "response") & (F.col("status_code") == 200)).alias("is_response"),
        (F.col("kind") == "revisit").alias("is_revisit"),
        F.coalesce("headers", empty).alias("headers"),
    )
    rows = rows.filter("is_response or is_revisit")
    # Id, URL and time name a record: with one row for each, a join adds no rows.
    pairs = latest_earlier(rows.select("id", "url_key", "captured", "is_response"), block_seconds)
    pairs = pairs.groupBy(F.col("revisit_id"), F.col("url_key").alias("p_key"), "revisit_at").agg(
        F.max(F.struct("response_at", "response_id")).alias("p")
    )
    revisits = rows.filter("is_revisit").drop("is_response", "is_revisit")
    in_order = F.array_sort(F.map_entries("headers")).cast("string")
    responses = rows.filter("is_response").groupBy(
        F.col("id").alias("r_id"), F.col("url_key").alias("r_key"), F.col("captured").alias("r_at")
    )
    responses = responses.agg(F.min_by("headers", in_order).alias("r_headers"))
    same_visit = (F.col("id") == F.col("revisit_id")) & (F.col("url_key") == F.col("p_key")) & (F.col("captured") == F.col("revisit_at"))
    found = revisits.join(pairs, same_visit, "left").withColumn("response_id", F.col("p.response_id"))
    same_response = (F.col("response_id") == F.col("r_id")) & (F.col("url_key") == F.col("r_key")) & (F.col("p.response_at") == F.col("r_at"))
    found = found.join(responses, same_response, "left")
    etag, modified = F.col("headers")["etag"], F.col("headers")["last-modified"]
    agrees = F.when(etag.isNotNull(), F.coalesce(_opaque(etag) == _opaque(F.col("r_headers")["etag"]), F.lit(False))).when(
        modified.isNotNull(), F.coalesce(modified == F.col("r_headers")["last-modified"], F.lit(False))
    )
    status = (
        F.when(F.col("r_id").isNull(), "orphan").when(agrees, "resolved").when(~agrees, "changed").otherwise("unverified")
    )
    allowed = F.map_filter("headers", lambda k, v: ~k.isin(*FIXED_HEADERS))
    kept = F.map_filter("r_headers", lambda k, v: ~F.map_contains_key(allowed, k))
    return found.withColumn("status", status).select(
        F.col("id").alias("record_id"),
        "url",
        "captured",
        F.when(F.col("status") != "orphan", F.col("response_id")).alias("response_id"),
        "status",
        F.when(F.col("status").isin("resolved", "unverified"), F.map_concat(kept, allowed)).alias("headers"),
    )


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Capture records that follow from a table of pages (page_id, url, html).

    Every page has a full response and two revisits, one with an ETag and one with a
    date; every third page also has a second full response with other content.
    """
    n, day = F.col("page_id"), 86400
    base = F.lit(1_600_000_000) + n * 41 % 5_000_011
    etag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    later = F.concat(F.lit('"'), F.md5(F.concat(F.coalesce("html", F.lit("")), F.lit("+"))), F.lit('"'))
    text = lambda c: c.cast("string")
    full = lambda tag, at: F.create_map(
        F.lit("content-length"), text(F.length(F.coalesce("html", F.lit("")))), F.lit("content-type"), F.lit("text/html"),
        F.lit("etag"), tag, F.lit("last-modified"), text(at - 60), F.lit("server"), F.lit("archive"),
    )
    first_visit, second_visit, renewed = base + (n % 9 - 2) * day, base + 30 * day, base + 10 * day
    tag_sent = F.when(n % 5 == 0, later).otherwise(F.concat(F.lit("W/"), etag))
    same = F.create_map(
        F.lit("cache-control"), F.lit("max-age=60"), F.lit("content-length"), F.lit("0"), F.lit("date"), text(first_visit), F.lit("etag"), tag_sent
    )
    dated = F.create_map(F.lit("date"), text(second_visit), F.lit("last-modified"), text(F.when(n % 3 == 0, renewed).otherwise(base) - 60))
    record = lambda k, kind, at, code, headers: F.struct(
        (n * 4 + k).alias("record_id"), at.alias("captured"), F.lit(kind).alias("kind"), F.lit(code).alias("status_code"), headers.alias("headers")
    )
    records = F.array(
        record(0, "response", base, 200, full(etag, base)),
        record(1, "revisit", first_visit, 304, same),
        record(2, "revisit", second_visit, 304, dated),
        F.when(n % 3 == 0, record(3, "response", renewed, 200, full(later, renewed))),
    )
    return pages.select("url", F.explode(F.filter(records, lambda r: r.isNotNull())).alias("r")).select("url", "r.*")
