"""Web captures whose payload was not stored again, resolved to the response that they repeat.

The as-of join to the latest earlier full response of the same canonical URL is done in two steps, so
that a URL with very many captures is spread over time slices: inside a slice a running maximum
finds it; the latest response of each slice is carried into the later ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

SLICE_SECONDS = 86_400
# Header fields of a not-modified answer that update the stored response (RFC 9110, RFC 9111).
PERMITTED_HEADERS = ["age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]
# Query parameters that track a visit and do not name another resource.
TRACKING = "^(utm_[a-z]+|ref|gclid|fbclid|sessionid)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, no scheme, fragment, tracking parameters or closing
    slash; the other parameters sorted.  Null stays null."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    bare = F.regexp_replace(bare, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    path = F.regexp_replace(bare, "\\?.*$", "")
    host = F.lower(F.regexp_extract(path, "^([^/]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)$", ""), "^www\\.", "")
    rest = F.regexp_replace(F.regexp_replace(path, "^[^/]*", ""), "/+$", "")
    asked = F.regexp_extract(bare, "\\?(.*)$", 1)
    parts = F.array_sort(F.filter(F.split(asked, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.concat(host, rest, F.when(F.size(parts) > 0, F.concat(F.lit("?"), F.array_join(parts, "&"))).otherwise(""))


def resolve_revisits(records: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Every revisit of ``records`` with the response that it stands for.

    ``records`` has ``record_id``, ``url``, ``captured`` (seconds, long), ``kind`` (``response`` or ``revisit``),
    ``etag``, ``last_modified``, ``digest`` and ``headers`` (a map with lower-case names).  Returns ``record_id``,
    ``canonical_url``, ``captured``, ``status``, ``response_id``, ``response_captured`` and the merged ``headers``.

    The response is the one with the greatest time before the revisit's own (ties: greatest id).  Validators are
    checked in order: entity tags where both have one (weak marks ignored), else dates of last
    modification, else payload digests; a difference, or nothing to compare, gives ``mismatch``.  ``resolved``
    takes the stored headers, updated by the permitted headers of the revisit; otherwise headers are null.  No earlier response, a
    null URL or a null time gives ``missing``.  Repeated rows are resolved each; extra columns are ignored.
    """
    rows = records.select(
        "record_id", canonical_url(F.col("url")).alias("canonical_url"), F.col("captured").cast("long").alias("captured"),
        "kind", F.regexp_replace("etag", "^W/", "").alias("etag"), "last_modified", "digest", "headers",
        F.floor(F.col("captured") / slice_seconds).alias("slice"),
    )
    known = F.col("canonical_url").isNotNull() & F.col("captured").isNotNull()
    order = F.when((F.col("kind") == "response") & known, F.struct("captured", "record_id"))
    found = F.struct("record_id", "captured", "etag", "last_modified", "digest", "headers")
    earlier = Window.partitionBy("canonical_url", "slice").orderBy("captured").rangeBetween(Window.unboundedPreceding, -1)
    lost = rows.filter(~known & (F.col("kind") == "revisit")).withColumn("found", F.lit(None).cast(rows.select(found.alias("f")).schema["f"].dataType))
    near = rows.filter(known).withColumn("near", F.max_by(found, order).over(earlier))
    before = Window.partitionBy("canonical_url").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.filter(known & (F.col("kind") == "response")).groupBy("canonical_url", "slice").agg(
        F.max_by(found, order).alias("last"), F.max(order).alias("order"))
    slices = rows.filter(known).select("canonical_url", "slice").distinct().join(carried, ["canonical_url", "slice"], "left")
    slices = slices.select("canonical_url", "slice", F.max_by("last", "order").over(before).alias("far"))
    met = near.filter("kind = 'revisit'").join(slices, ["canonical_url", "slice"]).withColumn("found", F.coalesce("near", "far"))
    out = met.select(*rows.columns, "found").unionByName(lost)
    was = F.col("found")
    same = (
        F.when(F.col("etag").isNotNull() & was["etag"].isNotNull(), F.col("etag") == was["etag"])
        .when(F.col("last_modified").isNotNull() & was["last_modified"].isNotNull(), F.col("last_modified") == was["last_modified"])
        .otherwise(F.coalesce(F.col("digest") == was["digest"], F.lit(False)))
    )
    status = F.when(was.isNull(), "missing").when(same, "resolved").otherwise("mismatch")
    update = F.map_filter(F.coalesce("headers", F.create_map().cast("map<string,string>")), lambda k, _: k.isin(PERMITTED_HEADERS))
    stored = F.map_filter(was["headers"], lambda k, _: ~F.map_contains_key(update, k))
    return out.select(
        "record_id", "canonical_url", "captured", status.alias("status"),
        was["record_id"].alias("response_id"), was["captured"].alias("response_captured"),
        F.when(status == "resolved", F.map_concat(F.coalesce(stored, F.create_map().cast("map<string,string>")), update)).alias("headers"),
    )


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Capture records derived from stored pages: each is a visit of its site's section page, a minute apart.

    Every third visit stored a full response.  The section's entity tag changes every 200 visits of the crawl; every
    fifth record carries none, and every seventh none but the digest of the same span.
    """
    id_ = F.col("page_id")
    url = F.regexp_replace("url", "^([a-z]+://[^/]+/[A-Za-z]+)/[0-9]+[^?#]*", "$1")
    span = F.floor(id_ / 200).cast("string")
    tag = F.md5(F.concat(canonical_url(url), F.lit(" "), span).cast("binary"))
    day = F.concat(F.lit("day "), span)
    response = F.pmod(id_, F.lit(3)) == 0
    etag = F.when(F.pmod(id_, F.lit(5)) != 0, tag)
    modified = F.when(F.pmod(id_, F.lit(7)) != 0, day)
    length = F.octet_length("html").cast("string")
    full = F.map_from_arrays(
        F.array(*map(F.lit, ("content-type", "content-length", "date", "etag"))),
        F.array(F.lit("text/html"), length, id_.cast("string"), F.coalesce(etag, F.lit(""))))
    short = F.map_from_arrays(
        F.array(*map(F.lit, ("content-length", "date", "cache-control"))),
        F.array(F.lit("0"), id_.cast("string"), F.concat(F.lit("max-age="), F.pmod(id_, F.lit(600)).cast("string"))))
    return pages.select(
        id_.alias("record_id"), url.alias("url"), (id_ * 60).alias("captured"),
        F.when(response, "response").otherwise("revisit").alias("kind"), etag.alias("etag"), modified.alias("last_modified"),
        tag.alias("digest"), F.when(response, full).otherwise(short).alias("headers"),
    )
