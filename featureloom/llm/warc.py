"""Revisits without a body (304 Not Modified) resolved to the latest earlier full response.

An as-of join on the canonical URL, in DataFrame functions. Time is cut into slices: within (URL, slice)
a window finds the latest response before each revisit; the last response of every slice, one row
each after a partial aggregate, is carried on to the slices behind it. So no task holds more of a URL
than one slice of it and one row for each slice, however many records the URL has. Bodies are not
moved: the result names the record that holds the body.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Header fields that a 304 response may update (RFC 9110, 15.4.5, and RFC 9111, 3.2): fixed values.
PERMITTED = ["age", "cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary", "warning"]
# Query parameters that only track a visitor: a fixed pattern.
TRACKING = r"^(utm_[^=]*|fbclid|gclid|msclkid|ref)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case without scheme, ``www.``, user and default port; path without a last slash;
    query without tracking parameters, sorted; no fragment. Null for a null URL or one without ``://``."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    rest = F.regexp_extract(plain, r"^[A-Za-z][A-Za-z0-9+.\-]*://(.*)$", 1)
    host = F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":(80|443)?$", ""), r"^www\d*\.", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), "/+$", "")
    params = F.split(F.regexp_extract(rest, r"\?(.*)$", 1), "&")
    params = F.array_sort(F.filter(params, lambda p: (p != "") & ~p.rlike(TRACKING)))
    query = F.when(F.size(params) > 0, F.concat(F.lit("?"), F.array_join(params, "&"))).otherwise("")
    return F.when(host != "", F.concat(host, path, query))


def lower_headers(headers: Column) -> Column:
    """Header map with names in lower case; of names that then agree the first; null as empty."""
    entries = F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    value = lambda n: F.element_at(F.filter(entries, lambda e: F.lower(e["key"]) == n), 1)["value"]
    return F.map_from_arrays(names, F.transform(names, value))


def merged_headers(stored: Column, revisit: Column) -> Column:
    """The stored header fields, those of the revisit that a 304 may update in their place."""
    update = F.map_filter(revisit, lambda k, v: k.isin(PERMITTED))
    return F.map_concat(F.map_filter(stored, lambda k, v: ~F.array_contains(F.map_keys(update), k)), update)


def resolve_revisits(records: DataFrame, slice_seconds: int = 3600) -> DataFrame:
    """One row for each revisit among ``records(record_id, url, date, status, headers, digest)``.

    A full response has status 200, a revisit 304; other rows take no part. ``date`` is a timestamp, and of
    equal dates the smaller ``record_id`` is earlier. Rows: ``record_id``, ``canonical_url``, ``date``,
    ``outcome``, ``refers_to``, ``refers_to_date``, ``status`` (that of the response), ``headers``, ``digest``.

    Outcomes: ``no_url``; ``no_response`` (no earlier one); by validators, a weak comparison of ETags or
    else of Last-Modified, ``resolved`` or ``changed``; ``unvalidated`` if both sides have none in common.
    The headers and the digest are given where it is ``resolved`` or ``unvalidated``. A null date comes before all
    others; records that repeat are all kept, and a response is given by the greatest digest of those with its date
    and id. Further columns are not read; an empty table gives no rows.
    """
    rows = records.where(F.col("status").isin(200, 304)).select(
        F.col("record_id").alias("id"), canonical_url(F.col("url")).alias("u"), F.col("date").alias("d"),
        F.coalesce(F.unix_micros("date"), F.lit(-(1 << 62))).alias("t"), F.col("status").alias("st"),
        lower_headers(F.col("headers")).alias("hd"), F.col("digest").alias("dg"),
    )
    rows = rows.withColumn("s", F.floor(F.col("t") / F.lit(slice_seconds * 1_000_000)))
    rank = F.struct("t", F.coalesce("id", F.lit(-(1 << 63))).alias("id"), F.coalesce("dg", F.lit("")).alias("dg"))
    rows = rows.withColumn("full", F.when(F.col("st") == 200, F.struct("id", "d", "hd", "dg")))
    # responses of one date and id: the one with the least digest stands last, so that it is the latest
    inside = Window.partitionBy("u", "s").orderBy("t", F.col("id").asc_nulls_first(), F.col("st").desc(), F.coalesce("dg", F.lit("")).asc()).rowsBetween(Window.unboundedPreceding, -1)
    known = rows.where(F.col("u").isNotNull())
    near = known.withColumn("found", F.last("full", ignorenulls=True).over(inside)).where("st = 304")
    ends = known.groupBy("u", "s").agg(F.max_by("full", F.when(F.col("st") == 200, rank)).alias("last"))
    before = Window.partitionBy("u").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("u", "s", F.last("last", ignorenulls=True).over(before).alias("carried"))
    met = near.join(ends, ["u", "s"], "left").withColumn("r", F.coalesce("found", "carried"))
    lost = rows.where("st = 304 and u is null").withColumn("r", F.lit(None).cast(met.schema["r"].dataType))
    met = met.select("id", "u", "d", "hd", "r").unionByName(lost.select("id", "u", "d", "hd", "r"))
    tag = lambda h: F.regexp_replace(h["etag"], r"^W/", "")
    stored, own = F.col("r.hd"), F.col("hd")
    same = F.coalesce(tag(stored) == tag(own), stored["last-modified"] == own["last-modified"])
    outcome = (
        F.when(F.col("u").isNull(), "no_url").when(F.col("r").isNull(), "no_response")
        .when(same, "resolved").when(~same, "changed").otherwise("unvalidated")
    )
    met = met.withColumn("outcome", outcome)
    good = F.col("outcome").isin("resolved", "unvalidated")
    return met.select(
        F.col("id").alias("record_id"), F.col("u").alias("canonical_url"), F.col("d").alias("date"), "outcome",
        F.col("r.id").alias("refers_to"), F.col("r.d").alias("refers_to_date"), F.when(good, F.lit(200)).alias("status"),
        F.when(good, merged_headers(stored, own)).alias("headers"), F.when(good, F.col("r.dg")).alias("digest"),
    )
