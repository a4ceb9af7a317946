"""Not-modified revisits of a web archive, resolved by an as-of join.

A revisit takes the latest earlier full response of its canonical URL. If a
validator of both (ETag, Last-Modified or payload digest) is equal and none of
the stronger ones differs, the response's headers, with those of the revisit
that a not-modified answer may update, are its own.

The join is made of windows over responses and revisits together. A URL may
have a third of all records: time is cut at quantiles of all records, so that
a window holds one URL in one cut only, and what a cut needs from earlier cuts
is one row for each URL and cut. Records of one URL at one instant are ordered
by their id, responses first.

Defined cases: a null URL, time or kind takes part in nothing; a revisit
without an earlier response is ``missing``; with one but without an equal
validator it is ``changed``; null headers are no headers; repeated rows get
equal results; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

RESPONSE, REVISIT = "response", "revisit"
# Cuts of time; a window holds about 1 / CUTS of all records at most.
CUTS = 256

# Headers of a connection and of a body, which a revisit can't update.
KEPT_OF_RESPONSE = (
    "connection content-encoding content-length content-range content-type keep-alive proxy-authenticate "
    "proxy-authorization te trailer transfer-encoding upgrade"
).split()


def canonical_url(url: Column) -> Column:
    """Scheme and leading ``www.`` left out, host in lower case, default port, fragment and closing slashes
    removed, parameters sorted, session and tracking parameters left out."""
    bare = F.regexp_replace(F.trim(url), r"#.*$", "")
    bare = F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?@]*@)?", "")
    host = F.lower(F.regexp_extract(bare, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, r"^www\d*\.", ""), r":(?:80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(bare, r"\?(.*)$", 1)
    parts = F.filter(
        F.array_sort(F.split(query, "&")),
        lambda p: (p != "") & ~F.lower(p).rlike(r"^(?:utm_[a-z]+|ref|sid|sessionid|phpsessid|jsessionid)(?:=|$)"),
    )
    tail = F.array_join(parts, "&")
    return F.concat(host, path, F.when(tail != "", F.concat(F.lit("?"), tail)).otherwise(F.lit("")))


def _by_name(headers: Column) -> Column:
    """Names in lower case; of names that differ in case only, the last in order of name stays."""
    entries = F.array_sort(F.map_entries(headers))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    last = lambda name: F.try_element_at(F.filter(entries, lambda e: F.lower(e["key"]) == name), F.lit(-1))["value"]
    return F.map_from_arrays(names, F.transform(names, last))


def merged_headers(response: Column, revisit: Column) -> Column:
    """The response's headers, updated by those of the revisit that may change."""
    permitted = F.map_filter(revisit, lambda name, _: ~name.isin(KEPT_OF_RESPONSE))
    left = F.map_filter(response, lambda name, _: ~F.map_contains_key(permitted, name))
    return F.map_concat(left, permitted)


def _latest_responses(records: DataFrame, cuts: int) -> DataFrame:
    """Every revisit with the latest earlier response of its URL, as struct ``found``."""
    # The sort key: responses come before revisits of the same instant.
    order = ["time", "is_revisit", "id"]
    borders = records.select(
        F.percentile_approx("second", [i / cuts for i in range(1, cuts)], 10_000).alias("b")
    ).collect()[0]["b"] or []
    borders = sorted(set(borders))
    cut = F.lit(0)
    if borders:
        table = "array(" + ",".join(f"{b}L" for b in borders) + ")"
        cut = F.expr(f"size(filter({table}, b -> b < second))")
    dealt = records.withColumn("cut", cut)
    response = F.struct("time", "id", "etag", "modified", "digest", "headers")
    answer = F.when(~F.col("is_revisit"), response)
    near = Window.partitionBy("url", "cut").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = dealt.withColumn("found", F.last(answer, ignorenulls=True).over(near)).where("is_revisit")
    # One row for each URL and cut, for revisits without a response in their own cut.
    latest = dealt.where("NOT is_revisit").groupBy("url", "cut").agg(F.max(F.struct("time", "id")).alias("last"))
    waiting = within.where("found IS NULL").select("url", "cut").distinct()
    asked = waiting.withColumn("last", F.lit(None).cast(latest.schema["last"].dataType)).withColumn("asks", F.lit(True))
    along = Window.partitionBy("url").orderBy("cut", "asks").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        latest.withColumn("asks", F.lit(False))
        .unionByName(asked)
        # A cut's own responses come later than its revisits here, or they would have been found.
        .withColumn("cut", F.col("cut") * 2 + F.when(F.col("asks"), 0).otherwise(1))
        .withColumn("earlier", F.last("last", ignorenulls=True).over(along))
        .where("asks AND earlier IS NOT NULL")
        .select("url", F.expr("cast(cut div 2 as int)").alias("cut"), F.col("earlier.id").alias("r_id"), F.col("earlier.time").alias("r_time"))
    )
    named = dealt.where("NOT is_revisit").select(
        "url", F.col("id").alias("r_id"), F.col("time").alias("r_time"), response.alias("carried")
    )
    carried = before.join(named, ["url", "r_id", "r_time"]).select("url", "cut", "carried").dropDuplicates(["url", "cut"])
    return within.join(carried, ["url", "cut"], "left").withColumn("found", F.coalesce("found", "carried"))


def resolve(records: DataFrame, *, cuts: int = CUTS) -> DataFrame:
    """One row for each revisit of ``records`` (record_id, url, time, kind, headers, digest).

    ``headers`` is a map; the result has ``revisit_id``, canonical ``url``,
    ``response_id``, ``status`` (resolved, changed or missing) and, if
    resolved, the merged ``headers`` (names in lower case).
    """
    headers = _by_name(F.coalesce("headers", F.create_map().cast("map<string,string>")))
    own = stored(
        records.where(F.col("url").isNotNull() & F.col("time").isNotNull() & F.col("kind").isin(RESPONSE, REVISIT))
        .select(
            F.col("record_id").alias("id"), canonical_url(F.col("url")).alias("url"), "time",
            (F.col("kind") == REVISIT).alias("is_revisit"), headers.alias("headers"), "digest",
        )
        .withColumns({
            "second": F.col("time").cast("timestamp").cast("long"),
            # Weak comparison, as a not-modified answer is judged by.
            "etag": F.regexp_replace(F.trim(F.try_element_at("headers", F.lit("etag"))), "^W/", ""),
            "modified": F.try_element_at("headers", F.lit("last-modified")),
        })
    )
    found = _latest_responses(own, cuts)
    etag, modified, digest = (F.col(f"found.{n}") == F.col(n) for n in ("etag", "modified", "digest"))
    # The strongest validator that both have decides.
    same = F.coalesce(etag, digest, modified, F.lit(False))
    status = F.when(F.col("found.id").isNull(), "missing").when(same, "resolved").otherwise("changed")
    return found.select(
        F.col("id").alias("revisit_id"),
        "url",
        F.col("found.id").alias("response_id"),
        status.alias("status"),
        F.when(F.col("found.id").isNotNull() & same, merged_headers(F.col("found.headers"), F.col("headers"))).alias("headers"),
    )
