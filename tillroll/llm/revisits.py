"""Not-modified revisits of web archives, resolved by an as-of join on the canonical URL.

A revisit (status 304) stands for the latest earlier full response (status 200) of its canonical URL; records of one
time are ordered by their ids. Its validators must fit: an entity tag equals the response's, apart from weakness, or,
without a tag, the date of last modification equals. The resolved record has the headers of the response, with those
of the revisit that may be updated in their place.

Records are sorted into range partitions by URL, time and id, so that an URL with many captures spans partitions; what a
partition must know of those before it, the last full response of the one URL that goes on, is carried over in a
table of at most one row per partition.

Status: ``resolved``; ``unvalidated``, the revisit has no validator and is resolved all the same; ``mismatch``, a validator
differs; ``missing``, there is no earlier full response. A null URL, time or status is that of no response and no revisit is
resolved by it: such rows are ``missing``. Repeated rows are records of their own; header names are compared in lower
case, and of names that differ in case only the last by name counts; extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.staging import written

# headers that a 304 must not change: hop-by-hop fields and those of the stored body; fixed values
KEPT = (
    "connection", "keep-alive", "proxy-authenticate", "proxy-authorization", "proxy-connection", "te", "trailer",
    "transfer-encoding", "upgrade", "content-encoding", "content-length", "content-range", "content-type",
)
# query parameters that name no other document: fixed values
TRACKING = r"(?i)^(utm_[a-z]+|ref|fbclid|gclid|msclkid|mc_[ce]id)(=|$)"


def canonical_url(url: Column) -> Column:
    """Host in lower case, without scheme, ``www.``, default port, fragment, tracking parameters, order of parameters or last slash."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    host = F.lower(F.regexp_extract(bare, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?]*)", 1))
    host = reduce(lambda h, p: F.regexp_replace(h, p, ""), [r"^.*@", r"^www\d*\.", r":(80|443)$", r"\.$"], host)
    rest = F.regexp_replace(bare, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?]*", "")
    path = F.regexp_replace(F.substring_index(rest, "?", 1), "/+$", "")
    query = F.when(F.instr(rest, "?") > 0, F.regexp_replace(rest, r"^[^?]*\?", "")).otherwise("")
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    tail = F.array_join(F.array_sort(kept), "&")
    return F.concat(host, path, F.when(tail != "", F.concat(F.lit("?"), tail)).otherwise(""))


def _lowered(headers: Column) -> Column:
    """Header names in lower case, values without outer blanks."""
    entries = F.array_sort(F.map_entries(headers))
    names = F.transform(entries, lambda e: F.lower(e["key"]))
    last = F.filter(entries, lambda e, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), F.lower(e["key"])))
    return F.map_from_entries(F.transform(last, lambda e: F.struct(F.lower(e["key"]), F.trim(e["value"]))))


def _tag(headers: Column) -> Column:
    return F.regexp_replace(F.try_element_at(headers, F.lit("etag")), "^W/", "")


def merged_headers(stored: Column, fresh: Column) -> Column:
    """The headers of the stored response, updated by those of a 304 that may change."""
    update = F.map_filter(fresh, lambda k, _: ~k.isin(*KEPT))
    return F.map_concat(F.map_filter(stored, lambda k, _: ~F.map_contains_key(update, k)), update)


def resolve(
    records: DataFrame, id_col: str = "record_id", url_col: str = "url", time_col: str = "captured", status_col: str = "status",
    headers_col: str = "headers",
) -> DataFrame:
    """One row per revisit: the id, ``canonical_url``, ``refers_to`` (the id of the response), ``resolution``, ``merged_headers``."""
    url = canonical_url(F.col(url_col))
    headers = F.coalesce(_lowered(F.col(headers_col)), F.create_map().cast("map<string,string>"))
    rows = records.where(F.col(status_col).isin(200, 304)).select(
        F.col(id_col).alias("id"),
        url.alias("url"),
        F.col(time_col).alias("time"),
        (F.col(status_col) == 304).alias("revisit"),
        headers.alias("headers"),
    )
    rows = rows.repartitionByRange("url", "time", "id").withColumn("part", F.spark_partition_id())
    # the struct is built from the written headers: lambdas that stand twice in one projection can lose entries
    usable = ~F.col("revisit") & F.col("url").isNotNull() & F.col("time").isNotNull()
    rows = written(rows, "captures").withColumn("full", F.when(usable, F.struct("id", "headers")))

    # URLs that go on in another partition are the first or last of theirs
    ends = rows.groupBy("part").agg(F.min("url").alias("a"), F.max("url").alias("b"))
    ends = ends.select("part", F.explode(F.array_distinct(F.array("a", "b"))).alias("url"))
    long = ends.groupBy("url").agg(F.count("*").alias("n")).where("n > 1").select("url")
    newest = rows.where("full IS NOT NULL").join(long, "url")  # at most a row per partition
    newest = newest.groupBy("url", "part").agg(F.max_by("full", F.struct("time", "id")).alias("newest"))
    newest = ends.join(long, "url").join(newest, ["url", "part"], "left")
    earlier = Window.partitionBy("url").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = newest.select("url", "part", F.last("newest", ignorenulls=True).over(earlier).alias("carried"))

    inside = Window.partitionBy("part", "url").orderBy("time", "id").rowsBetween(Window.unboundedPreceding, -1)
    seen = rows.withColumn("near", F.last("full", ignorenulls=True).over(inside)).where("revisit")
    seen = seen.join(carried, ["part", "url"], "left")  # at most two rows per partition
    source = F.when(F.col("url").isNotNull() & F.col("time").isNotNull(), F.coalesce("near", "carried"))
    seen = seen.withColumn("source", source)

    stored, fresh = F.col("source")["headers"], F.col("headers")
    date = lambda h: F.try_element_at(h, F.lit("last-modified"))
    resolution = (
        F.when(F.col("source").isNull(), "missing")
        .when(_tag(fresh).isNotNull(), F.when(_tag(fresh).eqNullSafe(_tag(stored)), "resolved").otherwise("mismatch"))
        .when(date(fresh).isNotNull(), F.when(date(fresh).eqNullSafe(date(stored)), "resolved").otherwise("mismatch"))
        .otherwise("unvalidated")
    )
    seen = seen.withColumn("resolution", resolution)
    fits = F.col("resolution").isin("resolved", "unvalidated")
    return seen.select(
        F.col("id").alias(id_col),
        F.col("url").alias("canonical_url"),
        F.when(fits, F.col("source")["id"]).alias("refers_to"),
        "resolution",
        F.when(fits, merged_headers(stored, fresh)).alias("merged_headers"),
    )
