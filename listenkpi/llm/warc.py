"""WARC: resolution of "not modified" revisit records.

A revisit record (a 304 answer) holds headers but no payload. It is joined as of its time, by canonical
URL, to the latest earlier full response. Its validators are checked against that response (entity tag by
weak comparison, else the modification date, else the payload digest); if they agree, the revisit takes the
response's payload, and the headers are merged as a cache does it: the stored ones, overlaid by those of
the revisit that a 304 may update.

The as-of join never gathers a URL: records are cut by (URL, time, id) into ranges of about equal size, so
a URL with a third of all records spans many ranges. A running last value finds the response inside the
range; where there is none, the last response of the URL's earlier ranges is carried over from a summary
with one row for each URL and range, read only for URLs that span several ranges. Payloads are not moved:
a result names the response's record.

Defined results, in ``status``: ``resolved``; ``no_response`` (no earlier full response, or no URL or time);
``no_validator`` (the two share none); ``mismatch``. Only resolved rows have merged headers and a payload.
Records of one time follow each other by record id; repeated records each give a row. NULL headers are none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listenkpi.llm.common import write_table

#: Headers a 304 answer doesn't update (of the payload, and of one connection).
KEPT = ["content-encoding", "content-type", "content-range", "content-length", "connection", "keep-alive", "proxy-authenticate",
        "proxy-authorization", "proxy-connection", "te", "trailer", "transfer-encoding", "upgrade"]
#: Query parameters that tell where a visitor came from.
TRACKING = "utm_[a-z]+|gclid|fbclid|msclkid|ref"


def canonical_url(url: Column) -> Column:
    """Scheme-free key of a URL: lower-case host without user and default port, path without a trailing
    slash, query without tracking parameters in sorted order, no fragment. NULL if it has no host."""
    plain = F.regexp_replace(F.trim(url), "#.*$", "")
    host = F.lower(F.regexp_extract(plain, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?@]*@)?([^/?]*)", 1))
    host = F.regexp_replace(host, r":(80|443)?$", "")
    path = F.regexp_replace(F.regexp_extract(plain, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_extract(plain, r"^[^?]*\?(.*)$", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^(?i)({TRACKING})(=|$)"))
    told = F.array_join(F.array_sort(kept), "&")
    return F.when(host != "", F.concat(host, path, F.when(told != "", F.concat(F.lit("?"), told)).otherwise(F.lit(""))))


def _names_lowered(headers: Column) -> Column:
    """Header names in lower case; of names that meet, the last in order of the written name. A NULL value
    is no header."""
    pairs = F.array_sort(F.filter(F.map_entries(headers), lambda e: e["value"].isNotNull()))
    lowered = F.transform(pairs, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")))
    return F.aggregate(lowered, F.expr("cast(map() as map<string,string>)"),
                       lambda m, e: F.map_concat(F.map_filter(m, lambda k, _: k != e["key"]), F.map_from_entries(F.array(e))))


def _tag(headers: Column) -> Column:
    return F.regexp_replace(headers["etag"], "^W/", "")


def resolve(records: DataFrame) -> DataFrame:
    """``record_id, url_key, time, status, response_id, headers, payload_digest, payload_length`` for each
    revisit of ``records``: ``record_id bigint, kind string`` (``response`` or ``revisit``), ``url string, time
    timestamp, http_status int, headers map<string,string>, payload_digest string, payload_length bigint``.
    A full response is one of kind ``response`` and status 200."""
    spark = records.sparkSession
    full = (F.col("kind") == "response") & (F.col("http_status") == 200)
    headers = F.coalesce(_names_lowered(F.col("headers")), F.expr("cast(map() as map<string,string>)"))
    rows = records.select("record_id", canonical_url(F.col("url")).alias("url_key"), "time", full.alias("full"), headers.alias("headers"),
                          "payload_digest", "payload_length").where(full | (F.col("kind") == "revisit"))
    rows, _ = write_table(rows, "records")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = rows.where("url_key IS NOT NULL AND time IS NOT NULL")
    cut, _ = write_table(known.repartitionByRange(n, "url_key", "time", "record_id").withColumn("range", F.spark_partition_id()), "ranges")

    response = F.when(F.col("full"), F.struct("time", "record_id", "headers", "payload_digest", "payload_length"))
    before = Window.partitionBy("url_key", "range").orderBy("time", "record_id", "payload_digest").rowsBetween(Window.unboundedPreceding, -1)
    inside = cut.withColumn("near", F.last(response, ignorenulls=True).over(before)).where("NOT full")

    spans = cut.groupBy("url_key").agg(F.min("range").alias("lo"), F.max("range").alias("hi")).where("lo < hi").select("url_key")
    spans, _ = write_table(spans, "spans")
    key = F.struct("time", "record_id", F.coalesce("payload_digest", F.lit("")).alias("tie"))
    summary = (cut.join(spans, "url_key", "left_semi").groupBy("url_key", "range")
               .agg(F.max_by(response, F.when(F.col("full"), key)).alias("last")))
    earlier = Window.partitionBy("url_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.withColumn("far", F.last("last", ignorenulls=True).over(earlier)).select("url_key", "range", "far").where("far IS NOT NULL")
    carried, _ = write_table(carried, "carried")
    found = inside.join(carried, ["url_key", "range"], "left").withColumn("r", F.coalesce("near", "far")).drop("near", "far", "range", "full")
    lost = rows.where("NOT full AND (url_key IS NULL OR time IS NULL)").drop("full").withColumn("r", F.lit(None).cast(found.schema["r"].dataType))
    return _merged(found.unionByName(lost))


def _merged(found: DataFrame) -> DataFrame:
    """Status, headers and payload of revisits that have their response in the struct column ``r``."""
    own, old = F.col("headers"), F.col("r.headers")
    by_tag, by_date = _tag(own).isNotNull() & _tag(old).isNotNull(), own["last-modified"].isNotNull() & old["last-modified"].isNotNull()
    by_digest = F.col("payload_digest").isNotNull() & F.col("r.payload_digest").isNotNull()
    same = (F.when(by_tag, _tag(own) == _tag(old)).when(by_date, own["last-modified"] == old["last-modified"])
            .when(by_digest, F.col("payload_digest") == F.col("r.payload_digest")))
    status = (F.when(F.col("r.record_id").isNull() & F.col("r.time").isNull(), "no_response").when(same.isNull(), "no_validator")
              .when(same, "resolved").otherwise("mismatch"))
    new = F.map_filter(own, lambda k, _: ~k.isin(KEPT))
    merged = F.map_concat(F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(new), k)), new)
    done = F.col("status") == "resolved"
    return found.withColumn("status", status).select(
        "record_id", "url_key", "time", "status", F.when(done, F.col("r.record_id")).alias("response_id"), F.when(done, merged).alias("headers"),
        F.when(done, F.col("r.payload_digest")).alias("payload_digest"), F.when(done, F.col("r.payload_length")).alias("payload_length"))


def crawl_of(pages: DataFrame) -> DataFrame:
    """Records of a crawl derived from all pages: page ``i`` is fetched at minute ``i`` (a full response with
    validators), and asked for again under another spelling of its URL one hour before and one and two days
    after. The second answer carries the response's validators, in weak form; the third those of the page's
    URL, which agree only by chance, or, where the page id is odd, only the modification date."""
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id") * 60)
    digest = F.sha1(F.coalesce("html", F.lit("")))
    tag = F.concat(F.lit('"'), F.substring(digest, 1, 16), F.lit('"'))
    modified = F.date_format(F.timestamp_seconds(F.lit(1_600_000_000) + F.length(F.coalesce("html", F.lit("")))), "yyyy-MM-dd HH:mm:ss")
    size = F.length(F.encode(F.coalesce("html", F.lit("")), "UTF-8")).cast("bigint")
    other = F.concat(F.regexp_replace(F.col("url"), "#.*$", ""), F.when(F.col("url").contains("?"), F.lit("&")).otherwise(F.lit("?")),
                     F.lit("utm_source=again#part"))
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    base = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), at.alias("at"), digest.alias("digest"),
                        tag.alias("tag"), modified.alias("modified"), size.alias("size"), other.alias("other"))

    def record(k: int, kind: str, url: str, hours: int, status: int, headers: list, digest: Column) -> Column:
        told = F.create_map(*[x for name, value in headers for x in (F.lit(name), value)])
        return F.struct((F.col("page_id") * 4 + k).alias("record_id"), F.lit(kind).alias("kind"), F.col(url).alias("url"),
                        (F.col("at") + F.expr(f"INTERVAL {hours} HOURS")).alias("time"), F.lit(status).alias("http_status"), told.alias("headers"),
                        digest.alias("payload_digest"), F.when(F.lit(status == 200), F.col("size")).alias("payload_length"))

    none = F.lit(None).cast("string")
    url_tag = F.concat(F.lit('"'), F.substring(F.sha1(text(F.col("url"))), 1, 16), F.lit('"'))
    answers = [
        record(0, "response", "url", 0, 200, [("Content-Type", F.lit("text/html")), ("Content-Length", text(F.col("size"))), ("ETag", F.col("tag")),
               ("Last-Modified", F.col("modified")), ("Cache-Control", F.lit("max-age=60"))], F.col("digest")),
        record(1, "revisit", "other", -1, 304, [("ETag", F.col("tag"))], none),
        record(2, "revisit", "other", 24, 304, [("ETag", F.concat(F.lit("W/"), F.col("tag"))), ("Cache-Control", F.lit("max-age=120")), ("Content-Length", F.lit("0")),
               ("Expires", text(F.col("at")))], none),
        record(3, "revisit", "url", 48, 304, [("ETag", F.when(F.col("page_id") % 2 == 0, url_tag)), ("Last-Modified", F.col("modified")), ("Date", text(F.col("at")))],
               F.col("digest")),
    ]
    return base.select(F.explode(F.array(*answers)).alias("r")).select("r.*")
