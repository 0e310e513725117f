import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from listenkpi.llm import warc as R

SCHEMA = ("record_id bigint, kind string, url string, time timestamp, http_status int, headers map<string,string>, payload_digest string, "
          "payload_length bigint, url_key string")
T0 = dt.datetime(2024, 1, 1)


def at(n):
    return T0 + dt.timedelta(minutes=n)


@pytest.mark.parametrize("url, key", [
    ("HTTP://User@Example.COM:80/a/b/?b=2&utm_source=x&a=1#frag", "example.com/a/b?a=1&b=2"), ("https://example.com", "example.com"),
    ("https://example.com:443/?gclid=1", "example.com"), ("https://example.com:8080/x", "example.com:8080/x"), ("https://e.com/A?ref=q&referrer=z", "e.com/A?referrer=z"),
    ("no url", None), (None, None), ("", None), ("http:///x", None)])
def test_canonical_url(spark, url, key):
    assert spark.createDataFrame([(url,)], "u string").select(R.canonical_url(F.col("u")).alias("k")).first()["k"] == key


def brute(rows):
    out = []
    for r in rows:
        if r[1] != "revisit":
            continue
        full = [x for x in rows if x[1] == "response" and x[4] == 200 and x[2] == r[2] and x[3] is not None and r[3] is not None and r[2] and (x[3], x[0]) < (r[3], r[0])]
        old = max(full, key=lambda x: (x[3], x[0]), default=None)
        low = lambda h: {k.lower(): v for k, v in (h or {}).items() if v is not None}
        if old is None:
            out.append((r[0], "no_response", None, None))
            continue
        a, b = low(r[5]), low(old[5])
        weak = lambda t: t.removeprefix("W/")
        same = (weak(a["etag"]) == weak(b["etag"]) if "etag" in a and "etag" in b else a["last-modified"] == b["last-modified"]
                if "last-modified" in a and "last-modified" in b else r[6] == old[6] if r[6] and old[6] else None)
        merged = {**b, **{k: v for k, v in a.items() if k not in R.KEPT}}
        out.append((r[0], "no_validator", None, None) if same is None else (r[0], "resolved", old[0], merged) if same else (r[0], "mismatch", None, None))
    return sorted(out, key=str)


def resolved(spark, rows):
    got = R.resolve(spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)).collect()
    return sorted(((r["record_id"], r["status"], r["response_id"], r["headers"]) for r in got), key=str)


def test_random_records_with_a_hot_url(spark):
    rng, rows = random.Random(0), []
    for i in range(600):
        url = "http://hot.example.com/x" if rng.random() < 0.5 else f"http://e.com/{rng.randint(0, 30)}"
        headers = {k: v for k, v in (("ETag", rng.choice(['"a"', 'W/"a"', '"b"'])), ("Last-Modified", rng.choice("xy")), ("Content-Length", str(i)), ("X-Seen", str(i)))
                   if rng.random() < 0.7}
        kind = rng.choice(["response", "revisit", "revisit"])
        rows.append((i, kind, url, at(rng.randint(0, 200)), 200 if kind == "response" and rng.random() < 0.9 else 304, headers, rng.choice([None, "d1", "d2"]), 5))
    assert resolved(spark, rows) == brute(rows)


def test_headers_that_a_304_may_not_update(spark):
    rows = [(1, "response", "http://e.com/a", at(0), 200, {"Content-Type": "text/html", "Content-Length": "9", "ETag": '"v"', "Age": "1"}, "d", 9),
            (2, "revisit", "http://e.com/a", at(1), 304, {"etag": 'W/"v"', "CONTENT-LENGTH": "0", "Content-Type": "x", "Connection": "close", "Age": "2", "Nul": None}, None, None)]
    ((_, status, response, headers),) = resolved(spark, rows)
    assert (status, response) == ("resolved", 1)
    assert headers == {"content-type": "text/html", "content-length": "9", "etag": 'W/"v"', "age": "2"}


def test_nulls_ties_repeats_and_empty(spark):
    ok = {"ETag": '"v"'}
    rows = [(1, "response", "http://e.com/a", at(0), 200, ok, "d", 9), (2, "revisit", "http://e.com/a", at(0), 304, ok, None, None), (2, "revisit", "http://e.com/a", at(0), 304, ok, None, None),
            (3, "revisit", None, at(1), 304, ok, None, None), (4, "revisit", "http://e.com/a", None, 304, ok, None, None), (5, "revisit", "http://e.com/a", at(1), 304, None, None, None),
            (6, "response", "http://e.com/b", at(0), 404, ok, "d", 1), (7, "revisit", "http://e.com/b", at(2), 304, ok, None, None), (0, "revisit", "http://e.com/a", at(0), 304, ok, None, None)]
    assert resolved(spark, rows) == sorted([(2, "resolved", 1, {"etag": '"v"'}), (2, "resolved", 1, {"etag": '"v"'}), (3, "no_response", None, None), (4, "no_response", None, None),
                                            (5, "no_validator", None, None), (7, "no_response", None, None), (0, "no_response", None, None)], key=str)
    assert resolved(spark, []) == [] and resolved(spark, rows[:1]) == []
