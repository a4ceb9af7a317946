from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tidemark.llm import warc

SCHEMA = "record_id long, url string, time timestamp, kind string, headers map<string,string>, digest string"
START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def brute(rows):
    out = {}
    for i, url, time, kind, headers, digest in rows:
        if kind != "revisit" or url is None or time is None:
            continue
        low = {k.lower(): v for k, v in (headers or {}).items()}
        before = [r for r in rows if r[3] == "response" and r[1] == url and r[2] is not None and r[2] <= time]
        if not before:
            out[i] = (None, "missing", None)
            continue
        last = max(before, key=lambda r: (r[2], r[0]))
        own = {k.lower(): v for k, v in (last[4] or {}).items()}
        pairs = [(own.get("etag"), low.get("etag")), (last[5], digest), (own.get("last-modified"), low.get("last-modified"))]
        known = [a == b for a, b in pairs if a is not None and b is not None]
        if not known or not known[0]:
            out[i] = (last[0], "changed", None)
        else:
            out[i] = (last[0], "resolved", own | {k: v for k, v in low.items() if k not in warc.KEPT_OF_RESPONSE})
    return out


def records(rng, n):
    rows = []
    for i in range(n):
        headers = {k: rng.choice("ab") for k in rng.sample(["ETag", "Last-Modified", "Content-Type", "Date", "Server"], rng.randrange(5))}
        url = rng.choice(["hot.example/"[:-1]] * 5 + ["a.example/x", "b.example/y", None])
        time = None if rng.random() < 0.05 else START + timedelta(seconds=rng.randrange(60))
        rows.append((i, url, time, rng.choice(["response", "revisit", "revisit", "other", None]), headers or None, rng.choice(["d", "e", None])))
    return rows


def test_equals_brute_force(spark):
    for cuts in (1, 4, 50):
        rows = records(random.Random(cuts), 300)
        df = spark.createDataFrame(rows, SCHEMA).withColumn("found", F.lit("clash")).repartition(6)
        got = {r.revisit_id: (r.response_id, r.status, r.headers) for r in warc.resolve(df, cuts=cuts).collect()}
        assert got == brute(rows)
        assert {x[1] for x in got.values()} == {"resolved", "changed", "missing"}


def test_canonical_urls(spark):
    same = [
        "http://www.Example.com/a/?b=2&a=1", "https://example.com:443/a?a=1&b=2&utm_source=x#top", "example.com/a/?a=1&ref=q&b=2",
        " HTTP://user@EXAMPLE.com:80/a?&b=2&a=1",
    ]
    other = ["http://example.com/A?a=1&b=2", "http://example.com/a?a=1", "http://example.com:8080/a?a=1&b=2", "http://example.com/a/"]
    df = spark.createDataFrame([(u,) for u in same + other], "u string")
    got = [r.c for r in df.select(warc.canonical_url(F.col("u")).alias("c")).collect()]
    assert set(got[: len(same)]) == {"example.com/a?a=1&b=2"}
    assert len(set(got)) == 1 + len(other)


def test_empty_and_repeated(spark):
    assert warc.resolve(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, "u.example/a", START, "response", None, "d"), (2, "u.example/a", START, "revisit", None, "d")]
    got = warc.resolve(spark.createDataFrame(rows * 2, SCHEMA)).collect()
    assert len(got) == 2 and {(r.revisit_id, r.response_id, r.status) for r in got} == {(2, 1, "resolved")}
    assert all(r.headers == {} for r in got)
