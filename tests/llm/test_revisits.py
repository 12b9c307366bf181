import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillroll.llm import revisits

SCHEMA = "record_id long, url string, captured timestamp, status int, headers map<string,string>, time string, part int, full string"


def canonical(spark, urls):
    frame = spark.createDataFrame([(u,) for u in urls], "u string")
    return [r.c for r in frame.select(revisits.canonical_url(F.col("u")).alias("c")).collect()]


def test_canonical_urls(spark):
    same = [
        "http://Example.com/a/b", "https://www.example.com:443/a/b/", "HTTP://user@EXAMPLE.com:80/a/b#top",
        " https://example.com./a/b?utm_source=x&ref=y ", "//example.com/a/b?",
    ]
    assert set(canonical(spark, same)) == {"example.com/a/b"}
    assert canonical(spark, ["http://e.org/A?b=2&a=1&UTM_campaign=q", "http://e.org", "", None]) == ["e.org/A?a=1&b=2", "e.org", "", None]
    assert canonical(spark, ["http://e.org/a?reference=1"]) == ["e.org/a?reference=1"]


def expected(rows):
    """(resolution, refers_to, headers) by revisit, by scanning all records; URLs are canonical already."""
    out = []
    for number, url, time, status, headers in rows:
        if status != 304:
            continue
        fresh = {k.lower(): v for k, v in sorted((headers or {}).items())}
        earlier = [r for r in rows if r[3] == 200 and r[1] == url and url is not None and r[2] is not None and time is not None and (r[2], r[0]) < (time, number)]
        if not earlier:
            out.append((number, "missing", None, None))
            continue
        base = max(earlier, key=lambda r: (r[2], r[0]))
        stored = {k.lower(): v for k, v in sorted((base[4] or {}).items())}
        bare = lambda tag: tag.removeprefix("W/") if tag is not None else None
        if "etag" in fresh:
            kind = "resolved" if bare(fresh["etag"]) == bare(stored.get("etag")) else "mismatch"
        elif "last-modified" in fresh:
            kind = "resolved" if fresh["last-modified"] == stored.get("last-modified") else "mismatch"
        else:
            kind = "unvalidated"
        if kind == "mismatch":
            out.append((number, kind, None, None))
        else:
            out.append((number, kind, base[0], {**stored, **{k: v for k, v in fresh.items() if k not in revisits.KEPT}}))
    return sorted(out, key=lambda r: r[0])


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = []
    for number in range(1500):
        hot = rng.random() < 0.4
        url = "hot.org/x" if hot else rng.choice([None, *(f"h{i}.org/p" for i in range(150))])
        time = None if rng.random() < 0.02 else datetime(2024, 1, 1) + timedelta(minutes=rng.randint(0, 400))
        full = rng.random() < (0.02 if hot else 0.4)
        headers: dict | None = {}
        if rng.random() < 0.8:
            headers[rng.choice(["ETag", "etag"])] = rng.choice(["", "W/"]) + rng.choice(['"1"', '"2"'])
        if rng.random() < 0.5:
            headers["Last-Modified"] = rng.choice(["x", "y"])
        headers["Content-Length"], headers["Date"] = str(number), str(number)
        if rng.random() < 0.05:
            headers = None
        out.append((number, url, time, 200 if full else rng.choice([304, 304, 304, 404, None]), headers))
    return out


def test_equals_a_scan_of_all_records(spark, rows):
    frame = spark.createDataFrame([(*r, "clash", 1, "clash") for r in rows], SCHEMA).repartition(6)
    got = sorted((r.record_id, r.resolution, r.refers_to, r.merged_headers) for r in revisits.resolve(frame).collect())
    assert got == expected(rows)
    assert {r[1] for r in got} == {"resolved", "unvalidated", "mismatch", "missing"}


def test_repeated_records_and_empty_table(spark):
    time = datetime(2024, 1, 1)
    rows = [(1, "a.org", time, 200, {"ETag": '"1"'}), (2, "http://a.org/", time, 304, {"ETag": '"1"', "ETAG": '"1"'})] * 2
    frame = spark.createDataFrame([(*r, "", 1, "") for r in rows], SCHEMA)
    got = [(r.record_id, r.refers_to, r.merged_headers) for r in revisits.resolve(frame).collect()]
    assert got == [(2, 1, {"etag": '"1"'})] * 2
    assert revisits.resolve(frame.limit(0)).count() == 0
