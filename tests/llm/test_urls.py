"""URL filters against brute force over all token combinations."""

import itertools
import random
import re
from collections import Counter

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from tillroll.llm import urls
from tillroll.llm.queries import LLM_QUERIES, URL_RULES


def split(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    return lower(host), re.match("[^?#]*", rest[len(host) :])[0], lower(rest)


def tokens(url):
    host, path, rest = split(url)
    query = re.match(r"[^?#]*(?:\?([^#]*))?", rest)[1] or ""
    low = re.sub("[A-Z]", lambda m: m[0].lower(), path)
    parts = [("h:", host.split(".")), ("p:", re.split("[\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)), ("q:", re.split("[&;]+", query))]
    return frozenset(mark + w for mark, words in parts for w in words if w)


def stated(url, rules):
    host, path, _ = split(url)
    fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.name), default=None)


def all_rules(labelled, needed, confidence):
    """Every frequent and confident combination, without pruning or merging of tokens: (antecedent, label) -> (confidence, n)."""
    with_label, alone = Counter(), Counter()
    for t, label in labelled:
        for k in range(1, len(t) + 1):
            for some in itertools.combinations(sorted(t), k):
                alone[some] += 1
                with_label[some, label] += 1
    return {(a, label): (n / alone[a], n) for (a, label), n in with_label.items() if n >= needed and n / alone[a] >= confidence}


def brute(rows, rules, labelled, needed, confidence):
    mined = all_rules([(tokens(u), label) for u, label in labelled], needed, confidence)
    shared = frozenset.intersection(*[tokens(u) for u, _ in labelled]) if labelled else frozenset()
    out = []
    for i, url in rows:
        rule, t = stated(url, rules), tokens(url)
        fit = [(c, n, label == "block") for (a, label), (c, n) in mined.items() if set(a) <= t and not set(a) <= shared]
        best = max(fit, default=None)
        verdict = rule.verdict if rule else ("block" if best[2] else "allow") if best else "allow"
        out.append((i, *split(url)[:2], rule.name if rule else None, verdict))
    return sorted(out, key=str)


def found(frame, rules, labelled, **options):
    rows = urls.judged(frame, rules, labelled, **options).select("page_id", "host", "path", "rule", "verdict").collect()
    return sorted(map(tuple, rows), key=str)


ODD = [
    None, "", "no scheme", "://", "http://", "HTTP://A.NET", "http://a.net/", "http://NET/x", "http://xnet/", "http://b.net?x=/", "http://b.net#/",
    "a://b://c.net/", "http://w.example.net/en/1", "http://w.example.net/EN/1", "http://w.example.net/en", "http://u@c.org/fr/?a=1&A=1;b", "http://É.org/fr/é#é",
    "http://example.com/de/" + "x/" * 20_000, "http://example.comx/de/", "http://a.example.com/de/\n?\n", "://org/fr/", "http://c.org:80/fr/",
]


def test_parts_and_stated_rules(spark):
    frame = spark.createDataFrame(list(enumerate(ODD)), "page_id long, url string")
    got = {r.page_id: (r.h, r.p, frozenset(r.t), r.s and r.s.rule) for r in frame.select(
        "page_id", urls.host(F.col("url")).alias("h"), urls.path(F.col("url")).alias("p"), urls.tokens(F.col("url")).alias("t"),
        urls.stated(urls.host(F.col("url")), urls.path(F.col("url")), URL_RULES).alias("s"),
    ).collect()}
    for i, url in enumerate(ODD):
        rule = stated(url, URL_RULES)
        assert got[i] == (*split(url)[:2], tokens(url), rule and rule.name)


@pytest.mark.parametrize("seed", [1, 2])
def test_judged_like_brute_force(spark, seed):
    rng = random.Random(seed)

    def made():
        host = f"{rng.choice(['www', 'm', 'x'])}.{rng.choice(['pills', 'news', 'shop', 'blog'])}.{rng.choice(['net', 'com', 'org'])}"
        return f"http://{host}/{rng.choice(['en', 'de', 'fr'])}/{rng.randrange(9)}{rng.choice(['', '?ref=x', '?ref=x&p=2'])}"

    def label(url):
        bad = "pills" in url or (".com/de" in url and "x." in url)
        return None if rng.random() < 0.1 else "block" if bad != (rng.random() < 0.05) else "allow"

    labelled = [(u, label(u)) for u in (made() for _ in range(300))]
    rows = [(i, made()) for i in range(200)] + [(None, made()), (3, made())]
    rules = [urls.Rule("block", "net"), urls.Rule("allow", "org", "/fr/")]
    learn = spark.createDataFrame(labelled, "url string, label string").repartition(3)
    frame = spark.createDataFrame(rows, "page_id long, url string")
    want = brute(rows, rules, [x for x in labelled if x[1]], 6, 0.8)
    assert found(frame, rules, learn, support=0.02) == want
    assert {v for *_, rule, v in want if not rule} == {"block", "allow"}
    clash = frame
    for name in ("id", "host", "path", "tokens", "token", "label", "confidence", "n", "m", "s", "rule"):
        clash = clash.withColumn(name, F.lit(1))
    assert found(clash.repartition(5), rules, learn, support=0.02) == want


def test_pruned_rules_decide_alike(spark):
    """What is left says for every URL what all rules say, and no rule is left that a shorter one makes idle."""
    learn = [(f"http://{h}.{d}.com/{p}", "block" if d == "bad" else "allow") for h in "abc" for d in ("bad", "good") for p in ("en", "de")] * 3
    frame = spark.createDataFrame(learn, "url string, label string").select(urls.tokens(F.col("url")).alias("tokens"), "label")
    rules = urls.mined(frame, support=0.01, confidence=0.8, least=2).collect()
    assert sorted((r.antecedent, r.label, r.n, r.confidence) for r in rules) == [(["h:bad"], "block", 18, 1.0), (["h:good"], "allow", 18, 1.0)]


def test_odd_rows(spark):
    frame = spark.createDataFrame(list(enumerate(ODD)) + [(None, None), (1, "http://a.net/")], "page_id long, url string")
    none = spark.createDataFrame([], "url string, label string")
    want = brute(list(enumerate(ODD)) + [(None, None), (1, "http://a.net/")], URL_RULES, [], 1, 0.8)
    assert found(frame, URL_RULES, none) == want
    assert found(frame.where("false"), URL_RULES, none) == []
    odd = spark.createDataFrame([(None, "block"), ("", "allow"), ("http://q.info/", None), ("http://q.info/", "other")], "url string, label string")
    assert found(frame, URL_RULES, odd) == want
    assert {v for *_, v in found(spark.createDataFrame([(1, "x")], "page_id long, url string"), [], none, default="block")} == {"block"}


def test_query(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    rows = [(r.page_id, r.url) for r in pages.collect()]
    ruled = [(u, r.verdict) for _, u in rows if (r := stated(u, URL_RULES))]
    got = LLM_QUERIES["op11_url_filter"](spark, SMALL)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "confidence"]
    got = sorted(map(tuple, got.drop("confidence").collect()), key=str)
    assert got == brute(rows, URL_RULES, ruled, urls.LEAST, urls.CONFIDENCE)
