"""Position-table checksums and importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tillroll.llm import crc, resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
KIND = "doc_id long, text string, extra string"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def features(text, low, high):
    w = words(text)
    return [" ".join(w[i : i + n]).encode() for n in range(low, high + 1) for i in range(len(w) - n + 1)]


def brute(docs, target, low=1, high=1, n_buckets=10_000, least=20, percent=10, seed=2024):
    bucket = lambda f: zlib.crc32(f) % n_buckets
    s, t = (Counter(bucket(f) for text in texts for f in features(text, low, high)) for texts in ([d[1] for d in docs], target))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + n_buckets) / ((s[b] + 1) * (all_t + n_buckets))))
    rows = []
    for i, text, *_ in docs:
        f = features(text, low, high)
        weight = sum(gain(bucket(x)) for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text)), None])
    open_ = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(open_[: percent * len(open_) // 100], 1):
        r[5] = k
    return sorted(((r[0], r[1], r[2], r[3], r[5]) for r in rows), key=str)


def found(frame, target, **options):
    out = resampling.resampled(frame, target, **options)
    return sorted(((r[0], r.n_features, r.weight, r.score, r["rank"]) for r in out.collect()), key=str)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=300), max_size=12))
def test_checksums_of_short_spans(parts):
    data = np.frombuffer(b"".join(parts) + b"x", np.uint8)
    ends = np.cumsum([len(p) for p in parts]) if parts else np.zeros(0, int)
    starts = ends - np.array([len(p) for p in parts], int)
    assert crc.crc32(data, starts, ends).tolist() == [zlib.crc32(p) for p in parts]


@pytest.mark.parametrize("window", [crc.WINDOW, 5000])
def test_checksums_of_long_and_overlapping_spans(monkeypatch, window):
    monkeypatch.setattr(crc, "WINDOW", window)
    rng = np.random.default_rng(3)
    data = rng.integers(0, 256, 600_000, dtype=np.uint8)
    length = np.array([0, 1, 63, 64, 65, 127, 128, 129, 4095, 4096, 4097, 262_144, 262_145, 500_000])
    starts = rng.integers(0, 600_000 - length + 1)
    want = [zlib.crc32(data[a : a + n].tobytes()) for a, n in zip(starts, length)]
    assert crc.crc32(data, starts, starts + length).tolist() == want


@pytest.mark.parametrize("window", [crc.WINDOW, 7])
def test_words_of_any_text(monkeypatch, window):
    monkeypatch.setattr(resampling, "WINDOW", window)
    rng = random.Random(4)
    texts = ["".join(rng.choice("aB9 é\n.ÄxY \x00ſ") for _ in range(rng.randrange(80))) for _ in range(40)] + ["", "..", "ÀÉ z"]
    data, starts, ends, count = resampling._spread([t.encode() for t in texts] + [None])
    got = [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]
    assert got == [w for t in texts for w in words(t)] and count.tolist() == [len(words(t)) for t in texts] + [0]


@pytest.mark.parametrize("low,high", [(1, 1), (1, 2), (2, 3)])
def test_resampling(spark, low, high):
    rng = random.Random(low * 10 + high)
    say = lambda vocabulary, n: " ".join(rng.choice(vocabulary) for _ in range(n))
    one, two = [f"word{k}" for k in range(40)], [f"Wort{k}é" for k in range(40)]
    docs = [(i, say(one if i % 3 else two, rng.randrange(60)), "x") for i in range(300)]
    target = [say(two, 50) for _ in range(5)]
    frame, aim = spark.createDataFrame(docs, KIND).repartition(5), spark.createDataFrame([(t,) for t in target], "text string")
    options = {"low": low, "high": high, "n_buckets": 500, "least_words": 10, "percent": 25}
    got = found(frame, aim, **options)
    assert got == brute(docs, target, low, high, 500, 10, 25)
    drawn = [i for i, *_, rank in got if rank]
    if low == 1:  # random pairs of words hardly repeat; single words of the target do
        assert sum(i % 3 == 0 for i in drawn) > 0.6 * len(drawn)  # a third of all have its words


def test_odd_rows(spark):
    long = "Ab " * 70_000
    docs = [(1, None, "x"), (2, "", "x"), (None, long, "x"), (4, long, "x"), (4, long, "x"), (5, "...", "x"), (6, "x" * 300_000, "x"), (None, None, None)]
    docs += [(k, "a b c " * 10, "x") for k in range(7, 30)]
    frame, aim = spark.createDataFrame(docs, KIND), spark.createDataFrame([("ab c",), (None,), ("",)], "text string")
    want = brute(docs, ["ab c", None, ""])
    assert found(frame, aim) == want
    clash = frame
    for name in ("id", "tie", "weight", "score", "rank", "n_words", "open", "place", "_part"):
        clash = clash.withColumn(name, F.lit("no"))
    assert found(clash.repartition(6), aim) == want
    assert found(frame.where("false"), aim) == []
    assert found(frame, aim.where("false")) == brute(docs, [])
    with pytest.raises(ValueError):
        resampling.resampled(frame, aim, low=3, high=2)
