"""Importance resampling towards a target distribution over hashed n-grams of words.

Features are all runs of ``low`` to ``high`` consecutive words, joined by one space and repeats counted; a feature's bucket
is the CRC-32 of its bytes modulo ``n_buckets`` (see ``crc``). A bucket's gain is the logarithm of its smoothed share in
the target over that in the documents, in thousandths and rounded down; a document's weight is the mean gain of its
features, rounded down. A seeded Gumbel number by id is added, and of the documents with enough words the best are
drawn: a sample without replacement in which a document's chance grows with its weight.

The texts are read twice, once for the counts (at most ``n_buckets`` numbers a task) and once for the weights; neither
moves a text. Ranks come from a global order in range partitions.

A word is a run of ASCII digits, lower-cased ASCII letters and other characters beyond ASCII. A null text has none.
Documents without features have weight 0. A null id counts as an empty one for the seeded number. Rows are taken one by
one, so ids and rows may repeat; equal scores go to the smaller id, nulls last, then by a digest of the text. Only id
and text are read, so extra columns cannot clash. An empty table gives no rows; an empty target gives gains all the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.crc import WINDOW, crc32
from tillroll.operators.ordering import global_row_number
from tillroll.staging import written

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
#: Bytes of words as they are, capital letters as small ones, all else as a space.
_WORDS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def _spread(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(data, starts, ends, count): the words with one space between them, where they are, and how many each text has."""
    joined = b" ".join([(t or b"").translate(_WORDS) for t in texts])
    raw = np.frombuffer(joined + b" ", np.uint8)
    ends_of = np.cumsum([len(t or b"") + 1 for t in texts])
    data, count = [], np.zeros(len(texts), np.int64)
    starts, ends, held = [], [], 0
    opened = False  # within a word that began in an earlier window
    for low in range(0, len(raw), WINDOW):
        part = raw[low : low + WINDOW]
        inside = part != 32
        before = np.concatenate([[opened], inside[:-1]])
        keep = inside | before  # a word's bytes, and the first space behind it
        begins, stops = np.flatnonzero(inside & ~before), np.flatnonzero(~inside & before)
        place = np.cumsum(keep) - 1 + held
        starts.append(place[begins])
        ends.append(place[stops])
        np.add.at(count, np.searchsorted(ends_of, begins + low, "right"), 1)
        data.append(part[keep])
        held += len(data[-1])
        opened = bool(inside[-1])
    whole = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return whole(data, np.uint8), whole(starts, np.int64), whole(ends, np.int64), count


def buckets(texts: list[bytes | None], low: int = 1, high: int = 1, n_buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """By size of the run: (text, bucket) of every feature, the texts ascending."""
    data, starts, ends, count = _spread(texts)
    text = np.repeat(np.arange(len(texts)), count)
    for size in range(low, high + 1):
        first = np.arange(max(0, len(starts) - size + 1))
        first = first[text[first] == text[first + size - 1]]
        yield text[first], crc32(data, starts[first], ends[first + size - 1]) % np.uint32(n_buckets)


def _batches(texts: pd.Series, size: int = 1 << 22) -> Iterator[tuple[int, list[bytes | None]]]:
    """Runs of texts of about ``size`` bytes, each with its first place."""
    rows, low, held = texts.tolist(), 0, 0
    for i, text in enumerate(rows):
        held += len(text or b"")
        if held >= size or i == len(rows) - 1:
            yield low, rows[low : i + 1]
            low, held = i + 1, 0


def _bytes(text: Column) -> Column:
    return text.cast("string").cast("binary")


def bucket_counts(docs: DataFrame, text_col: str = "text", low: int = 1, high: int = 1, n_buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all ``docs`` lie in each bucket: ``n_buckets`` numbers, whatever the number of rows."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(n_buckets, np.int64)
        for frame in frames:
            for _, texts in _batches(frame["text"]):
                for _, bucket in buckets(texts, low, high, n_buckets):
                    total += np.bincount(bucket, minlength=n_buckets)
        some = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": some, "n": total[some]})

    parts = docs.select(_bytes(F.col(text_col)).alias("text")).mapInPandas(count, "bucket long, n long")
    out = np.zeros(n_buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(counts: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The logarithm of the smoothed share of the target over that of the documents, in thousandths, rounded down."""
    n, all_docs, all_target = len(counts), int(counts.sum()), int(target.sum())
    up, down = float(all_docs + n), float(all_target + n)
    shares = [math.floor(1000 * math.log((t + 1.0) * up / ((s + 1.0) * down))) for s, t in zip(counts.tolist(), target.tolist())]
    return np.array(shares, np.int64)


def weighted(text: Column, gain: np.ndarray, low: int = 1, high: int = 1) -> Column:
    """(n_words, n_features, weight) of a text."""

    @F.pandas_udf("struct<n_words:long,n_features:long,weight:long>")
    def weigh(texts: pd.Series) -> pd.DataFrame:
        words, features, total = (np.zeros(len(texts), np.int64) for _ in range(3))
        for first, some in _batches(texts):
            here = slice(first, first + len(some))
            words[here] = _spread(some)[3] if low > 1 else 0
            for size, (owner, bucket) in enumerate(buckets(some, low, high, len(gain)), low):
                number = np.bincount(owner, minlength=len(some))
                features[here] += number
                if size == 1:
                    words[here] = number
                # sums of whole numbers stay exact in doubles up to 2**53
                total[here] += np.bincount(owner, gain[bucket], len(some)).astype(np.int64)
        return pd.DataFrame({"n_words": words, "n_features": features, "weight": total // np.maximum(features, 1)})

    return weigh(_bytes(text))


def noise(id_: Column, seed: int) -> Column:
    """A Gumbel number in thousandths that depends on the id and the seed only."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def resampled(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", low: int = 1, high: int = 1,
    n_buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """One row per document: the id, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``.

    Of the documents with ``least_words`` words or more, ``percent`` in a hundred are drawn, those with the highest scores;
    they have a rank, from 1. The others' rank is null. ``target`` needs the column ``text_col`` only.
    """
    if not 1 <= low <= high:
        raise ValueError("low must be at least 1 and at most high")
    gain = gains(bucket_counts(docs, text_col, low, high, n_buckets), bucket_counts(target, text_col, low, high, n_buckets))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tie"), weighted(F.col(text_col), gain, low, high).alias("w"))
    rows = rows.select("id", "tie", "w.*").withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    rows = written(rows, "weights")
    open_ = F.col("n_words") >= least_words
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("tie")]
    ranked = global_row_number(rows.where(open_), order, "place", "open")
    place = F.when(F.col("place") <= F.floor(F.lit(percent) * F.col("open") / 100), F.col("place"))
    columns = [F.col("id").alias(id_col), "n_words", "n_features", "weight", "score"]
    drawn = ranked.select(*columns, place.cast("long").alias("rank"))
    return drawn.unionByName(rows.where(~open_).select(*columns, F.lit(None).cast("long").alias("rank")))
