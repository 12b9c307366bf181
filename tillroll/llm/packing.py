"""Packing of tokenized documents into sequences of fixed length, by sums of squares.

A document is its token ids and an end id. One that is longer than a sequence is cut into pieces of a whole
sequence, of which the first may be shorter; whole pieces fill a sequence by themselves. The others are dealt to
groups of at most about ``GROUP`` pieces, one task each, longest first. A piece goes to the open bin, or to a new
one, after which the sum over all gaps of the squared number of open bins with that gap is smallest; full bins do
not count. Bins that end up less than ``FULL`` filled are emptied again and their pieces packed once more, in
groups of their own, so that the number of groups costs next to nothing.

A null or empty text is the end id alone. Repeated rows are documents of their own. Rows with a null id are packed
like all others. An empty table gives no rows. Only the id and text columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tillroll.staging import written

LENGTH = 2048
END = 0
VOCABULARY = "byte_bpe_50k.json"
GROUP = 32_768
FULL = 0.98
_SALT = 1 << 40  # sequence numbers of one group
_ROWS = 512  # documents whose ids are held at once


@lru_cache(maxsize=2)
def _encoder(vocabulary: str):
    """The byte-level merges of a public vocabulary file; ids equal those of the ``tokenizers`` library, at four times its speed.

    Like there, the strings of special tokens inside a text become their ids.
    """
    import public_tokenizers
    import tiktoken

    with open(vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary), encoding="utf-8") as file:
        spec = json.load(file)
    # such files write the bytes that are no printable characters as the characters from 256 on
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    byte = {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def encode(text: str) -> list[int]:
        if any(name in text for name in special):
            return encoding.encode(text, allowed_special="all")
        return encoding.encode_ordinary(text)  # does not search for special tokens

    return encode


def tokenized(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, length: int = LENGTH, end: int = END
) -> DataFrame:
    """One row per piece: the id, ``piece``, ``start`` (the ids before), ``length`` and ``ids``, little-endian unsigned 32-bit numbers."""
    kept = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                rows, pieces, starts, lengths, held = [], [], [], [], []
                for row, text in enumerate(part.column(1).to_pylist()):
                    ids = np.array([*(encode(text) if text else ()), end], "<u4").tobytes()
                    total = len(ids) // 4
                    first = total % length or length
                    bounds = [0, *range(first, total + 1, length)]
                    for n, (low, high) in enumerate(zip(bounds, bounds[1:])):
                        rows.append(row)
                        pieces.append(n)
                        starts.append(low)
                        lengths.append(high - low)
                        held.append(ids[4 * low : 4 * high])
                columns = [part.column(0).take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32())]
                columns += [pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(held, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "piece", "start", "length", "ids"])

    kind = kept.schema["id"].dataType.simpleString()
    out = kept.mapInArrow(cut, f"id {kind}, piece int, start long, length long, ids binary")
    return out.withColumnRenamed("id", id_col)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece, in the given order."""
    count = np.zeros(capacity + 1, np.int64)  # open bins by gap
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    for i, size in enumerate(lengths.tolist()):
        # by gap left: a bin moves from gap left + size to left; one that is filled counts no longer
        change = 2 * (count[: capacity - size + 1] - count[size:] + 1)
        change[0] = 1 - 2 * count[size]
        change[count[size:] == 0] = 4 * len(lengths)  # no such bin; a new one is always better
        left = int(change.argmin())
        fresh = 2 * count[capacity - size] + 1 if size < capacity else 0
        if fresh < change[left]:
            number, gap, left = made, capacity, capacity - size
            made += 1
        else:
            gap = left + size
            number = open_bins[gap].pop()
            count[gap] -= 1
        bins[i], offsets[i] = number, capacity - gap
        if left:
            open_bins[left].append(number)
            count[left] += 1
    return bins, offsets


def _packed(pieces: DataFrame, round_: int, length: int, group: int) -> DataFrame:
    """``pieces`` (row, length) with ``sequence_id``, ``offset`` and ``filled``, the fill of the sequence."""
    rows = pieces.count()
    groups = max(1, -(-rows // group))
    dealt = pieces.withColumn("g", F.pmod(F.xxhash64("row"), F.lit(groups)))

    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "row"], ascending=[False, True], ignore_index=True)
        bins, offsets = sum_of_squares(frame["length"].to_numpy(), length)
        fill = np.bincount(bins, weights=frame["length"]).astype(np.int64)
        number = (round_ << 60) + key[0] * _SALT + bins
        return pd.DataFrame({"row": frame["row"], "length": frame["length"], "sequence_id": number, "offset": offsets, "filled": fill[bins]})

    return dealt.groupBy("g").applyInPandas(pack, "row long, length long, sequence_id long, offset long, filled long")


def pack(pieces: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """``pieces``, a table with a ``length`` column of 1 to ``length``, with ``sequence_id`` and ``offset``.

    ``pieces`` is written once, with a number for each row.
    """
    rows = written(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    whole = F.col("length") == length
    first = written(_packed(rows.where(~whole).select("row", "length"), 1, length, group), "packed-first")
    good = F.col("filled") >= int(FULL * length)
    second = _packed(first.where(~good).select("row", "length"), 2, length, group)
    placed = first.where(good).unionByName(second).select("row", "sequence_id", "offset")
    short = rows.where(~whole).join(placed, "row")
    alone = rows.where(whole).withColumn("sequence_id", F.col("row")).withColumn("offset", F.lit(0).cast("long"))
    return short.unionByName(alone).drop("row")


def packed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, **options) -> DataFrame:
    """One row per piece of each document: id, ``piece``, ``start``, ``length``, ``ids``, ``sequence_id``, ``offset``."""
    return pack(tokenized(docs, id_col, text_col, length=length, **options), length)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences of ``packed_documents``: ``sequence_id`` and ``ids``, each at most one sequence long."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"))
