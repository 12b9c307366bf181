import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillroll.llm import packing

SCHEMA = "doc_id long, text string, sequence_id string, length int"
TEXTS = [
    "", None, "Hello world", "Hello world", "a<|endoftext|>b", "日本語 ünï 😀\r\n\t  x", " " * 50, "x" * 3000,
    "lorem ipsum " * 2000, "The quick brown fox. " * 30, "1234567890 " * 5,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 3 else 2, t, "clash", 1) for i, t in enumerate(TEXTS)] + [(None, "no id", "clash", 1)]
    return spark.createDataFrame(rows, SCHEMA)


def expected_ids(text):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_ids_equal_those_of_the_tokenizer(docs):
    pieces = defaultdict(list)
    for r in packing.tokenized(docs).collect():
        pieces[r.doc_id].append((r.piece, r.start, r.length, np.frombuffer(r.ids, "<u4").tolist()))
    assert len(pieces[2]) == 2  # repeated rows are documents of their own
    for i, text in enumerate(TEXTS):
        if i in (2, 3):
            continue
        ids = expected_ids(text)
        got = sorted(pieces[i])
        assert [p[0] for p in got] == list(range(len(got)))
        assert [x for p in got for x in p[3]] == ids
        assert [p[1] for p in got] == [sum(q[2] for q in got[:k]) for k in range(len(got))]
        assert all(p[2] == packing.LENGTH for p in got[1:])


def test_sequences_hold_every_piece_without_gaps(docs):
    packed = packing.packed_documents(docs, length=64)
    rows = packed.collect()
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(r.length for r in rows)
    assert total == sum(len(expected_ids(t)) for t in [*TEXTS, "no id"])
    assert -(-total // 64) <= len(by_sequence) <= -(-total // 64) + 3
    joined = {r.sequence_id: len(r.ids) // 4 for r in packing.sequences(packed).collect()}
    assert joined == {s: sum(n for _, n in places) for s, places in by_sequence.items()}


def test_each_piece_goes_where_the_squares_are_smallest():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 20, 200)
    bins, offsets = packing.sum_of_squares(lengths, 20)
    gaps: dict[int, int] = {}
    for size, chosen, offset in zip(lengths.tolist(), bins.tolist(), offsets.tolist()):
        def squares(number):
            after = dict(gaps)
            after[number] = after.get(number, 20) - size
            count = defaultdict(int)
            for gap in after.values():
                count[gap] += gap > 0
            return sum(n * n for n in count.values())

        fits = [b for b, gap in gaps.items() if gap >= size] + [len(gaps)]
        assert offset == 20 - gaps.get(chosen, 20)
        assert squares(chosen) == min(squares(b) for b in fits)
        gaps[chosen] = gaps.get(chosen, 20) - size


def test_few_sequences_over_many_groups(spark):
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 2000, 4000).tolist()
    pieces = spark.createDataFrame([(s,) for s in sizes], "length long")
    packed = packing.pack(pieces, 2048, group=500)
    assert packed.select("sequence_id").distinct().count() <= 1.03 * sum(sizes) / 2048 + 1


def test_empty_table(spark):
    assert packing.packed_documents(spark.createDataFrame([], SCHEMA)).count() == 0


def test_checksum_is_that_of_the_ids(docs):
    row = packing.tokenized(docs.where("doc_id = 9")).selectExpr("crc32(ids) AS c").first()
    assert row.c == zlib.crc32(np.array(expected_ids(TEXTS[9]), "<u4").tobytes())
