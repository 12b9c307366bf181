"""Secret scans: all rules compiled into one minimal byte automaton.

``spans`` and ``redacted`` run over whole texts. One pass of the combined
automaton marks every byte at which a rule can end. Only texts with such a byte
are looked at again: the mirrored automaton marks where matches begin, and the
rule's own automaton gives the longest match from there, leftmost first and
without overlap per rule. A match that is too short is dropped, but its text
stays consumed. Spans count code points, the end is exclusive.

A null text is read as an empty one and has no spans; repeated rows and ids are
scanned row by row; other columns are passed through, and ``spans`` and
``redacted`` replace a column of the name they are given.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tillroll.llm.automata import Scanner, compile_rules, longest

# kind, rule, group that the least length holds for, least length: fixed values
BASE_RULES = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
# public token formats beyond the base ones: fixed values
MORE_RULES = (
    ("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    ("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
)
RULES = BASE_RULES + MORE_RULES
SPANS = "array<struct<kind:string,start:long,end:long>>"
_CHUNK = 4 << 20  # bytes scanned at once


@lru_cache(maxsize=4)
def _compiled(rules):
    patterns = [rule for _, rule, _, _ in rules]
    return (
        Scanner(compile_rules(patterns)),
        Scanner(compile_rules(patterns, mirrored=True)),
        [compile_rules([p], search=False) for p in patterns],
        [re.compile(p.encode()) for p in patterns],
    )


def _spans_of(text: bytes, starts: list[np.ndarray], rules) -> list[tuple[int, int, int]]:
    """(start, number of the rule, end) in bytes; ``starts[rule]`` are the ascending beginnings of its matches."""
    _, _, anchored, exact = _compiled(rules)
    found = []
    for number, (_, _, group, least) in enumerate(rules):
        free = 0
        for start in starts[number].tolist():
            if start < free:
                continue
            free = longest(anchored[number], text, start)
            low, high = (start, free) if group == 0 else exact[number].fullmatch(text, start, free).span(group)
            if high - low >= least:
                found.append((start, number, free))
    return sorted(found)


def find_spans(texts: list[bytes], rules=RULES) -> dict[int, list[tuple[int, int, int]]]:
    """By number of the text, its spans as (start, number of the rule, end) in bytes."""
    forward, backward, _, _ = _compiled(rules)
    found = {}
    at = 0
    while at < len(texts):
        until, size = at, 0
        while until < len(texts) and (until == at or size + len(texts[until]) <= _CHUNK):
            size += len(texts[until])
            until += 1
        hit = np.unique(forward.hits(texts[at:until])[0]) + at
        if len(hit):
            chosen = [texts[i] for i in hit]
            text, back, mask = backward.hits([t[::-1] for t in chosen])
            for k, number in enumerate(hit.tolist()):
                low, high = np.searchsorted(text, [k, k + 1])
                begin = (len(chosen[k]) - 1 - back[low:high])[::-1]
                bits = mask[low:high][::-1]
                found[number] = _spans_of(chosen[k], [begin[bits >> r & 1 == 1] for r in range(len(rules))], rules)
        at = until
    return {k: v for k, v in found.items() if v}


def _bytes(texts: pd.Series) -> list[bytes]:
    return [t.encode() if t else b"" for t in texts]


def _points(text: bytes, offsets: list[int]) -> list[int]:
    """Byte offsets as code points."""
    lead = np.concatenate([[0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)])
    return lead[offsets].tolist()


def spans(text: Column | str, rules=RULES) -> Column:
    """``array<struct<kind,start,end>>`` of all secrets in a text, by start, then by the order of the rules."""
    names = [kind for kind, *_ in rules]

    @F.pandas_udf(SPANS)
    def scan(texts: pd.Series) -> pd.Series:
        raw = _bytes(texts)
        out = [[] for _ in raw]
        for number, found in find_spans(raw, rules).items():
            start = _points(raw[number], [s for s, _, _ in found])
            end = _points(raw[number], [e for _, _, e in found])
            out[number] = [{"kind": names[r], "start": s, "end": e} for (_, r, _), s, e in zip(found, start, end)]
        return pd.Series(out)

    return scan(text)


def redacted(text: Column | str, rules=RULES) -> Column:
    """The text with every secret replaced by its kind in brackets; overlapping secrets become one."""
    names = [kind for kind, *_ in rules]

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        raw = _bytes(texts)
        out = list(texts)
        for number, found in find_spans(raw, rules).items():
            parts, free = [], 0
            for start, rule, end in found:
                if start >= free:
                    parts += [raw[number][free:start], f"[{names[rule].upper()}]".encode()]
                free = max(free, end)
            out[number] = b"".join([*parts, raw[number][free:]]).decode()
        return pd.Series(out, dtype=object)

    return clean(text)


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """One row per row of ``docs``: the id and ``spans``."""
    return docs.select(F.col(id_col), spans(F.col(text_col), rules).alias("spans"))


def redact_documents(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with secrets replaced in the text and, if there is such a column, its length counted anew."""
    out = docs.withColumn(text_col, redacted(F.col(text_col)))
    if length_col in docs.columns:
        changed = F.length(text_col).cast(docs.schema[length_col].dataType)
        out = out.withColumn(length_col, F.when(F.col(text_col).isNotNull(), changed).otherwise(F.col(length_col)))
    return out
