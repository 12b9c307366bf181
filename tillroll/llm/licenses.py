"""License scans by conditional compression.

Texts are cut into sentences; those that hold a licensing word, with at most ``GAP`` others between them, form candidate
blocks. A block is compressed by zstandard as it is and with every template as a raw dictionary; templates are ranked by
how much smaller that makes it. The winner is confirmed by its wording: the differences between the words of template and
block. ``exact`` is a template whose words stand in the block in a row, ``variant`` one of which at least ``COVERED`` is
there in order and that differs in no defining word: names of licenses, their qualifiers, version numbers and negations, be
they missing, replaced or put in. A negated notice ("not released under ...") is none either. A winner that its wording
refuses gives way to the next in rank; what no template confirms is no finding.

Spans count code points of the whole text, the end exclusive. A null or empty text has no findings; repeated rows and ids
are scanned row by row; only the id and text are read. Of templates that make a block equally small the first one wins.
"""

from __future__ import annotations

import difflib
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F


def _creative_commons() -> list[tuple[str, str]]:
    """Short and long notices of all kinds and versions but those that are written out below."""
    out = []
    names = {"SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
    for version, reach in (("4.0", "International"), ("3.0", "Unported")):
        for parts in ((), ("SA",), ("NC",), ("ND",), ("NC", "SA"), ("NC", "ND")):
            if version == "4.0" and parts in ((), ("SA",), ("NC",)):
                continue
            short, long = "-".join(["BY", *parts]), "-".join(["Attribution", *(names[p] for p in parts)])
            name = f"CC-{short}-{version}"
            out.append((name, f"Licensed under CC {short} {version}."))
            out.append((name, f"This work is licensed under a Creative Commons {long} {version} {reach} License."))
    return out


# (license, template): wording in public use, fixed values
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License - see the LICENSE file for details."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction, including without limitation the'
        " rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit"
        " persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with'
        " the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later"
        " version.",
    ),
    (
        "GPL-2.0-or-later",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public"
        " License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later"
        " version.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met:",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not"
        " distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("BSD", "Released under the BSD License."),
    ("BSD-2-Clause", "This project is licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "This project is licensed under the BSD 3-Clause License."),
    ("ISC", "Released under the ISC License."),
    ("Apache-1.1", "Licensed under the Apache License, Version 1.1."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0-or-later", "This work is licensed under the GNU General Public License, version 2 or later."),
    ("GPL-3.0-or-later", "This work is licensed under the GNU General Public License, version 3 or later."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    (
        "LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General"
        " Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option)"
        " any later version.",
    ),
    (
        "LGPL-3.0-or-later",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)"
        " any later version.",
    ),
    (
        "AGPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option)"
        " any later version.",
    ),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    *_creative_commons(),
)
# words that tell licenses apart, and words that turn a notice round: fixed values
NAMES = frozenset(
    "mit apache gnu gpl lgpl agpl lesser library affero mozilla mpl bsd clause isc eclipse epl boost bsl artistic zlib unlicense cc cc0 sa nc nd"
    " sharealike noncommercial noderivatives noderivs proprietary commercial only later".split()
)
NEGATIONS = frozenset("not no never cannot nor neither except non isn aren prohibited forbidden revoked denied".split())
# beginnings of licensing words, lower case: fixed values
HINTS = ("licen", "copyright", "permission", "permitted", "redistribut", "public domain", "free software", "mozilla")
GAP = 2
COVERED = 0.8
BEFORE = 4
FINDING = "array<struct<start:long,end:long,license:string,template:int,reduction:double,wording:string,differences:array<string>>>"
_SENTENCE = re.compile(r"(?:[^\n.!?]|[.!?](?!\s|$))+[.!?]*", re.MULTILINE)
_WORD = re.compile(r"\w+")
_STOP = re.compile(r"[.:!?]*")
_END = re.compile(r"[.:;!?\n]")


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@lru_cache(maxsize=2)
def _compressors(templates):
    import zstandard

    plain = zstandard.ZstdCompressor(level=3)
    primed = []
    for _, text in templates:
        raw = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.append(zstandard.ZstdCompressor(level=3, dict_data=raw))
    return plain, primed, [_words(text) for _, text in templates]


def blocks(text: str) -> list[tuple[int, int]]:
    """(start, end) of the runs of sentences that may hold licenses."""
    if not any(h in text.lower() for h in HINTS):
        return []
    runs: list[list[int]] = []
    last = None
    for number, sentence in enumerate(_SENTENCE.finditer(text)):
        lower = sentence.group().lower()
        if any(h in lower for h in HINTS):
            start = sentence.end() - len(sentence.group().lstrip())
            if last is not None and number - last <= GAP + 1:
                runs[-1][1] = sentence.end()
            else:
                runs.append([start, sentence.end()])
            last = number
    return [(a, b) for a, b in runs]


def _occurrences(template: list[str], block: list[str]) -> list[int]:
    """Where the words of a template stand in a row, without overlaps."""
    size, out, at = len(template), [], 0
    while template:
        try:
            at = block.index(template[0], at, len(block) - size + 1)
        except ValueError:
            break
        if block[at : at + size] == template:
            out.append(at)
            at += size
        else:
            at += 1
    return out


def defining(word: str) -> bool:
    """Whether a difference in this word makes another license, or none. Numbers of up to two digits are versions."""
    return word in NAMES or word in NEGATIONS or (len(word) <= 2 and word.isdigit())


def _variant(match: difflib.SequenceMatcher, template: list[str], block: list[str]) -> tuple[list, list[str]] | None:
    """The matching blocks and the differences, if enough of the template is there and no defining word differs."""
    found = [m for m in match.get_matching_blocks() if m.size]
    if not found or sum(m.size for m in found) < COVERED * len(template):
        return None
    low, high = found[0].b, found[-1].b + found[-1].size  # the stretch of the block that the template covers
    changes = []
    for kind, a, b, c, d in match.get_opcodes():
        if kind == "equal" or (a == b and (d <= low or c >= high)):
            continue
        put_in = block[max(c, low) : min(d, high)]
        if any(map(defining, [*template[a:b], *put_in])):
            return None
        changes.append(f"{' '.join(template[a:b])} -> {' '.join(put_in)}")
    return found, changes


def differences(template: list[str], block: list[str]) -> tuple[str, list[str]]:
    """The wording of a block against a template: exact, variant or other, and where it differs."""
    if _occurrences(template, block):
        return "exact", []
    match = difflib.SequenceMatcher(None, template, block, autojunk=False)
    found = _variant(match, template, block)
    return ("variant", found[1]) if found else ("other", [])


def _near(match: difflib.SequenceMatcher, template: list[str], block: list[str]):
    """(low, high, matched words, differences) of a variant close to the longest run of words shared with the block."""
    size = len(template)
    match.set_seq1(template)
    run = match.find_longest_match()
    first = max(0, run.b - run.a - size)
    window = block[first : run.b - run.a + 2 * size]
    inner = difflib.SequenceMatcher(None, template, window, autojunk=False)
    confirmed = _variant(inner, template, window) if run.size else None
    if not confirmed:
        return None
    words = {first + m.b + n for m in confirmed[0] for n in range(m.size)}
    return min(words), max(words) + 1, words, confirmed[1]


def _notice(order: list[int], wording: list[list[str]], block: list[str]):
    """(template, low, high, kind, differences) of the first template in ``order`` that the words of a block confirm."""
    exact = {n: at for n in order if (at := _occurrences(wording[n], block))}
    match = difflib.SequenceMatcher(None, [], block, autojunk=False)
    for n in order:
        if n in exact:
            # a template that is part of another one that stands here as well
            n = max(exact, key=lambda m: len(wording[m]) if m == n or _occurrences(wording[n], wording[m]) else 0)
            return n, exact[n][0], exact[n][0] + len(wording[n]), "exact", []
        near = _near(match, wording[n], block)
        if not near:
            continue
        low, high, words, changes = near
        for m, places in exact.items():
            for at in places:
                end = at + len(wording[m])
                if at < high and end > low and not words.issuperset(range(at, end)):
                    return m, at, end, "exact", []
        return n, low, high, "variant", changes
    return None


def _apart(best: int, template: list[str], block: list[str]):
    """Like ``_notice``: a variant of one template, however far its words lie apart."""
    match = difflib.SequenceMatcher(None, template, block, autojunk=False)
    confirmed = _variant(match, template, block)
    if not confirmed:
        return None
    found, changes = confirmed
    return best, found[0].b, found[-1].b + found[-1].size, "variant", changes


def _negated(text: str, spans: list[tuple[int, int]], words: list[str], at: int) -> bool:
    """Whether one of the ``BEFORE`` words ahead of a notice, in its sentence, turns it round."""
    for n in range(at - 1, max(-1, at - 1 - BEFORE), -1):
        if _END.search(text, spans[n][1], spans[n + 1][0]):
            return False
        if words[n] in NEGATIONS:
            return True
    return False


def _gains(text: str, plain, primed) -> list[float]:
    raw = text.encode()
    size = len(plain.compress(raw))
    return [(size - len(c.compress(raw))) / size for c in primed]


def findings_of(text: str, templates=TEMPLATES) -> list[dict]:
    plain, primed, wording = _compressors(templates)
    out = []
    pieces = [(start, end, True) for start, end in blocks(text)]
    while pieces:
        start, end, is_block = pieces.pop()
        piece = text[start:end]
        if not any(h in piece.lower() for h in HINTS):
            continue
        spans = [(start + w.start(), start + w.end()) for w in _WORD.finditer(piece)]
        words = [text[a:b].lower() for a, b in spans]
        gains = _gains(piece, plain, primed)
        order = sorted(range(len(gains)), key=lambda n: (-gains[n], n))
        notice = _notice(order, wording, words) or (is_block and _apart(order[0], wording[order[0]], words))
        if not notice:
            continue
        n, low, high, kind, changes = notice
        behind = start
        for at in _occurrences(words[low:high], words):  # repeated notices at once
            a, b = spans[at][0], _STOP.match(text, spans[at + high - low - 1][1], end).end()
            pieces.append((behind, a, False))
            behind = b
            if _negated(text, spans, words, at):
                continue
            out.append({
                "start": a, "end": b, "license": templates[n][0], "template": n, "reduction": _gains(text[a:b], plain, primed[n : n + 1])[0],
                "wording": kind, "differences": changes,
            })
        pieces.append((behind, end, False))
    return sorted(out, key=lambda f: f["start"])


def findings(text: Column | str, templates=TEMPLATES) -> Column:
    """``array<struct<start,end,license,template,reduction,wording,differences>>`` of a text, by start."""

    @F.pandas_udf(FINDING)
    def scan(texts: pd.Series) -> pd.Series:
        return pd.Series([findings_of(t, templates) if t else [] for t in texts], dtype=object)

    return scan(text)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """One row per finding: the id, its span, license, template, reduction, wording and differences."""
    return docs.select(F.col(id_col), findings(F.col(text_col), templates).alias("f")).select(id_col, F.inline("f"))
