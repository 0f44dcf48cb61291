"""Licence scan by conditional compression.

Every licence cue is looked at with the words around it, whatever sentence or line they are in: a candidate block per
reach (16, 64, 256 words either side).  A block is compressed by itself and with each template of its reach as a raw
Zstandard dictionary, and the templates are ranked by the bytes that they save.  In that order the wording decides: the
template is placed over the cue by a word diff, which must be small and leave its telling words (names and versions)
untouched; the first template confirmed wins.  Templates whose telling words the block lacks cannot be confirmed and are
not compressed.  Of notices that overlap, the one that saves most is reported.

Templates are the texts and sentences in ``TEMPLATES`` and, by rule, the short names of licences and SPDX lines, which
must be there word for word.  Words are compared in lower case, without punctuation around them, ``licence`` as ``license``.

Null or empty text: no block.  Null ``doc_id``: reported as null.  Repeated rows: each is reported.  Empty table: no
rows.  Other columns are ignored.  No shuffle: every text is read once, whole, and only texts with a cue reach Python.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from typing import NamedTuple

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coderail.llm.common import exact_ids, slices, table

# Public licence notices in their usual wording, with the words that tell them apart.
TEMPLATES = {
    "MIT": ("Released under the MIT License.", "mit"),
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.", "sublicense"),
    "ISC-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.", "fee"),
    "BSD-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer.", "binary"),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "apache 2.0"),
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License.", "apache 2.0"),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", "gnu general 2"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "gnu general 3"),
    "LGPL-3.0": ("This work is licensed under the GNU Lesser General Public License, version 3.", "gnu lesser 3"),
    "AGPL-3.0": ("This work is licensed under the GNU Affero General Public License, version 3.", "gnu affero 3"),
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.", "gnu 3"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mozilla 2.0"),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "by 4.0"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "by-sa 4.0"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "by-nc 4.0"),
    "CC-BY-4.0-text": ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "attribution 4.0"),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related rights to this work.", "waived"),
    "Unlicense": ("This is free and unencumbered software released into the public domain.", "unencumbered"),
    "BSD-3-Clause-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission.", "redistribution binary neither endorse"),
    "Zlib-text": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions:", "as-is anyone alter"),
    "BSL-1.0-text": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, "
        "execute, and transmit the Software", "organization accompanying"),
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version.", "gnu 2"),
    "LGPL-2.1-header": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version.", "gnu lesser 2.1"),
    "AGPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.", "gnu affero 3"),
    "All-rights-reserved": ("All rights reserved.", "reserved"),
}

# Licence identifiers and the names in use for them.
NAMES = {
    "MIT": ["MIT License", "MIT licensed", "License MIT", "licensed under MIT"],
    "Apache-2.0": ["Apache License 2.0", "Apache License Version 2.0", "Apache License v2.0", "Apache 2.0 License", "Apache 2.0", "Apache-2.0", "Apache License v2"],
    "BSD-2-Clause": ["BSD 2-Clause", "BSD-2-Clause", "2-clause BSD", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause", "BSD-3-Clause", "3-clause BSD", "New BSD License", "Modified BSD License"],
    "BSD-4-Clause": ["BSD 4-Clause", "BSD-4-Clause", "4-clause BSD"],
    "BSD": ["BSD License", "BSD licensed", "BSD-style license", "BSD-like license"],
    "ISC": ["ISC License", "License ISC"],
    "MPL-2.0": ["Mozilla Public License 2.0", "Mozilla Public License v. 2.0", "Mozilla Public License Version 2.0", "Mozilla Public License v2.0", "MPL 2.0", "MPL-2.0"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License v2.0", "Eclipse Public License v. 2.0", "EPL-2.0"],
    "BSL-1.0": ["Boost Software License", "BSL-1.0"],
    "Zlib": ["zlib License", "zlib/libpng License"],
    "PSF-2.0": ["Python Software Foundation License", "PSF License", "PSF-2.0"],
    "Unlicense": ["The Unlicense"],
    "CC0-1.0": ["CC0 1.0", "CC0-1.0", "CC0"],
}
GNU = {"GPL": "General Public License", "LGPL": "Lesser General Public License", "AGPL": "Affero General Public License"}
GNU_VERSIONS = {"GPL": ["1", "2", "3"], "LGPL": ["2", "2.1", "3"], "AGPL": ["3"]}
CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
      "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
CC_VERSIONS = ["2.0", "2.5", "3.0", "4.0"]


def short_names() -> Iterator[tuple[str, str]]:
    """Licence and one of its names: those of ``NAMES``, the usual forms of GNU and Creative Commons names, and the SPDX lines of all."""
    ids = dict(NAMES)
    for family, long in GNU.items():
        for v in GNU_VERSIONS[family]:
            full = v if "." in v else v + ".0"
            said = sorted({v, full})
            ids[f"{family}-{full}"] = [name for x in said for name in (
                f"GNU {long} version {x}", f"GNU {long} v{x}", f"GNU {long} {x}", f"{family}v{x}", f"{family} v{x}", f"{family} version {x}",
                f"{family} {x}", f"{family}-{x}", f"{family}{x}", f"version {x} of the GNU {long}")]
            for more in ("only", "or-later"):
                ids[f"{family}-{full}-{more}"] = [f"{family}-{full}-{more}"]
    for kind, long in CC.items():
        for v in CC_VERSIONS:
            ids[f"CC-{kind}-{v}"] = [f"CC {kind} {v}", f"CC-{kind} {v}", f"CC-{kind}-{v}", f"Creative Commons {long} {v}", f"Creative Commons {long} License {v}"]
    for name, forms in ids.items():
        for form in [*forms, f"SPDX-License-Identifier: {name}"]:
            yield name, form


CUE = (r"licen[cs]|copyright|rights reserved|public domain|creative commons|\bcc[ -]by|\bcc0|\b[al]?gpl|\bmpl|\bbsd|permission (is|to)|"
       r"redistribution and use|free software|apache[ -]2|as-is")

#: Share of differing words up to which a block counts as a changed notice.
MAX_DIFFERENT = 0.2
LEVEL = 19
#: Templates of up to so many words are compared with every run of words over the cue.
SHORT = 16
WORD = re.compile(r"\S+")
AROUND = "\"'().,;:!?“”‘’*#/-<>[]+"


def plain_word(word: str) -> str:
    """A word in lower case without the punctuation around it, in one spelling of license."""
    return word.lower().strip(AROUND).replace("licence", "license")


def words_of(text: str) -> list[str]:
    return [w for w in map(plain_word, text.split()) if w]


class Template(NamedTuple):
    name: str
    words: list[str]
    telling: frozenset[str]
    most: int  # words that may be missing, and as many added
    compressor: zstandard.ZstdCompressor


class Notice(NamedTuple):
    license: str
    verdict: str
    n_different: int
    missing: str
    added: str
    size_alone: int
    size_given: int
    start: int
    end: int

    @property
    def rank(self) -> tuple:
        return self.size_given - self.size_alone, self.n_different, self.license, self.start


@functools.cache
def templates() -> dict[int, list[Template]]:
    """Templates by reach: the words either side of a cue among which a template that covers it must lie."""
    out: dict[int, list[Template]] = {}
    given = [(name, text, frozenset(telling.split()), MAX_DIFFERENT) for name, (text, telling) in TEMPLATES.items()]
    given += [(name, text, frozenset(words_of(text)), 0) for name, text in short_names()]
    for name, text, telling, share in given:
        words = words_of(text)
        raw = " ".join(words).rjust(8).encode()  # dictionaries below 8 bytes are not used
        known = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        most, reach = int(share * len(words)), 16
        while reach < len(words) + most:
            reach *= 4
        out.setdefault(reach, []).append(Template(name, words, telling, most, zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False)))
    return out


@functools.cache
def plain() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)


def around(text: str, at: int, need: int) -> tuple[list[tuple[int, int, str]], int]:
    """Start, end and plain form of the words within ``need`` words of the one at ``at``, and the number of those before it."""
    def words(found: Iterator[re.Match]) -> Iterator[tuple[int, int, str]]:
        return ((m.start(), m.end(), w) for m in found if (w := plain_word(m[0])))

    while at and not text[at - 1].isspace():
        at -= 1
    size = 16 * need
    while True:
        low = max(0, at - size)
        before = list(words(WORD.finditer(text, low, at)))
        if low:
            before = before[1:]  # may be the end of a word
        if not low or len(before) >= need:
            break
        size *= 2
    before = before[-need:]
    return before + list(itertools.islice(words(WORD.finditer(text, at)), need + 1)), len(before)


def differences(block: list[str], template: list[str]) -> tuple[list[str], list[str]]:
    """Template words missing from the block, and block words added to it."""
    missing, added = [], []
    for op, a, b, c, d in SequenceMatcher(None, template, block, autojunk=False).get_opcodes():
        if op != "equal":
            missing += template[a:b]
            added += block[c:d]
    return missing, added


def placements(words: list[str], template: list[str], most: int) -> Iterator[tuple[int, int]]:
    """First and last word of the places that may hold the template with up to ``most`` words missing and as many added:
    all such runs of words for a short template, for a long one the run of fewest edits up to each word."""
    n, known = len(template), set(template)
    if n <= SHORT:
        ends = [i for i, w in enumerate(words) if w in known]
        yield from ((i, j) for i in ends for j in ends if n - most <= j - i + 1 <= n + most)
        return
    row = [(0, j) for j in range(len(words) + 1)]  # edits, first word of the place
    for i, t in enumerate(template, 1):
        old, row = row, [(i, 0)]
        for j, w in enumerate(words, 1):
            row.append(old[j - 1] if t == w else min((old[j][0] + 1, old[j][1]), (row[-1][0] + 1, row[-1][1])))
    for j, (edits, first) in enumerate(row):
        if edits <= 2 * most and j > first:
            yield first, j - 1


def ranked(words: tuple[str, ...], reach: int) -> list[tuple[int, int, int]]:
    """Bytes that a template saves (negative), its number and the block's size with it, for the templates that can be confirmed, best first."""
    seen = set(words)
    able = [(k, t) for k, t in enumerate(templates()[reach]) if t.telling <= seen and sum(w not in seen for w in t.words) <= t.most]
    if not able:
        return []
    raw = " ".join(words).encode()
    alone = len(plain().compress(raw))
    return sorted((given - alone, k, given) for k, t in able for given in [len(t.compressor.compress(raw))])


@functools.lru_cache(maxsize=4096)
def confirmed(words: tuple[str, ...], before: int, reach: int) -> tuple | None:
    """The best-ranked template whose wording covers the word ``before``: template name, verdict, words that differ, missing, added, sizes, first and last word."""
    for less, k, given in ranked(words, reach):
        name, template, telling, most, _ = templates()[reach][k]
        best, known, bag = None, set(template), Counter(template)
        low = max(0, before + 1 - len(template) - most)  # a confirmed place is no longer than that
        near = list(words[low : before + len(template) + most])
        if not telling <= set(near) or (bag - Counter(near)).total() > most:
            continue
        for a, b in placements(near, template, most):
            a, b = a + low, b + low
            while a < b and words[a] not in known:
                a += 1
            while a < b and words[b] not in known:
                b -= 1
            if not a <= before <= b or (bag - Counter(words[a : b + 1])).total() > most:
                continue
            missing, added = differences(list(words[a : b + 1]), template)
            n = max(len(missing), len(added))
            if n <= most and not telling & set(missing):
                found = (n, a, b, " ".join(missing), " ".join(added))
                best = min(best, found) if best else found
        if best:
            n, a, b, missing, added = best
            return name, "modified" if missing or added else "exact", n, missing, added, given - less, given, a, b
    return None


def best_at(text: str, at: int) -> Notice | None:
    """The confirmed template over the cue at ``at`` that saves most, of all reaches."""
    widest = max(templates())
    got, before = around(text, at, widest)
    best = None
    for reach in templates():
        low = max(0, before - reach)
        part = got[low : before + reach + 1]
        found = confirmed(tuple(w for _, _, w in part), before - low, reach)
        if found:
            notice = Notice(*found[:-2], part[found[-2]][0], part[found[-1]][1])
            best = min(best, notice, key=lambda x: x.rank) if best else notice
    return best


#: A notice of more characters than this is not looked for again at the cues inside it.
LONG_NOTICE = 200


def notices(text: str) -> list[Notice]:
    """The notices of a text in order; of those that overlap, the one that saves most bytes."""
    found: set[Notice] = set()
    done = 0
    for m in re.finditer(CUE, text, re.IGNORECASE):
        if m.start() >= done and (notice := best_at(text, m.start())):
            found.add(notice)
            if notice.end - notice.start > LONG_NOTICE:
                done = notice.end
    out: list[Notice] = []
    for x in sorted(found, key=lambda x: x.rank):
        if all(x.end <= o.start or o.end <= x.start for o in out):
            out.append(x)
    return sorted(out, key=lambda x: x.start)


def recognise(text: str) -> Notice | None:
    """The notice of a text that saves most bytes."""
    return min(notices(text), default=None, key=lambda x: x.rank)


RESULT = ("doc_id long, block_start long, license string, verdict string, n_different long, missing string, added string, "
          "size_alone long, size_given_template long")


def scan(docs: DataFrame) -> DataFrame:
    """One row per confirmed notice of each document."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in slices(frames, "text"):
            out = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                out += [(None if doc_id is None else int(doc_id), n.start, *n[:-2]) for n in notices(text)]
            made = pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")])
            made["doc_id"] = exact_ids([r[0] for r in out])
            yield made

    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").where(F.col("text").rlike(f"(?i){CUE}")).mapInPandas(rows, RESULT)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
