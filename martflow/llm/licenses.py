"""License notices by conditional compression.

Blocks of text around license words are compressed with each license's template as a raw
zstandard dictionary.  The reduction against compression without one measures how much of
the block the template already says, and ranks the licenses.  Those it shortens are confirmed
by the exact differences in wording: every word of one notice of the template must stand
in the block in order, but for a small part that holds none of the words that tell the
license from others (its name and version).  Words that tell another license, or deny one,
must not have come in: a notice of the Lesser GPL is no notice of the GPL.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package

LEVEL = 9
BEFORE, AFTER = 300, 1200  # characters of a block around its first license word
WIDTHS = 24, 64, 160  # characters on both sides of a license word; a notice is most of one of these pieces
LEAST_GAIN = 0.15
MISSING_SHARE = 0.15


@dataclass(frozen=True)
class Template:
    """A license, the wordings that grant it, and the words that no notice may lack."""

    name: str
    notices: tuple[str, ...]
    telling: frozenset[str]


def template(name: str, telling: str, *notices: str) -> Template:
    return Template(name, notices, frozenset(telling.split()))


def titled(name: str, telling: str, *titles: str) -> Template:
    """A license by its titles: the usual grants of each, and its line for tools."""
    grants = [f"Licensed under {title}." for title in titles]
    return template(name, f"{telling} {name.lower()}", *grants, f"SPDX-License-Identifier: {name}")


#: Words that deny a license, within a notice or just before it in the same sentence and line.
DENYING = frozenset("not no never neither nor without cannot isn t don won aren non".split())
DENYING_BEFORE = 2  # words


# Short notices of common licenses, as their publishers word them.
TEMPLATES = (
    template(
        "Apache-2.0", "apache 2.0",
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License.",
    ),
    template(
        "MIT", "mit",
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
    ),
    template(
        "MIT", "permission charge",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
        'and associated documentation files (the "Software"), to deal in the Software without restriction',
    ),
    template(
        "GPL-3.0", "general public 3",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License v3.0.",
        "the terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    template(
        "GPL-2.0", "general public 2",
        "This work is licensed under the GNU General Public License, version 2.",
        "the terms of the GNU General Public License as published by the Free Software Foundation; "
        "either version 2 of the License, or (at your option) any later version.",
    ),
    template(
        "LGPL-3.0", "lesser general 3",
        "This work is licensed under the GNU Lesser General Public License, version 3.",
    ),
    template(
        "AGPL-3.0", "affero general 3",
        "This work is licensed under the GNU Affero General Public License, version 3.",
    ),
    template(
        "BSD-3-Clause", "bsd 3-clause",
        "Licensed under the BSD 3-Clause License.",
    ),
    template(
        "BSD", "redistribution binary",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met:",
    ),
    template(
        "MPL-2.0", "mozilla 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    template(
        "CC-BY-NC-4.0", "by-nc 4.0",
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under CC BY-NC 4.0.",
    ),
    template(
        "CC-BY-NC-4.0", "attribution-noncommercial 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    template(
        "CC-BY-4.0", "by 4.0",
        "Licensed under CC BY 4.0.",
        "This work is licensed under CC BY 4.0.",
    ),
    template(
        "CC-BY-SA-4.0", "by-sa 4.0",
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under CC BY-SA 4.0.",
    ),
    template(
        "CC0-1.0", "cc0 1.0",
        "Released under CC0 1.0.",
        "Licensed under CC0 1.0 Universal.",
    ),
    template(
        "All-Rights-Reserved", "rights reserved",
        "All rights reserved.",
    ),
    template(
        "LGPL-3.0", "lesser general 3",
        "Licensed under the GNU Lesser General Public License v3.0.",
        "the terms of the GNU Lesser General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    template(
        "AGPL-3.0", "affero general 3",
        "Licensed under the GNU Affero General Public License v3.0.",
        "the terms of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    template(
        "LGPL-2.1", "lesser general 2.1",
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "the terms of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version.",
    ),
    template(
        "GPL-2.0", "general public 2",
        "Licensed under the GNU General Public License v2.0.",
    ),
    template(
        "ISC", "permission fee purpose",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
        "fee is hereby granted",
    ),
    template(
        "Unlicense", "unencumbered domain",
        "This is free and unencumbered software released into the public domain.",
    ),
    template(
        "CC-BY-SA-4.0", "attribution-sharealike 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    template(
        "CC-BY-4.0", "attribution 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    titled("BSD-2-Clause", "bsd 2-clause", 'the BSD 2-Clause License', 'the Simplified BSD 2-Clause License'),
    titled("0BSD", "0bsd", "the 0BSD License", "the Zero-Clause 0BSD License"),
    titled("MPL-1.1", "mozilla 1.1", "the Mozilla Public License, version 1.1"),
    titled("EPL-2.0", "eclipse 2.0", "the Eclipse Public License, Version 2.0", "the Eclipse Public License v2.0"),
    titled("EPL-1.0", "eclipse 1.0", "the Eclipse Public License, Version 1.0", "the Eclipse Public License v1.0"),
    titled("CDDL-1.0", "distribution 1.0", "the Common Development and Distribution License, Version 1.0"),
    titled("EUPL-1.2", "european 1.2", "the European Union Public Licence, Version 1.2"),
    titled("CC-BY-ND-4.0", "by-nd 4.0", "CC BY-ND 4.0"),
    titled("CC-BY-NC-SA-4.0", "by-nc-sa 4.0", "CC BY-NC-SA 4.0"),
    titled("CC-BY-NC-ND-4.0", "by-nc-nd 4.0", "CC BY-NC-ND 4.0"),
    titled("Zlib", "zlib", "the zlib License"),
    titled("BSL-1.0", "boost 1.0", "the Boost Software License, Version 1.0"),
    titled("BUSL-1.1", "business 1.1", "the Business Source License, Version 1.1"),
    titled("Artistic-2.0", "artistic 2.0", "the Artistic License 2.0"),
    titled("WTFPL", "wtfpl", "the WTFPL"),
    titled("PostgreSQL", "postgresql", "the PostgreSQL License"),
    titled("NCSA", "illinois", "the University of Illinois/NCSA Open Source License"),
    titled("MS-PL", "microsoft public", "the Microsoft Public License"),
    titled("MS-RL", "microsoft reciprocal", "the Microsoft Reciprocal License"),
    titled("OFL-1.1", "font 1.1", "the SIL Open Font License, Version 1.1"),
    titled("Python-2.0", "python 2", "the Python Software Foundation License, Version 2"),
    titled("PHP-3.01", "php 3.01", "the PHP License, version 3.01"),
    titled("OSL-3.0", "open software 3.0", "the Open Software License version 3.0"),
    titled("AFL-3.0", "academic 3.0", "the Academic Free License version 3.0"),
    titled("ECL-2.0", "educational 2.0", "the Educational Community License, Version 2.0"),
    titled("UPL-1.0", "universal permissive 1.0", "the Universal Permissive License, Version 1.0"),
    titled("MulanPSL-2.0", "mulan v2", "the Mulan PSL v2"),
    titled("ODbL-1.0", "database 1.0", "the Open Database License v1.0"),
    titled("CPAL-1.0", "attribution 1.0", "the Common Public Attribution License Version 1.0"),
    titled("EFL-2.0", "eiffel 2", "the Eiffel Forum License, version 2"),
    *(
        template(name, name.lower(), f"SPDX-License-Identifier: {name}")
        for name in (
            "Apache-2.0", "MIT", "GPL-3.0", "GPL-2.0", "LGPL-3.0", "LGPL-2.1", "AGPL-3.0", "BSD-3-Clause",
            "MPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC0-1.0", "ISC", "Unlicense",
        )
    ),
    *(
        template(name, own.lower(), f"SPDX-License-Identifier: {own}")
        for name in ("GPL-3.0", "GPL-2.0", "LGPL-3.0", "LGPL-2.1", "AGPL-3.0")
        for own in (f"{name}-only", f"{name}-or-later")
    ),
)

#: What every notice above has at least one of; a block starts before each place of these.
ANCHOR = (
    r"(?i)licen[sc]|released under|permission is hereby|permission to use|redistribution and use|"
    r"rights reserved|unencumbered"
)
ANCHORS = re.compile(ANCHOR)
WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def blocks(text: str, reach: int | None = None) -> Iterator[tuple[int, str]]:
    """(first character, block) around license words; a notice of ``reach`` characters is whole in one of them.

    A block goes on for ``reach`` behind each license word that opens no block of its own.
    """
    reach = longest(TEMPLATES) if reach is None else reach
    before, after = max(BEFORE, reach), max(AFTER, 2 * reach)
    done = -1
    for found in ANCHORS.finditer(text):
        if min(found.end() + reach, len(text)) <= done:
            continue
        start, done = max(0, found.start() - before), min(len(text), found.start() + after)
        yield start, text[start:done]


@lru_cache(maxsize=8)
def _compressors(templates: tuple[Template, ...]):
    plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    primed = []
    for own in templates:
        data = zstandard.ZstdCompressionDict(
            "\n".join(own.notices).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        primed.append(
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False
            )
        )
    return plain, primed


def around(text: str) -> list[str]:
    """The lines of a block that hold a license word, pieces of each width around the words, and all of it."""
    pieces = [p for p in re.split(r"\n+", text) if ANCHORS.search(p)]
    for found in ANCHORS.finditer(text):
        pieces += [text[max(0, found.start() - w) : found.end() + w] for w in WIDTHS]
    return list(dict.fromkeys([*pieces, text]))


def longest(templates: tuple[Template, ...]) -> int:
    """Characters that a notice may take, with some more for changes and spaces."""
    return max((len(notice) * 3 // 2 for own in templates for notice in own.notices), default=0)


def ranked(text: str, templates: tuple[Template, ...] = TEMPLATES) -> list[tuple[float, int]]:
    """(reduction, template) of the templates that shorten a block, best first."""
    plain, primed = _compressors(templates)
    best = [0.0] * len(templates)
    for piece in around(text):
        data = piece.encode("utf-8", "replace")
        size = len(plain.compress(data))
        for k, compressor in enumerate(primed):
            best[k] = max(best[k], 1 - len(compressor.compress(data)) / size)
    order = sorted(range(len(templates)), key=lambda k: (-best[k], k))
    return [(best[k], k) for k in order if best[k] >= LEAST_GAIN]


@dataclass(frozen=True)
class Wording:
    confirmed: bool
    missing: tuple[str, ...]
    added: tuple[str, ...]
    place: tuple[int, int] = field(default=(0, 0), compare=False)  # characters of the notice
    words: int = field(default=0, compare=False)  # of the notice as its publisher words it

    @property
    def rank(self) -> tuple:
        """Better wordings first: confirmed, with few differences, of a long notice."""
        return not self.confirmed, len(self.missing) + len(self.added), -self.words


@lru_cache(maxsize=1024)
def _wanted(own: Template) -> tuple[tuple[tuple[str, ...], frozenset[str]], ...]:
    """The words of each notice, and those among them that must not be missing."""
    found = []
    for notice in own.notices:
        wanted = tuple(words(notice))
        found.append((wanted, frozenset(w for w in wanted if w in own.telling or any(c.isdigit() for c in w))))
    return tuple(found)


@lru_cache(maxsize=8)
def aliens(templates: tuple[Template, ...] | None = None) -> dict[Template, frozenset[str]]:
    """For each template, words that must not come into its notices: they tell others, or deny."""
    found = {}
    for own in templates or TEMPLATES:
        others = (w for t in templates or TEMPLATES if t.name != own.name for w in t.telling)
        found[own] = frozenset({*others, *DENYING} - own.telling)
    return found


def wording(
    text: str, own: Template, alien: frozenset[str] | None = None, only_possible: bool = False
) -> Wording | None:
    """The exact differences between a text and the nearest notice of a template.

    ``only_possible`` leaves out notices whose telling words are not all in the text, which
    cannot be confirmed; None if that leaves none.
    """
    if alien is None:
        alien = aliens()[own]
    spans = [m.span() for m in WORD.finditer(text.lower())]
    found = words(text)
    there, results = set(found), []
    for wanted, telling in _wanted(own):
        if not only_possible or telling <= there:
            results.append(_compared(text, found, spans, wanted, telling, alien))
    return min(results, key=lambda r: r.rank, default=None)


def _denied(text: str, found: list[str], spans: list[tuple[int, int]], first: int) -> bool:
    for k in range(max(0, first - DENYING_BEFORE), first):
        between = text[spans[k][1] : spans[first][0]]
        if found[k] in DENYING and not any(sign in between for sign in "\n.;:!?"):
            return True
    return False


def _compared(
    text: str,
    found: list[str],
    spans: list[tuple[int, int]],
    wanted: tuple[str, ...],
    telling: frozenset[str],
    alien: frozenset[str],
) -> Wording:
    matcher = SequenceMatcher(None, wanted, found, autojunk=False)
    longest = matcher.find_longest_match()
    low = max(0, longest.b - longest.a - len(wanted) // 4)
    part = found[low : longest.b + len(wanted) - longest.a + len(wanted) // 4]
    missing, added = [], []
    codes = SequenceMatcher(None, wanted, part, autojunk=False).get_opcodes()
    for turn, (kind, a, b, c, d) in enumerate(codes):
        if kind in ("delete", "replace"):
            missing += wanted[a:b]
        if kind in ("insert", "replace") and 0 < turn < len(codes) - 1:
            added += part[c:d]
    same = [(c, d) for kind, _, _, c, d in codes if kind == "equal"]
    if not same:
        return Wording(False, tuple(missing), tuple(added), words=len(wanted))
    first, last = low + same[0][0], low + same[-1][1] - 1
    allowed = len(wanted) * MISSING_SHARE
    ok = (
        len(missing) <= allowed and len(added) <= allowed and not _denied(text, found, spans, first)
        and not telling & set(missing) and not (alien - set(wanted)) & set(added)
    )
    place = spans[first][0], spans[last][1]
    return Wording(ok, tuple(missing), tuple(added), place, len(wanted))


def places(text: str, own: Template, alien: frozenset[str]) -> list[Wording]:
    """Every confirmed notice of a template in a block, in order, apart from each other.

    Each license word is looked at with as much around it as a notice may take; what a
    notice before it covers is left out, and so is what begins behind a later one.
    """
    reach, done, found = longest((own,)), 0, []
    for anchor in ANCHORS.finditer(text):
        low, high = max(done, anchor.start() - reach), anchor.end() + reach
        while anchor.start() >= done:
            result = wording(text[low:high], own, alien, only_possible=True)
            if result is None:
                break
            start, end = low + result.place[0], low + result.place[1]
            if not result.confirmed:
                if not low < end <= anchor.start():
                    break
                low = end  # an earlier place, which is no notice, must not hide this one
                continue
            if start > anchor.start():  # a later one; is there another at this word?
                high = start
                continue
            found.append(replace(result, place=(start, end)))
            done = low = end
    return found


FOUND = (
    "doc_id long, license string, start long, gain double, confirmed boolean, "
    "missing array<string>, added array<string>, length int"
)


def notices(text: str, templates: tuple[Template, ...] = TEMPLATES) -> list[tuple]:
    """(license, start, gain, confirmed, missing, added, length) of each notice in a text, in order.

    All templates that shorten a block are checked, and each place that one confirms is a
    notice; of overlapping places, the one with fewer differences and more words.  A block
    that a template shortens but nothing confirms is reported once, from its first
    character on, with its best template, as not confirmed.
    """
    alien = aliens(templates)
    confirmed: list[tuple[Wording, str, float]] = []
    doubtful: list[tuple] = []
    for start, block in blocks(text, longest(templates)):
        best = ranked(block, templates)
        before = len(confirmed)
        for gain, k in best:
            for result in places(block, templates[k], alien[templates[k]]):
                low, high = result.place
                moved = replace(result, place=(start + low, start + high))
                confirmed.append((moved, templates[k].name, gain))
        if best and len(confirmed) == before:
            gain, k = best[0]
            result = wording(block, templates[k], alien[templates[k]])
            doubtful.append((templates[k].name, start, gain, False, result.missing, result.added, len(block)))
    found = list(doubtful)
    for result, name, gain in _apart(confirmed):
        low, high = result.place
        found.append((name, low, gain, True, result.missing, result.added, high - low))
    return sorted(found, key=lambda n: (n[1], not n[3], n[0]))


def _apart(confirmed: list[tuple[Wording, str, float]]) -> list[tuple[Wording, str, float]]:
    """The best notices that do not overlap; blocks overlap, and so may templates."""
    order = sorted(confirmed, key=lambda c: (c[0].rank, c[0].place, c[1]))
    starts: list[int] = []
    kept: list[tuple[Wording, str, float]] = []
    for entry in order:
        low, high = entry[0].place
        at = bisect.bisect_left(starts, low)
        clear = (at == 0 or kept[at - 1][0].place[1] <= low) and (at == len(kept) or high <= starts[at])
        if clear:
            starts.insert(at, low)
            kept.insert(at, entry)
    return kept


def scan_licenses(
    docs: DataFrame,
    templates: tuple[Template, ...] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, license, start, gain, confirmed, missing, added, length``: a row for each notice.

    ``start`` and ``length`` are the notice's characters, or those of the block where none is
    confirmed.  ``gain`` is the template's for the block.  Texts of any length are read
    whole.  Texts without a license word (null and empty ones too) give no rows, repeated
    rows give rows each, an empty table none.  Licenses that say a notice equally well are
    taken in order of place and name.
    """
    ship_package(docs.sparkSession)

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [
            pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.bool_(),
            pa.list_(pa.string()), pa.list_(pa.string()), pa.int32(),
        ]
        names = ["doc_id", "license", "start", "gain", "confirmed", "missing", "added", "length"]
        for batch in batches:
            rows = [
                (key.as_py(), *notice)
                for key, text in zip(batch.column(0), batch.column(1))
                for notice in notices(text.as_py(), templates)
            ]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)], names
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.filter(F.col("text").rlike(ANCHOR)).mapInArrow(scanned, FOUND)
