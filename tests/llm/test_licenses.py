"""License notices against a plain search for their wordings."""

import re
from collections import defaultdict

import pytest
from corpus_tables import MEDIUM, awkward, empty, rows

from martflow.llm.licenses import DENYING, TEMPLATES, WORD, notices, ranked, scan_licenses, words, wording


def plain_notices(text: str) -> set:
    """(license, first character, characters) of each notice that stands in the text word for word.

    A notice within a longer one, and one that a word just before it denies, is none.
    """
    lower = (text or "").lower()
    own = [m.group() for m in WORD.finditer(lower)]
    spans = [m.span() for m in WORD.finditer(lower)]
    at = defaultdict(list)
    for k, w in enumerate(own):
        at[w].append(k)
    found = {}
    for t in TEMPLATES:
        for notice in t.notices:
            wanted = words(notice)
            for k in at[wanted[0]]:
                sentence = re.split(r"[\n.;:!?]", lower[: spans[k][0]])[-1]
                denied = DENYING & set([m.group() for m in WORD.finditer(sentence)][-2:])
                if own[k : k + len(wanted)] == wanted and not denied:
                    found[k, k + len(wanted)] = t.name
    return {
        (name, spans[a][0], spans[b - 1][1] - spans[a][0])
        for (a, b), name in found.items()
        if not any((c, d) != (a, b) and c <= a and b <= d for c, d in found)
    }


def test_all_notices_of_all_documents(spark):
    """Word-for-word notices are those of brute force, by license and place; there are no others here."""
    texts = dict(rows(MEDIUM, "SELECT doc_id, text FROM documents"))
    wanted = {(k, *notice) for k, t in texts.items() for notice in plain_notices(t)}
    found = scan_licenses(spark.read.parquet(f"{MEDIUM}/documents.parquet")).filter("confirmed").collect()
    assert len(wanted) > 20
    exact = {(r["doc_id"], r["license"], r["start"], r["length"]) for r in found if not r["missing"] + r["added"]}
    assert exact == wanted
    changed = [r for r in found if r["missing"] + r["added"]]
    for r in changed:  # a copy with a word changed; the texts have no other licenses
        near = {t.name for t in TEMPLATES if t.telling <= set(words(texts[r["doc_id"]]))}
        assert r["license"] in near


@pytest.mark.parametrize("own", TEMPLATES, ids=lambda t: t.name)
def test_each_template_is_its_own_best(own):
    for notice in own.notices:
        text = f"Some words before. And more of them.\n{notice}\nSome words after it."
        named = [n[0] for n in notices(text) if n[3]]
        assert own.name in named
        assert TEMPLATES[ranked(notice)[0][1]].name == own.name


def test_other_versions_and_names_are_not_confirmed():
    for text in (
        "Licensed under the Apache License, Version 1.1.",
        "This work is licensed under the GNU General Public License, version 9.",
        "Licensed under CC BY-NC 3.0.",
        "We talked about the license of the car.",
    ):
        assert not [n for n in notices(text) if n[3]]


def test_small_changes_of_wording_are_named():
    text = "this work is hereby licensed under the GNU General Public License version 3"
    gpl = next(t for t in TEMPLATES if t.name == "GPL-3.0")
    assert wording(text, gpl) == type(wording(text, gpl))(True, (), ("hereby",))


def test_notices_far_apart_in_a_long_text():
    text = "x y z\n" * 50_000 + "Released under the MIT License.\n" + "a b c\n" * 50_000 + "Licensed under CC BY 4.0."
    assert [n[0] for n in notices(text) if n[3]] == ["MIT", "CC-BY-4.0"]


def test_awkward_rows(spark):
    assert scan_licenses(awkward(spark)).count() == 0
    assert scan_licenses(empty(spark)).count() == 0
    twice = spark.createDataFrame([(None, "Released under the MIT License.")] * 2, "doc_id long, text string")
    assert scan_licenses(twice).filter("confirmed").count() == 2


PROSE = "The river ran past the old mill while people of the town spoke about weather and bread. " * 12
NOTICES = [(own.name, notice) for own in TEMPLATES for notice in own.notices]


@pytest.mark.parametrize("before", [0, 150, 300, 1000])
def test_notices_inside_a_long_line(before):
    lost = []
    for name, notice in NOTICES:
        text = f"{PROSE[:before]} {notice} {PROSE + PROSE}"[:2000]
        if name not in [n[0] for n in notices(text) if n[3]]:
            lost.append(notice)
    assert not lost


def test_every_license_of_a_list_is_found():
    for k, (name, notice) in enumerate(NOTICES):
        # Every notice meets a third of the others, before and behind it.
        for other, second in NOTICES[k % 3 :: 3]:
            found = [n[0] for n in notices(f"{notice}\n{second}") if n[3]]
            assert found == [name, other], (notice, second)
    listed = notices("\n".join(notice for _, notice in NOTICES))
    assert {n[0] for n in listed if n[3]} == {own.name for own in TEMPLATES}


@pytest.mark.parametrize("name, notice", NOTICES)
def test_notices_at_the_border_of_a_block(name, notice):
    for at in range(1000, 1250, 10):
        text = "The license of the car. ".ljust(24) + (PROSE * 2)[: at - 24] + "\n" + notice + "\n" + PROSE
        assert [n[0] for n in notices(text) if n[3]].count(name) == 1, at


def test_a_second_notice_in_an_overlapping_block():
    mit = "Released under the MIT License."
    text = f"The license of the car. {PROSE[:1000]}\n{mit}\n{PROSE[:800]}\n{mit}\n"
    assert [n[0] for n in notices(text) if n[3]] == ["MIT", "MIT"]


def confirmed(text):
    return [(n[0], text[n[1] : n[1] + n[6]]) for n in notices(text) if n[3]]


@pytest.mark.parametrize("text, wanted", [
    ("Licensed under the GNU Lesser General Public License v3.0.", ["LGPL-3.0"]),
    ("This work is licensed under the GNU Affero General Public License, version 3.", ["AGPL-3.0"]),
    (
        "the terms of the GNU Lesser General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.", ["LGPL-3.0"],
    ),
    ("This work is not licensed under the MIT License.", []),
    ("No longer released under the MIT License. Released under the MIT License.", ["MIT"]),
    ("Licensed under the BSD 2-Clause License.", ["BSD-2-Clause"]),
    ("// SPDX-License-Identifier: Apache-2.0", ["Apache-2.0"]),
    ("# SPDX-License-Identifier: GPL-3.0-or-later\n# SPDX-License-Identifier: MIT", ["GPL-3.0", "MIT"]),
    ("SPDX-License-Identifier: LicenseRef-Own", []),
    ("Licensed under CC BY-NC-SA 4.0.", ["CC-BY-NC-SA-4.0"]),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", ["CC-BY-NC-4.0"]),
])
def test_one_license_and_no_other(text, wanted):
    assert [name for name, _ in confirmed(text)] == wanted


def test_every_notice_is_a_row():
    lines = ["Licensed under the MIT License."] * 3 + ["Licensed under CC BY 4.0.", "Licensed under the MIT License."]
    text = "\n".join(lines)
    assert confirmed(text) == [("CC-BY-4.0" if "CC" in x else "MIT", x[:-1]) for x in lines]
    assert len(confirmed(" ".join(lines * 40))) == 200


def test_there_are_forty_licenses_and_more():
    assert len({own.name for own in TEMPLATES}) >= 40
