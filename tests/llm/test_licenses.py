import random
import re

import pytest

from cardlens.llm.licenses import BASE_PHRASES, evaluate, scan_licenses
from text_tables import by_id, docs  # noqa: F401

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    words = WORD.findall((text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in BASE_PHRASES.items():
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), sorted(labels)


def test_base_places_against_brute_force(docs, by_id):
    rng = random.Random(3)
    parts = ["MIT", "License", "license", "apache", "GENERAL", "public", "gnu", "lesser", "é", "émit", "mİt",
             "2", "licensed under the apache license, version 2.0"]
    gaps = [" ", "-", "\n", ", ", "'s ", "\x00", "  "]
    rows = [
        (i, "".join(rng.choice(parts) + rng.choice(gaps) for _ in range(rng.randint(0, 30))))
        for i in range(300)
    ]
    rows += [(900, None), (901, ""), (902, "mit license " * 20000), (None, "The MIT License.")]
    found = by_id(scan_licenses(docs(rows)), "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert found == {i: plain(t) for i, t in rows}


def test_tags_and_notices(docs, by_id):
    rows = [
        (1, "// SPDX-License-Identifier: MIT OR (GPL-2.0-only AND BSD-3-Clause)\nint x;"),
        (2, "# SPDX-License-Identifier: GPL-2.0-or-later WITH Classpath-exception-2.0 */"),
        (3, "spdx-license-identifier: unheard-of"),
        (4, "Permission is hereby granted, free of charge, to any person"),
        (5, "nothing"),
        (6, "under the Apache License and SPDX-License-Identifier: Apache-2.0"),
    ]
    found = by_id(scan_licenses(docs(rows)), "labels", "restriction", "score")
    assert found[1] == (["bsd", "gpl", "mit"], 1, round(1 - 0.05**3, 6))
    assert found[2] == (["gpl"], 2, 0.95)
    assert found[3] == found[5] == ([], None, 0.0)
    assert found[4] == (["mit"], None, 0.8)
    assert found[6] == (["apache"], 1, 0.98)


@pytest.mark.parametrize(
    "text, labels, level",
    [
        ("Licensed under CC BY-NC 4.0", ["cc-by-nc"], 3),
        ("licensed under the terms of the MIT license.", ["mit"], 1),
        ("Licensed under CC BY 4.0 or CC-BY-SA 3.0", ["cc-by", "cc-by-sa"], 1),
        ("SPDX License Identifier: MIT", ["mit"], 1),
        ("SPDX-License-Identifier: Zlib OR MIT", ["mit", "zlib"], 1),
        ("licensed under a tree", [], None),
    ],
)
def test_expressions_in_texts(docs, by_id, text, labels, level):
    found = by_id(scan_licenses(docs([(1, text)])), "labels", "restriction")
    assert found[1] == (labels, level)


@pytest.mark.parametrize(
    "text, labels, level",
    [
        ("mit", {"mit"}, 1),
        ("mit and gpl-3.0", {"mit", "gpl"}, 3),
        ("mit or gpl-3.0 and lgpl-2.1", {"mit", "gpl", "lgpl"}, 1),
        ("(mit or gpl-3.0) and lgpl-2.1+", {"mit", "gpl", "lgpl"}, 2),
        ("gpl-2.0 with x-exception or agpl-3.0", {"gpl", "agpl"}, 2),
        ("apache-2.0 and prose goes on", {"apache"}, 1),
        ("mit)", {"mit"}, 1),
        ("((mit", None, None),
        ("and mit", None, None),
        ("mit mit", {"mit"}, 1),
        ("(mit) or", {"mit"}, 1),
        ("", None, None),
        ("zlib or mit", {"zlib", "mit"}, 1),
        ("licenseref-x and mit", {"custom", "mit"}, 3),
        ("mit and zlib", {"mit", "zlib"}, 1),
        ("cc-by-nc-nd-4.0", {"cc-by-nc-nd"}, 3),
        ("cc-by-4.0", {"cc-by"}, 1),
        ("foo-1.0 or mit", {"unknown", "mit"}, 1),
        ("mit and foo-bar-2.1-or-later", {"mit", "unknown"}, 3),
    ],
)
def test_expressions(text, labels, level):
    assert evaluate(text) == (None if labels is None else (frozenset(labels), level))


def test_no_rows_and_repeated_rows(docs):
    assert scan_licenses(docs([])).count() == 0
    assert scan_licenses(docs([(1, "mit license"), (1, "mit license")])).count() == 2
