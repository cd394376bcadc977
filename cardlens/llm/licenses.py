"""Licence notices and identifier tags of whole texts.

An Aho-Corasick automaton over space-joined words finds notice phrases and tags. Behind a tag
and behind "licensed under", a licence expression is read from the raw line and evaluated by the
shunting-yard method. Identifiers are known by their stem; one that is not, but has a version, is
an operand of its own with the strictest restriction. A word of neither kind is prose.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame

from cardlens.llm.tables import ascii_words, map_texts

#: Phrases that count as places, with their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: Notices of common licences, as lower-case words, with their labels.
NOTICES = {
    "permission is hereby granted free of charge to any person": "mit",
    "licensed under the apache license version 2 0": "apache",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "isc license": "isc",
    "creative commons attribution": "cc-by",
    "released into the public domain": "public-domain",
    "all rights reserved": "proprietary",
}

#: Words of an identifier tag, and of a notice that names an identifier.
TAG, UNDER = "spdx license identifier", "licensed under"

#: Label and restriction of an operand that has an identifier's form, but no known stem.
UNKNOWN = ("unknown", 3)

#: Label and restriction (0 free to 3 strongly reciprocal, or use limited) by the
#: stem of identifiers in the public SPDX list, versions and suffixes left off.
IDENTIFIERS = {
    "0bsd": ("bsd", 0),
    "agpl": ("agpl", 3),
    "apache": ("apache", 1),
    "bsd": ("bsd", 1),
    "bsl": ("bsl", 1),
    "cc0": ("public-domain", 0),
    "cc-by": ("cc-by", 1),
    "epl": ("epl", 2),
    "gpl": ("gpl", 3),
    "isc": ("isc", 1),
    "lgpl": ("lgpl", 2),
    "mit": ("mit", 1),
    "mpl": ("mpl", 2),
    "unlicense": ("public-domain", 0),
    "afl": ("afl", 1),
    "apsl": ("apsl", 2),
    "artistic": ("artistic", 2),
    "blueoak": ("blueoak", 1),
    "busl": ("busl", 3),
    "cc-by-nc": ("cc-by-nc", 3),
    "cc-by-nc-nd": ("cc-by-nc-nd", 3),
    "cc-by-nc-sa": ("cc-by-nc-sa", 3),
    "cc-by-nd": ("cc-by-nd", 3),
    "cc-by-sa": ("cc-by-sa", 2),
    "cddl": ("cddl", 2),
    "cpl": ("cpl", 2),
    "ecl": ("ecl", 1),
    "elastic": ("elastic", 3),
    "eupl": ("eupl", 3),
    "ftl": ("ftl", 1),
    "gfdl": ("gfdl", 3),
    "hpnd": ("hpnd", 1),
    "ijg": ("ijg", 1),
    "ipl": ("ipl", 2),
    "libpng": ("libpng", 1),
    "licenseref": ("custom", 3),
    "lppl": ("lppl", 1),
    "ms-pl": ("ms-pl", 1),
    "ms-rl": ("ms-rl", 2),
    "mulanpsl": ("mulanpsl", 1),
    "ncsa": ("ncsa", 1),
    "npl": ("npl", 2),
    "odbl": ("odbl", 2),
    "odc-by": ("odc-by", 1),
    "ofl": ("ofl", 1),
    "openssl": ("openssl", 1),
    "osl": ("osl", 3),
    "pddl": ("public-domain", 0),
    "php": ("php", 1),
    "postgresql": ("postgresql", 1),
    "psf": ("psf", 1),
    "python": ("psf", 1),
    "qpl": ("qpl", 2),
    "ruby": ("ruby", 1),
    "sleepycat": ("sleepycat", 3),
    "sspl": ("sspl", 3),
    "tcl": ("tcl", 1),
    "unicode": ("unicode", 1),
    "upl": ("upl", 1),
    "vim": ("vim", 1),
    "w3c": ("w3c", 1),
    "wtfpl": ("wtfpl", 0),
    "x11": ("x11", 1),
    "zlib": ("zlib", 1),
    "zpl": ("zpl", 1),
}

#: How sure a find is: tag, notice, base phrase.
WEIGHTS = {"tag": 0.95, "notice": 0.8, "base": 0.6}

_BINDING = {"or": 1, "and": 2, "with": 3}
_PARTS = re.compile(r"[()]|[a-z0-9][a-z0-9.+-]*")
_TAG_TEXT = re.compile(r"spdx[- ]+license[- ]+identifier[ \t]*:?[ \t]*([^\r\n]*)")
_UNDER_TEXT = re.compile(r"licensed[ \t]+under[ \t]+(?:the[ \t]+)?(?:terms[ \t]+of[ \t]+(?:the[ \t]+)?)?([^\r\n]*)")
#: What only an identifier looks like: a name and a version.
_VERSIONED = re.compile(r"[a-z][a-z0-9.]*(?:-[a-z0-9.]+)*-[0-9][0-9.]*(?:-only|-or-later)?\+?")
#: The name of a licence family in prose, with its conditions and version apart.
_SPACED = re.compile(r"\bcc[ -]by((?:[ -](?:nc|nd|sa))*)(?:[ -]([0-9.]+[0-9]))?")


def identified(word: str) -> tuple[str, int] | None:
    """Label and restriction of a licence identifier such as ``gpl-2.0-or-later``."""
    stem = word.rstrip("+")
    while stem:
        if stem in IDENTIFIERS:
            return IDENTIFIERS[stem]
        stem = stem.rpartition("-")[0]
    return UNKNOWN if _VERSIONED.fullmatch(word) else None


def _joined(prose: str) -> str:
    """``cc by-nc 4.0`` as the identifier ``cc-by-nc-4.0``."""
    return _SPACED.sub(
        lambda m: "cc-by" + m[1].replace(" ", "-") + (f"-{m[2]}" if m[2] else ""), prose
    )


def evaluate(expression: str) -> tuple[frozenset[str], int] | None:
    """Labels and restriction of a lower-case licence expression, or None without one.

    ``and`` asks for both licences, so the stricter counts; ``or`` leaves the choice, so the
    milder counts; ``with`` names an exception, which lowers the restriction by one. Words that
    cannot go on with the expression end it: the longest complete expression counts.
    """
    values: list[tuple[frozenset[str], int]] = []
    waiting: list[str] = []
    best = None
    operand_next = True
    depth = 0

    def apply(operator: str, stack: list) -> None:
        labels, level = stack.pop()
        if operator == "with":
            stack.append((labels, max(0, level - 1)))
            return
        others, other = stack.pop()
        stack.append((labels | others, max(level, other) if operator == "and" else min(level, other)))

    def whole() -> tuple[frozenset[str], int]:
        stack = list(values)
        for operator in reversed(waiting):
            apply(operator, stack)
        return stack[0]

    for part in _PARTS.findall(expression):
        if part == "(":
            if not operand_next or waiting[-1:] == ["with"]:
                break
            waiting.append(part)
            depth += 1
        elif part == ")":
            if operand_next or not depth:
                break
            while waiting[-1] != "(":
                apply(waiting.pop(), values)
            waiting.pop()
            depth -= 1
        elif part in _BINDING:
            if operand_next:
                break
            while waiting and waiting[-1] != "(" and _BINDING[waiting[-1]] >= _BINDING[part]:
                apply(waiting.pop(), values)
            waiting.append(part)
            operand_next = True
            continue
        else:
            if not operand_next:
                break
            if waiting[-1:] == ["with"]:
                operand_next = False  # any exception's name will do
            else:
                known = identified(part)
                if known is None:
                    break
                values.append((frozenset([known[0]]), known[1]))
                operand_next = False
        if not operand_next and not depth:
            best = whole()
    return best


@lru_cache(maxsize=4)
def _finder(phrases: tuple[tuple[str, str], ...]) -> ahocorasick.Automaton:
    """Automaton over words, each phrase with a space at both ends."""
    automaton = ahocorasick.Automaton()
    kinds: dict[str, list[tuple[str, str]]] = {}
    for phrase, label in phrases:
        kinds.setdefault(phrase, []).append(("base", label))
    for phrase, label in NOTICES.items():
        kinds.setdefault(phrase, []).append(("notice", label))
    kinds.setdefault(TAG, []).append(("tag", ""))
    kinds.setdefault(UNDER, []).append(("under", ""))
    for phrase, found in kinds.items():
        automaton.add_word(f" {phrase} ", (len(phrase) + 1, tuple(found)))
    automaton.make_automaton()
    return automaton


def scan(text: bytes, phrases: tuple[tuple[str, str], ...]) -> dict[str, object]:
    """All that :func:`scan_licenses` returns for one text."""
    words = ascii_words(text)
    joined = (b" " + b" ".join(words) + b" ").decode("latin-1")
    base: set[str] = set()
    finds: set[tuple[str, str]] = set()
    starts: list[int] = []
    seen = at = 0
    tagged = under = False
    for end, (reach, found) in _finder(phrases).iter(joined):
        for kind, label in found:
            if kind == "tag":
                tagged = True
                continue
            if kind == "under":
                under = True
                continue
            finds.add((kind, label))
            if kind == "base":
                base.add(label)
                start = end - reach
                # a longer phrase that ends in the same place may start before the last
                seen += joined.count(" ", at, start) if start >= at else -joined.count(" ", start, at)
                at = start
                starts.append(seen)
    levels: list[int] = []
    if tagged or under:
        lowered = text.lower().decode("utf-8", "replace")
        for kind, wanted, lines in (("tag", tagged, _TAG_TEXT), ("notice", under, _UNDER_TEXT)):
            for line in lines.findall(lowered) if wanted else ():
                value = evaluate(_joined(line))
                if value is not None:
                    finds.update((kind, label) for label in value[0])
                    levels.append(value[1])
    doubt = 1.0
    for kind, _ in sorted(finds):
        doubt *= 1 - WEIGHTS[kind]
    return {
        "n_words": len(words),
        "n_base": len(starts),
        "first_word": min(starts, default=None),
        "last_word": max(starts, default=None),
        "base_labels": sorted(base),
        "labels": sorted({label for _, label in finds}),
        "restriction": max(levels, default=None),
        "score": round(1 - doubt, 6) if finds else 0.0,
    }


def scan_licenses(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: dict[str, str] = BASE_PHRASES,
) -> DataFrame:
    """Per row: words, base places with the first and the last word they start at (from 0),
    sorted arrays of labels, the strictest restriction of the tags, and a score from 0 to 1.

    ``phrases`` maps lower-case, space-joined words to labels; a place is where these words
    stand one after the other. Overlapping places all count. Texts without a find, null and
    empty ones among them, have empty label arrays, null places and score 0.
    """
    fixed = tuple(sorted(phrases.items()))
    fields = (
        "n_words long, n_base long, first_word long, last_word long, "
        "base_labels array<string>, labels array<string>, restriction int, score double"
    )

    def start():
        def work(texts: list[bytes]) -> dict[str, list]:
            rows = [scan(text, fixed) for text in texts]
            return {name: [row[name] for row in rows] for name in rows[0]} if rows else {}

        return work

    return map_texts(df, id_col, text_col, start, fields)
