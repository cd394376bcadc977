"""Counts by the estimated model, against plain Python."""

import random
import re
from collections import Counter
from math import log

import public_tokenizers
import regex

from cardlens.llm import token_counts as T
from cardlens.llm.byte_bpe import read_ranks
from text_tables import by_id, docs  # noqa: F401

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
FIELDS = "n_pieces", "n_tokens", "log_score"


def cut(piece: bytes, scores: dict[bytes, float]) -> tuple[float, list[bytes]]:
    """The best of all cuts: greatest score, then fewest tokens, then shortest last token."""
    best = [(0.0, 0, 0, [])]
    for end in range(1, len(piece) + 1):
        starts = [s for s in range(end) if piece[s:end] in scores]
        options = [
            (best[s][0] + scores[piece[s:end]], best[s][1] - 1, s - end, best[s][3] + [piece[s:end]])
            for s in starts
        ]
        best.append(max(options, key=lambda o: o[:3]))
    return best[-1][0], best[-1][3]


def by_definition(texts: list[str | None]) -> list[tuple[int, int, float]]:
    ranks = read_ranks(PATH)
    zipf = log(sum(1 / (r + 1) for r in ranks.values()))
    first = {t: -log(r + 1) - zipf for t, r in ranks.items()}
    pieces = [[p.encode() for p in regex.findall(PATTERN, t or "")] for t in texts]
    number = Counter(p for row in pieces for p in row)
    used = Counter()
    for piece, n in number.items():
        for token in cut(piece, first)[1]:
            used[token] += n
    total = sum(used.values()) + len(ranks)
    scores = {t: log((used[t] + 1) / total) for t in ranks}
    cuts = {p: cut(p, scores) for p in number}
    return [
        (len(row), sum(len(cuts[p][1]) for p in row), sum(cuts[p][0] for p in row)) for row in pieces
    ]


def some_texts() -> list[str | None]:
    random.seed(7)
    bits = ["the", "ing", " ", " ", "é", "\n", "q", "1", "漢", ",", "tion", "  ", "'s"]
    texts = ["".join(random.choices(bits, k=random.randint(0, 60))) for _ in range(80)]
    return texts + [None, "", " ", "  ", "a ", " a", "the " * 500, "the " * 500, "漢字" * 300]


def assert_as_defined(got, texts):
    for i, expected in enumerate(by_definition(texts)):
        assert got[i][:2] == expected[:2], (i, texts[i])
        assert abs(got[i][2] - expected[2]) < 1e-4


def test_against_the_definition(docs, by_id):
    texts = some_texts()
    got = by_id(T.count_by_corpus(docs(enumerate(texts)), PATH, PATTERN), *FIELDS)
    assert len(got) == len(texts)
    assert_as_defined(got, texts)


def test_without_frequent_stretches_and_with_small_memories(docs, by_id, monkeypatch):
    texts = some_texts()
    rows = docs(enumerate(texts))
    expected = by_id(T.count_by_corpus(rows, PATH, PATTERN), *FIELDS)
    none_frequent = T.frequent_stretches(T.stretch_counts(rows, PATTERN), 20)
    assert none_frequent.count() == 0
    monkeypatch.setattr(T, "frequent_stretches", lambda counts: counts.where("false").select("stretch"))
    assert by_id(T.count_by_corpus(rows, PATH, PATTERN), *FIELDS) == expected


def test_stretches_and_their_bound(docs):
    texts = some_texts()
    counts = T.stretch_counts(docs(enumerate(texts)), PATTERN)
    number = {r.stretch: r.n for r in counts.collect()}
    assert sum(len(s) * n for s, n in number.items()) == sum(len(t or "") for t in texts)
    assert number[" the"] >= 998 and len(number) == counts.count()
    for most in (100, 500, 5000):
        some = [r.stretch for r in T.frequent_stretches(counts, most).collect()]
        assert sum(len(s.encode()) + T.ENTRY_BYTES for s in some) <= most
    assert " the" in some


def test_uses_add_up(docs):
    counts = T.stretch_counts(docs([(1, "the thing"), (2, "the thing"), (3, None)]), PATTERN)
    used = T.token_use(counts, PATH, PATTERN)
    names = {r: t for t, r in read_ranks(PATH).items()}
    assert sum(len(names[r]) * n for r, n in used.items()) == 2 * len("the thing")
    assert set(used.values()) == {2}


def test_the_corpus_decides(docs, by_id):
    """What the corpus has often gets a better score than by rank alone."""
    many = [(i, " zebra") for i in range(500)]
    alone = by_id(T.count_tokens(docs(many[:1]), PATH, PATTERN), *FIELDS)[0]
    among = by_id(T.count_by_corpus(docs(many), PATH, PATTERN), *FIELDS)[0]
    assert among[2] > alone[2]


def test_empty_nulls_ties_and_repeated_rows(docs):
    assert T.count_by_corpus(docs([]), PATH, PATTERN).count() == 0
    nothing = T.count_by_corpus(docs([(None, None), (2, ""), (2, "")]), PATH, PATTERN).collect()
    assert [tuple(r)[1:] for r in nothing] == [(0, 0, 0.0)] * 3
    rows = T.count_by_corpus(docs([(None, "a b"), (1, "a b"), (1, "a b")]), PATH, PATTERN).collect()
    assert len(rows) == 3 and len({tuple(r)[1:] for r in rows}) == 1


def test_cuts_of_equal_score():
    """Of equal scores fewer tokens count, then the shorter last token."""
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257}
    unigram = T.UnigramCounter(ranks, PATTERN, {})
    unigram.scores = {t: -1.0 for t in ranks} | {b"ab": -2.0, b"bc": -2.0}
    used = Counter()
    assert unigram.count([b"abc"], [3], used) == [(2, -3.0)]
    assert used == {256: 3, ord("c"): 3}


def test_a_text_of_many_different_words(docs, by_id):
    text = " ".join(f"w{i}x" for i in range(200_000))
    got = by_id(T.count_by_corpus(docs([(1, text), (2, "w1x")]), PATH, PATTERN), *FIELDS)
    assert got[1][0] >= 200_000 and got[1][1] >= got[1][0] and got[2][1] <= got[1][1]
    assert re.fullmatch(r"-\d+\.\d+", f"{got[1][2]:.6f}")
