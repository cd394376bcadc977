import random
from collections import Counter

import public_tokenizers

from cardlens.llm import token_counts
from cardlens.llm.token_counts import TOGETHER_BYTES, UnigramCounter, count_tokens, counter
from text_tables import by_id, docs  # noqa: F401

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def brute(unigram, piece: bytes):
    """Best score and fewest tokens over all cuts."""
    best = [(0.0, 0)]
    for end in range(1, len(piece) + 1):
        best.append(
            max(
                (best[s][0] + unigram.scores[piece[s:end]], best[s][1] - 1)
                for s in range(end)
                if piece[s:end] in unigram.scores
            )
        )
    return best[-1][0], -best[-1][1]


def test_against_all_cuts(docs, by_id):
    random.seed(5)
    letters = ["the", "ing", " ", "é", "\n", "q", "1", "漢", ",", "tion"]
    texts = [(i, "".join(random.choices(letters, k=random.randint(0, 80)))) for i in range(60)]
    texts += [(60, None), (61, ""), (62, "ab" * 3000)]
    got = by_id(count_tokens(docs(texts), PATH, PATTERN), "n_pieces", "n_tokens", "log_score")
    unigram = counter(PATH, PATTERN)
    for i, text in texts:
        pieces = unigram.stretches.pieces(text or "")
        cuts = [brute(unigram, p.encode()) for p in pieces]
        assert got[i][:2] == (len(pieces), sum(n for _, n in cuts))
        assert abs(got[i][2] - sum(s for s, _ in cuts)) < 1e-5


def test_shared_prefixes_do_not_matter():
    unigram = counter(PATH, PATTERN)
    words = sorted({b"the", b"there", b"therein", b"thermal", b"a", b"an", b"zebra"})
    assert unigram.count(words) == [unigram.count([w])[0] for w in words]


def test_no_rows_and_repeated_rows(docs):
    assert count_tokens(docs([]), PATH, PATTERN).count() == 0
    rows = count_tokens(docs([(1, "a b"), (1, "a b")]), PATH, PATTERN).collect()
    assert len(rows) == 2 and rows[0] == rows[1]


def test_pieces_cut_together_as_one_by_one():
    """Whole arrays of pieces at a time, with the same tokens, scores and uses."""
    random.seed(11)
    bits = ["the", "ing", "é", "q", "1", "漢", ",", "tion", " ", "\x00", "ab", "\u3000"]
    pieces = {"".join(random.choices(bits, k=random.randint(1, 14))) for _ in range(3000)} | {"ab" * 300}
    pieces = sorted(p.encode() for p in pieces)
    weights = [random.randint(1, 9) for _ in pieces]
    unigram = counter(PATH, PATTERN)
    short = [i for i, p in enumerate(pieces) if len(p) <= TOGETHER_BYTES]
    assert 0 < len(short) < len(pieces)
    together, alone = Counter(), Counter()
    expected = unigram._one_by_one(pieces, weights, alone)
    assert unigram.count(pieces, weights, together) == expected and together == alone
    some = [pieces[i] for i in short]
    assert list(unigram._by_depth(some, (), None)) == [expected[i] for i in short]


def test_small_memories_and_repeats(monkeypatch):
    texts = [" ".join(f"w{i % 97}x,{i}" for i in range(k, k + 60)) for k in range(0, 600, 7)] + ["", " a", "  b  c"]
    expected = counter(PATH, PATTERN).texts(texts)
    monkeypatch.setattr(token_counts, "MOST_KEPT", 50)
    small = UnigramCounter(counter(PATH, PATTERN).ranks, PATTERN, None, {" zzz": (1, 1, 0.5)})
    assert [small.texts([t])[0] for t in texts] == expected == small.texts(texts)
    assert len(small.known) <= 51 and small.texts(["a zzz"])[0][2] == small.texts(["a"])[0][2] + 0.5
