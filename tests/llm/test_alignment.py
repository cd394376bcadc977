import random
from collections import Counter
from hashlib import sha256

import public_tokenizers
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from cardlens.llm import alignment
from cardlens.llm.catalog import BYTE_LEVEL, PIECES, QUERIES
from cardlens.llm.stretches import byte_values
from text_tables import by_id, docs  # noqa: F401

COLUMNS = (
    "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum",
)


def tokens(text):
    """Ids and bytes of both sides, straight from the libraries."""
    model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    pieces = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    if not text:
        return [], []
    value = byte_values()
    names = {i: t for t, i in model.get_vocab().items()}
    a = [(i, bytes(value[c] for c in names[i])) for i in model.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in pieces.encode(text):
        piece = pieces.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
        return [], []
    return a, b


def ranges(row):
    made, end = [], 0
    for _, token in row:
        made.append((end, end + len(token)))
        end += len(token)
    return made


def brute(rows):
    """Every pair of ranges is looked at."""
    found, held = {}, Counter()
    for key, text in rows:
        a, b = tokens(text)
        ra, rb = ranges(a), ranges(b)
        links = [
            (a[i][0], b[j][0])
            for i, (s, e) in enumerate(ra)
            for j, (t, f) in enumerate(rb)
            if s < f and t < e
        ]
        cuts = sorted({e for _, e in ra} & {e for _, e in rb})
        groups, begin = [], 0
        for cut in cuts:
            sides = [
                ",".join(str(row[k][0]) for k, (s, _) in enumerate(rs) if begin <= s < cut)
                for row, rs in ((a, ra), (b, rb))
            ]
            groups.append("|".join(sides))
            begin = cut
        held.update(set(links))
        found[key] = (len(a), len(b), groups, links)
    top = {}
    for (a, _), n in held.items():
        top[a] = max(top.get(a, 0), n)
    return {
        key: (
            n_a,
            n_b,
            len(groups),
            len(links),
            sha256(";".join(groups).encode()).hexdigest() if groups else "",
            sum(held[link] == top[link[0]] for link in links),
            sum(held[link] for link in links),
        )
        for key, (n_a, n_b, groups, links) in found.items()
    }


def values(column):
    return column.to_pylist() if hasattr(column, "to_pylist") else list(column)


def test_stretches_give_the_ids_of_whole_texts():
    work = alignment.aligner(BYTE_LEVEL, PIECES)
    texts = [t for _, t in sample(400, seed=11)] + [" ", "x ", "  x", " x", "a\n b", "\t", "x  y ", "  "]
    for text, a, b in zip(texts, *work.rows(texts)):
        assert a.tolist() == work.a.model.encode(" " + text, add_special_tokens=False).ids
        assert b.tolist() == work.b.model.encode(text)


def sample(n, seed=7):
    random.seed(seed)
    parts = ["the", " ", "  ", "éa", "\n", "Zusammen", "<|endoftext|>", "<0x41>", "漢字", "🙂", "x1", "\t", ".", "tion"]
    return [(i, "".join(random.choices(parts, k=random.randint(1, 40)))) for i in range(n)]


def test_against_all_pairs(docs, by_id):
    rows = sample(60) + [(60, None), (61, ""), (62, "a▁b"), (63, " "), (64, "same"), (65, "same")]
    got = by_id(alignment.align_and_weigh(docs(rows), BYTE_LEVEL, PIECES), *COLUMNS)
    expected = brute(rows)
    assert got == expected
    assert got[60] == got[61] == got[62] == (0, 0, 0, 0, "", 0, 0)


def test_lanes_and_batches_do_not_matter(docs, by_id, monkeypatch):
    rows = sample(8, seed=3)
    rows.append((8, " ".join(t for _, t in sample(300, seed=4))))
    work = alignment.aligner(BYTE_LEVEL, PIECES)
    whole = work.align([t for _, t in rows], True)
    one = [work.align([t], True) for _, t in rows]
    monkeypatch.setattr(alignment, "LANE", 3)
    cut = work.align([t for _, t in rows], True)
    for name in whole:
        assert values(whole[name]) == values(cut[name])
        assert values(whole[name]) == [v for made in one for v in values(made[name])]


def test_groups_spell_the_text(docs):
    rows = sample(20, seed=9)
    work = alignment.aligner(BYTE_LEVEL, PIECES)
    found = alignment.align(docs(rows), BYTE_LEVEL, PIECES, with_tokens=True).collect()
    texts = dict(rows)
    assert len(found) == 20 and len({r.row for r in found}) == 20
    for r in found:
        spelt, i, j = b"", 0, 0
        for stop_a, stop_b in zip(r.a_ends, r.b_ends):
            side = b"".join(work.a.tokens[t] for t in r.a_ids[i:stop_a])
            assert side == b"".join(work.b.tokens[t] for t in r.b_ids[j:stop_b])
            spelt, i, j = spelt + side, stop_a, stop_b
        assert spelt == (" " + texts[r["id"]]).encode() and len(r.a_ends) == r.n_groups


def test_frequent_pairs_and_shuffled_lookups(docs, by_id, no_broadcast):
    rows = [(i, "the same words again and again") for i in range(300)] + sample(40)
    got = by_id(alignment.align_and_weigh(docs(rows[:300] + [(1000 + i, t) for i, t in rows[300:]], 9), BYTE_LEVEL, PIECES), *COLUMNS)
    expected = brute(rows[:1] + [(1000 + i, t) for i, t in rows[300:]])
    assert {k: v[:5] for k, v in got.items() if k >= 1000} == {
        k: v[:5] for k, v in expected.items() if k >= 1000
    }
    alike = {got[i] for i in range(300)}
    assert len(alike) == 1 and alike.pop()[6] >= 300 * expected[0][3]


def test_no_rows_repeated_rows_and_missing_ids(docs):
    assert alignment.align_and_weigh(docs([]), BYTE_LEVEL, PIECES).count() == 0
    rows = [(1, "a b"), (1, "a b"), (None, "a b"), (2, None)]
    found = alignment.align_and_weigh(docs(rows), BYTE_LEVEL, PIECES).collect()
    assert len(found) == 4 and sum(r.count_sum == 3 * r.n_links > 0 for r in found) == 3


def test_query_against_all_pairs(spark, by_id):
    folder = "/root/testdata/sf0.001"
    some = spark.read.parquet(f"{folder}/documents.parquet").collect()
    rows = [(r.doc_id, r.text) for r in some]
    got = by_id(QUERIES["op11_token_alignment"](spark, folder), *COLUMNS)
    short = [(k, t) for k, t in rows if len(t or "") < 1500]
    for key, values in brute(short).items():
        assert got[key][:5] == values[:5]
    work = alignment.aligner(BYTE_LEVEL, PIECES)
    held, owned = Counter(), {}
    for key, text in rows:
        made = work.align([text or ""], False)
        owned[key] = dict(zip(made["pairs"].to_pylist()[0], made["times"].to_pylist()[0]))
        held.update(owned[key].keys())
    top = {}
    for pair, n in held.items():
        top[pair >> 31] = max(top.get(pair >> 31, 0), n)
    for key, pairs in owned.items():
        best = sum(k for pair, k in pairs.items() if held[pair] == top[pair >> 31])
        assert got[key][5:] == (best, sum(held[pair] * k for pair, k in pairs.items()))
