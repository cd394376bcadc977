import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cardlens.llm import toxicity
from cardlens.llm.tables import ascii_words
from text_tables import docs  # noqa: F401


@pytest.fixture
def labels(spark):
    def make(rows):
        full = [(i, 1, t, "clash") for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, quality int, toxic int, text string")

    return make


def corpus(n, seed):
    rng = random.Random(seed)
    common = ["the", "hand", "ration", "shore", "of", "island", "tion", "wheat", "and", "er", "Ünder"]
    bad = ["zgrumf", "qwerk", "blaxo"]
    rows = []
    for i in range(n):
        toxic = rng.random() < 0.25
        size = rng.choice([5, 30, 200])
        text = [rng.choice(common) + rng.choice(["", "s", "ing"]) for _ in range(size)]
        if toxic:
            for k in range(0, size, 12):
                text[k] = rng.choice(bad)
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def strings(text, n=toxicity.ORDER):
    stream = b" " * (n - 1) + (b" ".join(words) + b" " if (words := ascii_words(text.encode())) else b"")
    return [stream[i : i + n] for i in range(len(stream) - n + 1)]


class Plain:
    """The two models by their definition, from dictionaries."""

    def __init__(self, rows):
        counts = {toxicity.ORDER: [Counter(), Counter()]}
        for text, label in rows:
            counts[toxicity.ORDER][label].update(strings(text))
        for n in range(toxicity.ORDER - 1, 0, -1):
            counts[n] = [Counter(g[1:] for g in counts[n + 1][c]) for c in (0, 1)]
        for n in range(1, toxicity.SHARED + 1):
            both = counts[n][0] + counts[n][1]
            counts[n] = [both, both]
        self.counts = counts
        self.heads = {n: [defaultdict(list) for _ in (0, 1)] for n in counts}
        self.discounts = {}
        for n, pair in counts.items():
            for c in (0, 1):
                for g, k in pair[c].items():
                    self.heads[n][c][g[:-1]].append(k)
                n1, n2 = (sum(v == k for v in pair[c].values()) for k in (1, 2))
                self.discounts[n, c] = max(0.1, n1 / (n1 + 2 * n2)) if n1 else 0.5

    def chance(self, g, c):
        n = len(g)
        below = 1 / 256 if n == 1 else self.chance(g[1:], c)
        head = self.heads[n][c].get(g[:-1])
        if not head:
            return below
        d, total = self.discounts[n, c], sum(head)
        return max(self.counts[n][c][g] - d, 0) / total + d * len(head) / total * below

    def difference(self, text):
        found = strings(text)
        return sum(math.log(self.chance(g, 1) / self.chance(g, 0)) for g in found) / max(1, len(found))


def test_models_follow_their_definition(docs, labels):
    rows = corpus(120, 1)
    model = toxicity.train(docs([r[:2] for r in rows]), labels([(r[0], r[2]) for r in rows]))
    folds = {i: zlib.crc32(str(i).encode()) % 5 for i, _, _ in rows}
    plain = Plain([(t, y) for i, t, y in rows if folds[i] in (1, 2, 3)])
    texts = [t for _, t, _ in rows[:40]] + ["", "  ", "new wörds xyz 123", "zgrumf " * 2000, "漢字", "a"]
    found = model.differences([t.encode() for t in texts])
    assert found == pytest.approx([plain.difference(t) for t in texts], abs=1e-4)


def test_the_last_model_counts_all_learnable_rows(docs, labels):
    rows = corpus(120, 7)
    table, marks = docs([r[:2] for r in rows]), labels([(r[0], r[2]) for r in rows])
    model, _ = toxicity._fitted(table, marks, "doc_id", "text", "toxic")
    plain = Plain([(t, y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 5])
    texts = [t for _, t, _ in rows[:40]] + ["", "new wörds xyz 123", "zgrumf " * 2000]
    found = model.value.differences([t.encode() for t in texts])
    assert found == pytest.approx([plain.difference(t) for t in texts], abs=1e-4)


def test_counts_do_not_depend_on_how_they_are_gathered(docs, labels, monkeypatch):
    rows = corpus(60, 8)
    table, marks = docs([r[:2] for r in rows]), labels([(r[0], r[2]) for r in rows])
    expected = Counter()
    for i, t, y in rows:
        if zlib.crc32(str(i).encode()) % 5:
            own = zlib.crc32(str(i).encode()) % 5 == toxicity.CALIBRATION
            expected.update((int.from_bytes(g, "big"), own, y) for g in strings(t))
    for size in (1, 500, 4 << 20):
        monkeypatch.setattr(toxicity, "CHUNK", size)
        got = Counter()
        for r in toxicity.counted_strings(table, marks).collect():
            got[r.key, r.calibrating, 1] += r.toxic
            got[r.key, r.calibrating, 0] += r.other
        assert +got == expected


def test_held_out_rows(docs, labels):
    rows = corpus(800, 2)
    scored = toxicity.score(docs([r[:2] for r in rows]), labels([(r[0], r[2]) for r in rows])).collect()
    truth = {i: y for i, _, y in rows}
    held = [r for r in scored if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    right = [r for r in held if r.predicted == truth[r.doc_id]]
    assert len(right) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)


def test_held_out_labels_are_not_learnt_from(docs, labels):
    rows = corpus(200, 3)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, _, y in rows]
    table = docs([r[:2] for r in rows])
    a = toxicity.score(table, labels([(r[0], r[2]) for r in rows])).collect()
    b = toxicity.score(table, labels(flipped)).collect()
    assert sorted(a) == sorted(b)


def test_stage_drops_what_is_predicted(docs, labels):
    rows = corpus(300, 4)
    table = docs([*[r[:2] for r in rows], (5000, None), (5001, ""), (None, "zgrumf qwerk blaxo zgrumf")])
    marks = labels([(r[0], r[2]) for r in rows])
    bad = {r.doc_id for r in toxicity.score(table, marks).collect() if r.predicted}
    kept = toxicity.drop_toxic(table, marks)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {*range(300), 5000, 5001, None} - bad
    assert None in bad and not {5000, 5001} & bad


@pytest.mark.parametrize("marks", [[], [(1, None), (2, 7)], [(1, 0), (1, 1), (2, 0)]])
def test_few_labels(docs, labels, marks):
    rows = [(1, "some text"), (2, None), (2, "again"), (None, "x")]
    found = toxicity.score(docs(rows), labels(marks)).collect()
    assert len(found) == 4 and all(0 <= r.score <= 1 for r in found)


def test_no_rows(docs, labels):
    assert toxicity.score(docs([]), labels([(1, 1)])).count() == 0


def test_keys_of_several_texts():
    texts = [b"", b"a b", b"!!", b"Word", b""]
    keys, lengths = toxicity.keys_of(texts)
    expected = [int.from_bytes(g, "big") for t in texts for g in strings(t.decode())]
    assert keys.tolist() == expected
    assert lengths.tolist() == [len(strings(t.decode())) for t in texts]


def test_slots_are_the_same_in_spark(spark):
    keys = np.array([1, 2**31, 123456789, 2**32 - 1], np.uint32)
    rows = spark.createDataFrame(
        [(int(k), 1.0, 2.0, 1) for k in keys], "key long, toxic double, other double, weight long"
    )
    for order in (3, 4):
        table = toxicity._table(rows, order)
        assert np.allclose(table.get(keys), np.log(0.5))
        assert np.isnan(table.get(keys - np.uint32(1))).all()


def test_no_string_is_lost(spark):
    keys = np.random.default_rng(1).choice(2**32, 40000, replace=False).astype(np.uint32)
    rows = spark.createDataFrame(
        [(int(k), 1.0, 2.0, 1) for k in keys], "key long, toxic double, other double, weight long"
    )
    assert np.allclose(toxicity._table(rows, toxicity.ORDER).get(keys), np.log(0.5))
