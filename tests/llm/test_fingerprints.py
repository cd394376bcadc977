from hashlib import sha256

import numpy as np
import pytest

from cardlens.llm.fingerprints import Sampler, edited_text, fingerprint_edits, likeness, terms
from text_tables import by_id, docs  # noqa: F401


def similarity(a, b):
    """Generalised Jaccard similarity of weighted terms."""
    words = set(a) | set(b)
    return sum(min(a[w], b[w]) for w in words) / sum(max(a[w], b[w]) for w in words)


def plain(text, samples):
    """Each sample by its definition, one word at a time."""
    sampler = Sampler(samples)
    found = [sampler.draw([key])[0] for key in terms(text).items()]
    return [min(int(v[d]) for v in found) & 0xFFFFFFFF for d in range(samples)]


def test_samples_are_minima_and_memory_does_not_matter():
    texts = [f"a b b c{i} c{i + 1} d{i} the the the" for i in range(300)] + ["", "...", "x"]
    small, large = Sampler(32, kept=1 << 13), Sampler(32)
    small.values = small.values[:40]  # forgets all the time
    import cardlens.llm.fingerprints as module

    block, module.BLOCK = module.BLOCK, 16
    try:
        forgetful = small.fingerprints(texts)
    finally:
        module.BLOCK = block
    prints = large.fingerprints(texts)
    assert (forgetful == prints).all()
    for i in (0, 7, 299, 301, 302):
        assert [v % 0xFFFF for v in plain(texts[i], 32)] == prints[i].tolist()
    assert (prints[300] == 0xFFFF).all()


def test_collisions_follow_generalised_jaccard():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    sampler = Sampler(2048)
    for _ in range(6):
        a = " ".join(rng.choice(words, 150))
        b = " ".join([*a.split()[:90], *rng.choice(words, 60)])
        x, y = sampler.fingerprints([a, b])
        assert likeness(x, y) == pytest.approx(similarity(terms(a), terms(b)), abs=0.05)


def edits(rows):
    """Edited texts by definition."""
    ordered = sorted((i, t or "") for i, t in rows)
    made = {}
    for k, (i, text) in enumerate(ordered):
        after = ordered[(k + 1) % len(ordered)][1]
        quarter = len(text) // 4
        made[i] = (text[: len(text) - quarter] + after[:quarter], after)
    return made


@pytest.mark.parametrize("parts", [1, 7])
def test_edits_over_all_rows(docs, by_id, parts):
    rows = [(i * 3 - 50, f"é{i} one two three " * (i % 9) + "end" * (i % 4)) for i in range(80)]
    rows += [(1000, None), (2000, ""), (3000, "long words here " * 9000)]
    found = by_id(
        fingerprint_edits(docs(rows, parts)),
        "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )
    assert len(found) == len(rows)
    sampler = Sampler()
    for i, (edited, after) in edits(rows).items():
        text = dict(rows)[i] or ""
        a, b, c = sampler.fingerprints([text, edited, after])
        n, digest, own, changed, near, next_one = found[i]
        assert (n, digest) == (len(text), sha256(edited.encode()).hexdigest())
        assert own == a.astype(">u2").tobytes().hex() and changed == b.astype(">u2").tobytes().hex()
        assert near == likeness(a, b) and next_one == likeness(a, c)


def test_one_row_is_its_own_next(docs, by_id):
    found = by_id(fingerprint_edits(docs([(5, "abcdefgh")])), "edited_sha256", "near_next")
    assert found[5] == (sha256(b"abcdefab").hexdigest(), 1.0)


def test_rows_without_an_id_have_no_next(docs):
    rows = [(None, "abcdefgh"), (None, "abcdefgh"), (1, "x y"), (1, "a b"), (2, "z")]
    found = fingerprint_edits(docs(rows)).collect()
    assert len(found) == 5
    alone = [r for r in found if r.doc_id is None]
    assert {r.edited_sha256 for r in alone} == {sha256(b"abcdef").hexdigest()}
    assert {r.near_next for r in alone} == {0.0}


def test_no_rows(docs):
    assert fingerprint_edits(docs([])).count() == 0
    assert fingerprint_edits(docs([(None, None)])).count() == 1


def test_the_plan_does_not_grow_with_the_buckets(spark, docs):
    table = docs([(i, f"text {i}") for i in range(50)])
    sizes = []
    for parts in ("8", "20000"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            rows = fingerprint_edits(table)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        sizes.append(len(rows._jdf.queryExecution().optimizedPlan().toString()))
    assert sizes[1] < 1.2 * sizes[0]


def test_minima_shared_with_the_edited_text():
    words = ["a", "b b", "the", "Σας", "é", "...", "x\ny", "can't", "tail", " ", "İx"]
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(words, rng.integers(0, 30))) for _ in range(300)]
    texts += ["", "x", "one", "... ...", " lead", "nospaceatall" * 9]
    after = [*texts[1:], None]
    sampler = Sampler(32)
    found = sampler.edited_fingerprints(texts, after)
    edited = [edited_text(t, f) for t, f in zip(texts, after)]
    assert (found[0] == sampler.fingerprints(texts)).all()
    assert (found[1] == sampler.fingerprints(edited)).all()
