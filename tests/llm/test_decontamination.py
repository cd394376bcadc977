import random
import re

import pyarrow.parquet as pq
import pytest

from cardlens.llm import decontamination
from cardlens.llm.decontamination import drop_contaminated, find_passages
from text_tables import docs  # noqa: F401

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(rows, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        if item is not None:
            for i in range(max(1, len(w) - size + 1) if w else 0):
                windows.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    made = []
    for doc, text in rows:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                own = windows.get(tuple(w[i : i + n]))
                if own:
                    hit.update(range(i, i + n))
                    found |= own
        made.append((doc, len(w), sorted(hit), sorted(found)))
    return sorted(made, key=str)


def found(table, bench, **options):
    rows = find_passages(table, bench, **options).collect()
    return sorted(
        ((r.doc_id, r.n_words, [i for s in r.spans for i in range(s.start, s.end)], r["items"]) for r in rows),
        key=str,
    )


@pytest.fixture
def bench(spark):
    def make(items):
        rows = [(i, t, "clash") for i, t in items]
        return spark.createDataFrame(rows, "item_id long, text string, doc_id string").repartition(2)

    return make


def corpus(seed):
    rng = random.Random(seed)
    some = ["the", "of", "the", "THE", "é", "Über", "a1", "rare", "other", "of"]
    text = lambda n: " ".join(rng.choices(some, k=n))
    items = [(i, text(rng.randint(0, 30))) for i in range(60)]
    items += [(100, None), (101, ""), (102, "...!"), (103, "the"), (None, text(20)), (104, items[1][1])]
    items += [(105, "one item of nine words is one whole window")]
    rows = []
    for i in range(150):
        parts = [text(rng.randint(0, 12)) for _ in range(rng.randint(0, 3))]
        parts.insert(rng.randint(0, len(parts)), rng.choice(items)[1] or "")
        rows.append((i, rng.choice([" ", "\n", "--"]).join(parts)))
    rows += [(900, None), (901, ""), (902, "the of " * 6000 + (items[2][1] or "")), (None, items[3][1])]
    rows += [(7, rows[7][1]), (7, "another text of the same id")]
    rows += [(903, "ONE item of nine, words is one: whole window!"), (904, "one item of nine words is one whole")]
    return rows, items


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(docs, bench, monkeypatch, seed):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 300 * seed)
    monkeypatch.setattr(decontamination, "PROBES", 50)
    rows, items = corpus(seed)
    assert found(docs(rows), bench(items)) == plain(rows, items)


def test_a_benchmark_in_parts(docs, bench):
    rows, items = corpus(3)
    rows.append(rows[5])
    table, items_table = docs(rows), bench(items)
    assert found(table, items_table, part_bytes=200) == plain(rows, items)
    kept = drop_contaminated(table, items_table, part_bytes=200)
    clean = sorted((d for d, _, hit, _ in plain(rows, items) if not hit), key=str)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == clean


def test_proximity(docs, bench):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [
        (1, item),
        (2, item.replace("delta", "delta inserted")),
        (3, item.replace("delta epsilon", "epsilon delta")),
        (4, item.replace("delta", "a b c d e delta")),
        (5, item.replace("kappa", "")),
    ]
    near = {r.doc_id: (r["items"], r.near_items) for r in find_passages(docs(rows), bench([(9, item)])).collect()}
    assert near == {1: (["9"], []), 2: ([], ["9"]), 3: ([], ["9"]), 4: ([], []), 5: ([], [])}


def test_passages_do_not_run_over_documents(docs, bench):
    item = " ".join(f"w{i}" for i in range(10))
    rows = [(1, "w0 w1 w2 w3 w4"), (2, "w5 w6 w7 w8 w9")]
    table = find_passages(docs(rows, 1), bench([(1, item)]))
    assert all(not r["items"] and not r.near_items for r in table.collect())


def test_nothing_to_find(docs, bench):
    rows = [(1, "some text"), (2, None)]
    for items in ([], [(1, None)], [(None, "some text")]):
        assert found(docs(rows), bench(items)) == [(1, 2, [], []), (2, 0, [], [])]
    assert found(docs([]), bench([(1, "x")])) == []
    table = docs(rows)
    kept = drop_contaminated(table, bench([(1, "x")]))
    assert kept.columns == table.columns and kept.count() == 2


def test_an_index_is_searched_again(spark, docs, bench, tmp_path):
    rows, items = corpus(4)
    path = f"{tmp_path}/index"
    decontamination.write_index(docs(rows), path)
    for some in (items[:20], items[20:]):
        result = decontamination.search_index(spark, path, bench(some))
        got = sorted(((r.id, r.n_words, r["items"]) for r in result.collect()), key=str)
        assert got == sorted(((d, n, i) for d, n, _, i in plain(rows, some)), key=str)


def test_blocks_read_as_written():
    texts = [words(t) for t in ("a b a c", "", "c a é", "a")]
    block = decontamination.Block.of([[w.encode() for w in t] for t in texts])
    again = decontamination.Block.read(
        block.lengths.tolist(), b" ".join(block.words), block.heads.astype("int64").tobytes(), block.steps().tobytes()
    )
    assert again.words == block.words and (again.places == block.places).all()
    lists = {w: again.places[again.heads[i] : again.heads[i + 1]].tolist() for i, w in enumerate(again.words)}
    assert lists == {b"a": [0, 2, 5, 7], b"b": [1], b"c": [3, 4], "é".encode(): [6]}


def test_texts_are_packed_few_at_a_time(spark, tmp_path, monkeypatch):
    direct = decontamination.map_batches

    def watched(df, run, schema):
        def few(batches):
            for batch in batches:
                if batch.num_rows > 256:
                    raise ValueError("too many texts at a time")
                yield batch

        return direct(df, lambda batches: run(few(batches)), schema)

    monkeypatch.setattr(decontamination, "map_batches", watched)
    docs = spark.range(1000).selectExpr("id AS doc_id", "concat('text ', id) AS text").coalesce(1)
    path = str(tmp_path / "index")
    decontamination.write_index(docs, path)
    assert spark.read.parquet(path).selectExpr("explode(ids)").count() == 1000


def test_a_task_holds_little_of_the_index(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(decontamination, "GROUP_BYTES", 1 << 16, raising=False)
    rng = random.Random(5)
    texts = [" ".join(f"{rng.getrandbits(40):x}" for _ in range(300)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    path = tmp_path / "index"
    decontamination.write_index(docs, str(path))
    (file,) = path.glob("part-*")
    stored = pq.ParquetFile(file).metadata
    groups = [stored.row_group(i).total_byte_size for i in range(stored.num_row_groups)]
    assert stored.num_rows >= 250 and sum(groups) > 500_000
    assert max(groups) < 100_000  # the limit and a row


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_words_of_a_text_in_runs(monkeypatch, size):
    monkeypatch.setattr(decontamination, "RUN_BYTES", size)
    for text in ("", " ", "one", "  The é, of\nthe--THE a1 Über!  ", "x" * 50 + " y"):
        assert [w.decode() for w in decontamination.words_of(text.encode())] == words(text)
