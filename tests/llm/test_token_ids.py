import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cardlens.llm import token_ids
from cardlens.llm.byte_bpe import Stretches
from cardlens.llm.catalog import BYTE_LEVEL, QUERIES
from cardlens.llm.stretches import Coded, byte_level
from text_tables import docs  # noqa: F401


def expected(rows, end_id=0):
    """Ids of each row by the library, and the ids of all rows before."""
    model = Tokenizer.from_file(BYTE_LEVEL)
    made, start = {}, 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = model.encode(text or "", add_special_tokens=False).ids + ([] if end_id is None else [end_id])
        made[key] = (start, len(ids), ids)
        start += len(ids)
    return made


def read(df):
    return {r.key: (r.start, r.n_tokens, token_ids.as_integers(r.ids)) for r in df.collect()}


def texts(n, seed=1):
    random.seed(seed)
    words = ["the", "harbour", "é", "\n", "  ", "漢", "x9", "quick", "tion", "."]
    return [(3 * i, " ".join(random.choices(words, k=random.randint(0, 60)))) for i in range(n)]


def test_round_trip(spark, docs, tmp_path):
    rows = texts(200) + [(1, None), (2, ""), (None, "nobody's"), (4, "long " * 60000)]
    token_ids.write_ids(docs(rows, 7), str(tmp_path / "ids"), BYTE_LEVEL)
    assert read(token_ids.read_ids(spark, str(tmp_path / "ids"))) == expected(rows)


def test_small_blocks(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(token_ids, "BLOCK_DOCUMENTS", 3)
    rows = texts(50)
    path = str(tmp_path / "ids")
    blocks = token_ids.Blocks(4, b"", None)
    assert blocks.offsets == [0] and blocks.start == 0
    token_ids.write_ids(docs(rows, 4), path, BYTE_LEVEL, end_id=None)
    assert read(token_ids.read_ids(spark, path)) == expected(rows, None)


def test_some_documents(spark, docs, tmp_path):
    rows = texts(300) + [(None, "without an id")]
    path = str(tmp_path / "ids")
    token_ids.write_ids(docs(rows, 5), path, BYTE_LEVEL)
    wanted = spark.createDataFrame([(0,), (30,), (30,), (897,), (5,), (None,)], "wanted long")
    known = expected(rows)
    assert read(token_ids.read_some(spark, path, wanted)) == {k: known[k] for k in (0, 30, 897, None)}


def test_repeated_ids_and_rows(spark, docs, tmp_path):
    path = str(tmp_path / "ids")
    token_ids.write_ids(docs([(1, "a b c"), (1, "a b c"), (1, "other"), (0, "x")]), path, BYTE_LEVEL)
    found = sorted(token_ids.read_ids(spark, path).collect(), key=lambda r: r.start)
    assert [r.key for r in found] == [0, 1, 1, 1]
    assert [r.start for r in found] == list(np.cumsum([0] + [r.n_tokens for r in found])[:-1])


def test_special_tokens_are_found(spark, docs, tmp_path):
    rows = [(0, "a<|endoftext|> b"), (1, "<|endoftext|>"), (2, "x <|endo ftext|>")]
    token_ids.write_ids(docs(rows), str(tmp_path / "ids"), BYTE_LEVEL)
    got = read(token_ids.read_ids(spark, str(tmp_path / "ids")))
    assert got == expected(rows) and 50256 in got[0][2] and 50256 not in got[2][2]


def test_no_rows(spark, docs, tmp_path):
    path = str(tmp_path / "ids")
    token_ids.write_ids(docs([]), path, BYTE_LEVEL)
    assert token_ids.read_ids(spark, path).count() == 0
    assert token_ids.read_some(spark, path, spark.createDataFrame([(1,)], "k long")).count() == 0


def test_dictionary_helps_short_documents(spark, docs, tmp_path):
    rows = [(i, t) for i, t in texts(2000, seed=5) if t]
    data = token_ids.train_dictionary(docs(rows), BYTE_LEVEL)
    assert 0 < len(data) <= token_ids.DICTIONARY_BYTES
    assert data == token_ids.train_dictionary(docs(rows, 9), BYTE_LEVEL)  # whatever the layout
    ids = token_ids.serialized(BYTE_LEVEL, [t for _, t in rows], 0)
    schema = None
    shared, alone = (token_ids.Blocks(0, d, schema).compress for d in (data, b""))
    assert sum(len(shared(i)) for i in ids) < 0.6 * sum(len(alone(i)) for i in ids)


def test_another_dictionary_is_refused(spark, docs, tmp_path):
    path = str(tmp_path / "ids")
    token_ids.write_ids(docs(texts(20)), path, BYTE_LEVEL)
    other = spark.createDataFrame([("0" * 64, b"else")], "hash string, data binary")
    other.write.mode("overwrite").parquet(f"{path}/dictionary")
    with pytest.raises(Exception, match="another dictionary"):
        token_ids.read_ids(spark, path).collect()


def test_query_against_the_library(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    known = expected([tuple(r) for r in rows])
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op12_token_ids"](spark, folder).collect()}
    assert got == {k: (s, n, zlib.crc32(np.array(i, "<u4").tobytes())) for k, (s, n, i) in known.items()}


def test_stretches_as_numbers():
    some = ["a b a", "", " ", "b", "a  b c", "x \n y é", " a b", "漢 b\u3000 a", "\x00 b \x00"]
    between = Stretches(public_tokenizers.PATTERN).cut
    coded = Coded(some, between)
    names = [*(f" {s}" for s in coded.others), *coded.firsts]
    parts = [coded.codes[a:b].tolist() for a, b in zip(coded.bounds, coded.bounds[1:])]
    made = coded.in_order([[names[c] for c in part] for part in parts])
    assert made == [[first, *(f" {s}" for s in others)] for first, *others in map(between, some)]
    assert len(set(coded.others)) == len(coded.others) and len(set(coded.firsts)) == len(coded.firsts)
    model = byte_level(BYTE_LEVEL, plain=False)
    assert model.encode([]) == []
    assert list(map(token_ids.as_integers, model.encode(some))) == model.whole(some)
