import base64
import glob
import gzip
import hashlib
import random
import re

import pytest

from cardlens.llm import warc

PAGES = "page_id long, url string, html string, digest string, size int, ka string"


@pytest.fixture
def pages(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "d", 1, "k") for r in rows], PAGES).repartition(3)

    return make


def expected(rows, shortest=1000):
    last = {}
    for page, _, html in rows:
        if page is not None:
            last[html or ""] = max(last.get(html or "", page), page)
    made = []
    for page, _, html in rows:
        data = (html or "").encode()
        to = last.get(html or "")
        revisit = len(data) >= shortest and page is not None and page < to
        made.append(
            (page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", to if revisit else None)
        )
    return sorted(made, key=str)


def records(spark, path):
    number = lambda x: None if x is None else int(x)
    rows = warc.read_records(spark, path).collect()
    assert all(r.intact for r in rows)
    return sorted(((number(r.page), r.size, r.digest, r.record_type, number(r.refers_to)) for r in rows), key=str)


ROWS = [
    (1, "http://a/", "same " * 300),
    (2, None, "same " * 300),
    (3, "http://b/\r\nX: y", "same " * 300),
    (4, "u", "small"),
    (5, "u", "small"),
    (6, "u", None),
    (7, "u", ""),
    (8, "u", "x" * 999),
    (9, "u", "x" * 999),
    (10, "u", "é" * 500),
    (11, "u", "é" * 500),
    (12, "u", "aé\r\nb" * 60000),
    (13, "u", "aé\r\nb" * 60000),
    (14, "u", "\r\n" * 50000),
    (15, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\nHTTP"),
    (16, "u", "q" * warc.CHUNK),
    (17, "u", "q" * (warc.CHUNK + 1)),
    (18, "u", "漢\n" * 40000 + "\r"),
    (None, "u", "z" * 2000),
    (None, "u", "z" * 2000),
    (20, "u", "same id " * 200),
    (20, "u", "same id " * 200),
    (19, "u", "same id " * 200),
]


def test_round_trip(spark, pages, tmp_path):
    path = f"{tmp_path}/warc"
    warc.write_archives(pages(ROWS), path)
    assert records(spark, path) == expected(ROWS)


def test_round_trip_of_any_breaks(spark, pages, tmp_path, monkeypatch):
    rng = random.Random(4)
    rows = [
        (i, "u", "".join(rng.choices(["\r", "\n", "\r\n", "0\r\n", "a", "é", "ff", "\r\n\r\n"], k=rng.randint(0, 60))))
        for i in range(300)
    ]
    path = f"{tmp_path}/warc"
    warc.write_archives(pages(rows), path, shortest=10)
    assert records(spark, path) == expected(rows, 10)
    for page, url, html in rows[:80]:  # in small chunks, without Spark
        monkeypatch.setattr(warc, "CHUNK", 7)
        payload = html.encode()
        reader = warc._Reader(True)
        whole = b"".join(
            line + b"\r\n"
            for line in warc.record_rows(str(page), url, payload, hashlib.sha1(payload).hexdigest(), None, "d")
        )
        assert whole.endswith(b"\r\n\r\n")
        for line in (whole * 2).removesuffix(b"\r\n").split(b"\r\n"):
            reader.line(line)
        assert b"".join(r[6] for r in reader.rows) == payload * 2
        assert [r[9] for r in reader.rows if r[5]] == [True, True]


def test_chunks_carry_digests(spark, pages, tmp_path):
    path = f"{tmp_path}/warc"
    text = "".join(map(str, range(60000)))
    warc.write_archives(pages([(1, "u", text)]), path)
    chunks = warc.read_chunks(spark, path).orderBy("chunk").collect()
    assert len(chunks) == -(-len(text) // warc.CHUNK) and [c.last for c in chunks][-1]
    seen = b""
    for number, c in enumerate(chunks):
        seen += c.data
        assert (c.chunk, c.size, c.digest) == (number, len(seen), hashlib.sha1(seen).hexdigest())
    assert seen.decode() == text


def test_files_follow_the_format(spark, pages, tmp_path):
    path = f"{tmp_path}/warc"
    rows = [r for r in ROWS if r[0] is not None]
    warc.write_archives(pages(rows), path)
    for file in glob.glob(f"{path}/part-*.gz"):
        data = gzip.open(file).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\n")
            fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
            length = int(fields[b"Content-Length"])
            block, end, data = rest[:length], rest[length : length + 4], rest[length + 4 :]
            assert end == b"\r\n\r\n"
            http, _, body = block.partition(b"\r\n\r\n")
            if b"chunked" in http:
                payload = b""
                while size := int(body.partition(b"\r\n")[0], 16):
                    at = body.index(b"\r\n") + 2
                    payload += body[at : at + size]
                    assert body[at + size : at + size + 2] == b"\r\n"
                    body = body[at + size + 2 :]
                assert body == b"0\r\n\r\n"
                body = payload
            if fields[b"WARC-Type"] == b"response":
                digest = fields[b"WARC-Payload-Digest"].removeprefix(b"sha1:")
                assert base64.b32decode(digest) == hashlib.sha1(body).digest()
            else:
                assert not body and re.fullmatch(rb"<urn:page:\d+>", fields[b"WARC-Refers-To"])


def test_no_rows(spark, pages, tmp_path):
    path = f"{tmp_path}/warc"
    warc.write_archives(pages([]), path)
    assert warc.read_records(spark, path).count() == 0


def test_writer_gets_chunks(spark):
    sizes = [0, 1, warc.CHUNK, warc.CHUNK + 1, 40 * warc.CHUNK, 40 * warc.CHUNK + 7]
    rows = [(str(i), "u", bytearray(b"x" * n), "d", n, None) for i, n in enumerate(sizes)]
    rows += [("r", "u", bytearray(b"x" * 3 * warc.CHUNK), "d", 3 * warc.CHUNK, "5")]
    schema = "page string, url string, payload binary, digest string, size int, refers_to string"
    pieces = warc.payload_pieces(spark.createDataFrame(rows, schema).coalesce(1)).collect()
    for i, n in enumerate(sizes):
        mine = [p for p in pieces if p.page == str(i)]
        assert [p.piece for p in mine] == list(range(max(1, -(-n // warc.CHUNK))))
        assert all(len(p.data) == warc.CHUNK for p in mine[:-1])
        assert b"".join(bytes(p.data) for p in mine) == b"x" * n
    assert [(p.piece, p.data) for p in pieces if p.page == "r"] == [(0, None)]


def test_large_payloads_between_small_ones(spark, pages, tmp_path):
    path = f"{tmp_path}/warc"
    rows = [(i, "u", f"{i} " * (3_000_000 if i % 5 == 0 else 10)) for i in range(12)]
    warc.write_archives(pages(rows), path)
    assert records(spark, path) == expected(rows)
