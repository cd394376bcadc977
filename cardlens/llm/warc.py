"""WARC archives as text files that Spark writes and reads, payloads as tables of chunks.

Spark's text sink ends each row with CR LF, so a row may be the lines of a record's head, a
whole small payload, or one chunk of a large one: payloads above a limit are sent as HTTP
chunks, whose framing also ends in CR LF. Spark cuts payloads into (record, piece number, bytes)
rows before the writer sees them. Each file is compressed. The reader gets a file's
lines in order, follows the lengths that the heads state, and returns chunks with the digest
and the length of the payload so far; it never holds more of a record than a chunk and a line.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from hashlib import sha1

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm.tables import map_batches, named, text_of

#: Payloads above this are written as HTTP chunks of this size, and read in such pieces.
CHUNK = 64 << 10
#: Bytes of rows that the writer gathers before it hands them on.
HELD_BYTES = 4 << 20
#: Payloads of fewer bytes are never revisits.
SHORTEST_REVISIT = 1000
#: Fixed value: the profile of a revisit by digest.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_EOL = b"\r\n"


def _facts(pages: DataFrame, id_col: str, payload_col: str) -> list[Column]:
    payload = text_of(payload_col)
    return [
        F.xxhash64(named(id_col), payload).alias("ka"),
        F.xxhash64(F.lit("second"), named(id_col), payload).alias("kb"),
        F.sha1(payload.cast("binary")).alias("digest"),
        F.xxhash64(payload).alias("check"),
        F.octet_length(payload).alias("size"),
    ]


def revisits(pages: DataFrame, id_col: str, payload_col: str, shortest: int) -> DataFrame:
    """``ka, kb, refers_to``: rows whose payload another row with a larger id has.

    Digests are grouped with partial aggregates; the join that hands each row the largest id
    has narrow rows and can be split where many share a digest.
    """
    facts = pages.select(named(id_col).alias("id"), *_facts(pages, id_col, payload_col))
    long = facts.where(F.col("size") >= shortest)
    same = ["digest", "check", "size"]
    last = long.groupBy(*same).agg(F.max("id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    return (
        long.join(last.where(F.col("n") > 1), same)
        .where(F.col("id") < F.col("refers_to"))
        .select("ka", "kb", "refers_to")
        .distinct()
    )


def _record(name: str) -> str:
    return f"<urn:page:{name}>"


def _head(
    page: str | None, url: str | None, size: int, digest: str, refers_to: str | None, date: str
) -> bytes:
    """The head of one record and of its HTTP message, from what is known of the payload."""
    base32 = base64.b32encode(bytes.fromhex(digest)).decode()
    chunked = refers_to is None and size > CHUNK
    http = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8"]
    http.append("Transfer-Encoding: chunked" if chunked else f"Content-Length: {size}")
    head = ("\r\n".join(http) + "\r\n\r\n").encode()
    if chunked:
        full, rest = divmod(size, CHUNK)
        framing = full * (len(f"{CHUNK:x}") + 4) + (len(f"{rest:x}") + 4 if rest else 0)
        length = len(head) + size + framing + 5
    else:
        length = len(head) + (size if refers_to is None else 0)
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        *([f"WARC-Record-ID: {_record(page)}"] if page is not None else []),
        *([f"WARC-Target-URI: {' '.join(url.split())}"] if url is not None else []),
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base32}",
        *(
            [f"WARC-Refers-To: {_record(refers_to)}", f"WARC-Profile: {PROFILE}"]
            if refers_to is not None
            else []
        ),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {length}",
    ]
    return "\r\n".join(fields).encode() + _EOL * 2 + head


def piece_rows(
    page: str | None,
    url: str | None,
    digest: str,
    size: int,
    refers_to: str | None,
    piece: int,
    data: bytes | None,
    date: str,
) -> Iterator[bytes]:
    """The rows that one piece of a payload adds to its record, each without the CR LF that the
    sink adds. Piece 0 brings the head, the last piece of a chunked payload the end."""
    top = _head(page, url, size, digest, refers_to, date) if piece == 0 else b""
    if refers_to is not None or size <= CHUNK:
        yield top + (data if refers_to is None and data else b"") + _EOL
        return
    if piece == 0:
        yield top[:-2]  # the sink's CR LF ends the HTTP head
    yield b"".join([f"{len(data):x}".encode(), _EOL, data])
    if piece * CHUNK + len(data) == size:
        yield b"0" + _EOL * 3


def record_rows(
    page: str | None, url: str | None, payload: bytes, digest: str, refers_to: str | None, date: str
) -> Iterator[bytes]:
    """The rows of one record whose payload is at hand."""
    starts = range(0, max(1, len(payload) if refers_to is None else 0), CHUNK)
    for piece, start in enumerate(starts):
        data = payload[start : start + CHUNK]
        yield from piece_rows(page, url, digest, len(payload), refers_to, piece, data, date)


def payload_pieces(records: DataFrame) -> DataFrame:
    """``page, url, digest, size, refers_to, piece, data``: payloads cut into chunks, in order.

    A revisit has one piece without bytes. The cut happens row by row where the payload is, so
    that what leaves the scan or the join for Python is never more than a chunk a row.
    """
    last = F.when(
        F.col("refers_to").isNull(), F.greatest(F.ceil(F.col("size") / CHUNK) - 1, F.lit(0))
    ).otherwise(F.lit(0))
    begin = F.col("piece") * CHUNK + 1
    data = F.when(F.col("refers_to").isNull(), F.substring("payload", begin, F.lit(CHUNK)))
    numbered = records.select("*", F.explode(F.sequence(F.lit(0), last.cast("int"))).alias("piece"))
    return numbered.select("page", "url", "digest", "size", "refers_to", "piece", data.alias("data"))


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    date: str = "2024-01-01T00:00:00Z",
    shortest: int = SHORTEST_REVISIT,
) -> None:
    """Writes a record for every row under ``path``.

    Of rows with equal payloads of at least ``shortest`` bytes, the one with the largest id
    is a response, also if repeated; the others are revisits of it. Rows without an id are
    responses without a record id. A null payload is empty, a null address is left out.

    Python gets chunks, never whole payloads, and hands on a batch for every few megabytes.
    """
    payload = text_of(payload_col)
    facts = _facts(pages, id_col, payload_col)
    rows = pages.select(
        named(id_col).cast("string").alias("page"),
        named(url_col).cast("string").alias("url"),
        payload.cast("binary").alias("payload"),
        *[facts[i] for i in (0, 1, 2, 4)],  # the keys of the row, digest and size
    )
    found = revisits(pages, id_col, payload_col, shortest)
    decided = rows.join(found, ["ka", "kb"], "left").select(
        "page", "url", "payload", "digest", "size", F.col("refers_to").cast("string")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0

        def batch_of(rows: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["value"])

        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                columns = [c.to_pylist() for c in batch.slice(begin, 64).columns]
                for row in zip(*columns):
                    for line in piece_rows(*row, date):
                        held.append(line)
                        size += len(line)
                    if size > HELD_BYTES:
                        yield batch_of(held)
                        held, size = [], 0
        yield batch_of(held)

    pieces = payload_pieces(decided)
    lines = map_batches(pieces, run, "value binary").select(F.col("value").cast("string"))
    lines.write.option("lineSep", "\r\n").option("compression", "gzip").text(path)


class _Reader:
    """Follows the lines of archives and makes chunk rows."""

    def __init__(self, with_data: bool) -> None:
        self.with_data = with_data
        self.rows: list[tuple] = []
        self.state = "between"

    def line(self, line: bytes) -> None:
        if self.state == "between":
            if line.startswith(b"WARC/"):
                self.fields: dict[bytes, bytes] = {}
                self.state = "head"
        elif self.state == "head":
            if line:
                name, _, value = line.partition(b":")
                self.fields[name.strip().lower()] = value.strip()
            else:
                self._begin()
        else:
            data = line + _EOL
            data = data[: self.left]
            self.left -= len(data)
            self._block(data, line)
            if not self.left:
                self._end()

    def _begin(self) -> None:
        self.left = int(self.fields.get(b"content-length", b"0"))
        self.http: dict[bytes, bytes] = {}
        self.in_http = True
        self.digest, self.size, self.number = sha1(), 0, 0
        self.held: list[bytes] = []
        self.held_size = 0
        self.chunk = -1  # bytes left of an HTTP chunk, -1 before its size
        self.state = "block"
        if not self.left:
            self._end()

    def _block(self, data: bytes, line: bytes) -> None:
        if self.in_http:
            if line:
                name, _, value = line.partition(b":")
                self.http[name.strip().lower()] = value.strip()
            else:
                self.in_http = False
        elif self.http.get(b"transfer-encoding") != b"chunked":
            self._payload(data)
        else:
            while data:
                if self.chunk < 0:  # a size line, or the end of the chunk before
                    if line:
                        self.chunk = int(line.partition(b";")[0], 16)
                    return
                part = data[: self.chunk]
                self._payload(part)
                self.chunk -= len(part)
                data = data[len(part) :]
                if not self.chunk:
                    self.chunk = -1
                    return  # what is left of the line is the CR LF behind the chunk

    def _payload(self, data: bytes) -> None:
        while data:
            part = data[: CHUNK - self.held_size]
            data = data[len(part) :]
            self.held.append(part)
            self.held_size += len(part)
            if self.held_size == CHUNK:
                self._flush(False)

    def _flush(self, last: bool) -> None:
        data = b"".join(self.held)
        self.held, self.held_size = [], 0
        self.digest.update(data)
        self.size += len(data)
        fields = self.fields
        text = {k: v.decode("utf-8", "replace") for k, v in fields.items()}
        kind = text.get(b"warc-type", "")
        stated = text.get(b"warc-payload-digest", "").removeprefix("sha1:")
        stated = base64.b32decode(stated).hex() if stated else None
        size, digest = self.size, self.digest.hexdigest()
        if kind == "revisit":  # the payload is elsewhere
            size, digest = int(self.http.get(b"content-length", b"0")), stated
        self.rows.append(
            (
                _page(text.get(b"warc-record-id")),
                text.get(b"warc-target-uri"),
                kind,
                _page(text.get(b"warc-refers-to")),
                self.number,
                last,
                data if self.with_data else None,
                size,
                digest,
                (digest == stated) if last else None,
            )
        )
        self.number += 1

    def _end(self) -> None:
        self._flush(True)
        self.state = "between"


def _page(record: str | None) -> str | None:
    return record.removeprefix("<urn:page:").removesuffix(">") if record else None


def read_chunks(spark: SparkSession, path: str, with_data: bool = True) -> DataFrame:
    """The chunked record table: a row for each chunk of each record under ``path``.

    ``page, url, record_type, refers_to`` come from the record's head, ``chunk`` counts from 0,
    ``last`` marks the last one, ``data`` holds its bytes (null unless wanted). ``size`` and
    ``digest`` (SHA-1, hex) are of the payload up to here, on a revisit of the payload that it
    refers to. ``intact`` on the last chunk: the digest is the one that the head states. A
    record without payload has one chunk without bytes.
    """
    lines = spark.read.option("lineSep", "\r\n").text(path).select(F.col("value").cast("binary"))
    schema = (
        "page string, url string, record_type string, refers_to string, chunk int, last boolean, "
        "data binary, size long, digest string, intact boolean"
    )
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = [pa.string()] * 4 + [pa.int32(), pa.bool_(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(with_data)
        for batch in batches:
            column = batch.column(0)
            for begin in range(0, len(column), 256):
                for line in column.slice(begin, 256).to_pylist():
                    reader.line(line)
                if reader.rows:
                    arrays = [pa.array(list(c), k) for c, k in zip(zip(*reader.rows), kinds)]
                    reader.rows = []
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

    return map_batches(lines, run, schema)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record: its last chunk, with the digest and size of all the payload."""
    return read_chunks(spark, path, with_data=False).where("last").drop("chunk", "last", "data")
