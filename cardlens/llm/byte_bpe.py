"""Byte-level BPE encoding and decoding by a public vocabulary of ranks.

A piece of text is cut into tokens without merging: an Aho-Corasick automaton over the
vocabulary, its bytes mapped to Latin-1, finds the longest token at each place. Two tokens may
stand side by side only if merging their bytes gives just these two; a row of tokens is the
result of merging exactly if all its neighbours may. So the encoder walks along the longest
tokens, takes the next shorter prefix where neighbours don't fit, and steps back where none is
left. A place that proved a dead end is never entered again, hence linear time. Fits of
neighbours and tokens of short pieces are remembered, up to a bound.
"""

from __future__ import annotations

import base64
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import ahocorasick
import regex
from pyspark.sql import DataFrame

from cardlens.llm.tables import map_texts

#: Most entries of each memory of a worker process, and the longest stretch kept (characters).
MOST_KEPT, LONGEST_KEPT = 400_000, 24


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file with a Base64 token and its rank in each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def merged(piece: bytes, ranks: dict[bytes, int], leave: int = 1) -> list[bytes]:
    """``piece`` by merging: always the neighbours of lowest rank, the first of equals.

    Stops at ``leave`` parts, or when no neighbours are a token.
    """
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > leave:
        found = [
            (ranks[pair], i)
            for i, pair in enumerate(a + b for a, b in zip(parts, parts[1:]))
            if pair in ranks
        ]
        if not found:
            break
        at = min(found)[1]
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Stretches:
    """Cuts texts into stretches that the pattern of pieces treats on their own.

    The pattern's pieces may begin with a space, and white space may be a piece; no piece
    holds white space behind another character. So a space between two other characters
    always begins a piece.
    """

    def __init__(self, pattern: str) -> None:
        self.pieces = regex.compile(pattern).findall
        self._spaces = regex.compile(r" \s|\s ").search
        self._between = regex.compile(r"(?<=\S) (?=\S)").split

    def cut(self, text: str) -> list[str]:
        """The first stretch, then the others, each without the space that it begins with."""
        return self._between(text) if self._spaces(text) else text.split(" ")


class ByteEncoder:
    """Encoder and decoder for one vocabulary and one pattern of pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        self.shorter = [-1] * len(self.tokens)
        self.longest = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.tokens[rank] = token
            self.longest.add_word(token.decode("latin-1"), (len(token) - 1, rank))
            prefixes = (token[:n] for n in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((ranks[p] for p in prefixes if p in ranks), -1)
        self.longest.make_automaton()
        self.names = [str(i) for i in range(len(self.tokens))]
        self.stretches = Stretches(pattern)
        self.known: dict[str, tuple[int, ...]] = {}  # by stretch
        self.words: dict[str, tuple[int, ...]] = {}  # by piece
        self.fits: dict[tuple[int, int], bool] = {}
        self.halves: dict[int, tuple[int, int]] = {}

    def _halves(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge makes this one."""
        pair = self.halves.get(token)
        if pair is None:
            left, right = merged(self.tokens[token], self.ranks, leave=2)
            pair = self.halves[token] = (self.ranks[left], self.ranks[right])
        return pair

    def _fit(self, left: int, right: int) -> bool:
        """Whether merging leaves these neighbours as they are.

        Goes back through the merges that made the two, the latest first. Whatever pair met at
        the border would have merged if its rank came before the next merge of either side; of
        equal ranks the one further left goes first.
        """
        next_left = next_right = len(self.tokens)
        while True:
            joint = self.ranks.get(self.tokens[left] + self.tokens[right])
            if joint is not None and joint < next_left and joint <= next_right:
                return False
            made_left = left if len(self.tokens[left]) > 1 else -1
            made_right = right if len(self.tokens[right]) > 1 else -1
            if made_left < 0 and made_right < 0:
                return True
            if made_left > made_right:
                next_left, left = left, self._halves(left)[1]
            else:
                next_right, right = right, self._halves(right)[0]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Tokens of one piece, in linear time."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        here = [-1] * (len(piece) + 1)  # the longest token that starts at each place
        for end, (reach, rank) in self.longest.iter(piece.decode("latin-1")):
            here[end - reach] = rank
        dead = bytearray(len(piece) + 1)
        fits = self.fits
        row: list[int] = []
        place = 0
        token = here[0]
        while place < len(piece):
            end = place + len(self.tokens[token])
            if not dead[end]:
                fit = True
                if row:
                    pair = (row[-1], token)
                    fit = fits.get(pair)
                    if fit is None:
                        if len(fits) >= MOST_KEPT:
                            fits.clear()
                        fit = fits[pair] = self._fit(*pair)
                if fit:
                    row.append(token)
                    place = end
                    token = here[place]
                    continue
            token = self.shorter[token]
            while token < 0:  # nothing fits here: back to a shorter token before
                dead[place] = 1
                last = row.pop()
                place -= len(self.tokens[last])
                token = self.shorter[last]
        return row

    def _encode_stretch(self, stretch: str) -> tuple[int, ...]:
        words = self.words
        row: list[int] = []
        for piece in self.stretches.pieces(stretch):
            ids = words.get(piece)
            if ids is None:
                ids = tuple(self.encode_piece(piece.encode()))
                if len(piece) <= LONGEST_KEPT:
                    if len(words) >= MOST_KEPT:
                        words.clear()
                    words[piece] = ids
            row += ids
        return tuple(row)

    def encode(self, text: str) -> list[int]:
        """Tokens of a whole text, each piece encoded on its own."""
        first, *others = self.stretches.cut(text)
        rows = list(map(self.known.get, others))
        if None in rows:
            if len(self.known) > MOST_KEPT:
                self.known.clear()
            for i, row in enumerate(rows):
                if row is None:
                    stretch = others[i]
                    row = self.known.get(stretch)  # it may have come up in this text
                    if row is None:
                        row = self._encode_stretch(" " + stretch)
                        if len(stretch) <= LONGEST_KEPT:
                            self.known[stretch] = row
                    rows[i] = row
        return [*self._encode_stretch(first), *chain.from_iterable(rows)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> ByteEncoder:
    """The encoder of this worker process."""
    return ByteEncoder(read_ranks(path), pattern)


def encode_decode(
    df: DataFrame,
    path: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """Per row: ``n_tokens``, ``ids`` (if wanted), digests of the ids and of the decoded bytes.

    ``path`` names the file of ranks, which every executor has as part of an installed package.
    Null and empty texts have no tokens; their digests are those of no bytes.
    """

    def start():
        bpe = encoder(path, pattern)

        def work(texts: list[str]) -> dict[str, list]:
            made: dict[str, list] = {
                k: [] for k in ("n_tokens", "ids", "ids_sha256", "decoded_sha256")
            }
            for text in texts:
                ids = bpe.encode(text)
                made["n_tokens"].append(len(ids))
                if with_ids:
                    made["ids"].append(ids)
                listed = " ".join(map(bpe.names.__getitem__, ids))
                made["ids_sha256"].append(sha256(listed.encode()).hexdigest())
                made["decoded_sha256"].append(sha256(bpe.decode(ids)).hexdigest())
            return made

        return work

    ids = "ids array<int>, " if with_ids else ""
    fields = f"n_tokens long, {ids}ids_sha256 string, decoded_sha256 string"
    return map_texts(df, id_col, text_col, start, fields, as_bytes=False)
