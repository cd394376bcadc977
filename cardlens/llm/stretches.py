"""Library tokenizers on stretches of texts that recur.

Most words of a corpus recur, and tokenizers of the kinds below never join characters across a
space that stands between two other characters. So texts are cut there, the libraries encode
each different stretch, and a worker process remembers the ids of short ones, up to a bound. New
stretches are encoded as a row, put together to texts; the bytes of the tokens tell where each
one ends. The ids are those of the whole text; where a tokenizer doesn't allow the cut, whole
texts are encoded.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

from cardlens.llm.byte_bpe import Stretches

#: Most stretches that a worker process remembers, and the longest kept (characters).
MOST_KEPT, LONGEST_KEPT = 1_300_000, 24
#: Stretches in a text made of new ones.
ROW = 500


#: White space other than the space.
WHITE = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]


def as_bytes(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return np.array(ids, "<u4").tobytes()


def byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable bytes of Latin-1 stand for themselves, the others for the characters from U+0100
    on, in their order.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


def near_white(text: str) -> bool:
    """Whether a space has white space beside it."""
    return "  " in text or any(w in text and (f" {w}" in text or f"{w} " in text) for w in WHITE)


def joinable(some: list[str]) -> list[list[str]]:
    """Rows of those stretches that stay apart when joined: one space, ahead of other characters."""
    rows = []
    for k in range(0, len(some), ROW):
        row = some[k : k + ROW]
        text = "".join(row)
        if text.count(" ") != len(row) or text[-1].isspace() or near_white(text):
            row = [
                s
                for s in row
                if s.rfind(" ") == 0 and len(s) > 1 and not (s[1].isspace() or s[-1].isspace())
            ]
        rows.append(row)
    return [row for row in rows if row]


class Coded:
    """The stretches of some texts as numbers.

    ``others`` and ``firsts`` are the different stretches behind a space (without it) and at the
    start of a text. ``codes`` has the place of each occurrence in ``others + firsts``, text by
    text in the order ``order``; those of the k-th lie between ``bounds[k]`` and ``bounds[k + 1]``.
    """

    def __init__(self, texts: list[str], between: Callable[[str], list[str]]) -> None:
        near = list(map(near_white, texts))
        self.order = sorted(range(len(texts)), key=near.__getitem__)
        plain = [texts[k] for k in self.order[: len(texts) - sum(near)]]
        cut = [between(texts[k]) for k in self.order[len(plain) :]]
        rows = pc.split_pattern(pa.array(plain, pa.large_string()), " ")
        flat = pa.concat_arrays([rows.flatten(), pa.array(chain.from_iterable(cut), pa.large_string())])
        sizes = [*pc.list_value_length(rows).to_pylist(), *map(len, cut)]
        self.bounds = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64))])
        coded = flat.dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        codes = coded.indices.to_numpy().astype(np.int64)
        codes[self.bounds[:-1]] += len(names)  # a first stretch has no space before it
        seen = np.zeros(2 * len(names), bool)
        seen[codes] = True
        self.codes = (np.cumsum(seen) - 1)[codes]
        self.others = [names[k] for k in np.flatnonzero(seen[: len(names)]).tolist()]
        self.firsts = [names[k] for k in np.flatnonzero(seen[len(names) :]).tolist()]

    def in_order(self, values: list) -> list:
        """Values of the texts, as they were given, from those in the order ``order``."""
        made = [None] * len(values)
        for k, value in zip(self.order, values):
            made[k] = value
        return made


class Library:
    """A tokenizer: ``tokens``, the bytes of each id, and ``whole``, ids of texts as arrays.

    Texts begin with a space, which ``whole`` may leave to the library.
    """

    tokens: list[bytes]
    cuttable: bool
    whole: Callable[[list[str]], list[list[int]]]

    def sized(self) -> None:
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)

    def spelt(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def stretches(self, some: list[str], spelt: bool = True) -> list[bytes | None]:
        """Ids of stretches as :func:`as_bytes` has them.

        None, if ``spelt`` is asked for, where the tokens' bytes are not those of the stretch.
        """
        found: dict[str, bytes | None] = {}
        rows = joinable(some)
        texts = ["".join(row) for row in rows]
        for row, text, ids in zip(rows, texts, self.whole(texts) if texts else []):
            if spelt and self.spelt(ids) != text.encode():
                continue  # one by one, below
            ids = np.array(ids, "<u4")
            sizes = map(len, row) if text.isascii() else [len(s.encode()) for s in row]
            ends = np.cumsum(np.fromiter(sizes, np.int64, len(row)))
            reached = np.cumsum(self.sizes[ids])
            bounds = np.searchsorted(reached, ends)
            if reached[-1] == ends[-1] and (reached[bounds] == ends).all():
                data, bounds = ids.tobytes(), ((bounds + 1) * 4).tolist()
                found.update(zip(row, map(data.__getitem__, map(slice, [0, *bounds], bounds))))
        if len(found) < len(some):
            left = [s for s in some if s not in found]
            for s, ids in zip(left, self.whole(left)):
                whole = not spelt or self.spelt(ids) == s.encode()
                found[s] = as_bytes(ids) if whole else None
        return list(map(found.__getitem__, some))


class ByteLevel(Library):
    """A tokenizer of the ``tokenizers`` library.

    ``plain``: the strings of special tokens are ordinary text.
    """

    def __init__(self, path: str, plain: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = plain
        made = json.loads(self.model.to_str())
        self.special = [] if plain else [t["content"] for t in made["added_tokens"]]
        before = made["pre_tokenizer"] or {}
        #: Whether a space behind another character always begins a piece encoded on its own.
        self.cuttable = (
            made["model"]["type"] == "BPE"
            and made["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not any(made[k] for k in ("truncation", "padding"))
            and all(t["special"] for t in made["added_tokens"])
        )
        value = byte_values()
        names = {i: t for t, i in self.model.get_vocab(with_added_tokens=True).items()}
        self.tokens = [
            bytes(value[c] for c in names.get(i, "") if c in value) for i in range(max(names) + 1)
        ]
        self.sized()
        self.memory = Memory(partial(self.stretches, spelt=False))

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, whether it begins with a space or not."""
        if not self.cuttable:
            return list(map(as_bytes, self.whole(texts)))
        made = self._joined(texts)
        held = [k for k, text in enumerate(texts) if any(s in text for s in self.special)]
        for k, ids in zip(held, self.whole([texts[k] for k in held]) if held else []):
            made[k] = as_bytes(ids)
        return made

    def _joined(self, texts: list[str]) -> list[bytes]:
        """Ids of each text from those of its stretches."""
        coded = Coded(texts, self.memory.between)
        values = [*self.memory.values(coded.others), *self.memory.find(coded.firsts)]
        ids = np.frombuffer(b"".join(values), "<u4")
        sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
        begins = np.cumsum(sizes) - sizes
        taken = sizes[coded.codes]
        ends = np.concatenate([[0], np.cumsum(taken)])
        place = np.repeat(begins[coded.codes] - ends[:-1], taken)
        place += np.arange(len(place))
        data, bounds = ids[place].tobytes(), (4 * ends[coded.bounds]).tolist()
        return coded.in_order(list(map(data.__getitem__, map(slice, bounds, bounds[1:]))))


class Pieces(Library):
    """A tokenizer of the ``sentencepiece`` library that itself puts a space before a text."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.tokens = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in enumerate(names)
        ]
        self.sized()
        #: Whether a space behind another character always begins a piece.
        self.cuttable = not any("▁" in n.lstrip("▁") for n in names)
        self.space = self.model.encode("a ")[len(self.model.encode("a")) :]

    def whole(self, texts: list[str]) -> list[list[int]]:
        found = self.model.encode([t[1:] for t in texts], num_threads=1)
        return [ids if t != " " else self.space for t, ids in zip(texts, found)]


class Memory:
    """Values of the stretches of texts; ``find`` gets different stretches with their space."""

    def __init__(self, find: Callable[[list[str]], list], most: int | None = None) -> None:
        self.find, self.most, self.known = find, most or MOST_KEPT, {}
        self.between = Stretches(public_tokenizers.PATTERN).cut

    def cut(self, text: str) -> list[str]:
        """The first stretch, then the others, each without the space that it begins with."""
        return self.between(text) if near_white(text) else text.split(" ")

    def values(self, some: list[str]) -> list:
        """Values of different stretches, named without the space that they begin with."""
        known = self.known
        if len(known) > self.most:
            known.clear()
        found = list(map(known.get, some))
        new = [s for s, value in zip(some, found) if value is None]
        fresh = self.find([" " + s for s in new]) if new else []
        known.update((s, value) for s, value in zip(new, fresh) if len(s) <= LONGEST_KEPT)
        left = iter(fresh)
        return [next(left) if value is None else value for value in found]

    def rows(self, texts: list[str]) -> Iterator[Iterator]:
        """For each text, the values of its stretches in order; to be read one by one."""
        known = self.known
        if len(known) > self.most:
            known.clear()
        cut = list(map(self.cut, texts))
        leads = [row[0] for row in cut]
        for row in cut:
            del row[0]
        here = set().union(*cut)
        new = list(here.difference(known))
        values = dict(zip(here, map(known.get, here)))  # small, unlike what is remembered
        values.update(zip(new, self.find([" " + s for s in new]) if new else []))
        known.update((s, values[s]) for s in new if len(s) <= LONGEST_KEPT)
        some = list({s for s in leads if s})
        lead = dict(zip(some, self.find(some) if some else []))
        for first, row in zip(leads, cut):
            found = map(values.__getitem__, row)
            yield chain([lead[first]], found) if first else found


@lru_cache(maxsize=4)
def byte_level(path: str, plain: bool) -> ByteLevel:
    """The tokenizer of this worker process."""
    return ByteLevel(path, plain)
