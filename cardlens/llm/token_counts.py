"""Token counts under a unigram model, by dynamic programming on a shared trie.

A piece is cut into the tokens of the greatest total score. Pieces are sorted, so that prefixes
which they share are known by their neighbours: each is scored once however many pieces share
it, all of one length at a time, as arrays. The tokens that a prefix may end in are found along
a trie of reversed tokens. Long pieces are walked depth first, one by one, with the scores along
the present path.

:func:`count_by_corpus` estimates the scores from all texts. Spark counts the different
stretches between spaces; their best cuts under a first model say how often the corpus has each
token. The first model, which :func:`count_tokens` uses alone, lets a token's probability fall
with its rank in the vocabulary, as Zipf's law has it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import repeat
from math import log
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.llm.byte_bpe import Stretches, read_ranks
from cardlens.llm.graphs import stored
from cardlens.llm.stretches import Coded, joinable
from cardlens.llm.tables import STEP, map_batches, map_texts, steps, text_of

#: Most stretches and pieces whose counts a worker process keeps, and the longest kept (characters).
MOST_KEPT, LONGEST_KEPT = 350_000, 24
#: Pieces that are cut as arrays: the longest (bytes), and the most at a time.
TOGETHER_BYTES, TOGETHER_PIECES = 48, 1 << 15
#: Characters of texts whose new pieces share a trie.
TOGETHER = 1_000_000
#: Different stretches, and characters of texts, behind which a task hands on partial counts.
MOST_COUNTED, MOST_READ = 400_000, 16_000_000
#: Bytes of frequent stretches that every worker gets, and what an entry takes besides its text.
FREQUENT_BYTES, ENTRY_BYTES = 16_000_000, 16


class Suffixes:
    """The trie of a vocabulary's reversed tokens.

    ``table[(state << 8) + byte]`` is the next state, 0 if there is none; only the first
    ``inner`` states have any. ``ranks`` has the rank of each state that is a token, else -1.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        edges: dict[tuple[int, int], int] = {}
        ends: dict[bytes, int] = {}
        for token in ranks:
            state = 0
            for byte in reversed(token):
                state = edges.setdefault((state, byte), len(edges) + 1)
            ends[token] = state
        inner = sorted({state for state, _ in edges})
        place = {state: i for i, state in enumerate(inner)}
        for state in range(len(edges) + 1):
            place.setdefault(state, len(place))
        self.inner = len(inner)
        self.table = np.zeros(self.inner << 8, np.int32)
        for (state, byte), following in edges.items():
            self.table[(place[state] << 8) + byte] = place[following]
        self.states = {token: place[state] for token, state in ends.items()}
        self.ranks = np.full(len(place), -1, np.int64)
        for token, state in self.states.items():
            self.ranks[state] = ranks[token]


class UnigramCounter:
    """Best cuts of pieces into tokens. Every single byte has to be a token.

    ``counts``: how often the corpus has each rank, each one more than that; without them, the
    scores follow the ranks. ``frequent``: counts and scores of stretches, kept for good.
    """

    def __init__(
        self,
        ranks: dict[bytes, int],
        pattern: str,
        counts: dict[int, int] | None = None,
        frequent: dict[str, tuple[int, int, float]] | None = None,
        suffixes: Suffixes | None = None,
    ) -> None:
        if counts is None:
            total = log(sum(1 / (r + 1) for r in ranks.values()))
            self.scores = {token: -log(r + 1) - total for token, r in ranks.items()}
        else:
            total = log(sum(counts.values()) + len(ranks))
            self.scores = {t: log(counts.get(r, 0) + 1) - total for t, r in ranks.items()}
        self.ranks = ranks
        self.suffixes = suffixes or Suffixes(ranks)
        self._valued: tuple[dict | None, np.ndarray | None] = (None, None)
        #: Lengths worth a look, by the last four bytes; of other ends, only the shortest are.
        longer: dict[bytes, set[int]] = {}
        for token in ranks:
            if len(token) > 3:
                longer.setdefault(token[-4:], set()).add(len(token))
        self.lengths = {end: (2, 3, *sorted(some)) for end, some in longer.items()}
        self.stretches = Stretches(pattern)
        self.frequent = list(frequent or ())
        #: Pieces, tokens and score of what is remembered; ``known`` has the places.
        self.kept = np.zeros((3, len(self.frequent) + MOST_KEPT))
        if self.frequent:
            self.kept[:, : len(self.frequent)] = np.array(list(frequent.values()), np.float64).T
        self._forget()

    def count(
        self, pieces: list[bytes], weights: Iterable[int] = (), used: Counter | None = None
    ) -> list[tuple[int, float]]:
        """Tokens and score of each of some distinct, sorted pieces.

        A depth of the path holds the best score of the prefix and its tokens. Of cuts with
        equal scores, the one with fewer tokens counts, then that with the shorter last token.
        ``used`` gets the ranks of each best cut, as often as the piece's weight says.
        """
        made: list = [(0, 0.0)] * len(pieces)
        weights = list(weights)
        long = [i for i, p in enumerate(pieces) if len(p) > TOGETHER_BYTES]
        short = [i for i, p in enumerate(pieces) if 0 < len(p) <= TOGETHER_BYTES]
        for walk, places, most in ((self._one_by_one, long, TOGETHER_PIECES), (self._by_depth, short, TOGETHER_PIECES)):
            for begin in range(0, len(places), most):
                part = places[begin : begin + most]
                some = [pieces[i] for i in part]
                found = walk(some, [weights[i] for i in part] if used is not None else (), used)
                for i, value in zip(part, found):
                    made[i] = value
        return made

    def _by_depth(
        self, pieces: list[bytes], weights: Iterable[int], used: Counter | None
    ) -> Iterable[tuple[int, float]]:
        """:meth:`count` for all prefixes of one length at a time, as arrays.

        ``path[d]`` has the prefix of length d of each piece, ``best`` and the others have an
        entry for each such prefix. The last tokens to choose from are found along the trie of
        reversed tokens.
        """
        table, inner = self.suffixes.table, self.suffixes.inner
        values, named = self._values(), self.suffixes.ranks
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        width = int(sizes.max())
        letters = np.zeros((len(pieces), width), np.uint8)
        letters[np.arange(width) < sizes[:, None]] = np.frombuffer(b"".join(pieces), np.uint8)
        letters = np.ascontiguousarray(letters.T)
        shared = np.zeros(len(pieces), np.int64)
        same = np.logical_and.accumulate(letters[:, 1:] == letters[:, :-1], axis=0).sum(axis=0)
        shared[1:] = np.minimum(same, np.minimum(sizes[1:], sizes[:-1]))
        path = [np.zeros(len(pieces), np.int64)]
        best, tokens = [np.zeros(1)], [np.zeros(1, np.int64)]
        last, chosen = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
        for end in range(1, width + 1):
            fresh = (sizes >= end) & (shared < end)
            path.append(np.cumsum(fresh) - 1)
            row = np.flatnonzero(fresh)
            at = np.arange(len(row))
            state = table[letters[end - 1][row]]
            before = path[end - 1][row]
            top = best[end - 1][before] + values[state]
            count = tokens[end - 1][before] + 1
            size, token = np.ones(len(row), np.int64), named[state]
            for n in range(2, end + 1):
                on = np.flatnonzero(state < inner)
                if not len(on):
                    break
                at, row = at[on], row[on]
                state = table[(state[on] << 8) + letters[end - n][row]]
                on = np.flatnonzero(state)
                at, row, state = at[on], row[on], state[on]
                before = path[end - n][row]
                score, fewer = best[end - n][before] + values[state], tokens[end - n][before] + 1
                now = top[at]
                won = np.flatnonzero((score > now) | (score == now) & (fewer < count[at]))
                if len(won):
                    to = at[won]
                    top[to], count[to], size[to], token[to] = score[won], fewer[won], n, named[state[won]]
            best.append(top)
            tokens.append(count)
            last.append(size)
            chosen.append(token)
        if used is not None:
            weights, left = np.array(weights, np.int64), sizes.copy()
            sums = np.zeros(int(named.max()) + 1, np.int64)
            for end in range(width, 0, -1):
                here = np.flatnonzero(left == end)
                node = path[end][here]
                np.add.at(sums, chosen[end][node], weights[here])
                left[here] -= last[end][node]
            for rank in np.flatnonzero(sums).tolist():
                used[rank] += int(sums[rank])
        numbers, scores = np.zeros(len(pieces), np.int64), np.zeros(len(pieces))
        for end in range(1, width + 1):
            here = np.flatnonzero(sizes == end)
            node = path[end][here]
            numbers[here], scores[here] = tokens[end][node], best[end][node]
        return zip(numbers.tolist(), scores.tolist())

    def _values(self) -> np.ndarray:
        """The score of each state of the trie; none for those that are no token."""
        if self._valued[0] is not self.scores:
            values = np.full(len(self.suffixes.ranks), -np.inf)
            for token, state in self.suffixes.states.items():
                values[state] = self.scores[token]
            self._valued = self.scores, values
        return self._valued[1]

    def _one_by_one(
        self, pieces: list[bytes], weights: Iterable[int], used: Counter | None
    ) -> list[tuple[int, float]]:
        """:meth:`count` for long pieces."""
        made = []
        best: list[float] = [0.0]
        tokens: list[int] = [0]
        last: list[int] = [0]
        weight = iter(weights)
        before = b""
        scores, lengths, short = self.scores, self.lengths, (2, 3)
        single = [scores[bytes([b])] for b in range(256)]
        for piece in pieces:
            shared = 0
            for a, b in zip(before, piece):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], tokens[shared + 1 :], last[shared + 1 :]
            for end in range(shared + 1, len(piece) + 1):
                top, count = best[-1] + single[piece[end - 1]], tokens[-1] + 1
                size = 1
                for n in lengths.get(piece[end - 4 : end], short) if end > 3 else short:
                    if n > end:
                        break
                    score = scores.get(piece[end - n : end])
                    if score is not None:
                        score += best[end - n]
                        if score > top or score == top and tokens[end - n] + 1 < count:
                            top, count, size = score, tokens[end - n] + 1, n
                best.append(top)
                tokens.append(count)
                last.append(size)
            made.append((tokens[-1], best[-1]))
            if used is not None:
                end, n = len(piece), next(weight)
                while end:
                    used[self.ranks[piece[end - last[end] : end]]] += n
                    end -= last[end]
            before = piece
        return made

    def _forget(self) -> None:
        """Only frequent stretches stay."""
        self.known = dict(zip(self.frequent, range(len(self.frequent))))  # by stretch or piece
        self.held = len(self.frequent)

    def _remember(self, names: list[str], values: np.ndarray) -> None:
        """Keeps the short ones; beyond the bound, the others are forgotten first."""
        short = [i for i, s in enumerate(names) if len(s) <= LONGEST_KEPT]
        if self.held + len(short) > self.kept.shape[1]:
            self._forget()
            short = short[: self.kept.shape[1] - self.held]
        places = range(self.held, self.held + len(short))
        self.held = places.stop
        self.kept[:, places.start : places.stop] = values[:, short]
        self.known.update(zip(map(names.__getitem__, short), places))

    def _recalled(self, names: list[str]) -> tuple[np.ndarray, list[int]]:
        """Values of different stretches or pieces, and which are not known."""
        places = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        return self.kept[:, places], np.flatnonzero(places < 0).tolist()

    def rows(self, some: list[str]) -> np.ndarray:
        """Pieces, tokens and score of stretches, a column for each."""
        rows = joinable([s for s in some if s.startswith(" ")])
        names = [s for row in rows for s in row]
        pieces = [p for row in rows for p in self.stretches.pieces("".join(row))]
        begins = [i for i, p in enumerate(pieces) if p[0] == " "]  # each of these has one space
        left = list(set(some).difference(names))
        for s in left:
            begins.append(len(pieces))
            pieces += self.stretches.pieces(s)
        names += left
        coded = pa.array(pieces, pa.large_string()).dictionary_encode()
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        values, new = self._recalled(different)
        if new:
            data = [p.encode() for p in map(different.__getitem__, new)]
            order = sorted(range(len(new)), key=data.__getitem__)
            counts = np.array(self.count([data[i] for i in order]), np.float64)
            fresh = np.ones((3, len(new)))
            fresh[1:, order] = counts.T
            values[:, new] = fresh
            self._remember(list(map(different.__getitem__, new)), fresh)
        values = values[:, coded.indices.to_numpy()]
        sizes = np.diff([*begins, len(pieces)])
        row = np.repeat(np.arange(len(names)), sizes)
        sums = np.stack([np.bincount(row, part, len(names)) for part in values])  # added in order
        place = dict(zip(names, range(len(names))))
        return sums[:, np.fromiter(map(place.__getitem__, some), np.int64, len(some))]

    def texts(self, texts: list[str]) -> list[tuple[int, int, float]]:
        """Pieces, tokens and score of each text; distinct stretches are counted once."""
        coded = Coded(texts, self.stretches.cut)
        others = [" " + s for s in coded.others]
        values, new = self._recalled(others)
        some = list(map(others.__getitem__, new))
        fresh = self.rows(some + coded.firsts)
        values[:, new] = fresh[:, : len(new)]
        several = np.flatnonzero(fresh[0, : len(new)] > 1).tolist()  # single pieces are kept
        self._remember(list(map(some.__getitem__, several)), fresh[:, several])
        values = np.concatenate([values, fresh[:, len(new) :]], axis=1)
        numbers = values[:2].astype(np.int64)[:, coded.codes]
        sums = np.concatenate([np.zeros((2, 1), np.int64), np.cumsum(numbers, axis=1)], axis=1)
        made = np.diff(sums[:, coded.bounds]).tolist()
        scores, bounds = values[2, coded.codes].tolist(), coded.bounds.tolist()
        made.append([sum(scores[a:b]) for a, b in zip(bounds, bounds[1:])])
        return coded.in_order(list(zip(*made)))


@lru_cache(maxsize=2)
def counter(path: str, pattern: str) -> UnigramCounter:
    """The counter of this worker process whose scores follow the ranks."""
    return UnigramCounter(read_ranks(path), pattern, suffixes=suffixes(path))


@lru_cache(maxsize=1)
def suffixes(path: str) -> Suffixes:
    """The trie of this worker process, whatever the scores."""
    return Suffixes(read_ranks(path))


_fitted: dict[str, UnigramCounter] = {}


def fitted(name: str, path: str, pattern: str, model) -> UnigramCounter:
    """The counter of this worker process by the broadcast ``model`` of that name."""
    if name not in _fitted:
        _fitted.clear()
        _fitted[name] = UnigramCounter(read_ranks(path), pattern, *model.value, suffixes(path))
    return _fitted[name]


def _count(df: DataFrame, make, id_col: str, text_col: str) -> DataFrame:
    def start():
        unigram = make()

        def work(texts: list[str]) -> dict[str, list]:
            made = [row for part in steps(texts, TOGETHER) for row in unigram.texts(texts[part])]
            pieces, tokens, scores = zip(*made)
            return {"n_pieces": pieces, "n_tokens": tokens, "log_score": [round(s, 6) for s in scores]}

        return work

    fields = "n_pieces long, n_tokens long, log_score double"
    return map_texts(df, id_col, text_col, start, fields, as_bytes=False)


def count_tokens(
    df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: ``n_pieces``, ``n_tokens`` and ``log_score`` (6 digits) of the best cut.

    Scores follow the ranks of the vocabulary. Null and empty texts have no pieces, no tokens
    and score 0.
    """
    return _count(df, lambda: counter(path, pattern), id_col, text_col)


def stretch_counts(df: DataFrame, pattern: str, text_col: str = "text") -> DataFrame:
    """``stretch, n``: the different stretches of all texts and how often they occur.

    Tasks hand on partial counts, so a frequent stretch reaches its reducer as a few rows of
    each task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _fitted.clear()  # a worker serves many jobs: the memory of one that is over goes
        cut = Stretches(pattern).cut
        number: Counter[str] = Counter()
        read = 0

        def counted() -> Iterator[pa.RecordBatch]:
            number.pop("", None)  # of empty texts
            arrays = [pa.array(number.keys(), pa.string()), pa.array(number.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["stretch", "n"])
            number.clear()

        for batch in batches:
            for begin in range(0, batch.num_rows, STEP):
                texts = batch.column(0).slice(begin, STEP).to_pylist()
                for part in steps(texts, TOGETHER):
                    coded = Coded(texts[part], cut)
                    uses = np.bincount(coded.codes).tolist()
                    for s, n in zip([*(" " + s for s in coded.others), *coded.firsts], uses):
                        number[s] += n
                    read += sum(map(len, texts[part]))
                    if len(number) > MOST_COUNTED or read > MOST_READ:
                        yield from counted()
                        read = 0
        yield from counted()

    parts = map_batches(df.select(text_of(text_col).alias("text")), run, "stretch string, n long")
    return parts.groupBy("stretch").agg(F.sum("n").alias("n"))


def token_use(counts: DataFrame, path: str, pattern: str) -> dict[int, int]:
    """How often the best cuts of counted stretches, by the first model, use each rank.

    Every different stretch is cut once; what comes to the driver has a row for each token of
    the vocabulary at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unigram = counter(path, pattern)
        used: Counter[int] = Counter()
        pieces: Counter[str] = Counter()

        def cut() -> None:
            rows = sorted((p.encode(), n) for p, n in pieces.items())
            unigram.count([p for p, _ in rows], (n for _, n in rows), used)
            pieces.clear()

        read = 0
        for batch in batches:
            for stretch, n in zip(*(c.to_pylist() for c in batch.columns)):
                for piece in unigram.stretches.pieces(stretch):
                    pieces[piece] += n
                read += len(stretch)
                if len(pieces) > MOST_COUNTED or read > MOST_READ:
                    cut()
                    read = 0
        cut()
        arrays = [pa.array(some, pa.int64()) for some in (used.keys(), used.values())]
        yield pa.RecordBatch.from_arrays(arrays, names=["token", "n"])

    uses = map_batches(counts.select("stretch", "n"), run, "token long, n long")
    return {r.token: r.n for r in uses.groupBy("token").agg(F.sum("n").alias("n")).collect()}


def frequent_stretches(counts: DataFrame, most: int = FREQUENT_BYTES) -> DataFrame:
    """``stretch`` of those whose share of all occurrences is at least their share of ``most`` bytes.

    As shares add up to 1, all of them together have at most ``most`` bytes, whatever the corpus.
    """
    total = counts.agg(F.sum("n").cast("double")).scalar()
    takes = F.octet_length("stretch") + ENTRY_BYTES
    return counts.where(F.col("n") * float(most) >= takes * total).select("stretch")


def score_stretches(stretches: DataFrame, make: Callable[[], UnigramCounter]) -> DataFrame:
    """``stretch, n_pieces, n_tokens, log_score`` of different stretches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unigram = make()
        for batch in batches:
            some = batch.column(0).to_pylist()
            arrays = [pa.array(values).cast(kind) for values, kind in zip(unigram.rows(some), kinds)]
            if some:
                yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    kinds, names = (pa.int64(), pa.int64(), pa.float64()), ["stretch", "n_pieces", "n_tokens", "log_score"]
    return map_batches(stretches, run, "stretch string, n_pieces long, n_tokens long, log_score double")


def count_by_corpus(
    df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """As :func:`count_tokens`, by scores that all texts of ``df`` give.

    A token's probability is one more than its uses in the corpus, over the sum of these. Frequent
    stretches are scored once for all tasks; the others where they stand, in the trie of the texts
    around them. A table without rows gives none; repeated rows count as often as they occur.
    """
    counts = stretch_counts(df, pattern, text_col).sortWithinPartitions("stretch")
    counts = stored(counts, "stretches")
    uses = token_use(counts, path, pattern)

    def model(frequent: dict | None) -> Callable[[], UnigramCounter]:
        shared, name = df.sparkSession.sparkContext.broadcast((uses, frequent)), uuid4().hex
        return lambda: fitted(name, path, pattern, shared)

    scored = score_stretches(frequent_stretches(counts), model(None)).collect()
    return _count(df, model({r[0]: tuple(r[1:]) for r in scored}), id_col, text_col)
