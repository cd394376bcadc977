"""SimHash fingerprints and the classes that near fingerprints form.

Fingerprints are linked by the generalised pigeonhole principle. The 64 bits are grouped into
partitions, correlated bits together. If thresholds t(i) of the partitions add up to the
distance less the number of partitions less one, two fingerprints within the distance differ
by at most t(i) bits in some partition. How many bits each partition may differ by (-1: the
partition is not looked at) is allocated by dynamic programming on estimated candidate counts.
Fingerprints that share a probe form a bucket, where each is verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlens.llm.graphs import components, stored
from cardlens.llm.tables import map_batches, map_texts, named, text_of

BITS = 64
#: Numbers of partitions that the plan chooses from.
PARTITIONS = (2, 3, 4)
#: Bits of a partition that its histogram counts; the others enter as independent bits.
COUNTED_BITS = 16
#: The work of a probe row, in verified candidates.
PROBE_WORK = 30
#: Fingerprints of a bucket that one task takes; larger buckets are split by further bits.
BUCKET = 1 << 18


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 (seed 42) of all word shingles of a text, repeats included.

    Words are what white space separates, A-Z lower-cased. Fewer words than ``size`` make one
    shingle, no words none.
    """
    words = text.lower().split()
    digest = xxhash.xxh64_intdigest
    if len(words) > size:
        rows = zip(*(words[i:] for i in range(size)))
        return np.array([digest(s, 42) for s in map(b" ".join, rows)], np.uint64)
    return np.array([digest(b" ".join(words), 42)] if words else [], np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """A bit is set if it is set in more than half of the hashes."""
    ones = np.zeros(BITS, np.int64)
    for begin in range(0, len(hashes), 1 << 14):
        some = hashes[begin : begin + (1 << 14)].astype("<u8")
        bits = np.unpackbits(some.view(np.uint8), bitorder="little").reshape(-1, BITS)
        ones += bits.sum(axis=0, dtype=np.int64)
    chosen = ones * 2 > len(hashes)
    return int(np.packbits(chosen, bitorder="little").view("<i8")[0])


def fingerprints(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3
) -> DataFrame:
    """Per row: ``simhash``, a 64-bit integer; 0 for a text without words."""

    def start():
        def work(texts: list[bytes]) -> dict[str, list]:
            return {"simhash": [simhash(shingle_hashes(t, shingle)) for t in texts]}

        return work

    return map_texts(df, id_col, text_col, start, "simhash long")


def _unsigned(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False).view(np.uint64)


def bit_counts(prints: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each pair of bits, in how many both are set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS))
        for batch in batches:
            some = _unsigned(batch, "simhash").astype("<u8")
            bits = np.unpackbits(some.view(np.uint8), bitorder="little").reshape(-1, BITS)
            bits = bits.astype(np.float32)
            both += bits.T @ bits
            n += len(some)
        counts = np.concatenate([[n], both.ravel()]).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(counts), dtype=np.int32)), pa.array(counts)], names=["at", "n"]
        )

    rows = map_batches(prints.select("simhash"), run, "at int, n long")
    counts = np.zeros(1 + BITS * BITS)
    for row in rows.groupBy("at").agg(F.sum("n").alias("n")).collect():
        counts[row["at"]] = row["n"]
    return int(counts[0]), counts[1:].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """The bits of each of ``parts`` partitions of about equal width.

    A partition begins with the free bit most correlated to the others and takes on the free
    bit most correlated to those it has, until it is full.
    """
    share = np.diag(both) / max(n, 1)
    joint = both / max(n, 1) - np.outer(share, share)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    related = np.abs(joint / np.outer(spread, spread))
    np.fill_diagonal(related, 0)
    free = set(range(BITS))
    groups = []
    for part in range(parts):
        width = BITS // parts + (part < BITS % parts)
        left = sorted(free)
        group = [left[int(np.argmax(related[np.ix_(left, left)].sum(axis=1)))]]
        while len(group) < width:
            left = sorted(free.difference(group))
            group.append(left[int(np.argmax(related[np.ix_(left, group)].sum(axis=1)))])
        free.difference_update(group)
        groups.append(group)
    return groups


def values_of(prints: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each fingerprint, the first one lowest."""
    made = np.zeros(len(prints), np.uint64)
    for place, bit in enumerate(bits):
        made |= ((prints >> np.uint64(bit)) & np.uint64(1)) << np.uint64(place)
    return made


def histograms(prints: DataFrame, layouts: list[list[list[int]]]) -> dict[tuple[int, int], np.ndarray]:
    """By layout and partition: fingerprints by value of up to ``COUNTED_BITS`` of its bits."""
    wanted = [
        (i, j, bits[:COUNTED_BITS]) for i, layout in enumerate(layouts) for j, bits in enumerate(layout)
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(wanted), 1 << COUNTED_BITS), np.int64)
        for batch in batches:
            some = _unsigned(batch, "simhash")
            for k, (_, _, bits) in enumerate(wanted):
                counts[k] += np.bincount(
                    values_of(some, bits).astype(np.int64), minlength=1 << COUNTED_BITS
                )
        for k, row in enumerate(counts):
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), k, np.int32)), pa.array(at.astype(np.int32)), pa.array(row[at])],
                names=["k", "at", "n"],
            )

    rows = map_batches(prints.select("simhash"), run, "k int, at int, n long")
    found = rows.groupBy("k", "at").agg(F.sum("n").alias("n")).toArrow()
    made = {}
    for k, (i, j, _) in enumerate(wanted):
        mine = found.filter(pa.compute.equal(found["k"], k))
        made[i, j] = np.zeros(1 << COUNTED_BITS)
        made[i, j][mine["at"].to_numpy()] = mine["n"].to_numpy()
    return made


def estimated_candidates(histogram: np.ndarray, others: np.ndarray, most: int) -> list[float]:
    """Ordered pairs that differ by at most 0, 1, ... ``most`` bits in a partition.

    ``others``: the share of set bits of each bit that the histogram leaves out.
    """
    place = np.arange(len(histogram))
    width = len(histogram).bit_length() - 1
    exact = []
    for distance in range(most + 1):
        total = 0.0
        for flips in combinations(range(width), distance):
            total += float(histogram @ histogram[place ^ sum(1 << f for f in flips)])
        exact.append(total)
    apart = np.zeros(most + 1)
    apart[0] = 1.0
    for share in others:
        differ = 2 * share * (1 - share)
        apart[1:] = apart[1:] * (1 - differ) + apart[:-1] * differ
        apart[0] *= 1 - differ
    by_distance = np.convolve(exact, apart)[: most + 1]
    return np.cumsum(by_distance).tolist()


def allocate(costs: list[list[float]], units: int) -> tuple[float, list[int]]:
    """The cheapest way to hand ``units`` to the partitions, by dynamic programming.

    ``costs[i][u]`` is the work of partition i with u units; u units mean threshold u - 1.
    """
    best: list[tuple[float, list[int]]] = [(0.0, [])] + [(np.inf, [])] * units
    for row in costs:
        best = [
            min(
                (
                    (best[total - u][0] + row[u], [*best[total - u][1], u])
                    for u in range(total + 1)
                    if u < len(row)
                ),
                key=lambda x: x[0],
            )
            for total in range(units + 1)
        ]
    return best[units]


def plan(prints: DataFrame, distance: int) -> list[tuple[list[int], int]]:
    """Bits and threshold of each partition that is probed."""
    n, both = bit_counts(prints)
    share = np.diag(both) / max(n, 1)
    layouts = [group_bits(n, both, parts) for parts in PARTITIONS]
    counts = histograms(prints, layouts)
    chosen = None
    for i, layout in enumerate(layouts):
        costs = []
        for j, bits in enumerate(layout):
            most = min(distance, 2)
            pairs = estimated_candidates(counts[i, j], share[bits[COUNTED_BITS:]], most)
            probes = np.cumsum([comb(len(bits), d) for d in range(most + 1)])
            costs.append([0.0, *(p + PROBE_WORK * n * q for p, q in zip(pairs, probes))])
        work, units = allocate(costs, distance + 1)
        if np.isfinite(work) and (chosen is None or work < chosen[0]):
            chosen = (work, [(bits, u - 1) for bits, u in zip(layout, units) if u])
    if chosen is None:  # a large distance: a bit per unit would do, all pairs in one bucket is worse
        raise ValueError(f"no plan for distance {distance}")
    return chosen[1]


def linked(bucket: np.ndarray, distance: int) -> Iterator[tuple[int, np.ndarray]]:
    """Links within ``distance`` that connect what is connected in a bucket.

    Flood fill: what lies near a fingerprint leaves the bucket and is searched from next, so
    a dense bucket shrinks fast. A fingerprint gets at most one link, not one for each pair.
    """
    if len(bucket) <= 48:
        near = np.bitwise_count(bucket[:, None] ^ bucket[None, :]) <= distance
        if np.count_nonzero(near) == len(bucket):
            return
    rest = bucket
    while len(rest) > 1:
        seed, rest = rest[0], rest[1:]
        front = [seed]
        while front and len(rest):
            near = np.bitwise_count(rest ^ front.pop()) <= distance
            if near.any():
                found = rest[near]
                rest = rest[~near]
                front.extend(found)
                yield seed, found


def _masks(bits: list[int], threshold: int) -> np.ndarray:
    """All ways to flip at most ``threshold`` of a partition's bits, by place in its value."""
    return np.array(
        [
            sum(1 << f for f in flips)
            for distance in range(threshold + 1)
            for flips in combinations(range(len(bits)), distance)
        ],
        np.uint64,
    )


def probes(prints: DataFrame, partitions: list[tuple[list[int], int]]) -> DataFrame:
    """``part, value, simhash``: each fingerprint under every value near its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = _unsigned(batch, "simhash")
            for part, (bits, threshold) in enumerate(partitions):
                own = values_of(some, bits)
                for mask in _masks(bits, threshold):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(some), part, np.int32)),
                            pa.array((own ^ mask).view(np.int64)),
                            batch.column("simhash"),
                        ],
                        names=["part", "value", "simhash"],
                    )

    return map_batches(prints.select("simhash"), run, "part int, value long, simhash long")


def _split(members: DataFrame, partitions: list[list[int]], pieces: int) -> tuple[DataFrame, list[list[int]]]:
    """Members of large buckets under keys with some more bits each.

    Fingerprints of a bucket within the distance agree in one of ``pieces`` = distance + 1
    groups of whatever bits. So each bucket is dealt out once for each group of the bits that
    are not part of its key yet, and the group's bits join the key.
    """
    split = []
    for bits in partitions:
        free = [b for b in range(BITS) if b not in bits]
        split.append([free[i::pieces] for i in range(pieces)])
    key_bits = [sorted({*bits, *extra}) for bits, groups in zip(partitions, split) for extra in groups]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("part").to_numpy(zero_copy_only=False)
            prints = _unsigned(batch, "simhash")
            old = _unsigned(batch, "value")
            for part, groups in enumerate(split):
                mine = np.flatnonzero(parts == part)
                for k, extra in enumerate(groups if len(mine) else []):
                    more = values_of(prints[mine], extra)
                    # keys may meet by chance: all members of a bucket are verified
                    value = (old[mine] * np.uint64(0x9E3779B97F4A7C15)) ^ more
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(mine), part * pieces + k, np.int32)),
                            pa.array(value.view(np.int64)),
                            pa.array(prints[mine].view(np.int64)),
                        ],
                        names=["part", "value", "simhash"],
                    )

    return map_batches(members, run, "part int, value long, simhash long"), key_bits


def _verified(members: DataFrame, distance: int) -> DataFrame:
    """Links of all buckets; each task reads its buckets one after the other."""
    buckets = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = members.repartition(buckets, "part", "value").sortWithinPartitions("part", "value")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = values = prints = None

        def links(last: bool) -> pa.RecordBatch:
            nonlocal parts, values, prints
            change = np.flatnonzero((np.diff(parts) != 0) | (values[1:] != values[:-1])) + 1
            cuts = np.concatenate([[0], change, [len(parts)] if last else []]).astype(np.int64)
            a: list[np.ndarray] = []
            b: list[np.ndarray] = []
            sizes = np.diff(cuts)
            for k in np.flatnonzero(sizes > 1):
                for seed, found in linked(prints[cuts[k] : cuts[k + 1]], distance):
                    a.append(np.full(len(found), seed, np.uint64))
                    b.append(found)
            rest = cuts[-1]
            parts, values, prints = parts[rest:], values[rest:], prints[rest:]
            none = [np.zeros(0, np.uint64)]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x or none).view(np.int64)) for x in (a, b)], names=["a", "b"]
            )

        for batch in batches:
            new = (
                batch.column("part").to_numpy(zero_copy_only=False),
                batch.column("value").to_numpy(zero_copy_only=False),
                _unsigned(batch, "simhash"),
            )
            if parts is None:
                parts, values, prints = new
            else:
                parts, values, prints = (
                    np.concatenate(x) for x in zip((parts, values, prints), new)
                )
            yield links(last=False)
        if parts is not None:
            yield links(last=True)

    return map_batches(dealt, run, "a long, b long")


def link_classes(prints: DataFrame, distance: int = 3, bucket: int = BUCKET) -> DataFrame:
    """``node, root`` of distinct fingerprints that have a link to another one.

    Buckets larger than ``bucket`` are split by further bits, again and again; a bucket whose
    key has b bits holds at most 2 to the power 64 - b distinct fingerprints, which bounds it.
    """
    partitions = plan(prints, distance)
    bits = [b for b, _ in partitions]
    members = stored(probes(prints, partitions), "probes")
    links = None
    while True:
        large = None
        if prints.count() > bucket:  # else no bucket can be larger
            sizes = members.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
            large = stored(sizes.where(F.col("n") > bucket).select("part", "value"), "large")
            if large.isEmpty() or min(BITS - len(b) for b in bits) <= distance:
                large = None
        small = members if large is None else members.join(large, ["part", "value"], "left_anti")
        found = _verified(small, distance)
        links = found if links is None else links.union(found)
        if large is None:
            return components(links)
        members, bits = _split(members.join(large, ["part", "value"]), bits, distance + 1)
        members = stored(members, "probes")


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    distance: int = 3,
    bucket: int = BUCKET,
) -> DataFrame:
    """Per row: ``simhash`` and ``component_id``, the least id that links lead to, its own included.

    Equal fingerprints are linked, and those that differ by at most ``distance`` bits. Texts
    without words have fingerprint 0 and are linked like others. Rows without an id take part;
    a class of such rows alone has a null ``component_id``.
    """
    prints = stored(fingerprints(df, id_col, text_col, shingle), "prints").withColumnRenamed(
        id_col, "id"
    )
    distinct = stored(
        prints.groupBy("simhash").agg(F.min("id").alias("least")), "distinct"
    )
    roots = link_classes(distinct, distance, bucket)
    rooted = distinct.join(
        roots.select(F.col("node").alias("simhash"), "root"), "simhash", "left"
    ).select("simhash", "least", F.coalesce("root", "simhash").alias("root"))
    rooted = stored(rooted, "rooted")
    classes = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = rooted.join(classes, "root").select("simhash", "component_id")
    return prints.join(by_print, "simhash").select(
        named("id").alias(id_col), "simhash", "component_id"
    )


def keep_one_per_class(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    distance: int = 3,
) -> DataFrame:
    """One row of each class of near duplicates, all columns as they are.

    The row of the least id stays; rows without an id come last. Of rows that repeat an id, the
    one whose text has the least hash stays, of equal rows any one.
    """
    text = text_of(text_col)
    key = [
        F.xxhash64(named(id_col), text).alias("ka"),
        F.xxhash64(F.lit("second"), named(id_col), text).alias("kb"),
    ]
    rank = F.struct(named(id_col).isNull().alias("none"), named(id_col).alias("id"), *key)
    found = near_duplicates(
        docs.select(rank.alias("rank"), text.alias("text")), "rank", "text", shingle, distance
    )
    first = found.where(F.col("rank") == F.col("component_id")).select("rank.ka", "rank.kb").distinct()
    # the input's columns travel inside a struct, so that none clashes with the keys
    rows = docs.select(F.struct(*map(named, docs.columns)).alias("row"), *key)
    kept = rows.join(first, ["ka", "kb"], "left_semi")
    repeat = F.row_number().over(Window.partitionBy("ka", "kb").orderBy("ka"))
    return kept.withColumn("repeat", repeat).where("repeat = 1").select(
        *[F.col("row").getField(n).alias(n) for n in docs.columns]
    )
