import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cardlens.llm import simhash
from cardlens.llm.graphs import components
from text_tables import by_id, docs  # noqa: F401


def plain_simhash(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or (
        [b" ".join(words)] if words else []
    )
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def classes(prints, distance=3):
    """Least key of each class, by comparing all pairs."""
    keys = list(prints)
    values = np.array([prints[k] for k in keys], np.int64).view(np.uint64)
    parent = list(range(len(keys)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(keys)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= distance) + i + 1:
            parent[find(int(j))] = find(i)
    least = {}
    for i, k in enumerate(keys):
        least[find(i)] = min(least.get(find(i), k), k)
    return {k: least[find(i)] for i, k in enumerate(keys)}


def near(base, bits, rng):
    for b in rng.sample(range(64), bits):
        base ^= 1 << b
    return base


def made_prints(n, seed):
    """Chains and dense groups of fingerprints among random ones."""
    rng = random.Random(seed)
    prints = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(25):
        x = rng.choice(prints)
        for _ in range(rng.randint(1, 12)):
            x = near(x, rng.randint(1, 5), rng)
            prints.append(x)
    centre = rng.getrandbits(64)
    prints += [near(centre, rng.randint(0, 4), rng) for _ in range(300)]
    return [p - (1 << 64) if p >> 63 else p for p in dict.fromkeys(prints)]


def test_fingerprints_of_texts(docs, by_id):
    rows = [(1, "A b\tC d é"), (2, "a B c\nD é"), (3, None), (4, ""), (5, "one two"), (6, "One\x0bTwo"),
            (7, "x y z"), (8, "w " * 40000), (None, "q r s t")]
    found = by_id(simhash.fingerprints(docs(rows)), "simhash")
    assert found == {i: (plain_simhash(t),) for i, t in rows}
    # Spark's own function is the same hash
    spark = docs(rows).sparkSession
    own = spark.range(1).select(F.xxhash64(F.lit("a b é"))).first()[0]
    assert simhash.shingle_hashes("a b é".encode(), 3).view(np.int64)[0] == own


@pytest.mark.parametrize("parts", [2, 3, 4])
def test_all_links_are_found_for_any_plan(spark, monkeypatch, parts):
    monkeypatch.setattr(simhash, "PARTITIONS", (parts,))
    prints = made_prints(1500, parts)
    table = spark.createDataFrame([(p,) for p in prints], "simhash long").repartition(4)
    found = {r.node: r.root for r in simhash.link_classes(table).collect()}
    expected = classes({p: p for p in prints})
    assert {p: found.get(p, p) for p in prints} == expected


def test_large_buckets_are_split(spark):
    prints = made_prints(600, 9)
    table = spark.createDataFrame([(p,) for p in prints], "simhash long").repartition(4)
    found = {r.node: r.root for r in simhash.link_classes(table, bucket=20).collect()}
    assert {p: found.get(p, p) for p in prints} == classes({p: p for p in prints})


def test_allocation_is_the_cheapest():
    costs = [[0.0, 5.0, 9.0], [0.0, 1.0, 20.0], [0.0, 3.0, 4.0]]
    every = [
        (costs[0][a] + costs[1][b] + costs[2][c], [a, b, c])
        for a in range(3) for b in range(3) for c in range(3) if a + b + c == 4
    ]
    assert simhash.allocate(costs, 4) == min(every)


def test_estimates_count_exactly_what_the_histogram_has():
    values = [0, 0, 1, 3, 7]
    histogram = np.bincount(values, minlength=8).astype(float)
    pairs = [(a ^ b).bit_count() for a in values for b in values]
    expected = [float(sum(p <= d for p in pairs)) for d in range(3)]
    assert simhash.estimated_candidates(histogram, np.array([]), 2) == expected


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(200)]
    hub = [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 1299), (7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain + hub, "a long, b long")).collect()}
    assert {found[i] for i in range(201)} == {0}
    assert {found[i] for i in range(1000, 1300)} == {1000} and found[5000] == 1000
    assert len(found) == 201 + 300 + 1


def test_classes_of_documents(docs, by_id):
    words = [f"word{i}" for i in range(400)]
    rows = [(10, " ".join(words)), (3, " ".join(words)), (7, " ".join([*words[:-1], "other"]))]
    rows += [(20, "nothing alike here at all"), (21, None), (22, ""), (23, " \n"), (None, " ".join(words))]
    rows += [(10, " ".join(words))]
    found = simhash.near_duplicates(docs(rows)).collect()
    assert len(found) == len(rows)
    expected = classes({(i if i is not None else 10**9, k): plain_simhash(t) for k, (i, t) in enumerate(rows)})
    least = {i: expected[(i if i is not None else 10**9, k)][0] for k, (i, _) in enumerate(rows)}
    assert {(r.doc_id, r.component_id) for r in found} == set(least.items())
    assert {r.component_id for r in found if r.doc_id in (21, 22, 23)} == {21}


def test_one_of_each_class_stays(docs):
    text = " ".join(f"word{i}" for i in range(300))
    rows = [(4, text), (2, text), (2, text), (None, text), (9, "else entirely now"), (None, "no id here"), (None, "no id here")]
    table = docs(rows)
    kept = simhash.keep_one_per_class(table)
    assert kept.columns == table.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [
        (0, "no id here"), (2, text), (9, "else entirely now"),
    ]


def test_no_rows(docs):
    assert simhash.near_duplicates(docs([])).count() == 0
    assert simhash.keep_one_per_class(docs([])).count() == 0
