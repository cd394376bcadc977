import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardlens.operators import ranking


def test_quantiles_match_numpy_on_skewed_values(spark):
    draw = np.random.default_rng(3)
    values = np.concatenate([np.full(4000, 7.5), draw.lognormal(3, 2, 6000)])
    frame = pd.DataFrame({"g": (np.arange(10_000) % 10 == 0).astype(int), "v": values})
    df = spark.createDataFrame(frame).repartition(8)
    shares = {"low": 0.0, "p25": 0.25, "p50": 0.5, "p99": 0.99, "high": 1.0}
    counts = ranking.value_counts(df, "v", ("g",))
    rows = {r.g: r for r in ranking.quantiles(counts, "v", shares, ("g",)).collect()}
    for g, part in frame.groupby("g"):
        for name, share in shares.items():
            assert rows[g][name] == pytest.approx(np.quantile(part["v"], share))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5)), min_size=1, max_size=40), st.floats(0.01, 1))
def test_discrete_quantile_and_cdf(spark, values, share):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    counts = ranking.value_counts(df, "v")
    known = sorted(v for v in values if v is not None)
    picked = ranking.quantiles(counts, "v", {"q": share}, discrete=True).first()["q"]
    steps = {r.v: r.cdf for r in ranking.cumulative_distribution(counts, "v").collect()}
    if not known:
        assert picked is None and steps == {}
        return
    assert steps == {v: sum(k <= v for k in known) / len(known) for v in known}
    covering = [v for v in known if sum(k <= v for k in known) >= len(known) * share]
    assert picked == covering[0]


def test_groups_may_be_null_and_values_nan(spark):
    rows = [(None, 1.0), (None, 3.0), (1, float("nan")), (1, 2.0), (1, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    counts = ranking.value_counts(df, "v", ("g",))
    ranked = {(r.g, str(r.v)): (r.before, r.upto, r.total) for r in ranking.running_counts(counts, "v", ("g",)).collect()}
    assert ranked == {
        (None, "1.0"): (0, 1, 2),
        (None, "3.0"): (1, 2, 2),
        (1, "2.0"): (0, 1, 2),
        (1, "nan"): (1, 2, 2),
    }


def test_counted_values_can_be_counted_again(spark):
    df = spark.createDataFrame([(i % 2, float(i % 3)) for i in range(30)], "g int, v double")
    counts = ranking.value_counts(df, "v", ("g",))
    whole = {r.v: r.n for r in ranking.value_counts(counts, "v", weight="n").collect()}
    assert whole == {0.0: 10, 1.0: 10, 2.0: 10}


def test_row_numbers_follow_the_order(spark):
    df = spark.range(0, 5000, 1, 7).withColumn("k", F.pmod(F.xxhash64("id"), F.lit(50)))
    numbered = ranking.number_rows(df, "place", F.desc("k"), "id").collect()
    ordered = sorted(numbered, key=lambda r: (-r.k, r.id))
    assert [r.place for r in ordered] == list(range(5000))


def test_whole_numbers_keep_their_digits(spark):
    big = 2**53
    df = spark.createDataFrame([(big + 1,), (big,), (big + 1,), (big + 2,)], "v bigint")
    counts = ranking.value_counts(df, "v")
    assert {(r.v, r.n) for r in counts.collect()} == {(big, 1), (big + 1, 2), (big + 2, 1)}
    ranked = {r.v: (r.before, r.upto, r.total) for r in ranking.running_counts(counts, "v").collect()}
    assert ranked == {big: (0, 1, 4), big + 1: (1, 3, 4), big + 2: (3, 4, 4)}
    assert ranking.quantiles(counts, "v", {"q": 0.5}, discrete=True).first()["q"] == big + 1
