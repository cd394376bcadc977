import math
import random

import pytest
from conftest import at
from pyspark.sql import Window
from pyspark.sql import functions as F

from cardlens.functions import bands as B
from cardlens.functions import expressions as X
from cardlens.operators import features as ops

SCHEMA = "transaction_id string, card_id string, transaction_ts timestamp_ntz, amount double"


def velocity(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).transform(ops.add_epoch_seconds)
    out = ops.add_velocity(df, **options).collect()
    return {r.transaction_id: (r.card_tx_count_1h, r.card_amount_sum_1h) for r in out}


def brute_force(rows, lookback=3600):
    answer = {}
    for tid, card, ts, _ in rows:
        earlier = [
            (i, a)
            for i, c, t, a in rows
            if c == card and 1 <= (ts - t).total_seconds() <= lookback
        ]
        amounts = [a for _, a in earlier if a is not None]
        answer[tid] = (len(earlier), sum(amounts) if amounts else None)
    return answer


def test_velocity_window_edges(spark):
    rows = [
        ("a", "c", at(0), 1.0),
        ("b", "c", at(0), 2.0),  # same second: neither sees the other
        ("c", "c", at(1), 4.0),
        ("d", "c", at(3600), 8.0),  # still sees second 0
        ("e", "c", at(7201), 16.0),  # 3601 after d
        ("f", "lone", at(5), 32.0),
    ]
    assert velocity(spark, rows) == {
        "a": (0, None),
        "b": (0, None),
        "c": (2, 3.0),
        "d": (3, 7.0),
        "e": (0, None),
        "f": (0, None),
    }


@pytest.mark.parametrize("lookback", [1, 60, 3600, 50_000])
def test_velocity_matches_brute_force_with_a_busy_card(spark, no_broadcast, lookback):
    draw = random.Random(7)
    rows = [
        (str(i), "busy" if i % 3 else f"c{i % 5}", at(draw.randrange(0, 60_000)), float(i % 17))
        for i in range(600)
    ]
    got = velocity(spark, rows, lookback=lookback)
    for tid, (n, spent) in brute_force(rows, lookback).items():
        assert got[tid][0] == n
        assert got[tid][1] == (pytest.approx(spent) if spent is not None else None)


def test_velocity_keeps_unknown_cards_and_amounts(spark):
    rows = [("a", None, at(0), None), ("b", None, at(10), 3.0), ("c", None, at(20), 5.0)]
    assert velocity(spark, rows) == {"a": (0, None), "b": (1, None), "c": (2, 3.0)}


def test_velocity_before_the_epoch(spark):
    rows = [("a", "c", at(-1_800_000_000), 1.0), ("b", "c", at(-1_800_000_000 + 3600), 2.0)]
    assert velocity(spark, rows) == {"a": (0, None), "b": (1, 1.0)}


def test_velocity_ignores_rows_without_time(spark):
    """Unknown times see each other, as they do in a range window, but no known time."""
    rows = [("a", "c", None, 1.0), ("b", "c", None, 2.0), ("c", "c", at(5), 4.0)]
    assert velocity(spark, rows) == {"a": (2, 3.0), "b": (2, 3.0), "c": (0, None)}


def test_velocity_equals_the_sliding_window(spark):
    rows = [(str(i), f"c{i % 3}" if i % 11 else None, at(i * i % 9000), float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA).transform(ops.add_epoch_seconds)
    sliding = Window.partitionBy("card_id").orderBy("tx_unix").rangeBetween(-3600, -1)
    plain = df.select(
        "transaction_id", F.count("transaction_id").over(sliding), F.sum("amount").over(sliding)
    )
    assert velocity(spark, rows) == {r[0]: (r[1], r[2]) for r in plain.collect()}


def test_distance(spark):
    points = [(40.0, -70.0, 41.0, -71.0), (0.0, 0.0, 0.0, 180.0), (10.0, 10.0, 10.0, 10.0)]
    df = spark.createDataFrame([*points, (1.0, None, 2.0, 3.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(X.distance_km(*[F.col(c) for c in "abcd"])).collect()]
    for (lat1, lon1, lat2, lon2), km in zip(points, got):
        p, q = math.radians(lat1), math.radians(lat2)
        angle = math.sin(p) * math.sin(q) + math.cos(p) * math.cos(q) * math.cos(math.radians(lon2 - lon1))
        assert km == pytest.approx(6371 * math.acos(min(1.0, angle)), abs=1e-4)
    assert got[3] is None


def test_age(spark):
    rows = [("1990-06-15", "2024-06-14"), ("1990-06-15", "2024-06-16"), ("15/06/1990", "2024-01-01"), (None, "2024-01-01")]
    df = spark.createDataFrame(rows, "dob string, d string")
    got = [r[0] for r in df.select(X.age_in_years(F.col("dob"), F.col("d").cast("timestamp"))).collect()]
    assert got == [33, 34, None, None]


def test_temporal(spark):
    df = spark.createDataFrame([("a", "c", at(0), 1.0), ("b", "c", None, 1.0)], SCHEMA)
    known, unknown = df.transform(ops.add_temporal).collect()
    # 1 January 2024 was a Monday.
    assert (known.tx_hour, known.tx_day_of_week, known.tx_month, known.tx_is_weekend) == (0, 2, 1, 0)
    assert known.tx_time_of_day == "night" and unknown.tx_time_of_day == "evening"


def test_amount_shape_and_zscore(spark):
    df = spark.createDataFrame([(9.99,), (10.0,), (99.99,), (500.0,), (None,)], "amount double")
    bins = [r.amount_bin for r in df.transform(ops.add_amount_shape).collect()]
    assert bins == ["micro", "small", "small", "large", "large"]
    same = spark.createDataFrame([(3.0,), (3.0,)], "amount double")
    assert [r.amount_zscore for r in same.transform(ops.add_amount_zscore).collect()] == [None, None]
    scores = [r.amount_zscore for r in df.dropna().transform(ops.add_amount_zscore).collect()]
    assert sum(scores) == pytest.approx(0, abs=1e-9)


def test_gender_flag(spark):
    df = spark.createDataFrame([("M",), ("m",), ("F",), (None,)], "gender string")
    assert [r.gender_encoded for r in df.transform(ops.add_cardholder).collect()] == [1, 1, 0, 0]


@pytest.mark.parametrize("threshold", ["-1", "10MB"])
def test_merchant_rate_shuffled_and_broadcast(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    rows = [(str(i), "hot" if i % 3 else "cold", i % 2) for i in range(60)] + [("n", None, 1)]
    df = spark.createDataFrame(rows, "transaction_id string, merchant string, is_fraud int")
    out = ops.add_merchant_rate(df).collect()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(out) == 61
    for r in out:
        peers = [f for _, m, f in rows if m == r.merchant]
        expected = None if r.merchant is None else pytest.approx(sum(peers) / len(peers))
        assert r.merchant_fraud_rate == expected


def test_category_index(spark):
    labels = ["x"] * 3 + ["b"] * 2 + ["a"] * 2 + ["z", "y", None]
    df = spark.createDataFrame([(str(i), c) for i, c in enumerate(labels)], "transaction_id string, category string")
    out = {r.category: r.category_encoded for r in ops.add_category_index(df).collect()}
    assert out == {"x": 0.0, "a": 1.0, "b": 2.0, "y": 3.0, "z": 4.0, None: 5.0}


def test_features_are_optional(spark):
    df = spark.createDataFrame([("a", 1)], "transaction_id string, other int")
    assert ops.feature_table(df).columns == ["transaction_id", "other"]


def test_band_policies_differ_on_missing_values(spark):
    values = [9.99, 10.0, 99.99, 100.0, 299.99, 300.0, None, float("nan"), -1.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")

    def labels(band):
        return [r[0] for r in df.select(band.of(F.col("v"))).collect()]

    assert labels(B.DISTANCE_EXPLORATORY) == [
        "< 10 km", "10-50 km", "50-100 km", "100-300 km", "100-300 km", "100-300 km",
        "100-300 km", "100-300 km", "< 10 km",
    ]
    assert labels(B.DISTANCE_BEHAVIOUR)[3:8] == [
        "100–300 km", "100–300 km", "> 300 km", "> 300 km", "> 300 km"
    ]
    assert labels(B.DISTANCE_TIERS) == [
        "< 10 km", "10-50 km", "50-100 km", "100-300 km", "100-300 km", "> 300 km", None, None, None
    ]


def test_age_bands(spark):
    df = spark.createDataFrame([(v,) for v in (24, 25, 64, 65, None, 200)], "v bigint")
    open_ended = [r[0] for r in df.select(B.AGE_EXPLORATORY.of(F.col("v"))).collect()]
    bounded = [r[0] for r in df.select(B.AGE_TIERS.of(F.col("v"))).collect()]
    assert open_ended == ["Under 25", "25-34", "55-64", "65+", "65+", "65+"]
    assert bounded == ["Under 25", "25-34", "55-64", "65+", None, None]


def test_many_rows_without_a_second_are_joined_in_slices(spark, no_broadcast):
    rows = [(str(i), "c" if i % 2 else None, None, 1.0) for i in range(400)] + [("x", "c", 100, 1.0)]
    df = spark.createDataFrame(rows, "transaction_id string, card_id string, tx_unix bigint, amount double")
    out = {r.transaction_id: (r.card_tx_count_1h, r.card_amount_sum_1h) for r in ops.add_velocity(df).collect()}
    assert len(out) == 401 and out.pop("x") == (0, None)
    assert set(out.values()) == {(200, 200.0)}
