import numpy as np
import pytest
from conftest import at
from pyspark.sql import functions as F

from cardlens.operators import exploration, portfolio, quality, sampling, selection
from cardlens.operators import statistics as stats


@pytest.fixture(scope="module")
def tx(spark):
    """500 rows; one merchant has a third of them; some keys, labels and amounts are missing."""
    rows = [
        (
            str(i),
            at(i * 7001),
            f"c{i % 9}" if i % 50 else None,
            "fraud_hot" if i % 3 == 0 else f"fraud_m{i % 4}",
            float(i % 97) * 3.5 if i % 41 else None,
            (1 if i % 13 == 0 else 0) if i % 61 else None,
            "abc"[i % 3],
            f"S{i % 4}" if i % 30 else None,
            "F" if i % 2 else "M",
        )
        for i in range(1, 501)
    ]
    return spark.createDataFrame(
        rows,
        "transaction_id string, transaction_ts timestamp_ntz, card_id string, merchant string, "
        "amount double, is_fraud int, category string, state string, gender string",
    )


@pytest.fixture(scope="module")
def pdf(tx):
    return tx.toPandas()


def test_exploratory_groups_keep_null_keys_and_portfolio_drops_them(tx):
    assert exploration.busiest_states(tx).where("state IS NULL").count() == 1
    assert portfolio.by_state(tx, floor=1).where("state IS NULL").count() == 0


def test_portfolio_measures_match_pandas(tx, pdf):
    groups = pdf.dropna(subset=["state"]).groupby("state")
    for r in portfolio.by_state(tx, floor=1).collect():
        part = groups.get_group(r.state)
        stolen = part[part.is_fraud == 1].amount.sum()
        assert (r.total, r.fraud) == (part.is_fraud.count(), part.is_fraud.sum())
        assert r.avg_amount == pytest.approx(part.amount.mean())
        assert r.fraud_amount == pytest.approx(stolen)
        assert r.fraud_rate == pytest.approx(part.is_fraud.sum() / part.is_fraud.count() * 100)


def test_group_without_labels_or_frauds(spark):
    df = spark.createDataFrame([("a", None, 5.0), ("b", 0, 5.0)], "category string, is_fraud int, amount double")
    a, b = portfolio.by_category(df).collect()
    assert (a.total, a.fraud_rate, a.fraud_amount) == (0, None, 0.0)
    assert (b.total, b.fraud_rate, b.fraud_amount) == (1, 0.0, 0.0)


def test_kpis_match_pandas(tx, pdf):
    k = portfolio.kpis(tx).first()
    fraud = pdf[pdf.is_fraud == 1]
    assert (k.total_tx, k.fraud_tx) == (500, fraud.shape[0])
    assert (k.unique_cards, k.unique_merchants) == (pdf.card_id.nunique(), pdf.merchant.nunique())
    assert k.cards_with_fraud == fraud.card_id.nunique()
    assert k.total_spend == pytest.approx(pdf.amount.sum())
    assert k.fraud_amount_avg == pytest.approx(fraud.amount.mean())
    assert (k.first_month, k.last_month) == ("Jan 2024", "Feb 2024")
    assert k.fraud_loss_pct == pytest.approx(fraud.amount.sum() / pdf.amount.sum() * 100)


def test_detection_value_is_truncated(spark):
    df = spark.createDataFrame([(1, 100.0)] * 30 + [(0, 5.0)], "is_fraud int, amount double")
    v = portfolio.detection_value(df, recall=0.9, precision=0.8).first()
    assert (v.exposure, v.caught, v.false_positives) == (3000.0, 2700.0, 6)
    assert v.missed == pytest.approx(300.0)


def test_merchant_marks_and_names(tx, pdf):
    rates = pdf.groupby("merchant").is_fraud.agg(lambda x: x.sum() / x.count() * 100)
    marks = portfolio.merchant_rate_marks(tx, floor=20).first()
    assert marks.avg_fraud_rate == pytest.approx(rates.mean())
    assert marks.p90_fraud_rate == pytest.approx(rates.quantile(0.9))
    names = {r.merchant_short for r in portfolio.riskiest_merchants(tx).collect()}
    assert names == {"hot", "m0", "m1", "m2", "m3"}


def test_high_velocity_cards(tx, pdf):
    per_card = pdf.groupby("card_id").is_fraud.count()
    mark = int(per_card.quantile(0.99))
    r = portfolio.high_velocity_cards(tx).first()
    assert tuple(r) == (mark, int((per_card >= mark).sum()))


def test_heatmap_has_all_hours(tx, pdf):
    cells = portfolio.weekday_hour_heatmap(tx)
    assert cells.columns == ["tx_dow", *[f"h{h}" for h in range(24)]]
    dow, hour = pdf.transaction_ts.dt.dayofweek, pdf.transaction_ts.dt.hour
    expected = (pdf.groupby([dow, hour]).is_fraud.mean() * 100).to_dict()
    for r in cells.collect():
        for h in range(24):
            assert r[f"h{h}"] == pytest.approx(np.nan_to_num(expected.get((r.tx_dow, h), 0.0)))


def test_monthly_trend_matches_polyfit(tx):
    months = portfolio.by_month(tx).collect()
    fit = np.polyval(np.polyfit([m.t for m in months], [m.total_spend for m in months], 1), [m.t for m in months])
    assert [m.spend_trend for m in months] == pytest.approx(list(fit))


def test_amount_by_label_matches_pandas(tx, pdf):
    for r in exploration.amount_by_label(tx).where("is_fraud IS NOT NULL").collect():
        part = pdf[pdf.is_fraud == r.is_fraud].amount
        assert r["mean"] == pytest.approx(part.mean(), abs=0.006)
        assert r["std"] == pytest.approx(part.std(), abs=0.006)
        for name, share in (("p25", 0.25), ("median", 0.5), ("p95", 0.95)):
            covering = np.quantile(part.dropna(), share, method="inverted_cdf")
            assert r[name] == pytest.approx(covering)
    assert exploration.amount_by_label(tx).where("is_fraud IS NULL").first()["median"] is not None


def test_class_balance_without_fraud(spark):
    r = exploration.class_balance(spark.createDataFrame([(0,)], "is_fraud int")).first()
    assert (r.fraud_rate_pct, r.legit_per_fraud) == (0.0, None)


def test_histogram_keeps_every_row(tx, pdf):
    bins = stats.histogram(tx, "amount", 12).collect()
    for label in (0, 1):
        part = pdf[(pdf.is_fraud == label)].amount.dropna()
        counts, edges = np.histogram(part, bins=12)
        got = {r.bin: r for r in bins if r.is_fraud == label}
        assert sum(r.n for r in got.values()) == len(part)
        assert sum(r.density for r in got.values()) * (edges[1] - edges[0]) == pytest.approx(1)
        for b, r in got.items():
            assert r.bin_start == pytest.approx(edges[b])
    same = tx.withColumn("amount", F.lit(2.0)).withColumn("is_fraud", F.lit(1))
    assert [(r.bin, r.n) for r in stats.histogram(same, "amount", 5).collect()] == [(0, 500)]


def test_clipped_five_numbers(tx, pdf):
    kept = pdf[pdf.amount <= pdf.amount.quantile(0.99)]
    for r in stats.clipped_five_numbers(tx).where("is_fraud IS NOT NULL").collect():
        part = kept[kept.is_fraud == r.is_fraud].amount
        assert (r["min"], r["max"]) == (part.min(), part.max())
        assert r["median"] == pytest.approx(part.median())


def test_outliers(tx, pdf):
    q1, q3 = pdf.amount.quantile([0.25, 0.75])
    r = stats.iqr_outliers(tx, reach=0.2).first()
    above = pdf.amount > q3 + 0.2 * (q3 - q1)
    assert r.upper_fence == pytest.approx(q3 + 0.2 * (q3 - q1))
    assert (r.outliers, r.fraud_outliers) == (above.sum(), (above & (pdf.is_fraud == 1)).sum())
    z = ((pdf.amount - pdf.amount.mean()) / pdf.amount.std()).abs() > 1.5
    r = stats.zscore_outliers(tx, limit=1.5).first()
    assert tuple(r) == (z.sum(), (z & (pdf.is_fraud == 1)).sum())


def test_correlations_agree_with_spark_ml(spark):
    df = spark.createDataFrame(
        [(float(i), float(i * i % 17), float(i % 5)) for i in range(60)], "a double, b double, c double"
    )
    own = {(r.col_a, r.col_b): r.r for r in stats.correlation_matrix(df, df.columns).collect()}
    ml = {(r.col_a, r.col_b): r.r for r in stats.vector_correlation_matrix(df, df.columns).collect()}
    assert own == pytest.approx(ml)
    constant = df.withColumn("c", F.lit(1.0))
    matrix = {(r.col_a, r.col_b): r.r for r in stats.correlation_matrix(constant, df.columns).collect()}
    assert matrix["a", "c"] is None and matrix["c", "c"] is None and matrix["a", "a"] == 1.0


def test_quality_reports(tx, pdf):
    nulls = {r.column_name: r.null_count for r in quality.null_report(tx).collect()}
    expected = pdf.isna().sum()
    assert nulls == {c: n for c, n in expected.items() if n}
    audit = quality.audit(tx, high=300.0).first()
    assert audit.null_amount == expected["amount"]
    assert audit.non_positive_amount == (pdf.amount <= 0).sum()
    assert audit.high_amount == (pdf.amount > 300).sum()
    coverage = {r.feature: r for r in quality.feature_coverage(tx.withColumn("tx_hour", F.lit(1))).collect()}
    assert coverage["tx_hour"].present and coverage["tx_hour"].filled_rows == 500
    assert not coverage["amount_bin"].present
    assert quality.fraud_alert(tx, 5.0).first().alert and not quality.fraud_alert(tx, 50.0).first().alert


def test_hash_samples_ignore_the_layout(tx):
    one = {r[0] for r in sampling.sample(tx, 0.3).select("transaction_id").collect()}
    two = {r[0] for r in sampling.sample(tx.repartition(7, "amount"), 0.3).select("transaction_id").collect()}
    assert one == two and 100 < len(one) < 200
    assert 0 < sampling.layout_sample(tx, 0.5).count() < 500


def test_fixed_size_sample_is_exact(tx, spark):
    assert sampling.fixed_size_sample(tx, 500).count() == 500
    picked = sampling.fixed_size_sample(tx, 20).select("transaction_id").collect()
    everything = tx.orderBy(sampling.hash_position(42, "transaction_id")).select("transaction_id").limit(20).collect()
    assert {r[0] for r in picked} == {r[0] for r in everything}
    big = spark.range(20_000).select(F.col("id").cast("string").alias("transaction_id"))
    assert sampling.fixed_size_sample(big, 100).count() == 100


def test_splits_are_a_partition_of_the_rows(tx):
    parts = sampling.split(tx, (0.6, 0.2, 0.2))
    ids = [r[0] for p in parts for r in p.select("transaction_id").collect()]
    assert sorted(ids) == sorted(r[0] for r in tx.select("transaction_id").collect())
    train, test = sampling.stratified_split(tx)
    for label in (0, 1):
        n, held = (selection.with_label(p, label).count() for p in (train, test))
        assert 0.65 < n / (n + held) < 0.92
    assert train.count() + test.count() == tx.where("is_fraud IS NOT NULL").count()


def test_union_matches_columns_by_name(tx):
    a, b = tx.select("transaction_id", "amount"), tx.select("amount", "transaction_id")
    assert sampling.union([a, b]).count() == 1000
    assert sampling.distinct_pairs(tx, "category", "gender").count() == 6


def test_approximate_distinct_counts(spark):
    df = spark.range(50_000).select((F.col("id") % 20_000).alias("k"))
    approximate = portfolio.approximate_distinct_counts(df, ["k"], 0.02).first()[0]
    assert abs(approximate - 20_000) <= 3 * 0.02 * 20_000
    assert portfolio.distinct_counts(df, ["k"]).first()[0] == 20_000
