from collections import Counter

import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from cardlens.functions import bands as B
from cardlens.operators import exploration, features, joins, selection
from cardlens.plans import layout
from cardlens.plans.report import plan_text, summarize_plan
from cardlens.session import create_session, scratch_folder


@pytest.fixture
def facts(spark):
    return spark.range(2000).select(
        F.col("id").cast("string").alias("transaction_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("category"),
        (F.col("id") % 50).cast("double").alias("amount"),
        (F.col("id") % 10 == 0).cast("int").alias("is_fraud"),
    )


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_all_lookup_joins_agree(facts):
    dim = facts.groupBy("category").agg(F.avg("amount").alias("mean")).where("category <> 'k3'")
    expected = rows(facts.join(dim, "category", "left").select(*facts.columns, "mean"))
    assert rows(joins.lookup_join(facts, dim, "category")) == expected
    assert rows(joins.merge_lookup(facts, dim, "category")) == expected
    assert rows(joins.salted_lookup(facts, dim, "category", salts=3)) == expected


def test_large_keys_are_cut_by_their_volume(facts):
    gaps = facts.withColumn("category", F.when(F.col("amount") > 20, F.col("category")))
    n = Counter(r.category for r in gaps.collect())
    slices = {r.category: r.slices for r in joins.key_slices(gaps, "category", tasks=10).collect()}
    share = 2000 / 10 / 2
    assert slices == {k: -(-v // share) for k, v in n.items() if v > share}
    assert None in slices and len(slices) < 20
    assert joins.key_slices(facts, "transaction_id", tasks=10).count() == 0
    assert joins.key_slices(facts.limit(0), "category").count() == 0


@pytest.mark.parametrize("tasks", [1, 10, 500])
def test_sliced_join_keeps_rows_without_a_key(facts, tasks):
    gaps = facts.withColumn("category", F.when(F.col("amount") > 20, F.col("category")))
    dim = facts.groupBy("category").agg(F.avg("amount").alias("mean"))
    expected = rows(gaps.join(dim, "category", "left").select(*gaps.columns, "mean"))
    assert rows(joins.sliced_lookup(gaps, dim, "category", tasks=tasks)) == expected
    assert rows(joins.sliced_lookup(gaps.limit(0), dim, "category")) == []


def test_join_strategies(facts, no_broadcast):
    dim = facts.groupBy("category").agg(F.avg("amount").alias("mean"))
    assert summarize_plan(joins.lookup_join(facts, dim, "category")).joins == ("SortMergeJoin",)
    for df in (joins.merge_lookup(facts, dim, "category"), joins.salted_lookup(facts, dim, "category")):
        assert "SortMergeJoin" in summarize_plan(df).joins


def test_small_lookup_is_broadcast(facts):
    dim = facts.groupBy("category").agg(F.avg("amount").alias("mean"))
    assert summarize_plan(joins.lookup_join(facts, dim, "category")).joins == ("BroadcastHashJoin",)


def test_lookup_over_many_partitions_runs_without_a_single_task(spark, no_broadcast):
    facts = spark.range(0, 3000, 1, 40).select(F.col("id").alias("k"), F.col("id").cast("string").alias("transaction_id"))
    dim = spark.range(0, 3000, 1, 30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = joins.lookup_join(facts, dim, "k")
    assert joined.where("v = 2 * k").count() == 3000


def test_band_order_fills_empty_bands(spark):
    df = spark.createDataFrame([(5.0, 1), (None, 0), (5.0, 0)], "merch_distance_km double, is_fraud int")
    assert [tuple(r) for r in exploration.by_distance(df).collect()] == [
        ("< 10 km", 2, 50.0),
        ("10-50 km", None, None),
        ("50-100 km", None, None),
        ("100-300 km", 1, 0.0),
    ]
    groups = df.groupBy(B.DISTANCE_BEHAVIOUR.of(F.col("merch_distance_km")).alias("dist_bin")).count()
    kept = joins.in_band_order(groups, B.DISTANCE_BEHAVIOUR, fill=False)
    assert [r.dist_bin for r in kept.collect()] == ["< 10 km", "> 300 km"]


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "is_fraud int")
    assert {r.is_fraud: r.class_weight for r in joins.class_weights(df).collect()} == {1: 2.0, 0: pytest.approx(4 / 6)}
    single = spark.createDataFrame([(1,), (1,)], "is_fraud int")
    assert rows(joins.with_class_weight(single)) == [(1, 0.5), (1, 0.5)]


def test_top_groups(facts):
    kept = selection.in_top_groups(facts, "category", 2)
    uses = Counter(r.category for r in facts.collect())
    top = sorted(uses, key=lambda c: (-uses[c], c))[:2]
    assert {r.category for r in kept.select("category").distinct().collect()} == set(top)
    assert kept.count() == sum(uses[c] for c in top)
    assert kept.columns == facts.columns


def test_box_includes_its_borders(spark):
    df = spark.createDataFrame([(24.0, -130.0), (50.0, -60.0), (50.1, -60.0), (None, -60.0)], "lat double, long double")
    assert selection.in_box(df).count() == 2


def test_rebalance_and_shrink(facts):
    spread = layout.rebalance(facts, 16)
    assert spread.rdd.getNumPartitions() == 16 and rows(spread) == rows(facts)
    fewer = layout.shrink(spread, 4)
    assert fewer.rdd.getNumPartitions() == 4
    assert summarize_plan(fewer).shuffles == summarize_plan(spread).shuffles
    assert layout.shrink(facts, 100).rdd.getNumPartitions() == facts.rdd.getNumPartitions()


@pytest.mark.parametrize("level", [StorageLevel.MEMORY_AND_DISK, StorageLevel.DISK_ONLY])
def test_reuse_is_released(facts, level):
    with layout.reused(facts, level) as kept:
        assert summarize_plan(kept.groupBy("category").count()).reads_cache
        assert kept.count() == 2000
    assert not facts.is_cached


def test_settings_are_restored(spark, facts):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    groups = facts.groupBy("category").count()

    def run():
        return spark.conf.get("spark.sql.adaptive.enabled"), rows(groups)

    with_it = layout.with_adaptive_execution(spark, True, 40, run)
    without = layout.with_adaptive_execution(spark, False, 40, run)
    assert with_it == ("true", without[1]) and without[0] == "false"
    with pytest.raises(RuntimeError):
        layout.under_settings(spark, {"cardlens.unknown": "1"}, lambda: (_ for _ in ()).throw(RuntimeError()))
    assert spark.conf.get("cardlens.unknown", None) is None
    assert {k: spark.conf.get(k) for k in before} == before


def test_partitions_fit_the_input(spark, facts, monkeypatch):
    path = scratch_folder(spark, "wide")
    facts.write.parquet(path)
    size = layout.stored_bytes(spark, path)
    assert size > 1000
    shuffle, scan = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(shuffle), spark.conf.get(scan)
    assert layout.fitting_settings(spark, path) == {shuffle: before[0]}

    assert layout.partitions_for(size, size / 50.5) == 51 and layout.partitions_for(0) == 1

    large = (1 << 50) // 8
    monkeypatch.setattr(layout, "stored_bytes", lambda spark, path: large)
    assert layout.fitted_to(spark, path, lambda: spark.conf.get(scan)) == f"{1 << 30}b"
    needed = str(large // layout.SHUFFLE_PARTITION_BYTES)
    assert layout.fitted_to(spark, path, lambda: spark.conf.get(shuffle)) == needed
    assert (spark.conf.get(shuffle), spark.conf.get(scan)) == before


def test_salted_totals_equal_plain_ones(facts):
    salted = layout.salted_totals(facts, ["category"], "amount", salts=5)
    plain = facts.groupBy("category").agg(
        F.count("*").alias("tx_count"), F.sum("amount").alias("total"), F.avg("amount").alias("mean")
    )
    assert rows(salted) == rows(plain)


def test_stored_table_is_filtered_and_pruned_in_the_scan(spark, facts):
    path = scratch_folder(spark, "facts")
    facts.withColumn("state", F.lit("X")).withColumn("wide", F.repeat("category", 9)).write.parquet(path)
    plan = summarize_plan(exploration.fraud_by_category_and_state(spark.read.parquet(path)))
    assert "EqualTo(is_fraud,1)" in plan.pushed_filters
    assert sorted(plan.scan_columns) == ["amount", "category", "is_fraud", "state"]
    assert plan.python_stages == 0


def test_feature_expressions_need_no_python(spark, facts):
    df = facts.withColumns({"lat": F.lit(1.0), "long": F.lit(2.0), "merch_lat": F.lit(3.0), "merch_long": F.lit(4.0)})
    plan = plan_text(df.transform(features.add_distance).transform(features.add_amount_shape))
    assert "Python" not in plan and "Exchange" not in plan


def test_session_uses_utc(spark):
    session = create_session("again", settings={"cardlens.flag": "on"})
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"
    assert session.conf.get("cardlens.flag") == "on"
