"""What the optimizer makes of the reports."""

from __future__ import annotations

import contextlib

import pytest
from pyspark.sql import functions as F

from forumlens.operators import clusters, experts, joins, store
from forumlens.plans import reports
from forumlens.session import keep
from forumlens.sources import derived

SF = "/root/testdata/sf0.001"


@contextlib.contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan after adaptive execution has run it."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().execute().count()
    return execution.executedPlan().toString()


@pytest.fixture(scope="module")
def posts(spark):
    return derived.posts(spark, SF)


@pytest.fixture(scope="module")
def xl(spark):
    return keep(derived.posts_xl(spark, SF), "xl")


def test_topk_is_cut_before_the_shuffle(spark, xl):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = plan(reports.experts_report(xl))
    limits = [line for line in text.splitlines() if "WindowGroupLimit" in line]
    assert len(limits) == 2 and "Partial" in limits[1] and "Final" in limits[0]
    # Two pre-aggregates, two for the join, one per count and one per rank
    assert text.count("Exchange hashpartitioning") == 6
    # Each aggregate combines before its shuffle
    assert text.count("partial_") >= 3


def test_no_python_and_no_product(spark, xl, posts):
    points = clusters.points(derived.tag_points(spark, SF))
    users = keep(spark.createDataFrame([(1,)], "user_id bigint"), "users")
    for df in (
        reports.experts_report(xl),
        reports.experts_report_store(xl),
        reports.activity_report(xl),
        reports.activity_report_experts(xl, users),
        reports.features(xl),
        clusters.step(points, [(1, 0, 0, 1), (1, 1, 5, 5), (2, 0, 7, 7)]),
    ):
        text = plan(df)
        for word in ("Python", "Cartesian", "NestedLoop", "ArrowEval"):
            assert word not in text


def test_assignment_needs_no_join_and_no_shuffle(spark):
    points = clusters.points(spark.createDataFrame([("a", 1.0, 2.0)], "tag string, avg_minutes double, popularity double"))
    text = plan(clusters.assign(points, [(1, 0, 0, 1), (1, 1, 5, 5), (2, 0, 7, 7)]))
    assert "Join" not in text and "Exchange" not in text


def test_small_expert_set_is_broadcast_by_its_size(spark, xl):
    users = keep(spark.range(50).select(F.col("id").alias("user_id")), "users")
    given = xl.filter("post_type_id = '2'").select(F.col("owner_user_id").cast("bigint").alias("owner_user_id"))
    semi = joins.semi_experts(given, users)
    assert "BroadcastHashJoin" in plan(semi) and "LeftSemi" in plan(semi)
    wanted = semi.count()
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="1"):
        big = joins.semi_experts(given, users)
        assert "SortMergeJoin" in plan(big) and "BroadcastHashJoin" not in plan(big)
        assert big.count() == wanted


def test_snapshot_is_shuffled_once(spark, xl):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        text = final_plan(reports.experts_report_store(xl))
    assert "ReusedExchange" in text
    # Both sides of the lookup come from one scan of the posts
    ran = text.split("== Initial Plan ==")[0]
    assert ran.count("FileScan parquet") == 1


def test_lookup_uses_the_partitioning_of_the_snapshot(spark, xl):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        snapshot = store.store_posts(xl)
        text = plan(experts.answers_per_tag_user_store(snapshot))
    # snapshot (twice, reused), pre-aggregate, questions by answer id, count
    assert text.count("Exchange hashpartitioning") == 5


def test_a_stored_snapshot_is_not_computed_again(spark, xl):
    """Neither is the newest version of posts whose ids are unique searched for."""
    kept = keep(store.snapshot(xl), "snapshot")
    for df in (
        reports.experts_report_snapshot(kept),
        reports.experts_report_store(xl, unique_ids=True),
        reports.activity_report_snapshot(kept, keep(spark.range(9).select(F.col("id").alias("user_id")), "users")),
        reports.activity_report_experts(xl, keep(spark.range(9).select(F.col("id").alias("user_id")), "users"), unique_ids=True),
    ):
        text = plan(df)
        assert "SortAggregate" not in text and "newest" not in text


def test_tag_lists_stay_whole_up_to_the_count(spark, xl):
    """With unique answers one row per question goes through the shuffles before the join."""
    text = plan(reports.experts_report(xl, unique_ids=True))
    below_join = text[text.index("SortMergeJoin") :]
    assert "Generate explode" in text and "Generate explode" not in below_join


def shuffles(df):
    """Shuffles that ran, those read a second time not counted again."""
    ran = final_plan(df).split("== Initial Plan ==")[0]
    return ran.count("+- Exchange hashpartitioning")


def test_shuffles_per_report(spark, xl):
    users = keep(spark.createDataFrame([(1,)], "user_id bigint"), "users")
    off = "-1"
    with settings(spark, spark__sql__autoBroadcastJoinThreshold=off, spark__sql__adaptive__autoBroadcastJoinThreshold=off):
        assert shuffles(reports.experts_report(xl)) == 6
        assert shuffles(reports.experts_report_store(xl)) == 5
        assert shuffles(reports.experts_report(xl, unique_ids=True)) == 5
        assert shuffles(reports.activity_report(xl)) == 4
        assert shuffles(reports.activity_report(xl, unique_ids=True)) == 3
        assert shuffles(reports.activity_report_experts(xl, users)) == 5
        assert shuffles(reports.features(xl)) == 4
        assert shuffles(reports.features(xl, unique_ids=True)) == 4
    assert shuffles(reports.activity_report_experts(xl, users)) == 3


def test_filters_and_columns_reach_the_scan(spark, xl):
    with settings(spark, spark__sql__maxMetadataStringLength="1000"):
        text = plan(reports.activity_report(xl))
    assert "Not(EqualTo(creation_date,))" in text and "EqualTo(post_type_id,1)" in text
    scans = [line for line in text.splitlines() if "FileScan" in line]
    assert scans and all("accepted_answer_id" not in line for line in scans)


def test_skewed_join_is_split(spark, make_posts):
    """One answer that a third of all questions accept."""
    asked = spark.range(60000).select(
        F.col("id").cast("string").alias("post_id"),
        F.lit("1").alias("post_type_id"),
        F.when(F.col("id") % 3 == 0, "1000000").otherwise((F.col("id") + 1000001).cast("string")).alias("accepted_answer_id"),
        F.lit("2020-01-01T00:00:00.000").alias("creation_date"),
        F.lit("1").alias("owner_user_id"),
        F.concat(F.lit("<t"), (F.col("id") % 100).cast("string"), F.lit(">")).alias("tags"),
        F.lit("").alias("parent_id"),
    )
    given = spark.range(1000000, 1060001).select(
        F.col("id").cast("string").alias("post_id"),
        F.lit("2").alias("post_type_id"),
        F.lit("").alias("accepted_answer_id"),
        F.lit("2020-01-01T00:05:00.000").alias("creation_date"),
        (F.col("id") % 1000).cast("string").alias("owner_user_id"),
        F.lit("").alias("tags"),
        F.lit("1").alias("parent_id"),
    )
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
        spark__sql__shuffle__partitions="16",
    ):
        joined = joins.join_accepted(asked.unionByName(given))
        assert "skew=true" in final_plan(joined)
        assert joined.count() == 60000
