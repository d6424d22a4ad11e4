"""Keyed snapshots: the newest version of every post."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.functions import parse_date
from forumlens.operators.validity import typed, valid_posts_activity_store, valid_posts_store
from forumlens.sources.posts import ANSWER

# A post has no version number, so the newest is the one with the latest date,
# then the greatest owner; both are compared as the text they are.
VERSION = ("creation_date", "owner_user_id")


def latest_posts(
    posts: DataFrame, key: str = "post_id", order_by: Sequence[str] = VERSION
) -> DataFrame:
    """One row per ``key``: the greatest by ``order_by``, then by the other columns.

    An aggregate and not a window: each task keeps one row per key before the
    shuffle, so a post with any number of copies costs one row per task, and
    the result stays partitioned by ``key`` for the join that follows.
    """
    rest = [c for c in posts.columns if c != key and c not in order_by]
    newest = posts.groupBy(key).agg(F.max(F.struct(*order_by, *rest)).alias("newest"))
    return newest.select(
        *[key if c == key else F.col(f"newest.{c}").alias(c) for c in posts.columns]
    )


STORE_COLUMNS = ("post_id", "post_type_id", "accepted_answer_id", "creation_date", "owner_user_id", "tags")
ACTIVITY_COLUMNS = ("post_id", "post_type_id", "owner_user_id", "tags", "creation_date", "parent_id")


def snapshot(
    posts: DataFrame, valid: Callable[[DataFrame], DataFrame] = valid_posts_store, order_by: Sequence[str] = VERSION
) -> DataFrame:
    """The newest version of every post that is ``valid``, with all its columns.

    ``valid`` is ``valid_posts_store`` for the lookups of the experts and
    ``valid_posts_activity_store`` for the activity reports. ``order_by`` names the
    columns, compared as they are, whose greatest values make a version the newest.
    """
    return latest_posts(valid(posts), order_by=order_by)


def write_snapshot(posts: DataFrame, path: str, **options) -> None:
    """Store the snapshot of ``posts``, which reports then read without computing it again."""
    snapshot(posts, **options).write.parquet(path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def upsert_snapshot(spark: SparkSession, path: str, posts: DataFrame, into: str, **options) -> None:
    """Store at ``into`` the snapshot at ``path`` with newer versions and new posts of ``posts``.

    The stored one stays as it is, so that its readers and a failed run do no harm.
    """
    stored = read_snapshot(spark, path)
    fresh = posts.select([F.col(c).cast(t) for c, t in stored.dtypes])
    write_snapshot(stored.unionByName(fresh), into, **options)


def store_view(newest: DataFrame) -> DataFrame:
    """A snapshot in the columns of the lookups."""
    return typed(newest.select(*STORE_COLUMNS))


def activity_view(newest: DataFrame) -> DataFrame:
    """A snapshot in the five columns the activity reports need.

    Answers have a date and a parent but no tags, all others tags only.
    """
    is_answer = F.col("post_type_id").eqNullSafe(ANSWER)
    return (
        typed(newest.select(*ACTIVITY_COLUMNS))
        .select(
            "post_id",
            "post_type_id",
            "owner_user_id",
            F.when(~is_answer, F.col("tags")).alias("tags"),
            F.when(is_answer, F.col("creation_date")).alias("creation_date"),
            F.when(is_answer, F.col("parent_id")).alias("parent_id"),
        )
        .withColumn("created", parse_date("creation_date"))
    )


def _newest(posts: DataFrame, columns: Sequence[str], order_by: Sequence[str], unique_ids: bool) -> DataFrame:
    if unique_ids:
        return posts.select(*columns)
    needed = [*columns, *[c for c in order_by if c not in columns]]
    return latest_posts(posts.select(*needed), order_by=order_by)


def store_posts(posts: DataFrame, order_by: Sequence[str] = VERSION, unique_ids: bool = False) -> DataFrame:
    """The newest version of each question and answer, in the columns of the lookups.

    ``unique_ids`` saves the search for it where ids are known to be unique.
    """
    return store_view(_newest(valid_posts_store(posts), STORE_COLUMNS, order_by, unique_ids))


def activity_store(posts: DataFrame, order_by: Sequence[str] = VERSION, unique_ids: bool = False) -> DataFrame:
    """The newest version of every post, in the five columns the activity reports need."""
    return activity_view(_newest(valid_posts_activity_store(posts), ACTIVITY_COLUMNS, order_by, unique_ids))
