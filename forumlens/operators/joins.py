"""Questions joined with answers, answers with experts, tags with popularity.

The joins here return one row per matching pair of posts, which is what they
are asked for. The reports count instead of listing pairs and so go through
``experts``, ``activity`` and ``response``, where both sides are aggregated
before they meet. Plain equi joins on purpose: adaptive execution splits a
partition that one post id makes too large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.functions import minutes_between, parse_date, present, time_slot
from forumlens.functions.dates import TIME_SLOTS
from forumlens.operators.validity import (
    answers,
    questions,
    valid_posts_accepted,
    valid_posts_activity,
)


def join_accepted(posts: DataFrame, on_bad_date: int | None = None) -> DataFrame:
    """Each question with its accepted answer: (user_id, tags, minutes, question_id).

    Repeated ids are kept, so two questions with one answer give two rows.
    """
    valid = valid_posts_accepted(posts)
    asked = questions(valid).select(
        F.col("post_id").alias("question_id"),
        F.col("accepted_answer_id").alias("answer_id"),
        "tags",
        parse_date("creation_date").alias("asked"),
    )
    given = answers(valid).select(
        F.col("post_id").alias("answer_id"),
        F.col("owner_user_id").alias("user_id"),
        parse_date("creation_date").alias("answered"),
    )
    return asked.join(given, "answer_id").select(
        "user_id",
        "tags",
        minutes_between("asked", "answered", on_bad_date).alias("minutes"),
        "question_id",
    )


def join_parent(posts: DataFrame, slots: int = TIME_SLOTS) -> DataFrame:
    """Each question with each of its answers: (tags, slot)."""
    valid = valid_posts_activity(posts)
    asked = questions(valid).select("post_id", "tags")
    given = answers(valid).select(
        "parent_id", time_slot(parse_date("creation_date"), slots).alias("slot")
    )
    return asked.join(
        given.filter(F.col("slot").isNotNull()), F.col("post_id") == F.col("parent_id")
    ).select("tags", "slot")


def store_sides(store: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Owned questions (answer_id, tags, question_id) and owned posts (answer_id, user_id).

    The accepted answer may be a stored post of any type.
    """
    owned = store.filter(F.col("owner_user_id").isNotNull())
    asked = questions(owned).filter(F.col("accepted_answer_id").isNotNull())
    return (
        asked.select(
            F.col("accepted_answer_id").alias("answer_id"), "tags", F.col("post_id").alias("question_id")
        ),
        owned.select(F.col("post_id").alias("answer_id"), F.col("owner_user_id").alias("user_id")),
    )


def join_accepted_store(store: DataFrame) -> DataFrame:
    """Each stored question with its accepted answer: (user_id, tags, question_id).

    Give it a snapshot that was written as a table. Then both sides reach the
    join through a shuffle of their own, and adaptive execution can split an
    answer that very many questions accept.
    """
    asked, given = store_sides(store)
    return asked.join(given, "answer_id").select("user_id", "tags", "question_id")


def semi_experts(given: DataFrame, experts: DataFrame) -> DataFrame:
    """The rows whose owner is an expert.

    No hint: with ``experts`` read from a table, as ``session.keep`` gives it,
    the optimizer knows its size and broadcasts it if it is below
    ``spark.sql.autoBroadcastJoinThreshold``; otherwise both sides are shuffled
    and adaptive execution splits a user with very many answers.
    """
    users = experts.select(F.col("user_id").alias("owner_user_id"))
    return given.join(users, "owner_user_id", "left_semi")


def tag_features(avg_minutes: DataFrame, popularity: DataFrame) -> DataFrame:
    """(tag, avg_minutes, popularity); NULL where a side lacks the tag."""
    return avg_minutes.join(popularity, "tag", "full").select("tag", "avg_minutes", "popularity")


def complete_features(features: DataFrame) -> DataFrame:
    """The tags that have both numbers, the input of clustering."""
    return features.filter(
        present("tag") & F.col("avg_minutes").isNotNull() & F.col("popularity").isNotNull()
    )
