"""Which posts take part in which report.

The rules return ids as BIGINT and the date as text (a date that is present but
unreadable does not make a post invalid). The rules of the keyed stores type
the key only, because the newest version is found by comparing text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.functions import as_id, split_tags
from forumlens.sources.posts import ANSWER, QUESTION

_IDS = ("post_id", "accepted_answer_id", "owner_user_id", "parent_id")


def typed(posts: DataFrame, ids: Sequence[str] = _IDS) -> DataFrame:
    """Ids that are text as numbers; an id that is no number counts as missing."""
    return posts.select(
        *[as_id(c).alias(c) if c in ids and kind == "string" else F.col(c) for c, kind in posts.dtypes]
    )


_IDENTIFIED = f"post_type_id IN ('{QUESTION}', '{ANSWER}') AND post_id IS NOT NULL AND creation_date <> ''"
_IS_QUESTION = f"post_type_id = '{QUESTION}'"
_IS_ANSWER = f"post_type_id = '{ANSWER}'"


def valid_posts_accepted(posts: DataFrame) -> DataFrame:
    """Questions with tags and an accepted answer, and answers with an owner."""
    return typed(posts).where(
        f"""{_IDENTIFIED} AND (
            ({_IS_QUESTION} AND accepted_answer_id IS NOT NULL AND tags <> '')
            OR ({_IS_ANSWER} AND owner_user_id IS NOT NULL))"""
    )


def valid_posts_activity(posts: DataFrame) -> DataFrame:
    """Questions with tags, and answers with an owner and a parent."""
    return typed(posts).where(
        f"""{_IDENTIFIED} AND (
            ({_IS_QUESTION} AND tags <> '')
            OR ({_IS_ANSWER} AND parent_id IS NOT NULL AND owner_user_id IS NOT NULL))"""
    )


def valid_posts_store(posts: DataFrame) -> DataFrame:
    """All questions and answers that have an id."""
    return typed(posts, ["post_id"]).where(
        f"post_type_id IN ('{QUESTION}', '{ANSWER}') AND post_id IS NOT NULL"
    )


def valid_posts_activity_store(posts: DataFrame) -> DataFrame:
    """Answers, and posts of any other or no type that have tags."""
    return typed(posts, ["post_id"]).where(
        f"post_id IS NOT NULL AND ({_IS_ANSWER} OR tags <> '')"
    )


def questions(posts: DataFrame) -> DataFrame:
    return posts.where(_IS_QUESTION)


def answers(posts: DataFrame) -> DataFrame:
    return posts.where(_IS_ANSWER)


def parse_or_drop(rows: DataFrame, column: str) -> DataFrame:
    """``column`` as BIGINT; rows where it is no whole number are dropped."""
    return rows.withColumn(column, as_id(column)).filter(F.col(column).isNotNull())


def explode_tags(rows: DataFrame, tags: str = "tags") -> DataFrame:
    """One row per tag in column ``tag``, in place of the tag list."""
    return rows.select(
        *[c for c in rows.columns if c != tags], F.explode(split_tags(tags)).alias("tag")
    )
