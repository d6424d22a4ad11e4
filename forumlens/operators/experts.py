"""Who answers best, per tag."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlens.operators.joins import store_sides
from forumlens.operators.validity import answers, explode_tags, questions, valid_posts_accepted

# Fixed value: the number of experts per tag
TOP_K = 5


def count_answers(joined: DataFrame) -> DataFrame:
    """Answers per (tag, user_id) of joined rows (user_id, tags, ...)."""
    return explode_tags(joined.select("user_id", "tags")).groupBy("tag", "user_id").agg(
        F.count("*").alias("answers")
    )


def _count_pairs(asked: DataFrame, given: DataFrame) -> DataFrame:
    """Answers per (tag, user_id) from (answer_id, tag, asked) and (answer_id, user_id, given).

    A question met by ``given`` copies of its answer counts ``asked * given``
    times. As both sides hold a combination once, a post id gives at most one
    row per (tag, user_id) of the result, however many copies it has. Both
    sides grow with the posts, so neither is broadcast.
    """
    return (
        asked.join(given.hint("merge"), "answer_id")
        .groupBy("tag", "user_id")
        .agg(F.sum(F.col("asked") * F.col("given")).alias("answers"))
    )


def _asked_tags(asked: DataFrame) -> DataFrame:
    """Questions per (answer_id, tag)."""
    return (
        explode_tags(asked.select("answer_id", "tags"))
        .groupBy("answer_id", "tag")
        .agg(F.count("*").alias("asked"))
    )


def count_unique(asked: DataFrame, given: DataFrame) -> DataFrame:
    """Answers per (tag, user_id) where each occurs once, from (answer_id, tags) and (answer_id, user_id).

    A question then meets one answer at most, so its tag list can stay whole up
    to the count: one row per question goes through each shuffle, not one per tag.
    """
    lists = asked.groupBy("answer_id", "tags").agg(F.count("*").alias("asked"))
    joined = lists.join(given.hint("merge"), "answer_id").select("user_id", "tags", "asked")
    return explode_tags(joined).groupBy("tag", "user_id").agg(F.sum("asked").alias("answers"))


def answers_per_tag_user(posts: DataFrame, unique_ids: bool = False) -> DataFrame:
    """Accepted answers per (tag, user_id), without listing the joined pairs.

    Copies of an answer are combined before the join. ``unique_ids`` saves that
    shuffle; it is for posts whose ids are known to be unique.
    """
    valid = valid_posts_accepted(posts)
    asked = questions(valid).select(F.col("accepted_answer_id").alias("answer_id"), "tags")
    given = answers(valid).select(
        F.col("post_id").alias("answer_id"), F.col("owner_user_id").alias("user_id")
    )
    if unique_ids:
        return count_unique(asked, given)
    given = given.groupBy("answer_id", "user_id").agg(F.count("*").alias("given"))
    return _count_pairs(_asked_tags(asked), given)


def answers_per_tag_user_store(store: DataFrame) -> DataFrame:
    """The same from a snapshot, where each post occurs once."""
    asked, given = store_sides(store)
    return count_unique(asked.select("answer_id", "tags"), given)


def topk_experts(counts: DataFrame, k: int = TOP_K) -> DataFrame:
    """The first ``k`` users per tag: (tag, rank, user_id, answers).

    Among equals the lower user id comes first. Spark cuts each task's share of
    a tag to ``k`` rows before the shuffle, so a popular tag stays small.
    """
    order = Window.partitionBy("tag").orderBy(F.desc("answers"), F.asc("user_id"))
    return (
        counts.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("tag", "rank", "user_id", "answers")
    )


def experts_list(experts: DataFrame) -> DataFrame:
    """(tag, experts): the ranked user ids of a tag as ``u1,u2,...``; ``k`` ids at most."""
    ids = F.expr("listagg(CAST(user_id AS STRING), ',') WITHIN GROUP (ORDER BY rank)")
    return experts.groupBy("tag").agg(ids.alias("experts"))
