"""At what time of day a tag is answered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.functions import parse_date, present, slot_label, split_tags, time_slot
from forumlens.functions.dates import TIME_SLOTS, check_slots
from forumlens.operators.joins import semi_experts
from forumlens.operators.validity import answers, explode_tags, questions, valid_posts_activity


def slot_column(slot: int) -> str:
    return f"slot{slot}"


def _slots(wide: DataFrame) -> list[int]:
    return sorted(int(c[4:]) for c in wide.columns if c.startswith("slot") and c[4:].isdigit())


def count_slots(tag_slots: DataFrame) -> DataFrame:
    """Answers per (tag, slot) of joined rows (tags, slot)."""
    return explode_tags(tag_slots).groupBy("tag", "slot").agg(F.count("*").alias("answers"))


def answers_per_parent(given: DataFrame, slots: int = TIME_SLOTS) -> DataFrame:
    """Answers per slot, one column each, of every parent_id; needs ``created``.

    One row per question and task goes into the shuffle, however many answers
    the question has.
    """
    slot = time_slot("created", slots)
    return (
        given.filter(F.col("created").isNotNull())
        .groupBy("parent_id")
        .agg(*[F.count_if(slot == i).alias(slot_column(i)) for i in range(check_slots(slots))])
    )


def _per_tag(asked: DataFrame, per_parent: DataFrame) -> DataFrame:
    """Answers per slot of every tag, from questions (post_id, tags, asked).

    Both sides grow with the posts, so neither is broadcast; the answers are
    already partitioned by their parent.
    """
    columns = [slot_column(i) for i in _slots(per_parent)]
    joined = asked.join(per_parent.hint("merge"), F.col("post_id") == F.col("parent_id"))
    weighted = joined.select("tags", *[(F.col("asked") * F.col(c)).alias(c) for c in columns])
    return explode_tags(weighted).groupBy("tag").agg(*[F.sum(c).alias(c) for c in columns])


def activity_of_all(
    posts: DataFrame, slots: int = TIME_SLOTS, unique_ids: bool = False
) -> DataFrame:
    """(tag, slot0, slot1, ...): answers by anyone.

    Copies of a question are combined before the join. ``unique_ids`` saves that
    shuffle; it is for posts whose ids are known to be unique.
    """
    valid = valid_posts_activity(posts)
    asked = questions(valid).select("post_id", "tags")
    if unique_ids:
        asked = asked.withColumn("asked", F.lit(1))
    else:
        asked = asked.groupBy("post_id", "tags").agg(F.count("*").alias("asked"))
    given = answers(valid).select("parent_id", parse_date("creation_date").alias("created"))
    return _per_tag(asked, answers_per_parent(given, slots))


def activity_of_experts(store: DataFrame, experts: DataFrame, slots: int = TIME_SLOTS) -> DataFrame:
    """(tag, slot0, slot1, ...): answers by ``experts`` (user_id), from the activity store.

    The parent may be a stored post of any type that has tags. An answer without
    parent in the store is left out.
    """
    given = answers(store).filter(F.col("parent_id").isNotNull())
    return activity_of_sides(store.select("post_id", "tags"), given, experts, slots)


def activity_of_sides(asked: DataFrame, given: DataFrame, experts: DataFrame, slots: int = TIME_SLOTS) -> DataFrame:
    """The same from posts (post_id, tags), each once, and answers (owner_user_id, parent_id, created)."""
    by_experts = semi_experts(given.select("owner_user_id", "parent_id", "created"), experts)
    tagged = asked.filter(present("tags")).withColumn("asked", F.lit(1))
    return _per_tag(tagged, answers_per_parent(by_experts, slots))


def _slot_pair(slot: int) -> Column:
    return F.struct(F.lit(slot).alias("slot"), F.col(slot_column(slot)).alias("answers"))


def activity_counts(wide: DataFrame) -> DataFrame:
    """(tag, slot, answers), one row per slot that has answers."""
    pairs = F.array(*[_slot_pair(i) for i in _slots(wide)])
    return wide.select("tag", F.inline(pairs)).filter(F.col("answers") > 0)


def activity_histogram(wide: DataFrame) -> DataFrame:
    """Lines ``tag,TimeSlot0:n,TimeSlot1:n,...`` without the empty slots."""
    parts = [
        F.when(
            F.col(slot_column(i)) > 0,
            F.concat(slot_label(F.lit(i)), F.lit(":"), F.col(slot_column(i)).cast("string")),
        )
        for i in _slots(wide)
    ]
    any_answer = sum((F.col(slot_column(i)) for i in _slots(wide)), F.lit(0))
    return wide.filter(any_answer > 0).select(
        "tag", F.concat_ws(",", "tag", *parts).alias("histogram")
    )


def activity_map(wide: DataFrame) -> DataFrame:
    """(tag, activity): a map from slot to answers without the empty slots."""
    pairs = F.array(*[F.when(F.col(slot_column(i)) > 0, _slot_pair(i)) for i in _slots(wide)])
    return wide.select("tag", F.map_from_entries(F.array_compact(pairs)).alias("activity"))


def tag_popularity(posts: DataFrame) -> DataFrame:
    """Questions per tag; a question that repeats a tag counts once."""
    asked = questions(valid_posts_activity(posts))
    return (
        asked.select(F.explode(F.array_distinct(split_tags("tags"))).alias("tag"))
        .groupBy("tag")
        .agg(F.count("*").alias("popularity"))
    )
