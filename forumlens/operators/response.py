"""How long a tag waits for an accepted answer.

An id with one question, or with one answer, is joined plainly. For the others the mean
lists no pairs of posts. Let a question have the whole minute ``A`` and
the rest ``ra``, an answer ``B`` and ``rb``. Their minutes, truncated toward zero,
are ``B - A``, less one if ``rb < ra``, and one more if the answer is earlier and
``rb <> ra``. Summed over all answers of a question that is

    sum(B) - n * A + (answers earlier in time) - (answers earlier by rest, then time)

so sums and two ranks suffice. A rank is counted within buckets first, hours for
the one and rests for the other, and then over the buckets, so that an id with
very many dates is dealt over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.functions import minutes_between, parse_date
from forumlens.operators.validity import answers, explode_tags, questions, valid_posts_accepted
from forumlens.session import keep


def mean_minutes(joined: DataFrame) -> DataFrame:
    """(tag, avg_minutes) of joined rows (tags, minutes, ...)."""
    return _mean(joined.select("tags", "minutes", F.lit(1).alias("pairs")))


def _mean(rows: DataFrame) -> DataFrame:
    """Mean of ``minutes`` per tag, each row standing for ``pairs``, truncated toward zero."""
    known = rows.filter(F.col("minutes").isNotNull())
    return _divided(known.select("tags", (F.col("minutes") * F.col("pairs")).alias("total"), "pairs"))


def _divided(rows: DataFrame) -> DataFrame:
    """(tag, avg_minutes): the sums of ``total`` by those of ``pairs``."""
    return (
        explode_tags(rows)
        .groupBy("tag")
        .agg(F.sum("total").alias("total"), F.sum("pairs").alias("pairs"))
        .filter("pairs > 0")
        .select("tag", F.expr("cast(total div pairs as bigint)").alias("avg_minutes"))
    )


def _millis(date: str) -> Column:
    """Milliseconds since year 0, the first that a date can have."""
    past = F.col(date) - F.expr("timestamp_ntz'0000-01-01 00:00:00'")
    return (past.cast("interval second").cast("decimal(18,3)") * 1000).cast("bigint")


def _big(number: str) -> Column:
    """A number whose products with others do not overflow."""
    return F.col(number).cast("decimal(19,0)")


def many_by_many(asked: DataFrame, given: DataFrame) -> DataFrame | None:
    """(answer_id) of the ids with two rows or more on both sides, as a table; None if there are none.

    Most posts have no such id, and then only the questions are looked at.
    """
    often = keep(_repeated(asked), "asked-often")
    if often.isEmpty():
        return None
    both = keep(_repeated(given.join(often, "answer_id", "left_semi")), "many")
    return None if both.isEmpty() else both


def _repeated(rows: DataFrame) -> DataFrame:
    return rows.groupBy("answer_id").agg(F.count("*").alias("rows")).where("rows > 1").select("answer_id")


def avg_minutes_per_tag(posts: DataFrame, on_bad_date: int | None = None, unique_ids: bool = False) -> DataFrame:
    """Mean minutes from question to accepted answer per tag.

    An id with one question or one answer takes a plain join, which has no more rows than
    the posts. Only ids with several of both are counted by date and go through sums and
    ranks: with ``n`` dates as question and ``m`` as answer they cost ``n + m`` rows, not
    their product. ``unique_ids`` saves the search for such ids; it is for posts whose ids
    are known to be unique. ``on_bad_date=-1`` lets unreadable dates enter the mean as
    minus one minute; by default they are left out.
    """
    valid = valid_posts_accepted(posts)
    created = parse_date("creation_date").alias("date")
    asked = questions(valid).select(F.col("accepted_answer_id").alias("answer_id"), "tags", created)
    given = answers(valid).select(F.col("post_id").alias("answer_id"), created)
    many = None if unique_ids else many_by_many(asked.select("answer_id"), given.select("answer_id"))
    few = asked if many is None else asked.join(many, "answer_id", "left_anti")
    # Both sides grow with the posts, so neither is broadcast
    met = few.join(given.withColumnRenamed("date", "answered").hint("merge"), "answer_id")
    pairs = met.select("tags", minutes_between("date", "answered", on_bad_date).alias("total"), F.lit(1).cast("bigint").alias("pairs"))
    pairs = pairs.where("total IS NOT NULL")
    if many is None:
        return _divided(pairs)
    ranked = _many_sums(asked.join(many, "answer_id", "left_semi"), given.join(many, "answer_id", "left_semi"), on_bad_date)
    return _divided(ranked.unionByName(pairs.select("tags", *[F.col(c).cast("decimal(38,0)").alias(c) for c in ("total", "pairs")])))


def _many_sums(asked: DataFrame, given: DataFrame, on_bad_date: int | None) -> DataFrame:
    """(tags, total, pairs) of questions (answer_id, tags, date) and answers (answer_id, date) of any number."""
    none = F.lit(0).cast("bigint")
    asked = (
        asked.groupBy("answer_id", "tags", "date")
        .agg(F.count("*").alias("questions"))
        .select("answer_id", "tags", "date", "questions", none.alias("answers"))
    )
    given = (
        given.groupBy("answer_id", "date")
        .agg(F.count("*").alias("answers"))
        .select("answer_id", F.lit(None).cast("string").alias("tags"), "date", none.alias("questions"), "answers")
    )
    both = asked.unionByName(given)
    if on_bad_date is None:
        both = both.filter(F.col("date").isNotNull())
    return _sums(both.withColumn("at", _millis("date")), on_bad_date)


def _sums(both: DataFrame, on_bad_date: int | None) -> DataFrame:
    """(tags, total, pairs) of questions and answers, which have (answer_id, tags, at, questions, answers).

    Every row counts in a bucket of either order: by time in its hour, and by the
    rest of the minute, then time, in its rest. Rows without a time have a bucket
    of their own in the first.
    """
    orders = F.when(F.col("at").isNull(), F.array(F.lit("time"))).otherwise(F.array(F.lit("time"), F.lit("rest")))
    in_buckets = both.withColumn("by", F.explode(orders)).withColumn(
        "bucket", F.when(F.col("by") == "time", F.expr("at div 3600000")).otherwise(F.expr("at % 60000"))
    )
    # Questions come before answers of their time, which are not earlier
    within = Window.partitionBy("answer_id", "by", "bucket").orderBy("at", F.col("tags").isNull())
    earlier = F.sum("answers").over(within.rowsBetween(Window.unboundedPreceding, 0))
    counted = in_buckets.withColumn("earlier", earlier)
    known, minute = F.col("at").isNotNull(), F.expr("at div 60000")
    reduced = counted.groupBy("answer_id", "by", "bucket", "tags").agg(
        F.sum("questions").alias("questions"),
        F.sum("answers").alias("answers"),
        F.sum(_big("questions") * minute).alias("asked_minutes"),
        F.sum(_big("answers") * minute).alias("given_minutes"),
        F.sum(_big("questions") * F.when(known, F.col("earlier"))).alias("earlier"),
    )
    dated = F.when(F.col("bucket").isNotNull(), F.col("answers"))
    of_id = Window.partitionBy("answer_id", "by")
    before = of_id.orderBy("bucket").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    own = Window.partitionBy("answer_id", "by", "bucket")
    whole = (
        reduced.withColumn("before", F.coalesce(F.sum(dated).over(before), F.lit(0)) - F.coalesce(F.sum(dated).over(own), F.lit(0)))
        .withColumn("dated", F.coalesce(F.sum(dated).over(of_id), F.lit(0)))
        .withColumn("undated", F.sum("answers").over(of_id) - F.col("dated"))
        .withColumn("given_minutes", F.coalesce(F.sum("given_minutes").over(of_id), F.lit(0)))
        .filter(F.col("tags").isNotNull() & (F.col("dated") + F.col("undated") > 0))
    )
    rank = F.col("earlier") + _big("questions") * _big("before")
    differences = _big("questions") * F.col("given_minutes") - F.col("asked_minutes") * _big("dated")
    bad = F.lit(0 if on_bad_date is None else on_bad_date)
    total = (
        F.when(F.col("by") == "rest", -rank)
        .when(F.col("bucket").isNull(), bad * _big("questions") * (_big("dated") + _big("undated")))
        .otherwise(differences + rank + bad * _big("questions") * _big("undated"))
    )
    pairs = F.when(F.col("by") == "time", _big("questions") * (_big("dated") + _big("undated"))).otherwise(0)
    return whole.select("tags", total.cast("decimal(38,0)").alias("total"), pairs.cast("decimal(38,0)").alias("pairs"))
