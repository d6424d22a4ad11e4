"""Forum posts and tag points derived from whole event, order and line item tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _date_text(ts: Column) -> Column:
    """yyyy-MM-dd'T'HH:mm:ss.SSS of a timestamp without zone, in any session zone."""
    text = ts.cast("string")
    millis = F.rpad(F.substring(text, 21, 3), 3, "0")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."), millis)


def _minute_text(ts: Column, minutes: Column) -> Column:
    """The same for a whole second, ``minutes`` later."""
    later = ts + minutes * F.expr("INTERVAL '1' MINUTE")
    return F.concat(F.replace(later.cast("string"), F.lit(" "), F.lit("T")), F.lit(".000"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth event is a question, the next three are its answers.

    Some rows break each of the rules a post must keep.
    """
    n = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("int")
    is_question = n % 4 == 0
    events = _table(spark, sf_dir, "events").withColumn("fourth", F.floor(n / 4))
    return events.select(
        n.cast("string").alias("post_id"),
        F.when(n % 101 == 100, "3").when(is_question, "1").otherwise("2").alias("post_type_id"),
        F.when(~is_question | (n % 20 == 16), "")
        .otherwise((n + 1 + F.col("fourth") % 3).cast("string"))
        .alias("accepted_answer_id"),
        F.when(n % 103 == 102, "bad-date").otherwise(_date_text(F.col("ts"))).alias("creation_date"),
        F.when(n % 97 == 96, "").otherwise(F.col("user_id").cast("string")).alias("owner_user_id"),
        F.when(~is_question | (n % 89 == 88), "")
        .otherwise(F.concat(F.lit("<"), "event_type", F.lit("><k"), (k % 10).cast("string"), F.lit(">")))
        .alias("tags"),
        F.when(is_question, "").otherwise((n - n % 4).cast("string")).alias("parent_id"),
    )


def posts_xl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as questions and line items as answers; answer ids repeat."""
    order_key, cust_key = F.col("o_orderkey"), F.col("o_custkey")
    asked = _table(spark, sf_dir, "orders").select(
        order_key.cast("string").alias("post_id"),
        F.lit("1").alias("post_type_id"),
        (order_key * 10 + 100000001).cast("string").alias("accepted_answer_id"),
        _minute_text(F.col("o_orderdate"), cust_key % 1440).alias("creation_date"),
        cust_key.cast("string").alias("owner_user_id"),
        F.concat(
            F.lit("<"),
            F.lower(F.substring("o_orderpriority", 3, 100)),
            F.lit("><s"),
            (cust_key % 50).cast("string"),
            F.lit(">"),
        ).alias("tags"),
        F.lit("").alias("parent_id"),
    )
    line_key = F.col("l_orderkey")
    answered = _table(spark, sf_dir, "lineitem").select(
        (line_key * 10 + F.col("l_linenumber") + 100000000).cast("string").alias("post_id"),
        F.lit("2").alias("post_type_id"),
        F.lit("").alias("accepted_answer_id"),
        _minute_text(F.col("l_shipdate"), (F.col("l_partkey") * 7) % 1440).alias("creation_date"),
        F.col("l_suppkey").cast("string").alias("owner_user_id"),
        F.lit("").alias("tags"),
        line_key.cast("string").alias("parent_id"),
    )
    return asked.unionByName(answered)


def posts_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``posts`` in the 17 columns of a dump, with quotes and commas in the title."""
    derived = posts(spark, sf_dir)
    number = F.col("post_id").cast("bigint")
    number_text = {"score": 17, "view_count": 1000, "answer_count": 4, "comment_count": 9, "favorite_count": 5}
    counts = {name: (number % size).cast("string") for name, size in number_text.items()}
    title = F.concat(F.lit('On "'), F.col("owner_user_id"), F.lit('", part '), F.col("post_id"))
    return derived.select(
        "post_id",
        "post_type_id",
        F.when(F.col("post_type_id") == "2", F.col("parent_id"))
        .otherwise(F.col("accepted_answer_id"))
        .alias("accepted_or_parent_id"),
        "creation_date",
        counts["score"].alias("score"),
        counts["view_count"].alias("view_count"),
        "owner_user_id",
        F.lit("").alias("last_editor_display_name"),
        F.lit("").alias("last_edit_date"),
        F.col("creation_date").alias("last_activity_date"),
        "tags",
        counts["answer_count"].alias("answer_count"),
        counts["comment_count"].alias("comment_count"),
        counts["favorite_count"].alias("favorite_count"),
        F.lit("").alias("community_owned_date"),
        title.alias("title"),
        F.lit("").alias("parent_id"),
    )


def _points_by(spark: SparkSession, sf_dir: str, prefix: str, key: str) -> DataFrame:
    """Per ``key``: mean minutes from order to shipment, and the number of line items."""
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", key, "l_shipdate")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    minutes = (F.col("l_shipdate") - F.col("o_orderdate")).cast("interval minute").cast("bigint")
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .groupBy(key)
        .agg(F.sum(minutes).alias("total"), F.count("*").alias("popularity"))
        .select(
            F.concat(F.lit(prefix), F.col(key).cast("string")).alias("tag"),
            F.expr("total div popularity").alias("avg_minutes"),
            "popularity",
        )
    )


def tag_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point per part."""
    return _points_by(spark, sf_dir, "p", "l_partkey")


def supplier_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point per supplier."""
    return _points_by(spark, sf_dir, "s", "l_suppkey")
