"""Post records: the comma-separated dump, and the Parquet store made of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from forumlens.sources.records import read_records

# The columns of a post record, by position. The third holds the
# accepted answer of a question and the parent question of an answer.
RECORD = (
    "post_id",
    "post_type_id",
    "accepted_or_parent_id",
    "creation_date",
    "score",
    "view_count",
    "owner_user_id",
    "last_editor_display_name",
    "last_edit_date",
    "last_activity_date",
    "tags",
    "answer_count",
    "comment_count",
    "favorite_count",
    "community_owned_date",
    "title",
    "parent_id",
)
# Post types
QUESTION = "1"
ANSWER = "2"


def read_posts(
    spark: SparkSession,
    path: str,
    parent_id_from: int = 2,
    escape: str = '"',
    breaks: bool = False,
    seen: Observation | None = None,
) -> DataFrame:
    """Posts of a headerless CSV dump, one record per line, all fields text.

    Lines with too few or too many fields, or with a quote left open, are
    dropped. ``parent_id_from`` names the position (2 or 16) that holds the
    parent of an answer. ``escape`` is ``'"'`` for doubled quotes, ``'\\\\'`` for
    quotes behind a backslash. ``breaks`` and ``seen`` are those of ``read_records``: a dump
    of ``write_csv`` has line breaks to put back, and dropped lines can be counted.
    """
    if parent_id_from not in (2, 16):
        raise ValueError(f"parent_id_from must be 2 or 16, got {parent_id_from}")
    records = read_records(spark, path, RECORD, escape, breaks, seen)
    second = F.col("accepted_or_parent_id")
    is_answer = F.col("post_type_id") == ANSWER
    parent = second if parent_id_from == 2 else F.col("parent_id")
    return records.select(
        "post_id",
        "post_type_id",
        F.when(~is_answer, second).alias("accepted_answer_id"),
        *RECORD[3:16],
        F.when(is_answer, parent).alias("parent_id"),
    )


def write_posts(posts: DataFrame, path: str) -> None:
    """Store posts as Parquet, one folder per post type.

    Every report reads the questions and the answers apart, so each side then
    scans its own folder only and no post is read twice.
    """
    posts.write.mode("overwrite").partitionBy("post_type_id").parquet(path)


def load_posts(spark: SparkSession, path: str) -> DataFrame:
    """Posts stored by ``write_posts``, each type as the text it was.

    Folder names read as numbers would turn ``01`` into ``1``, so the schema names
    the type as text. An empty type is missing, as in ``read_posts``.
    """
    found = spark.read.parquet(path).schema
    fields = [StructField(f.name, StringType()) if f.name == "post_type_id" else f for f in found]
    return spark.read.schema(StructType(fields)).parquet(path)
