"""Small side files: expert lists, tag features and cluster centres."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from forumlens.functions import as_id, present
from forumlens.sources.records import escape_breaks, read_records


def write_csv(df: DataFrame, path: str) -> None:
    """Rows as comma-separated text; a missing value is an empty field.

    A record is one line: breaks inside a text are written as ``escape_breaks`` tells.
    """
    lines = [escape_breaks(F.col(f"`{c}`")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes]
    df.select(*lines).write.mode("overwrite").csv(path, sep=",", quote='"', escape='"', emptyValue="")


def write_text(df: DataFrame, path: str, sep: str = "\t") -> None:
    """One line per row, the columns joined by ``sep``; a missing value is empty."""
    fields = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws(sep, *fields).alias("value")).write.mode("overwrite").text(path)


def read_experts(spark: SparkSession, path: str) -> DataFrame:
    """Lines ``tag<whitespace>u1,u2,...`` as rows (tag, rank, user_id)."""
    parts = F.split("value", r"\s+")
    lines = spark.read.text(path).select(
        F.get(parts, F.lit(0)).alias("tag"), F.get(parts, F.lit(1)).alias("users")
    )
    ranked = lines.filter(present("tag")).select(
        "tag", F.posexplode(F.split("users", ",")).alias("place", "user")
    )
    return ranked.select(
        "tag", (F.col("place") + 1).alias("rank"), as_id("user").alias("user_id")
    ).filter(F.col("user_id").isNotNull())


def read_popularity(spark: SparkSession, path: str, seen: Observation | None = None) -> DataFrame:
    """Lines ``tag,popularity``; a line whose popularity is no number is dropped.

    Of lines that repeat a tag the greatest popularity counts.
    """
    rows = read_records(spark, path, ["tag", "popularity"], breaks=True, seen=seen)
    numbers = rows.select("tag", F.col("popularity").try_cast("double").alias("popularity"))
    known = numbers.filter(present("tag") & F.col("popularity").isNotNull())
    return known.groupBy("tag").agg(F.max("popularity").alias("popularity"))


def read_tag_features(spark: SparkSession, path: str, seen: Observation | None = None) -> DataFrame:
    """Lines ``tag,minutes,popularity``; a line without exactly three fields is dropped.

    ``seen`` counts lines as ``read_records`` tells, here and in ``read_popularity``.
    """
    rows = read_records(spark, path, ["tag", "avg_minutes", "popularity"], breaks=True, seen=seen)
    return rows.select(
        "tag",
        F.col("avg_minutes").try_cast("double").alias("avg_minutes"),
        F.col("popularity").try_cast("double").alias("popularity"),
    )


def read_centres(spark: SparkSession, paths: dict[int, str]) -> DataFrame:
    """Centres ``minutes,popularity``, one file per configuration, numbered by line.

    The order of the lines decides ties, so a file is read as one text; it holds
    a handful of centres, which end up in the plan of every clustering pass.
    """
    read = None
    for config, path in paths.items():
        lines = spark.read.text(path, wholetext=True).select(
            F.posexplode(F.split(F.trim("value"), r"\R")).alias("center", "line")
        )
        xy = F.split("line", ",")
        rows = lines.select(
            F.lit(config).alias("config"),
            "center",
            F.get(xy, F.lit(0)).try_cast("double").alias("avg_minutes"),
            F.get(xy, F.lit(1)).try_cast("double").alias("popularity"),
        ).filter(F.col("avg_minutes").isNotNull() & F.col("popularity").isNotNull())
        read = rows if read is None else read.unionByName(rows)
    return read


def write_centres(history: DataFrame, path: str) -> None:
    """Centres of every pass, one folder per configuration and iteration."""
    history.write.mode("overwrite").partitionBy("config", "iteration").parquet(path)
