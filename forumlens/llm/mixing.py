"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target of words. A document's expected number of copies is
its share of the target: the whole part of it is taken for certain, and the rest
is the probability of one more copy. Documents are ranked by their random odds
over their inclusion odds, and the sample is the front of that order up to the
number of words that comes nearest to what the target lacks.

No source is brought together: ranks fall into narrow buckets whose words are
summed, and only the documents of the bucket in which the target falls are put
in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumlens.llm.common import n_words, spare
from forumlens.session import keep

MAX_COPIES = 3
WEIGHTS = (1, 2, 3)
#: The ranks of a source are split into so many parts.
BUCKETS = 4096


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """The columns of ``sizes`` (``source, source_size``) with ``target``.

    Sources by code point, null last, weigh ``weights``, repeated. All words are
    shared by weight; a target over ``max_copies`` times its source stops there
    and the excess is shared anew among the others until none is above. Filling
    in the order of size over weight reaches that at once: a source stops if its
    share of the words left exceeds its limit, and the first that does not stop
    fixes the share of all later ones. One task sees one row per source, never a
    document.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights) + 1
    weighed = sizes.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), place.cast("int")))
    whole = Window.partitionBy()
    level = F.col("source_size") / F.col("_w")
    before = Window.orderBy(level, F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    words_left = F.sum("source_size").over(whole) - F.coalesce(F.sum(max_copies * F.col("source_size")).over(before), F.lit(0))
    weight_left = F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0))
    shared = weighed.withColumn("_share", words_left / weight_left).withColumn("_limit", max_copies * F.col("source_size"))
    below = F.when(F.col("_share") * F.col("_w") <= F.col("_limit"), F.struct(level.alias("level"), (-F.col("_share")).alias("minus")))
    # Of sources at one level the first has the largest share; those after it count it as stopped
    target = F.least(F.col("_limit").cast("double"), F.col("_w") * -F.min(below).over(whole)["minus"])
    return shared.withColumn("target", target).drop("_w", "_share", "_limit")


def mix(
    docs: DataFrame,
    seed: int = 10,
    weights: tuple[int, ...] = WEIGHTS,
    max_copies: int = MAX_COPIES,
    preference: str | None = None,
) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies``.

    ``size`` is the number of words (null text: 0), ``copies`` how often the mix
    takes the document, at most ``max_copies`` times. With ``preference``, a
    column of positive numbers, documents are expected in proportion to it
    (null: 1); without, all documents of a source alike. Random numbers come
    from the ids, so reruns agree; rows with equal ids go by
    their texts, and of equal rows either may be taken. Columns of ``docs`` with one of the four names are replaced. An empty
    table gives an empty result, and a source without words takes no copies.
    """
    likes = F.coalesce(F.col(preference).cast("double"), F.lit(1.0)) if preference else F.lit(1.0)
    rows = docs.drop("size", "source_size", "target", "copies")
    given = rows.columns
    # Names of other columns cannot meet those used here
    inner = [c if c in ("doc_id", "source", "text", preference) else f"_own_{i}" for i, c in enumerate(given)]
    rows = rows.toDF(*inner).withColumn("size", n_words(F.col("text")).cast("long"))
    own = rows.columns
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum(likes * F.col("size")).alias("_mix_liked"))
    # A row per source; its size on disk tells Spark whether it can be broadcast
    goals = keep(targets(sizes, weights, max_copies).withColumnRenamed("source", "_mix_source"), "mix-targets")
    same = F.col("source").eqNullSafe(F.col("_mix_source"))
    expected = F.when(F.col("_mix_liked") > 0, F.least(F.lit(float(max_copies)), F.col("target") * likes / F.col("_mix_liked")))
    part = F.greatest(F.lit(0.0), F.col("_mix_expected") - F.col("_mix_sure"))
    # Uniform in (0, 1), from 52 bits of a digest that other engines have too
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("doc_id").cast("string")).cast("binary"))
    uniform = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)
    odds = (F.col("_mix_u") / (1 - F.col("_mix_u"))) / (F.col("_mix_part") / (1 - F.col("_mix_part")))
    ranked = (
        rows.join(goals, same)
        .withColumn("_mix_expected", F.coalesce(expected, F.lit(0.0)))
        .withColumn("_mix_sure", F.floor(F.col("_mix_expected") + 1e-12))
        .withColumns({"_mix_u": uniform, "_mix_part": part})
        .withColumn("_mix_rank", F.when(F.col("_mix_part") > 0, odds))
        # rank / (1 + rank) grows with the rank and lies in (0, 1)
        .withColumn("_mix_bucket", F.floor(F.col("_mix_rank") / (1 + F.col("_mix_rank")) * BUCKETS))
    )
    sums = ranked.groupBy("_mix_source", "_mix_bucket").agg(
        F.sum("size").alias("words"), F.sum(F.col("_mix_sure") * F.col("size")).alias("sure"), F.first("target").alias("target")
    )
    of_source = Window.partitionBy("_mix_source")
    up_to = of_source.orderBy(F.col("_mix_bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = sums.select(
        "_mix_source",
        "_mix_bucket",
        F.sum(F.when(F.col("_mix_bucket").isNotNull(), F.col("words")).otherwise(0)).over(up_to).alias("end"),
        F.greatest(F.lit(0.0), F.col("target") - F.sum("sure").over(of_source)).alias("lack"),
    )
    # The first bucket that ends beyond what is lacking; without one all are taken
    beyond = F.col("_mix_bucket").isNotNull() & (F.col("end") > F.col("lack"))
    last = F.struct("_mix_bucket", "end")
    cuts = keep(
        ended.groupBy(F.col("_mix_source").alias("_mix_source2")).agg(
            F.coalesce(F.min(F.when(beyond, F.col("_mix_bucket"))), F.lit(BUCKETS + 1)).alias("_mix_cut"),
            F.coalesce(F.max(F.when(F.col("_mix_bucket").isNotNull() & ~beyond, last))["end"], F.lit(0)).alias("_mix_start"),
            F.max("lack").alias("_mix_lack"),
        ),
        "mix-cuts",
    )
    placed = ranked.join(cuts, F.col("_mix_source").eqNullSafe(F.col("_mix_source2")))
    columns = [*own, "source_size", "target"]
    at_cut = F.col("_mix_bucket").isNotNull() & (F.col("_mix_bucket") == F.col("_mix_cut"))
    front = F.when(F.col("_mix_bucket") < F.col("_mix_cut"), 1).otherwise(0)
    clear = placed.where(~at_cut).select(*columns, (F.col("_mix_sure") + front).alias("copies"))
    # Numbered and written, so that only numbers and sizes are put in order; equal ids by text
    near = keep(placed.where(at_cut).withColumn("_mix_row", F.monotonically_increasing_id()), "mix-bucket")
    order = near.select("_mix_row", "_mix_source", "_mix_rank", "doc_id", "size", "_mix_start", F.xxhash64("text").alias("version"))
    in_order = Window.partitionBy("_mix_source").orderBy("_mix_rank", "doc_id", "size", "version", "_mix_row")
    # Taken if the words up to its middle are lacking: the total comes nearest to the target
    middle = F.col("_mix_start") + F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size") / 2
    middles = order.select(F.col("_mix_row").alias("_mix_row2"), middle.alias("_mix_middle"))
    near = near.join(middles, F.col("_mix_row") == F.col("_mix_row2"))
    near = near.select(*columns, (F.col("_mix_sure") + F.when(F.col("_mix_middle") <= F.col("_mix_lack"), 1).otherwise(0)).alias("copies"))
    return clear.unionByName(near).withColumn("copies", F.col("copies").cast("int")).toDF(*given, "size", "source_size", "target", "copies")


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each document as often as ``copies`` says, with ``columns``."""
    times = F.array_repeat(F.lit(0), F.col("copies"))
    copy = spare(mixed, "_mix_copy")
    return mixed.where("copies > 0").select(*columns, F.explode(times).alias(copy)).drop(copy)
