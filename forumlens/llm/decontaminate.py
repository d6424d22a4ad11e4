"""Benchmark passages in documents, with SQL functions only.

A document is read through windows that have as many words as an item. Windows are
laid so that they end in a five-word shingle of the benchmark: if the last shingle of
a window is none, the window one word before is as similar or more, so the first of the
best windows is always among these, or starts the document. Windows with fewer
shingles of the benchmark than the similarity takes are left out. Each window and item gets a SimHash of its shingles. The 64 bits
fall into 8 blocks; fingerprints within 23 bits agree in some block up to two bits,
so joining a window's blocks with all values within two bits of an item's finds
every such pair. Pairs within the radius are verified by the exact weighted
Jaccard similarity of their shingles.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import let, spare, words
from forumlens.session import keep

SHINGLE = 5
SIMILARITY = 0.8
BITS, BLOCKS, FLIPS = 64, 8, 2
#: Pigeonhole: 23 differing bits leave some of 8 blocks at most 2.
RADIUS = BLOCKS * (FLIPS + 1) - 1
#: A benchmark with at most so many shingles is sent to all executors (16 bytes each and some).
BROADCAST_SHINGLES = 1_000_000


def _shingles(w: Column) -> Column:
    """Hashes of the five-word shingles of an array of words, in order."""

    def of(bound: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(bound) - SHINGLE), lambda i: F.xxhash64(*[F.get(bound, i + k) for k in range(SHINGLE)]))
        return F.when(F.size(bound) >= SHINGLE, hashes).otherwise(F.array().cast("array<bigint>"))

    # Bound once: put into the function by the optimizer, the words would be split anew for each shingle
    return let(w, of)


def _simhash(hashes: Column) -> Column:
    """The 64 bits in which over half of the hashes have a one."""
    one = F.lit(1).cast("long")

    def bit(b: Column) -> Column:
        ones = F.aggregate(hashes, F.lit(0).cast("long"), lambda n, h: n + F.call_function("shiftrightunsigned", h, b).bitwiseAND(one))
        return F.when(2 * ones > F.size(hashes), F.call_function("shiftleft", one, b)).otherwise(F.lit(0).cast("long"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(bit(b)))


def _block(fp: Column, block: Column) -> Column:
    width = BITS // BLOCKS
    return F.call_function("shiftrightunsigned", fp, block * width).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _similarity(x: Column, y: Column) -> Column:
    """Weighted Jaccard: shingles count as often as they occur."""
    both = F.array_distinct(F.array_intersect(x, y))
    times = lambda a, h: F.size(F.filter(a, lambda v: v == h))
    common = F.aggregate(both, F.lit(0), lambda n, h: n + F.least(times(x, h), times(y, h)))
    return common / (F.size(x) + F.size(y) - common)


def _items(benchmark: DataFrame) -> DataFrame:
    """``item_id, n, shingles, fp`` of the items with five words or more."""
    rows = benchmark.select("item_id", words(F.lower("text")).alias("w"))
    rows = rows.select("item_id", F.size("w").alias("n"), _shingles(F.col("w")).alias("shingles")).where(F.size("shingles") > 0)
    return rows.withColumn("fp", _simhash(F.col("shingles")))


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, item_id, similarity, word``: the benchmark items found in documents.

    Texts are lower-cased. A pair is found if a window of the document of as many
    words as the item has at least ``similarity`` with it; ``similarity`` and
    ``word`` (from 0) are of the best such window, the first of equals. A
    document shorter than the item is one window. Items below five words (null
    and empty ones too) are not searched for, as they have no shingle; documents
    below five words match none. Rows with equal doc_id and text count once,
    as do repeated items; a null id is an id like any other. Every word of every
    document is looked at.
    """
    items = keep(_items(benchmark).dropDuplicates(["item_id", "n", "shingles"]), "benchmark-items")
    anchors = items.select("n", F.explode("shingles").alias("h")).groupBy("h").agg(F.collect_set("n").alias("lengths"))
    anchors = keep(anchors, "benchmark-shingles")
    if anchors.count() <= BROADCAST_SHINGLES:
        anchors = F.broadcast(anchors)
    texts = docs.select("doc_id", F.xxhash64("text").alias("version"), "text")
    grams = texts.select("doc_id", "version", _shingles(words(F.lower("text"))).alias("grams"))
    grams = grams.select("doc_id", "version", F.size("grams").alias("n_grams"), F.posexplode_outer("grams").alias("at", "gram"))
    met = grams.join(anchors, F.col("gram") == F.col("h")).select("doc_id", "version", "n_grams", "at", F.explode("lengths").alias("n"))
    spots = met.groupBy("doc_id", "version", "n_grams", "n").agg(F.sort_array(F.collect_set("at")).alias("ats"))
    size = F.col("n") - (SHINGLE - 1)
    # x common shingles of two sets of a and b give x / (a + b - x)
    least = F.ceil(similarity * (F.least(F.col("n_grams"), size) + size) / (1 + similarity) - 1e-6).cast("int")
    spots = spots.withColumns({"size": size, "least": F.greatest(F.lit(1), least)})
    enough = F.filter("ats", lambda at, i: (i + 1 >= F.col("least")) & (F.get("ats", i + 1 - F.col("least")) > at - F.col("size")))
    words_ = F.array_distinct(F.transform(enough, lambda at: F.greatest(F.lit(0), at + 1 - F.col("size"))))
    spots = spots.select("doc_id", "version", F.struct("size", words_.alias("words")).alias("spot")).where(F.size("spot.words") > 0)
    spots = spots.groupBy(F.col("doc_id").alias("doc_id2"), F.col("version").alias("version2")).agg(F.collect_list("spot").alias("spots"))
    spots = keep(spots, "window-places")
    laid = texts.join(spots, F.col("doc_id").eqNullSafe(F.col("doc_id2")) & (F.col("version") == F.col("version2")))

    def cut(bound: Column) -> Column:
        """``n, word, seen`` of the windows of a document whose shingles are ``bound``."""

        def of(p: Column) -> Column:
            one = lambda w: F.struct((p["size"] + (SHINGLE - 1)).alias("n"), w.alias("word"), F.slice(bound, w + 1, p["size"]).alias("seen"))
            return F.transform(p["words"], one)

        return F.flatten(F.transform("spots", of))

    windows = laid.select("doc_id", F.explode(let(_shingles(words(F.lower("text"))), cut)).alias("p"))
    # Equal windows of a document need one look; copies of it have the same ones
    windows = windows.groupBy("doc_id", F.col("p.n").alias("n"), F.col("p.seen").alias("seen")).agg(F.min("p.word").alias("word"))
    # Written with its fingerprint, which the join would compute anew for every pair
    windows = keep(windows.withColumn("fp2", _simhash(F.col("seen"))), "windows")
    number = F.sequence(F.lit(0), F.lit(BLOCKS - 1))
    width = BITS // BLOCKS
    masks = [sum(1 << b for b in c) for k in range(FLIPS + 1) for c in combinations(range(width), k)]
    near = F.array(*[F.lit(m).cast("long") for m in masks])
    # Index: the values within two bits of each block of an item
    index = (
        items.select("item_id", "n", "shingles", "fp", F.explode(number).alias("block"))
        .select("*", F.explode(near).alias("mask"))
        .select("item_id", "shingles", "fp", F.col("n").alias("n2"), F.col("block").alias("block2"), _block(F.col("fp"), F.col("block")).bitwiseXOR(F.col("mask")).alias("value2"))
    )
    probes = windows.select("*", F.explode(number).alias("block")).withColumn("value", _block(F.col("fp2"), F.col("block")))
    matched = probes.join(index, (F.col("n") == F.col("n2")) & (F.col("block") == F.col("block2")) & (F.col("value") == F.col("value2")))
    close = matched.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2"))) <= RADIUS)
    checked = close.withColumn("similarity", _similarity(F.col("seen"), F.col("shingles"))).where(F.col("similarity") >= similarity)
    best = F.max(F.struct("similarity", (-F.col("word")).alias("back")))
    found = checked.groupBy("doc_id", "item_id").agg(best.alias("best"))
    return found.select("doc_id", "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.back")).cast("long").alias("word"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns."""
    leak = spare(docs, "_leak_doc_id")
    leaks = find_leaks(docs, benchmark, similarity).select(F.col("doc_id").alias(leak)).distinct()
    return docs.join(keep(leaks, "leaks"), F.col("doc_id").eqNullSafe(F.col(leak)), "left_anti")
