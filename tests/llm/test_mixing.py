from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from forumlens.llm import mixing


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """Share, stop what is above its limit, share the excess anew, until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in open_}
        target |= {s: float(most * sizes[s]) for s in over}
        left -= sum(most * sizes[s] for s in over)
        open_ -= over
    return target


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    draw = random.Random(seed)
    names = draw.sample(["a", "B", "é", "Z", "", "b", "src10", "src9", "ａ", "𝒳"], draw.randint(1, 9)) + [None] * draw.randint(0, 1)
    sizes = {s: draw.choice([0, 1, 10, 1000, 100_000]) for s in names}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(frame).collect()}
    want = plain_targets(sizes)
    assert found.keys() == want.keys()
    assert all(found[s] == pytest.approx(want[s]) for s in want)


def test_mix_comes_near_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mix(docs).select("doc_id", "text", "source", "size", "source_size", "target", "copies").collect()
    assert len(rows) == docs.count()
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        assert r.size == len((r.text or "").split()) and 0 <= r.copies <= 3
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    want = plain_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1
    copies = {(r.source, r.copies) for r in rows}
    assert all(max(c for t, c in copies if t == s) - min(c for t, c in copies if t == s) <= 1 for s in sizes)


def test_reruns_agree(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    one = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    assert one == {r.doc_id: r.copies for r in mixing.mix(docs.repartition(7)).collect()}
    assert one != {r.doc_id: r.copies for r in mixing.mix(docs, seed=11).collect()}


def test_preference(spark):
    """Documents of one source and size: the preferred half is taken about three times as often."""
    text = "word " * 10
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit(text).alias("text"), F.when(F.col("id") < 2000, "a").otherwise("b").alias("source"),
        F.when(F.col("id") % 2 == 0, 3.0).otherwise(1.0).alias("liked"),
    )
    rows = mixing.mix(docs, weights=(1,), preference="liked").where("source = 'a'").collect()
    often = [sum(r.copies for r in rows if r.doc_id % 2 == k) for k in (0, 1)]
    assert often[0] == pytest.approx(1500, abs=60) and often[1] == pytest.approx(500, abs=60)
    assert sum(often) == pytest.approx(2000, abs=2)


def test_odd_rows(make_docs):
    docs = make_docs((1, None, "en", "a"), (2, "", "en", None), (3, "x y z", "en", None), (3, "x y z", "en", None), (None, "w " * 50_000, "en", "a"), (4, "p q", "en", "b"))
    docs = docs.withColumn("size", F.lit("s")).withColumn("target", F.lit(0)).withColumn("words", F.lit(0)).withColumn("sure", F.lit(0))
    rows = mixing.mix(docs).collect()
    assert sorted(r.size for r in rows) == [0, 0, 2, 3, 3, 50_000]
    targets = plain_targets({"a": 50_000, "b": 2, None: 6})
    assert all(r.target == pytest.approx(targets[r.source]) for r in rows)
    assert all(r.copies == 3 for r in rows if r.size in (2, 3))
    again = mixing.repeated(mixing.mix(docs), docs.columns)
    assert again.columns == docs.columns and again.where("source = 'b'").count() == 3
    assert mixing.mix(docs.where("false")).collect() == []


def test_a_hot_source(spark):
    docs = spark.range(60_000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("some words "), F.col("id").cast("string")).alias("text"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("s"), (F.col("id") % 7).cast("string"))).otherwise("hot").alias("source"),
    )
    found = mixing.mix(docs).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) <= 3 for r in found)


def test_clashing_names_and_equal_ids(make_docs):
    """Other columns keep their names and values; of rows with one id the text decides which is taken."""
    rows = [(i % 7, f"{'word ' * (i % 5 + 1)}{i}") for i in range(200)]
    docs = make_docs(*rows).withColumns({n: F.col("doc_id") for n in ("_mix_source", "_mix_row", "version", "words", "_own_1")})
    runs = []
    for parts in (1, 5):
        mixed = mixing.mix(docs.repartition(parts))
        assert mixed.columns == [*docs.columns, "size", "source_size", "target", "copies"]
        got = mixed.collect()
        assert len(got) == 200 and all(r._mix_source == r._own_1 == r.version == r.doc_id for r in got)
        runs.append(sorted((r.doc_id, r.text, r.copies) for r in got))
    assert runs[0] == runs[1]
