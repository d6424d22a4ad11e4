from __future__ import annotations

import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from forumlens.llm import decontaminate
from forumlens.llm.queries import oracle_sql

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


@pytest.fixture(scope="module")
def make_items(spark):
    return lambda *rows: spark.createDataFrame(rows, "item_id long, text string")


def plain_leaks(docs, items, least=0.8):
    """Every window of an item's length, compared with Counters."""
    found = {}
    five = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    for item, item_text in items:
        iw = (item_text or "").lower().split()
        wanted = Counter(five(iw))
        for doc, text in docs:
            w = (text or "").lower().split()
            grams = five(w)
            for start in range(max(0, len(w) - len(iw)) + 1):
                seen = Counter(grams[start : start + max(0, len(iw) - 4)])
                common = sum((seen & wanted).values())
                s = common / ((sum(seen.values()) + sum(wanted.values()) - common) or 1)
                if s >= least:
                    key = (doc, item)
                    found[key] = max(found.get(key, (0, 0)), (s, -start))
    return {(d, i, round(s, 6), -b) for (d, i), (s, b) in found.items()}


def leaks(docs, items):
    return {(r.doc_id, r.item_id, round(r.similarity, 6), r.word) for r in decontaminate.find_leaks(docs, items).collect()}


def test_given_documents_match_sql(spark, sample):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sample}/{name}.parquet'")
    want = {tuple(r) for r in con.sql(oracle_sql()["op6_decontamination"]).fetchall()}
    docs, items = (spark.read.parquet(f"{sample}/{name}.parquet") for name in ("documents", "benchmark"))
    assert {(r.doc_id, r.item_id, round(r.similarity, 6), r.word) for r in decontaminate.find_leaks(docs, items).collect()} == want
    assert want


def test_altered_and_odd_rows(make_docs, make_items, monkeypatch):
    w = ITEM.split()
    texts = [
        (1, f"before it {ITEM} after it"),
        (2, ITEM.upper().replace(" ", "\n\t ")),
        (3, f"x {' '.join(w[:10])} changed {' '.join(w[11:])} y"),
        (4, f"x {' '.join(w[:19])} y"),
        (5, " ".join(w[:18])),
        (6, " ".join(w[:12])),
        (7, None),
        (8, ""),
        (9, "alpha beta"),
        (10, "alpha beta gamma delta epsilon and then nothing of it any more in this text at all"),
        (11, f"{ITEM} {ITEM}"),
        (11, f"{ITEM} {ITEM}"),
        (None, ITEM),
        (12, "filler " * 50_000 + ITEM),
    ]
    items = [(1, ITEM), (2, "one two three four five six one two three four five six one two three"), (2, None), (3, ""), (4, "too short item"), (5, ITEM), (5, ITEM)]
    docs = make_docs(*texts).withColumn("n", F.lit(1)).withColumn("grams", F.lit("x")).withColumn("item_id", F.lit(1)).withColumn("_leak_doc_id", F.lit(1))
    want = plain_leaks([t for t in texts if t[0] != 12], items) | {(12, i, 1.0, 50_000) for i in (1, 5)}
    assert leaks(docs, make_items(*items)) == want
    assert {d for d, *_ in want} >= {1, 2, 5, 11, 12, None} and not {d for d, *_ in want} & {6, 7, 8, 9, 10}
    kept = decontaminate.without_leaks(docs, make_items(*items))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({t[0] for t in texts} - {d for d, *_ in want})
    # The same without a broadcast
    monkeypatch.setattr(decontaminate, "BROADCAST_SHINGLES", 0)
    assert leaks(docs, make_items(*items)) == want


def test_shifted_by_insertions(make_docs, make_items, monkeypatch):
    """The best window need not lie as the item does at any shingle that both have."""
    draw = random.Random(5)
    item = [f"w{i}" for i in range(400)]
    texts = []
    for n in range(6):
        w = list(item)
        for p in [*range(0, 3), *range(397, 400)]:
            w[p] = f"x{p}"
        at = draw.randint(100, 300)
        w[at:at] = [f"new{i}" for i in range(10 * n)]
        front = " ".join(f"own{i}" for i in range(draw.randint(0, 40)))
        texts.append((n, f"{front} {' '.join(w)} and some more words behind it"))
    # Words that repeat, so that shingles have several places
    few = [(i, " ".join(draw.choices("ab", k=draw.randint(5, 60)))) for i in range(40)]
    items = [(1, " ".join(item)), (2, "a b a b a a b b a b a b"), (3, "a a a a a a a")]
    want = plain_leaks(texts + [(100 + i, t) for i, t in few], items)
    docs = make_docs(*texts, *[(100 + i, t) for i, t in few])
    assert leaks(docs, make_items(*items)) == want
    assert len([1 for d, i, *_ in want if i == 1]) > 2
    monkeypatch.setattr(decontaminate, "BROADCAST_SHINGLES", 0)
    assert leaks(docs, make_items(*items)) == want


def test_no_rows(make_docs, make_items):
    docs, items = make_docs((1, ITEM)), make_items((1, ITEM))
    assert leaks(docs.where("false"), items) == set()
    assert leaks(docs, items.where("false")) == set()


def test_a_hot_passage(spark, make_items):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string"), F.lit(" " + ITEM)).alias("text"))
    found = decontaminate.find_leaks(docs, make_items((1, ITEM)))
    assert found.count() == 20_000


def test_no_python_runs(make_docs, make_items):
    plan = decontaminate.find_leaks(make_docs((1, ITEM)), make_items((1, ITEM)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
