from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from forumlens.llm import decontaminate, langid
from forumlens.llm.queries import tokenizer_path

from .test_similar import plain_groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before and after each stage, each written and read again."""
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "t")
        stage(spark, docs[-1], SF).write.parquet(path)
        docs.append(spark.read.parquet(path))
    return docs


def test_language(spark, stages):
    given, kept = stages[:2]
    assert kept.columns == given.columns
    judge = langid._judge(langid.fit(given), langid.MARGIN, langid.LEVEL)
    want = sorted(r.doc_id for r in given.collect() if judge(r.text)[0] != "und")
    assert sorted(r.doc_id for r in kept.collect()) == want
    assert len(want) >= 0.98 * given.count()


def test_near_dedup(stages):
    given, kept = stages[1:3]
    texts = {r.doc_id: r.text for r in given.collect()}
    groups = plain_groups(texts)
    assert kept.columns == given.columns
    left = {r.doc_id for r in kept.collect()}
    # Of every group its smallest stays; at most a tenth of what should go stays as well
    assert set(groups.values()) <= left
    assert len(left) - len(set(groups.values())) <= 0.1 * (len(texts) - len(set(groups.values())))


def test_decontamination(spark, stages):
    given, kept = stages[2:4]
    leaks = {r.doc_id for r in decontaminate.find_leaks(given, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len(r.text.split()) >= 5]
    whole = {r.doc_id for r in given.collect() if any(f" {x} " in f" {' '.join(r.text.lower().split())} " for x in items)}
    assert whole and whole <= leaks
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.doc_id for r in given.collect()} - leaks)


def test_mixing(stages):
    given, kept = stages[3:5]
    assert kept.columns == given.columns
    times = {r.doc_id: r["count"] for r in kept.groupBy("doc_id").count().collect()}
    assert set(times) <= {r.doc_id for r in given.collect()} and max(times.values()) <= 3
    words = lambda df: df.agg(F.sum(F.size(F.expr("filter(split(text, '[ \\\\t-\\\\r]+'), x -> x <> '')")))).first()[0]
    assert words(kept) == pytest.approx(words(given), rel=0.25)


def test_token_files(stages):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(tokenizer_path()).encode
    given, found = stages[4:6]
    start, want = 0, []
    for r in sorted(given.collect(), key=lambda r: r.doc_id):
        ids = [*encode(r.text, add_special_tokens=False).ids, 0]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in found.collect()) == want


def test_run_applies_all_stages(spark, stages):
    assert sorted(map(tuple, pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages[-1].collect()))


def test_odd_documents_pass_all_stages(spark, make_docs):
    docs = make_docs((1, None), (2, ""), (3, "the house on the hill is green and old"), (3, "the house on the hill is green and old"), (4, "x " * 60_000, None, None), (None, "no id but some words of prose"))
    docs = docs.withColumn("size", F.lit("s")).withColumn("fp", F.lit(1)).withColumn("_clash", F.lit(2))
    for frame in (docs, docs.where("false")):
        for _, stage in pipeline.STAGES[:-1]:
            out = stage(spark, frame, SF)
            assert out.columns == docs.columns
            frame = spark.createDataFrame(out.collect(), docs.schema)
        tokens = pipeline.STAGES[-1][1](spark, frame, SF)
        assert tokens.count() == frame.count()
