from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from forumlens.llm import langid, quality
from forumlens.llm.common import id_remainder
from forumlens.llm.queries import op4_quality, op5_language

SF = "/root/testdata/sf0.01"


def test_id_remainder(spark, make_docs):
    docs = make_docs((0, ""), (17, ""), (123456789, ""), (-4, ""), (None, ""))
    found = [r[0] for r in docs.select(id_remainder(F.col("doc_id"), 4)).collect()]
    assert found == [zlib.crc32(x) % 4 for x in (b"0", b"17", b"123456789", b"-4", b"")]


def test_quality_of_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op4_quality(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    for wanted in (0, 1):
        own = [p == y for p, y in held if y == wanted]
        assert len(own) > 5 and sum(own) >= 0.9 * len(own)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= quality.THRESHOLD) for r in rows)


def test_quality_ranks_pairs(spark, make_docs):
    good = [(i, f"Plain sentences of number {i} follow here. They are fine.") for i in range(30)]
    bad = [(100 + i, f"BUY!! NOW!! {i} ### $$$ | | |") for i in range(30)]
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(None, 1), (5000, 0), (1, 7)], "doc_id long, label int")
    docs = make_docs(*good, *bad)
    ranking = quality.fit(docs, labels)
    assert quality.fit(docs.repartition(7), labels) == ranking
    scores = {r.doc_id: r.score for r in quality.scored(docs, ranking).collect()}
    assert min(scores[i] for i, _ in good) > max(scores[i] for i, _ in bad)


def test_quality_of_odd_rows(spark, make_docs):
    docs = make_docs((1, None), (1, ""), (2, "word"), (2, "word"), (3, "!" * 300_000)).withColumn("score", F.lit("x")).withColumn("_q_words", F.lit(1))
    labels = spark.createDataFrame([(2, 1), (3, 0)], "doc_id long, label int")
    rows = quality.scored(docs, quality.fit(docs, labels)).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    by_id = {}
    for r in rows:
        by_id.setdefault((r.doc_id, r.text), set()).add((r.score, r.predicted))
    assert all(len(v) == 1 for v in by_id.values()) and by_id[(1, None)] == by_id[(1, "")]
    for known, predicted in ((labels.where("label = 1"), 1), (labels.where("label = 0"), 0), (labels.where("false"), 1)):
        assert {r.predicted for r in quality.scored(docs, quality.fit(docs, known)).collect()} == {predicted}
    assert quality.scored(docs.where("false"), quality.fit(docs.where("false"), labels)).collect() == []


def test_language_of_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op5_language(spark, SF).collect()
    assert len(rows) == len(truth)
    held = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert sum(held) >= 0.97 * len(held) and all(0 <= r.score <= 1 for r in rows)


@pytest.fixture(scope="module")
def dictionaries(spark, make_docs):
    texts = {"en": "the house stands on the green hill near the river", "de": "das haus steht auf dem grünen hügel nahe dem fluss"}
    rows = [(i, f"{t} {i}", lang, "s") for i in range(8) for lang, t in texts.items()]
    return langid.fit(make_docs(*rows, (90, None, "xx", "s"), (91, "12 34", "xx", "s"), (92, "words", None, "s")))


def test_language_of_odd_rows(make_docs, dictionaries):
    assert sorted(dictionaries) == ["de", "en"]
    docs = make_docs((1, None), (2, ""), (3, "123 ***"), (4, "the river near the hill"), (4, "the river near the hill"), (5, "das haus " * 30_000))
    docs = docs.withColumn("lang_pred", F.lit("x")).withColumn("score", F.lit(9))
    found = sorted((r.doc_id, r.lang_pred) for r in langid.identified(docs, dictionaries).collect())
    assert found == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (5, "de")]
    assert {r.lang_pred for r in langid.identified(docs, {}).collect()} == {"und"}
    assert {r.lang_pred for r in langid.identified(docs.where("doc_id > 3"), {"en": b"the"}).collect()} == {"en"}
    kept = langid.recognised(docs, dictionaries)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [4, 4, 5]
    assert langid.identified(docs.where("false"), dictionaries).collect() == []


def test_narrow_margins_are_rejected(make_docs, dictionaries):
    docs = make_docs((1, "qqq"), (2, "the house stands on the green hill near the river"))
    found = {r.doc_id: r.lang_pred for r in langid.identified(docs, dictionaries, margin=0.1).collect()}
    assert found == {1: "und", 2: "en"}


def test_clean_texts_of_five_megabytes_are_recognised(spark):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    found = langid.fit(given)
    draw = random.Random(3)
    rows = []
    for lang in sorted(found):
        own = [r.text for r in given.where(F.col("lang") == lang).collect() if r.text and langid.letters(r.text)]
        own = [t for t in own if langid.letters(t) not in found[lang]]
        long, size = [], 0
        while size < 5_000_000:
            draw.shuffle(own)
            long += own
            size += sum(map(len, own))
        rows.append((len(rows), " ".join(long)[:5_000_000], lang, "s", 5_000_000))
    docs = spark.createDataFrame(rows, given.select("doc_id", "text", "lang", "source", "n_chars").schema)
    want = [(r[0], r[2]) for r in rows]
    assert len(want) > 1
    for margin in (langid.MARGIN, 0.01):
        assert sorted((r.doc_id, r.lang_pred) for r in langid.identified(docs, found, margin=margin).collect()) == want
    assert langid.recognised(docs, found).count() == len(want)


def test_a_dictionary_is_bounded(make_docs):
    rows = [(i, "word " * 200 + str(i), "en", "s") for i in range(50)] + [(99, "long " * 100_000, "de", "s"), (98, "kurz", "de", "s")]
    found = langid.fit(make_docs(*rows), size=5000)
    assert sorted(found) == ["de", "en"] and all(len(d) <= 5000 for d in found.values())


def test_a_language_of_long_texts_only_is_learned(spark):
    draw = random.Random(9)
    words = {k: ["".join(draw.choices(letters, k=draw.randint(3, 9))) for _ in range(400)] for k, letters in (("xx", "abcdefg"), ("yy", "mnopqrs"))}
    text = lambda k, n: " ".join(draw.choices(words[k], k=n))
    # One letter comes behind more digits than a piece has
    rows = [(i, text("xx", 300), "xx") for i in range(20)] + [(100 + i, "7 " * 40_000 + text("yy", 60_000), "yy") for i in range(3)]
    rows += [(200 + i, "123 456", "zz") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = langid.fit(docs)
    assert sorted(found) == ["xx", "yy"]
    got = langid.identified(docs.where("lang <> 'zz'"), found).collect()
    assert all(r.lang_pred == ("xx" if r.doc_id < 100 else "yy") for r in got)


def test_language_is_that_of_the_smallest_compression(spark, sample):
    """Each piece of a text compressed with each dictionary by the library's plain call."""
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    dictionaries = langid.fit(docs)
    docs = docs.where("doc_id % 3 = 0")
    found = {r.doc_id: r for r in langid.identified(docs, dictionaries).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(found) == len(texts) > 50
    for i, text in texts.items():
        lowered = (text or "").lower()
        data = re.sub(r"[\W\d_]+", " ", lowered).strip().encode()
        if not data:
            assert (found[i].lang_pred, found[i].score) == ("und", 0)
            continue
        sizes = {}
        for lang, content in dictionaries.items():
            coder = zstandard.ZstdCompressor(
                level=langid.LEVEL,
                dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
                write_content_size=False,
                write_dict_id=False,
            )
            pieces = range(0, len(data), langid.PIECE_BYTES)
            sizes[lang] = sum(len(coder.compress(data[at : at + langid.PIECE_BYTES])) for at in pieces)
        least = min(sizes.values())
        assert found[i].lang_pred == min(k for k, v in sizes.items() if v == least)
        others = sum(sizes.values()) - least
        assert found[i].score == pytest.approx(max(0, 1 - least * (len(sizes) - 1) / others))


def test_quality_learns_from_all_labels(spark, make_docs, monkeypatch):
    """More labels than a sample of 10,000 held, and a class of few; the cut is the quantile of all strengths."""
    docs = spark.range(24_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("plain words of "), F.col("id").cast("string"), F.repeat(F.lit("! #"), (F.col("id") % 7).cast("int"))).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 7 < 6).cast("int").alias("label"))
    met = []
    pairs = quality._pairs
    monkeypatch.setattr(quality, "_pairs", lambda rows, good, bad, *rest: met.append((rows.count(), good, bad)) or pairs(rows, good, bad, *rest))
    ranking = quality.fit(docs, labels)
    assert met == [(24_000, 20_572, 3_428)]
    strengths = quality.with_figures(docs).select(quality._strength(F.col("_q_figures"), ranking.weights)).toPandas().iloc[:, 0]
    assert ranking.cut == pytest.approx(np.quantile(strengths, 3_428 / 24_000), rel=1e-9)
    wrong = quality.scored(docs, ranking).join(labels, "doc_id").where("predicted <> label").count()
    assert wrong <= 24


def test_every_labelled_document_meets_another(spark):
    for good, bad in ((30, 7), (5, 41), (1, 1), (3, 3)):
        rows = spark.range(good + bad).select((F.col("id") < good).cast("int").alias("_q_label"), F.when(F.col("id") < good, F.col("id")).otherwise(F.col("id") - good).alias("place"))
        rows = rows.withColumn("x", F.array(F.col("place").cast("double"), F.lit(0.0)))
        one = np.array([1.0, 1.0])
        times = min(good, bad, max(quality.MEETINGS, -(-40 // max(good, bad))))
        assert quality._pairs(rows, good, bad, one, 40, 1).count() == times * max(good, bad)
        marked = rows.withColumn("x", F.when(F.col("_q_label") == 1, F.array(F.col("place") * 1000.0, F.lit(0.0))).otherwise(F.array(-F.col("place").cast("double"), F.lit(0.0))))
        found = [divmod(int(r.difference[0]), 1000) for r in quality._pairs(marked, good, bad, one, 40, 1).collect()]
        assert {g for g, _ in found} == set(range(good)) and {b for _, b in found} == set(range(bad))
        assert len(set(found)) == len(found)
