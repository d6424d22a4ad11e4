from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from forumlens.llm import line_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 10 or 100 * len(covered) > 20 * len(words),
    )


def figures(df):
    return line_rules.clean_lines(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_figures_match_plain_ones(make_docs, seed):
    draw = random.Random(seed)
    texts = []
    for i in range(60):
        parts = draw.choices(["a", "b", "c", "dé", "*x", "\n", "\t", "\x0b", " ", "\r\n", "a b\n", "\xa0", "<|"], k=draw.randint(0, 90))
        texts.append((i, draw.choice([" ", "", "  "]).join(parts)))
    found = {r.doc_id: tuple(r)[1:] for r in figures(make_docs(*texts)).collect()}
    assert found == {i: plain(t) for i, t in texts}


def test_given_documents(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    found = {r.doc_id: tuple(r)[1:] for r in figures(docs).collect()}
    short = [(r.doc_id, r.text) for r in docs.collect() if len(r.text or "") < 8000]
    assert {i: found[i] for i, _ in short} == {i: plain(t) for i, t in short}


@pytest.mark.parametrize(
    ("line", "fails"),
    [
        ("This is a sentence.", False),
        ('He said "so."', False),
        ("no end mark", True),
        (" ".join(["word"] * 20), False),
        ("Home | Search | Contact | Login.", True),
        ("Read more »", True),
        ("Please accept cookies to go on.", True),
        ("Copyright © 2001, all rights reserved.", True),
        ("Licensed under the Apache License, Version 2.0.", True),
        ("### $$$ *** ends.", True),
        ("Homework is done.", False),
    ],
)
def test_rules(spark, line, fails):
    assert spark.createDataFrame([(line,)], "x string").select(line_rules.line_fails(F.col("x"))).first()[0] == fails


def test_lost_text_rejects(make_docs):
    good, bad = "Here are ten plain words in a sentence of prose.", "Home | Search | Contact | Login"
    docs = make_docs((1, f"{good}\n{bad}"), (2, f"{good}\n{bad}\n{bad}\n{bad}"), (3, good))
    found = {r.doc_id: (r.kept, r.clean_text, r.n_lines, r.n_bad_lines) for r in line_rules.clean_lines(docs).collect()}
    assert found == {1: (True, good, 2, 1), 2: (False, good, 4, 3), 3: (True, good, 1, 0)}


def test_clean_documents_are_kept(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1")
    cleaned = line_rules.clean_lines(spark.read.parquet(f"{sf}/documents.parquet")).join(labels, "doc_id").where("not base_failed")
    kept = [r.kept for r in cleaned.select("kept").collect()]
    assert sum(kept) >= 0.98 * len(kept)


def test_odd_rows(make_docs):
    docs = make_docs((1, None), (2, ""), (3, " \n\n "), (4, "w " * 60_000), (4, "w " * 60_000))
    docs = docs.withColumn("kept", F.lit("x")).withColumn("n_words", F.lit(-1)).withColumn("clean_text", F.lit(0)).withColumn("_line_words", F.lit(1))
    found = sorted((r.doc_id, r.n_words, r.n_repeat_words, r.base_failed, r.kept, r.clean_text) for r in line_rules.clean_lines(docs).collect())
    assert found[:3] == [(i, 0, 0, True, False, "") for i in (1, 2, 3)]
    assert [f[:5] for f in found[3:]] == [(4, 60_000, 60_000, True, False)] * 2
    assert line_rules.clean_lines(docs.where("false")).collect() == []


def test_no_python_and_no_shuffle(make_docs):
    plan = line_rules.clean_lines(make_docs((1, "a")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
