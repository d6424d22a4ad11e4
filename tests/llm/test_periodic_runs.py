"""Runs of words against all periods of all stretches."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import __spark_entry__ as entry
from forumlens.llm import periodic_runs
from forumlens.llm.common import WORD


def brute(words: list, least: int = periodic_runs.MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of all maximal runs, period by period."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            start = i
            while i < n - q and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(least, 2 * q):
                run = words[start : i + q]
                if not any(run[r:] == run[:-r] for r in range(1, q)):
                    found.append((start, len(run), q))
            i += i == start
    return sorted(found)


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> str:
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def _texts(rng: random.Random) -> list[str]:
    kind, n, letters = rng.random(), rng.randint(0, 90), rng.choice([1, 2, 2, 3, 5, 30])
    words = [rng.randrange(letters) for _ in range(n)]
    if kind < 0.4 and n:
        root = words[: rng.randint(1, max(1, n // 2))]
        words = (root * n)[:n]
        for _ in range(rng.randint(0, 2)):
            words[rng.randrange(n)] = rng.randrange(letters)
    elif kind > 0.95:
        before, words = [0], [0, 1]
        while len(words) < 80:
            before, words = words, words + before
    elif kind > 0.8:
        block = [0] * rng.randint(2, 12) + [1]
        words = block * rng.randint(1, 6) + [0] * rng.randint(0, 20) + block * rng.randint(0, 4)
    return [str(w) for w in words]


def test_all_runs_of_small_texts():
    rng, total = random.Random(12), 0
    for _ in range(1_000):
        docs = [_texts(rng) for _ in range(rng.randint(1, 4))]
        found = periodic_runs._of_documents([[w.encode() for w in words] for words in docs])
        for words, runs in zip(docs, found):
            wanted = brute(words)
            assert [tuple(r) for r in runs] == wanted, words
            total += len(wanted)
    assert total > 2_000


def test_long_periods_and_one_word_only():
    rng = random.Random(1)
    root = [b"%d" % rng.randrange(4_000) for _ in range(5_000)]
    same = [b"a"] * 200_000
    blocks = ([b"a"] * 999 + [b"b"]) * 8
    found = periodic_runs._of_documents([root * 4 + root[:17], same, root, blocks])
    assert found[0] == [(0, 20_017, 5_000)]
    assert found[1] == [(0, 200_000, 1)]
    assert found[2] == []
    assert (0, 8_000, 1_000) in found[3] and len(found[3]) == 9


def test_frame(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "BATCH_WORDS", 15)
    texts = ["a b " * 6, None, "", " x  ", "a b " * 5, "a  b\n" * 7 + "c", "a b " * 6]
    docs = spark.createDataFrame([(i, t, "old", None) for i, t in enumerate(texts)], "doc_id int, text string, Runs string, x binary").coalesce(1)
    out = periodic_runs.with_runs(docs)
    assert out.columns == ["doc_id", "text", "x", "runs", "collapsed"]
    rows = {r.doc_id: r for r in out.collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        words = re.findall(WORD, text or "")
        assert [tuple(r) for r in rows[i].runs] == brute(words)
        assert rows[i].collapsed == collapsed(words, brute(words)) and rows[i].text == text
    assert rows[5].collapsed == "a b c" and rows[4].runs == []
    assert periodic_runs.with_runs(docs.limit(0)).collect() == []


def test_query(spark, sample):
    rows = {r.doc_id: r for r in entry.queries()["op12_periodic_runs"](spark, sample).collect()}
    docs = spark.read.parquet(f"{sample}/documents.parquet").collect()
    assert len(rows) == len(docs)
    planted = 0
    for doc in docs:
        words = re.findall(WORD, doc.text or "")
        n, h = len(words), zlib.crc32(str(doc.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        if n > 600:
            # Too many stretches to try; a run still is what it says
            wanted = [tuple(x) for x in periodic_runs._of_documents([[w.encode() for w in words]])[0]]
            assert all(words[s : s + n - q] == words[s + q : s + n] for s, n, q in wanted)
        else:
            wanted = brute(words)
        best = max(wanted, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        row = rows[doc.doc_id]
        assert row.n_runs == len(wanted)
        assert (row.start, row.length, row.period) == best
        assert row.exponent_milli == (1000 * best[1] // best[2] if wanted else None)
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in wanted)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed(words, wanted).encode()).hexdigest()
    assert planted > 5
