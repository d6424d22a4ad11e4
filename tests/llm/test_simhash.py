from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from forumlens.llm import golay, simhash
from forumlens.llm.components import components


def plain_fingerprint(text, k=3):
    """Bit by bit, from the words of the contract."""
    import re

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids_and_fps):
    """The smallest id reachable, by comparing all pairs."""
    rows = list(ids_and_fps)
    least = {i: i for i in range(len(rows))}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 3:
                a, b = root(i), root(j)
                least[max(a, b, key=lambda x: rows[x][0])] = min(a, b, key=lambda x: rows[x][0])
    return [rows[root(i)][0] for i in range(len(rows))]


TEXTS = ["", "a", "A b", "a b c", "x\ty\nz\x0bw  v", "Ünï cödé Text ßs", "a\xa0b c d e f", "the " * 70_000]


@pytest.mark.parametrize("text", [None, *TEXTS])
def test_fingerprint_matches_the_plain_one(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)
    assert simhash.fingerprint(text, 5) == plain_fingerprint(text, 5)


def test_fingerprint_hash_is_that_of_spark(spark, make_docs):
    row = make_docs((1, "a b c")).select(F.xxhash64("text")).first()
    assert row[0] % (1 << 64) == simhash.fingerprint("A  b\nc")


def test_every_word_within_one_bit_shares_a_key():
    words = np.random.default_rng(1).integers(0, 1 << 23, 20_000)
    keys = golay.keys(words)
    assert (keys[:, 0] >= 0).all() and keys.max() < 4096
    for bit in range(23):
        near = golay.keys(words ^ (1 << bit))
        assert (near == keys[:, :1]).any(axis=1).all()


@pytest.mark.parametrize("blocks", [4, 5])
def test_fingerprints_within_three_bits_share_a_key(blocks):
    draw = np.random.default_rng(blocks)
    a = draw.integers(0, 1 << 64, 500, dtype=np.uint64)
    b = a.copy()
    for _ in range(3):
        b ^= np.uint64(1) << draw.integers(0, 64, 500).astype(np.uint64)
    met = [set(), set()]
    for side, fps in enumerate((a, b)):
        for row, key in simhash.keys(fps, blocks):
            met[side] |= set(zip(row.tolist(), key.tolist(), strict=True))
    assert {r for r, _ in met[0] & met[1]} == set(range(500))


def test_all_patterns_of_three_bits_share_a_key():
    """Also where a half has a bit more than the code, above exact bits that are 0."""
    patterns = np.array([(1 << a) | (1 << b) | (1 << c) for a in range(64) for b in range(a) for c in range(b)], dtype=np.uint64)
    assert len(patterns) == 41_664
    odd = sum(1 << b for b in range(1, 64, 2))
    for fp in (0, odd, (1 << 64) - 1, 0xFFFF0000FFFF0000):
        own = [key[row == 0] for row, key in simhash.keys(np.array([fp], dtype=np.uint64))]
        met = np.zeros(len(patterns), dtype=bool)
        for (row, key), mine in zip(simhash.keys(patterns ^ np.uint64(fp)), own, strict=True):
            met[row[np.isin(key, mine[0])]] = True
        assert met.all()


def test_bits_above_a_word_do_not_change_its_keys():
    words = np.random.default_rng(2).integers(0, 1 << 23, 1000)
    assert (golay.keys(words) == golay.keys(words | (1 << 23))).all() and golay.keys(words | (1 << 23)).max() < 4096


def fps_frame(spark, fps):
    return spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long").distinct()


@pytest.mark.parametrize("bucket", [simhash.BUCKET, 10])
def test_links_connect_what_all_pairs_do(spark, bucket):
    """Random fingerprints, pairs at 1 to 4 bits, chains, and a dense group; also with keys that are dealt out."""
    draw = random.Random(bucket)
    fps = [draw.getrandbits(64) for _ in range(150)]
    for base in fps[:60]:
        other = base
        for bit in draw.sample(range(64), draw.randint(1, 4)):
            other ^= 1 << bit
        fps.append(other)
    centre = draw.getrandbits(64)
    fps += [centre ^ (1 << i) ^ (1 << j) for i in range(0, 64, 3) for j in range(1, 64, 5)]
    fps = list(dict.fromkeys(fps))
    links = simhash.linked(fps_frame(spark, fps), bucket=bucket)
    pairs = [(r.a % (1 << 64), r.b % (1 << 64)) for r in links.collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
    ids = {f: i for i, f in enumerate(fps)}
    least = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(least[ids[a]], least[ids[b]])
            changed |= least[ids[a]] != low or least[ids[b]] != low
            least[ids[a]] = least[ids[b]] = low
    assert least == plain_components([(i, f) for i, f in enumerate(fps)])


def test_a_dense_group_gives_few_links(spark):
    fps = [(1 << i) | (1 << j) for i in range(64) for j in range(i)]
    links = simhash.linked(fps_frame(spark, fps))
    # All pairs would be millions; a forest per key is linear
    assert links.count() < 60 * len(fps)


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(7, 3), (3, 7), (5, 5)] + [(1000 + i, 1000) for i in range(50)]
    links = spark.createDataFrame(chain, "a long, b long")
    found = {r.node: r.component for r in components(links).collect()}
    assert found == {i: 100 for i in range(100, 161)} | {7: 3, 3: 3} | {1000 + i: 1000 for i in range(50)}
    assert components(links.where("a < 0")).collect() == []


def test_near_duplicates_match_brute_force(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = plain_components([(i, plain_fingerprint(t)) for i, t in rows])
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert found == {i: (f"{plain_fingerprint(t):016x}", c) for (i, t), c in zip(rows, want, strict=True)}


def test_odd_rows(make_docs):
    docs = make_docs((5, None), (3, ""), (9, " \n"), (4, "one two three four"), (4, "one two three four"), (None, "one two three four"), (8, "other words here"))
    docs = docs.withColumn("version", F.lit(1)).withColumn("fp", F.lit("x")).withColumn("least", F.lit(2))
    found = sorted((r.doc_id or 0, r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert found == [(0, 4), (3, 3), (4, 4), (4, 4), (5, 3), (8, 8), (9, 3)]
    kept = simhash.one_of_each(docs, simhash.groups(docs))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 8]


def test_no_rows(make_docs):
    docs = make_docs((1, "a")).where("false")
    assert simhash.near_duplicates(docs).collect() == []
    assert simhash.one_of_each(docs, simhash.groups(docs)).collect() == []
