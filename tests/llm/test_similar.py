from __future__ import annotations

import random
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from forumlens.llm import similar, simhash
from forumlens.llm.common import ship


def plain_shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())


def plain_links(texts):
    """All pairs of ids with a similarity of 0.8 or more; texts without words are alike."""
    sets = {i: plain_shingles(t) for i, t in texts.items()}
    holders = {}
    for i, s in sets.items():
        for x in s or {None}:
            holders.setdefault(x, []).append(i)
    pairs = {p for ids in holders.values() for p in combinations(sorted(ids), 2)}
    return {(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])}


def plain_groups(texts):
    label = {i: i for i in texts}
    links = plain_links(texts)
    while True:
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return label


def changed(draw, text, share):
    return " ".join(f"new{draw.randrange(10**9)}" if draw.random() < share else w for w in text.split())


def found_groups(docs, **options):
    ship(docs.sparkSession)
    return {r.doc_id: r.g for r in similar.groups(docs, **options).select("doc_id", F.col("least.doc_id").alias("g")).collect()}


def near_copies(draw, originals, copies, most):
    texts = {}
    for _ in range(originals):
        text = " ".join(f"w{draw.randrange(5000)}" for _ in range(draw.randint(60, 400)))
        for share in [0.0, *(draw.uniform(0, most) for _ in range(copies))]:
            texts[len(texts)] = changed(draw, text, share)
    return texts


def test_recall_against_all_pairs_and_no_false_link(make_docs):
    texts = near_copies(random.Random(5), 400, 1, 0.03)
    found = found_groups(make_docs(*texts.items()))
    links = plain_links(texts)
    together = {(a, b) for a, b in links if found[a] == found[b]}
    assert len(links) > 250 and len(together) >= 0.9 * len(links)
    want = plain_groups(texts)
    assert {(a, b) for a, b in zip(range(0, 800, 2), range(1, 800, 2), strict=True) if found[a] == found[b]} <= {(a, b) for a, b in links}
    assert all(want[i] == want[g] for i, g in found.items())


def test_large_groups_and_split_keys(make_docs):
    texts = near_copies(random.Random(6), 3, 60, 0.02)
    docs = make_docs(*texts.items())
    want = plain_groups(texts)
    for bucket in (4096, 10):
        found = found_groups(docs, bucket=bucket)
        assert all(want[i] == want[g] for i, g in found.items())
        assert sum(found[i] != want[i] for i in texts) <= 0.03 * len(texts)


def test_exact_bound(make_docs):
    words = [f"w{i}" for i in range(13)]
    # 9 shingles of 13 words; one more word makes 10, of which 9 are shared; two words more at the other end 8 of 10
    docs = make_docs((1, " ".join(words)), (2, " ".join(words + ["x"])), (3, "a b c"), (4, "A  b\nC"), (5, "a b d"))
    sets = {i: similar.shingles(t) for i, t in ((1, " ".join(words)), (2, " ".join(words + ["x"])))}
    assert (len(sets[1]), len(sets[2]), len(np.intersect1d(sets[1], sets[2]))) == (9, 10, 9)
    found = found_groups(docs)
    assert found[3] == found[4] == 3 and found[5] == 5


def test_nearest_forest_connects_what_is_near():
    draw = np.random.default_rng(3)
    fps = np.unique(draw.integers(0, 1 << 12, 200).astype(np.uint64))
    for radius in (1, 2, 3):
        links = simhash.nearest_forest(fps, radius)
        assert all(int(fps[a] ^ fps[b]).bit_count() <= radius for a, b in links)
        label = list(range(len(fps)))
        every = [(a, b) for a, b in combinations(range(len(fps)), 2) if int(fps[a] ^ fps[b]).bit_count() <= radius]

        def joined(pairs):
            own = list(label)
            for _ in own:
                for a, b in pairs:
                    own[a] = own[b] = min(own[a], own[b])
            return own

        assert joined([tuple(x) for x in links.tolist()]) == joined(every)
    assert simhash.nearest_forest(fps[:1], 3).shape == (0, 2)


def test_odd_rows(make_docs):
    long = " ".join(f"w{i}" for i in range(50_000))
    docs = make_docs((1, None), (2, ""), (3, " \n"), (7, long), (5, long), (5, long), (None, long), (None, "x y"))
    docs = docs.withColumn("version", F.lit("v")).withColumn("fp", F.lit(1)).withColumn("set", F.lit(2)).withColumn("w", F.lit(3)).withColumn("w_id", F.lit(4))
    ship(docs.sparkSession)
    rows = similar.groups(docs)
    assert sorted(((r.doc_id, r.least.doc_id) for r in rows.collect()), key=str) == sorted([(1, 1), (2, 1), (3, 1), (7, 5), (5, 5), (5, 5), (None, 5), (None, None)], key=str)
    kept = simhash.one_of_each(docs, rows)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, (r.text or "")[:3]) for r in kept.collect()), key=str) == sorted([(1, ""), (5, "w0 "), (None, "x y")], key=str)
    assert similar.groups(docs.where("false")).collect() == []


def test_more_segments_find_more(make_docs):
    texts = near_copies(random.Random(9), 150, 1, 0.05)
    found = found_groups(make_docs(*texts.items()), segments=6)
    links = plain_links(texts)
    share = sum(found[a] == found[b] for a, b in links) / len(links)
    assert share >= 0.95


def test_every_link_is_found(make_docs):
    """Texts at the bound itself, of which keys of fingerprints missed some."""
    draw = random.Random(12)
    texts = near_copies(draw, 300, 2, 0.06)
    words = [f"v{i}" for i in range(40)]
    for size in (9, 14, 19, 24, 40):
        for cut in range(3):
            texts[len(texts)] = " ".join(words[:size] + [f"end{size}"] * 1 + words[:cut])
    want = plain_groups(texts)
    assert len(set(want.values())) < len(want) - 200
    docs = make_docs(*texts.items())
    for bucket in (4096, 4):
        assert found_groups(docs, bucket=bucket) == want


def test_forest_of_sets_joins_what_is_similar():
    draw = np.random.default_rng(8)
    base = draw.choice(10**6, 120, replace=False)
    sets = [np.unique(np.concatenate([draw.choice(base, draw.integers(95, 121), replace=False), draw.integers(0, 10**6, draw.integers(0, 14))])) for _ in range(150)]
    every = {(i, j) for i, j in combinations(range(150), 2) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    links = {tuple(sorted(x)) for x in similar.similar_forest(sets).tolist()}

    def joined(pairs):
        label = list(range(150))
        for _ in label:
            for a, b in pairs:
                label[a] = label[b] = min(label[a], label[b])
        return label

    assert links <= every and len(links) < 150 < len(every) and joined(links) == joined(every)
    assert similar.similar_forest(sets[:1]).shape == (0, 2)
