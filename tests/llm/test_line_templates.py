from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from forumlens.llm import line_templates as lt

PASSAGE = " ".join(f"passage{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))


def cleaned(docs):
    return {r.doc_id: (r.n_lines, r.n_dropped, r.clean_text) for r in lt.drop_templates(docs).collect()}


def test_masked():
    assert lt.masked(" Page 3 of  10\t") == "Page <*> of <*>"
    assert lt.masked("\t ") == "" and lt.masked("plain words") == "plain words"


def test_recurring_lines_go(make_docs):
    rows = [(i, f"Own text {chr(97 + i) * 9} stands {chr(98 + i) * 4} here {chr(99 + i) * 7}.\n{PASSAGE}\nLast words {chr(97 + i) * 5}.") for i in range(3)]
    alone = (9, "A line of its own that nobody else has.\n\nAnd another line without any copy.")
    found = cleaned(make_docs(*rows, alone))
    for i in range(3):
        n, dropped, text = found[i]
        assert (n, dropped) == (3, 1) and PASSAGE not in text and chr(97 + i) * 5 in text
    assert found[9] == (2, 0, alone[1])


def test_variable_fields(make_docs):
    lines = [
        "Posted by alice on Monday in the general news section",
        "Posted by alice on Friday in the general news section",
        "Posted by alice on Sunday in the general news section",
        "Posted by alice but nothing else is alike in this",
    ]
    found = cleaned(make_docs(*enumerate(lines)))
    assert [found[i][1] for i in range(4)] == [1, 1, 1, 0]
    templates = {r.template for r in lt.recurring(make_docs(*enumerate(lines))).collect()}
    assert templates == {"Posted by alice on <*> in the general news section"}


def test_numbers_are_variable(make_docs):
    found = cleaned(make_docs((1, "Updated at 10:31 by the night shift"), (2, "Updated at 11:59 by the night shift")))
    assert [v[1] for v in found.values()] == [1, 1]


def test_short_lines_need_more_documents(make_docs):
    few = [(i, "Yes.") for i in range(lt.SHORT_DOCS - 1)]
    assert {v[1] for v in cleaned(make_docs(*few)).values()} == {0}
    assert {v[1] for v in cleaned(make_docs(*few, (99, "Yes."))).values()} == {1}


def test_repeats_within_a_document_do_not_recur(make_docs):
    line = "The same line stands here many times over"
    found = cleaned(make_docs((1, "\n".join([line] * 5)), (2, "something else entirely stands in here")))
    assert found[1][:2] == (5, 0) and found[2][:2] == (1, 0)


@pytest.mark.parametrize("leaf_lines", [lt.LEAF_LINES, 4])
def test_large_leaves(make_docs, leaf_lines):
    """Lines with the same first words: those that recur do so whatever the size of a leaf."""
    draw = random.Random(1)
    word = lambda: "".join(draw.choices("abcdefghij", k=6))
    rows = [(i, f"We went to the old {' '.join(word() for _ in range(9))}") for i in range(30)]
    rows += [(100 + i, f"We went to the old castle and then saw it by the {['north', 'south', 'east'][i % 3]} side") for i in range(6)]
    docs = make_docs(*rows)
    lines = {r.line for r in lt.recurring(docs, leaf_lines).collect()}
    assert {lt._number(lt.masked(t)) for i, t in rows if i >= 100} <= lines
    assert not {lt._number(lt.masked(t)) for i, t in rows if i < 100} & lines


@pytest.mark.parametrize("place", range(4, 12, 3))
def test_variable_words_at_any_place(make_docs, place):
    """Forty lines that differ in one or two words from the fifth on have one template at every size of a leaf."""
    draw = random.Random(place)
    rows = []
    for i in range(40):
        tokens = "the clerk of our town office read these old papers aloud to them".split()
        for p in {place, draw.choice([place, 12])}:
            tokens[p] = "".join(draw.choices("abcdefghij", k=8))
        rows.append((i, " ".join(tokens)))
    docs = make_docs(*rows)
    many, few = ({tuple(r) for r in lt.recurring(docs, n).collect()} for n in (lt.LEAF_LINES, 4))
    assert many == few and len(many) == 40


def plain_tree(docs):
    """Line, template and documents by the rule of the tree, one leaf after the other, token by token."""
    seen = {}
    for doc, text in docs:
        for m in {lt.masked(x) for x in (text or "").split("\n")} - {""}:
            seen.setdefault(m, []).append(doc)
    leaves = {}
    for m in sorted(seen, key=lambda m: (-len(seen[m]), m)):
        tokens = m.split(" ")
        forms = leaves.setdefault((len(tokens), *tokens[: lt.DEPTH]), [])
        best = max(forms, key=lambda f: sum(a == b for a, b in zip(f[0], tokens, strict=True)), default=None)
        if best and sum(a == b for a, b in zip(best[0], tokens, strict=True)) >= 0.75 * len(tokens):
            best[0][:] = [a if a == b else lt.VARIABLE for a, b in zip(best[0], tokens, strict=True)]
            best[1].append(m)
        else:
            forms.append((tokens, [m]))
    found = set()
    for leaf, forms in leaves.items():
        for form, lines in forms:
            ids = [d for m in lines for d in seen[m]]
            if len(set(ids)) > 1 and len(ids) >= (10 if leaf[0] < 5 else 2):
                found |= {(lt._number(m), " ".join(form), len(ids)) for m in lines}
    return found


def test_tree_matches_brute_force(spark, sample, make_docs):
    docs = spark.read.parquet(f"{sample}/documents.parquet").dropDuplicates(["doc_id"])
    draw = random.Random(3)
    made = [(i, "\n".join(" ".join(draw.choices("abc7", k=draw.randint(1, 9))) for _ in range(4))) for i in range(200)]
    for frame in (docs, make_docs(*made)):
        rows = [(r.doc_id, r.text) for r in frame.collect()]
        assert {tuple(r) for r in lt.recurring(frame).collect()} == plain_tree(rows)


def test_a_hot_leaf_ends(spark):
    """A leaf of 200,000 lines, all but some of which are like no other."""
    word = lambda k: F.substring(F.md5(F.concat(F.col("id").cast("string"), F.lit(f"-{k}"))), 1, 8)
    letters = lambda k: F.translate(word(k), "0123456789", "ghijklmnop")
    rest = F.when(F.col("id") % 1000 == 0, F.concat_ws(" ", F.lit("but then came the"), letters(1), F.lit("of the hill")))
    rest = F.coalesce(rest, F.concat_ws(" ", *[letters(k) for k in range(8)]))
    docs = spark.range(200_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("we all saw "), rest).alias("text"))
    found = lt.recurring(docs).groupBy("template").count().collect()
    assert [tuple(r) for r in found] == [("we all saw but then came the <*> of the hill", 200)]


def test_exact_recurrence_matches_brute_force(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    where = {}
    for i, text in rows:
        for line in text.split("\n"):
            where.setdefault(lt.masked(line), set()).add(i)
    found = cleaned(docs)
    for i, text in rows:
        lines = [(x, lt.masked(x)) for x in text.split("\n")]
        must = [x for x, m in lines if m and len(where[m]) >= (lt.SHORT_DOCS if m.count(" ") + 1 < lt.SHORT else lt.MIN_DOCS)]
        n, dropped, clean = found[i]
        assert n == sum(bool(m) for _, m in lines) and dropped >= len(must)
        left = clean.split("\n")
        assert not set(must) & set(left)
        # What stays is in order, and nothing is made up
        order = iter(text.split("\n"))
        assert clean == "" or all(x in order for x in left)


def test_odd_rows(make_docs):
    line = "A rather common line with some more words"
    docs = make_docs((1, None), (2, ""), (3, " \n"), (4, line), (4, line), (None, line), (5, "x" * 200_000 + "\n" + line))
    docs = docs.withColumn("n_lines", F.lit("x")).withColumn("line", F.lit(1)).withColumn("doc", F.lit(2)).withColumn("version", F.lit(3)).withColumn("_drop_doc", F.lit(4)).withColumn("_drop_places", F.lit(5))
    found = lt.drop_templates(docs)
    assert sorted(found.columns) == sorted({*docs.columns, "n_lines", "n_dropped", "clean_text"})
    got = sorted((r.doc_id or 0, r.n_lines, r.n_dropped, r.clean_text) for r in found.collect())
    assert got == [(0, 1, 1, ""), (1, 0, 0, ""), (2, 0, 0, ""), (3, 0, 0, " \n"), (4, 1, 1, ""), (4, 1, 1, ""), (5, 2, 1, "x" * 200_000)]
    assert lt.drop_templates(docs.where("false")).collect() == []


def test_a_hot_line(spark):
    line = "This very common line stands in all of the documents"
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit(line + "\nown "), F.md5(F.col("id").cast("string"))).alias("text"))
    found = lt.drop_templates(docs).agg(F.min("n_dropped"), F.count("*")).first()
    assert found[0] >= 1 and found[1] == 20_000


@pytest.mark.parametrize("leaf_lines", [lt.LEAF_LINES, 4])
def test_lines_that_share_no_piece_meet(make_docs, leaf_lines):
    """Twelve lines of 40 tokens that differ in one token of each turn's piece, among others of their leaf."""
    starts = [lt.DEPTH + turn * (40 - lt.DEPTH) // lt.TURNS for turn in range(lt.TURNS)]
    letters = lambda *x: "".join(chr(97 + int(c)) for c in "".join(f"{i:03d}" for i in x))
    rows = []
    for i in range(12):
        tokens = [f"w{letters(p)}" for p in range(40)]
        for p in starts:
            tokens[p] = f"x{letters(p, i)}"
        rows.append((i, " ".join(tokens)))
    alone = [(100 + i, " ".join([f"w{letters(p)}" for p in range(lt.DEPTH)] + [f"y{letters(p, i)}" for p in range(40 - lt.DEPTH)])) for i in range(12)]
    found = {tuple(r) for r in lt.recurring(make_docs(*rows, *alone), leaf_lines).collect()}
    assert {x[0] for x in found} == {lt._number(t) for _, t in rows}
    assert {x[1:] for x in found} == {(" ".join("<*>" if p in starts else f"w{letters(p)}" for p in range(40)), 12)}


def test_no_two_lines_that_agree_stay_apart(make_docs):
    """Templates of a leaf cut at four lines: no two that could meet are left, and brute force finds the same lines."""
    draw = random.Random(21)
    rows = [(i, "in the town " + " ".join(draw.choices("abc", k=6))) for i in range(150)]
    docs = make_docs(*rows)
    found = lt.recurring(docs, 4).collect()
    forms = sorted({r.template for r in found})
    agree = lambda a, b: sum(x == y for x, y in zip(a.split(), b.split(), strict=True)) >= 0.75 * 9
    assert len(forms) > 1 and not any(agree(a, b) for a in forms for b in forms if a < b)
    single = {t for _, t in rows if lt._number(t) not in {r.line for r in found}}
    assert not any(agree(a, b) for a in single for b in single if a < b)
