"""Line deduplication by a log-template tree.

A line's place in the tree is its number of tokens, then its leading tokens, where
tokens with a digit count as variable. In a leaf, lines that agree in most tokens
share a template, in which the tokens that differ are variable too. A template
that stands in several documents is recurring, and its lines are dropped.

Equal lines are combined where they are read, and a task holds one leaf. The lines
of a leaf with more than a bounded number go through turns: in each, lines that share a
piece of tokens meet, and become templates by the same rule; these are the lines of the
next turn, and meet by another piece. When few enough are left they meet all.
Those of leaves that are still large meet in rounds by parts of the line, as many as
tokens may differ and one: lines that agree share a part. The rounds end when no two
lines of such a leaf agree, so none is kept from another by the size of its leaf.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.llm.common import let, spare
from forumlens.session import delete, keep, new_path

VARIABLE = "<*>"
#: Leading tokens of a leaf's path.
DEPTH = 3
#: Lines that meet at once. Lines of larger leaves meet by pieces of so many tokens, from so many places.
LEAF_LINES = 5000
TURNS, PIECE = 8, 2
#: The least share of equal tokens for a common template; tokens with digits are equal to each other.
AGREEMENT = 0.75
#: A template recurs if it stands in so many documents; below SHORT tokens, where lines meet by chance, in more.
MIN_DOCS = 2
SHORT = 5
SHORT_DOCS = 10
#: Lines combined in a task before they are sent on.
GATHERED = 50_000


_ASCII_DIGIT = re.compile("[0-9]").search


def _has_digit(text: str) -> bool:
    """Whether any character counts as a digit."""
    return bool(_ASCII_DIGIT(text)) if text.isascii() else any(map(str.isdigit, text))


def masked(line: str) -> str:
    """The tokens of a line, those with a digit as VARIABLE, joined by spaces; empty without tokens."""
    tokens = line.split()
    if _has_digit(line):
        tokens = [VARIABLE if _has_digit(t) else t for t in tokens]
    return " ".join(tokens)


def _number(value: str) -> int:
    """As Spark's ``xxhash64``."""
    number = xxhash.xxh64_intdigest(value.encode("utf-8", "replace"), seed=42)
    return number - (1 << 64) if number >> 63 else number


def _leaf(line: str) -> int:
    return _number(f"{line.count(' ') + 1} {' '.join(line.split(' ', DEPTH)[:DEPTH])}")


def line_hashes(docs: DataFrame) -> DataFrame:
    """``doc, version, place, line`` of each line with a token: the hash of its masked form.

    ``version`` is a hash of the text; it tells rows apart that repeat an id.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, versions, places, found = [], [], [], []
            for doc, version, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                for place, line in enumerate((text.as_py() or "").split("\n")):
                    m = masked(line)
                    if m:
                        ids.append(doc)
                        versions.append(version)
                        places.append(place)
                        found.append(_number(m))
            columns = [pa.array(ids, batch.column(0).type), pa.array(versions, pa.int64()), pa.array(places, pa.int32()), pa.array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "version", "place", "line"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("version"), "text")
    return rows.mapInArrow(make, f"doc {kind}, version long, place int, line long")


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``leaf, line, docs, low, high``: masked lines, how many rows have them, and the least and the greatest of those."""
    gathered: dict[str, list[int]] = {}

    def rows() -> pa.RecordBatch:
        texts = list(gathered)
        values = list(gathered.values())
        return pa.RecordBatch.from_pydict(
            {
                "leaf": pa.array(list(map(_leaf, texts)), pa.int64()),
                "line": pa.array(texts, pa.string()),
                "docs": pa.array([v[0] for v in values], pa.int64()),
                "low": pa.array([v[1] for v in values], pa.int64()),
                "high": pa.array([v[2] for v in values], pa.int64()),
            }
        )

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            for m in set(map(masked, (text.as_py() or "").split("\n"))):
                if not m:
                    continue
                have = gathered.get(m)
                if have is None:
                    gathered[m] = [1, doc, doc]
                else:
                    have[0] += 1
                    have[1] = min(have[1], doc)
                    have[2] = max(have[2], doc)
            if len(gathered) >= GATHERED:
                yield rows()
                gathered.clear()
    if gathered:
        yield rows()


def _recurs(n: int, docs: int, low: int, high: int) -> bool:
    return low != high and docs >= (SHORT_DOCS if n < SHORT else MIN_DOCS)


def _templates(lines: list[tuple[str, int, int, int]]) -> Iterator[tuple[str, list[int]]]:
    """The templates of lines of one leaf, each with the numbers of its lines."""
    if len(lines) == 1:
        yield lines[0][0], [0]
        return
    # The most frequent first; equal ones by text, so the order of rows does not matter
    order = sorted(range(len(lines)), key=lambda i: (-lines[i][1], lines[i][0]))
    split = [lines[i][0].split(" ") for i in order]
    n = len(split[0])
    numbers: dict[str, int] = {VARIABLE: 0}
    tokens = np.array([[numbers.setdefault(t, len(numbers)) for t in s] for s in split], dtype=np.int32)
    forms = np.empty((len(lines), n), dtype=np.int32)
    members: list[list[int]] = []
    for i, row in zip(order, tokens, strict=True):
        used = len(members)
        if used:
            # A place that has become variable no longer counts as equal to a token
            known = forms[:used]
            equal = (known == row).sum(axis=1)
            best = int(equal.argmax())
            if equal[best] >= AGREEMENT * n:
                known[best][known[best] != row] = 0
                members[best].append(i)
                continue
        forms[used] = row
        members.append([i])
    words = list(numbers)
    for form, own in zip(forms, members, strict=False):
        yield " ".join(words[t] for t in form), own


def _groups(batches: Iterator[pa.RecordBatch], most: int | None = None) -> Iterator[tuple[int, list[tuple[str, int, int, int]]]]:
    """The lines of each group together, at most ``most`` at a time, from rows ``group, line, docs, low, high`` in order."""
    group, held = None, []
    for batch in batches:
        for key, text, docs, low, high in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and key == group and held[-1][0] == text:
                same = held[-1]
                held[-1] = (text, same[1] + docs, min(same[2], low), max(same[3], high))
                continue
            if held and (key != group or len(held) == most):
                yield group, held
                held = []
            group = key
            held.append((text, docs, low, high))
    if held:
        yield group, held


def _parse(lines: DataFrame) -> DataFrame:
    """``line, template, docs`` of the lines in recurring templates, from lines of whole leaves."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, str, int]] = []

        def rows() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) if out else [[]] * 3
            kinds = [pa.int64(), pa.string(), pa.int64()]
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["line", "template", "docs"])
            out.clear()
            return made

        for _, held in _groups(batches):
            for template, own in _templates(held):
                docs = sum(held[i][1] for i in own)
                if _recurs(template.count(" ") + 1, docs, min(held[i][2] for i in own), max(held[i][3] for i in own)):
                    out.extend((_number(held[i][0]), template, docs) for i in own)
            if len(out) > GATHERED:
                yield rows()
        yield rows()

    rows = lines.select("leaf", "line", "docs", "low", "high").repartition("leaf").sortWithinPartitions("leaf", "line")
    return rows.mapInArrow(parse, "line long, template string, docs long")


_LINES = "leaf long, line string, docs long, low long, high long"


def _merge(lines: DataFrame, turn: int | None, most: int) -> DataFrame:
    """The columns of ``lines`` with ``template``: what each line becomes among those that it meets.

    Without a turn a leaf is met whole. In a turn, lines of a leaf meet that share a
    piece of it: the tokens from the turn's place on. Of a piece with more than
    ``most`` lines so many neighbours meet, in order from that place on.
    """
    if turn is None:
        ordered = lines.withColumn("home", F.col("leaf")).withColumn("turned", F.col("line"))
    else:
        tokens = F.split("line", " ")
        n = F.size(tokens)
        start = (F.lit(DEPTH) + F.floor(F.lit(turn) * (n - DEPTH) / TURNS)).cast("int")
        # Of four tokens any one may differ beside the leading three, of five one of two
        piece = F.when(n <= DEPTH + 1, 0).when(n == DEPTH + 2, 1).otherwise(PIECE)
        turned = F.concat(F.slice(tokens, start + 1, n), F.slice(tokens, F.lit(1), start))
        lines = lines.withColumn("turned", F.array_join(turned, " "))
        ordered = lines.withColumn("home", F.xxhash64("leaf", F.array_join(F.slice(F.split("turned", " "), F.lit(1), piece), " ")))
    ordered = ordered.repartition("home").sortWithinPartitions("home", "leaf", "turned")
    return _merged(lines.drop("turned"), ordered, most)


def _merged(lines: DataFrame, ordered: DataFrame, most: int) -> DataFrame:
    """``lines`` with ``template``, from the same lines in the order of their ``home``, where ``most`` meet."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _groups(batches, most):
            line, template = [], []
            for form, own in _templates(held):
                line += [held[i][0] for i in own]
                template += [form] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(line, pa.string()), pa.array(template, pa.string())], ["line", "template"])

    made = ordered.select("home", "line", "docs", "low", "high").mapInArrow(merge, "line string, template string")
    return lines.join(made.withColumnRenamed("line", "line2"), F.col("line") == F.col("line2")).drop("line2")


def _nearest(group: pa.Table) -> pa.Table:
    """``line, partner, equal, docs``: of each line the earlier one that has the most tokens in common, if these are enough."""
    lines = sorted(zip(group.column("line").to_pylist(), group.column("docs").to_pylist(), strict=True), key=lambda x: (-x[1], x[0]))
    numbers: dict[str, int] = {}
    tokens = np.array([[numbers.setdefault(t, len(numbers)) for t in line.split(" ")] for line, _ in lines], dtype=np.int32)
    out: list[tuple[str, str, int, int]] = []
    for i in range(1, len(lines)):
        equal = (tokens[:i] == tokens[i]).sum(axis=1)
        best = int(equal.argmax())
        if equal[best] >= AGREEMENT * tokens.shape[1]:
            out.append((lines[i][0], lines[best][0], int(equal[best]), lines[best][1]))
    columns = list(zip(*out, strict=True)) if out else [[]] * 4
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int64()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["line", "partner", "equal", "docs"])


def _joining(lines: DataFrame, most: int) -> DataFrame:
    """``line, partner``: lines that agree with an earlier one of their leaf which agrees with none before it.

    The more frequent line is the earlier. All lines of a leaf that agree meet: they
    have a part in common, and of a part that more than ``most`` lines share, these
    are dealt out in chunks, every two of which meet.
    """
    tokens = F.split("line", " ")
    n = F.size(tokens)
    rest, differ = n - DEPTH, n - F.ceil(n * AGREEMENT).cast("int")
    # Where all but the leading tokens may differ, all lines agree
    parts = F.when(differ >= rest, 1).otherwise(differ + 1)
    edge = lambda part: (F.lit(DEPTH) + F.floor(part * F.col("rest") / F.col("parts"))).cast("int")
    cut = lines.select("leaf", "line", "docs", tokens.alias("tokens"), rest.alias("rest"), differ.alias("differ"), parts.alias("parts"))
    cut = cut.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    shared = F.slice("tokens", edge(F.col("part")) + 1, F.greatest(F.lit(0), edge(F.col("part") + 1) - edge(F.col("part"))))
    content = F.when(F.col("differ") >= F.col("rest"), "").otherwise(F.array_join(shared, " "))
    met = cut.select("leaf", "line", "docs", F.xxhash64("leaf", "part", content).alias("key"))
    met = met.withColumn("n", F.count("*").over(Window.partitionBy("leaf", "key"))).where("n > 1")
    met = met.withColumn("chunks", F.when(F.col("n") <= most, 1).otherwise(F.ceil(F.col("n") / (most / 2))).cast("long"))
    met = met.withColumn("own", F.pmod(F.xxhash64("line"), F.col("chunks")))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).where("chunks = 1 or own <> other")
    met = met.select("leaf", "line", "docs", F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"))
    near = met.groupBy("leaf", "key").applyInArrow(_nearest, "line string, partner string, equal int, docs long")
    near = near.groupBy("line").agg(F.min(F.struct(-F.col("equal"), -F.col("docs"), F.col("partner"))).alias("best"))
    near = keep(near.select("line", F.col("best.partner").alias("partner")), "agreeing")
    return near.join(near.select(F.col("line").alias("line2")), F.col("partner") == F.col("line2"), "left_anti")


def _round(lines: DataFrame, joining: DataFrame, most: int) -> DataFrame:
    """``lines`` with ``template``: lines become one with the line that they join, by the rule of a leaf."""
    homes = joining.unionByName(joining.select(F.col("partner").alias("line"), "partner").distinct())
    inside = lines.join(homes.withColumnRenamed("line", "line2"), F.col("line") == F.col("line2")).drop("line2")
    inside = inside.withColumn("home", F.xxhash64("leaf", "partner")).drop("partner")
    # The line that is joined comes first
    ordered = inside.repartition("home").sortWithinPartitions("home", "leaf", F.desc("docs"), "line")
    others = lines.join(homes.select(F.col("line").alias("line2")), F.col("line") == F.col("line2"), "left_anti")
    return _merged(inside.drop("home"), ordered, most).unionByName(others.withColumn("template", F.col("line")))


def _of_large(lines: DataFrame, leaf_lines: int) -> DataFrame:
    """``line, template, docs`` of different lines of large leaves that recur."""
    members = None
    same = lambda rows: rows.withColumn("template", F.col("line"))
    inside = F.col("leaf") == F.col("leaf2")

    def moved(step: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The lines of the next step, and which of them each line at the start has become."""
        step = keep(step, "templates")
        to = step.select(F.xxhash64("line").alias("line2"), F.xxhash64("template").alias("to"))
        if members is None:
            now = to.withColumnRenamed("line2", "line")
        else:
            now = keep(members.join(to, F.col("to_now") == F.col("line2")).select("line", "to"), "members")
        left = step.groupBy("leaf", F.col("template").alias("line")).agg(F.sum("docs").alias("docs"), F.min("low").alias("low"), F.max("high").alias("high"))
        return keep(left, "templates"), now.withColumnRenamed("to", "to_now")

    for turn in [*range(TURNS), None]:
        large = lines.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") > leaf_lines)
        large = keep(large.select(F.col("leaf").alias("leaf2")), "large-leaves")
        more = not large.isEmpty()
        if turn is not None and not more:
            continue
        few, many = lines.join(large, inside, "left_anti"), lines.join(large, inside, "left_semi")
        step = same(few).unionByName(_merge(many, turn, leaf_lines)) if turn is not None else _merge(few, None, leaf_lines).unionByName(same(many))
        lines, members = moved(step)
    # Leaves that are still large, until no two lines agree in any of them
    while more:
        joining = keep(_joining(lines.join(large, inside, "left_semi"), leaf_lines), "joining")
        if joining.isEmpty():
            break
        lines, members = moved(_round(lines, joining, leaf_lines))
    least = F.when(F.size(F.split("line", " ")) < SHORT, SHORT_DOCS).otherwise(MIN_DOCS)
    found = lines.where((F.col("low") != F.col("high")) & (F.col("docs") >= least)).select(F.xxhash64("line").alias("number"), F.col("line").alias("template"), "docs")
    return members.join(found, F.col("to_now") == F.col("number")).select("line", "template", "docs")


def recurring(docs: DataFrame, leaf_lines: int = LEAF_LINES) -> DataFrame:
    """``line, template, docs``: hashes of the masked lines that recur, with their templates.

    ``docs`` counts a document once for each different masked line. A null doc_id
    is an id of its own.
    """
    return _recurring(keep(_gathered(docs), "lines"), leaf_lines)


def _gathered(docs: DataFrame) -> DataFrame:
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 62)))
    return docs.select(number.alias("doc_id"), "text").mapInArrow(_lines, _LINES)


def _recurring(rows: DataFrame, leaf_lines: int) -> DataFrame:
    large = rows.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") > leaf_lines)
    large = keep(large.select(F.col("leaf").alias("leaf2")), "large-leaves")
    inside = F.col("leaf") == F.col("leaf2")
    small = _parse(rows.join(large, inside, "left_anti"))
    if large.isEmpty():
        return small
    lines = rows.join(large, inside, "left_semi").groupBy("leaf", "line")
    lines = lines.agg(F.sum("docs").alias("docs"), F.min("low").alias("low"), F.max("high").alias("high"))
    return small.unionByName(_of_large(keep(lines, "lines"), leaf_lines))


def drop_templates(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with ``n_lines, n_dropped`` and ``clean_text``.

    ``n_lines`` counts lines with a token, ``n_dropped`` those of recurring
    templates; ``clean_text`` is the text without these, all other lines as they
    are. Null and empty texts have no lines and an empty ``clean_text``. Rows that
    repeat an id and text are one document. Columns of ``docs`` with one of the
    three names are replaced. A null doc_id is an id of its own.
    """
    doc, version, places, lines = (spare(docs, f"_drop_{n}") for n in ("doc", "version", "places", "lines"))
    spark, path = docs.sparkSession, new_path(docs.sparkSession, "lines")
    _gathered(docs).write.parquet(path)
    found = _recurring(spark.read.schema(_LINES).parquet(path), LEAF_LINES)
    bad = keep(found.select(F.col("line").alias("line2")).distinct(), "recurring-lines")
    # Nothing reads the lines again, and the texts are yet to be shuffled
    delete(spark, path)
    marked = line_hashes(docs).join(bad, F.col("line") == F.col("line2"), "left")
    flags = marked.groupBy(F.col("doc").alias(doc), F.col("version").alias(version)).agg(
        F.sort_array(F.collect_set(F.when(F.col("line2").isNotNull(), F.col("place")))).alias(places),
        F.count_distinct("place").cast("long").alias(lines),
    )
    own = docs.drop("n_lines", "n_dropped", "clean_text")
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.xxhash64("text") == F.col(version))
    text = F.coalesce(F.col("text"), F.lit(""))
    n_dropped = F.coalesce(F.size(places), F.lit(0))
    rest = let(F.split(text, "\n", -1), lambda found: _without(found, F.col(places)))
    return (
        own.join(flags, same, "left")
        .withColumns(
            {
                "n_lines": F.coalesce(lines, F.lit(0).cast("long")),
                "n_dropped": n_dropped.cast("long"),
                "clean_text": F.when(n_dropped == 0, text).otherwise(rest),
            }
        )
        .drop(doc, version, places, lines)
    )


def _without(lines: Column, places: Column) -> Column:
    """The lines at other places than ``places`` (ascending), joined: the slices between them."""
    last = F.size(places)
    start = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(places, i - 1) + 1)
    stop = lambda i: F.when(i == last, F.size(lines)).otherwise(F.get(places, i))
    runs = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(lines, start(i) + 1, F.greatest(F.lit(0), stop(i) - start(i))))
    return F.array_join(F.flatten(runs), "\n")
