"""The registered queries of the operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.llm import bpe_replay, decontaminate, hard_negatives, html_text, langid, line_rules, line_templates, mixing
from forumlens.llm import periodic_runs, quality, simhash, token_files, warc
from forumlens.llm.common import BLANK, WORD, id_remainder, let, ship, table, words
from forumlens.session import keep, new_path

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder, tokenizer_path())
    return token_files.read_tokens(spark, folder)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(id_remainder(F.col("doc_id"), 4) != 2)
    figures = keep(quality.with_figures(docs.select("doc_id", "text")).drop("text"), "quality-figures")
    ranking = quality.learn(figures, labels.select("doc_id", F.col("quality").alias("label")))
    held_out = (id_remainder(F.col("doc_id"), 4) == 2).alias("held_out")
    return quality.with_scores(figures, ranking).select("doc_id", held_out, "score", "predicted")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dictionaries = langid.fit(docs.where(id_remainder(F.col("doc_id"), 3) != 1))
    found = langid.identified(docs, dictionaries)
    return found.select("doc_id", (id_remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.round("similarity", 6).alias("similarity"), "word")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "archive")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    field = warc.header_field
    return warc.read_archive(spark, path).select(
        field("WARC-Page-ID").cast("long").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        field("WARC-Type").alias("record_type"),
        field("WARC-Refers-To-Page-ID").cast("long").alias("refers_to"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_rules.clean_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_templates.drop_templates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.col("clean_text").alias("text"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = (tokenizer_path(RANKS), public_tokenizers.PATTERN)
    encoded = bpe_replay.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), *vocabulary)
    return bpe_replay.decode(encoded, *vocabulary).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _with_periods(text: Column, doc_id: Column) -> Column:
    """The text, which in every tenth document turns periodic from some word on."""
    hashed = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    draw = F.floor(hashed / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        first = (draw % n).cast("int")
        period = (1 + F.floor((n - first) / (3 + draw % 8))).cast("int")
        at = lambda i: w[F.when(i < first, i).otherwise(first + (i - first) % period)]
        return F.when(n > 0, F.concat_ws(" ", F.transform(F.sequence(F.lit(0), n - 1), at))).otherwise(text)

    return F.when(hashed % 10 == 0, let(words(text), repeated)).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", _with_periods(F.col("text"), F.col("doc_id")).alias("text"))
    # Of equally long runs the one with the smallest start, then period
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length, -r.start, -r.period)))
    line = lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n"))
    found = periodic_runs.with_runs(docs).withColumn("longest", longest)
    length, start, period = (F.col("longest")[c] for c in ("length", "col2", "col3"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-start).alias("start"),
        length.alias("length"),
        (-period).alias("period"),
        F.floor(1000 * length / -period).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label"))
    return hard_negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


def _ready(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    own = (
        op1_html_extraction,
        op2_simhash,
        op3_token_files,
        op4_quality,
        op5_language,
        op6_decontamination,
        op7_warc,
        op8_quality_rules,
        op9_line_dedup,
        op10_mixing,
        op11_bpe,
        op12_periodic_runs,
        op13_hard_negatives,
    )
    return {f.__name__: _ready(f) for f in own} | {"pipeline": corpus_pipeline.run}


def _base_sql() -> str:
    """The base figures of the line rules and the verdict, word by word."""
    rules, word, blank = line_rules, WORD, BLANK
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    count = lambda pattern: f"(length(x) - length(regexp_replace(x, {quoted(pattern)}, '', 'g')))"
    ended = f"right(rtrim(x, {quoted(rules.CLOSERS)}), 1) IN ({', '.join(map(quoted, rules.END_MARKS))})"
    notice = " OR ".join(f"contains(lower(x), {quoted(x)})" for x in rules.BOILERPLATE)
    fails = f"""((NOT {ended} AND len(regexp_extract_all(x, {quoted(word)})) < {rules.LONG_LINE})
    OR {count(rules.SYMBOLS)} > {rules.SYMBOL_SHARE} * length(x) OR {count(rules.SEPARATORS)} >= {rules.MENU_SEPARATORS}
    OR regexp_matches(lower(x), {quoted(rules.NAVIGATION_WORDS)}) OR {notice})"""
    return rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT doc_id, text, regexp_extract_all(text, '{word}') AS w FROM texts),
windows AS (SELECT doc_id, i, array_to_string(list_slice(w, i + 1, i + 5), ' ') AS five FROM (SELECT doc_id, w, unnest(range(len(w) - 4)) AS i FROM split)),
repeated AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM repeated) GROUP BY doc_id),
lines AS (SELECT doc_id, line, regexp_replace(line, '^{blank}+|{blank}+$', '', 'g') AS x
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts) WHERE regexp_matches(line, '{word}')),
judged AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines,
    sum(CASE WHEN {fails} THEN length(regexp_replace(x, '{blank}', '', 'g')) ELSE 0 END) AS lost FROM lines GROUP BY doc_id),
base AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '{blank}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '{rules.SYMBOLS}', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    coalesce(lost, 0) AS lost
  FROM split LEFT JOIN judged USING (doc_id) LEFT JOIN covered USING (doc_id))
SELECT * EXCLUDE (lost), n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND lost <= {rules.MAX_LOSS} * word_chars AS kept FROM base"""


def _leaks_sql() -> str:
    """All windows with a shingle of an item, compared shingle by shingle."""
    return rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '{WORD}') AS w FROM documents),
ds AS (SELECT doc_id, len(w) AS nd, i AS pos, array_to_string(list_slice(w, i + 1, i + 5), ' ') AS h
  FROM (SELECT doc_id, w, unnest(range(len(w) - 4)) AS i FROM d)),
b AS (SELECT item_id, regexp_extract_all(lower(text), '{WORD}') AS w FROM benchmark),
bs AS (SELECT item_id, len(w) AS n, i AS place, array_to_string(list_slice(w, i + 1, i + 5), ' ') AS h
  FROM (SELECT item_id, w, unnest(range(len(w) - 4)) AS i FROM b)),
met AS (SELECT DISTINCT doc_id, item_id, n, nd, pos FROM ds JOIN bs USING (h)),
windows AS (SELECT DISTINCT doc_id, item_id, n, unnest(range(greatest(0, pos - n + 5), least(pos, greatest(0, nd - n)) + 1)) AS word FROM met),
seen AS (SELECT doc_id, item_id, word, ds.h, count(*) AS c FROM windows JOIN ds USING (doc_id)
  WHERE pos BETWEEN word AND word + n - 5 GROUP BY ALL),
item AS (SELECT item_id, h, count(*) AS c FROM bs GROUP BY ALL),
pairs AS (SELECT doc_id, item_id, word, sum(least(seen.c, item.c)) AS common FROM seen JOIN item USING (item_id, h) GROUP BY ALL),
sizes AS (SELECT doc_id, item_id, word, sum(c) AS size FROM seen GROUP BY ALL),
alike AS (SELECT doc_id, item_id, word, CAST(common AS DOUBLE) / (sizes.size + (SELECT sum(c) FROM item i WHERE i.item_id = pairs.item_id) - common) AS s
  FROM pairs JOIN sizes USING (doc_id, item_id, word))
SELECT doc_id, item_id, round(s, 6) AS similarity, CAST(word AS BIGINT) AS word
FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY s DESC, word) AS place FROM alike
  WHERE s >= {decontaminate.SIMILARITY}) WHERE place = 1"""


def _mix_sql(seed: int = 10) -> str:
    """The mix with each source's documents in one order, by a running sum over all of it."""
    most, weights = mixing.MAX_COPIES, list(mixing.WEIGHTS)
    return rf"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, {weights}[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} + 1 AS INT)] AS weight FROM s),
shares AS (SELECT *, (sum(source_size) OVER () - coalesce({most} * sum(source_size) OVER before, 0))
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS share
  FROM w WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
goals AS (SELECT source, source_size, least(CAST({most} * source_size AS DOUBLE), weight *
    (SELECT share FROM shares WHERE share * weight <= {most} * source_size ORDER BY source_size / weight, share DESC LIMIT 1)) AS target FROM shares),
e AS (SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN least({most}.0::DOUBLE, target / source_size) ELSE 0 END AS ratio,
    (CAST('0x' || substr(md5('{seed}:' || doc_id), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN goals USING (source)),
p AS (SELECT *, floor(ratio + 1e-12::DOUBLE) AS sure, greatest(0, ratio - floor(ratio + 1e-12::DOUBLE)) AS part FROM e),
o AS (SELECT *, greatest(0, target - sure * source_size) AS lack, sum(size) OVER (PARTITION BY source
    ORDER BY (u / (1 - u)) / (part / (1 - part)), doc_id, size ROWS UNBOUNDED PRECEDING) AS running FROM p WHERE part > 0),
taken AS (SELECT doc_id, size, source_size, target, sure + CASE WHEN running - size / 2 <= lack THEN 1 ELSE 0 END AS copies FROM o
  UNION ALL SELECT doc_id, size, source_size, target, sure FROM p WHERE part = 0)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken FROM taken"""


def _negatives_sql() -> str:
    """The scores of all anchors with all rows."""
    scale = hard_negatives.SCALE
    return f"""
WITH r AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, r.id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM r a JOIN r ON a.id <> r.id WHERE a.id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INT) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER best <= 5"""


def oracle_sql() -> dict[str, str]:
    """For the operators that SQL can express; the others are tested against brute force."""
    return {
        "op6_decontamination": _leaks_sql(),
        "op7_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
k AS (SELECT page_id, html, strlen(html) AS n, max(page_id) OVER (PARTITION BY html) AS newest FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN n >= {warc.MIN_REVISIT_BYTES} AND page_id <> newest THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {warc.MIN_REVISIT_BYTES} AND page_id <> newest THEN newest END AS refers_to FROM k""",
        "op8_quality_rules": _base_sql(),
        "op10_mixing": _mix_sql(),
        "op13_hard_negatives": _negatives_sql(),
    }
