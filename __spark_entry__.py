"""The registered queries: one per operator and report, over the whole given tables."""

from __future__ import annotations

import importlib
import importlib.util
from collections.abc import Callable
from types import ModuleType

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

import oracles
from forumlens.functions import distance, minutes_between, parse_date, slot_label, time_slot
from forumlens.operators import activity, clusters, experts, joins, keyed, response, store, validity
from forumlens.plans import reports
from forumlens.session import keep, new_path
from forumlens.sources import derived, files
from forumlens.sources.posts import load_posts, read_posts, write_posts

# Starting centres (config, center, avg_minutes, popularity)
POINT_CENTRES = [
    (1, 0, -1000000, 20),
    (1, 1, 0, 30),
    (1, 2, 500000, 40),
    (2, 0, -500000, 15),
    (2, 1, 0, 25),
    (2, 2, 0, 35),
    (2, 3, 900000, 45),
]
TAG_CENTRES = [(1, 0, 0, 100), (1, 1, 0, 400), (2, 0, 0, 200), (2, 1, 0, 260), (2, 2, 0, 600)]
TAG_CENTRES_XL = [(1, 0, 0, 100), (1, 1, 0, 2000), (2, 0, 0, 280), (2, 1, 0, 310), (2, 2, 0, 3000)]
# Input 1 belongs to configuration 1, input 2 to configuration 2
INPUT_CENTRES = [(1, 0, -500000, 20), (1, 1, 0, 40), (2, 0, 0, 580), (2, 1, 0, 600), (2, 2, 0, 620)]
PROTOTYPE_CENTRES = [c for c in POINT_CENTRES if c[0] == 2]

_POSTS = ("post_id", "post_type_id", "accepted_answer_id", "creation_date", "owner_user_id", "tags", "parent_id")


# Adding zero makes a negative zero positive
_CENTRE = (
    "config",
    "center",
    "round(avg_minutes, 4) + 0.0D AS avg_minutes",
    "round(popularity, 4) + 0.0D AS popularity",
    "size",
)


# The same in both engines: every seventh id and type is odd in its own way
_ODD_ID = (
    "CASE WHEN accepted_answer_id = '' THEN '' ELSE CASE CAST(post_id AS BIGINT) % 7"
    " WHEN 0 THEN '+' || accepted_answer_id WHEN 1 THEN ' ' || accepted_answer_id WHEN 2 THEN accepted_answer_id || ' '"
    " WHEN 3 THEN accepted_answer_id || 'x' WHEN 4 THEN '-' || accepted_answer_id ELSE accepted_answer_id END END"
)
_ODD_TYPE = (
    "CASE CAST(post_id AS BIGINT) % 7 WHEN 0 THEN '01' WHEN 1 THEN '1 ' WHEN 2 THEN 'word' WHEN 3 THEN NULL ELSE post_type_id END"
)


def _rounded(centres: DataFrame) -> DataFrame:
    return centres.selectExpr(*_CENTRE)


def _at_rest(centres: DataFrame) -> DataFrame:
    return centres.selectExpr(*_CENTRE, "at_rest")


def scan_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "dump")
    dump = derived.posts_dump(spark, sf_dir)
    files.write_csv(dump, path)
    # Lines with too few fields, too many, or an open quote
    broken = "CASE CAST(post_id AS BIGINT) % 3 WHEN 0 THEN '1,2,3' WHEN 1 THEN repeat(',x', 40) ELSE '5,1,\"open' END AS value"
    dump.where("CAST(post_id AS BIGINT) % 50 = 7").selectExpr(broken).write.mode("append").text(path)
    return read_posts(spark, path)


def store_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "store")
    write_posts(derived.posts(spark, sf_dir), path)
    stored = load_posts(spark, path)
    return stored.filter((F.col("post_type_id") == "1") & (F.col("owner_user_id") != "")).select(*_POSTS)


def parse_or_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of which some have a sign, a blank or a letter."""
    odd = derived.posts(spark, sf_dir).withColumn("accepted_answer_id", F.expr(_ODD_ID))
    return validity.parse_or_drop(odd, "accepted_answer_id").select("post_id", "accepted_answer_id")


def store_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored posts of which some have a type that only looks like a number, or none."""
    path = new_path(spark, "store")
    write_posts(derived.posts(spark, sf_dir).withColumn("post_type_id", F.expr(_ODD_TYPE)), path)
    return load_posts(spark, path).select("post_id", "post_type_id", "owner_user_id")


def store_scan_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "store")
    write_posts(derived.posts(spark, sf_dir), path)
    given = load_posts(spark, path).filter(F.col("post_type_id") == "2")
    return given.select("post_id", "creation_date", "owner_user_id", "parent_id")


def parse_date_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = parse_date("creation_date")
    return derived.posts(spark, sf_dir).select(
        "post_id",
        F.year(created).alias("year"),
        F.month(created).alias("month"),
        F.day(created).alias("day"),
        F.hour(created).alias("hour"),
        F.minute(created).alias("minute"),
        F.round(F.date_part(F.lit("SECOND"), created).cast("double"), 3).alias("second"),
    )


def time_slot_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    slot = time_slot(parse_date("creation_date"))
    posts = derived.posts(spark, sf_dir).select("post_id", slot.alias("slot"))
    return posts.withColumn("label", slot_label("slot"))


def minutes_to_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minutes from order to shipment of every line item, some of them negative."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", minutes_between("o_orderdate", "l_shipdate").alias("minutes")
    )


def semi_experts(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = derived.posts(spark, sf_dir)
    given = validity.answers(validity.valid_posts_activity(posts))
    return joins.semi_experts(given, reports.expert_users(posts)).select("post_id", "owner_user_id", "parent_id")


def experts_list_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "experts-list")
    files.write_text(reports.experts_report(derived.posts(spark, sf_dir)), path)
    return files.read_experts(spark, path)


def tag_features_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tag-features")
    found = reports.features(derived.posts(spark, sf_dir))
    files.write_csv(found, path)
    found.selectExpr("concat(tag, ',1') AS value").write.mode("append").text(path)
    # A tag may hold a line break
    more = new_path(spark, "tag-features")
    files.write_csv(found.withColumn("tag", F.concat(F.lit("a\n\\n"), "tag")), more)
    return files.read_tag_features(spark, path).unionByName(files.read_tag_features(spark, more))


def _stored_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts in all columns of a dump, as read from one."""
    path = new_path(spark, "dump")
    files.write_csv(derived.posts_dump(spark, sf_dir), path)
    return read_posts(spark, path)


def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every post twice, the older version with other values."""
    path = new_path(spark, "snapshot")
    posts = _stored_posts(spark, sf_dir)
    older = posts.withColumns({"creation_date": F.lit("1999-01-01T00:00:00.000"), "title": F.lit("old"), "score": F.lit("0")})
    store.write_snapshot(posts.unionByName(older.where("creation_date IS NOT NULL")), path)
    return store.read_snapshot(spark, path).withColumn("post_id", F.col("post_id").cast("string"))


def _edits(posts: DataFrame) -> DataFrame:
    """Later versions of every fifth post and earlier ones of every seventh."""
    later = posts.where("CAST(post_id AS BIGINT) % 5 = 0")
    earlier = posts.where("CAST(post_id AS BIGINT) % 7 = 0 AND CAST(post_id AS BIGINT) % 5 <> 0")
    return later.withColumns({"creation_date": F.lit("later"), "owner_user_id": F.lit("77")}).unionByName(
        earlier.withColumns({"creation_date": F.lit("1900-01-01T00:00:00.000"), "owner_user_id": F.lit("88")})
    )


def snapshot_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored snapshot with edits."""
    first, second = new_path(spark, "snapshot"), new_path(spark, "snapshot")
    posts = derived.posts(spark, sf_dir)
    store.write_snapshot(posts, first)
    store.upsert_snapshot(spark, first, _edits(posts), second)
    return store.read_snapshot(spark, second).select("post_id", "post_type_id", "creation_date", "owner_user_id", "tags")


def _keyed(spark: SparkSession, posts: DataFrame, kind: str = "experts") -> str:
    path = new_path(spark, "keyed")
    keyed.create(posts, path, kind, buckets=keyed.buckets_for(posts, least=8))
    return path


def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store kept by key with the same edits."""
    posts = derived.posts(spark, sf_dir)
    path = _keyed(spark, posts)
    keyed.upsert(spark, path, _edits(posts))
    return keyed.open_store(spark, path).posts.select("post_id", "post_type_id", "creation_date", "owner_user_id", "tags")


def keyed_counts_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per tag and user to which the changes of an upsert are added: other tags, then other owners."""
    posts = derived.posts(spark, sf_dir)
    path = _keyed(spark, posts)
    counts = keep(keyed.answers_per_tag_user(keyed.open_store(spark, path)), "counts")
    for rest, column, value in ((0, "tags", "<edited>"), (1, "owner_user_id", "77")):
        edits = posts.where(f"CAST(post_id AS BIGINT) % 50 = {rest}")
        change = keyed.upsert(spark, path, edits.withColumns({"creation_date": F.lit("later"), column: F.lit(value)}))
        counts = keep(keyed.merge_counts(counts, keyed.count_changes(spark, path, change)), "counts")
    return counts


def experts_report_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.experts_report_keyed(keyed.open_store(spark, _keyed(spark, derived.posts_xl(spark, sf_dir))))


def join_accepted_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.join_accepted(keyed.open_store(spark, _keyed(spark, derived.posts_xl(spark, sf_dir))))


def activity_report_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = derived.posts(spark, sf_dir)
    kept = keyed.open_store(spark, _keyed(spark, posts, "activity"))
    return reports.activity_report_keyed(kept, reports.expert_users(posts))


def scan_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines of a dump were kept, and dropped for what."""
    path, seen = new_path(spark, "dump"), Observation()
    dump = derived.posts_dump(spark, sf_dir)
    files.write_csv(dump, path)
    broken = "CASE CAST(post_id AS BIGINT) % 4 WHEN 0 THEN '1,2,3' WHEN 1 THEN repeat(',x', 40) WHEN 2 THEN '5,1,\"open' ELSE '' END AS value"
    dump.where("CAST(post_id AS BIGINT) % 50 IN (7, 8)").selectExpr(broken).write.mode("append").text(path)
    read_posts(spark, path, seen=seen).write.format("noop").mode("overwrite").save()
    counts = [(reason, n) for reason, n in seen.get.items() if n and reason != "lines"]
    return spark.createDataFrame(counts, "reason string, lines bigint")


def _snapshot(spark: SparkSession, posts: DataFrame, **options) -> DataFrame:
    path = new_path(spark, "snapshot")
    store.write_snapshot(posts, path, **options)
    return store.read_snapshot(spark, path)


def experts_report_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.experts_report_snapshot(_snapshot(spark, derived.posts_xl(spark, sf_dir)))


def activity_report_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experts from the list file of the experts report, posts from a stored snapshot."""
    path, posts = new_path(spark, "experts-list"), derived.posts(spark, sf_dir)
    files.write_text(reports.experts_report(posts), path)
    users = keep(files.read_experts(spark, path).select("user_id").distinct(), "experts")
    newest = _snapshot(spark, posts, valid=validity.valid_posts_activity_store)
    return reports.activity_report_snapshot(newest, users)


def tag_clusters_report_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Popularity and starting centres from files, some lines of which repeat a tag or are no numbers."""
    posts = derived.posts(spark, sf_dir)
    path = new_path(spark, "popularity")
    popular = activity.tag_popularity(posts)
    files.write_csv(popular, path)
    popular.selectExpr("concat(tag, ',1') AS value").write.mode("append").text(path)
    popular.selectExpr("concat(tag, ',many') AS value").write.mode("append").text(path)
    paths = {}
    for config in (1, 2):
        paths[config] = new_path(spark, "centres")
        lines = "\n".join(f"{m},{p}" for c, _, m, p in TAG_CENTRES if c == config)
        spark.createDataFrame([(lines,)], "value string").write.text(paths[config])
    centres = files.read_centres(spark, paths)
    return _at_rest(reports.clusters_report(posts, centres, files.read_popularity(spark, path)))


def point_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _points(spark, sf_dir).selectExpr("tag", "round(x, 4) + 0.0D AS x", "round(y, 4) + 0.0D AS y")


def point_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    far = distance("x", "y", "0.1D", "30.0D")
    return _points(spark, sf_dir).selectExpr("tag", f"round({far}, 4) AS distance")


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.points(derived.tag_points(spark, sf_dir))


def kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.assign(_points(spark, sf_dir), POINT_CENTRES).select("tag", "config", "center")


def kmeans_assign_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third point is a centre of its own number."""
    points = _points(spark, sf_dir)
    chosen = points.selectExpr("1 AS config", "CAST(substr(tag, 2) AS INT) AS center", "avg_minutes", "popularity").where("center % 3 = 0")
    return clusters.assign(points, chosen).select("tag", "config", "center")


def kmeans_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(clusters.update(clusters.assign(_points(spark, sf_dir), POINT_CENTRES)))


def kmeans_update_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = clusters.normalised_centres(POINT_CENTRES)
    return _rounded(clusters.step(_points(spark, sf_dir), start, clusters.NORMALISED))


def kmeans_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = clusters.step(_points(spark, sf_dir), POINT_CENTRES)
    return moved.selectExpr(*_CENTRE, "round(shift, 4) AS shift")


def kmeans_converged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.unconverged(clusters.step(_points(spark, sf_dir), POINT_CENTRES))


def kmeans_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "centres")
    found = clusters.kmeans(_points(spark, sf_dir), POINT_CENTRES)
    files.write_centres(clusters.history_frame(spark, found), path)
    return spark.read.parquet(path).selectExpr("iteration", *_CENTRE, "at_rest")


def kmeans_loop(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clusters.kmeans(_points(spark, sf_dir), POINT_CENTRES)
    return _at_rest(clusters.centres_frame(spark, found))


def kmeans_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stopped after two passes, then taken up again from what they wrote."""
    output, points = new_path(spark, "passes"), _points(spark, sf_dir)
    clusters.kmeans(points, POINT_CENTRES, max_iter=2, output=output)
    return _at_rest(clusters.centres_frame(spark, clusters.kmeans(points, POINT_CENTRES, output=output)))


def kmeans_multi_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two inputs, one per configuration."""
    first = clusters.points(derived.tag_points(spark, sf_dir)).withColumn("config", F.lit(1))
    second = clusters.points(derived.supplier_points(spark, sf_dir)).withColumn("config", F.lit(2))
    found = clusters.kmeans(first.unionByName(second), INPUT_CENTRES)
    return _at_rest(clusters.centres_frame(spark, found))


def kmeans_prototype(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clusters.kmeans(
        _points(spark, sf_dir),
        clusters.normalised_centres(PROTOTYPE_CENTRES),
        eps=0.1,
        min_iter=2,
        space=clusters.NORMALISED,
    )
    return _at_rest(clusters.centres_frame(spark, found))


def _on(source: Callable, report: Callable, *args, **options) -> Callable[[SparkSession, str], DataFrame]:
    """``report`` over the posts that ``source`` derives."""
    return lambda spark, sf_dir: report(source(spark, sf_dir), *args, **options)


def entry(spark: SparkSession) -> DataFrame:
    """The experts of every tag."""
    return reports.experts_report(derived.posts(spark, "/root/testdata/sf0.001"))


def _llm() -> ModuleType | None:
    """The queries of the training-data operators, where that part of the package is."""
    found = importlib.util.find_spec("forumlens.llm")
    return importlib.import_module("forumlens.llm.queries") if found and found.origin else None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    llm = _llm()
    return _post_queries() | (llm.queries() if llm else {})


def oracle_sql() -> dict[str, str]:
    llm = _llm()
    return _post_sql() | (llm.oracle_sql() if llm else {})


def _post_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    posts, xl = derived.posts, derived.posts_xl
    accepted = ("post_id", "post_type_id", "accepted_answer_id", "creation_date", "owner_user_id", "tags")
    active = ("post_id", "post_type_id", "creation_date", "owner_user_id", "tags", "parent_id")
    return {
        # Scans, filters, projections, scalars
        "scan_posts": scan_posts,
        "scan_losses": scan_losses,
        "store_scan": store_scan,
        "store_scan_answers": store_scan_answers,
        "store_types": store_types,
        "valid_posts_accepted": _on(posts, lambda p: validity.valid_posts_accepted(p).select(*accepted)),
        "valid_posts_activity": _on(posts, lambda p: validity.valid_posts_activity(p).select(*active)),
        "parse_or_drop": parse_or_drop,
        "explode_tags": _on(posts, lambda p: validity.explode_tags(p.select("post_id", "tags"))),
        "parse_date": parse_date_query,
        "time_slot": time_slot_query,
        "minutes_to_answer": minutes_to_answer,
        # Snapshots
        "latest_posts": _on(xl, lambda p: validity.typed(store.latest_posts(validity.valid_posts_store(p))).select(*_POSTS)),
        "snapshot_roundtrip": snapshot_roundtrip,
        "snapshot_upsert": snapshot_upsert,
        "keyed_upsert": keyed_upsert,
        "keyed_counts_current": keyed_counts_current,
        "activity_store": _on(posts, lambda p: store.activity_store(p).drop("created")),
        # Joins
        "join_accepted": _on(posts, joins.join_accepted),
        "join_accepted_bad_dates": _on(posts, joins.join_accepted, on_bad_date=-1),
        "join_accepted_xl": _on(xl, joins.join_accepted),
        "join_parent": _on(posts, joins.join_parent),
        "join_accepted_store": _on(xl, lambda p: joins.join_accepted_store(keep(store.store_posts(p), "store"))),
        "join_accepted_keyed": join_accepted_keyed,
        "semi_experts": semi_experts,
        "tag_features": _on(posts, reports.features),
        "tag_features_roundtrip": tag_features_roundtrip,
        # Aggregates and windows
        "answers_per_tag_user": _on(posts, experts.answers_per_tag_user),
        "answers_per_tag_user_joined": _on(xl, lambda p: experts.count_answers(joins.join_accepted(p))),
        "experts_store_counts": _on(xl, lambda p: experts.answers_per_tag_user_store(store.store_posts(p))),
        "topk_experts": _on(posts, lambda p: experts.topk_experts(experts.answers_per_tag_user(p))),
        "topk_experts_store": _on(
            xl, lambda p: experts.topk_experts(experts.answers_per_tag_user_store(store.store_posts(p)))
        ),
        "experts_list_roundtrip": experts_list_roundtrip,
        "activity_counts": _on(posts, lambda p: activity.activity_counts(activity.activity_of_all(p))),
        "activity_counts_joined": _on(xl, lambda p: activity.count_slots(joins.join_parent(p))),
        "activity_pivot": _on(posts, activity.activity_of_all),
        "activity_experts": _on(
            posts,
            lambda p: activity.activity_counts(
                activity.activity_of_experts(store.activity_store(p), reports.expert_users(p))
            ),
        ),
        "avg_minutes_per_tag": _on(posts, response.avg_minutes_per_tag),
        "avg_minutes_bad_dates": _on(posts, response.avg_minutes_per_tag, on_bad_date=-1),
        "mean_minutes_joined": _on(xl, lambda p: response.mean_minutes(joins.join_accepted(p))),
        "tag_popularity": _on(posts, activity.tag_popularity),
        # Clustering
        "point_normalise": point_normalise,
        "point_distance": point_distance,
        "kmeans_assign": kmeans_assign,
        "kmeans_assign_many": kmeans_assign_many,
        "kmeans_update": kmeans_update,
        "kmeans_update_normalised": kmeans_update_normalised,
        "kmeans_step": kmeans_step,
        "kmeans_converged": kmeans_converged,
        "kmeans_history": kmeans_history,
        "kmeans_loop": kmeans_loop,
        "kmeans_resumed": kmeans_resumed,
        "kmeans_multi_config": kmeans_multi_config,
        "kmeans_prototype": kmeans_prototype,
        # Reports
        "experts_report": _on(posts, reports.experts_report),
        "experts_report_xl": _on(xl, reports.experts_report),
        "experts_report_store": _on(xl, reports.experts_report_store),
        "activity_report_all": _on(posts, reports.activity_report),
        "activity_report_all_xl": _on(xl, reports.activity_report),
        "activity_report_experts": _on(posts, reports.activity_report_experts),
        "activity_report_experts_xl": _on(xl, reports.activity_report_experts),
        "tag_clusters_report": _on(posts, lambda p: _at_rest(reports.clusters_report(p, TAG_CENTRES))),
        "experts_report_snapshot": experts_report_snapshot,
        "activity_report_snapshot": activity_report_snapshot,
        "experts_report_keyed": experts_report_keyed,
        "activity_report_keyed": activity_report_keyed,
        "tag_clusters_report_files": tag_clusters_report_files,
        "tag_clusters_report_xl": _on(xl, lambda p: _at_rest(reports.clusters_report(p, TAG_CENTRES_XL))),
    }


def _post_sql() -> dict[str, str]:
    sql, rounded = oracles.with_blocks, oracles.ROUNDED
    points = "part_points"
    list_of = "string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY rank)"
    histogram = "tag || ',' || string_agg('TimeSlot' || slot || ':' || answers, ',' ORDER BY slot)"
    pivoted = ", ".join(
        f"CAST(coalesce(sum(CASE WHEN slot = {i} THEN answers END), 0) AS BIGINT) AS slot{i}" for i in range(4)
    )
    minus_one = "CAST(coalesce(minutes, -1) AS BIGINT)"

    def steps(n: int, select: str, **options) -> str:
        return sql(select, extra=oracles.lloyd_steps(points, POINT_CENTRES, n, **options))

    def loop(name: str, centres: list, posts: str = "posts", **options) -> str:
        rest = "bool_and(rest) OVER (PARTITION BY config) AS at_rest"
        last = f"SELECT {rounded}, {rest} FROM passes WHERE pass = (SELECT max(pass) FROM passes)"
        return sql(last, posts, extra=oracles.lloyd_loop(name, centres, **options))

    both = (
        "inputs AS (SELECT 1 AS config, * FROM part_points UNION BY NAME SELECT 2 AS config, * FROM supplier_points),\n"
    )
    dump = """
  SELECT post_id, post_type_id,
    nullif(CASE WHEN post_type_id <> '2' THEN accepted_answer_id END, '') AS accepted_answer_id, creation_date,
    CAST(CAST(post_id AS BIGINT) % 17 AS VARCHAR) AS score, CAST(CAST(post_id AS BIGINT) % 1000 AS VARCHAR) AS view_count,
    nullif(owner_user_id, '') AS owner_user_id, CAST(NULL AS VARCHAR) AS last_editor_display_name,
    CAST(NULL AS VARCHAR) AS last_edit_date, creation_date AS last_activity_date, nullif(tags, '') AS tags,
    CAST(CAST(post_id AS BIGINT) % 4 AS VARCHAR) AS answer_count,
    CAST(CAST(post_id AS BIGINT) % 9 AS VARCHAR) AS comment_count,
    CAST(CAST(post_id AS BIGINT) % 5 AS VARCHAR) AS favorite_count, CAST(NULL AS VARCHAR) AS community_owned_date,
    'On "' || owner_user_id || '", part ' || post_id AS title,
    CASE WHEN post_type_id = '2' THEN parent_id END AS parent_id FROM posts"""
    upserted = """
  SELECT CAST(post_id AS BIGINT) AS post_id, post_type_id,
    CASE WHEN CAST(post_id AS BIGINT) % 5 = 0 THEN 'later' ELSE creation_date END AS creation_date,
    CASE WHEN CAST(post_id AS BIGINT) % 5 = 0 THEN '77' ELSE owner_user_id END AS owner_user_id, tags
  FROM posts WHERE post_type_id IN ('1', '2')"""
    accepted_newest = "SELECT user_id, tags, question_id FROM asked_xl q JOIN newest_xl a ON q.answer_id = a.answer_id"
    return {
        "scan_posts": sql(dump),
        "snapshot_roundtrip": sql(f"{dump} WHERE post_type_id IN ('1', '2')"),
        "snapshot_upsert": sql(upserted),
        "experts_report_snapshot": sql(f"SELECT tag, {list_of} AS experts FROM experts_store GROUP BY tag", "posts_xl"),
        "activity_report_snapshot": sql(f"SELECT tag, {histogram} AS histogram FROM expert_slot_counts GROUP BY tag"),
        "tag_clusters_report_files": loop("complete", TAG_CENTRES),
        "store_scan": sql(f"SELECT {', '.join(_POSTS)} FROM posts WHERE post_type_id = '1' AND owner_user_id <> ''"),
        "valid_posts_accepted": sql(
            "SELECT post_id, post_type_id, accepted_answer_id, creation_date, owner_user_id, tags FROM valid_accepted"
        ),
        "valid_posts_activity": sql(
            "SELECT post_id, post_type_id, creation_date, owner_user_id, tags, parent_id FROM valid_activity"
        ),
        "parse_or_drop": sql(f"""
  SELECT post_id, TRY_CAST(odd AS BIGINT) AS accepted_answer_id FROM (SELECT post_id, {_ODD_ID} AS odd FROM posts)
  WHERE regexp_full_match(odd, '[+-]?[0-9]+')"""),
        "store_scan_answers": sql(
            "SELECT post_id, creation_date, owner_user_id, parent_id FROM posts WHERE post_type_id = '2'"
        ),
        "store_types": sql(f"SELECT post_id, {_ODD_TYPE} AS post_type_id, owner_user_id FROM posts"),
        "explode_tags": sql(f"SELECT post_id, unnest({oracles.SPLIT.format('tags')}) AS tag FROM posts"),
        "parse_date": sql("""
  SELECT CAST(post_id AS VARCHAR) AS post_id, CAST(year(created) AS INT) AS year, CAST(month(created) AS INT) AS month,
    CAST(day(created) AS INT) AS day, CAST(hour(created) AS INT) AS hour, CAST(minute(created) AS INT) AS minute,
    round(CAST(extract(microsecond FROM created) AS DOUBLE) / 1000000, 3) AS second FROM typed"""),
        "time_slot": sql("""
  SELECT CAST(post_id AS VARCHAR) AS post_id, CAST(hour(created) // 6 AS INT) AS slot,
    'TimeSlot' || CAST(hour(created) // 6 AS VARCHAR) AS label FROM typed"""),
        "minutes_to_answer": """
  SELECT l_orderkey, l_linenumber, l_partkey, date_sub('minute', o_orderdate, l_shipdate) AS minutes
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
        "latest_posts": sql(f"SELECT {', '.join(_POSTS)} FROM latest", "posts_xl"),
        "activity_store": sql(
            "SELECT post_id, post_type_id, owner_user_id, tags, creation_date, parent_id FROM activity_latest"
        ),
        "join_accepted": sql("SELECT user_id, tags, minutes, question_id FROM joined"),
        "join_accepted_bad_dates": sql(f"SELECT user_id, tags, {minus_one} AS minutes, question_id FROM joined"),
        "join_accepted_xl": sql("""
  SELECT user_id, tags, date_sub('minute', q.created, a.created) AS minutes, question_id
  FROM asked_xl q JOIN given_xl a ON q.answer_id = a.answer_id"""),
        "join_parent": sql("SELECT tags, slot FROM tag_slots"),
        "join_accepted_store": sql(accepted_newest),
        "join_accepted_keyed": sql(accepted_newest),
        "experts_report_keyed": sql(f"SELECT tag, {list_of} AS experts FROM experts_store GROUP BY tag", "posts_xl"),
        "activity_report_keyed": sql(f"SELECT tag, {histogram} AS histogram FROM expert_slot_counts GROUP BY tag"),
        "keyed_upsert": sql(upserted),
        "keyed_counts_current": sql("SELECT tag, user_id, answers FROM edited_counts"),
        "scan_losses": sql("""
  SELECT reason, count(*) AS lines FROM (
    SELECT 'kept' AS reason FROM posts UNION ALL
    SELECT CASE CAST(post_id AS BIGINT) % 4 WHEN 0 THEN 'fields' WHEN 1 THEN 'fields' WHEN 2 THEN 'open_quote' ELSE 'empty' END
    FROM posts WHERE CAST(post_id AS BIGINT) % 50 IN (7, 8)) GROUP BY reason"""),
        "semi_experts": sql("""
  SELECT post_id, owner_user_id, parent_id FROM valid_activity
  WHERE post_type_id = '2' AND owner_user_id IN (SELECT user_id FROM experts)"""),
        "tag_features": sql("SELECT tag, avg_minutes, popularity FROM features"),
        "tag_features_roundtrip": sql(
            "SELECT t.tag, CAST(avg_minutes AS DOUBLE) AS avg_minutes, CAST(popularity AS DOUBLE) AS popularity"
            " FROM features f, LATERAL (VALUES (f.tag), ('a' || chr(10) || '\\n' || f.tag)) AS t(tag)"
        ),
        "answers_per_tag_user": sql("SELECT tag, user_id, answers FROM counts"),
        "answers_per_tag_user_joined": sql("SELECT tag, user_id, answers FROM counts", "posts_xl"),
        "experts_store_counts": sql("SELECT tag, user_id, answers FROM counts_store", "posts_xl"),
        "topk_experts": sql("SELECT tag, rank, user_id, answers FROM experts"),
        "topk_experts_store": sql("SELECT tag, rank, user_id, answers FROM experts_store", "posts_xl"),
        "experts_list_roundtrip": sql("SELECT tag, rank, user_id FROM experts"),
        "activity_counts": sql("SELECT tag, slot, answers FROM slot_counts"),
        "activity_counts_joined": sql("SELECT tag, slot, answers FROM slot_counts", "posts_xl"),
        "activity_pivot": sql(f"SELECT tag, {pivoted} FROM slot_counts GROUP BY tag"),
        "activity_experts": sql("SELECT tag, slot, answers FROM expert_slot_counts"),
        "avg_minutes_per_tag": sql("SELECT tag, avg_minutes FROM averages"),
        "avg_minutes_bad_dates": sql(
            f"SELECT tag, CAST(trunc(sum({minus_one}) / count(*)) AS BIGINT) AS avg_minutes FROM joined_tags GROUP BY tag"
        ),
        "mean_minutes_joined": sql("SELECT tag, avg_minutes FROM averages", "posts_xl"),
        "tag_popularity": sql("SELECT tag, popularity FROM popularity"),
        "point_normalise": steps(1, "SELECT tag, round(x, 4) + 0.0::DOUBLE AS x, round(y, 4) + 0.0::DOUBLE AS y FROM xy"),
        "point_distance": steps(1, "SELECT tag, round(sqrt(pow(x - 0.1, 2) + pow(y - 30.0, 2)), 4) AS distance FROM xy"),
        "kmeans_assign": steps(1, "SELECT tag, config, center FROM a1"),
        "kmeans_update": steps(1, f"SELECT {rounded} FROM s1"),
        "kmeans_update_normalised": steps(1, f"SELECT {rounded} FROM s1", normalised=True),
        "kmeans_step": steps(
            1,
            f"SELECT {rounded}, round(sqrt(pow(round_even(avg_minutes / 1590397.0::DOUBLE, 2) - cx, 2)"
            " + pow(round_even(popularity, 2) - cy, 2)), 4) AS shift FROM s1",
        ),
        "kmeans_converged": steps(
            1,
            "SELECT config, count(*) FILTER (sqrt(pow(round_even(avg_minutes / 1590397.0::DOUBLE, 2) - cx, 2)"
            " + pow(round_even(popularity, 2) - cy, 2)) >= 1) AS moving FROM s1 GROUP BY config",
        ),
        "kmeans_history": sql(
            f"SELECT pass AS iteration, {rounded}, rest AS at_rest FROM passes WHERE pass > 0",
            extra=oracles.lloyd_loop(points, POINT_CENTRES),
        ),
        "kmeans_loop": loop(points, POINT_CENTRES),
        "kmeans_assign_many": sql("SELECT tag, config, center FROM met", extra=oracles.many_centres(points)),
        "kmeans_resumed": loop(points, POINT_CENTRES),
        "kmeans_multi_config": sql(
            f"SELECT {rounded}, rest AS at_rest FROM passes WHERE pass = (SELECT max(pass) FROM passes)",
            extra=both + oracles.lloyd_loop("inputs", INPUT_CENTRES, own_config=True),
        ),
        "kmeans_prototype": loop(points, PROTOTYPE_CENTRES, normalised=True),
        "experts_report": sql(f"SELECT tag, {list_of} AS experts FROM experts GROUP BY tag"),
        "experts_report_xl": sql(f"SELECT tag, {list_of} AS experts FROM experts GROUP BY tag", "posts_xl"),
        "experts_report_store": sql(f"SELECT tag, {list_of} AS experts FROM experts_store GROUP BY tag", "posts_xl"),
        "activity_report_all": sql(f"SELECT tag, {histogram} AS histogram FROM slot_counts GROUP BY tag"),
        "activity_report_all_xl": sql(f"SELECT tag, {histogram} AS histogram FROM slot_counts GROUP BY tag", "posts_xl"),
        "activity_report_experts": sql(f"SELECT tag, {histogram} AS histogram FROM expert_slot_counts GROUP BY tag"),
        "activity_report_experts_xl": sql(
            f"SELECT tag, {histogram} AS histogram FROM expert_slot_counts GROUP BY tag", "posts_xl"
        ),
        "tag_clusters_report": loop("complete", TAG_CENTRES),
        "tag_clusters_report_xl": loop("complete", TAG_CENTRES_XL, "posts_xl"),
    }
