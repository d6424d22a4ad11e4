"""A stored snapshot kept by key, so that lookups need no shuffle and upserts rewrite little.

The newest version of every post lies in buckets of its id, and beside it an index of
what the lookups join it with: accepted questions in buckets of their answer's id, or
answers in buckets of their parent's. Both sides of a lookup have as many buckets, which
Spark joins one with one as they lie.

A bucket is a folder of a version. A manifest per version names the folder of every
bucket; it is written last, and the newest whole one counts. So an upsert writes
folders for the buckets that change and a manifest, readers of older versions go on,
and a run that fails leaves the store as it was.

A key of an index that very many posts share makes its bucket long, and a bucket is one
task. For such posts ``store.write_snapshot`` and its reports are the other way.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.functions import as_id
from forumlens.functions.dates import TIME_SLOTS
from forumlens.operators.activity import activity_of_sides
from forumlens.operators.experts import count_unique
from forumlens.operators.store import VERSION, activity_view, latest_posts, store_view
from forumlens.operators.validity import answers, questions, valid_posts_activity_store, valid_posts_store
from forumlens.session import delete, keep, names_in, written
from forumlens.sources.posts import ANSWER

#: The least buckets of a store by default, and posts of a bucket from which on there are more. The number stays for good.
BUCKETS, BUCKET_POSTS = 64, 500_000
# The column of the bucket's number, which is also the name of its folder
_BUCKET = "id_bucket"


def _accepted(newest: DataFrame) -> DataFrame:
    """Owned questions by the id of the answer they accept."""
    asked = questions(store_view(newest)).where("owner_user_id IS NOT NULL AND accepted_answer_id IS NOT NULL")
    return asked.select(F.col("accepted_answer_id").alias("answer_id"), "tags", F.col("post_id").alias("question_id"))


def _parents(newest: DataFrame) -> DataFrame:
    """Answers by the id of their question."""
    given = answers(activity_view(newest)).where("parent_id IS NOT NULL")
    return given.select("parent_id", "owner_user_id", "created", F.col("post_id").alias("given_id"))


@dataclass(frozen=True)
class Kind:
    """Which posts a store holds, and the index beside them with its key and the post a row comes from."""

    valid: Callable[[DataFrame], DataFrame]
    index: Callable[[DataFrame], DataFrame]
    key: str
    source: str


KINDS = {
    "experts": Kind(valid_posts_store, _accepted, "answer_id", "question_id"),
    "activity": Kind(valid_posts_activity_store, _parents, "parent_id", "given_id"),
}


@dataclass(frozen=True)
class Manifest:
    """A version: of each table its columns, and the version folder of every bucket that has rows."""

    kind: str
    buckets: int
    order_by: list[str]
    version: int = 0
    columns: dict[str, str] = field(default_factory=dict)
    folders: dict[str, dict[str, str]] = field(default_factory=dict)


@dataclass(frozen=True)
class Store:
    """``posts`` by post_id and their ``index``, both in buckets."""

    kind: str
    posts: DataFrame
    index: DataFrame


def _bucket(key: str, buckets: int) -> Column:
    """The bucket in which Spark's bucketed tables put ``key``."""
    return F.pmod(F.hash(key), F.lit(buckets))


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions of the store whose manifests are whole, oldest first."""
    return [int(n) for n in names_in(spark, f"{path}/manifests") if written(spark, f"{path}/manifests/{n}")]


def _manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest:
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        raise ValueError(f"no version {version or ''} of a store at {path}")
    line = spark.read.text(f"{path}/manifests/{known[-1] if version is None else version:08d}").first().value
    return Manifest(**json.loads(line))


def _commit(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Make ``manifest`` the store's newest version; fails if there is one of its number."""
    line = spark.createDataFrame([(json.dumps(vars(manifest)),)], "value string")
    line.coalesce(1).write.mode("error").text(f"{path}/manifests/{manifest.version:08d}")


def _write(rows: DataFrame, key: str, buckets: int, path: str) -> set[str]:
    """Write rows in buckets and tell which have any. Spark lays out buckets of catalogued tables only."""
    name = f"forumlens_{uuid.uuid4().hex}"
    dealt = rows.withColumn(_BUCKET, _bucket(key, buckets)).repartition(buckets, key)
    dealt.write.format("parquet").partitionBy(_BUCKET).bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    rows.sparkSession.sql(f"DROP TABLE {name}")
    return {n.split("=")[1] for n in names_in(rows.sparkSession, path) if n.startswith(f"{_BUCKET}=")}


def _read(spark: SparkSession, path: str, manifest: Manifest, table: str, key: str) -> DataFrame:
    """A table of a version with its bucket numbers, each bucket from the folder the manifest names."""
    name = f"forumlens_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({manifest.columns[table]}, {_BUCKET} INT) USING parquet PARTITIONED BY ({_BUCKET})"
        f" CLUSTERED BY ({key}) SORTED BY ({key}) INTO {manifest.buckets} BUCKETS LOCATION '{path}/unused'"
    )
    folders = manifest.folders[table]
    if folders:
        places = [f"PARTITION ({_BUCKET}={b}) LOCATION '{path}/{folder}/{table}/{_BUCKET}={b}'" for b, folder in folders.items()]
        spark.sql(f"ALTER TABLE {name} ADD {' '.join(places)}")
    return spark.table(name)


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)


def buckets_for(posts: DataFrame, least: int = BUCKETS) -> int:
    """As many buckets as keep the posts of one, which a task sorts, at BUCKET_POSTS on average."""
    return max(least, -(-posts.count() // BUCKET_POSTS))


def create(posts: DataFrame, path: str, kind: str = "experts", buckets: int | None = None, order_by=VERSION) -> None:
    """Store the newest version of every post at ``path``, for the lookups of ``kind``.

    ``kind`` is ``experts`` or ``activity``; see ``store.snapshot`` for ``order_by``.
    Without a number of ``buckets`` they grow with the posts.
    """
    spark, rule = posts.sparkSession, KINDS[kind]
    buckets = buckets_for(posts) if buckets is None else buckets
    if versions(spark, path):
        raise ValueError(f"there is a store at {path}")
    folder = f"00000001-{uuid.uuid4().hex[:8]}"
    newest = latest_posts(rule.valid(posts), order_by=order_by)
    filled = _write(newest, "post_id", buckets, f"{path}/{folder}/posts")
    index = rule.index(spark.read.schema(newest.schema).parquet(f"{path}/{folder}/posts") if filled else newest)
    indexed = _write(index, rule.key, buckets, f"{path}/{folder}/index")
    columns = {"posts": _ddl(newest), "index": _ddl(index)}
    folders = {"posts": dict.fromkeys(sorted(filled, key=int), folder), "index": dict.fromkeys(sorted(indexed, key=int), folder)}
    _commit(spark, path, Manifest(kind, buckets, list(order_by), 1, columns, folders))


def open_store(spark: SparkSession, path: str, version: int | None = None) -> Store:
    """The newest version of the store at ``path``, or the given one."""
    manifest = _manifest(spark, path, version)
    posts = _read(spark, path, manifest, "posts", "post_id").drop(_BUCKET)
    index = _read(spark, path, manifest, "index", KINDS[manifest.kind].key).drop(_BUCKET)
    return Store(manifest.kind, posts, index)


@dataclass(frozen=True)
class Change:
    """What an upsert did: the versions before and after, the buckets rewritten, and the keys.

    ``keys`` are the index keys whose lookups may give other rows, as a table with the
    column ``key``; None if nothing changed.
    """

    before: int
    version: int
    buckets: dict[str, list[int]]
    keys: DataFrame | None = None


def upsert(spark: SparkSession, path: str, posts: DataFrame) -> Change:
    """Merge newer versions and new posts into the store at ``path``.

    Only buckets with an id of ``posts`` are read and rewritten, and only buckets of the
    index in which a row changes. Posts without a valid row change nothing. Columns that the
    store does not have are left out.
    """
    old = _manifest(spark, path)
    rule, version = KINDS[old.kind], old.version + 1
    folder = f"{version:08d}-{uuid.uuid4().hex[:8]}"
    stored = _read(spark, path, old, "posts", "post_id")
    types = [(c, t) for c, t in stored.dtypes if c != _BUCKET]
    valid = rule.valid(posts).select([F.col(c).cast(t) for c, t in types])
    fresh = keep(latest_posts(valid, order_by=old.order_by), "fresh")
    touched = _touched(fresh, "post_id", old.buckets)
    if not touched:
        return Change(old.version, old.version, {"posts": [], "index": []})
    ids = fresh.select("post_id")
    before = stored.where(F.col(_BUCKET).isin(touched)).drop(_BUCKET)
    merged = latest_posts(before.unionByName(fresh), order_by=old.order_by)
    filled = _write(merged, "post_id", old.buckets, f"{path}/{folder}/posts")
    after = spark.read.schema(merged.schema).parquet(f"{path}/{folder}/posts").drop(_BUCKET)

    was, now = before.join(ids, "post_id", "left_semi"), after.join(ids, "post_id", "left_semi")
    gone = keep(rule.index(was).exceptAll(rule.index(now)), "gone")
    came = keep(rule.index(now).exceptAll(rule.index(was)), "came")
    moved = now.exceptAll(was).select(F.col("post_id").alias("key"))
    keys = gone.unionByName(came).select(F.col(rule.key).alias("key")).unionByName(moved).distinct()
    changed = _touched(gone.unionByName(came), rule.key, old.buckets)
    indexed: set[str] = set()
    if changed:
        index = _read(spark, path, old, "index", rule.key).where(F.col(_BUCKET).isin(changed)).drop(_BUCKET)
        left = index.join(gone.select(rule.source), rule.source, "left_anti").select(*came.columns)
        indexed = _write(left.unionByName(came), rule.key, old.buckets, f"{path}/{folder}/index")
    folders = {
        "posts": _switched(old.folders["posts"], touched, filled, folder),
        "index": _switched(old.folders["index"], changed, indexed, folder),
    }
    _commit(spark, path, replace(old, version=version, folders=folders))
    return Change(old.version, version, {"posts": touched, "index": changed}, keep(keys, "keys"))


def _touched(rows: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets that rows fall in; no more numbers than there are buckets."""
    return sorted(r.bucket for r in rows.select(_bucket(key, buckets).alias("bucket")).distinct().collect())


def _switched(folders: dict[str, str], touched: list[int], filled: set[str], folder: str) -> dict[str, str]:
    """Touched buckets lie in the new folder, or nowhere if they have no rows any more."""
    left = {b: f for b, f in folders.items() if int(b) not in touched}
    return dict(sorted((left | dict.fromkeys(filled, folder)).items(), key=lambda x: int(x[0])))


def clean(spark: SparkSession, path: str, versions_kept: int = 2) -> list[str]:
    """Delete all but the newest versions, and the folders that none of those names.

    Call it when nobody reads an older version and no upsert runs.
    """
    known = versions(spark, path)
    used = {f for v in known[-versions_kept:] for t in _manifest(spark, path, v).folders.values() for f in t.values()}
    gone = [f"manifests/{v:08d}" for v in known[:-versions_kept]]
    gone += [n for n in names_in(spark, path) if n not in used and n[:8].isdigit()]
    for name in gone:
        delete(spark, f"{path}/{name}")
    return gone


def owners(posts: DataFrame) -> DataFrame:
    """(answer_id, user_id) of the owned posts, as they lie in their buckets."""
    owned = posts.select(F.col("post_id").alias("answer_id"), as_id("owner_user_id").alias("user_id"))
    return owned.where("user_id IS NOT NULL")


def _of(store: Store, kind: str) -> Store:
    if store.kind != kind:
        raise ValueError(f"a store for {kind} is needed, this one is for {store.kind}")
    return store


def join_accepted(store: Store) -> DataFrame:
    """Each stored question with its accepted answer, without a shuffle: (user_id, tags, question_id)."""
    joined = _of(store, "experts").index.join(owners(store.posts).hint("merge"), "answer_id")
    return joined.select("user_id", "tags", "question_id")


def answers_per_tag_user(store: Store) -> DataFrame:
    """Accepted answers per (tag, user_id); only the count is shuffled."""
    return count_unique(_of(store, "experts").index.select("answer_id", "tags"), owners(store.posts))


def activity_of_experts(store: Store, experts: DataFrame, slots: int = TIME_SLOTS) -> DataFrame:
    """(tag, slot0, slot1, ...): answers by ``experts`` (user_id); only the sums per tag are shuffled."""
    asked = _of(store, "activity").posts.where(f"NOT post_type_id <=> '{ANSWER}'").select("post_id", "tags")
    return activity_of_sides(asked, store.index, experts, slots)


def count_changes(spark: SparkSession, path: str, change: Change) -> DataFrame:
    """(tag, user_id, answers): by how much an upsert changed the counts of ``answers_per_tag_user``.

    Reads the buckets of the changed keys in both versions, which hold both sides of their lookups.
    """
    manifest = _manifest(spark, path, change.version)
    _of(Store(manifest.kind, None, None), "experts")
    if change.keys is None:
        return spark.createDataFrame([], "tag string, user_id bigint, answers bigint")
    there = F.col(_BUCKET).isin(_touched(change.keys, "key", manifest.buckets))

    def counted(version: int, sign: int) -> DataFrame:
        of = _manifest(spark, path, version)
        index = _read(spark, path, of, "index", "answer_id").where(there)
        given = owners(_read(spark, path, of, "posts", "post_id").where(there))
        asked = index.join(change.keys, F.col("answer_id") == F.col("key"), "left_semi").select("answer_id", "tags")
        return count_unique(asked, given).withColumn("answers", F.col("answers") * sign)

    both = counted(change.version, 1).unionByName(counted(change.before, -1))
    return both.groupBy("tag", "user_id").agg(F.sum("answers").alias("answers")).where("answers <> 0")


def merge_counts(counts: DataFrame, changes: DataFrame) -> DataFrame:
    """Counts per (tag, user_id) after ``changes``; those that fall to zero go."""
    both = counts.unionByName(changes)
    return both.groupBy("tag", "user_id").agg(F.sum("answers").alias("answers")).where("answers > 0")
