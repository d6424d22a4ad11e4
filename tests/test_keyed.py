"""The store kept by key: plans, upserts by bucket, versions, and counts kept current."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import answer, question
from forumlens.operators import experts, keyed, store
from forumlens.operators.validity import valid_posts_activity_store
from forumlens.plans import reports
from forumlens.session import keep, new_path
from forumlens.sources import derived
from test_plans import final_plan, plan, settings

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.collect()))


def files_of(path):
    return {os.path.join(top, n) for top, _, names in os.walk(path) for n in names if n.endswith(".parquet")}


@pytest.fixture
def made(spark):
    def create(posts, **options):
        path = new_path(spark, "keyed")
        keyed.create(posts, path, **{"buckets": 4} | options)
        return path

    return create


def test_lookups_need_no_shuffle(spark, made):
    posts = derived.posts_xl(spark, SF)
    path = made(posts)
    users = keep(spark.range(400).select(F.col("id").alias("user_id")), "users")
    activity = keyed.open_store(spark, made(posts, kind="activity"))
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="1MB"):
        for df, most in (
            (keyed.join_accepted(keyed.open_store(spark, path)), 0),
            (keyed.answers_per_tag_user(keyed.open_store(spark, path)), 1),
            (reports.activity_report_keyed(activity, users), 1),
        ):
            text = plan(df)
            assert "Exchange hashpartitioning" not in text[text.index("SortMergeJoin") :]
            assert final_plan(df).split("== Initial Plan ==")[0].count("+- Exchange hashpartitioning") == most


def test_reports_are_those_of_the_snapshot(spark, made):
    for posts in (derived.posts(spark, SF), derived.posts_xl(spark, SF)):
        kept = keyed.open_store(spark, made(posts))
        newest = store.snapshot(posts)
        assert rows(kept.posts.select(newest.columns)) == rows(newest)
        assert rows(reports.experts_report_keyed(kept)) == rows(reports.experts_report_snapshot(newest))
        users = reports.expert_users(posts)
        kept = keyed.open_store(spark, made(posts, kind="activity"))
        newest = store.snapshot(posts, valid=valid_posts_activity_store)
        assert rows(reports.activity_report_keyed(kept, users)) == rows(reports.activity_report_snapshot(newest, users))


def test_upsert_rewrites_touched_buckets_only(spark, made, make_posts):
    posts = [question(i, 1000 + i, "<a>", owner=str(i)) for i in range(200)] + [answer(1000 + i) for i in range(200)]
    path = made(make_posts(*posts), buckets=16)
    first, before = files_of(path), rows(keyed.open_store(spark, path).posts)
    edits = make_posts(question(3, 1003, "<b>", date="2021-01-01T00:00:00.000"), answer(5000, date="2021-01-01T00:00:00.000"))
    change = keyed.upsert(spark, path, edits)
    assert change.version == 2 and len(change.buckets["posts"]) <= 2 and len(change.buckets["index"]) == 1
    new = {f.split("id_bucket=")[1].split("/")[0] for f in files_of(path) - first if "/posts/" in f}
    assert new == {str(b) for b in change.buckets["posts"]} and first <= files_of(path)
    now = keyed.open_store(spark, path)
    assert now.posts.count() == 401 and now.index.where("question_id = 3").first().tags == "<b>" and now.index.count() == 200
    assert rows(keyed.open_store(spark, path, 1).posts) == before
    # Old versions change nothing but the version; posts that are not valid not even that
    assert keyed.upsert(spark, path, make_posts(question(3, 9, date="1999-01-01T00:00:00.000"))).buckets["index"] == []
    assert keyed.upsert(spark, path, make_posts(question("x", 9))).version == 3 and keyed.versions(spark, path) == [1, 2, 3]


def test_a_failed_run_leaves_the_store(spark, made, make_posts, monkeypatch):
    path = made(make_posts(question(1, 2), answer(2)))
    before = rows(keyed.open_store(spark, path).posts)
    edit = make_posts(question(1, 2, "<new>", date="2022-01-01T00:00:00.000"))
    with monkeypatch.context() as m:
        m.setattr(keyed, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            keyed.upsert(spark, path, edit)
    assert rows(keyed.open_store(spark, path).posts) == before
    assert keyed.upsert(spark, path, edit).version == 2
    assert keyed.open_store(spark, path).index.first().tags == "<new>"
    # The folder of the failed run, the first version's and its manifest
    assert len(keyed.clean(spark, path, versions_kept=1)) == 2
    assert keyed.open_store(spark, path).posts.count() == 2
    with pytest.raises(ValueError):
        keyed.open_store(spark, path, 1)


def test_counts_kept_current(spark, made, make_posts):
    """Owners, tags, accepted answers and types change; posts come, and some edits are older than what is stored."""
    draw = random.Random(4)

    def some(n, year):
        date = lambda: f"{year + draw.randint(0, 1)}-01-01T00:00:00.000"
        made = []
        for _ in range(n):
            i = draw.randint(1, 60)
            if draw.random() < 0.5:
                made.append(question(i, draw.choice([*range(40, 70), ""]), draw.choice(["<a>", "<b>", "<a><b>", "<a><a>", ""]), date(), draw.choice(["1", "2", ""])))
            else:
                made.append(answer(i, draw.choice([1, 2, 3, ""]), date=date()))
        return make_posts(*made)

    path = made(some(150, 2000))
    counts = keep(keyed.answers_per_tag_user(keyed.open_store(spark, path)), "counts")
    assert counts.count() > 3
    for year in (2001, 2002, 2003):
        change = keyed.upsert(spark, path, some(12, year))
        counts = keep(keyed.merge_counts(counts, keyed.count_changes(spark, path, change)), "counts")
        kept = keyed.open_store(spark, path)
        assert rows(counts) == rows(keyed.answers_per_tag_user(kept))
        assert rows(counts) == rows(experts.answers_per_tag_user_store(store.store_view(kept.posts)))
    nothing = keyed.upsert(spark, path, make_posts(question("", 1)))
    assert nothing.keys is None and keyed.count_changes(spark, path, nothing).count() == 0


def test_empty_store_and_wrong_uses(spark, made, make_posts):
    path = made(make_posts(question("no id", 1)))
    kept = keyed.open_store(spark, path)
    assert kept.posts.count() == kept.index.count() == reports.experts_report_keyed(kept).count() == 0
    with pytest.raises(ValueError):
        keyed.create(make_posts(), path)
    with pytest.raises(ValueError):
        reports.activity_report_keyed(kept, spark.range(1).toDF("user_id"))
    with pytest.raises(ValueError):
        keyed.open_store(spark, new_path(spark, "none"))
    assert keyed.upsert(spark, path, make_posts(question(1, 2), answer(2))).version == 2
    assert [tuple(r) for r in reports.experts_report_keyed(keyed.open_store(spark, path)).collect()] == [("a", "7")]


def test_buckets_grow_with_the_posts(spark, monkeypatch):
    """A task holds a bucket, so a bucket must not grow with the store."""
    monkeypatch.setattr(keyed, "BUCKET_POSTS", 300)
    paths = []
    create = keyed.create
    monkeypatch.setattr(keyed, "create", lambda posts, path, *rest, **options: paths.append(path) or create(posts, path, *rest, **options))
    found = rows(entry.queries()["experts_report_keyed"](spark, SF))
    posts = derived.posts_xl(spark, SF)
    manifest = keyed._manifest(spark, paths[0])
    assert manifest.buckets == -(-posts.count() // 300) > 8
    sizes = [r["count"] for r in keyed._read(spark, paths[0], manifest, "posts", "post_id").groupBy("id_bucket").count().collect()]
    assert max(sizes) <= 2 * 300
    assert found == rows(reports.experts_report_snapshot(store.snapshot(posts)))
