"""Small posts made by hand, each for one rule."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import answer, as_dict, question
from forumlens.operators import activity, clusters, experts, joins, response, store, validity
from forumlens.plans import reports


def ids(df):
    return sorted(r.post_id for r in df.collect())


def test_valid_for_accepted_answers(make_posts):
    posts = make_posts(
        question(1, 10),
        question("", 10),
        question("x1", 10),
        question(2, 10, date=""),
        question(3, ""),
        question(4, 10, tags=""),
        question(5, 10, kind="3"),
        question(6, 10, kind=""),
        question(7, 10, owner=""),
        question(8, 10, date="bad-date"),
        question(9, None),
        answer(10),
        answer(11, owner=""),
        answer(12, owner="nobody"),
        answer(13, parent=""),
    )
    assert ids(validity.valid_posts_accepted(posts)) == [1, 7, 8, 10, 13]


def test_valid_for_activity(make_posts):
    posts = make_posts(
        question(1, ""),
        question(2, 10, tags=""),
        question(3, 10, tags=None),
        question(4, 10, date=None),
        question(5, 10, kind="4"),
        answer(10, parent=1),
        answer(11, parent=""),
        answer(12, parent="x"),
        answer(13, parent=1, owner=""),
    )
    assert ids(validity.valid_posts_activity(posts)) == [1, 10]


def test_join_keeps_repeats_and_drops_orphans(make_posts):
    posts = make_posts(
        question(1, 10, "<a>"),
        question(2, 10, "<b>"),
        question(3, 99),
        question(4, "010", "<c>"),
        answer(10, 7),
        answer(10, 8, date="bad"),
        answer(11, 9),
    )
    rows = sorted(tuple(r) for r in joins.join_accepted(posts, on_bad_date=-1).collect())
    want = [(u, t, m, q) for u, m in ((7, 60), (8, -1)) for t, q in (("<a>", 1), ("<b>", 2), ("<c>", 4))]
    assert rows == sorted(want)
    counts = {(r.tag, r.user_id): r.answers for r in experts.answers_per_tag_user(posts).collect()}
    assert counts == {(t, u): 1 for t in "abc" for u in (7, 8)}


def test_experts_ranked_with_ties(make_posts):
    rows = []
    for user, won in ((20, 3), (9, 2), (100, 2), (5, 1), (6, 1), (7, 1), (3, 1)):
        for n in range(won):
            number = user * 1000 + n
            rows += [question(number, number + 500, "<a>"), answer(number + 500, user)]
    assert as_dict(reports.experts_report(make_posts(*rows)), "tag", "experts") == {"a": "20,9,100,3,5"}
    assert as_dict(reports.experts_report(make_posts(*rows), k=2), "tag", "experts") == {"a": "20,9"}


def test_unique_ids_change_nothing_but_the_plan(make_posts):
    rows = []
    for n in range(40):
        rows += [question(n, 100 + n % 30, f"<{'abc'[n % 3]}><z>"), answer(100 + n, n % 7, n)]
    posts = make_posts(*rows)
    for report, key in ((reports.experts_report, "experts"), (reports.activity_report, "histogram")):
        assert as_dict(report(posts, unique_ids=True), "tag", key) == as_dict(report(posts), "tag", key)


def test_repeated_tags_count_twice(make_posts):
    posts = make_posts(question(1, 10, "<a><a><>"), answer(10, 7))
    assert [tuple(r) for r in experts.answers_per_tag_user(posts).collect()] == [("a", 7, 2)]
    assert as_dict(activity.tag_popularity(posts), "tag", "popularity") == {"a": 1}


def test_newest_version_wins(make_posts):
    posts = make_posts(
        answer(10, 7, date="2020-01-01T00:00:00.000"),
        answer("010", 8, date="2020-01-02T00:00:00.000"),
        answer(11, 9),
        answer(11, 10),
        answer(12, ""),
        answer(12, 3),
        question(13, kind="3"),
    )
    newest = as_dict(store.store_posts(posts), "post_id", "owner_user_id")
    assert newest == {10: 8, 11: 9, 12: 3}  # owners compare as text


def test_store_report_differs_as_it_should(make_posts):
    posts = make_posts(
        question(1, 10, "<a>", owner=""),  # no owner: not asked of the store
        question(2, 20, "<b>", date=""),  # no date: the store does not care
        question(3, 2, "<c>", owner="4"),  # accepts a question
        question(4, 10, "<d>", owner="4"),
        answer(10, 7, date="2020-01-01T00:00:00.000"),
        answer(10, 8, date="2020-01-02T00:00:00.000"),
        answer(20, 9),
    )
    assert as_dict(reports.experts_report(posts), "tag", "experts") == {"a": "7,8", "d": "7,8"}
    assert as_dict(reports.experts_report_store(posts), "tag", "experts") == {"b": "9", "c": "1", "d": "8"}
    joined = joins.join_accepted_store(store.store_posts(posts))
    assert sorted(tuple(r) for r in joined.collect()) == [(1, "<c>", 3), (8, "<d>", 4), (9, "<b>", 2)]


@pytest.fixture
def busy(make_posts):
    def at(hour):
        return f"2020-01-01T{hour:02d}:30:00.000"

    return make_posts(
        question(1, 10, "<a><b>"),
        question(2, "", "<b>"),
        question(3, "", "<w>", kind="5"),
        question(4, "", "<e>", kind=""),
        question(5, "", "<n>", kind=None),
        answer(10, 7, 1, at(1)),
        answer(11, 7, 1, at(13)),
        answer(12, 8, 1, at(14)),
        answer(13, 8, 2, at(23)),
        answer(14, 7, 3, at(6)),
        answer(15, 7, 99, at(6)),
        answer(16, 7, 1, "bad-date"),
        answer(17, 7, 10, at(6)),  # its parent is an answer
        answer(18, 7, 4, at(6)),
        answer(19, 7, 5, at(6)),
    )


def test_activity_of_all(busy):
    assert as_dict(reports.activity_report(busy), "tag", "histogram") == {
        "a": "a,TimeSlot0:1,TimeSlot2:2",
        "b": "b,TimeSlot0:1,TimeSlot2:2,TimeSlot3:1",
    }
    wide = activity.activity_of_all(busy)
    assert sorted(tuple(r) for r in wide.collect()) == [("a", 1, 0, 2, 0), ("b", 1, 0, 2, 1)]
    long = sorted(tuple(r) for r in activity.activity_counts(wide).collect())
    assert long == [("a", 0, 1), ("a", 2, 2), ("b", 0, 1), ("b", 2, 2), ("b", 3, 1)]
    assert sorted(tuple(r) for r in activity.count_slots(joins.join_parent(busy)).collect()) == long
    assert as_dict(activity.activity_map(wide), "tag", "activity") == {"a": {0: 1, 2: 2}, "b": {0: 1, 2: 2, 3: 1}}


def test_more_slots_keep_their_order(busy):
    lines = as_dict(reports.activity_report(busy, slots=24), "tag", "histogram")
    assert lines["b"] == "b,TimeSlot1:1,TimeSlot13:1,TimeSlot14:1,TimeSlot23:1"


def test_activity_of_experts(spark, busy):
    """User 7 is the expert; a parent of another type counts, an absent one does not."""
    assert as_dict(reports.activity_report_experts(busy), "tag", "histogram") == {
        "a": "a,TimeSlot0:1,TimeSlot2:1",
        "b": "b,TimeSlot0:1,TimeSlot2:1",
        "w": "w,TimeSlot1:1",
        "e": "e,TimeSlot1:1",
        "n": "n,TimeSlot1:1",
    }
    others = spark.createDataFrame([(8,)], "user_id bigint")
    assert as_dict(reports.activity_report_experts(busy, others), "tag", "histogram") == {
        "a": "a,TimeSlot2:1",
        "b": "b,TimeSlot2:1,TimeSlot3:1",
    }


def test_activity_store_blanks_what_does_not_apply(busy):
    rows = {r.post_id: r for r in store.activity_store(busy).collect()}
    assert (rows[1].tags, rows[1].creation_date, rows[1].parent_id) == ("<a><b>", None, None)
    assert (rows[10].tags, rows[10].parent_id, rows[10].creation_date) == (None, 1, "2020-01-01T01:30:00.000")
    assert rows[3].post_type_id == "5"


def test_mean_minutes(make_posts):
    posts = make_posts(
        question(1, 10, "<a>"),
        question(2, 11, "<a><b>"),
        question(3, 12, "<b>"),
        question(4, 13, "<c>", date="bad-date"),
        answer(10, date="2020-01-01T00:10:00.000"),
        answer(11, date="2019-12-31T23:55:00.000"),
        answer(12, date="bad-date"),
        answer(13),
    )
    assert as_dict(response.avg_minutes_per_tag(posts), "tag", "avg_minutes") == {"a": 2, "b": -5}
    assert as_dict(response.avg_minutes_per_tag(posts, -1), "tag", "avg_minutes") == {"a": 2, "b": -3, "c": -1}
    joined = joins.join_accepted(posts)
    assert as_dict(response.mean_minutes(joined), "tag", "avg_minutes") == {"a": 2, "b": -5}


def test_features_keep_tags_with_one_number(spark, make_posts):
    minutes = spark.createDataFrame([("a", 5), ("b", 6)], "tag string, avg_minutes bigint")
    popular = spark.createDataFrame([("b", 2.0), ("c", 3.0)], "tag string, popularity double")
    found = joins.tag_features(minutes, popular)
    assert sorted(found.collect(), key=lambda r: r.tag) == [("a", 5, None), ("b", 6, 2.0), ("c", None, 3.0)]
    assert [r.tag for r in clusters.points(found).collect()] == ["b"]


def test_clusters_report(make_posts):
    rows = []
    for n, tag in enumerate("aaaabbbcd"):
        rows += [question(n, n + 100, f"<{tag}>"), answer(n + 100)]
    centres = [(1, 0, 0, 0), (1, 1, 0, 10), (2, 0, 0, 3)]
    found = sorted(tuple(r) for r in reports.clusters_report(make_posts(*rows), centres).collect())
    assert found == [(1, 0, 60.0, 2.25, 4, True), (2, 0, 60.0, 2.25, 4, True)]


def test_snapshots_are_stored_and_upserted(spark, make_posts, tmp_path):
    """All columns stay; the columns that tell the newest version can be named."""
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    posts = make_posts(question(1, date="2020-01-02T00:00:00.000"), answer(2), question(3, kind="9"))
    posts = posts.withColumn("last_edit_date", F.lit("2020-02-01")).withColumn("title", F.lit("first"))
    order = ("last_edit_date", *store.VERSION)
    store.write_snapshot(posts, one, order_by=order)
    stored = store.read_snapshot(spark, one)
    assert stored.columns == posts.columns and sorted(r.post_id for r in stored.collect()) == [1, 2]
    edits = make_posts(question(1, tags="<b>"), answer(2, owner="9"), answer(4))
    edits = edits.withColumn("last_edit_date", F.expr("CASE post_id WHEN '1' THEN '2020-03-01' ELSE '2020-01-01' END"))
    store.upsert_snapshot(spark, one, edits.withColumn("title", F.lit("second")), two, order_by=order)
    found = {r.post_id: (r.title, r.tags, r.owner_user_id) for r in store.read_snapshot(spark, two).collect()}
    assert found == {1: ("second", "<b>", "1"), 2: ("first", "", "7"), 4: ("second", "", "7")}
    lookups = as_dict(store.store_posts(posts.unionByName(edits.withColumn("title", F.lit("x"))), order), "post_id", "tags")
    assert lookups[1] == "<b>"
