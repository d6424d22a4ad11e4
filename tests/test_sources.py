from __future__ import annotations

import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import answer, question
from forumlens import session
from forumlens.operators.clusters import as_centres
from forumlens.session import keep, new_path, shared_folder
from forumlens.sources import files
from forumlens.sources.posts import RECORD, load_posts, read_posts, write_posts


def record(**fields):
    return ",".join(fields.get(name, "") for name in RECORD)


def text_file(tmp_path, name, *lines):
    path = tmp_path / name
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_read_posts(spark, tmp_path):
    path = text_file(
        tmp_path,
        "posts.csv",
        record(post_id="1", post_type_id="1", accepted_or_parent_id="2", tags="<a><b>", title='"q""q, and more"'),
        record(post_id="2", post_type_id="2", accepted_or_parent_id="1", parent_id="99", owner_user_id="5"),
        '1,1,"abc',  # a quote left open in the middle
        record(post_id="4", post_type_id="1", parent_id='"open'),  # and in the last field
        "5,1",  # too short
        record(post_id="6") + ",extra",  # too long
        "",
        record(post_id="7", post_type_id="1", title='"'),  # open, swallows the last field
    )
    posts = read_posts(spark, path)
    assert posts.columns == [
        *RECORD[:2],
        "accepted_answer_id",
        *RECORD[3:],
    ]
    rows = {r.post_id: r for r in posts.collect()}
    assert set(rows) == {"1", "2"}
    assert rows["1"].title == 'q"q, and more'
    assert (rows["1"].accepted_answer_id, rows["1"].parent_id) == ("2", None)
    assert (rows["2"].accepted_answer_id, rows["2"].parent_id) == (None, "1")
    assert read_posts(spark, path).select("post_id").count() == 2
    other = {r.post_id: r.parent_id for r in read_posts(spark, path, parent_id_from=16).collect()}
    assert other == {"1": None, "2": "99"}
    with pytest.raises(ValueError):
        read_posts(spark, path, parent_id_from=3)


def test_read_posts_with_backslashes(spark, tmp_path):
    path = text_file(tmp_path, "posts.csv", record(post_id="1", post_type_id="1", title='"say \\"hi\\", you"'))
    assert read_posts(spark, path, escape="\\").first().title == 'say "hi", you'


def test_store_round_trip(spark, make_posts, tmp_path):
    posts = make_posts(question(1, 2), answer(2), question(3, kind="5"))
    path = str(tmp_path / "store")
    write_posts(posts, path)
    back = load_posts(spark, path)
    assert dict(back.dtypes)["post_type_id"] == "string"
    assert sorted(back.select(posts.columns).collect()) == sorted(posts.collect())
    plan = back.filter(F.col("post_type_id") == "1").select("post_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(post_type_id" in text
    assert plan.count() == 1


def test_experts(spark, tmp_path):
    path = text_file(tmp_path, "experts.txt", "java\t5,3,9", "c# 4", "nobody\t", "", "odd\t1,x,2")
    rows = sorted(tuple(r) for r in files.read_experts(spark, path).collect())
    assert rows == [("c#", 1, 4), ("java", 1, 5), ("java", 2, 3), ("java", 3, 9), ("odd", 1, 1), ("odd", 3, 2)]


def test_text_and_csv_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, None), ("b,c", None, "x")], "tag string, n int, s string")
    files.write_text(df, str(tmp_path / "t"), sep="|")
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "t")).collect()) == ["a|1|", "b,c||x"]
    files.write_csv(df, str(tmp_path / "c"))
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "c")).collect()) == ['"b,c",,x', "a,1,"]


def test_features_and_popularity(spark, tmp_path):
    path = text_file(tmp_path, "f.csv", "a,5,10", "b,5", "c,5,6,7", "d,,3", "e,x,3")
    rows = sorted((tuple(r) for r in files.read_tag_features(spark, path).collect()), key=str)
    assert rows == [("a", 5.0, 10.0), ("d", None, 3.0), ("e", None, 3.0)]
    path = text_file(tmp_path, "p.csv", "a,10", "b,", "c,many", "d,2.5", "e,1,2")
    assert sorted(tuple(r) for r in files.read_popularity(spark, path).collect()) == [("a", 10.0), ("d", 2.5)]


def test_centres(spark, tmp_path):
    one = text_file(tmp_path, "one.txt", "-5,20", "0,30.5")
    two = text_file(tmp_path, "two.txt", "7,8")
    centres = as_centres(files.read_centres(spark, {1: one, 2: two}))
    assert [tuple(c) for c in centres] == [(1, 0, -5.0, 20.0), (1, 1, 0.0, 30.5), (2, 0, 7.0, 8.0)]


def test_kept_tables_lie_in_the_shared_folder(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "n int, s string")
    kept = keep(df, "some")
    assert sorted(kept.collect()) == sorted(df.collect())
    assert shared_folder(spark) + "/some-" in kept.inputFiles()[0]
    assert new_path(spark, "a") != new_path(spark, "a")


class Cluster:
    """As much of a cluster's session as ``shared_folder`` looks at."""

    def __init__(self, **values):
        self.conf = {key.replace("__", "."): value for key, value in values.items()}


def test_a_cluster_must_name_its_folder():
    named = Cluster(spark__master="yarn", spark__checkpoint__dir="hdfs:///shared/")
    assert shared_folder(named) == "hdfs:///shared"
    with pytest.raises(RuntimeError):
        shared_folder(Cluster(spark__master="yarn"))


def test_a_local_session_gets_a_folder_of_its_own():
    local = Cluster(spark__master="local[2]", spark__app__id="app-1")
    assert shared_folder(local) == shared_folder(local)
    other = Cluster(spark__master="local[2]", spark__app__id="app-2")
    assert shared_folder(local) != shared_folder(other)


def test_stored_types_stay_as_they_are(spark, make_posts, tmp_path):
    kinds = ["1", "01", "1 ", "2", "3", "word", "", None]
    posts = make_posts(*[(str(i), kind, "", "2020-01-01T00:00:00.000", "1", "", "") for i, kind in enumerate(kinds)])
    write_posts(posts, str(tmp_path / "store"))
    back = {r.post_id: r.post_type_id for r in load_posts(spark, str(tmp_path / "store")).collect()}
    assert back == {str(i): kind or None for i, kind in enumerate(kinds)}


def test_kept_tables_are_released(spark):
    before = session.made(spark)
    table = session.keep(spark.range(3).toDF("n"), "mine")
    path = table.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert os.path.isdir(path) and session.made(spark) == before + 1
    assert session.release(spark, before) == 1
    assert not os.path.isdir(path) and session.made(spark) == before


def test_popularity_of_a_repeated_tag(spark, tmp_path):
    (tmp_path / "p.csv").write_text("a,3\na,7\nb,many\nb,2\n,4\nc\n")
    found = files.read_popularity(spark, str(tmp_path / "p.csv"))
    assert sorted(map(tuple, found.collect())) == [("a", 7.0), ("b", 2.0)]


def test_line_breaks_and_backslashes_come_back(spark):
    tags = ["a\nb", "a\r\nb", "back\\slash", "\\n", "\\\\n\n", 'q"u,o\n"te', "\\", "plain"]
    rows = [(t, float(i), None if i % 2 else 1.5) for i, t in enumerate(tags)]
    path = new_path(spark, "features")
    files.write_csv(spark.createDataFrame(rows, "tag string, avg_minutes double, popularity double"), path)
    assert sorted(map(tuple, files.read_tag_features(spark, path).collect()), key=str) == sorted(rows, key=str)
    assert spark.read.text(path).count() == len(rows)


def test_dropped_lines_are_counted_by_reason(spark, tmp_path):
    good = "1,1,2" + "," * 14
    lines = [good, good, "", "", "", "1,2", good + ",", good + ',"open', '"', good]
    path = tmp_path / "dump"
    path.write_text("\n".join(lines) + "\n")
    seen = Observation()
    posts = read_posts(spark, str(path), seen=seen)
    assert posts.count() == read_posts(spark, str(path)).count() == 3
    assert seen.get == {"lines": 10, "kept": 3, "empty": 3, "open_quote": 2, "fields": 2}
    # The lines are read once
    text = posts._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan text") == 1 and "CollectMetrics" in text
    counted = Observation()
    path = new_path(spark, "popularity")
    spark.createDataFrame([("a,1",), ("b",), ("c,x",)], "value string").write.text(path)
    assert files.read_popularity(spark, path, counted).count() == 1
    assert counted.get == {"lines": 3, "kept": 2, "empty": 0, "open_quote": 0, "fields": 1}
