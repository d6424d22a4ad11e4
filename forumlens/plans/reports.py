"""The five reports over a frame of posts.

Posts are text columns as ``read_posts`` or ``load_posts`` give them. Each
report is one lazy plan, except that the experts, the points to cluster and the ids
with several questions and answers are written to the shared folder first, because
more than one job reads them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

from forumlens.functions.dates import TIME_SLOTS
from forumlens.operators import activity, clusters, experts, keyed, response
from forumlens.operators.joins import tag_features
from forumlens.operators.store import VERSION, activity_store, activity_view, store_posts, store_view
from forumlens.session import keep


def experts_report(
    posts: DataFrame, k: int = experts.TOP_K, unique_ids: bool = False
) -> DataFrame:
    """(tag, experts): who has the most accepted answers per tag."""
    counts = experts.answers_per_tag_user(posts, unique_ids)
    return experts.experts_list(experts.topk_experts(counts, k))


def experts_report_store(
    posts: DataFrame, k: int = experts.TOP_K, order_by: Sequence[str] = VERSION, unique_ids: bool = False
) -> DataFrame:
    """The same from the newest version of every post.

    It needs an owner for the question too, but neither a date nor a question
    to be answered by a post of type answer.
    """
    return _experts_of_store(store_posts(posts, order_by, unique_ids), k)


def experts_report_snapshot(snapshot: DataFrame, k: int = experts.TOP_K) -> DataFrame:
    """The same from a stored snapshot of ``valid_posts_store``."""
    return _experts_of_store(store_view(snapshot), k)


def experts_report_keyed(kept: keyed.Store, k: int = experts.TOP_K) -> DataFrame:
    """The same from a store kept by key, whose lookups need no shuffle."""
    return experts.experts_list(experts.topk_experts(keyed.answers_per_tag_user(kept), k))


def _experts_of_store(store: DataFrame, k: int) -> DataFrame:
    counts = experts.answers_per_tag_user_store(store)
    return experts.experts_list(experts.topk_experts(counts, k))


def activity_report(
    posts: DataFrame, slots: int = TIME_SLOTS, unique_ids: bool = False
) -> DataFrame:
    """(tag, histogram): answers by anyone per slot of the day."""
    return activity.activity_histogram(activity.activity_of_all(posts, slots, unique_ids))


def expert_users(posts: DataFrame, k: int = experts.TOP_K, unique_ids: bool = False) -> DataFrame:
    """The users who are an expert of any tag, as a table in the shared folder."""
    ranked = experts.topk_experts(experts.answers_per_tag_user(posts, unique_ids), k)
    return keep(ranked.select("user_id").distinct(), "experts")


def activity_report_experts(
    posts: DataFrame,
    users: DataFrame | None = None,
    slots: int = TIME_SLOTS,
    order_by: Sequence[str] = VERSION,
    unique_ids: bool = False,
) -> DataFrame:
    """(tag, histogram): answers by experts, by default those of ``experts_report``."""
    users = expert_users(posts, unique_ids=unique_ids) if users is None else users
    wide = activity.activity_of_experts(activity_store(posts, order_by, unique_ids), users, slots)
    return activity.activity_histogram(wide)


def activity_report_snapshot(snapshot: DataFrame, users: DataFrame, slots: int = TIME_SLOTS) -> DataFrame:
    """The same from a stored snapshot of ``valid_posts_activity_store`` and expert ``users`` (user_id).

    ``users`` may come from an expert list file, whose users repeat.
    """
    wide = activity.activity_of_experts(activity_view(snapshot), users, slots)
    return activity.activity_histogram(wide)


def activity_report_keyed(kept: keyed.Store, users: DataFrame, slots: int = TIME_SLOTS) -> DataFrame:
    """The same from a store kept by key, whose lookups need no shuffle."""
    return activity.activity_histogram(keyed.activity_of_experts(kept, users, slots))


def features(posts: DataFrame, popularity: DataFrame | None = None, unique_ids: bool = False) -> DataFrame:
    """(tag, avg_minutes, popularity); popularity is the number of questions by default."""
    popularity = activity.tag_popularity(posts) if popularity is None else popularity
    return tag_features(response.avg_minutes_per_tag(posts, unique_ids=unique_ids), popularity)


def clusters_report(
    posts: DataFrame,
    centres: DataFrame | Iterable,
    popularity: DataFrame | None = None,
    unique_ids: bool = False,
    **options,
) -> DataFrame:
    """(config, center, avg_minutes, popularity, size, at_rest): the clusters of the tags."""
    points = clusters.points(features(posts, popularity, unique_ids))
    return clusters.centres_frame(posts.sparkSession, clusters.kmeans(points, centres, **options))
