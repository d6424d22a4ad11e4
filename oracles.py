"""The registered queries again, as DuckDB SQL over the given tables.

The SQL lists every joined pair and counts it, so it shares no step with the
aggregated joins of the library. Words in doubled braces name the blocks below.
"""

from __future__ import annotations

import re

_BLOCKS = {
    # Inputs
    "posts": """
  SELECT CAST(event_id AS VARCHAR) AS post_id,
    CASE WHEN event_id % 101 = 100 THEN '3' WHEN event_id % 4 = 0 THEN '1' ELSE '2' END AS post_type_id,
    CASE WHEN event_id % 4 = 0 THEN
      (CASE WHEN event_id % 20 = 16 THEN '' ELSE CAST(event_id + 1 + (event_id // 4) % 3 AS VARCHAR) END)
      ELSE '' END AS accepted_answer_id,
    CASE WHEN event_id % 103 = 102 THEN 'bad-date'
      ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.')
        || lpad(CAST(extract(millisecond FROM ts) % 1000 AS VARCHAR), 3, '0') END AS creation_date,
    CASE WHEN event_id % 97 = 96 THEN '' ELSE CAST(user_id AS VARCHAR) END AS owner_user_id,
    CASE WHEN event_id % 4 <> 0 OR event_id % 89 = 88 THEN ''
      ELSE '<' || event_type || '><k' || CAST(CAST(json_extract_string(props, '$.k') AS INT) % 10 AS VARCHAR) || '>' END AS tags,
    CASE WHEN event_id % 4 = 0 THEN '' ELSE CAST(event_id - event_id % 4 AS VARCHAR) END AS parent_id
  FROM events""",
    "posts_xl": """
  SELECT CAST(o_orderkey AS VARCHAR) AS post_id, '1' AS post_type_id,
    CAST(100000000 + o_orderkey * 10 + 1 AS VARCHAR) AS accepted_answer_id,
    strftime(o_orderdate + to_minutes(CAST(o_custkey % 1440 AS BIGINT)), '%Y-%m-%dT%H:%M:%S.000') AS creation_date,
    CAST(o_custkey AS VARCHAR) AS owner_user_id,
    '<' || lower(substr(o_orderpriority, 3)) || '><s' || CAST(o_custkey % 50 AS VARCHAR) || '>' AS tags,
    '' AS parent_id FROM orders
  UNION ALL
  SELECT CAST(100000000 + l_orderkey * 10 + l_linenumber AS VARCHAR), '2', '',
    strftime(l_shipdate + to_minutes(CAST((l_partkey * 7) % 1440 AS BIGINT)), '%Y-%m-%dT%H:%M:%S.000'),
    CAST(l_suppkey AS VARCHAR), '', CAST(l_orderkey AS VARCHAR) FROM lineitem""",
    # The sides of the accepted join of posts_xl, straight from the given tables
    "asked_xl": """
  SELECT CAST(o_orderkey AS BIGINT) AS question_id, 100000000 + CAST(o_orderkey AS BIGINT) * 10 + 1 AS answer_id,
    date_trunc('second', o_orderdate + to_minutes(CAST(o_custkey % 1440 AS BIGINT))) AS created,
    '<' || lower(substr(o_orderpriority, 3)) || '><s' || CAST(o_custkey % 50 AS VARCHAR) || '>' AS tags FROM orders""",
    "given_xl": """
  SELECT 100000000 + CAST(l_orderkey AS BIGINT) * 10 + l_linenumber AS answer_id, CAST(l_suppkey AS BIGINT) AS user_id,
    date_trunc('second', l_shipdate + to_minutes(CAST((l_partkey * 7) % 1440 AS BIGINT))) AS created FROM lineitem""",
    "newest_xl": """
  SELECT answer_id, user_id FROM (SELECT *, row_number() OVER (
      PARTITION BY answer_id ORDER BY created DESC, CAST(user_id AS VARCHAR) DESC) AS version FROM given_xl) WHERE version = 1""",
    # Edits of every fiftieth post, of which the newest version counts
    "edited": """
  SELECT post_id, CASE WHEN CAST(post_id AS BIGINT) % 50 = 1 THEN '77' ELSE owner_user_id END AS owner_user_id,
    post_type_id, accepted_answer_id, CASE WHEN CAST(post_id AS BIGINT) % 50 = 0 THEN '<edited>' ELSE tags END AS tags FROM posts""",
    "edited_counts": """
  SELECT tag, user_id, count(*) AS answers FROM (
    SELECT TRY_CAST(a.owner_user_id AS BIGINT) AS user_id, unnest({{split_q}}) AS tag
    FROM edited q JOIN edited a ON q.accepted_answer_id = a.post_id
    WHERE q.post_type_id = '1' AND a.post_type_id IN ('1', '2') AND q.owner_user_id <> '' AND a.owner_user_id <> '') GROUP BY tag, user_id""",
    # Typed posts: ids as numbers, the date parsed
    "typed": """
  SELECT TRY_CAST(post_id AS BIGINT) AS post_id, post_type_id,
    TRY_CAST(accepted_answer_id AS BIGINT) AS accepted_answer_id, creation_date,
    CASE WHEN regexp_full_match(creation_date, '\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}[.]\\d{3}')
      THEN TRY_CAST(creation_date AS TIMESTAMP) END AS created,
    TRY_CAST(owner_user_id AS BIGINT) AS owner_user_id, tags,
    TRY_CAST(parent_id AS BIGINT) AS parent_id FROM posts""",
    "valid_accepted": """
  SELECT * FROM typed WHERE post_id IS NOT NULL AND creation_date <> ''
    AND ((post_type_id = '1' AND accepted_answer_id IS NOT NULL AND tags <> '')
      OR (post_type_id = '2' AND owner_user_id IS NOT NULL))""",
    "valid_activity": """
  SELECT * FROM typed WHERE post_id IS NOT NULL AND creation_date <> ''
    AND ((post_type_id = '1' AND tags <> '')
      OR (post_type_id = '2' AND parent_id IS NOT NULL AND owner_user_id IS NOT NULL))""",
    # Joined rows
    "joined": """
  SELECT a.owner_user_id AS user_id, q.tags, date_sub('minute', q.created, a.created) AS minutes,
    q.post_id AS question_id
  FROM valid_accepted q JOIN valid_accepted a ON q.accepted_answer_id = a.post_id
  WHERE q.post_type_id = '1' AND a.post_type_id = '2'""",
    "tag_slots": """
  SELECT q.tags, CAST(hour(a.created) // 6 AS INT) AS slot
  FROM valid_activity q JOIN valid_activity a ON a.parent_id = q.post_id
  WHERE q.post_type_id = '1' AND a.post_type_id = '2' AND a.created IS NOT NULL""",
    "joined_tags": """
  SELECT user_id, minutes, question_id, unnest({{split}}) AS tag FROM joined""",
    # Snapshots
    "latest": """
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY post_id
      ORDER BY creation_date DESC NULLS LAST, CAST(owner_user_id AS VARCHAR) DESC NULLS LAST,
        post_type_id DESC, accepted_answer_id DESC NULLS LAST, tags DESC, parent_id DESC NULLS LAST) AS version
    FROM typed WHERE post_type_id IN ('1', '2') AND post_id IS NOT NULL) WHERE version = 1""",
    "joined_store": """
  SELECT a.owner_user_id AS user_id, q.tags, q.post_id AS question_id
  FROM latest q JOIN latest a ON q.accepted_answer_id = a.post_id
  WHERE q.post_type_id = '1' AND q.owner_user_id IS NOT NULL AND a.owner_user_id IS NOT NULL""",
    "activity_latest": """
  SELECT post_id, post_type_id, owner_user_id,
    CASE WHEN post_type_id <> '2' THEN tags END AS tags,
    CASE WHEN post_type_id = '2' THEN creation_date END AS creation_date,
    CASE WHEN post_type_id = '2' THEN created END AS created,
    CASE WHEN post_type_id = '2' THEN parent_id END AS parent_id
  FROM (SELECT *, row_number() OVER (PARTITION BY post_id
      ORDER BY creation_date DESC NULLS LAST, CAST(owner_user_id AS VARCHAR) DESC NULLS LAST,
        post_type_id DESC, tags DESC, parent_id DESC NULLS LAST) AS version
    FROM typed WHERE post_id IS NOT NULL
      AND (post_type_id = '2' OR tags <> '')) WHERE version = 1""",
    # Counts
    "counts": """
  SELECT tag, user_id, count(*) AS answers FROM joined_tags GROUP BY tag, user_id""",
    "counts_store": """
  SELECT tag, user_id, count(*) AS answers
  FROM (SELECT user_id, unnest({{split}}) AS tag FROM joined_store) GROUP BY tag, user_id""",
    "experts": """
  SELECT tag, rank, user_id, answers FROM (SELECT *, CAST(row_number() OVER (
      PARTITION BY tag ORDER BY answers DESC, user_id) AS INT) AS rank FROM counts) WHERE rank <= 5""",
    "experts_store": """
  SELECT tag, rank, user_id, answers FROM (SELECT *, CAST(row_number() OVER (
      PARTITION BY tag ORDER BY answers DESC, user_id) AS INT) AS rank FROM counts_store) WHERE rank <= 5""",
    "slot_counts": """
  SELECT tag, slot, count(*) AS answers
  FROM (SELECT slot, unnest({{split}}) AS tag FROM tag_slots) GROUP BY tag, slot""",
    "expert_slot_counts": """
  SELECT tag, slot, count(*) AS answers FROM (
    SELECT CAST(hour(a.created) // 6 AS INT) AS slot, unnest({{split_q}}) AS tag
    FROM activity_latest a JOIN activity_latest q ON a.parent_id = q.post_id
    WHERE a.post_type_id = '2' AND a.created IS NOT NULL AND q.tags <> ''
      AND a.owner_user_id IN (SELECT user_id FROM experts)) GROUP BY tag, slot""",
    "averages": """
  SELECT tag, CAST(trunc(sum(minutes) / count(*)) AS BIGINT) AS avg_minutes
  FROM joined_tags WHERE minutes IS NOT NULL GROUP BY tag""",
    "popularity": """
  SELECT tag, count(*) AS popularity
  FROM (SELECT unnest(list_distinct({{split}})) AS tag FROM valid_activity WHERE post_type_id = '1')
  GROUP BY tag""",
    "features": """
  SELECT coalesce(a.tag, p.tag) AS tag, avg_minutes, popularity
  FROM averages a FULL JOIN popularity p ON a.tag = p.tag""",
    "complete": """
  SELECT * FROM features WHERE avg_minutes IS NOT NULL AND popularity IS NOT NULL""",
    # Points
    "part_points": """
  SELECT 'p' || l_partkey AS tag,
    CAST(sum(date_sub('minute', o_orderdate, l_shipdate)) // count(*) AS BIGINT) AS avg_minutes,
    count(*) AS popularity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    "supplier_points": """
  SELECT 's' || l_suppkey AS tag,
    CAST(sum(date_sub('minute', o_orderdate, l_shipdate)) // count(*) AS BIGINT) AS avg_minutes,
    count(*) AS popularity
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
}
# A tag list in SQL
SPLIT = "[x FOR x IN string_split(translate(replace({0}, '><', '='), '<>', ''), '=') IF x <> '']"


def _fill(sql: str) -> str:
    return sql.replace("{{split}}", SPLIT.format("tags")).replace("{{split_q}}", SPLIT.format("q.tags"))


def with_blocks(select: str, posts: str = "posts", extra: str = "") -> str:
    """``select`` behind the blocks it needs, ``posts`` standing for the named input."""
    blocks = {name: _fill(sql) for name, sql in _BLOCKS.items() if name not in ("posts", "posts_xl")}
    blocks["posts"] = _BLOCKS[posts]
    needed: set[str] = set()
    todo = [extra + select]
    while todo:
        text = todo.pop()
        for name in blocks:
            if name not in needed and re.search(rf"\b(FROM|JOIN) {name}\b", text):
                needed.add(name)
                todo.append(blocks[name])
    order = ["posts", *[name for name in _BLOCKS if name not in ("posts", "posts_xl")]]
    # Computed once, whatever is asked of the result
    once = {"asked_xl", "given_xl", "newest_xl"}
    ctes = [f"{name} AS {'MATERIALIZED ' * (name in once)}({blocks[name]})" for name in order if name in needed]
    if extra:
        ctes.append(extra)
    recursive = "RECURSIVE " if "FROM passes" in extra else ""
    return f"WITH {recursive}" + ",\n".join(ctes) + "\n" + select


# Adding zero makes a negative zero positive
ROUNDED = (
    "config, center, round(avg_minutes, 4) + 0.0::DOUBLE AS avg_minutes,"
    " round(popularity, 4) + 0.0::DOUBLE AS popularity, size"
)


def _values(centres) -> str:
    rows = ", ".join(f"({c}, {i}, CAST({m} AS DOUBLE), CAST({p} AS DOUBLE))" for c, i, m, p in centres)
    return f"SELECT * FROM (VALUES {rows}) AS v(config, center, avg_minutes, popularity)"


def _x(table: str, divide: bool = True) -> str:
    by = " / 1590397.0::DOUBLE" if divide else ""
    return f"round_even(CAST({table}.avg_minutes AS DOUBLE){by}, 2)"


def _y(table: str) -> str:
    return f"round_even(CAST({table}.popularity AS DOUBLE), 2)"


def _assigned(points: str, centres: str, own_config: bool = False) -> str:
    """Each point with the nearest of ``centres`` (config, center, cx, cy) per configuration."""
    on = "p.config = c.config" if own_config else "true"
    return f"""
  SELECT * FROM (SELECT p.*{' EXCLUDE (config)' if own_config else ''}, c.config, c.center, c.cx, c.cy, row_number() OVER (PARTITION BY p.tag, c.config
      ORDER BY sqrt(pow(p.x - c.cx, 2) + pow(p.y - c.cy, 2)), c.center) AS place
    FROM {points} p JOIN {centres} c ON {on}) WHERE place = 1"""


def _scaled(table: str, divide: bool = True) -> str:
    return f"SELECT config, center, {_x(table, divide)} AS cx, {_y(table)} AS cy FROM {table}"


def many_centres(points: str) -> str:
    """CTE ``met``: the points with the nearest of those that are centres too, all of them tried."""
    return f"""xy AS (SELECT p.*, {_x('p')} AS x, {_y('p')} AS y FROM {points} p),
chosen AS (SELECT 1 AS config, CAST(substr(tag, 2) AS INT) AS center, x AS cx, y AS cy FROM xy WHERE CAST(substr(tag, 2) AS INT) % 3 = 0),
met AS ({_assigned('xy', 'chosen')})"""


def lloyd_steps(points: str, centres, steps: int, own_config: bool = False, normalised: bool = False) -> str:
    """CTEs ``xy`` (points), ``s1`` ... ``s<steps>`` (new centres) and ``a1`` ... (assignments)."""
    ctes = [f"xy AS (SELECT p.*, {_x('p')} AS x, {_y('p')} AS y FROM {points} p)", f"s0 AS ({_values(centres)})"]
    first, second = ("x", "y") if normalised else ("avg_minutes", "popularity")
    for n in range(1, steps + 1):
        ctes.append(f"c{n} AS ({_scaled(f's{n - 1}', not normalised or n == 1)})")
        ctes.append(f"a{n} AS ({_assigned('xy', f'c{n}', own_config)})")
        ctes.append(
            f"s{n} AS (SELECT config, center, any_value(cx) AS cx, any_value(cy) AS cy,"
            f" avg(CAST({first} AS DOUBLE)) AS avg_minutes, avg(CAST({second} AS DOUBLE)) AS popularity,"
            f" count(*) AS size FROM a{n} GROUP BY config, center)"
        )
    return ",\n".join(ctes)


def lloyd_loop(points: str, centres, own_config: bool = False, normalised: bool = False) -> str:
    """CTE ``passes``: the centres of every pass until all of them are at rest.

    The first pass has number 1. ``rest`` tells whether a cluster is at rest, and
    ``moving`` counts, over all configurations, those that still moved.
    """
    first, second = ("x", "y") if normalised else ("avg_minutes", "popularity")
    rest, least = ("<= 0.1", 2) if normalised else ("< 1", 1)
    by = "CASE WHEN pass = 0 THEN 1590397.0::DOUBLE ELSE 1.0::DOUBLE END" if normalised else "1590397.0::DOUBLE"
    nx = "round_even(avg_minutes, 2)" if normalised else "round_even(avg_minutes / 1590397.0::DOUBLE, 2)"
    on = "p.config = c.config" if own_config else "true"
    return f"""xy AS (SELECT p.*, {_x("p")} AS x, {_y("p")} AS y FROM {points} p),
start AS ({_values(centres)}),
passes AS (
  SELECT 0 AS pass, config, center, avg_minutes, popularity, CAST(0 AS BIGINT) AS size, false AS rest,
    CAST(1 AS BIGINT) AS moving
  FROM start
  UNION ALL
  SELECT pass, config, center, avg_minutes, popularity, size, rest,
    CAST(sum(CASE WHEN rest THEN 0 ELSE 1 END) OVER () AS BIGINT) AS moving
  FROM (SELECT *, sqrt(pow({nx} - cx, 2) + pow(round_even(popularity, 2) - cy, 2)) {rest} AS rest
    FROM (SELECT any_value(pass) AS pass, config, center, any_value(cx) AS cx, any_value(cy) AS cy,
        avg(CAST({first} AS DOUBLE)) AS avg_minutes, avg(CAST({second} AS DOUBLE)) AS popularity, count(*) AS size
      FROM (SELECT p.avg_minutes, p.popularity, p.x, p.y, c.pass, c.config, c.center, c.cx, c.cy,
          row_number() OVER (PARTITION BY p.tag, c.config
            ORDER BY sqrt(pow(p.x - c.cx, 2) + pow(p.y - c.cy, 2)), c.center) AS place
        FROM xy p JOIN (SELECT pass + 1 AS pass, config, center, round_even(avg_minutes / {by}, 2) AS cx,
            round_even(popularity, 2) AS cy FROM passes
          WHERE moving > 0 OR pass < {least}) c ON {on})
      WHERE place = 1 GROUP BY config, center)))"""
