"""DuckDB SQL for the queries on conversations and embeddings, step by step and unindexed."""

from __future__ import annotations

from termlode.llm.grid_join import SIMILARITY
from termlode.llm.prefix_trie import GROUP, MOST_SHARED
from termlode.llm.repair import DELETE, INSERT, REROLE, RULES, TRUNCATED

# CRC-32 of a short ASCII text, bit by bit.
_CRC = """xor(list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)],
                list_transform(range(1, len({0}) + 1), lambda i: CAST(ascii({0}[i]) AS BIGINT))),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
      lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""


def crc32(text: str) -> str:
    return _CRC.format(text)


def prefix_trie_sql() -> str:
    """Every prefix as a list of digests, and every pair of a node and one below it."""
    return f"""
    WITH turns AS (
      SELECT conv_id, role, text, md5(strlen(role) || ':' || role || text) AS digest,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
                                md5(strlen(role) || ':' || role || text)) AS at
      FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations WHERE conv_id IS NOT NULL)),
    names AS (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS name FROM turns),
    ids AS (SELECT conv_id, {crc32("name")} % {MOST_SHARED + 1} AS h,
                   conv_id - conv_id % {GROUP} AS base FROM names),
    sized AS (SELECT ids.*, (SELECT count(*) FROM turns t WHERE t.conv_id = ids.base) AS n FROM ids),
    rebuilt AS (
      SELECT i.conv_id, t.at AS depth, t.digest, strlen(t.text) AS size
      FROM sized i JOIN turns t ON t.conv_id = i.base AND t.at <= i.h
      UNION ALL
      SELECT i.conv_id, t.at - i.h + least(i.h, i.n), t.digest, strlen(t.text)
      FROM sized i JOIN turns t ON t.conv_id = i.conv_id AND t.at > i.h),
    paths AS (
      SELECT conv_id, depth, size,
             array_agg(digest) OVER (PARTITION BY conv_id ORDER BY depth) AS path
      FROM rebuilt
      UNION ALL
      SELECT conv_id, 0, 0, CAST([] AS VARCHAR[]) FROM ids),
    ends AS (
      SELECT path, list(conv_id ORDER BY conv_id) AS convs
      FROM (SELECT conv_id, arg_max(path, depth) AS path FROM paths GROUP BY conv_id) GROUP BY path),
    nodes AS (SELECT path, min(conv_id) AS conv_id, min(depth) AS depth, min(size) AS size,
                     count(*) AS n_convs FROM paths GROUP BY path),
    children AS (SELECT path[1 : depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0
                 GROUP BY ALL),
    counted AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (path)),
    below AS (SELECT v.path, sum((w.n_convs - 1) * w.size) AS saved,
                     count(*) FILTER (WHERE w.n_children = 0) AS leaves
              FROM counted v JOIN counted w ON w.depth >= v.depth AND w.path[1 : v.depth] = v.path
              GROUP BY v.path)
    SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, v.n_convs,
           v.n_children, leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
           sha256(coalesce(array_to_string(convs, ','), '')) AS ends_sha256
    FROM counted v JOIN below USING (path) LEFT JOIN ends USING (path)
    LEFT JOIN nodes p ON v.depth > 0 AND p.path = v.path[1 : v.depth - 1]"""


def _steps_sql() -> str:
    """All ways over one row: state, initial, fault, letters, cost and the state after it.

    Up to three rows are inserted first, then the row is kept, reroled or deleted.
    """
    after = {"": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}
    inserts = []
    for state in after:
        here, letters, cost = state, "", 0
        for _ in range(4):
            inserts.append((state, letters, cost, here))
            here, letters, cost = ("a" if here == "u" else "u"), letters + "I", cost + INSERT
    rows = []
    for state, letters, cost, here in inserts:
        for initial in "sua?":
            for fault in ("", "cut", "gone"):
                rows.append((state, initial, fault, letters + "D", cost + DELETE, here))
                more = cost + (TRUNCATED if fault == "cut" else 0)
                for to in after[here] if fault != "gone" else ():
                    if to == initial:
                        rows.append((state, initial, fault, letters + "K", more, to))
                    elif to != "s":
                        rows.append((state, initial, fault, letters + "R", more + REROLE, to))
    values = ", ".join(f"('{a}', '{b}', '{c}', '{d}', {e}, '{f}')" for a, b, c, d, e, f in rows)
    ends = ", ".join(f"('{a}', '{b}', {c})" for a, b, c, d in inserts if d in ("", "a"))
    return f"""
    steps(state, initial, fault, letters, price, after) AS (VALUES {values}),
    last_steps(state, letters, price) AS (VALUES {ends})"""


def repair_sql() -> str:
    """The cheapest repair of each conversation, row by row, the best audit for each state."""
    blank = r"'[^\x20\x09-\x0D]'"
    return f"""
    WITH RECURSIVE {_steps_sql()},
    nulls AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')
               AS name
      FROM conversations),
    ruled AS (SELECT *, {crc32("name")} % {RULES} AS rule FROM nulls),
    hurt AS (
      SELECT conv_id, turn, CASE WHEN rule = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN rule = 1 THEN '' WHEN rule = 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                  ELSE text END AS text, unnest(range(CASE WHEN rule = 3 THEN 2 ELSE 1 END)) AS copy
      FROM ruled WHERE rule <> 0),
    placed AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
                                   md5(strlen(role) || ':' || role || text), copy) AS spot FROM hurt),
    faulty AS (
      SELECT *, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE '?' END AS initial,
             CASE WHEN NOT regexp_matches(text, {blank}) THEN 'blank'
                  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY spot) > 1
                  THEN 'duplicate'
                  WHEN right(regexp_replace(text, '[\\x20\\x09-\\x0D]+$', ''), 1) NOT IN ('.', '!', '?')
                  THEN 'truncated' ELSE '' END AS kind,
             left(role, 1) || lead(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY spot) AS pair
      FROM placed),
    counts AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (WHERE kind = 'blank') AS blank,
             count(*) FILTER (WHERE kind = 'duplicate') AS duplicate,
             count(*) FILTER (WHERE kind = 'truncated') AS truncated,
             count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal, max(spot) AS size
      FROM faulty GROUP BY conv_id),
    walk AS (
      SELECT conv_id, CAST(0 AS BIGINT) AS spot, size, '' AS state, 0 AS cost, '' AS audit FROM counts
      UNION ALL
      SELECT conv_id, spot, size, after, best.cost, best.audit FROM (
        SELECT w.conv_id, w.spot + 1 AS spot, any_value(w.size) AS size, s.after,
               min({{'cost': w.cost + s.price, 'audit': w.audit || s.letters}}) AS best
        FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.spot = w.spot + 1
        JOIN steps s ON s.state = w.state AND s.initial = f.initial AND s.fault =
          CASE WHEN f.kind IN ('blank', 'duplicate') THEN 'gone'
               WHEN f.kind = 'truncated' THEN 'cut' ELSE '' END
        GROUP BY w.conv_id, w.spot, s.after)),
    best AS (
      SELECT conv_id, min({{'cost': cost + price, 'audit': audit || letters}}) AS b
      FROM walk JOIN last_steps USING (state) WHERE spot = size GROUP BY conv_id),
    letters AS (
      SELECT conv_id, len(replace(b.audit, 'D', '')) % 2 AS odd,
             unnest(range(1, len(b.audit) + 1)) AS place, b.audit AS audit FROM best),
    numbered AS (
      SELECT *, audit[place] AS edit,
             len(replace(audit[1 : place], 'I', '')) AS spot,
             len(replace(audit[1 : place], 'D', '')) - 1 AS written FROM letters),
    lines AS (
      SELECT n.conv_id, n.place,
             CASE WHEN edit = 'K' THEN f.role WHEN (written - odd) % 2 = 0 THEN 'user'
                  ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE f.text END AS line
      FROM numbered n LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM n.conv_id
        AND f.spot = n.spot AND edit <> 'I' WHERE edit <> 'D'),
    repaired AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY place) AS whole FROM lines
                 GROUP BY conv_id)
    SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
           coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, CAST(coalesce(b.cost, 0) AS BIGINT) AS cost,
           coalesce(b.audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) i
    LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
    LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM i.conv_id
    LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM i.conv_id"""


def embedding_duplicates_sql() -> str:
    """Every pair of vectors, and everything that can be reached over links."""
    return f"""
    WITH RECURSIVE ready AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (
      SELECT a.vec_id AS a, b.vec_id AS b FROM ready a JOIN ready b
        ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
      WHERE list_cosine_similarity(a.v, b.v) >= {SIMILARITY}),
    reach AS (
      SELECT vec_id, vec_id AS other FROM embeddings
      UNION
      SELECT r.vec_id, b FROM reach r JOIN links ON a = r.other),
    least AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
    counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
    SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id,
           e.vec_id IS NOT DISTINCT FROM component_id AS kept
    FROM embeddings e LEFT JOIN counts USING (vec_id) LEFT JOIN least USING (vec_id)"""
