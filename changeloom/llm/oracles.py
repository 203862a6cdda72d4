"""The queries as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

_TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

_MIXING = r"""
WITH docs AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM docs GROUP BY source
), filled AS (
  SELECT *, 2 * source_size AS cap,
         coalesce(sum(2 * source_size) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
         sum(weight) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
         sum(source_size) OVER () AS all_size
  FROM sources
), levels AS (
  SELECT *, 3 * all_size - 2 * capped AS remaining, (3 * all_size - 2 * capped) * weight > 2 * cap * open_weight AS stops FROM filled
), first_open AS (
  SELECT remaining, open_weight FROM levels WHERE NOT stops ORDER BY cap / weight, source NULLS LAST LIMIT 1
), targets AS (
  SELECT l.source, l.source_size,
         CASE WHEN l.stops THEN CAST(l.cap AS DOUBLE) ELSE CAST(f.remaining * l.weight AS DOUBLE) / CAST(f.open_weight * 2 AS DOUBLE) END AS target
  FROM levels l CROSS JOIN first_open f
), numbered AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / CAST(t.source_size AS DOUBLE) ELSE 0.0 END AS rate,
         CAST(CAST('0x' || substr(md5('0:' || coalesce(d.source, '')), 1, 4) AS BIGINT) AS DOUBLE) / 65536.0 AS start,
         row_number() OVER (
           PARTITION BY d.source
           ORDER BY length(bin(size)) * 64 + (size >> greatest(length(bin(size)) - 6, 0)), coalesce(doc_id % 16, 0), doc_id NULLS FIRST, size
         ) - 1 AS n
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), taken AS (
  SELECT *, CAST(least(floor(start + rate * (n + 1)) - floor(start + rate * n), ceil(rate)) AS INTEGER) AS copies FROM numbered
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM taken
"""

_CHAT = r"""
WITH given AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM given
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### :') + length('/turn<>') + 3 + 2 * length(role) - length(regexp_replace(role, '[\\#<:]', '', 'g'))
           + 2 * length(text) - length(regexp_replace(text, '[\\#<:]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

_SEARCH = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term, r
  FROM (SELECT *, row_number() OVER () AS r FROM documents)
), tfs AS (SELECT r, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT r, count(*) AS n FROM words GROUP BY r),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sizes),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
asked AS (
  SELECT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT *, row_number() OVER () AS i FROM benchmark)
), weighted AS (
  SELECT i, item_id, a.term, count(*) * CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM asked a JOIN dfs d ON a.term = d.term, totals GROUP BY i, item_id, a.term, docs, df
), damped AS (SELECT r, 100 - 75 + (75 * n * docs) // words AS m FROM sizes, totals),
scored AS (
  SELECT i, item_id, t.r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM weighted w JOIN tfs t ON w.term = t.term JOIN damped d ON d.r = t.r GROUP BY i, item_id, t.r, doc_id
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM scored WHERE score > 0
) WHERE rank <= 10
"""


def _add(state: str, cost: object, letter: str, line: str | None = None) -> str:
    """A state of a repair after one more edit."""
    lines = f"list_append({state}.r, {line})" if line else f"{state}.r"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'r': {lines}}}"


def _repair() -> str:
    """The repair by a recursion over rows that carries the cheapest edits, the least of equal ones, to each of the four states."""
    user, assistant = "'user:'", "'assistant:'"

    def stays(state: str, role: str) -> str:
        """A row that follows on a state under a role, kept or changed."""
        keep = f"CASE WHEN initial = '{role[0]}' THEN 0 ELSE 2 END + CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END + CASE WHEN gone THEN 1000000000 ELSE 0 END"
        edit = f"CASE WHEN initial = '{role[0]}' THEN 'K' ELSE 'R' END"
        line = f"CASE WHEN initial = '{role[0]}' THEN role ELSE '{role}' END || ':' || text"
        return f"{{'c': {state}.c + {keep}, 'a': {state}.a || {edit}, 'r': list_append({state}.r, {line})}}"

    first = (
        "{'c': p0.c + CASE WHEN initial = 's' AND NOT gone THEN CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END ELSE 1000000000 END, "
        "'a': p0.a || 'K', 'r': list_append(p0.r, role || ':' || text)}"
    )
    two = lambda state: _add(f"({_add(state, 2, 'I', user)})", 2, "I", assistant)
    none = "{'c': 1000000000::BIGINT, 'a': '', 'r': []::VARCHAR[]}"
    return rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS k
  FROM conversations
), hashed AS (
  SELECT *, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(k) // 2 + 1), lambda i: CAST('0x' || substr(k, CAST(2 * i - 1 AS BIGINT), 2) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, (x & 1) * 3988292384))
  ), 4294967295) % 20 AS h FROM keyed
), damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN h = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed WHERE h <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS n,
         left(role, 1) AS initial, right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last
  FROM damaged
), judged AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
                 WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY n) || initial AS pair
  FROM numbered
), counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id
), steps AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 'r': []::VARCHAR[]}} AS p0, {none} AS p1, {none} AS p2, {none} AS p3 FROM counted
  UNION ALL
  SELECT conv_id, n, {_add("p0", 3, "D")}, least({_add("p1", 3, "D")}, {first}),
         least({_add("p2", 3, "D")}, {stays("p0", "user")}, {stays("p1", "user")}, {stays("c3", "user")}),
         least({_add("p3", 3, "D")}, {stays("c2", "assistant")})
  FROM (
    SELECT s.*, j.n, j.role, j.text, j.initial, j.fault, j.fault IN ('blank', 'duplicate') AS gone,
           least(p2, {_add("p0", 2, "I", user)}, {_add("p1", 2, "I", user)}, {_add("p3", 2, "I", user)}) AS c2,
           least(p3, {_add("p2", 2, "I", assistant)}, {two("p0")}, {two("p1")}) AS c3
    FROM steps s JOIN judged j ON s.conv_id IS NOT DISTINCT FROM j.conv_id AND j.n = s.i + 1
  )
), ended AS (
  SELECT s.conv_id, least(p0, p3, {_add("p2", 2, "I", assistant)}, {two("p1")}) AS best
  FROM steps s JOIN counted c ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.i = c.n
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit,
       sha256(coalesce(array_to_string(best.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_topk": _TOPK, "op7_mixing": _MIXING, "op10_chat": _CHAT, "op12_repair": _repair(), "op13_search": _SEARCH}
