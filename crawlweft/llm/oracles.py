"""DuckDB SQL for the operators that SQL can express."""


def crc32(text: str) -> str:
    """CRC-32 (unsigned) of an ASCII string expression, bit by bit."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    last = f"list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda r, x: CASE WHEN x >= 0 THEN xor(r, x) ELSE xor(r >> 1, 3988292384 * (r & 1)) END)"
    return f"xor({last}, 4294967295)"


def _code(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_code(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


#: The trees level by level, then every leaf's way up, first in its language and then over the languages.
MERKLE = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf("n_chars")} AS leaf,
    {_leaf(f"CASE WHEN {crc32('doc_id::VARCHAR')} % 7 = 0 THEN n_chars + 1 ELSE n_chars END")} AS now
  FROM documents
), base AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    row_number() OVER (ORDER BY g, doc_id NULLS FIRST, leaf) AS id, count(*) OVER (PARTITION BY g) AS n
  FROM hashed
), tree(g, lvl, pos, n, h) AS (
  SELECT g, 0, pos, n, leaf FROM base
  UNION ALL
  SELECT g, lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM tree WHERE n > 1 GROUP BY g, lvl, pos // 2, n
), climb(id, g, lvl, pos, n, folded, proof) AS (
  SELECT id, g, 0, pos, n, now, '' FROM base
  UNION ALL
  SELECT c.id, c.g, c.lvl + 1, c.pos // 2, (c.n + 1) // 2,
    sha256(CASE WHEN c.pos % 2 = 1 THEN s.h || c.folded ELSE c.folded || coalesce(s.h, '') END), c.proof || coalesce(s.h, '')
  FROM climb c LEFT JOIN tree s ON s.g = c.g AND s.lvl = c.lvl AND s.pos = xor(c.pos, 1) WHERE c.n > 1
), subroots AS (
  SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1
), top(lvl, pos, n, h) AS (
  SELECT 0, pos, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 2, n
), above(id, lvl, pos, n, folded, proof) AS (
  SELECT c.id, 0, s.pos, s.n, c.folded, c.proof FROM climb c JOIN subroots s ON s.g = c.g WHERE c.n = 1
  UNION ALL
  SELECT c.id, c.lvl + 1, c.pos // 2, (c.n + 1) // 2,
    sha256(CASE WHEN c.pos % 2 = 1 THEN s.h || c.folded ELSE c.folded || coalesce(s.h, '') END), c.proof || coalesce(s.h, '')
  FROM above c LEFT JOIN top s ON s.lvl = c.lvl AND s.pos = xor(c.pos, 1) WHERE c.n > 1
)
SELECT b.doc_id, b.leaf, s.h AS subroot, r.h AS root, sha256(a.proof) AS proof_sha256, a.folded AS folded_root, a.folded = r.h AS verified
FROM base b JOIN above a ON a.id = b.id AND a.n = 1 JOIN subroots s ON s.g = b.g JOIN top r ON r.n = 1
"""

#: Damage, faults, then the cheapest way to each state (0 start, 1 after s, 2 after u, 3 after a) row by row.
CONVERSATIONS = f"""
WITH RECURSIVE read AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM read WHERE kind <> 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
  FROM damaged
), faulty AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' END AS fault
  FROM ranked
), told AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id
), inserts(was, edits, state, cost, lines) AS (
  VALUES (0, '', 0, 0, []), (1, '', 1, 0, []), (2, '', 2, 0, []), (3, '', 3, 0, []),
    (0, 'I', 2, 3, ['user:']), (1, 'I', 2, 3, ['user:']), (2, 'I', 3, 3, ['assistant:']), (3, 'I', 2, 3, ['user:']),
    (0, 'II', 3, 6, ['user:', 'assistant:']), (1, 'II', 3, 6, ['user:', 'assistant:']), (2, 'II', 2, 6, ['assistant:', 'user:']), (3, 'II', 3, 6, ['user:', 'assistant:'])
), edits(was, edit, initial, state, cost, due) AS (
  VALUES (0, 'D', NULL, 0, 4, NULL), (1, 'D', NULL, 1, 4, NULL), (2, 'D', NULL, 2, 4, NULL), (3, 'D', NULL, 3, 4, NULL),
    (0, 'K', 's', 1, 0, NULL), (0, 'K', 'u', 2, 0, NULL), (1, 'K', 'u', 2, 0, NULL), (3, 'K', 'u', 2, 0, NULL), (2, 'K', 'a', 3, 0, NULL),
    (0, 'R', NULL, 2, 3, 'user'), (1, 'R', NULL, 2, 3, 'user'), (3, 'R', NULL, 2, 3, 'user'), (2, 'R', NULL, 3, 3, 'assistant')
), best(conv_id, i, state, way) AS (
  SELECT conv_id, 0::BIGINT, 0, {{'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]}} FROM told
  UNION ALL
  SELECT b.conv_id, b.i + 1, e.state, min({{
      'cost': (b.way.cost + p.cost + e.cost + CASE WHEN r.fault = 'truncated' AND e.edit <> 'D' THEN 3 ELSE 0 END)::BIGINT,
      'audit': b.way.audit || p.edits || e.edit,
      'lines': list_concat(b.way.lines, p.lines, CASE WHEN e.edit = 'D' THEN [] ELSE [coalesce(e.due, r.role) || ':' || r.text] END)}})
  FROM best b JOIN faulty r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.i = b.i + 1
    JOIN inserts p ON p.was = b.state JOIN edits e ON e.was = p.state
  WHERE (e.edit = 'D' OR r.fault IS NULL OR r.fault = 'truncated') AND (e.edit <> 'K' OR e.initial = r.initial)
  GROUP BY b.conv_id, b.i + 1, e.state
), ended AS (
  SELECT t.*, min({{'cost': b.way.cost + p.cost, 'audit': b.way.audit || p.edits, 'lines': list_concat(b.way.lines, p.lines)}}) AS way
  FROM told t JOIN best b ON b.conv_id IS NOT DISTINCT FROM t.conv_id AND b.i = t.n JOIN inserts p ON p.was = b.state
  WHERE p.state IN (0, 3) GROUP BY ALL
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(way.cost, 0) AS cost, coalesce(way.audit, '') AS audit, sha256(coalesce(array_to_string(way.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""
