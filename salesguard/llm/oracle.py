"""DuckDB SQL of the conversation operators."""

from __future__ import annotations


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string, bit by bit."""
    bit = "CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END"
    byte = f"list_reduce([xor(c, b)] || list_transform(range(8), lambda i: 0::BIGINT), lambda v, z: {bit})"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda c, b: {byte}), 4294967295::BIGINT)"


def _moves() -> str:
    """Every way from a state over one row: turns put in, then delete, keep or another role."""
    after = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    put, name = (2, 2, 3, 2), {2: "user", 3: "assistant"}
    rows = []
    for start in range(4):
        state, lines = start, ""
        for k in range(3):
            letters, cost = "I" * k, 2 * k
            rows.append((start, "D", "", letters + "D", cost + 3, state, lines, ""))
            rows += [(start, "K", x, letters + "K", cost, to, lines, "") for (at, x), to in after.items() if at == state]
            rows.append((start, "R", "", letters + "R", cost + 2, put[state], lines, name[put[state]]))
            state = put[state]
            lines += f"{name[state]}:|"
    return ", ".join(str(r) for r in rows)


OP11 = f"""
WITH RECURSIVE hit AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k FROM conversations),
hurt AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy_ FROM hit WHERE k <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy_) AS i,
    regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS last_ FROM hurt),
marked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS again,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM placed),
faults AS (
  SELECT *, CASE WHEN last_ = '' THEN 'blank' WHEN again > 1 THEN 'duplicate'
    WHEN last_ NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM marked),
moves(st, kind, initial, letters, cost, st2, lines_, role2) AS (VALUES {_moves()}),
ids AS (SELECT DISTINCT conv_id FROM conversations),
step AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS st, 0::BIGINT AS cost, '' AS audit, '' AS body FROM ids
  UNION ALL
  SELECT conv_id, i, st2, cost, audit, body FROM (
    SELECT p.conv_id, r.i, m.st2,
      p.cost + m.cost + CASE WHEN r.fault = 'truncated' AND m.kind <> 'D' THEN 1 ELSE 0 END AS cost,
      p.audit || m.letters AS audit,
      p.body || replace(m.lines_, '|', chr(10)) || CASE m.kind WHEN 'K' THEN r.role || ':' || r.text || chr(10)
        WHEN 'R' THEN m.role2 || ':' || r.text || chr(10) ELSE '' END AS body,
      row_number() OVER (PARTITION BY p.conv_id, m.st2 ORDER BY
        p.cost + m.cost + CASE WHEN r.fault = 'truncated' AND m.kind <> 'D' THEN 1 ELSE 0 END, p.audit || m.letters) AS best
    FROM step p JOIN faults r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1
    JOIN moves m ON m.st = p.st AND (m.kind = 'D' OR r.fault NOT IN ('blank', 'duplicate'))
      AND (m.kind <> 'K' OR m.initial = left(r.role, 1))) WHERE best = 1),
ends(st, letters, cost, lines_) AS (VALUES (0, '', 0, ''), (1, 'II', 4, 'user:|assistant:|'), (2, 'I', 2, 'assistant:|'), (3, '', 0, '')),
counted AS (
  SELECT conv_id, count(*) AS n, count(DISTINCT turn) AS turns, max(turn) - min(turn) + 1 AS span,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id),
done AS (
  SELECT p.conv_id, p.cost + e.cost AS cost, p.audit || e.letters AS audit, p.body || replace(e.lines_, '|', chr(10)) AS body,
    row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + e.cost, p.audit || e.letters) AS best
  FROM step p JOIN ends e USING (st) LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM p.conv_id WHERE p.i = coalesce(c.n, 0))
SELECT d.conv_id, CASE WHEN c.turns > 0 THEN c.span - c.turns ELSE 0 END::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank,
  coalesce(c.duplicate, 0)::BIGINT AS duplicate, coalesce(c.truncated, 0)::BIGINT AS truncated,
  coalesce(c.illegal, 0)::BIGINT AS illegal, d.cost::BIGINT AS cost, d.audit, sha256(left(d.body, greatest(length(d.body) - 1, 0)::INT)) AS repaired_sha256
FROM done d LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM d.conv_id WHERE d.best = 1
"""

OP12 = f"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos,
    sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS key,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, {_crc32("conv_id::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM own)),
built AS (
  SELECT i.conv_id, o.pos, o.key, o.words FROM ids i JOIN own o ON o.conv_id = i.conv_id - i.conv_id % 20 AND o.pos < i.h
  UNION ALL SELECT i.conv_id, o.pos, o.key, o.words FROM ids i JOIN own o ON o.conv_id = i.conv_id AND o.pos >= i.h),
prefixes AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(key, '') OVER w AS node, words FROM built
  WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
  UNION ALL SELECT conv_id, 0, '', 0 FROM ids),
lengths AS (SELECT conv_id, max(depth) AS n FROM prefixes GROUP BY conv_id),
nodes AS (
  SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words,
    string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth) AS ends
  FROM prefixes JOIN lengths USING (conv_id) GROUP BY depth, node),
kids AS (SELECT p.node, count(*) AS n FROM nodes p JOIN nodes c ON c.depth = p.depth + 1 AND left(c.node, 64 * p.depth::INT) = p.node
  GROUP BY p.node),
below AS (
  SELECT p.node, count(*) FILTER (k.n IS NULL) AS n_leaves, sum((c.n_convs - 1) * c.words) AS saved
  FROM nodes p JOIN nodes c ON c.depth >= p.depth AND left(c.node, 64 * p.depth::INT) = p.node LEFT JOIN kids k ON k.node = c.node
  GROUP BY p.node)
SELECT v.conv_id, v.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, v.n_convs::BIGINT AS n_convs,
  coalesce(k.n, 0)::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens,
  sha256(coalesce(v.ends, '')) AS ends_sha256
FROM nodes v JOIN below b USING (node) LEFT JOIN kids k USING (node)
LEFT JOIN nodes u ON v.depth > 0 AND u.node = left(v.node, 64 * (v.depth - 1)::INT)
"""
