"""DuckDB SQL for the rows of the training-data queries that SQL can express."""


def _went(state: str, cost: str, letter: str) -> str:
    return f"CASE WHEN ({state}) IS NOT NULL THEN {{'cost': ({state}).cost + {cost}, 'audit': ({state}).audit || '{letter}'}} END"


def _edited(none: str, s: str, u: str, a: str, open_: str) -> str:
    """The four states after one row: it is deleted, kept or given another role."""
    kept = lambda state, initial: f"CASE WHEN NOT must AND initial = '{initial}' THEN {_went(state, 'extra', 'K')} END"
    other = lambda state: f"CASE WHEN NOT must THEN {_went(state, 'extra + 1', 'R')} END"
    gone = lambda state: _went(state, "2", "D")
    return f"""{gone(none)} AS none, least({gone(s)}, {kept(none, "s")}) AS s,
      least({gone(u)}, {kept(open_, "u")}, {other(open_)}) AS u, least({gone(a)}, {kept(u, "a")}, {other(u)}) AS a"""


_NOTHING = "NULL::STRUCT(cost BIGINT, audit VARCHAR)"

#: crc32 is written out bit by bit; the fold is a recursion over the rows of all conversations side by side.
OP11 = rf"""
WITH RECURSIVE fated AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, _: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END))) % 20 AS fate
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy
  FROM fated, (VALUES (1), (2)) AS c(copy) WHERE fate <> 0 AND (copy = 1 OR fate = 3)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos FROM damaged
), marked AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' END AS fault
  FROM placed
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n
  FROM marked GROUP BY conv_id
), edits AS (
  SELECT conv_id, pos, initial, coalesce(fault IN ('blank', 'duplicate'), false) AS must, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra FROM marked
), fold AS (
  SELECT conv_id, 0::BIGINT AS pos, {{'cost': 0::BIGINT, 'audit': ''}} AS none, {_NOTHING} AS s, {_NOTHING} AS u, {_NOTHING} AS a FROM counted
  UNION ALL
  SELECT conv_id, pos, {_edited("none", "s", "u", "a", "least(none, s, a)")}
  FROM (
    SELECT f.conv_id, e.pos, must, initial, extra, none, s, least(u, {_went("least(none, s, a)", "5", "I")}) AS u, least(a, {_went("u", "5", "I")}) AS a
    FROM fold f JOIN edits e ON e.conv_id IS NOT DISTINCT FROM f.conv_id AND e.pos = f.pos + 1
  )
), best AS (
  SELECT f.conv_id, least(none, a, {_went("u", "5", "I")}) AS best FROM fold f JOIN counted c ON c.conv_id IS NOT DISTINCT FROM f.conv_id AND c.n = f.pos
), letters AS (
  SELECT conv_id, best.audit[i] AS letter, i, i - length(replace(best.audit[1:i], 'I', '')) AS put FROM best, range(1, 100000) AS r(i) WHERE i <= length(best.audit)
), said AS (
  SELECT l.conv_id, l.i, l.letter, m.role, coalesce(CASE WHEN letter <> 'I' THEN m.text END, '') AS text, coalesce(letter = 'K' AND m.initial = 's', false) AS system,
    row_number() OVER (PARTITION BY l.conv_id ORDER BY l.i) AS nth
  FROM letters l LEFT JOIN marked m ON m.conv_id IS NOT DISTINCT FROM l.conv_id AND l.letter <> 'I' AND m.pos = l.i - l.put WHERE l.letter <> 'D'
), spoken AS (
  SELECT conv_id, nth, CASE WHEN letter = 'K' THEN role WHEN (nth - max(system::INT) OVER (PARTITION BY conv_id)) % 2 = 1 THEN 'user' ELSE 'assistant' END AS role, text FROM said
), written AS (
  SELECT conv_id, string_agg(role || ':' || text, chr(10) ORDER BY nth) AS repaired FROM spoken GROUP BY conv_id
)
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN written w ON w.conv_id IS NOT DISTINCT FROM i.conv_id
"""
