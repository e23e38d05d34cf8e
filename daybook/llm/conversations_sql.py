"""Damage and repair of conversations as one SQL statement."""

from __future__ import annotations

from daybook.llm.conversations import ENDS, STATES, edits_of


def _ways() -> str:
    rows = [
        f"('{initial}', '{fault}', {before}, {after}, {cost}, '{edits}')"
        for initial in ("s", "u", "a", "-")
        for fault in ("", "truncated", "blank")
        for after in STATES
        for before, cost, edits in edits_of(initial, fault)[after]
    ]
    return ", ".join(rows)


# CRC-32 (reflected, polynomial 0xEDB88320) over the bytes of an ASCII key.
_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda c: ord(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
                                  lambda x, i: xor(x // 2, 3988292384 * (x % 2)))))"""

REPAIR_SQL = f"""
WITH RECURSIVE kinds AS MATERIALIZED (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC} % 20 AS kind
    FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations)
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM (SELECT *, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) FROM kinds WHERE kind <> 0)
), placed AS MATERIALIZED (
    SELECT *, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role || ':' || text) AS i
    FROM damaged
), judged AS MATERIALIZED (
    SELECT *, left(role, 1) AS initial, CASE
        WHEN ending = '' THEN 'blank'
        WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
        WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) AS before
    FROM (SELECT *, regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS ending FROM placed)
), ways(initial, fault, s, t, more, edits) AS MATERIALIZED (VALUES {_ways()}
), best AS (
    SELECT c, 0 AS i, 0 AS s, {{'cost': 0, 'audit': ''}} AS way FROM (SELECT DISTINCT c FROM judged)
    UNION ALL
    SELECT b.c, j.i, w.t, min({{'cost': b.way.cost + w.more, 'audit': b.way.audit || w.edits}})
    FROM best b JOIN judged j ON j.c = b.c AND j.i = b.i + 1
    JOIN ways w ON w.s = b.s AND w.initial = CASE WHEN j.initial IN ('s', 'u', 'a') THEN j.initial ELSE '-' END
     AND w.fault = CASE WHEN j.fault = 'duplicate' THEN 'blank' ELSE j.fault END
    GROUP BY b.c, j.i, w.t
), won AS MATERIALIZED (
    SELECT c, min({{'cost': way.cost + 3 * length(e.edits), 'audit': way.audit || e.edits}}) AS way
    FROM best JOIN (SELECT c, max(i) AS i FROM judged GROUP BY c) USING (c, i)
    JOIN (VALUES {", ".join(f"({s}, '{edits}')" for s, edits in ENDS)}) e(s, edits) USING (s)
    GROUP BY c
), edits AS (
    SELECT c, place, way.audit[place] AS edit, sum((way.audit[place] <> 'I')::INT) OVER (PARTITION BY c ORDER BY place) AS i
    FROM (SELECT c, way, unnest(range(1, length(way.audit) + 1)) AS place FROM won)
), written AS (
    SELECT *, row_number() OVER (PARTITION BY c ORDER BY place) AS n,
           first(edit = 'K' AND initial = 's') OVER (PARTITION BY c ORDER BY place) AS begins
    FROM (SELECT e.c, place, edit, role, initial, CASE WHEN edit = 'I' THEN '' ELSE text END AS text
          FROM edits e LEFT JOIN judged j ON j.c = e.c AND j.i = e.i AND edit <> 'I')
    WHERE edit <> 'D'
), repaired AS (
    SELECT c, string_agg(CASE WHEN edit = 'K' THEN role
                              WHEN (n - begins::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
                         chr(10) ORDER BY place) AS lines
    FROM written GROUP BY c
), counted AS (
    SELECT any_value(conv_id) AS conv_id, c, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY c
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(way.cost, 0)::BIGINT AS cost,
       coalesce(way.audit, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN won USING (c) LEFT JOIN repaired USING (c)
"""
