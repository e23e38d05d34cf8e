"""The page filter as one SQL statement, level by level."""

from __future__ import annotations

from collections.abc import Sequence

from daybook.llm.url_filter import BLOCK, THIRDS, Rule, Tree

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ENDING = "'[.][A-Za-z][A-Za-z0-9]{0,4}$'"


def _rule_of(rules: Sequence[Rule], pick) -> str:
    longest_first = sorted(rules, key=lambda r: (len(r.host) + len(r.path), len(r.host)), reverse=True)
    cases = "\n".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{pick(r)}'"
        for r in longest_first
    )
    return f"CASE {cases} END"


def _kind(seg: str) -> str:
    base = f"regexp_replace({seg}, {_ENDING}, '')"
    return f"""CASE WHEN regexp_matches({base}, '^[0-9]{{4}}-[0-9]{{2}}(-[0-9]{{2}})?$') THEN '<date>'
        WHEN regexp_matches({base}, '^[0-9]+$') THEN '<num>'
        WHEN regexp_matches({base}, '^[0-9A-Fa-f-]{{8,}}$') THEN '<hex>'
        WHEN regexp_matches({base}, '[0-9]') THEN '<mixed>' ELSE '<word>' END
        || regexp_extract({seg}, {_ENDING})"""


def filter_urls_sql(rules: Sequence[Rule], tree: Tree = Tree()) -> str:
    """For the tables `pages` with `page_id` and `url`; labels are the rules' verdicts."""
    ctes = [
        f"""p AS MATERIALIZED (
            SELECT *, {_rule_of(rules, lambda r: r.host + r.path)} AS rule,
                   {_rule_of(rules, lambda r: r.verdict)} AS ruled
            FROM (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_UPPER.lower()}') AS host,
                         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
                  FROM (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3)
                                             ELSE '' END AS rest FROM pages)))""",
        f"""t0 AS MATERIALIZED (
            SELECT host, path, is_bad, '' AS template,
                   CASE WHEN len(s) > {tree.levels} THEN list_append(s[1:{tree.levels}], '**') ELSE s END AS s
            FROM (SELECT host, path, max(ruled = '{BLOCK}') AS is_bad,
                         list_filter(string_split(path, '/'), lambda x: x <> '') AS s
                  FROM p GROUP BY host, path))""",
    ]
    last = tree.levels + 1
    for d in range(last):
        ctes += [
            f"""k{d} AS MATERIALIZED (SELECT host, template, s[{d + 1}] AS seg, count(*) AS n
                FROM t{d} WHERE len(s) > {d} GROUP BY ALL)""",
            f"""f{d} AS MATERIALIZED (SELECT host, template, seg
                FROM k{d} JOIN (SELECT host, template, sum(n) AS every FROM k{d} GROUP BY ALL) USING (host, template)
                WHERE n >= {tree.least_paths} AND n >= {tree.least_share}::DOUBLE * every)""",
            f"""t{d + 1} AS MATERIALIZED (
                SELECT t.host, path, is_bad, s, CASE
                    WHEN len(s) <= {d} THEN t.template
                    WHEN f.seg IS NOT NULL OR s[{d + 1}] = '**' THEN t.template || '/' || s[{d + 1}]
                    ELSE t.template || '/' || {_kind(f"s[{d + 1}]")} END AS template
                FROM t{d} t LEFT JOIN f{d} f
                  ON t.host = f.host AND t.template = f.template AND s[{d + 1}] = f.seg)""",
        ]
    ctes.append(
        f"""b{last + 1} AS MATERIALIZED (
            SELECT host, template, template AS branch, count(is_bad) AS l, count(*) FILTER (is_bad) AS b
            FROM t{last} GROUP BY host, template)"""
    )
    thirds = "[" + ", ".join(f"'{t}'" for t in THIRDS) + "]"
    for at in range(last, 0, -1):
        ctes += [
            f"""w{at} AS MATERIALIZED (
                SELECT *, array_to_string(parts[1:{at}], '/') AS before, array_to_string(parts[{at + 2}:], '/') AS after,
                       least(2, floor(own_bad * 3 / own))::INT AS third
                FROM (SELECT host, branch, sum(l) AS own, sum(b) AS own_bad, string_split(branch, '/') AS parts
                      FROM b{at + 1} GROUP BY host, branch)
                WHERE len(parts) > {at} AND own >= {tree.least_labels})""",
            f"""q{at} AS MATERIALIZED (
                SELECT host, before, after, len(parts) AS depth, third, count(*) AS branches,
                       (sum(own_bad) + 0.5::DOUBLE) / (sum(own) + 1.0::DOUBLE) AS rate
                FROM w{at} GROUP BY ALL)""",
            f"""b{at} AS MATERIALIZED (
                SELECT o.host, o.template, coalesce(m.merged, o.branch) AS branch, l, b
                FROM b{at + 1} o LEFT JOIN (
                    SELECT w.host, branch, concat_ws('/', w.before, {thirds}[w.third + 1],
                           CASE WHEN len(parts) > {at + 1} THEN w.after END) AS merged
                    FROM w{at} w JOIN q{at} q ON w.host = q.host AND w.before = q.before AND w.after = q.after
                         AND len(parts) = depth AND w.third = q.third
                    WHERE branches > 1
                      AND abs(own_bad / own - rate) <= {tree.z}::DOUBLE * sqrt(rate * (1.0::DOUBLE - rate) / own)
                ) m ON o.host = m.host AND o.branch = m.branch)""",
        ]
    return f"""
        WITH {", ".join(ctes)},
        overall AS (SELECT (sum(b) + 0.5::DOUBLE) / (sum(l) + 1.0::DOUBLE) AS g FROM b1),
        prior AS (
            SELECT template, (sum(b) + g * {tree.all_weight}::DOUBLE) / (sum(l) + {tree.all_weight}::DOUBLE) AS prior
            FROM b1, overall GROUP BY template, g),
        own AS (SELECT host, branch, sum(l) AS l, sum(b) AS b FROM b1 GROUP BY host, branch),
        judged AS (
            SELECT b1.host, template, branch,
                   (own.b + prior * {tree.own_weight}::DOUBLE) / (own.l + {tree.own_weight}::DOUBLE) AS purity
            FROM b1 JOIN prior USING (template) JOIN own USING (host, branch))
        SELECT page_id, p.host, p.path, rule,
               coalesce(ruled, CASE WHEN purity >= {tree.reject_at} THEN '{BLOCK}' ELSE 'allow' END) AS verdict,
               template, branch
        FROM p JOIN t{last} USING (host, path) JOIN judged USING (host, template)
    """
