"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

from kpiloom.llm.url_filter import LOWER, RULES, SOFT, SOFT_LIMIT, STRICT, UPPER


def _url_filter() -> str:
    """Rules as one CASE from the longest; a term counts where it is a whole run of letters and digits."""
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN " for h, p, _ in RULES]
    order = sorted(range(len(RULES)), key=lambda i: -len(RULES[i][0] + RULES[i][1]))
    rule = "CASE " + " ".join(f"WHEN {fits[i]}'{RULES[i][0]}{RULES[i][1]}'" for i in order) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits[i]}'{RULES[i][2]}'" for i in order) + " END"
    listed = ", ".join(f"'{t}'" for t in STRICT)
    weights = " ".join(f"WHEN '{t}' THEN {w}" for t, w in SOFT.items())
    soft = ", ".join(f"'{t}'" for t in SOFT)
    return f"""
    WITH parts AS (
        SELECT page_id,
               translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host,
               regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
               string_split_regex(translate(coalesce(url, ''), '{UPPER}', '{LOWER}'), '[^a-z0-9]+') AS runs
        FROM pages),
    hits AS (
        SELECT page_id, host, path, {rule} AS rule, {verdict} AS by_rule,
               CAST(len([x FOR x IN runs IF x IN ({listed})]) AS BIGINT) AS n_strict,
               list_distinct([x FOR x IN runs IF x IN ({soft})]) AS mild
        FROM parts),
    weighed AS (
        SELECT *, CAST(coalesce(list_sum([CASE x {weights} END FOR x IN mild]), 0) AS BIGINT) AS soft_weight FROM hits)
    SELECT page_id, host, path, rule,
           coalesce(by_rule, CASE WHEN n_strict > 0 OR soft_weight >= {SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
           n_strict, CAST(len(mild) AS BIGINT) AS n_soft, soft_weight
    FROM weighed"""


def oracle_sql() -> dict[str, str]:
    return {"op5_url_filter": _url_filter()}
