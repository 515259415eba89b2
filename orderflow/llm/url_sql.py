"""DuckDB SQL of the URL filter, level by level like the DataFrames."""

from __future__ import annotations

from orderflow.llm.urls import VARIABLE, Rule

_CAPITALS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _rule_case(rules: list[Rule]) -> str:
    cases = [f"when (host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}') then '{r.text}'"
             for r in sorted(rules, key=lambda r: (len(r.text), r.text), reverse=True)]
    return f"case {' '.join(cases)} end"


def _level(k: int, max_children: int, rare: float) -> str:
    return f"""
    seen{k} as (select *, case when len(segments) > {k} then segments[{k + 1}] else '/' end as segment from grown{k}),
    child{k} as (select host, prefix, segment, sum(n) as n from seen{k} group by all),
    branch{k} as (select host, prefix, count(*) as k, sum(n) as total from child{k} group by all),
    token{k} as (select c.host, c.prefix, c.segment, case when segment <> '/' and k > {max_children}
        and n < cast({rare} as double) * total then '*' else segment end as token from child{k} c join branch{k} using (host, prefix)),
    grown{k + 1} as (select s.* exclude (prefix, segment), case when token = '/' then prefix else prefix || '/' || token end as prefix
        from seen{k} s join token{k} using (host, prefix, segment)),"""


def _merge(k: int, z: float) -> str:
    return f"""
    named{k} as (select host, template, sum(bad) as bad, sum(labelled) as labelled, string_split(template, '/') as parts
        from leaves{k + 1} group by host, template),
    sibling{k} as (select *, array_to_string(list_transform(parts, lambda p, i: case when i = {k + 1} then '{{*}}' else p end), '/') as sibling
        from named{k} where len(parts) > {k}),
    pooled{k} as (select host, sibling, sum(bad) as all_bad, sum(labelled) as all_labelled, count(*) as k
        from sibling{k} group by all having count(*) > 1),
    apart{k} as (select host, template, sibling, abs(cast(bad as double) / nullif(labelled, 0)
            - cast(all_bad - bad as double) / nullif(all_labelled - labelled, 0))
        > cast({z} as double) * sqrt((cast(all_bad as double) / nullif(all_labelled, 0)) * (1 - cast(all_bad as double) / nullif(all_labelled, 0))
            * (1e0 / nullif(labelled, 0) + 1e0 / nullif(all_labelled - labelled, 0))) as apart
        from sibling{k} join pooled{k} using (host, sibling)),
    leaves{k} as (select l.host, l.leaf, l.bad, l.labelled, coalesce(m.sibling, l.template) as template
        from leaves{k + 1} l left join (select * from apart{k} where not coalesce(apart, false)) m using (host, template)),"""


def judged_sql(rules: list[Rule], depth: int = 3, max_children: int = 32, rare: float = 0.02, z: float = 1.96,
               prior: float = 20.0, limit: float = 0.5) -> str:
    blocked = ", ".join(f"'{r.text}'" for r in rules if r.verdict == "block")
    return f"""with cut as (
        select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as after from pages),
    split as (select page_id, translate(regexp_extract(after, '^([^/?#]*)', 1), {_CAPITALS}) as host,
        regexp_extract(after, '^[^/?#]*([^?#]*)', 1) as path from cut),
    ruled as (select *, {_rule_case(rules)} as rule, array_to_string(list_transform(string_split(regexp_replace(path, '^/', ''), '/'),
        lambda s: regexp_replace(s, '{VARIABLE}', '*\\1')), '/') as shape from split),
    known as (select doc_id as page_id, max(case when quality = 0 or toxic = 1 then 1 else 0 end) as label
        from labels where doc_id is not null group by doc_id),
    marked as (select r.*, case when rule in ({blocked}) then 1 when rule is not null then 0 end as by_rule, label
        from ruled r left join known using (page_id)),
    grown0 as (select host, shape, count(*) as n, coalesce(sum(coalesce(by_rule, label)), 0) as bad,
        count(coalesce(by_rule, label)) as labelled, string_split(shape, '/') as segments, '' as prefix from marked group by host, shape),
    overall as (select coalesce(cast(sum(bad) as double) / nullif(sum(labelled), 0), 0) as share from grown0),
    {"".join(_level(k, max_children, rare) for k in range(depth))}
    way as (select host, shape, prefix || case when len(segments) > {depth} then '/**' else '' end as leaf, bad, labelled from grown{depth}),
    leaves{depth + 1} as (select host, leaf, leaf as template, sum(bad) as bad, sum(labelled) as labelled from way group by all),
    {"".join(_merge(k, z) for k in range(depth, 0, -1))}
    purity as (select host, template, (sum(bad) + {prior}e0 * any_value(share)) / (sum(labelled) + {prior}e0) as purity
        from leaves1, overall group by host, template)
    select page_id, m.host, path, rule, case when by_rule = 1 then 'block' when by_rule = 0 then 'allow'
        when purity >= {limit} then 'block' else 'allow' end as verdict, template, purity
    from marked m join way using (host, shape) join leaves1 l using (host, leaf) join purity using (host, template)"""
