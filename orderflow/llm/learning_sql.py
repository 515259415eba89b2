"""DuckDB SQL of the resampling and clustering queries."""

from __future__ import annotations


def _nibbles() -> list[int]:
    """What four bits do to a CRC-32."""
    out = []
    for i in range(16):
        for _ in range(4):
            i = i >> 1 ^ 0xEDB88320 if i & 1 else i >> 1
        out.append(i)
    return out


def resampled_sql(percent: int, least_words: int, buckets: int, seed: int) -> str:
    """Weighted documents and their ranks by words of 1 to 3. The CRC takes the hexadecimal digits of each byte, the second one first."""
    return rf"""
    with sides as (
        select 0 as side, doc_id as id, row_number() over () as no, text from documents
        union all select 1, item_id, row_number() over (), text from benchmark),
    w as (select side, id, no, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from sides),
    grams as (
        select side, no, unnest(w) as f from w
        union all select side, no, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from w
        union all select side, no, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) from w),
    counted as (select side, no, f, count(*) as n from grams group by all),
    hexed as (select f, hex(encode(f)) as h from (select distinct f from counted)),
    bucketed as (
        select f, xor(list_reduce(
            list_transform(range(length(h)), lambda p: instr('123456789ABCDEF', substr(h, p + 2 - 2 * (p % 2), 1))),
            lambda c, b: xor(c >> 4, ({_nibbles()}::bigint[])[(xor(c, b) & 15) + 1]), 4294967295), 4294967295) % {buckets} as bucket
        from hexed),
    sums as (select bucket, coalesce(sum(n) filter (side = 0), 0) as s, coalesce(sum(n) filter (side = 1), 0) as t
             from counted join bucketed using (f) group by bucket),
    totals as (select sum(s)::double as all_s, sum(t)::double as all_t from sums),
    gains as (select bucket, cast(floor(1000 * ln(((t + 1::double) * (all_s + {buckets})) / ((s + 1::double) * (all_t + {buckets})))) as bigint) as gain
              from sums, totals),
    weights as (select no, cast(sum(n) as bigint) as n_features, cast(sum(n * gain) as bigint) as weight
                from counted join bucketed using (f) join gains using (bucket) where side = 0 group by no),
    scored as (
        select no, id as doc_id, coalesce(len(w), 0) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
               coalesce(weight, 0) + cast(floor(-1000 * ln(-ln(
                   (cast('0x' || substr(sha256('{seed}:' || coalesce(cast(id as varchar), '')), 1, 8) as bigint) + 0.5::double) / 4294967296::double))) as bigint) as score
        from w left join weights using (no) where side = 0),
    ranked as (select no, row_number() over (order by score desc, doc_id nulls last) as nth from scored where n_words >= {least_words})
    select doc_id, n_features, weight, score, case when nth <= {percent} * (select count(*) from ranked) // 100 then nth end as rank
    from scored left join ranked using (no)"""


def clustered_sql(k: int, rounds: int, dims: int, scale: int, seed: int) -> str:
    """Lloyd's rounds one after the other, a row per component."""
    steps = [f"""
    kept as (select row_number() over () as no, vec_id, embedding from embeddings
             where len(embedding) = {dims} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {dims}),
    x as (select no, unnest(range({dims})) as dim, cast(floor({scale} * unnest(embedding)::double) as bigint) as v from kept),
    firsts as (select no, row_number() over (order by sha256('{seed}:' || coalesce(cast(vec_id as varchar), '')), embedding) - 1 as c
               from kept qualify c < {k}),
    c0 as (select c, dim, v from firsts join x using (no))"""]
    for r in range(rounds + 1):
        steps.append(f"""
    d{r} as (select x.no, c.c, sum((x.v - c.v) * (x.v - c.v)) as distance from x join c{r} c using (dim) group by all),
    a{r} as (select * from d{r} qualify row_number() over (partition by no order by distance, c) = 1)""")
        if r < rounds:
            steps.append(f"""
    m{r} as (select c, dim, sum(v) as total, count(*) as n from a{r} join x using (no) group by all),
    c{r + 1} as (select c, dim, cast(case when n is null then v else (total - (total % n + n) % n) // n end as bigint) as v
             from c{r} left join m{r} using (c, dim))""")
    return f"""
    with {",".join(steps)},
    named as (select c, sha256(string_agg(cast(v as varchar), ',' order by dim)) as centroid_sha256 from c{rounds} group by c)
    select vec_id, cast(c as integer) as cluster, cast(distance as bigint) as distance,
           cast(sum(distance) over (partition by c) as bigint) as cluster_inertia, cast(sum(distance) over () as bigint) as inertia, centroid_sha256
    from a{rounds} join kept using (no) join named using (c)"""
