"""The same results in plain SQL, where SQL can express them."""

ORACLES = {
    "op3_mix": r"""
with d as (
    select doc_id, source,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size,
        case max(l.quality) over (partition by doc_id) when 1 then 2.0 when 0 then 0.5 else 1.0 end as w
    from documents left join labels l using (doc_id)
), k as (
    select *, -ln((('0x' || substr(md5('mix:' || doc_id::varchar), 1, 13))::bigint + 0.5)
        / 4503599627370496.0) / w as draw
    from d
), s as (
    select source, sum(size)::bigint as source_size,
        case (row_number() over (order by source nulls last) - 1) % 3
            when 0 then 5.0 when 1 then 2.0 else 1.0 end as weight
    from d group by source
), o as (
    select *, 1.5 * sum(source_size) over () as total,
        coalesce(sum(2.0 * source_size) over (order by 2.0 * source_size / weight, source
            rows between unbounded preceding and 1 preceding), 0.0) as held,
        sum(weight) over (order by 2.0 * source_size / weight, source
            rows between current row and unbounded following) as sharing
    from s
), v as (
    select (total - held) / sharing as level
    from o where (total - held) / sharing <= 2.0 * source_size / weight
    order by 2.0 * source_size / weight, source limit 1
), t as (
    select source, source_size,
        case when source_size = 0 then 0.0
            else least(2.0 * source_size, weight * level) end as target
    from s, v
), e as (
    select *, case when source_size = 0 then 0 else floor(target / source_size) end::int as epochs
    from t
), p as (
    select k.*, source_size, target, epochs, target - epochs * source_size as rest,
        sum(size) over (partition by k.source order by draw, doc_id
            rows between unbounded preceding and current row) as upto
    from k join e on k.source is not distinct from e.source
), c as (
    select *, epochs + (rest > 0 and 2 * upto - size <= 2 * rest)::int as repeats from p
)
select doc_id, size::bigint as size, source_size, target::double as target, repeats::int as repeats,
    (repeats * size)::bigint as taken
from c
""",
    "op8_exact_dedup": r"""
with d as (
    select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
    from documents
), g as (
    select text_sha256, min(doc_id) as keep_id, count(*)::bigint as group_size from d group by 1
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from d join g using (text_sha256)
""",
}
