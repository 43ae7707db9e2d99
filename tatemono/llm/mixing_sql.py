"""The mix as DuckDB SQL."""

MIX = r"""
with docs as (
    select row_number() over () as rid, doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
           ('0x' || substr(md5('17:' || coalesce(doc_id::varchar, '')), 1, 15))::bigint as mix
    from documents
), src as (
    select source, sum(size)::hugeint as source_size from docs group by source
), ranked as (
    select *, (row_number() over (order by source asc nulls last) - 1) % 3 + 1 as w, 3 * source_size as cap from src
), steps as (
    select *, sum(cap) over o as caps_to, sum(w) over o as w_to,
           sum(source_size) over () as budget, sum(w) over () as w_all,
           row_number() over o as step
    from ranked
    window o as (order by cap::double / w, w, source asc nulls last rows unbounded preceding)
), judged as (
    select *, cap * (w_all - w_to + w)::hugeint < (budget - caps_to + cap)::hugeint * w as stops from steps
), level as (
    select coalesce(min(step) filter (not stops), max(step) + 1) as first_free from judged
), share as (
    select budget - coalesce(sum(cap) filter (step < first_free), 0) as rest,
           sum(w) filter (step >= first_free) as free_w
    from judged, level group by budget
), targets as (
    select source, source_size::bigint as source_size,
           case when step < first_free then cap::double else rest::double * w::double / free_w::double end as target
    from judged, level, share
), queue as (
    select rid, d.doc_id, d.source, size, mix, t.source_size, t.target,
           sum(size) over (partition by d.source order by mix, doc_id nulls first, size, rid rows unbounded preceding) as ends
    from docs d join targets t on d.source is not distinct from t.source
    where size > 0
), merged as (
    select rid, size, sum(size) over (
        order by (pass * source_size + ends)::double / target, source asc nulls last, pass, mix, doc_id nulls first, size, rid
        rows unbounded preceding) as used
    from queue, (values (0), (1), (2)) p(pass)
), taken as (
    select rid, sum(size) as taken from merged
    where used <= (select sum(size) from docs) group by rid
)
select d.doc_id, d.size, t.source_size, t.target, coalesce(k.taken, 0)::bigint as taken
from docs d join targets t on d.source is not distinct from t.source left join taken k on k.rid = d.rid
"""
