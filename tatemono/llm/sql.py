"""The operators' results as DuckDB SQL, where SQL can express them."""

from tatemono.llm.mixing_sql import MIX

TOP_K = """
with vectors as materialized (
    select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as w
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as (
    select r, vec_id, unnest(w) as x, generate_subscripts(w, 1) as i from vectors
), scores as (
    select q.r as q, q.vec_id as query_id, c.vec_id, sum(q.x * c.x)::bigint as score
    from parts q join parts c on q.i = c.i and q.r <> c.r
    where q.vec_id % 100 = 0 group by q.r, q.vec_id, c.r, c.vec_id
), ranked as (
    select *, row_number() over (partition by q order by score desc, vec_id)::integer as rank from scores
)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""

WARC = """
with p as (
    select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as h from pages
), named as (
    select page_id, strlen(payload)::bigint as payload_bytes,
           list_aggregate(list_transform(range(32), lambda k:
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                      ((('0x' || substr(h, (k // 8) * 10 + 1, 10))::bigint >> (35 - 5 * (k % 8))) & 31)::integer + 1, 1)
           ), 'string_agg', '') as payload_digest,
           max(page_id) over (partition by payload) as original
    from p
)
select page_id, payload_bytes, payload_digest,
       case when page_id = original then 'response' else 'revisit' end as record_type,
       case when page_id <> original then original end as refers_to
from named
"""

URLS = r"""
with rules(verdict, rhost, rpath) as (
    values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
           ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), rest as (
    select page_id,
           case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as r
    from pages
), cut as (
    select page_id, r, regexp_extract(r, '^[^/?#]*') as h from rest
), parts as (
    select row_number() over () as n, page_id,
           translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(substr(r, length(h) + 1), '^[^?#]*') as path
    from cut
), fits as (
    select n, rhost || rpath as rule, verdict,
           row_number() over (partition by n order by length(rhost || rpath) desc, length(rhost) desc) as k
    from parts, rules
    where (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath)
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
from parts left join fits on fits.n = parts.n and k = 1
"""

CHAT = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), placed as (
    select *, row_number() over w as k, count(*) over (partition by conv_id) as n,
           -- a turn's own characters: 3 + 6 + 4 of the template, and one for each escape
           13 + length(role) + length(text)
             + len(regexp_extract_all(role, '</?s\\*>|\[/?INST\\*\]')) + len(regexp_extract_all(text, '</?s\\*>|\[/?INST\\*\]')) as size
    from turns window w as (partition by conv_id order by turn nulls first, role, text)
), summed as (
    select *, sum(size) over (partition by conv_id order by k rows unbounded preceding) as upto from placed
)
select conv_id, max(n)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by k) filter (role = 'assistant'), '')) as loss_sha256,
       sum(upto) filter (role = 'assistant' or k = n)::bigint as formatted_chars
from summed group by conv_id
"""

NEAR_DUP = r"""
with recursive words as materialized (
    select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') as w
    from documents
), shingles as materialized (
    select distinct doc_id, unnest(
        case when w is null or len(w) = 0 then []
             when len(w) < 5 then [array_to_string(w, ' ')]
             else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as s
    from words
), coded as materialized (
    select doc_id, hash(s) as s from shingles
), sizes as materialized (
    select doc_id, count(*) as n from coded group by doc_id
), shared as (
    select a.doc_id as a, b.doc_id as b, count(*) as m
    from coded a join coded b on a.s = b.s and a.doc_id < b.doc_id group by a.doc_id, b.doc_id
), links as materialized (
    select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
    where 100 * m >= 75 * (x.n + y.n - m)
), edges as materialized (
    select a, b from links union all select b, a from links
), reach(node, seen) as (
    select doc_id, doc_id from documents
    union select e.b, r.seen from reach r join edges e on e.a = r.node where e.b > r.seen
), components as (
    select node, min(seen) as component_id from reach group by node
)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, d.doc_id = component_id as kept
from documents d left join sizes using (doc_id) join components on node = d.doc_id
"""

# the same with a similarity of 80 percent, without the verdict
JACCARD = NEAR_DUP.replace("100 * m >= 75 *", "100 * m >= 80 *").replace(", d.doc_id = component_id as kept", "")

HARD_NEGATIVES = """
with v as materialized (
    select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as w
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scores as materialized (
    select a.r as a, a.vec_id as anchor_id, c.r as c, c.vec_id, a.label = c.label as same,
           coalesce(list_sum(list_transform(range(1, least(len(a.w), len(c.w)) + 1), lambda i: a.w[i] * c.w[i])), 0)::bigint as score
    from v a join v c on a.r <> c.r where a.vec_id % 100 = 0
), positives as (
    select * from scores where same qualify row_number() over (partition by a order by score desc, vec_id, c) <= 5
)
select p.anchor_id, p.vec_id as positive_id,
       row_number() over (partition by p.a, p.c order by n.score desc, n.vec_id, n.c)::integer as rank,
       n.vec_id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join scores n
  on n.a = p.a and not n.same and 80 * p.score <= 100 * n.score and 100 * n.score <= 100 * p.score
qualify rank <= 5
"""

TRIE = """
with turns as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
           row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as k
    from conversations where conv_id is not null
), own as materialized (
    select conv_id, list(struct_pack(role := role, text := text) order by k) as turns from turns group by conv_id
), asked as (
    -- CRC-32, bit by bit: a byte is mixed in, then eight shifts follow
    select conv_id, turns, xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
               string_split(conv_id::varchar, ''), lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda x, y: case when y >= 0 then xor(x, y) else xor(x >> 1, 3988292384::bigint * (x & 1)) end),
               4294967295) % 9 as h
    from own
), rebuilt as materialized (
    select a.conv_id, list_concat(coalesce(b.turns[1:h], []), a.turns[h + 1:]) as turns
    from asked a left join own b on b.conv_id = a.conv_id - a.conv_id % 5
), paths as materialized (
    select conv_id, unnest(range(0, len(turns) + 1)) as depth, len(turns) as total, turns from rebuilt
), keyed as materialized (
    select conv_id, depth, total, sha256(turns[1:depth]::json::varchar) as node,
           case when depth > 0 then sha256(turns[1:depth - 1]::json::varchar) end as parent,
           case when depth > 0 then strlen(turns[depth].text) else 0 end as bytes
    from paths
), nodes as materialized (
    select node, min(conv_id) as conv_id, max(depth) as depth, max(parent) as parent, count(*) as n_convs, max(bytes) as bytes,
           sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (depth = total), '')) as ends_sha256
    from keyed group by node
), children as materialized (
    select parent as node, count(*) as n_children from nodes where parent is not null group by parent
), below as (
    -- every node counts for all nodes on the path of one of its members
    select k.node, count(*) filter (c.n_children is null) as n_leaves, sum((n.n_convs - 1) * n.bytes) as saved_tokens
    from nodes n left join children c on c.node = n.node
    join keyed k on k.conv_id = n.conv_id and k.depth <= n.depth group by k.node
)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs::bigint as n_convs,
       coalesce(n_children, 0)::bigint as n_children, n_leaves::bigint as n_leaves,
       saved_tokens::bigint as saved_tokens, n.ends_sha256
from nodes n join below b on b.node = n.node left join children c on c.node = n.node left join nodes p on p.node = n.parent
"""

ORACLES: dict[str, str] = {
    "op2_mix_sources": MIX,
    "op3_exact_top_k": TOP_K,
    "op4_warc_round_trip": WARC,
    "op8_url_rules": URLS,
    "op9_chat_examples": CHAT,
    "op10_minhash_near_dup": NEAR_DUP,
    "op11_jaccard_join": JACCARD,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_prefix_trie": TRIE,
}
