"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_SPACES = r"[\x20\x09-\x0D]+"
_WORDS = r"[^\x20\x09-\x0D]+"

OP1 = rf"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') as ws
  from documents
), s as (
  select distinct doc_id, unnest(case when len(ws) >= 5 then [ws[i : i + 4] for i in range(1, len(ws) - 3)]
                                      when len(ws) > 0 then [ws] else [] end) as g
  from w
), n as (select doc_id, count(*) as n from s group by doc_id),
links as (
  select a.doc_id as a, b.doc_id as b
  from s a join s b on a.g = b.g and a.doc_id < b.doc_id
  join n na on na.doc_id = a.doc_id join n nb on nb.doc_id = b.doc_id
  group by a.doc_id, b.doc_id
  having 100 * count(*) >= 80 * (any_value(na.n) + any_value(nb.n) - count(*))
), e as (select a, b from links union all select b, a from links),
reach(x, y) as (select doc_id, doc_id from documents union select r.x, e.b from reach r join e on e.a = r.y)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, r.component_id
from documents d left join n on n.doc_id = d.doc_id
join (select x, min(y) as component_id from reach group by x) r on r.x = d.doc_id
"""

# The same permutation (digest of seed and id), prefix rule and order of large before small documents.
OP2 = rf"""
with d as (
  select doc_id, coalesce('s' || source, 'n') as k, source is null as last,
         len(regexp_extract_all(coalesce(text, ''), '{_WORDS}'))::bigint as size,
         ('0x' || substr(md5('mix-1|' || doc_id), 1, 15))::bigint as place
  from documents
), s as (
  select k, last, sum(size)::bigint as words, count(*) as docs from d group by k, last
), r as (
  select k, words, docs, [5, 2, 1][1 + (row_number() over (order by last, k) - 1) % 3]::bigint as w,
         3 * words as cap, (sum(words) over ())::bigint as total
  from s
), l as (
  select *, row_number() over (order by cap / w, k) as rank,
         total - coalesce((sum(cap) over (order by cap / w, k rows between unbounded preceding and 1 preceding))::bigint, 0) as rest,
         (sum(w) over (order by cap / w, k rows between current row and unbounded following))::bigint as share
  from r
), f as (
  select rank as frank, rest as frest, share as fshare from l
  where cap::double * share > w::double * rest order by rank limit 1
), t as (
  select l.k, words, docs, case when frank is null or rank < frank then cap::double else (w * frest)::double / fshare end as target
  from l left join f on true
), p as (
  select k, words, docs, target, least(floor(case when words > 0 then target / words else 0 end), 3)::bigint as rounds,
         case when words > 0 then target / words else 0 end - least(floor(case when words > 0 then target / words else 0 end), 3) as part
  from t
), m as (
  select d.*, p.words, p.target, p.rounds, p.part, 2 * size * docs > words as big from d join p on p.k = d.k
), c as (
  select *, sum(size) over (partition by k, big order by place) as upto,
         sum(size) over (partition by k, big, place) as peers, sum(size) over (partition by k, big) as half
  from m
), b as (
  select *, big and 2 * (upto - peers) + peers <= 2 * (part * half) as in_big from c
), g as (
  select *, part * words - sum(case when in_big then size else 0 end) over (partition by k) as open from b
)
select doc_id, size, words as source_size, target,
       (size * (rounds + case when part > 0 and (in_big or (not big and 2 * (upto - peers) + peers <= 2 * open)) then 1 else 0 end))::bigint as taken
from g
"""

OP5 = rf"""
with d as (select doc_id, regexp_replace(coalesce(text, ''), '{_SPACES}', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       doc_id = min(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from d
"""

OP4 = """
with p as (
  select page_id, octet_length(encode(coalesce(html, '')))::bigint as n, sha1(coalesce(html, '')) as d from pages
), m as (
  select *, case when n >= 1000 then max(page_id) over (partition by d, n) else page_id end as top from p
)
select page_id, n as payload_bytes, d as payload_digest, case when page_id = top then 'response' else 'revisit' end as record_type,
       case when page_id <> top then top end as refers_to
from m
"""

OP11 = rf"""
with recursive d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '{_WORDS}') as ws from documents
), m as (
  select doc_id, part,
         case when len(ws) < 100 then 1 else 0 end
         + case when 100 * len(list_distinct(ws)) < 80 * len(ws) then 2 else 0 end
         + case when 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) then 4 else 0 end
         + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end
         + case when doc_id > min(doc_id) over (partition by t) then 16 else 0 end as mask
  from d
), y as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as bad
  from labels group by doc_id
), c as (
  select part, mask, coalesce(good, 0) as good, coalesce(bad, 0) as bad, count(*) as n
  from m left join y on y.doc_id = m.doc_id group by all
), o(name, step, bit, earlier) as (  -- the beginnings of all orders, with the filters before the last
  select chr(65 + i::int), 1, 1 << i::int, 0 from range(5) r(i)
  union all
  select name || chr(65 + i::int), step + 1, 1 << i::int, earlier | bit from o, range(5) r(i)
  where step < 5 and not contains(name, chr(65 + i::int))
), s as (  -- every step of every whole order
  select w.name as filter_order, o.step, o.bit, o.earlier
  from o w join o on w.step = 5 and left(w.name, o.step) = o.name
), u as (
  select part, filter_order, step, bit,
         sum(case when mask & (earlier | bit) = 0 then n else 0 end)::bigint as kept,
         sum(case when mask & earlier = 0 and mask & bit > 0 then n else 0 end)::bigint as removed,
         sum(case when mask & earlier > 0 and mask & bit > 0 then n else 0 end)::bigint as redundant,
         sum(case when mask = bit then n else 0 end)::bigint as unique_fails,
         sum(case when mask & earlier = 0 and mask & bit > 0 then n * good else 0 end)::bigint as good_lost,
         sum(case when mask & earlier = 0 and mask & bit > 0 then n * bad else 0 end)::bigint as toxic_lost
  from c, s group by part, filter_order, step, bit
)
select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) over (partition by part, bit))::bigint as shapley
from u
"""

OP13 = rf"""
with d as (
  select doc_id, coalesce(text, '') as t, sha256('42:' || coalesce(doc_id::varchar, '')) as h,
         regexp_extract_all(coalesce(text, ''), '{_SPACES[:-1]}*{_WORDS}|{_SPACES}') as u
  from documents
), c as (
  select *, len(u)::bigint as n,
         ('0x' || substr(h, 1, 8))::bigint % (len(u) + 1) as x, ('0x' || substr(h, 9, 8))::bigint % (len(u) + 1) as y,
         case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>')
                   or ('0x' || substr(h, 17, 8))::bigint % 100 >= 50 then 'plain'
              when ('0x' || substr(h, 25, 8))::bigint % 100 < 80 then 'spm' else 'psm' end as form
  from d
), p as (
  select *, array_to_string(u[1 : least(x, y)], '') as a, array_to_string(u[least(x, y) + 1 : greatest(x, y)], '') as b,
         array_to_string(u[greatest(x, y) + 1 : n], '') as c
  from c
)
select doc_id, n, form,
       case when form <> 'plain' then length(a) end as prefix_chars, case when form <> 'plain' then length(b) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || a || '<S>' || c || '<M>' || b
                   else '<S>' || c || '<P>' || a || '<M>' || b end) as output_sha256,
       sha256(t) as restored_sha256
from p
"""

ORACLES = {
    "op1_ngram_join": OP1,
    "op2_mixing": OP2,
    "op4_warc": OP4,
    "op5_exact_dedup": OP5,
    "op11_filter_audit": OP11,
    "op13_fim": OP13,
}
