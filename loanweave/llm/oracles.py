"""DuckDB SQL for the queries of this subpackage that SQL can express on whole tables."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = rf"""
with words as (select doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
items as (
  select distinct item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where text is not null and item_id is not null),
sized as (select item_id, w, least(len(w), 10) as size from items where len(w) > 0),
starts as (select item_id, w, size, unnest(range(1, len(w) - size + 2)) as k from sized),
windows as (select distinct item_id, size, array_to_string(w[k : k + size - 1], ' ') as win from starts),
placed as (
  select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as k
  from words, (select distinct size from windows) where len(w) >= size),
found as (
  select p.doc_id, p.k, p.size, n.item_id
  from (select doc_id, k, size, array_to_string(w[k : k + size - 1], ' ') as win from placed) p
  join windows n using (size, win)),
covered as (
  select doc_id, count(distinct place) as n_hit
  from (select doc_id, unnest(range(k, k + size)) as place from found) group by doc_id),
named as (
  select doc_id, count(*) as n_items, string_agg(name, ',' order by name) as names
  from (select distinct doc_id, cast(item_id as varchar) as name from found) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(names, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from words left join covered using (doc_id) left join named using (doc_id)
"""

NEAR_DUPLICATES = rf"""
with recursive words as (select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
shingled as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 1), lambda k: array_to_string(w[k : k + 2], ' '))) end as s
  from words),
sizes as (select doc_id, len(s) as n from shingled),
each as (select doc_id, unnest(s) as g from shingled),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c
  from each a join each b on a.g = b.g and a.doc_id < b.doc_id group by all),
links as (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * c >= 85 * (x.n + y.n - c)),
paired as (select a, b from links union all select b, a from links),
reached(doc_id, other) as (
  select doc_id, doc_id from sizes
  union
  select r.doc_id, b.b from reached r join paired b on r.other = b.a)
select doc_id, cast(n as bigint) as n_shingles, component_id, doc_id = component_id as kept
from sizes join (select doc_id, min(other) as component_id from reached group by doc_id) using (doc_id)
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

RANKED_SEARCH = rf"""
with docs as (select doc_id, regexp_extract_all({_LOWER}, '{_TERM}') as w from documents),
totals as (select count(*) filter (len(w) > 0) as big_n, sum(len(w)) as big_l from docs),
each as (
  select doc_id, len(w) as n, unnest(w) as term from docs),
held as (select doc_id, any_value(n) as n, term, count(*) as tf from each group by doc_id, term),
weights as (
  select term, cast(floor(1000 * ln(cast(2 * big_n + 2 as double) / (2 * count(*) + 1))) as bigint) as weight
  from held, totals group by term, big_n),
asked as (
  select item_id, term, count(*) as times
  from (select item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) as term from benchmark) group by item_id, term),
scored as (
  select item_id, doc_id,
    sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + cast((25 * n * big_n) // big_l as bigint))))) as score
  from asked join weights using (term) join held using (term), totals group by item_id, doc_id)
select item_id, cast(place as integer) as rank, doc_id, cast(score as bigint) as score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as place from scored where score > 0)
where place <= 20
"""

LARGEST_PRODUCTS = """
with rows as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, p.vec_id, cast(list_inner_product(q.v, p.v) as bigint) as score
  from rows q join rows p on q.vec_id <> p.vec_id where q.vec_id % 50 = 0)
select query_id, cast(place as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as place from scored)
where place <= 5
"""
