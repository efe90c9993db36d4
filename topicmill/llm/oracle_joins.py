"""DuckDB SQL for the joins of documents and vectors, by all pairs: for small tables."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

# The smallest id that each node of `links` (a, b), both ways, can reach.
_COMPONENTS = """
reach(node, mate) as (
  select a, a from links union select r.node, l.b from reach r join links l on l.a = r.mate),
groups as (select node, min(mate) as least from reach group by node)"""

OP6 = rf"""
with recursive words as (
  select doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")} as w from documents),
shingles as (
  select distinct doc_id, unnest(case when len(w) = 0 then []::varchar[] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as shingle
  from words),
sizes as (select doc_id, count(*) as size from shingles group by doc_id),
common as (
  select x.doc_id as a, y.doc_id as b, count(*) as common from shingles x join shingles y on x.shingle = y.shingle
  where x.doc_id <> y.doc_id group by x.doc_id, y.doc_id),
links as (
  select a, b from common join sizes m on m.doc_id = a join sizes n on n.doc_id = b
  where 100 * common >= 75 * (m.size + n.size - common)),
{_COMPONENTS}
select d.doc_id, coalesce(size, 0)::bigint as n_shingles, coalesce(least, d.doc_id) as component_id
from documents d left join sizes s on s.doc_id = d.doc_id left join groups g on g.node = d.doc_id
"""

OP7 = f"""
with recursive vectors as (
  select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
units as (select vec_id, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) as u from vectors),
links as (
  select x.vec_id as a, y.vec_id as b from units x join units y on x.vec_id <> y.vec_id
  where list_dot_product(x.u, y.u) >= 0.9::double),
{_COMPONENTS},
counts as (select a, count(*) as n from links group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, coalesce(least, vec_id) as component_id, coalesce(least, vec_id) = vec_id as kept
from embeddings left join counts on a = vec_id left join groups on node = vec_id
"""

OP8 = f"""
with words as (
  select doc_id, {_WORDS.format("coalesce(text, '')")} as w from documents),
starts as (select doc_id, w, unnest(range(1, len(w) - 48)) as s from words where len(w) >= 50),
windows as (select doc_id, s, sha256(array_to_string(w[s:s + 49], ' ')) as body from starts),
later as (
  select doc_id, s from windows join (select body, min(doc_id) as least from windows group by body) using (body) where doc_id > least),
gone as (select distinct doc_id, unnest(range(s, s + 50)) as p from later),
places as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from words),
left_over as (
  select p.doc_id, string_agg(word, ' ' order by p.p) as kept, count(*) as n from places p
  left join gone g on g.doc_id = p.doc_id and g.p = p.p where g.p is null group by p.doc_id)
select d.doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from words d left join left_over l on l.doc_id = d.doc_id
"""
