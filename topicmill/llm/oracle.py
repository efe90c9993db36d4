"""DuckDB SQL for the operators that SQL can express."""

from topicmill.llm.mixing import BUCKETS, MAX_EPOCHS, SEED
from topicmill.llm.oracle_joins import OP6, OP7, OP8
from topicmill.llm.oracle_tables import OP11, OP12

SPACE_WORD = r"[^\x20\x09-\x0D]+"

OP9 = r"""
with pages_ as (
  select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as hex from pages),
digests as (
  select page_id, strlen(payload) as payload_bytes,
    translate(array_to_string(list_transform(range(32), lambda i: substr('0123456789abcdefghijklmnopqrstuv',
      1 + cast((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::bigint >> (15 - 5 * (i % 4))) & 31 as integer), 1)), ''),
      '0123456789abcdefghijklmnopqrstuv', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') as payload_digest
  from pages_),
largest as (select *, max(page_id) over (partition by payload_digest, payload_bytes) as response from digests)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
  case when page_id = response then 'response' else 'revisit' end as record_type,
  case when page_id <> response then response end as refers_to, true as valid
from largest
"""


def _bits(seed: int) -> str:
    return f"('0x' || substr(md5('{seed}#' || coalesce(doc_id::varchar, '')), 1, 8))::bigint"


OP10 = rf"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '{SPACE_WORD}')), 0)::bigint as size,
    cast(floor({_bits(SEED)} / 4294967296.0::double * {BUCKETS}) as integer) as bucket,
    {_bits(SEED + 1)} / 4294967296.0::double as jitter
  from documents),
sizes as (select source, sum(size)::hugeint as source_size from sized group by source),
ranked as (
  select *, case (row_number() over (order by source is null, source) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end::hugeint as weight
  from sizes),
ordered as (
  select *, {MAX_EPOCHS} * source_size as cap, sum(source_size) over () as total, sum(weight) over () as all_weight,
    row_number() over (order by {MAX_EPOCHS} * source_size / weight::double, source) as k
  from ranked),
levels as (
  select *, total - coalesce(sum(cap) over (order by k rows between unbounded preceding and 1 preceding), 0) as rest,
    all_weight - coalesce(sum(weight) over (order by k rows between unbounded preceding and 1 preceding), 0) as wsum
  from ordered),
level as (select rest, wsum from levels where cap * wsum >= weight * rest order by k limit 1),
plan as (
  select source, source_size, least(cap::double, weight::double * rest::double / wsum::double) as target
  from ordered, level),
ratios as (
  select *, case when source_size > 0 then floor(target / source_size::double) else 0 end as whole from plan),
lefts as (select *, greatest(target - whole * source_size::double, 0.0::double) as rest_words from ratios),
buckets as (
  select source, bucket, sum(size) as words, coalesce(sum(sum(size)) over (partition by source order by bucket
    rows between unbounded preceding and 1 preceding), 0) as before from sized group by source, bucket),
cuts as (
  select b.source, max(b.bucket) as cut_bucket,
    arg_max(least((rest_words - before::double) / words::double, 1.0::double), b.bucket) as share
  from buckets b join lefts l on b.source is not distinct from l.source
  where before < rest_words and words > 0 group by b.source)
select doc_id, size, l.source_size::bigint as source_size, l.target,
  (l.whole * size + case when cut_bucket is null or bucket > cut_bucket then 0 when bucket < cut_bucket then size
    else least(size, floor(share * size + jitter)) end)::bigint as taken, l.whole::bigint as whole
from sized d join lefts l on d.source is not distinct from l.source
left join cuts c on d.source is not distinct from c.source
"""

OP3 = r"""
with recursive own as (
  select page_id, url, html,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
ruled as (
  select *, case
    when (host = 'example.net' or host like '%.example.net') and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'org' or host like '%.org') and starts_with(path, '/fr/') then 'org/fr/'
    when (host = 'net' or host like '%.net') and starts_with(path, '/') then 'net/' end as rule
  from own),
named as (
  select *, case when rule in ('example.net/en/', 'org/fr/') then 'allow' when rule is not null then 'block' end as decided,
    case when html like '%anonical%' then nullif(regexp_extract(html,
      '(?is)<link[^>]*rel\s*=\s*["'']?canonical[^>]*href\s*=\s*["'']?([^"''\s>]+)', 1), '') end as canonical,
    case when html like '%efresh%' then nullif(regexp_extract(html,
      '(?is)<meta[^>]*http-equiv\s*=\s*["'']?refresh[^>]*content\s*=\s*["''][^"''>]*?url\s*=\s*([^"''\s>]+)', 1), '') end as target
  from ruled),
links as (
  select url, unnest([url, canonical, target]) as link, host from named),
full_links as (
  select url, case when contains(link, '://') then link when starts_with(link, '//') then 'http:' || link
    when starts_with(link, '/') then 'http://' || host || link end as link from links),
parts as (
  select url, regexp_replace(translate(regexp_extract(link, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^(www|m)\.([^.]+\.)', '') as host,
    regexp_replace(regexp_extract(link, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '/+$', '') as path,
    array_to_string(list_filter(string_split(regexp_extract(link, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'),
      lambda f: not regexp_matches(f, '^(utm_[^=&]*|ref)(=.*)?$')), '&') as query
  from full_links where link is not null),
edges as (
  select distinct 'u ' || url as a, 'p ' || host || path || case when query <> '' then '?' || query else '' end as b
  from parts where host <> ''),
both_ways as (select a, b from edges union select b, a from edges),
reach(node, mate) as (
  select a, a from both_ways union select r.node, e.b from reach r join both_ways e on e.a = r.mate),
aliases as (
  select r.node, bool_or(n.decided = 'allow') as allowed, bool_or(n.decided = 'block') as blocked
  from reach r join named n on r.mate = 'u ' || n.url group by r.node)
select page_id, host, path, rule,
  coalesce(decided, case when allowed then 'allow' when blocked then 'block' else 'allow' end) as verdict
from named left join aliases on node = 'u ' || url
"""

OP2 = r"""
with doc_words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
item_words as (
  select item_id::varchar as item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark where text is not null),
windows as (
  select distinct item_id, least(len(w), 10) as width, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') as body
  from item_words, unnest(generate_series(1, greatest(len(w) - 9, 1))) t(s) where len(w) > 0),
widths as (select distinct width from windows),
doc_windows as (
  select doc_id, width, s, array_to_string(w[s : s + width - 1], ' ') as body
  from doc_words, widths, unnest(generate_series(1, len(w) - width + 1)) t(s)),
hits as (select d.doc_id, d.width, d.s, i.item_id from doc_windows d join windows i using (width, body)),
covered as (
  select doc_id, count(distinct p) as n from hits, unnest(generate_series(s, s + width - 1)) t(p) group by doc_id),
items as (
  select doc_id, count(distinct item_id) as n, string_agg(distinct item_id, ',' order by item_id) as ids from hits group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(c.n, 0)::bigint as n_hit, coalesce(i.n, 0)::bigint as n_items,
  sha256(coalesce(i.ids, '')) as items_sha256, c.n is not null as contaminated
from doc_words left join covered c using (doc_id) left join items i using (doc_id)
"""

ORACLE = {
    "op2_decontamination": OP2,
    "op3_url_filter": OP3,
    "op6_ngram_join": OP6,
    "op7_embedding_dedup": OP7,
    "op8_substring_dedup": OP8,
    "op9_warc": OP9,
    "op10_mixing": OP10,
    "op11_merkle_manifest": OP11,
    "op12_line_dedup": OP12,
}
