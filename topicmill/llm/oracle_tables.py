"""DuckDB SQL for the manifest and for line dedup."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _framed(value: str) -> str:
    return f"coalesce(strlen({value}::varchar)::varchar || ':' || {value}::varchar, '-')"


def _leaf(text: str = "text") -> str:
    return "sha256(" + " || ".join(_framed(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


# Bitwise checksum of the decimal id, one character after the other.
_CRC = """xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(doc_id::varchar, ''), lambda c: ord(c)::bigint)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
    lambda x, y: case when x & 1 = 1 then xor(x >> 1, 3988292384::bigint) else x >> 1 end)), 4294967295::bigint)"""


def _tree(name: str, leaves: str) -> str:
    """Nodes of all levels of the trees of `leaves` (tree, rank, n, digest), and
    per node what stands before and after it among its siblings."""
    among = "partition by level, tree, rank // 16 order by rank rows between"
    return f"""
{name}_nodes(level, tree, rank, n, digest) as (
  select 0, tree, rank, n, digest from {leaves}
  union all
  select level + 1, tree, rank // 16, (n + 15) // 16, sha256(string_agg(digest, '' order by rank))
  from {name}_nodes where n > 1 group by level, tree, rank // 16, n),
{name}_steps as (
  select level, tree, rank, coalesce(string_agg(digest, '') over ({among} unbounded preceding and 1 preceding), '') as before,
    coalesce(string_agg(digest, '') over ({among} 1 following and unbounded following), '') as after
  from {name}_nodes where n > 1)"""


OP11 = f"""
with recursive leaves as (
  select doc_id, coalesce('=' || source, '') as tree, {_leaf()} as leaf,
    case when {_CRC} % 5 = 0 then {_leaf(f"translate(text, '{_UPPER}', '{_LOWER}')")} end as claimed
  from documents),
ranked as (
  select *, leaf as digest, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as rank,
    count(*) over (partition by tree) as n from leaves),
{_tree("low", "ranked")},
subroots as (
  select '' as tree, tree as source_tree, digest, row_number() over (order by tree) - 1 as rank, count(*) over () as n
  from low_nodes where n = 1),
{_tree("top", "subroots")},
walk(doc_id, tree, leaf, level, rank, folded, siblings) as (
  select doc_id, tree, leaf, 0, rank, coalesce(claimed, leaf), '' from ranked
  union all
  select doc_id, w.tree, leaf, w.level + 1, w.rank // 16, sha256(before || folded || after), siblings || before || after
  from walk w join low_steps s on s.tree = w.tree and s.level = w.level and s.rank = w.rank),
climbed as (
  select w.*, s.digest as subroot, s.rank as top_rank from walk w join subroots s on s.source_tree = w.tree
  join (select tree, max(level) as level from low_nodes group by tree) t on t.tree = w.tree and t.level = w.level),
finish(doc_id, leaf, subroot, level, rank, folded, siblings) as (
  select doc_id, leaf, subroot, 0, top_rank, folded, siblings from climbed
  union all
  select doc_id, leaf, subroot, f.level + 1, f.rank // 16, sha256(before || folded || after), siblings || before || after
  from finish f join top_steps s on s.level = f.level and s.rank = f.rank),
root as (select digest as root, level from top_nodes where n = 1)
select doc_id, leaf, subroot, root, sha256(siblings) as proof_sha256, folded as folded_root, folded = root as verified
from finish f join root r on f.level = r.level
"""

OP12 = f"""
with lines as (
  select doc_id, unnest(lines) as line, unnest(range(len(lines))) as place
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents)),
keyed as (
  select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') as key
  from lines),
repeated as (
  select key, max(doc_id) as top from keyed where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
marked as (select k.*, coalesce(doc_id <> top, false) as goes from keyed k left join repeated r on k.key = r.key)
select doc_id, count(*)::bigint as n_lines, count(*) filter (goes)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (not goes), '')) as kept_sha256
from marked group by doc_id
"""
