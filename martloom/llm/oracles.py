"""SQL (DuckDB) of the queries that SQL can express.

The others rest on trained models, XXH64, BPE or voting; their tests compare them
with plain versions instead.
"""

from __future__ import annotations

import string

_NORMAL = rf"""regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
_PLAIN = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_DECONTAMINATION = f"""
with item_words as (select item_id, {_NORMAL} as words from benchmark),
grams as (
  select distinct item_id, least(13, len(words)) as size, array_to_string(words[i : i + 12], ' ') as gram
  from (select item_id, words, unnest(range(1, greatest(1, len(words) - 12) + 1)) as i from item_words where len(words) > 0) x),
doc_words as (select doc_id, {_NORMAL} as words from documents),
places as (
  select doc_id, words, size, unnest(range(1, len(words) - size + 2)) as i
  from doc_words cross join (select distinct size from grams) sizes where len(words) >= size),
hits as (
  select doc_id, i, p.size, item_id from places p
  join grams g on g.size = p.size and g.gram = array_to_string(words[i : i + p.size - 1], ' ')),
hit_words as (select doc_id, count(distinct place) as n_hit
  from (select doc_id, unnest(range(i, i + size)) as place from hits) h group by doc_id),
hit_items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from hits) h group by doc_id)
select d.doc_id, cast(len(words) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words) as contaminated
from doc_words d left join hit_words using (doc_id) left join hit_items using (doc_id)"""


def _without_repeats(window: int) -> str:
    return f"""
with doc_words as (select doc_id, {_PLAIN} as words from documents),
tokens as (select doc_id, unnest(words) as word, unnest(range(1, len(words) + 1)) as place from doc_words),
grams as (
  select doc_id, place, string_agg(word, ' ') over ahead as gram, count(*) over ahead as n from tokens
  window ahead as (partition by doc_id order by place rows between current row and {window - 1} following)),
ordered as (
  select doc_id, place, row_number() over (partition by gram order by doc_id, place) as rn from grams where n = {window}),
gone as (select distinct doc_id, unnest(range(place, place + {window})) as place from ordered where rn > 1),
kept as (
  select doc_id, count(*) as n, string_agg(word, ' ' order by place) as text
  from tokens anti join gone using (doc_id, place) group by doc_id)
select d.doc_id, cast(len(words) as bigint) as n_words, len(words) - coalesce(n, 0) as n_removed,
  sha256(coalesce(text, '')) as kept_sha256
from doc_words d left join kept using (doc_id)"""


def _clusters(k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, seed: int = 3) -> str:
    steps = [f"""
with kept as materialized (
  select row_number() over () as row_no, vec_id, list_transform(embedding, lambda x: cast(floor({scale} * cast(x as double)) as bigint)) as v
  from embeddings
  where len(embedding) = {size} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {size}),
c0 as materialized (
  select row_number() over (order by sha256('{seed}:' || vec_id) nulls last, v) - 1 as c, v from kept
  qualify c < {k})"""]
    for n in range(rounds + 1):
        steps.append(f"""
a{n} as materialized (
  select row_no, vec_id, k.v, c, list_sum(list_transform(list_zip(k.v, x.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as d
  from kept k cross join c{n} x qualify row_number() over (partition by row_no order by d, c) = 1)""")
        if n < rounds:
            steps.append(f"""
m{n} as (
  select c, i, sum(x) as s, count(*) as n from (select c, unnest(v) as x, unnest(range(1, {size + 1})) as i from a{n}) u group by c, i),
c{n + 1} as materialized (
  select c, coalesce(m.v, c{n}.v) as v
  from c{n} left join (select c, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as v from m{n} group by c) m using (c))""")
    return ",".join(steps) + f"""
select vec_id, cast(c as integer) as cluster, cast(d as bigint) as distance,
  cast(sum(d) over (partition by c) as bigint) as cluster_inertia, cast(sum(d) over () as bigint) as inertia,
  sha256(array_to_string(c{rounds}.v, ',')) as centroid_sha256
from a{rounds} join c{rounds} using (c)"""


def _top_products(k: int = 5, scale: int = 256, every: int = 50) -> str:
    return f"""
with whole as materialized (
  select distinct vec_id, list_transform(embedding, lambda x: cast(floor({scale} * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, q.v as asked, c.v,
    cast(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) as bigint) as score
  from whole q join whole c on c.vec_id is distinct from q.vec_id where q.vec_id % {every} = 0)
select query_id, cast(row_number() over ranking as integer) as rank, vec_id, score
from scored
window ranking as (partition by query_id, asked order by score desc, vec_id nulls last, v)
qualify row_number() over ranking <= {k}"""


_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(regexp_extract_all(cast(conv_id as varchar), '.'), lambda x: cast(ascii(x) as bigint))),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [cast(0 as bigint) for i in range(8)]),
      lambda x, _: xor(x >> 1, 3988292384 * (x & 1)))))"""

_TRIE = f"""
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first,
      md5(concat(len(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) - 1 as pos
  from conversations where conv_id is not null),
ids as (
  select conv_id, conv_id - conv_id % 100 as base, {_CRC32} % 6 as h from (select distinct conv_id from turns) x),
rebuilt as (
  select ids.conv_id, pos, role, text from ids join turns on turns.conv_id = base where pos < h
  union all
  select ids.conv_id, pos, role, text from ids join turns using (conv_id) where pos >= h),
steps as materialized (
  select conv_id, row_number() over (partition by conv_id order by pos) as depth, role, text from rebuilt),
paths as materialized (
  select conv_id, depth, text,
    string_agg(sha256(concat(len(role), ':', role, text)), '' order by depth) over (partition by conv_id order by depth) as path
  from steps
  union all
  select conv_id, 0, '', '' from ids),
nodes as materialized (
  select path, depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(len(text)) as size from paths group by path, depth),
family as materialized (
  select n.path, n.depth, n.conv_id, n.n_convs, (n.n_convs - 1) * n.size as own, p.conv_id as parent_conv_id, p.path as above
  from nodes n left join nodes p on p.depth = n.depth - 1 and n.path[1 : 64 * (n.depth - 1)] = p.path),
below as (select above as path, count(*) as n_children from family where depth > 0 group by above),
lasts as (select conv_id, max(depth) as depth from paths group by conv_id),
ends as (
  select path, string_agg(cast(conv_id as varchar), ',' order by conv_id) as ids from paths join lasts using (conv_id, depth) group by path),
subtree as (
  select v.path, count(*) filter (n_children is null) as n_leaves, sum(u.own) as saved
  from family v join family u on starts_with(u.path, v.path) left join below on below.path = u.path group by v.path)
select conv_id, depth, parent_conv_id, n_convs, coalesce(n_children, 0) as n_children, n_leaves,
  cast(saved as bigint) as saved_tokens, sha256(coalesce(ids, '')) as ends_sha256
from family join subtree using (path) left join below using (path) left join ends using (path)"""

ORACLES: dict[str, str] = {
    "op11_centroid_clustering": _clusters(),
    "op12_exact_top_k": _top_products(),
    "op13_conversation_prefix_trie": _TRIE,
    "op1_benchmark_decontamination": _DECONTAMINATION,
    "op2_substring_dedup": _without_repeats(20),
    "op4_suffix_array_dedup": _without_repeats(50),
}
