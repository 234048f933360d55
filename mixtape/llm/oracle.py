"""DuckDB SQL for the queries whose result SQL can express."""

from __future__ import annotations

from mixtape.llm.sharding import PRIME, round_keys


def _mix(x: str, key) -> str:
    a, c, d = key
    y = f"((({x}) % {PRIME} * {a} + {c}) % {PRIME})"
    return f"(({y} * {y} % {PRIME} + {d}) % {PRIME})"


def shards_sql(shards: int = 24, seed: int = 2024) -> str:
    """Row numbers by doc_id, the Feistel rounds as one CTE column each, and the
    cycle walk as a recursive CTE. crc32 is folded byte by byte over a table
    that SQL builds from the polynomial."""
    rounds, left, right = [], "l0", "r0"
    for i, key in enumerate(round_keys(seed)):
        if i % 2 == 0:
            rounds.append(f"lateral (select ({left} + {_mix(right, key)}) % a as l{i + 1}) t{i}")
            left = f"l{i + 1}"
        else:
            rounds.append(f"lateral (select ({right} + {_mix(left, key)}) % b as r{i + 1}) t{i}")
            right = f"r{i + 1}"
    network = ", ".join(rounds)
    return f"""with recursive bits as (
  select i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: case when c % 2 = 1 then xor(3988292384::bigint, c >> 1) else c >> 1 end) as v
  from (select unnest(range(256))::bigint as i)),
crc as (select list(v order by i) as tbl from bits),
numbered as (
  select doc_id, octet_length(encode(coalesce(text, ''))) + 8 as size, hex(encode(coalesce(text, ''))) as h,
         row_number() over (order by doc_id) - 1 as row_number from documents),
sized as (select count(*) as n, cast(floor(sqrt(greatest(count(*) - 1, 0))) as bigint) + 1 as a from documents),
dom as (select n, a, greatest(1, (n + a - 1) // a) as b from sized),
walk as (
  select row_number, row_number as x, 0 as step from numbered
  union all
  select row_number, {left} * b + {right}, step + 1
  from (select w.row_number, w.step, d.*, w.x // d.b as l0, w.x % d.b as r0
        from walk w, dom d where w.step = 0 or w.x >= d.n) s, {network}),
placed as (select row_number, x as place from walk, dom where step > 0 and x < n)
select m.doc_id, m.size,
       xor(4294967295::bigint, list_reduce(list_prepend(4294967295::bigint,
             list_transform(regexp_extract_all(h, '..'), lambda s: ('0x' || s)::bigint)),
           lambda c, b: xor(c >> 8, tbl[xor(c, b) % 256 + 1]))) as text_crc32,
       'rows' as law, cast(place % {shards} as int) as shard, place // {shards} as slot,
       cast(null as int) as grown_shard, m.row_number
from numbered m join placed using (row_number), crc"""


SHARDS = shards_sql()

WARC = """with digests as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
         sha1(coalesce(html, '')) as payload_digest from pages),
groups as (
  select *, max(page_id) over (partition by payload_digest) as last from digests)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and page_id < last then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id < last then last end as refers_to
from groups"""


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def near_duplicates_sql(k: int = 3, percent: int = 85) -> str:
    """All pairs of documents that share a shingle, and the closure of their links."""
    return f"""with recursive split as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                    '[^\\x20\\x09-\\x0D]+') as w from documents),
sets as (
  select doc_id, case when len(w) >= {k} then list_distinct(list_transform(range(1, len(w) - {k} + 2),
                        lambda i: array_to_string(list_slice(w, i, i + {k} - 1), ' ')))
                      when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from split),
grams as (select doc_id, len(s) as n, unnest(s) as g from sets),
common as (
  select a.doc_id as x, b.doc_id as y, any_value(a.n) as nx, any_value(b.n) as ny, count(*) as c
  from grams a join grams b on a.g = b.g and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
links as (select x, y from common where 100 * c >= {percent} * (nx + ny - c)),
sym as (select x, y from links union all select y, x from links),
reach as (
  select doc_id as node, doc_id as other from documents
  union select reach.node, sym.y from reach join sym on reach.other = sym.x),
component as (select node, min(other) as component_id from reach group by node)
select doc_id, len(s) as n_shingles, component_id, doc_id = component_id as kept,
       case when len(s) = 0 then doc_id
            else min(doc_id) over (partition by array_to_string(list_sort(s), '\n')) end as class_id
from sets join component on node = doc_id"""


NEAR_DUPLICATES = near_duplicates_sql()

#: All pairs of anchors and rows, scored as wholes.
HARD_NEGATIVES = """with v as (
  select vec_id, cast(label as bigint) as label, embedding from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda c: c is null or isnan(c) or isinf(c))) = 0),
r as (
  select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda c: floor(256 * cast(c as double))) as x from v),
s as (
  select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same,
         cast(list_dot_product(a.x, r.x) as bigint) as score
  from r a join r on a.vec_id <> r.vec_id where a.vec_id % 100 = 0),
p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
n as (
  select p.anchor_id, p.positive_id, s.vec_id as negative_id, p.positive_score, s.score as negative_score,
         cast(row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as int) as rank
  from p join s on p.anchor_id = s.anchor_id and not s.same
    and 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 10"""
