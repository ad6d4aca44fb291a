"""SQL of the text queries that SQL can express, for checking their results on the same tables."""

from __future__ import annotations

import string

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
_GRAM = "array_to_string(w[p:p + m - 1], ' ')"

NEAR_DUPLICATES = rf"""
with recursive docs as (
  select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
shingles as (
  select distinct doc_id, array_to_string(w[p:p + 4], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as p from docs where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
links as (
  select a.doc_id as a, b.doc_id as b
  from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id
       join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, x.n, y.n
  having 100 * count(*) >= 75 * (x.n + y.n - count(*))),
reach(a, b) as (
  select a, b from links
  union select r.a, l.b from reach r join links l on l.a = r.b),
least_of as (select a, min(b) as b from reach group by a)
select d.doc_id, coalesce(s.n, 0) as n_shingles,
       least(d.doc_id, coalesce(l.b, d.doc_id)) as component_id,
       d.doc_id <= coalesce(l.b, d.doc_id) as kept
from docs d left join sizes s on s.doc_id = d.doc_id left join least_of l on l.a = d.doc_id
"""

_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w"

CONTAMINATION = f"""
with docs as (select row_number() over () as r, doc_id, {_WORDS} from documents),
items as (select cast(item_id as varchar) as item, {_WORDS} from benchmark),
windows as (
  select item, m, {_GRAM} as g
  from (select item, w, m, unnest(range(1, len(w) - m + 2)) as p
        from (select *, least(len(w), 10) as m from items where len(w) > 0))),
places as (
  select r, m, p, {_GRAM} as g
  from (select r, w, m, unnest(range(1, len(w) - m + 2)) as p
        from docs, (select distinct m from windows) where len(w) >= m)),
hits as (select distinct r, p, m, g from places where (m, g) in (select (m, g) from windows)),
words as (select r, count(distinct q) as n from (select r, unnest(range(p, p + m)) as q from hits) group by r),
found as (
  select r, count(*) as n, string_agg(item, ',' order by item) as items
  from (select distinct h.r, v.item from hits h join windows v on v.m = h.m and v.g = h.g) group by r)
select d.doc_id, len(d.w) as n_words, coalesce(x.n, 0) as n_hit, coalesce(f.n, 0) as n_items,
       sha256(coalesce(f.items, '')) as items_sha256, x.n is not null as contaminated
from docs d left join words x on x.r = d.r left join found f on f.r = d.r
"""


def _base32(digest: str) -> str:
    """Upper-case base32 of a hex text of 40 digits: eight times 20 bits, each four letters."""
    letters = string.ascii_uppercase + "234567"
    parts = [
        f"substr('{letters}', cast((cast('0x' || substr({digest}, {5 * k + 1}, 5) as bigint) >> {shift}) & 31 as int) + 1, 1)"
        for k in range(8)
        for shift in (15, 10, 5, 0)
    ]
    return " || ".join(parts)


WARC = f"""
with payloads as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h,
         min(page_id) over (partition by coalesce(html, '')) as first_id from pages)
select page_id, cast(strlen(html) as bigint) as payload_bytes, {_base32("h")} as payload_digest,
       case when first_id = page_id then 'response' else 'revisit' end as record_type,
       case when first_id <> page_id then first_id end as refers_to
from payloads
"""


def _field(value: str) -> str:
    text = f"cast({value} as varchar)"
    return f"coalesce(cast(strlen({text}) as varchar) || ':' || {text}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, levels: int) -> str:
    """Tables of a tree over ``<name>0(g, i, c, d)``: its levels, and every node's siblings left and right."""
    parts = []
    for k in range(levels):
        run = "over (partition by g, i // 16 order by i rows between"
        parts.append(f"""
{name}_near{k} as (
  select g, i, c > 1 as several, coalesce(string_agg(d, '') {run} unbounded preceding and 1 preceding), '') as l,
         coalesce(string_agg(d, '') {run} 1 following and unbounded following), '') as r from {name}{k}),
{name}{k + 1} as (
  select g, i // 16 as i, (any_value(c) + 15) // 16 as c,
         case when any_value(c) > 1 then sha256(string_agg(d, '' order by i)) else any_value(d) end as d
  from {name}{k} group by g, i // 16)""")
    return ",".join(parts)


def _climbed(rows: str, name: str, levels: int, tree: str, number: str) -> tuple[str, str]:
    """Tables that carry ``own`` and ``proof`` of ``rows`` up a tree, and the name of the last one."""
    parts = []
    for k in range(levels):
        parts.append(f"""
{rows}_{name}{k} as (
  select a.* replace (case when n.several then sha256(n.l || own || n.r) else own end as own, proof || n.l || n.r as proof)
  from {rows if k == 0 else f"{rows}_{name}{k - 1}"} a
       join {name}_near{k} n on n.g = {tree} and n.i = {number} // {16**k})""")
    return ",".join(parts), f"{rows}_{name}{levels - 1}"


def _merkle(levels: int = 6, top_levels: int = 4) -> str:
    """For sources of at most 16^levels documents, and 16^top_levels sources."""
    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    digits = "list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c))"
    shift = "case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end"  # the CRC-32 polynomial, reversed
    in_source, climbed = _climbed("docs", "node", levels, "a.g", "a.i")
    to_root, done = _climbed(climbed, "top", top_levels, "0", "a.g")
    return f"""
with bytes_(t) as (
  select list(c order by k) from (
    select k, list_reduce([cast(k as bigint)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: {shift}) as c from range(256) b(k))),
read_ as (
  select doc_id, source, {_leaf("text")} as leaf, {_leaf(lower)} as lowered,
         xor(list_reduce([cast(4294967295 as bigint)] || {digits},
             lambda a, b: xor(a // 256, t[cast(xor(a % 256, b) as int) + 1])), 4294967295) % 5 = 0 as chosen
  from documents, bytes_),
docs as (
  select doc_id, leaf, case when chosen then lowered else leaf end as own, '' as proof,
         dense_rank() over (order by source nulls first) - 1 as g,
         row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as i,
         count(*) over (partition by source) as c from read_),
node0 as (select g, i, c, leaf as d from docs),{_tree("node", levels)},
top0 as (select 0 as g, g as i, count(*) over () as c, d from node{levels}),{_tree("top", top_levels)},
{in_source.lstrip()},{to_root}
select a.doc_id, a.leaf, s.d as subroot, r.d as root, sha256(a.proof) as proof_sha256, a.own as folded_root,
       a.own = r.d as verified
from {done} a join node{levels} s on s.g = a.g, top{top_levels} r
"""


def _codes(rounds: int = 2, parts: int = 16, entries: int = 64) -> str:
    """Parts as lists; every round's assignments and codebooks in full."""
    apart = "list_sum(list_transform(list_zip(p.v, e.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
near{k} as (
  select r, part, min(row(far, entry)) as best
  from (select p.r, p.part, e.entry, cast({apart} as bigint) as far from parts p join book{k} e on e.part = p.part)
  group by r, part)""")
        if k < rounds:
            steps.append(f"""
means{k} as (
  select part, entry, list(cast(floor(total / n) as bigint) order by j) as v
  from (select n.part, n.best[2] as entry, u.j, sum(p.v[u.j]) as total, count(*) as n
        from near{k} n join parts p on p.r = n.r and p.part = n.part, (select unnest(range(1, width + 1)) as j from shape) u
        group by all)
  group by part, entry),
book{k + 1} as (
  select b.part, b.entry, coalesce(m.v, b.v) as v from book{k} b left join means{k} m on m.part = b.part and m.entry = b.entry)""")
    return f"""
with whole as (
  select vec_id, label, list_transform(embedding, lambda x: cast(floor(cast(x as double) * 256) as bigint)) as v
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
rows_ as (select *, row_number() over (order by vec_id nulls last, v) as r from whole),
shape as (select len(v) // {parts} as width from rows_ where r = 1),
parts as (
  select r, part, v[part * width + 1:(part + 1) * width] as v
  from rows_, shape, (select unnest(range({parts})) as part) where len(v) = {parts} * width),
book0 as (select part, r - 1 as entry, v from parts where r <= {entries}),{",".join(steps)},
coded as (
  select r, string_agg(lpad(lower(to_hex(best[2])), 2, '0'), '' order by part) as code, cast(sum(best[1]) as bigint) as error
  from near{rounds} group by r),
digest as (
  select sha256(string_agg(array_to_string(v, ','), ',' order by part, entry)) as codebooks_sha256 from book{rounds})
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from rows_ join coded using (r), digest
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op5_minhash_near_dedup": NEAR_DUPLICATES,
        "op6_benchmark_decontamination": CONTAMINATION,
        "op7_warc": WARC,
        "op12_vector_code_compression": _codes(),
        "op13_merkle_manifest": _merkle(),
    }
