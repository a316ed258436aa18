"""Queries of the operators as DuckDB SQL, written from what each returns."""

from __future__ import annotations

from .licence_texts import NAMES, PASSAGES, REPLACED, STATEMENTS

_BACKSLASHED = r"<\\*\|"

OP1 = rf"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, turn, role, '<|im_end|><|im_start|>assistant ok'
  from (values (0, 'user'), (1, 'assistant')) v(turn, role))
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), ''))
    as loss_sha256,
  cast(sum(24 + length(role) + length(text) + len(regexp_extract_all(text, '{_BACKSLASHED}'))) as bigint)
    as formatted_chars
from rows group by conv_id"""

# A word ends where a byte that is neither letter, digit nor beyond ASCII begins.
_WORDS = (r"[x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') if x <> '']")

OP4 = rf"""
with items as (
  select cast(item_id as varchar) as item_id, ws, least(len(ws), 13) as w
  from (select item_id, {_WORDS} as ws from benchmark) where len(ws) > 0),
windows as (
  select distinct item_id, w, list_slice(ws, a, a + w - 1) as win
  from (select item_id, ws, w, unnest(range(1, len(ws) - w + 2)) as a from items)),
docs as (select doc_id, row_number() over () as d, {_WORDS} as ws from documents),
sizes as (select distinct w from windows),
places as (
  select d, w, ws, unnest(range(1, len(ws) - w + 2)) as a from docs, sizes where len(ws) >= w),
hits as (
  select d, a, p.w, item_id from (select d, a, w, list_slice(ws, a, a + w - 1) as win from places) p
  join windows using (w, win)),
covered as (
  select d, count(distinct word) as n_hit
  from (select distinct d, unnest(range(a, a + w)) as word from hits) group by d),
found as (
  select d, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items
  from (select distinct d, item_id from hits where item_id is not null) group by d)
select doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from docs left join covered using (d) left join found using (d)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_quoted(x) if isinstance(x, str) else str(x) for x in row) + ")" for row in rows)


_PLAIN = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(1) || chr(2), 'abcdefghijklmnopqrstuvwxyz  ')"
for _pattern, _by in ((r"'\n[^a-z0-9\n]+'", "chr(10)"), ("'identifier:'", "'identifier '"), (r"'([^a-z0-9])v\.'", r"'\1v '"),
                      (r"'([0-9])\+'", r"'\1 or later '"),
                      (r"'[.!?;:][^a-z0-9 \t\n\r\f\v]*([ \t\n\r\f\v]|$)'", "chr(1)"), (r"'\n\n+'", "chr(1)"),
                      (r"'\n'", "chr(2)"), (r"'[^a-z0-9\x01\x02]+'", "' '")):
    _PLAIN = f"regexp_replace({_PLAIN}, {_pattern}, {_by}, 'g')"

# Only the published wording is the operator's own table; cutting and matching are written out here.
# Known sentences and rules hardly overlap other than by one holding the other, so what begins
# within an earlier one, or is the shorter of two that begin together, is not counted.
OP10 = rf"""
with names(licence, name) as (values {_values((k, n) for k, ns in NAMES.items() for n in ns)}),
spdx(name, licence) as (values {_values([*((k, k) for k in NAMES), *REPLACED.items()])}),
starts(start) as (values {_values((s,) for s in STATEMENTS)}),
passages(p, licence, text) as (values {_values((k, *x) for k, x in enumerate(PASSAGES))}),
docs as (select doc_id, row_number() over () as d, coalesce(text, '') as text from documents),
said as (
  select licence || '-ref' as ids, start || the || name as text
  from names, starts, (values (' '), (' the ')) as t(the)
  union all select licence || '-ref', 'SPDX-License-Identifier: ' || name from spdx
  union all select a.licence || '-ref ' || b.licence || '-ref', 'SPDX-License-Identifier: ' || a.name || word || b.name
  from spdx a, spdx b, (values (' OR '), (' AND ')) as t(word)),
texts as (
  select 'd' as kind, d as k, text from docs
  union all select 'p', p, text from passages
  union all select 's', row_number() over (), text from (select distinct text from said)),
cut as (select kind, k, string_split({_PLAIN.format("chr(10) || text")}, chr(1)) as parts from texts),
parts as (select kind, k, unnest(parts) as part, unnest(range(len(parts))) as u from cut),
units as (
  select * from (select kind, k, u, [trim(x) for x in string_split(part, chr(2)) if trim(x) <> ''] as lines from parts)
  where len(lines) > 0),
spoken as (
  select distinct ids, array_to_string(lines, ' ') as sentence
  from (select distinct ids, text from said) join texts t using (text) join units u on u.kind = 's' and t.kind = 's' and u.k = t.k),
written as (
  select k as p, u, licence, array_to_string(lines, ' ') as sentence
  from units join passages on k = p where kind = 'p'),
numbered as (
  select licence || '-' || row_number() over (partition by licence order by p, u) as ids, sentence
  from (select * from written where sentence not in (select sentence from spoken)
        qualify row_number() over (partition by sentence order by p, u) = 1)),
known as (select ids, sentence from spoken union all select ids, sentence from numbered),
words as (select string_split(sentence, ' ') as ws from known),
prefixes as (select distinct array_to_string(ws[1:n], ' ') as prefix from (select ws, unnest(range(1, len(ws) + 1)) as n from words)),
firsts as (
  select * from (select k as d, u, lines, unnest(range(1, len(lines) + 1)) as i from units where kind = 'd')
  where lines[i] in (select prefix from prefixes)),
runs as (
  select d, u, lines, i, unnest(range(i, least(len(lines), i + (select max(len(ws)) from words)) + 1)) as j from firsts),
matched as (
  select d, u, i, j, ids from runs join known on array_to_string(lines[i:j], ' ') = sentence),
kept as (
  select * from matched m where not exists (
    select 1 from matched o where o.d = m.d and o.u = m.u
      and (o.i < m.i and m.i <= o.j or o.i = m.i and o.j > m.j))),
ids as (select d, string_agg(ids, ' ' order by u, i) as sentence_ids from kept group by d),
rules as (
  select sequence, arg_min(licence, p) as licence, len(string_split(sequence, ' ')) as n
  from (select p, licence, string_agg(ids, ' ' order by u) as sequence from written join known using (sentence) group by p, licence
        union all select distinct -1, licence, licence || '-ref' from names) group by sequence),
places as (
  select d, i, i + n - 1 as j, licence
  from (select d, string_split(sentence_ids, ' ') as seq, unnest(range(1, len(string_split(sentence_ids, ' ')) + 1)) as i from ids)
  join rules on array_to_string(seq[i:i + n - 1], ' ') = sequence),
stated as (
  select d, string_agg(distinct licence, ',' order by licence) as licences, count(*) as n_licences
  from places m where not exists (
    select 1 from places o where o.d = m.d and (o.i < m.i and m.i <= o.j or o.i = m.i and o.j > m.j)) group by d)
select doc_id, coalesce(sentence_ids, '') as sentence_ids, coalesce(licences, '') as licences,
  coalesce(n_licences, 0) as n_licences
from docs left join ids using (d) left join stated using (d)"""

# Texts as hexadecimal digits, two a byte; taken apart in steps, as long strings are slow to cut.
OP7 = """
with docs as (
  select doc_id, hex(encode(coalesce(text, ''))) as h, strlen(coalesce(text, '')) as n from documents),
parts as (
  select doc_id, n, a, substr(h, 2 * a + 1, 610) as part
  from (select doc_id, n, h, unnest(range(0, n, 256)) as a from docs)),
places as (
  select doc_id, n, a + k as q, substr(part, 2 * k + 1, 100) as s
  from (select *, unnest(range(0, least(256, n - a))) as k from parts)),
windows as (select doc_id, q as p, s from places where q + 50 <= n),
firsts as (select s, min(doc_id) as low from windows group by s),
hits as (select doc_id, p from windows join firsts using (s) where low < doc_id),
bytes as (select doc_id, q, left(s, 2) as x from places),
marked as (
  select b.doc_id, q, x, coalesce(q - max(p) over (partition by b.doc_id order by q) < 50, false) as gone
  from bytes b left join hits on hits.doc_id = b.doc_id and p = q),
runs as (
  select *, gone and not coalesce(lag(gone) over (partition by doc_id order by q), false) as opens from marked),
done as (
  select doc_id, count(*) filter (where gone) as n_removed, count(*) filter (where opens) as n_spans,
    string_agg(x, '' order by q) filter (where not gone) as kept
  from runs group by doc_id)
select doc_id, n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(kept, ''))) as kept_sha256
from docs left join done using (doc_id)"""

OP6 = r"""
with recursive docs as (
  select doc_id, [x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') if x <> ''] as ws from documents),
shingles as (
  select distinct doc_id, list_slice(ws, a, a + 2) as s
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) as a from docs where len(ws) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as u, b.doc_id as v, count(*) as shared
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as (
  select u, v from common join sizes x on x.doc_id = u join sizes y on y.doc_id = v
  where 100 * shared >= 90 * (x.n + y.n - shared)),
edges as (select u, v from links union all select v, u from links),
reached(doc_id, node) as (
  select doc_id, doc_id from docs union select r.doc_id, e.v from reached r join edges e on e.u = r.node),
lowest as (select doc_id, min(node) as component_id from reached group by doc_id)
select doc_id, coalesce(n, 0) as n_shingles, component_id
from docs join lowest using (doc_id) left join sizes using (doc_id)"""


# The same windows of words as strings; words hold no spaces.
OP11 = r"""
with docs as (
  select doc_id, row_number() over () as d, [x for x in string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+')
    if x <> ''] as ws from documents),
places as (select d, doc_id, ws, unnest(range(1, len(ws) - 48)) as a from docs where len(ws) >= 50),
windows as (select d, doc_id, a, array_to_string(list_slice(ws, a, a + 49), ' ') as s from places),
firsts as (select s, min(doc_id) as low from windows group by s),
hits as (select d, a from windows join firsts using (s) where low < doc_id),
words as (select d, unnest(ws) as w, unnest(range(1, len(ws) + 1)) as q from docs),
marked as (
  select w.d, q, w, coalesce(q - max(a) over (partition by w.d order by q) < 50, false) as gone
  from words w left join hits h on h.d = w.d and a = q),
done as (
  select d, count(*) filter (where gone) as n_removed, string_agg(w, ' ' order by q) filter (where not gone) as kept
  from marked group by d)
select doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_removed, 0) as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256
from docs left join done using (d)"""

# CRC-32 of the strings of a table: bytes through the table of 256 remainders, made by its rule.
_CRC_TABLE = """
crc_table as (
  select list(c order by k) as t from (
    select k, list_reduce(list_prepend(k, range(8)), lambda a, b:
      case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as c from range(256) r(k)))"""


def _crc(strings: str, column: str) -> str:
    return f"""
  select {column}, xor(list_reduce(list_prepend(4294967295, bytes), lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])),
    4294967295) as crc
  from (select {column}, [16 * (strpos('0123456789ABCDEF', h[2 * k + 1]) - 1) + strpos('0123456789ABCDEF', h[2 * k + 2]) - 1
      for k in range(len(h) // 2)] as bytes
    from (select {column}, hex(encode({column})) as h from ({strings}))), crc_table"""


OP12 = rf"""
with {_CRC_TABLE},
docs as (select doc_id, row_number() over () as d, {_WORDS} as ws from documents),
corpus as (select d, unnest(ws) as w from docs),
target as (select unnest(ws) as w from (select {_WORDS} as ws from benchmark)),
known as (select w, crc % 10000 as b from ({_crc("select distinct w from (select w from corpus union all select w from target)", "w")})),
s as (select b, count(*) as n from corpus join known using (w) group by b),
t as (select b, count(*) as n from target join known using (w) group by b),
sums as (select coalesce((select sum(n) from s), 0) as sn, coalesce((select sum(n) from t), 0) as tn),
gains as (
  select b, cast(floor(1000 * ln((coalesce(t.n, 0) + 1)::double * (sn + 10000) / ((s.n + 1)::double * (tn + 10000)))) as bigint)
    as gain from s left join t using (b), sums),
weights as (select d, sum(gain) as weight from corpus join known using (w) join gains using (b) group by d),
scored as (
  select doc_id, cast(len(ws) as bigint) as n_features, cast(coalesce(weight, 0) as bigint) as weight,
    cast('0x' || substr(sha256('2024:' || coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint) as h
  from docs left join weights using (d)),
noisy as (select *, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296))) as bigint) as score from scored),
ranked as (
  select *, case when n_features >= 20 then row_number() over (
      partition by n_features >= 20 order by score desc, doc_id nulls last) end as place,
    count(*) filter (where n_features >= 20) over () as able from noisy)
select doc_id, n_features, weight, score, case when place <= 10 * able // 100 then place end as rank from ranked"""

OP13 = rf"""
with recursive {_CRC_TABLE},
original as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as place from conversations),
marks as (select place, crc % 20 as kind from ({_crc("select distinct place from original", "place")})),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case when kind = 3 then 2 else 1 end)) as copy
  from original join marks using (place) where kind <> 0),
ordered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
    role[1] as initial from damaged),
judged as (
  select *, case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank'
      when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
      when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') then 'truncated' end as fault,
    lag(initial) over (partition by conv_id order by i) || initial as pair from ordered),
counted as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate,
    count(*) filter (where fault = 'truncated') as truncated,
    count(*) filter (where pair is not null and pair not in ('su', 'ua', 'au')) as illegal
  from judged group by conv_id),
-- What may be done with a row: state before, initial the row must have, edits, their cost, state after.
moves(st, needs, edits, price, nxt, stays) as (values
  ('', 's', 'K', 0, 's', true), ('', 'u', 'K', 0, 'u', true), ('', 'a', 'IK', 2, 'a', true),
  ('s', 'u', 'K', 0, 'u', true), ('s', 'a', 'IK', 2, 'a', true), ('u', 'a', 'K', 0, 'a', true),
  ('u', 'u', 'IK', 2, 'u', true), ('a', 'u', 'K', 0, 'u', true), ('a', 'a', 'IK', 2, 'a', true),
  ('', null, 'R', 2, 'u', true), ('', null, 'IR', 4, 'a', true), ('s', null, 'R', 2, 'u', true),
  ('s', null, 'IR', 4, 'a', true), ('u', null, 'R', 2, 'a', true), ('u', null, 'IR', 4, 'u', true),
  ('a', null, 'R', 2, 'u', true), ('a', null, 'IR', 4, 'a', true),
  ('', null, 'D', 3, '', false), ('s', null, 'D', 3, 's', false), ('u', null, 'D', 3, 'u', false),
  ('a', null, 'D', 3, 'a', false)),
steps(conv_id, i, st, best) as (
  select conv_id, 0, '', '00000000' from counted
  union all
  select p.conv_id, p.i + 1, nxt, min(printf('%08d', cast(left(best, 8) as bigint) + price
      + case when stays and fault = 'truncated' then 1 else 0 end) || substr(best, 9) || edits)
  from steps p join judged r on r.conv_id is not distinct from p.conv_id and r.i = p.i + 1
  join moves m on m.st = p.st and (needs is null or needs = initial)
    and (not stays or fault is null or fault = 'truncated')
  group by p.conv_id, p.i, nxt),
ends as (
  select c.conv_id, min(case st when 'u' then printf('%08d', cast(left(best, 8) as bigint) + 2) || substr(best, 9) || 'I'
      when 's' then printf('%08d', cast(left(best, 8) as bigint) + 4) || substr(best, 9) || 'II' else best end) as best
  from counted c join steps p on p.conv_id is not distinct from c.conv_id and p.i = c.n group by c.conv_id),
letters as (
  select conv_id, unnest(range(9, len(best) + 1)) as q, best[unnest(range(9, len(best) + 1))] as edit from ends),
taken as (select *, sum(case when edit = 'I' then 0 else 1 end) over (partition by conv_id order by q) as i from letters),
left_ as (
  select t.conv_id, q, edit, r.role, r.initial, r.text, row_number() over (partition by t.conv_id order by q) as k
  from taken t left join judged r on r.conv_id is not distinct from t.conv_id and r.i = t.i and edit <> 'I'
  where edit <> 'D'),
named as (
  select *, max(case when k = 1 and edit = 'K' and initial = 's' then 1 else 0 end) over (partition by conv_id) as lead from left_),
texts as (
  select conv_id, string_agg(case when edit = 'K' then role when (k - lead) % 2 = 1 then 'user' else 'assistant' end
    || ':' || coalesce(text, ''), chr(10) order by q) as repaired from named group by conv_id)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
  coalesce(cast(left(best, 8) as bigint), 0) as cost, coalesce(substr(best, 9), '') as audit,
  sha256(coalesce(repaired, '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counted c on c.conv_id is not distinct from o.conv_id
left join ends e on e.conv_id is not distinct from o.conv_id
left join texts x on x.conv_id is not distinct from o.conv_id"""
