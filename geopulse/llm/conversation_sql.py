"""What the conversation queries return, stated in SQL."""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, a byte and then eight shifts at a time."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda ch: list_concat([cast(ascii(ch) as bigint)], [-1, -1, -1, -1, -1, -1, -1, -1])))"
    fold = "lambda c, b: case when b >= 0 then xor(c, b) else xor(c >> 1, 3988292384 * (c & 1)) end"
    return f"xor(list_reduce(list_concat([4294967295], {steps}), {fold}), 4294967295)"


_SPELLED = "coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')"

# Costs and letters go forward from row to row, the cheapest and then least script for each role last said.
REPAIR = rf"""
with recursive given as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {_crc32(_SPELLED)} % 20 as code from conversations),
spoilt as (
  select conv_id, turn, case code when 4 then 'user' else role end as role,
         case code when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
         unnest(case code when 3 then [0, 1] else [0] end) as copy
  from given where code <> 0),
placed as (
  select *, left(role, 1) as x, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as bare,
         row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i,
         row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as seen
  from spoilt),
faulty as (
  select *, case when bare = '' then 'b' when seen > 1 then 'd' when right(bare, 1) not in ('.', '!', '?') then 't' else '' end as fault,
         lag(x) over (partition by conv_id order by i) as x0
  from placed),
moves as (select * from (values
  ('', 'R', null, 'u'), ('s', 'R', null, 'u'), ('a', 'R', null, 'u'), ('u', 'R', null, 'a'),
  ('', 'K', 's', 's'), ('', 'K', 'u', 'u'), ('s', 'K', 'u', 'u'), ('a', 'K', 'u', 'u'), ('u', 'K', 'a', 'a'),
  ('', 'D', null, ''), ('s', 'D', null, 's'), ('u', 'D', null, 'u'), ('a', 'D', null, 'a')) m(last, letter, needs, next)),
inserts as (select * from (values
  ('', '', '', ''), ('s', '', '', 's'), ('u', '', '', 'u'), ('a', '', '', 'a'),
  ('', 'I', chr(10) || 'user:', 'u'), ('s', 'I', chr(10) || 'user:', 'u'), ('a', 'I', chr(10) || 'user:', 'u'), ('u', 'I', chr(10) || 'assistant:', 'a'),
  ('', 'II', chr(10) || 'user:' || chr(10) || 'assistant:', 'a'), ('s', 'II', chr(10) || 'user:' || chr(10) || 'assistant:', 'a'),
  ('a', 'II', chr(10) || 'user:' || chr(10) || 'assistant:', 'a')) m(last, letters, said, next)),
walk as (
  select conv_id, cast(0 as bigint) as i, n.next as last, cast(5 * length(letters) as bigint) as cost, letters as audit, said
  from (select distinct conv_id from faulty), inserts n where n.last = ''
  union all
  select conv_id, i, last, cost, audit, said from (
    select f.conv_id, f.i, n.next as last,
           w.cost + 5 * length(n.letters) + case m.letter when 'D' then 2 when 'R' then 1 else 0 end + case when m.letter <> 'D' and f.fault = 't' then 5 else 0 end as cost,
           w.audit || m.letter || n.letters as audit,
           w.said || case m.letter when 'D' then '' when 'K' then chr(10) || f.role || ':' || f.text
                     else chr(10) || case m.next when 'u' then 'user:' else 'assistant:' end || f.text end || n.said as said
    from walk w join faulty f on f.conv_id is not distinct from w.conv_id and f.i = w.i + 1
    join moves m on m.last = w.last and (m.needs is null or m.needs = f.x) and (m.letter = 'D' or f.fault not in ('b', 'd'))
    join inserts n on n.last = m.next) s
  qualify row_number() over (partition by conv_id, i, last order by cost, audit) = 1),
figures as (
  select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'b') as blank,
         count(*) filter (fault = 'd') as duplicate, count(*) filter (fault = 't') as truncated,
         count(*) filter (x0 is not null and x0 || x not in ('su', 'ua', 'au')) as illegal
  from faulty group by conv_id),
best as (
  select w.* from walk w join figures f on f.conv_id is not distinct from w.conv_id and f.n = w.i where w.last in ('', 'a')
  qualify row_number() over (partition by w.conv_id order by w.cost, w.audit) = 1)
select c.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
       coalesce(illegal, 0) as illegal, cast(coalesce(cost, 0) as bigint) as cost, coalesce(audit, '') as audit,
       sha256(coalesce(substr(said, 2), '')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join figures f on f.conv_id is not distinct from c.conv_id left join best b on b.conv_id is not distinct from c.conv_id
"""

PREFIXES = rf"""
with spoken as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
  from conversations where conv_id is not null),
convs as (
  select conv_id, {_crc32("cast(conv_id as varchar)")} % 4 as h, conv_id - (conv_id % 20 + 20) % 20 as base
  from (select distinct conv_id from spoken)),
rebuilt as (
  select c.conv_id, s.pos, s.role, s.text from convs c join spoken s on s.conv_id = c.base and s.pos <= c.h
  union all
  select c.conv_id, s.pos, s.role, s.text from convs c join spoken s on s.conv_id = c.conv_id and s.pos > c.h),
sequences as (
  select c.conv_id, coalesce(list({{'role': r.role, 'text': r.text}} order by r.pos) filter (r.pos is not null), []) as turns
  from convs c left join rebuilt r on r.conv_id = c.conv_id group by c.conv_id),
members as (
  select conv_id, turns, unnest(range(0, len(turns) + 1)) as depth from sequences),
nodes as (
  select turns[1:depth] as node, depth, min(conv_id) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(case when len(turns) = depth then cast(conv_id as varchar) end, ',' order by conv_id), '')) as ends_sha256
  from members group by 1, 2),
valued as (
  select *, case when depth = 0 then 0 else (n_convs - 1) * len(regexp_extract_all(node[depth].text, '[^\x20\x09-\x0D]+')) end as saved from nodes),
children as (select node[1:depth - 1] as node, count(*) as n_children from nodes where depth > 0 group by 1),
counted as (select v.*, coalesce(k.n_children, 0) as n_children from valued v left join children k on k.node = v.node),
spread as (select node, saved, n_children, unnest(range(0, depth + 1)) as up from counted),
sums as (
  select node[1:up] as node, count(*) filter (n_children = 0) as n_leaves, cast(sum(saved) as bigint) as saved_tokens from spread group by 1)
select c.conv_id, cast(c.depth as bigint) as depth, p.conv_id as parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved_tokens, c.ends_sha256
from counted c join sums s on s.node = c.node left join nodes p on c.depth > 0 and p.node = c.node[1:c.depth - 1]
"""
