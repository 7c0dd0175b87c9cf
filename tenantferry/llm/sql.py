"""SQL for DuckDB that the longer queries of this folder must equal."""

from __future__ import annotations

# CRC-32 by its table, which the first list builds from the polynomial
CRC_TABLE = """select list_transform(range(256), lambda i: list_reduce(
    [i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t"""


def crc32(text: str) -> str:
    """CRC-32 of ASCII text where ``t`` is the table."""
    return f"""xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split({text}, ''), lambda h: ord(h)::bigint)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"""


def _way(p: str, cost: str, letter: str, turn: str | None = None) -> str:
    said = f"list_append(({p}).t, {turn})" if turn else f"({p}).t"
    return f"struct_pack(c := ({p}).c + {cost}, p := ({p}).p || '{letter}', t := {said})"


def _least(*ways: str) -> str:
    return f"list_sort([{', '.join(ways)}])[1]"


def _if(test: str, way: str) -> str:
    return f"case when {test} then {way} else struct_pack(c := 1000000000, p := '', t := []::varchar[]) end"


def _keep(p: str, initial: str) -> str:
    return _if(f"free and r = '{initial}'", _way(p, "cut", "K", "role || ':' || text"))


def _rerole(p: str, role: str) -> str:
    return _if("free", _way(p, "2 + cut", "R", f"'{role}:' || text"))


def _put(p: str, role: str) -> str:
    return _way(p, "2", "I", f"'{role}:'")


_FAR = "struct_pack(c := 1000000000, p := '', t := []::varchar[])"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

#: Rows one after another, the best way to each of the four states carried along.
REPAIR = f"""
with recursive crc as ({CRC_TABLE}),
named as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k
    from conversations
), dealt as (select named.*, {crc32('k')} % 20 as d from named, crc),
damaged as (
    select conv_id, turn, case when d = 4 then 'user' else role end as role,
        case d when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, d
    from dealt where d <> 0
), doubled as (select * from damaged union all select * from damaged where d = 3),
placed as (
    select conv_id, turn, role, text, left(role, 1) as r, trim(text, {_BLANKS}) as body,
        row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) as i
    from doubled
), ordered as (select *, row_number() over (partition by conv_id, role, text order by i) as nth from placed), marked as (
    select *, case when body = '' then 'blank' when nth > 1 then 'duplicate' when right(body, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
        lag(r) over (partition by conv_id order by i) || r as pair
    from ordered
), steps as (select *, fault in ('', 'truncated') as free, (fault = 'truncated')::int as cut from marked),
walk as (
    select conv_id, 0::bigint as i, struct_pack(c := 0, p := '', t := []::varchar[]) as e, {_FAR} as s,
        struct_pack(c := 2, p := 'I', t := ['user:']) as u, struct_pack(c := 4, p := 'II', t := ['user:', 'assistant:']) as a
    from (select distinct conv_id from steps)
    union all
    select conv_id, i, e, s, {_least('u', _put('e', 'user'), _put('s', 'user'), _put('a', 'user'))},
        {_least('a', _put('u', 'assistant'), *(_way(f"{_put(x, 'user')}", '2', 'I', "'assistant:'") for x in 'es'))}
    from (
        select w.conv_id, x.i, {_way('e', '3', 'D')} as e,
            {_least(_way('s', '3', 'D'), _keep('e', 's'))} as s,
            {_least(_way('u', '3', 'D'), *(_keep(x, 'u') for x in 'esa'), *(_rerole(x, 'user') for x in 'esa'))} as u,
            {_least(_way('a', '3', 'D'), _keep('u', 'a'), _rerole('u', 'assistant'))} as a
        from walk w join steps x on x.conv_id is not distinct from w.conv_id and x.i = w.i + 1
    )
), ends as (select conv_id, {_least('e', 'a')} as best from walk qualify i = max(i) over (partition by conv_id)),
counted as (
    select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
        count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
        count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) as illegal
    from marked group by conv_id
)
select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
    coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(best.c, 0)::bigint as cost,
    coalesce(best.p, '') as audit, sha256(coalesce(array_to_string(best.t, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counted c on c.conv_id is not distinct from o.conv_id
left join ends n on n.conv_id is not distinct from o.conv_id
"""

DEDUP = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
    row_number() over (partition by coalesce(text, '') order by doc_id desc nulls last) = 1 as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
"""


def _enc(c: str) -> str:
    return f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')"


_HEAD = " || ".join(map(_enc, ("doc_id", "source", "lang", "n_chars")))
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OTHERS = "array_to_string(list_concat(hs[1:c.pos % 8], hs[c.pos % 8 + 2:]), '')"
_AGAIN = "sha256(array_to_string(list_concat(list_append(hs[1:c.pos % 8], cur), hs[c.pos % 8 + 2:]), ''))"

#: Levels of the languages' trees and of the one above; then each leaf climbs them twice, as it was and as it is.
MERKLE = f"""
with recursive crc as ({CRC_TABLE}),
hashed as (
    select doc_id, lang, sha256({_HEAD} || {_enc('text')}) as leaf,
        case when {crc32('doc_id::varchar')} % 3 = 0 then sha256({_HEAD} || {_enc(_LOWER)}) end as changed
    from documents, crc
), leaves as (
    select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by lang) as n from hashed
), tree as (
    select 0 as lvl, lang, pos, n, leaf as h from leaves
    union all
    select lvl + 1, lang, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' order by pos)) from tree where n > 1 group by lvl, lang, pos // 8, n
), runs as (select lvl, lang, pos // 8 as run, list(h order by pos) as hs from tree where n > 1 group by all),
subroots as (select lang, h, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n from tree where n = 1),
top as (
    select 0 as lvl, pos, n, h from subroots
    union all
    select lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' order by pos)) from top where n > 1 group by lvl, pos // 8, n
), top_runs as (select lvl, pos // 8 as run, list(h order by pos) as hs from top where n > 1 group by all),
climb as (
    select lang, pos as leaf_pos, 0 as lvl, pos, n, coalesce(changed, leaf) as cur, '' as proof from leaves
    union all
    select c.lang, leaf_pos, c.lvl + 1, c.pos // 8, (c.n + 7) // 8, {_AGAIN}, proof || {_OTHERS}
    from climb c join runs r on r.lvl = c.lvl and r.lang is not distinct from c.lang and r.run = c.pos // 8 where c.n > 1
), over as (
    select c.lang, leaf_pos, 0 as lvl, s.pos, s.n, cur, proof from climb c join subroots s on s.lang is not distinct from c.lang where c.n = 1
    union all
    select c.lang, leaf_pos, c.lvl + 1, c.pos // 8, (c.n + 7) // 8, {_AGAIN}, proof || {_OTHERS}
    from over c join top_runs r on r.lvl = c.lvl and r.run = c.pos // 8 where c.n > 1
)
select l.doc_id, l.leaf, s.h as subroot, t.h as root, sha256(o.proof) as proof_sha256, o.cur as folded_root, o.cur = t.h as verified
from leaves l join over o on o.lang is not distinct from l.lang and o.leaf_pos = l.pos and o.n = 1
join subroots s on s.lang is not distinct from l.lang join top t on t.n = 1
"""
