"""DuckDB SQL for the numbered queries that SQL can express."""

from __future__ import annotations

import math
import zlib

from zonekit.llm import chat_format, chat_repair, mixing, ranked_search, secret_scan


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _found(kind: str, pattern: str) -> str:
    """Rows (row, kind, rank, s, e, found) of a pattern's matches; positions in code points, end exclusive."""
    p = _quoted(pattern)
    return f"""
    select row, '{kind}' as kind, {secret_scan.KINDS.index(kind)} as rank,
           coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(found[1:i - 1], lambda x: length(x))), 0) as s,
           s + length(found[i]) as e, found[i] as found
    from (select *, unnest(range(1, len(found) + 1)) as i from (
        select row, regexp_extract_all(t, {p}) as found, string_split_regex(t, {p}) as gaps from d where regexp_matches(t, {p})))"""


def op2() -> str:
    hex_run, hex_window, hex_bits = secret_scan.CLASSES["entropy_hex"]
    _, window, bits = secret_scan.CLASSES["entropy_token"]
    gains = [round(c * math.log2(c) * secret_scan.MILLION) if c else 0 for c in range(max(hex_window, window) + 1)]

    def least(w: int) -> str:
        return (f"list_min(list_transform(range(1, length(found) - {w} + 2), lambda i: "
                f"list_sum(list_transform(map_values(list_histogram(string_split(substr(found, i, {w}), ''))), lambda c: {gains}[c::bigint + 1]))))")

    allowed = " or ".join("(" + " and ".join([f"regexp_matches(found, {_quoted(p)})" for p in must] + [f"not regexp_matches(found, {_quoted(p)})" for p in never]) + ")"
                          for must, never in secret_scan.ALLOW)
    is_hex = f"(regexp_full_match(found, {_quoted(hex_run)}) and length(found) >= {hex_window})"
    return f"""
with d as (select row_number() over () as row, doc_id, coalesce(text, '') as t from documents),
base as ({_found("assign", secret_scan.ASSIGN)} union all {_found("access", secret_scan.ACCESS)} union all {_found("hex", secret_scan.HEX)}),
kept as (select * from base where kind <> 'assign' or length(regexp_extract(found, {_quoted(secret_scan.ASSIGN)}, 2)) >= 6),
candidate as ({_found("entropy_hex", secret_scan.HEX_CANDIDATE)} union all
              select * from ({_found("entropy_token", secret_scan.CANDIDATE)}) where not {is_hex}),
open_ as (select c.* from candidate c where not ({allowed})
          and not exists (select 1 from kept k where k.row = c.row and k.s <= c.s and c.e <= k.e)),
added as (select row, kind, rank, s, e from open_
          where case when kind = 'entropy_hex' then {least(hex_window)} <= {secret_scan.limit(hex_window, hex_bits)} else {least(window)} <= {secret_scan.limit(window, bits)} end),
spans as (select row, string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) as spans
          from (select row, kind, rank, s, e from kept union all select * from added) group by row),
base_spans as (select row, count_if(kind = 'assign') as n_assign, count_if(kind = 'access') as n_access, count_if(kind = 'hex') as n_hex,
                      string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) as listed from kept group by row)
select d.doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access, coalesce(n_hex, 0)::bigint as n_hex,
       sha256(coalesce(listed, '')) as base_sha256, coalesce(spans, '') as spans
from d left join base_spans using (row) left join spans using (row)"""


def op4() -> str:
    weights = ", ".join(map(str, mixing.WEIGHTS))
    return f"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_quoted(mixing.WORD)}))::bigint as size from documents),
src as (select source, sum(size)::bigint as source_size, row_number() over (order by source collate "C" nulls last) - 1 as idx from d group by source),
w as (select *, ([{weights}])[1 + (idx % {len(mixing.WEIGHTS)})::int]::bigint as weight, source_size * {mixing.MAX_EPOCHS} as most, sum(source_size) over () as total from src),
c as (select *, total - coalesce(sum(most) over f, 0) as rest, sum(weight) over () - coalesce(sum(weight) over f, 0) as weights,
             row_number() over (order by most / weight, idx) as place
      from w window f as (order by most / weight, idx rows between unbounded preceding and 1 preceding)),
share as (select rest, weights, place from c where rest::decimal(38, 0) * weight <= most::decimal(38, 0) * weights order by place limit 1),
t as (select c.source, c.idx, c.source_size, case when c.place >= s.place then (c.weight * s.rest)::double / s.weights::double else c.most::double end as target from c, share s),
slots as (select idx, ceil(floor(target) / {mixing.BLOCK_WORDS}.0)::bigint as slots from t),
points as (select idx, unnest(range(slots)) + coalesce(sum(slots) over (order by idx rows between unbounded preceding and 1 preceding), 0) as point, sum(slots) over () as n from slots),
timed as (select idx, case when n <= 1 then 0 else ('0b' || reverse(lpad(bin(point::bigint), length(bin((n - 1)::bigint))::int, '0')))::bigint end as first_time from points),
blocks as (select idx, first_time, row_number() over (partition by idx order by first_time) - 1 as block from timed),
o as (select d.*, t.idx, t.source_size, t.target, coalesce(sum(size) over (partition by d.source
             order by ('0x' || substr(md5('7:' || coalesce(doc_id::varchar, '')), 1, 15))::bigint, doc_id rows between unbounded preceding and 1 preceding), 0) as start
      from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
       ({" + ".join(f"greatest(0, least(start + {e} * source_size + size, floor(target)) - (start + {e} * source_size))" for e in range(mixing.MAX_EPOCHS))})::bigint as taken, first_time
from o left join blocks on blocks.idx = o.idx and size > 0 and start < floor(target) and block = start // {mixing.BLOCK_WORDS}"""


def op5(k: int = 3, percent: int = 90) -> str:
    return f"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_quoted(mixing.WORD)}) as w from documents),
s as (select doc_id, case when len(w) = 0 then [] when len(w) < {k} then [array_to_string(w, ' ')]
             else list_distinct(list_transform(range(1, len(w) - {k} + 2), lambda i: array_to_string(w[i:i + {k} - 1], ' '))) end as s from w),
n as (select doc_id, len(s)::bigint as n from s),
g as (select doc_id, len(s)::bigint as n, unnest(s) as g from s),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as shared from g a join g b on a.g = b.g and a.doc_id < b.doc_id and 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n) group by all),
links as (select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * shared >= {percent} * (x.n + y.n - shared)),
near as (select a, b from links union all select b, a from links),
reach as (select doc_id as a, doc_id as b from n union select reach.a, near.b from reach join near on reach.b = near.a)
select n.doc_id, n.n as n_shingles, min(reach.b) as component_id from n join reach on reach.a = n.doc_id group by n.doc_id, n.n"""


def op6() -> str:
    escaped = "replace(replace({}, '&', '&amp;'), '<', '&lt;')"
    role = f"replace({escaped.format('role')}, chr(10), '&#10;')"
    said = _quoted("\\### Assistant: </turn> ok")
    return f"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all select -7, 0, 'user', {said} union all select -7, 1, 'assistant', {said})
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum({len(chat_format.OPEN) + 1 + len(chat_format.CLOSE)} + length({role}) + length({escaped.format('text')}))::bigint as formatted_chars
from t group by conv_id"""


def op11(k: int = 20) -> str:
    found = f"unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_quoted(ranked_search.TERM)})) as term"
    return f"""
with d as (select row_number() over () as row, doc_id, text from documents),
q as (select row_number() over () as query, item_id, text from benchmark),
t as (select row, doc_id, term, count(*) as tf from (select row, doc_id, {found} from d) group by all),
n as (select row, sum(tf)::bigint as n from t group by row),
s as (select count(*)::bigint as n_all, sum(n)::bigint as l_all from n),
w as (select term, floor(1000 * ln((2 * n_all + 2) / (2 * count(*) + 1)))::bigint as w from t, s group by term, n_all),
u as (select query, item_id, term, count(*)::bigint as times from (select query, item_id, {found} from q) group by all),
scored as (select query, item_id, t.row, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_all) // l_all))))::bigint as score
           from u join w using (term) join t using (term) join n on n.row = t.row, s group by all)
select item_id, rank::int as rank, doc_id, score
from (select *, row_number() over (partition by query order by score desc, doc_id nulls last) as rank from scored where score > 0) where rank <= {k}"""


def op13() -> str:
    # CRC-32 over ASCII: the register after one byte, for each low byte (its start and end are inverted)
    step = [zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)]
    crc = f"xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(key, ''), lambda c: ascii(c)::bigint)), lambda r, b: xor(r >> 8, ({step}::bigint[])[(xor(r, b) & 255) + 1])), 4294967295)"
    c = chat_repair
    # a way to a state is its cost, padded, and its letters: the least string is the cheapest and first
    add = lambda way, cost, letter: f"case when {way} is not null then lpad((left({way}, 9)::bigint + {cost})::varchar, 9, '0') || substr({way}, 10) || '{letter}' end"
    cut = f"(case when truncated then {c.TRUNCATED} else 0 end)"
    moves = {c.START: [], c.SYSTEM: [], c.USER: [], c.ASSISTANT: []}
    for state in range(4):
        moves[state].append(add(f"w{state}", c.DELETE, "D"))
        moves[c.NEXT[state]].append(f"case when not gone then {add(f'w{state}', f'{c.REROLE} + {cut}', 'R')} end")
    for (state, initial), after in c.KEPT.items():
        moves[after].append(f"case when not gone and initial = '{initial}' then {add(f'w{state}', cut, 'K')} end")
    after = {k: f"list_min([{', '.join(v)}])" for k, v in moves.items()}
    inserted = f"""select conv, i, v0 as w0, v1 as w1, u as w2, list_min([v3, {add('u', c.INSERT, 'I')}]) as w3
                   from (select *, list_min([v2, {add('v0', c.INSERT, 'I')}, {add('v1', c.INSERT, 'I')}, {add('v3', c.INSERT, 'I')}]) as u from x)"""
    return f"""
with recursive keyed as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
                                coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key from conversations),
marked as (select *, {crc} % 20 as fault from keyed),
damaged as (select conv_id, turn, case when fault = 4 then 'user' else role end as role,
                   case when fault = 1 then '' when fault = 2 then translate(text, '.!?', '') else text end as text,
                   unnest(range(case when fault = 3 then 2 else 1 end)) as copy from marked where fault <> 0),
convs as (select conv_id, row_number() over () as conv from (select distinct conv_id from conversations)),
placed as (select conv, turn, role, text, row_number() over (partition by conv order by turn nulls first, role, left(text, 64), sha256(text), copy) as i
           from damaged d join convs c on d.conv_id is not distinct from c.conv_id),
faulty as (select *, not regexp_matches(text, '[^\\x20\\x09-\\x0D]') as blank, row_number() over (partition by conv, role, text order by i) > 1 as again,
                  not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') as open_, left(role, 1) as initial,
                  lag(left(role, 1)) over (partition by conv order by i) as previous from placed),
rows_ as (select *, blank or again as gone, open_ and not blank and not again as truncated from faulty),
ways as (
  select conv, 0::bigint as i, lpad('0', 9, '0') as w0, null::varchar as w1, lpad('{c.INSERT}', 9, '0') || 'I' as w2, lpad('{2 * c.INSERT}', 9, '0') || 'II' as w3 from convs
  union all
  select * from ({inserted.replace("from x)", f"from (select conv, r.i, {', '.join(f'{after[k]} as v{k}' for k in range(4))} from ways join rows_ r using (conv) where r.i = ways.i + 1))")})),
best as (select conv, arg_max(list_min([w0, w3]), i) as way from ways group by conv),
letters as (select conv, unnest(string_split(substr(way, 10), '')) as letter, unnest(range(1, length(way) - 8)) as k from best where length(way) > 9),
edits as (select *, sum(case when letter <> 'I' then 1 else 0 end) over (partition by conv order by k) as i,
                 sum(case when letter <> 'D' then 1 else 0 end) over (partition by conv order by k) as e from letters),
lined as (select t.conv, t.k, t.e, t.letter, r.role, r.text, r.initial from edits t left join rows_ r on r.conv = t.conv and r.i = t.i and t.letter <> 'I' where t.letter <> 'D'),
shifted as (select *, max(case when e = 1 and letter = 'K' and initial = 's' then 1 else 0 end) over (partition by conv) as has_system from lined),
texts as (select conv, string_agg(case when letter = 'K' then role when (e - has_system) % 2 = 1 then 'user' else 'assistant' end
                                  || ':' || case when letter = 'I' then '' else text end, chr(10) order by k) as repaired from shifted group by conv),
counts as (select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count_if(blank) as blank, count_if(again and not blank) as duplicate,
                  count_if(truncated) as truncated, count_if(previous is not null and previous || initial not in ('su', 'ua', 'au')) as illegal from rows_ group by conv)
select conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
       coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, left(way, 9)::bigint as cost, substr(way, 10) as audit,
       sha256(coalesce(repaired, '')) as repaired_sha256
from convs join best using (conv) left join counts using (conv) left join texts using (conv)"""


def oracle_sql() -> dict[str, str]:
    return {"op2_secret_scan": op2(), "op4_source_mix": op4(), "op5_ngram_jaccard": op5(), "op6_chat_format": op6(),
            "op11_ranked_search": op11(), "op13_chat_repair": op13()}


__all__ = ["oracle_sql"]
