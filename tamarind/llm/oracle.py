"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from tamarind.llm import fill_in_middle, line_dedup, quality, turn_trie, urls
from tamarind.llm.chat import END, TEXT, TRAINED_ROLE, TURN

_WORD = r"[^\x20\x09-\x0D]+"


def _quality() -> str:
    q = quality
    separators = " + ".join(f"(length(line) - length(replace(line, '{mark}', '')))" for mark in q.SEPARATORS)
    return rf"""
with texts as (
    select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{_WORD}') as ws from documents
),
windows as (
    select doc_id, i, array_to_string(ws[i : i + {q.WINDOW - 1}], ' ') as g
    from (select doc_id, ws, unnest(range(1, len(ws) - {q.WINDOW - 2})) as i from texts)
),
twice as (select doc_id, i from (select *, count(*) over (partition by doc_id, g) as c from windows) where c > 1),
covered as (
    select doc_id, count(distinct i + k) as n from twice, unnest(range(0, {q.WINDOW})) as r(k) group by doc_id
),
lines as (
    select doc_id, line, regexp_extract_all(line, '{_WORD}') as ws
    from (select doc_id, unnest(string_split(text, chr(10))) as line from texts)
),
worded as (
    select *, len(ws) as n, {separators} as separators,
        length(regexp_replace(line, '[^{q.SYMBOLS}]+', '', 'g')) as symbols,
        length(regexp_replace(line, '[^\p{{Lu}}]+', '', 'g')) as capitals,
        length(regexp_replace(line, '[^\p{{L}}]+', '', 'g')) as letters,
        len([i for i in range(2, len(ws) + 1) if ws[i] = ws[i - 1]]) as stutter
    from lines where len(ws) > 0
),
judged as (
    select doc_id, line,
        not regexp_matches(line, '{q.SENTENCE_MARK}')
        or (separators >= 2 and separators * {q.NAVIGATION_WORDS} >= n)
        or symbols > n * {q.MOST_SYMBOLS}
        or (n >= {q.SHOUT_WORDS} and capitals > letters * {q.MOST_CAPITALS})
        or (n >= {q.STUTTER_WORDS} and stutter > n * {q.MOST_STUTTER})
        or (n <= {q.BOILERPLATE_WORDS} and regexp_matches(lower(line), '{q.BOILERPLATE}')) as failed
    from worded
),
by_line as (
    select doc_id, count(*) - count(distinct line) as dup,
        coalesce(sum(length(line)) filter (not failed), 0) / sum(length(line)) as share
    from judged group by doc_id
),
figures as (
    select t.doc_id, len(ws) as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
        length(regexp_replace(text, '[^{q.SYMBOLS}]+', '', 'g')) as n_symbols, coalesce(dup, 0) as n_dup_lines,
        coalesce(c.n, 0) as n_repeat_words, coalesce(share, 0.0) as kept_share
    from texts t left join by_line using (doc_id) left join covered c using (doc_id)
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
    n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words,
    n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
    not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and kept_share >= {q.LEAST_KEPT} as kept,
    kept_share::double as kept_share
from figures
"""


_DEDUP = r"""
with digests as (
    select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as d from documents
)
select doc_id, min(doc_id) over (partition by d) as keep_id, (count(*) over (partition by d))::bigint as group_size,
    doc_id = min(doc_id) over (partition by d) as kept, d as text_sha256
from digests
"""


def _chat() -> str:
    escaped = r"replace(replace({0}, '\', '\\'), '<|', '<\|')"
    length = (
        f"{len(TURN) + len(TEXT) + len(END)} + length({escaped.format('role')}) + length({escaped.format('text')})"
    )
    said = r"\### Assistant: </turn> ok"
    return rf"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '{said}' union all select -7, 1, '{TRAINED_ROLE}', '{said}'
),
whole as (
    select conv_id, count(*) as n_turns,
        string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as said,
        coalesce(string_agg(text, '' order by turn nulls first, text) filter (role = '{TRAINED_ROLE}'), '') as loss,
        sum({length}) as formatted_chars
    from turns group by conv_id
)
select conv_id, n_turns::bigint as n_turns, sha256(said) as turns_sha256, length(loss)::bigint as loss_chars,
    sha256(loss) as loss_sha256, formatted_chars::bigint as formatted_chars
from whole
"""


def _urls() -> str:
    listed = " or ".join(f"contains(host, '{w}')" for w in urls.LISTED_WORDS)
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in urls.RULES)
    return rf"""
with cut as (
    select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages
),
parts as (
    select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
    from (select page_id, coalesce(rest, '') as rest from cut)
),
named as (
    select *, case when host <> '' then
        regexp_replace(regexp_replace(host, ':[0-9]*$', ''), '^(?:www|m)\.([^.]+\.)', '\1')
        || regexp_replace(path, '(?:/index)?(?:\.html?)?/*$', '') end as canonical
    from parts
),
rules(rule_host, prefix, verdict) as (values {rules}),
fitting as (
    select page_id, max_by({{'rule': rule_host || prefix, 'verdict': verdict}}, length(rule_host || prefix)) as r
    from named join rules
        on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, prefix)
    group by page_id
),
listing as (select distinct canonical from named where {listed})
select n.page_id, host, path, r.rule as rule, l.canonical is not null as listed,
    coalesce(r.verdict, case when l.canonical is not null then 'block' else 'allow' end) as verdict
from named n left join fitting using (page_id) left join listing l on n.canonical = l.canonical
"""


_NGRAMS = rf"""
with recursive words as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') as ws
    from documents
),
shingles as (
    select distinct doc_id, array_to_string(ws[i : i + 4], ' ') as g
    from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as i from words where len(ws) > 0)
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
    select a.doc_id as x, b.doc_id as y, count(*) as c
    from shingles a join shingles b on a.g = b.g and a.doc_id < b.doc_id group by all
),
links as (
    select x, y from common join sizes s on s.doc_id = x join sizes t on t.doc_id = y
    where 100 * c >= 80 * (s.n + t.n - c)
),
both_ways as (select x, y from links union all select y, x from links),
reach(doc_id, other) as (
    select x, x from both_ways union select r.doc_id, y from reach r join both_ways on x = other
)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles,
    coalesce((select min(other) from reach r where r.doc_id = d.doc_id), d.doc_id) as component_id
from documents d left join sizes using (doc_id)
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _lines() -> str:
    blanks = " || ".join(f"chr({ord(c)})" for c in line_dedup.BLANKS)
    return rf"""
with texts as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
lines as (select doc_id, unnest(range(len(ls))) as place, unnest(ls) as line from texts),
keyed as (select *, translate(trim(line, {blanks}), '{_UPPER}', '{_LOWER}') as k from lines),
shared as (
    select k, max(doc_id) as keep from keyed where length(k) >= {line_dedup.LEAST_CHARS}
    group by k having count(distinct doc_id) >= {line_dedup.LEAST_DOCS}
),
judged as (select doc_id, place, line, keep is not null and keep <> doc_id as gone from keyed left join shared using (k))
select doc_id, count(*)::bigint as n_lines, (count(*) filter (gone))::bigint as n_dropped,
    sha256(coalesce(string_agg(line, chr(10) order by place) filter (not gone), '')) as kept_sha256
from judged group by doc_id
"""


def _middles() -> str:
    f = fill_in_middle
    draws = ", ".join(f"('0x' || substr(h, {1 + 8 * i}, 8))::bigint as h{i + 1}" for i in range(4))
    marked = " or ".join(f"contains(text, '{m}')" for m in (f.PREFIX, f.SUFFIX, f.MIDDLE))
    return rf"""
with texts as (
    select doc_id, coalesce(text, '') as text, sha256('{f.SEED}:' || doc_id) as h,
        regexp_extract_all(coalesce(text, ''), '[ 	-
]*[^ 	-
]+|[ 	-
]+') as units
    from documents
),
drawn as (select *, len(units) as n, {draws} from texts),
cut as (
    select *, least(h1 % (n + 1), h2 % (n + 1)) as low, greatest(h1 % (n + 1), h2 % (n + 1)) as high,
        case when text = '' or {marked} or h3 % 100 >= {f.FIM_PERCENT} then 'plain'
            when h4 % 100 < {f.SUFFIX_FIRST_PERCENT} then 'spm' else 'psm' end as form
    from drawn
),
parts as (
    select *, coalesce(array_to_string(units[1 : low], ''), '') as p,
        coalesce(array_to_string(units[low + 1 : high], ''), '') as m,
        coalesce(array_to_string(units[high + 1 : n], ''), '') as s
    from cut
)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(p)::bigint end as prefix_chars,
    case when form <> 'plain' then length(m)::bigint end as middle_chars,
    sha256(case form when 'plain' then text
        when 'psm' then '{f.PREFIX}' || p || '{f.SUFFIX}' || s || '{f.MIDDLE}' || m
        else '{f.SUFFIX}' || s || '{f.PREFIX}' || p || '{f.MIDDLE}' || m end) as output_sha256,
    sha256(text) as restored_sha256
from parts
"""


def _trie() -> str:
    t = turn_trie
    return rf"""
with recursive turns as (
    select conv_id, turn, length(coalesce(text, ''))::bigint as chars,
        md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as k
    from conversations where conv_id is not null
),
told as (
    select conv_id, list({{'k': k, 'chars': chars}} order by turn nulls first, k) as ts from turns group by conv_id
),
crc_step(b, c, i) as (
    select b, b::bigint, 0 from range(256) r(b)
    union all
    select b, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i + 1 from crc_step where i < 8
),
crc_table as (select list(c order by b) as t from crc_step where i = 8),
mixed as (
    select conv_id, ts, xor(4294967295, list_reduce(
        list_prepend(4294967295::bigint, [ascii(x)::bigint for x in string_split(conv_id::varchar, '')]),
        lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1]))) % {t.SHARED} as h
    from told, crc_table
),
rebuilt as (
    select m.conv_id, coalesce(b.ts[1 : h], []) || m.ts[h + 1 : len(m.ts)] as ts
    from mixed m left join told b on b.conv_id = m.conv_id - m.conv_id % {t.BLOCK}
),
members as (
    select conv_id, d as depth, len(ts) = d as ends, [x.k for x in ts[1 : d]] as path,
        case when d > 0 then ts[d].chars else 0 end as chars
    from (select conv_id, ts, unnest(range(0, len(ts) + 1)) as d from rebuilt)
),
nodes as (
    select path, any_value(depth) as depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(chars) as chars,
        sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256
    from members group by path
),
linked as (
    select n.*, p.conv_id as parent_conv_id from nodes n left join nodes p on n.depth > 0 and p.path = n.path[1 : n.depth - 1]
),
counted as (
    select l.*, coalesce(c.n, 0) as n_children
    from linked l
    left join (select path[1 : depth - 1] as up, count(*) as n from nodes where depth > 0 group by up) c on c.up = l.path
),
above as (
    select path[1 : unnest(range(0, depth + 1))] as top, (n_children = 0)::bigint as leaf, (n_convs - 1) * chars as saved
    from counted
),
below as (select top, sum(leaf) as n_leaves, sum(saved) as saved_tokens from above group by top)
select conv_id, depth::bigint as depth, parent_conv_id, n_convs::bigint as n_convs, n_children::bigint as n_children,
    n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, ends_sha256
from counted join below on top = path
"""


ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": _quality(),
    "op3_exact_dedup": _DEDUP,
    "op4_chat_formatting": _chat(),
    "op9_url_filters": _urls(),
    "op10_ngram_jaccard_join": _NGRAMS,
    "op11_line_dedup": _lines(),
    "op12_fill_in_middle": _middles(),
    "op13_prefix_trie": _trie(),
}
