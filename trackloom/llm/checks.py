"""SQL that gives the expected rows of the queries that SQL can express, written on its own."""

from .queries import ODD_TEXT
from .urls import RULES, SOFT_TERMS, STRICT_TERMS

_LINES = r"""
with recursive given as (select distinct doc_id, text, string_split(text, chr(10)) as own from documents where text is not null),
lines as (select doc_id, text, unnest(range(len(own))) as n, unnest(own) as line from given),
split as (select *, list_filter(regexp_split_to_array(line, '\s+'), lambda x: x <> '') as own from lines),
parsed as materialized (
    select doc_id, text, n,
           case when len(own) < 4 then own
                else list_transform(own, lambda x: case when regexp_matches(x, '[0-9]') then '<*>' else x end) end as words
    from split where len(own) > 0),
different as (select row_number() over () as w, words, len(words) as size, len(words) // 5 as block
              from (select distinct words from parsed)),
keyed as materialized (
    select w, size, j, words[1:j * block] as before, words[(j + 1) * block + 1:size] as behind
    from (select *, unnest(range((size + block - 1) // block)) as j from different where block > 0)),
linked as materialized (
    select w, min(w) over (partition by size, j, before, behind) as hub from keyed),
links as materialized (
    select w as a, hub as b from linked where w <> hub union select hub, w from linked where w <> hub),
reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on l.a = r.b),
named as (
    select p.doc_id, p.text, p.n, least(d.w, coalesce(t.least_w, d.w)) as template
    from parsed p join different d on d.words = p.words
    left join (select a, min(b) as least_w from reach group by a) t on t.a = d.w),
places as (select distinct template, doc_id, text from named),
recurring as (
    select template, first(struct_pack(d := doc_id, t := text) order by doc_id nulls last) as place
    from places group by template having count(*) >= 2),
dropped as (
    select n.doc_id, n.text, n.n from named n join recurring r on r.template = n.template
    where not (n.doc_id is not distinct from r.place.d and n.text = r.place.t)),
kept as (
    select l.doc_id, l.text, count(*) as lines, count(d.n) as dropped_lines,
           coalesce(string_agg(l.line, chr(10) order by l.n) filter (where d.n is null), '') as left_text
    from lines l left join dropped d
    on d.doc_id is not distinct from l.doc_id and d.text = l.text and d.n = l.n group by l.doc_id, l.text)
select d.doc_id, coalesce(k.lines, 0) as lines, coalesce(k.dropped_lines, 0) as dropped_lines, k.left_text as text
from documents d left join kept k on k.doc_id is not distinct from d.doc_id and k.text = d.text"""

_JACCARD = r"""
with recursive given as (
    select row_number() over () as r, doc_id, text,
           regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') as w from documents),
shingles as (
    select distinct r, unnest([array_to_string(w[i:i + 4], ' ') for i in range(1, greatest(len(w) - 3, 2))]) as s
    from given where len(w) > 0
    union all select r, chr(1) || text from given where len(w) = 0),
sizes as (select r, count(*) as n from shingles group by r),
both_have as (
    select a.r as a, b.r as b, count(*) as n from shingles a join shingles b on a.s = b.s and a.r < b.r group by 1, 2),
linked as (
    select c.a, c.b from both_have c join sizes x on x.r = c.a join sizes y on y.r = c.b
    where c.n >= 0.8 * (x.n + y.n - c.n) - 1e-9),
links as (select a, b from linked union all select b, a from linked),
reach as (select r, r as o from given union select reach.r, l.b from reach join links l on l.a = reach.o),
classes as (select reach.r, min(g.doc_id) as class_id from reach join given g on g.r = reach.o group by 1),
counts as (select a as r, count(*) as n from links group by 1)
select g.doc_id, c.class_id, coalesce(n.n, 0) as links
from given g join classes c on c.r = g.r left join counts n on n.r = g.r"""

_ESCAPED = r"regexp_replace({c}, '<(\\*)(turn>|body>|/turn>)', '<\\\1\2', 'g')"

_CHAT = f"""
with given as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '{ODD_TEXT}' union all select -7, 1, 'assistant', '{ODD_TEXT}')
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text)
                       filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(20 + length({_ESCAPED.format(c='role')}) + length({_ESCAPED.format(c='text')})) as bigint)
           as formatted_chars
from given group by conv_id"""

#: the table of crc32, bit by bit, and the checksum of a list of bytes
_CRC_TABLE = """
crc_table as (
    select list(list_reduce(list_prepend(b, range(8)),
                            lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by b) as crcs
    from range(256) r(b))"""


def _crc(data: str) -> str:
    return (
        f"xor(list_reduce(list_prepend(4294967295, {data}), "
        "lambda c, b: xor(crcs[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"
    )


_ASCII = "list_transform(string_split({s}, ''), lambda x: cast(ord(x) as bigint))"
_LATIN = (
    "flatten(list_transform(string_split({s}, ''), lambda x: case when ord(x) < 128 then [cast(ord(x) as bigint)] "
    "else [cast(195 as bigint), cast(ord(x) - 64 as bigint)] end))"
)

_RUNS = rf"""
with {_CRC_TABLE},
given as (
    select row_number() over () as r, doc_id, h, h // 10 as g,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
    from (select doc_id, text, {_crc(_ASCII.format(s="cast(doc_id as varchar)"))} as h from documents, crc_table)),
placed as (
    select r, len(w) as n, h % 10 = 0 and len(w) > 0 as planted,
           case when len(w) > 0 then g % len(w) end as a,
           case when len(w) > 0 then 1 + (len(w) - g % len(w)) // (3 + g % 8) end as p
    from given),
own as (select r, unnest(range(len(w))) as i, unnest(w) as word from given),
moved as materialized (
    select r, n, i, case when planted and i >= a then a + (i - a) % p else i end as j
    from (select *, unnest(range(n)) as i from placed)),
words as materialized (select m.r, m.n, m.i, y.word from moved m join own y on y.r = m.r and y.i = m.j),
grams as (select r, n, gram, list(i) as spots
          from (select r, n, i, word || ' ' || lead(word, 1) over o || ' ' || lead(word, 2) over o || ' '
                       || lead(word, 3) over o || ' ' || lead(word, 4) over o as gram
                from words window o as (partition by r order by i))
          where gram is not null group by r, n, gram having count(*) > 1),
firsts as (select r, n, spots, unnest(spots) as i from grams),
periods as (select distinct r, q from (select r, n, i, unnest(spots) - i as q from firsts) where q > 0 and 4 * q <= n),
same as (
    select p.r, p.q, a.i, a.i - row_number() over (partition by p.r, p.q order by a.i) as island
    from periods p join words a on a.r = p.r join words b on b.r = p.r and b.i = a.i + p.q and b.word = a.word),
stretches as (
    select r, q, min(i) as start, count(*) + q as length from same group by r, q, island
    having count(*) + q >= greatest(6, 4 * q)),
runs as materialized (select r, start, length, min(q) as period from stretches group by r, start, length),
listed as (
    select r, count(*) as n_runs,
           string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as text
    from runs group by r),
best as (
    select * from runs u
    qualify row_number() over (partition by r order by cast(1000000000000 as hugeint) * length // period desc, start, period) = 1),
dropped as (select distinct r, unnest(range(start + period, start + length)) as i from runs),
kept as (
    select x.r, string_agg(x.word, ' ' order by x.i) as text
    from words x left join dropped d on d.r = x.r and d.i = x.i where d.r is null group by x.r)
select d.doc_id, coalesce(l.n_runs, 0) as n_runs, b.start, b.length, b.period,
       1000 * b.length // b.period as exponent_milli,
       sha256(coalesce(l.text, '')) as runs_sha256, sha256(coalesce(k.text, '')) as collapsed_sha256
from given d left join listed l on l.r = d.r left join best b on b.r = d.r left join kept k on k.r = d.r"""

_VARIANTS = rf"""
with recursive {_CRC_TABLE},
found as (
    select cast(doc_id as varchar) as id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[A-Za-z\x{{C0}}-\x{{FF}}]+')) as run from documents),
counted as (select id, run, count(*) as n from found group by all),
hashed as (select run, n, {_crc(f"list_concat({_ASCII.format(s='id')}, [58], {_LATIN.format(s='run')})")} as h from counted, crc_table),
damaged as (
    select case when h % 97 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n
    from hashed),
words as (
    select word, cast(sum(n) as bigint) as n from damaged where length(word) >= 5 group by word having sum(n) >= 3),
rests as (
    select word, spot, substr(word, 1, spot - 1) || substr(word, spot + 1) as rest
    from (select word, unnest(range(1, length(word) + 1)) as spot from words)),
near as (
    select a.word as a, b.word as b from rests a join rests b on a.spot = b.spot and a.rest = b.rest and a.word <> b.word
    union select r.word, w.word from rests r join words w on w.word = r.rest
    union select w.word, r.word from rests r join words w on w.word = r.rest),
ranked as (
    select a, b, w.n, count(*) over (partition by a) as n_near,
           row_number() over (partition by a order by w.n desc, encode(b)) as place
    from near join words w on w.word = b),
forms as (
    select w.word, w.n, coalesce(r.n_near, 0) as n_near,
           case when r.n >= 2 * w.n then r.b end as form, case when r.n >= 2 * w.n then r.n end as form_n
    from words w left join ranked r on r.a = w.word and r.place = 1),
ways as (
    select word, word as root, form as next from forms
    union all select y.word, f.word, f.form from ways y join forms f on f.word = y.next)
select f.word, f.form, y.root, f.n, f.n_near, f.form_n from forms f join ways y on y.word = f.word and y.next is null"""

_URLS = rf"""
with rules(rule_host, rule_path, says) as (values {", ".join(map(str, RULES))}),
terms(term, weight) as (values {", ".join(str((t, 2)) for t in STRICT_TERMS)}, {", ".join(str((t, 1)) for t in SOFT_TERMS)}),
given as (
    select row_number() over () as r, page_id, url,
           translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lowered,
           case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
    from pages),
parts as (
    select *, regexp_extract(rest, '^[^/?#]*') as own_host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from given),
hosts as (
    select *, translate(own_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host from parts),
ruled as (
    select p.r, u.rule_host || u.rule_path as rule, u.says from hosts p join rules u
    on (p.host = u.rule_host or ends_with(p.host, '.' || u.rule_host)) and starts_with(p.path, u.rule_path)
    qualify row_number() over (partition by p.r order by length(rule_host) + length(rule_path) desc, length(rule_host) desc) = 1),
weights as (
    select p.r, sum(t.weight) as weight
    from (select r, chr(1) || regexp_replace(lowered, '([^\p{{L}}\p{{N}}])', chr(1) || '\1' || chr(1), 'g') || chr(1) as cut from hosts) p
    join (select weight, chr(1) || regexp_replace(term, '([^\p{{L}}\p{{N}}])', chr(1) || '\1' || chr(1), 'g') || chr(1) as cut from terms) t
    on contains(p.cut, t.cut) group by p.r)
select p.page_id, p.host, p.path, u.rule, cast(coalesce(w.weight, 0) as int) as weight,
       coalesce(u.says, case when w.weight >= 2 then 'block' else 'allow' end) as verdict
from hosts p left join ruled u on u.r = p.r left join weights w on w.r = p.r"""

LLM_ORACLES = {
    "op2_lines": _LINES, "op7_jaccard": _JACCARD, "op9_chat": _CHAT, "op11_runs": _RUNS, "op12_variants": _VARIANTS,
    "op13_urls": _URLS,
}
