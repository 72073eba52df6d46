"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tidemark.llm.line_dedup import TO_LINES
from tidemark.llm.quality_rules import STOP_WORDS

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP6 = rf"""
with d as (
  select doc_id, source, len({WORDS})::bigint as size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint as h
  from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (
  select *, 3 * source_size as cap,
         1 + (row_number() over (order by source asc nulls last) - 1) % 3 as weight,
         sum(source_size) over ()::bigint as total
  from s),
l as (
  select *, coalesce(sum(cap) over (order by cap / weight::double, source asc nulls last
                                    rows between unbounded preceding and 1 preceding), 0)::hugeint as cap_before,
         sum(weight) over (order by cap / weight::double, source asc nulls last
                           rows between current row and unbounded following)::hugeint as weight_left
  from w),
c as (select *, cap::hugeint * weight_left <= (total - cap_before) * weight as capped from l),
t as (
  select source, source_size,
         case when capped then cap::double
              else weight::double * (total - sum(case when capped then cap else 0 end) over ())::double
                   / (sum(case when capped then 0 else weight end) over ())::double end as target
  from c),
p as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint as passes from t),
r as (
  select d.doc_id, d.size, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size as left_over,
         sum(d.size) over (partition by d.source order by d.h range unbounded preceding) as upto,
         sum(d.size) over (partition by d.source, d.h) as own
  from d join p on d.source is not distinct from p.source)
select doc_id, size, source_size, target,
       size * (passes + case when passes < 3 and (upto <= left_over
               or (upto - own <= left_over and upto - left_over < left_over - (upto - own))) then 1 else 0 end) as taken
from r
"""


def _lines(column: str) -> str:
    for pattern, replacement in TO_LINES:
        quoted = replacement.replace("'", "''")
        shown = "chr(10)" if quoted == "\n" else f"'{quoted}'"
        column = f"regexp_replace({column}, '{pattern.replace(chr(39), chr(39) * 2)}', {shown}, 'g')"
    return column


OP9 = rf"""
with p as (
  select page_id, lower(coalesce(regexp_extract(url,
           '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)', 1), '')) as host,
         list_filter(string_split(coalesce({_lines('html')}, ''), chr(10)), lambda x: x <> '') as lines
  from pages),
h as (select host, count(*) as host_pages from p group by host),
n as (select host, line, count(*) as n
      from (select host, unnest(list_distinct(lines)) as line from p) group by host, line),
b as (select n.host, list(n.line) as drops from n join h using (host)
      where n.n >= 3 and n.n::double / h.host_pages > 0.1 group by n.host),
k as (
  select p.page_id, p.host, h.host_pages, p.lines,
         list_filter(p.lines, lambda x: not list_contains(coalesce(b.drops, []), x)) as kept
  from p join h using (host) left join b using (host))
select page_id, host, host_pages, len(lines)::bigint as n_lines, (len(lines) - len(kept))::bigint as n_dropped,
       md5(coalesce(array_to_string(kept, chr(10)), '')) as text_md5
from k
"""

_STOPS = ", ".join(f"'{w}'" for w in sorted({w for line in STOP_WORDS.values() for w in line.split()}))
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_EDGE = ".,;:!?()\"''"

OP10 = rf"""
with d as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as text, {WORDS} as words from documents),
g as (
  select rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as gram
  from (select rid, words, unnest(range(1, len(words) - 1)) as i from d)),
m as (select rid, i from (select rid, i, count(*) over (partition by rid, gram) as n from g) where n > 1),
r as (
  select rid, count(distinct j) as n
  from (select rid, unnest([i, i + 1, i + 2]) as j from m) group by rid),
c as (
  select d.rid, doc_id, len(words)::bigint as n_words,
         coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::bigint as word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
         length(translate(translate(text, {_SPACES}, ''), '#*$%&|<>{_EDGE}0123456789-_/\+=@^~`[]{{}}', ''))::bigint
           as n_letters,
         list_filter(string_split(text, chr(10)), lambda x: translate(x, {_SPACES}, '') <> '') as lines,
         len(list_filter(words, lambda w: trim(translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '{_EDGE}') in ({_STOPS})))::bigint as n_stop_words,
         coalesce(r.n, 0)::bigint as n_repeat_words
  from d left join r using (rid)),
v as (
  select *, len(lines)::bigint as n_lines, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
         n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed
  from c),
x as (
  select *, concat_ws(',',
    case when n_words < 50 or n_words > 1000000 then 'n_words' end,
    case when n_words > 0 and (word_chars::double / n_words < 2 or word_chars::double / n_words > 14)
         then 'mean_word_chars' end,
    case when n_words > 0 and n_symbols::double / n_words > 0.1 then 'symbol_ratio' end,
    case when word_chars > 0 and n_letters::double / word_chars < 0.6 then 'alpha_ratio' end,
    case when n_words > 0 and n_stop_words::double / n_words < 0.02 then 'stop_word_ratio' end,
    case when n_lines > 0 and n_dup_lines::double / n_lines > 0.5 then 'dup_line_ratio' end,
    case when n_words > 0 and n_repeat_words::double / n_words > 0.5 then 'repeat_word_ratio' end) as broken_rules
  from v)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and broken_rules = '' as kept, n_lines, n_stop_words, n_letters, broken_rules
from x
"""


def _crc32(text: str) -> str:
    """Unsigned crc32 of an ASCII string, bit by bit (reflected polynomial 0xEDB88320)."""
    step = "list_reduce(list_concat([xor(s, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda t, z: xor(t >> 1, (t & 1) * 3988292384))"
    return (f"xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split({text}, ''), "
            f"lambda c: ascii(c)::bigint)), lambda s, b: {step}), 4294967295)")


def _field(column: str) -> str:
    return f"case when {column} is null then '-' else strlen({column}::varchar)::varchar || ':' || {column}::varchar end"


def _tree(name: str, levels: int) -> str:
    """Levels 1, 2, ... over {name}0 (tree, rank, total, digest) and the runs {name}r0, ... of eight digests in order."""
    out = []
    for k in range(levels):
        out.append(f"""
{name}r{k} as (select tree, total, rank // 8 as rank, list(digest order by rank) as run from {name}{k}
  where (total + {8 ** k - 1}) // {8 ** k} > 1 group by all),
{name}{k + 1} as (select tree, rank, total, sha256(array_to_string(run, '')) as digest from {name}r{k})""")
    tops = " union all ".join(f"select tree, digest from {name}{k} where (total + {8 ** k - 1}) // {8 ** k} = 1"
                              for k in range(levels + 1))
    return ",".join(out) + f",\n{name}_top as ({tops})"


def _climb(name: str, source: str, levels: int) -> str:
    """{name}p{k}: rows of ``source`` (tree, rank, f, proof) with f folded and proof grown over k levels."""
    out, last = [], source
    for k in range(levels):
        at = f"(x.rank // {8 ** k} % 8)::int"
        left, right = f"array_to_string(r.run[1:{at}], '')", f"array_to_string(r.run[{at} + 2:], '')"
        out.append(f"""
{name}p{k + 1} as (select x.* replace (
    case when r.run is null then x.f else sha256({left} || x.f || {right}) end as f,
    case when r.run is null then x.proof else x.proof || {left} || {right} end as proof)
  from {last} x left join {name}r{k} r on r.tree is not distinct from x.tree and r.rank = x.rank // {8 ** (k + 1)})""")
        last = f"{name}p{k + 1}"
    return ",".join(out)


_PLAIN = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))
OP12 = f"""
with d as (
  select doc_id, lang as tree, sha256({_PLAIN} || {_field('text')}) as leaf,
         case when {_crc32('doc_id::varchar')} % 3 = 0
              then sha256({_PLAIN} || {_field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) end as tampered
  from documents),
l as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as rank, count(*) over (partition by tree) as total
  from d),
a0 as (select tree, rank, total, leaf as digest from l),{_tree('a', 8)},
b0 as (
  select 0 as tree, row_number() over (order by tree nulls first) - 1 as rank, count(*) over () as total, tree as part, digest
  from a_top),{_tree('b', 5)},
w as (
  select l.doc_id, l.leaf, l.tree, l.rank, coalesce(l.tampered, l.leaf) as f, '' as proof, b0.digest as subroot, b0.rank as part_rank
  from l join b0 on b0.part is not distinct from l.tree),{_climb('a', 'w', 8)},
u as (select doc_id, leaf, subroot, 0 as tree, part_rank as rank, f, proof from ap8),{_climb('b', 'u', 5)}
select doc_id, leaf, subroot, b_top.digest as root, sha256(proof) as proof_sha256, f as folded_root, f = b_top.digest as verified
from bp5, b_top
"""


def _moves11(state: int) -> str:
    """Ways to take one message from a state, as SQL rows (state, audit, cost, to, needed initial, or * for any)."""
    after, rows, at = {0: 2, 1: 2, 2: 3, 3: 2}, [], state
    for n in range(3):
        rows.append((state, "I" * n + "D", 2 * n + 3, at, "d"))
        rows.append((state, "I" * n + "R", 2 * n + 2, after[at], "r"))
        rows += [(state, "I" * n + "K", 2 * n, to, initial) for initial, to in {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[at].items()]
        at = after[at]
    return ", ".join(f"({s}, '{a}', {c}, {t}, '{i}')" for s, a, c, t, i in rows)


OP11 = rf"""
with recursive g as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         {_crc32("(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))")} % 20 as way
  from conversations),
d as (
  select conv_id, turn, case when way = 4 then 'user' else role end as role,
         case when way = 1 then '' when way = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from g, (values (0), (1)) c(copy) where way <> 0 and (copy = 0 or way = 3)),
o as (
  select *, sha256(role || chr(0) || text) as sign,
         row_number() over (partition by conv_id order by turn nulls first, sha256(role || chr(0) || text)) as n,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as final
  from d),
f as (
  select *, final = '' as blank, final <> '' and row_number() over (partition by conv_id, sign order by n) > 1 as duplicate,
         coalesce(left(role, 1), '') as initial
  from o),
r as (
  select *, not blank and not duplicate and final not in ('.', '!', '?') as truncated,
         lag(initial) over (partition by conv_id order by n) || initial as pair,
         count(*) over (partition by conv_id) as length
  from f),
m as (select * from (values {", ".join(_moves11(s) for s in range(4))}) t(state, edits, cost, after, needs)),
w as (
  select distinct conv_id, length, 0::bigint as n, 0 as state, 0::bigint as cost, '' as audit, [''] as said from r
  union all
  select conv_id, length, n, after, min(cost), min_by(audit, (cost, audit)), min_by(said, (cost, audit))
  from (
    select w.conv_id, w.length, r.n, m.after, w.audit || m.edits as audit,
           w.cost + m.cost + case when r.truncated and not suffix(m.edits, 'D') then 1 else 0 end as cost,
           list_concat(w.said, list_transform(range(len(m.edits)), lambda i:
             case when m.edits[i + 1] = 'D' then null
                  when m.edits[i + 1] = 'K' then r.role || ':' || r.text
                  else case when (case when w.state = 2 then 1 else 0 end + i) % 2 = 0 then 'user:' else 'assistant:' end
                       || case when m.edits[i + 1] = 'R' then r.text else '' end end)) as said
    from w join r on r.conv_id is not distinct from w.conv_id and r.n = w.n + 1
    join m on m.state = w.state and (m.needs = 'd' or not (r.blank or r.duplicate) and (m.needs = 'r' or m.needs = r.initial)))
  group by conv_id, length, n, after),
e as (
  select conv_id, w.cost + x.cost as cost, audit || x.edits as audit, list_concat(w.said, x.said) as said
  from w join (values (0, '', 0, []::varchar[]), (1, 'II', 4, ['user:', 'assistant:']), (2, 'I', 2, ['assistant:']), (3, '', 0, []::varchar[]))
    x(state, edits, cost, said) on x.state = w.state
  where n = length),
b as (select conv_id, min(cost) as cost, min_by(audit, (cost, audit)) as audit, min_by(said, (cost, audit)) as said from e group by conv_id),
s as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, sum(blank::bigint) as blank,
         sum(duplicate::bigint) as duplicate, sum(truncated::bigint) as truncated,
         sum(coalesce(pair not in ('su', 'ua', 'au'), false)::bigint) as illegal
  from r group by conv_id)
select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
       coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(b.cost, 0)::bigint as cost,
       coalesce(audit, '') as audit,
       sha256(coalesce(array_to_string(list_filter(said[2:], lambda x: x is not null), chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join s on s.conv_id is not distinct from c.conv_id left join b on b.conv_id is not distinct from c.conv_id
"""

ORACLES = {"op6_mix": OP6, "op9_line_dedup": OP9, "op10_quality": OP10, "op11_conversations": OP11, "op12_merkle": OP12}
