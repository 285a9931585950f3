"""DuckDB SQL for the operators that SQL can express, over whole tables."""

from __future__ import annotations

from .lines import BOILERPLATE, GOOD_END, MARKED, SEPARATORS, TAIL


def _text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _char_class(pattern: str) -> str:
    """A pattern with its escapes beyond ASCII spelled as the characters themselves."""
    for code in ("2026", "3002", "00BB", "201D", "2019", "203A", "2022"):
        pattern = pattern.replace("\\u" + code, chr(int(code, 16)))
    return _text(pattern)


_WORD = _text(r"[^\x20\x09-\x0D]+")
_PHRASES = " or ".join(f"contains(low, {_text(p)})" for p in BOILERPLATE)

LINES = f"""
with d as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text from documents
), w as (
  select r, doc_id, text, regexp_extract_all(text, {_WORD}) as words,
         list_filter(string_split(text, chr(10)), lambda s: regexp_matches(s, '[^\\x20\\x09-\\x0D]')) as lines
  from d
), win as (
  select r, unnest(range(1, len(words) - 1)) as i, words from w where len(words) >= 3
), counted as (
  select r, i, count(*) over (partition by r, words[i], words[i + 1], words[i + 2]) as c from win
), covered as (
  select r, count(distinct i + k) as n
  from counted, (select unnest([0, 1, 2]) as k) where c > 1 group by r
), l as (
  select r, line, lower(line) as low, len(regexp_extract_all(line, {_WORD})) as words
  from (select r, unnest(lines) as line from w)
), judged as (
  select r, line,
    case when {_PHRASES} then 'boilerplate'
         when len(regexp_extract_all(line, {_char_class(SEPARATORS)})) >= greatest(2, 0.2 * words) then 'navigation'
         when words >= 3 and (not regexp_matches(right(line, {TAIL}), {_char_class(GOOD_END)})
              or len(regexp_extract_all(line, {_char_class(MARKED)})) > 0.3 * words) then 'punctuation'
    end as rule
  from l
), sums as (
  select r, sum(len(line)) filter (rule is not null) as lost, sum(len(line)) as all_chars,
         count(*) filter (rule = 'boilerplate') as b, count(*) filter (rule = 'navigation') as n,
         count(*) filter (rule = 'punctuation') as p
  from judged group by r
), out as (
  select doc_id, len(words)::bigint as n_words,
         len(array_to_string(words, ''))::bigint as word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
         coalesce(covered.n, 0)::bigint as n_repeat_words,
         coalesce(lost, 0)::bigint as lost_chars, coalesce(all_chars, 0) as all_chars,
         coalesce(b, 0)::bigint as n_boilerplate, coalesce(sums.n, 0)::bigint as n_navigation,
         coalesce(p, 0)::bigint as n_punctuation,
         coalesce((select string_agg(j.line, chr(10) order by j.k) from
           (select line, rule, row_number() over () as k from judged x where x.r = w.r) j where j.rule is null), '') as clean
  from w left join covered using (r) left join sums using (r)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and lost_chars <= 0.5 * all_chars as kept,
       lost_chars, n_boilerplate, n_navigation, n_punctuation, sha256(clean) as clean_sha256
from out
"""

_SHINGLES = f"""
  select id, list_distinct(case
      when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s
  from (select id, regexp_extract_all(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORD}) as w
        from %s)
"""

JACCARD = f"""
with recursive sets as ({_SHINGLES % "(select doc_id as id, text from documents)"}),
x as (select id, len(s) as n, unnest(s) as t from sets),
pairs as (
  select a.id as a, b.id as b, count(*) as c, any_value(a.n) as n, any_value(b.n) as m
  from x a join x b on a.t = b.t and a.id <> b.id group by 1, 2
),
links as (select a, b from pairs where 100 * c >= 75 * (n + m - c)),
reach(id, to_id) as (
  select id, id from sets union select reach.id, links.b from reach join links on reach.to_id = links.a
)
select sets.id as doc_id, len(sets.s)::bigint as n_shingles, min(to_id) as component_id
from sets join reach using (id) group by sets.id, len(sets.s)
"""

_LOW_WORDS = f"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORD})"""

CONTAINED = f"""
with d as ({_SHINGLES % "(select doc_id as id, text from documents)"}),
i as ({_SHINGLES % "(select item_id as id, text from benchmark)"}),
long as (select item_id as id from benchmark where len({_LOW_WORDS}) >= 5),
dx as (select id, unnest(s) as t from d),
ix as (select id, len(s)::bigint as n, unnest(s) as t from i where id in (select id from long))
select dx.id as doc_id, ix.id as item_id, any_value(n) as n_item, count(*)::bigint as n_shared,
       count(*)::double / any_value(n) as containment
from dx join ix using (t) group by dx.id, ix.id having 4 * count(*) >= 3 * any_value(n)
union all
select doc_id, item_id, 1::bigint, 1::bigint, 1.0::double
from (select item_id, ' ' || array_to_string({_LOW_WORDS}, ' ') || ' ' as w from benchmark
      where len({_LOW_WORDS}) between 1 and 4) a
join (select doc_id, ' ' || array_to_string({_LOW_WORDS}, ' ') || ' ' as w from documents) b on contains(b.w, a.w)
"""

_TERM = _text(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_TERMS = f"""
  select row, id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_TERM})) as term
  from (select row_number() over () as row, %s as id, text from %s)
"""

RANKED = f"""
with dt as ({_TERMS % ("doc_id", "documents")}),
it as ({_TERMS % ("item_id", "benchmark")}),
f as (select row, id, term, count(*) as tf from dt group by row, id, term),
d as (select row, sum(tf)::bigint as n from f group by row),
total as (select count(*) as docs, sum(n)::bigint as terms from d),
w as (select term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::bigint as w
      from (select term, count(*) as df from f group by term), total),
m as (select row, 100 - 25 + ((25 * n * docs) // terms) as m from d, total),
q as (select row as item_row, id as item_id, term, count(*) as repeats from it group by row, id, term),
s as (
  select item_row, item_id, f.row, f.id as doc_id,
         sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
  from q join f using (term) join w using (term) join m on f.row = m.row
  group by item_row, item_id, f.row, f.id
), r as (
  select *, row_number() over (partition by item_row order by score desc, doc_id nulls first) as rank
  from s where score > 0
)
select item_id, rank::int as rank, doc_id, score from r where rank <= 20
"""

ORACLES = {
    "op2_line_cleaning": LINES,
    "op5_jaccard_join": JACCARD,
    "op6_decontamination": CONTAINED,
    "op12_ranked_search": RANKED,
}
