"""The operators' results in DuckDB SQL, where it can express them."""

from __future__ import annotations

from degraus.llm.collocations import LEAST, LONGEST, MOST_RANKED
from degraus.llm.filter_audit import (
    FILTERS,
    LEAST_DISTINCT_PERCENT,
    LEAST_WORDS,
    MOST_CAPITALS_PERCENT,
)
from degraus.llm.filter_audit import SYMBOLS as FILTER_SYMBOLS
from degraus.llm.quality_rules import PHRASES, SENTENCE_MARKS, SEPARATORS, SYMBOLS, LineRules

_LIMITS = LineRules()
_WORD = r"[^\x20\x09-\x0D]+"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


OP1 = rf"""
with docs as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
words as (select r, doc_id, t, regexp_extract_all(t, {_text(_WORD)}) as w from docs),
windows as (
    select r, i, [w[i], w[i + 1], w[i + 2]] as g
    from (select r, w, unnest(range(1, len(w) - 1)) as i from words)),
again as (select r, i from (select r, i, count(*) over (partition by r, g) as n from windows) where n > 1),
covered as (
    select r, count(distinct p) as n_repeat_words
    from (select r, unnest([i, i + 1, i + 2]) as p from again) group by r),
split as (select r, unnest(string_split(t, chr(10))) as line from docs),
counted as (
    select r, line, length(line) as n, len(regexp_extract_all(line, {_text(SYMBOLS)})) as symbols,
        length(line) - length(replace(line, '!!', '')) as shouted
    from split where regexp_matches(line, {_text(_WORD)})),
ruled as (
    select r, line, n, symbols, case
        when len(regexp_extract_all(line, {_text(SEPARATORS)})) >= {_LIMITS.separators} then 'navigation'
        when regexp_matches(line, {_text(PHRASES)}) then 'boilerplate'
        when not regexp_matches(line, {_text(SENTENCE_MARKS)})
            or greatest(symbols, shouted) * 100 > n * {_LIMITS.marks_per_hundred} then 'punctuation'
        else 'kept' end as rule
    from counted),
lines as (
    select r, sum(symbols) as n_symbols, count(*) - count(distinct line) as n_dup_lines, count(*) as n_lines,
        count(*) filter (rule = 'punctuation') as n_punctuation, count(*) filter (rule = 'navigation') as n_navigation,
        count(*) filter (rule = 'boilerplate') as n_boilerplate, sum(n) as line_chars,
        coalesce(sum(n) filter (rule = 'kept'), 0) as kept_chars
    from ruled group by r),
facts as (
    select doc_id, len(w)::bigint as n_words, coalesce(list_sum([length(x) for x in w]), 0)::bigint as word_chars,
        coalesce(n_symbols, 0)::bigint as n_symbols, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
        coalesce(n_repeat_words, 0)::bigint as n_repeat_words, coalesce(n_lines, 0)::bigint as n_lines,
        coalesce(n_punctuation, 0)::bigint as n_punctuation, coalesce(n_navigation, 0)::bigint as n_navigation,
        coalesce(n_boilerplate, 0)::bigint as n_boilerplate, coalesce(line_chars, 0)::bigint as line_chars,
        coalesce(kept_chars, 0)::bigint as kept_chars
    from words left join covered using (r) left join lines using (r))
select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    not (n_words < 50 or 100 * n_repeat_words > 50 * n_words)
        and 100 * (line_chars - kept_chars) <= {_LIMITS.most_lost_percent} * line_chars as kept
from facts
"""

OP11 = rf"""
with pieces as (
    select row_number() over () as p, lang, regexp_extract_all(piece, '[^\x20\x09]+') as w
    from (
        select coalesce(lang, 'und') as lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) as piece
        from documents)),
placed as (select lang, w, unnest(range(1, len(w) + 1)) as i from pieces),
grams as (
    select lang, list_aggregate(w[i : i + m - 1], 'string_agg', ' ') as phrase, m
    from placed, (select unnest(range(1, {LONGEST} + 1)) as m) where i + m - 1 <= len(w)),
counts as (select lang, phrase, m, count(*) as a from grams group by all),
sizes as (select lang, sum(a) as n from counts where m = 1 group by lang),
candidates as (select lang, phrase, m, a, string_split(phrase, ' ') as w from counts where m > 1 and a >= {LEAST}),
inside as (
    select lang, array_to_string(w[1 + x : m - 1 + x], ' ') as phrase, max(a) as longer
    from candidates, (select unnest([0, 1]) as x) group by all),
cuts as (
    select c.lang, c.phrase, c.a, n, k, array_to_string(w[1 : k], ' ') as first, array_to_string(w[k + 1 : m], ' ') as rest
    from candidates c join sizes using (lang) left join inside i on c.lang = i.lang and c.phrase = i.phrase,
        (select unnest(range(1, {LONGEST})) as k)
    where k < m and (longer is null or 100 * longer < 100 * c.a)),
scored as (
    select c.lang, c.phrase, c.a, l.a as l, r.a as r, n, k,
        ((1000::hugeint * c.a * n::hugeint) // (l.a::hugeint * r.a))::bigint as score
    from cuts c join counts l on l.lang = c.lang and l.phrase = first join counts r on r.lang = c.lang and r.phrase = rest),
lowest as (
    select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
ranked as (
    select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r,
        n::bigint as n, score
    from lowest)
select * from ranked where rank <= {MOST_RANKED}
"""

_LETTERS = ", ".join(f"('{x}', {1 << i})" for i, x in enumerate(FILTERS))
OP12 = rf"""
with docs as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents),
firsts as (select t, min(doc_id) as low from docs group by t),
marked as (
    select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic
    from labels group by doc_id),
worded as (select *, regexp_extract_all(t, {_text(_WORD)}) as w from docs),
masks as (
    select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
        (case when len(w) < {LEAST_WORDS} then 1 else 0 end)
        + (case when 100 * len(list_distinct(w)) < {LEAST_DISTINCT_PERCENT} * len(w) then 2 else 0 end)
        + (case when 100 * len(regexp_extract_all(t, '[A-Z]')) > {MOST_CAPITALS_PERCENT} * length(t) then 4 else 0 end)
        + (case when regexp_matches(t, {_text(FILTER_SYMBOLS)}) then 8 else 0 end)
        + (case when doc_id > low then 16 else 0 end) as mask
    from worded join firsts using (t) left join marked using (doc_id)),
cells as (
    select part, mask, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
    from masks group by part, mask),
letters(f, bit) as (values {_LETTERS}),
orders as (
    select a.f || b.f || c.f || d.f || e.f as filter_order
    from letters a, letters b, letters c, letters d, letters e
    where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
steps as (
    select filter_order, step, bit,
        (select coalesce(sum(e.bit), 0)::bigint from letters e where instr(filter_order, e.f) < step) as before
    from orders, (select unnest(range(1, 6)) as step) join letters on f = filter_order[step]),
effects as (
    select part, filter_order, step::int as step, bit,
        coalesce(sum(n) filter (mask & (before | bit) = 0), 0)::bigint as kept,
        coalesce(sum(n) filter (mask & before = 0 and mask & bit <> 0), 0)::bigint as removed,
        coalesce(sum(n) filter (mask & before <> 0 and mask & bit <> 0), 0)::bigint as redundant,
        coalesce(sum(n) filter (mask = bit), 0)::bigint as unique_fails,
        coalesce(sum(good) filter (mask & before = 0 and mask & bit <> 0), 0)::bigint as good_lost,
        coalesce(sum(toxic) filter (mask & before = 0 and mask & bit <> 0), 0)::bigint as toxic_lost
    from cells, steps group by part, filter_order, step, bit)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) over (partition by part, bit))::bigint as shapley
from effects
"""

ORACLE_SQL = {"op1_quality_rules": OP1, "op11_collocations": OP11, "op12_filter_audit": OP12}
