"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

from tillroll.llm import preference, quality_rules

_BLANK = r"\x20\x09-\x0D"


def _count(text: str, pattern: str) -> str:
    return f"(length({text}) - length(regexp_replace({text}, '{pattern}', '', 'g')))"


_QUALITY = f"""with docs as (
    select row_number() over () as r, doc_id, coalesce(text, '') as text,
           regexp_extract_all(coalesce(text, ''), '[^{_BLANK}]+') as words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^{_BLANK}]')) as lines
    from documents
),
windows as (
    select r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as shingle
    from (select r, words, unnest(range(1, len(words) - 1)) as i from docs)
),
repeats as (select r, i from (select *, count(*) over (partition by r, shingle) as n from windows) where n > 1),
covered as (
    select r, count(distinct place) as n from (select r, unnest([i, i + 1, i + 2]) as place from repeats) group by r
),
numbered as (select r, unnest(lines) as line, unnest(range(len(lines))) as i from docs),
judged as (
    select r, length(line) as chars,
           {_count('line', quality_rules.SYMBOLS)} > {quality_rules.MAX_SYMBOLS}::double * length(line)
           or {_count('line', '!')} > {quality_rules.MAX_EXCLAMATIONS}::double * length(line)
           or {_count('line', '[|»›]')} > {quality_rules.MAX_SEPARATORS}::double * length(line)
           or (length(line) <= {quality_rules.NOTICE_CHARS} and regexp_matches(line, '{quality_rules.NOTICES}')) as fails
    from (
        select distinct r, line, case when length(line) < {quality_rules.DUPLICATE_CHARS} then i end as i from numbered
    )
),
stays as (select r, sum(chars) as chars from judged where not fails group by r),
totals as (select r, sum(length(line)) as chars from numbered group by r),
measured as (
    select doc_id, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
           {_count('text', quality_rules.SYMBOLS)} as n_symbols,
           len(lines) - len(list_distinct(lines)) as n_dup_lines,
           coalesce(covered.n, 0) as n_repeat_words,
           case when totals.chars > 0 then 1 - coalesce(stays.chars, 0)::double / totals.chars::double else 0 end as lost
    from docs left join covered using (r) left join stays using (r) left join totals using (r)
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
       n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed, lost::double as lost,
       not base_failed and lost <= {quality_rules.MAX_LOST}::double as kept
from (
    select *, n_words < {quality_rules.MIN_WORDS}
              or 100 * n_repeat_words > {quality_rules.MAX_REPEATED_PERCENT} * n_words as base_failed
    from measured
)"""

_AHEAD = len(preference.OPENING) + len(preference.MIDDLE)


def _literal(text: str) -> str:
    return "'" + text.replace("\n", "' || chr(10) || '") + "'"


def _of_side(side: str) -> str:
    return f"""select pair_id, string_agg(piece, '' order by place) as {side},
        string_agg((upto - length(piece) + {_AHEAD} + length(role))::bigint || '-' || upto::bigint, ';' order by place)
            filter (where role = '{preference.TRAINED}') as {side}_mask
    from ended where side = '{side}' group by pair_id"""


_PREFERENCE = f"""with pairs as (
    select id // 2 as pair_id, max(id) filter (where id % 2 = 0) as chosen_id,
           max(id) filter (where id % 2 = 1) as rejected_id
    from (select distinct conv_id::bigint as id from conversations where conv_id is not null) group by 1
),
numbered as (
    select conv_id::bigint as id, coalesce(role, '') as role, coalesce(text, '') as text,
           row_number() over (
               partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as place
    from conversations where conv_id is not null
),
sides as (
    select pair_id, 'chosen' as side, chosen_id as id from pairs
    union all select pair_id, 'rejected', rejected_id from pairs
),
said as (
    select pair_id, side, place, role,  text,
           {_literal(preference.OPENING)} || role || {_literal(preference.MIDDLE)} || text
           || {_literal(preference.CLOSING)} as piece
    from sides join numbered using (id)
),
matched as (
    select c.pair_id, c.place from said as c join said as r on c.pair_id = r.pair_id and c.place = r.place
    where c.side = 'chosen' and r.side = 'rejected' and c.role = r.role and c.text = r.text
),
shared as (
    select pair_id, count(*) as n
    from (select pair_id, place, row_number() over (partition by pair_id order by place) as k from matched)
    where place = k group by pair_id
),
placed as (select said.*, coalesce(n, 0) as n from said left join shared using (pair_id)),
prompts as (
    select pair_id, string_agg(piece, '' order by place) as prompt
    from placed where side = 'chosen' and place <= n group by pair_id
),
ended as (
    select *, sum(length(piece)) over (partition by pair_id, side order by place) as upto from placed where place > n
),
chosen as ({_of_side('chosen')}),
rejected as ({_of_side('rejected')})
select pair_id, chosen_id, rejected_id, coalesce(n, 0) as n_shared, coalesce(prompt, '') as prompt,
       coalesce(chosen, '') as chosen, coalesce(chosen_mask, '') as chosen_mask,
       coalesce(rejected, '') as rejected, coalesce(rejected_mask, '') as rejected_mask
from pairs left join shared using (pair_id) left join prompts using (pair_id)
left join chosen using (pair_id) left join rejected using (pair_id)"""

ORACLE_SQL: dict[str, str] = {
    "op5_preference_pairs": _PREFERENCE,
    "op10_line_first_rules": _QUALITY,
}
