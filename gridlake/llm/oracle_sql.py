"""The results of the corpus queries in DuckDB SQL, where SQL can express them."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
with docs as (
    select row_number() over () as r, doc_id, {_ALNUM} as w from documents
), items as (
    select coalesce(cast(item_id as varchar), '') as item, {_ALNUM} as w from benchmark
), sizes as (
    select distinct least(13, len(w)) as n from items where len(w) > 0
), item_windows as (
    select distinct item, n, array_to_string(list_slice(w, i, i + n - 1), ' ') as win
    from (select item, w, least(13, len(w)) as n, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i
          from items where len(w) > 0)
), doc_windows as (
    select r, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') as win
    from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from docs, sizes where len(w) >= n)
), hits as (
    select r, i, n, item from doc_windows join item_windows using (n, win)
), words as (
    select r, count(distinct p) as n_hit
    from (select distinct r, unnest(range(i, i + n)) as p from hits) group by r
), found as (
    select r, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as digest
    from (select distinct r, item from hits) group by r
)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
       coalesce(n_items, 0) as n_items, coalesce(digest, sha256('')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs left join words using (r) left join found using (r)
"""

_RULES = ("symbols", "shouting", "dup_lines")
_CELLS = [(rule, cutoff) for rule in _RULES for cutoff in range(1, 21)]

QUALITY_RULES = rf"""
with docs as (
    select row_number() over () as r, doc_id, coalesce(text, '') as t,
           case when lang in ('de', 'en', 'es', 'fr') then lang else 'other' end as stratum
    from documents
), split as (
    select r, doc_id, stratum, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w,
           list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
    from docs
), runs as (
    select r, i, array_to_string(list_slice(w, i, i + 7), ' ') as run
    from (select r, w, unnest(range(1, len(w) - 6)) as i from split where len(w) >= 8)
), repeated as (
    select r, unnest(range(i, i + 8)) as p
    from (select r, i, count(*) over (partition by r, run) as c from runs) where c > 1
), repeats as (
    select r, count(distinct p) as n_repeat_words from repeated group by r
), counts as (
    select r, doc_id, stratum, cast(len(w) as bigint) as n_words,
           cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
           cast(length(t) - length(translate(t, '#*$%&|<>', '')) as bigint) as n_symbols,
           length(regexp_replace(t, '[^A-Z!]+', '', 'g')) as n_shouted,
           cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
           coalesce(n_repeat_words, 0) as n_repeat_words
    from split left join repeats using (r)
), judged as (
    select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
           case when word_chars > 0 then cast(ceil(40.0 * n_symbols / word_chars) as int) else 0 end as symbols,
           case when word_chars > 0 then cast(ceil(40.0 * n_shouted / word_chars) as int) else 0 end as shouting,
           case when n_words > 0 then cast(ceil(40.0 * n_dup_lines / (n_words / 10.0)) as int) else 0 end as dup_lines
    from counts
), marks as (
    select doc_id, avg(quality) >= 0.5 as good from labels
    where doc_id is not null and quality is not null group by doc_id
), cells as (
    {" union all ".join(
        f"select stratum, '{rule}' as rule, {cutoff} as cutoff, count(*) filter (good) as n,"
        f" count(*) filter (good and {rule} > {cutoff}) as k,"
        f" count(*) filter (not good and {rule} > {cutoff}) as bad"
        " from judged join marks using (doc_id) where not base_failed group by stratum"
        for rule, cutoff in _CELLS)}
), tails as (
    select stratum, rule, cutoff, n, k, bad - k as gain, 0.02 / 3 as a from cells
), tested as (
    select stratum, rule, cutoff, gain,
           case when k >= n * a then 1 else (
               select sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1)
                              + j * ln(a) + (n - j) * ln(1 - a)))
               from unnest(range(0, k + 1)) as u(j)) end as p
    from tails
), cutoffs as (
    select stratum, rule, max_by(cutoff, gain * 100 + cutoff) as cutoff
    from tested where p <= 0.05 / 300 and gain > 0 group by stratum, rule
), flat as (
    select stratum, {", ".join(f"max(cutoff) filter (rule = '{r}') as cut_{r}" for r in _RULES)}
    from cutoffs group by stratum
), flagged as (
    select *, list_filter([{", ".join(f"case when {r} > cut_{r} then '{r}' end" for r in _RULES)}],
                          lambda x: x is not null) as failed
    from judged left join flat using (stratum)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       coalesce(array_to_string(failed, ','), '') as failed_rules,
       not base_failed and len(failed) = 0 as kept
from flagged
"""


_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SEARCH = f"""
with docs as (
    select row_number() over () as r, doc_id, {_TERMS} as w from documents
), asked as (
    select i, item_id, t, count(*) as k
    from (select row_number() over () as i, item_id, unnest({_TERMS}) as t from benchmark)
    group by i, item_id, t
), corpus as (
    select cast(count(*) as bigint) as n, cast(sum(len(w)) as bigint) as l from docs where len(w) > 0
), found as (
    select r, t, count(*) as tf from (select r, unnest(w) as t from docs)
    where t in (select t from asked) group by r, t
), held as (
    select t, cast(floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1))) as bigint) as weight
    from found, corpus group by t, n
), points as (
    select i, item_id, r,
           sum(k * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(w) * n) // l)))) as score
    from asked join found using (t) join held using (t) join docs using (r), corpus
    group by i, item_id, r
), ranked as (
    select item_id, doc_id, score, row_number() over (partition by i order by score desc, doc_id) as rank
    from points join docs using (r) where score > 0
)
select item_id, cast(rank as integer) as rank, doc_id, cast(score as bigint) as score
from ranked where rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_quality_rules": QUALITY_RULES,
        "op8_decontamination": DECONTAMINATION,
        "op12_search": SEARCH,
    }
