"""DuckDB statements that the queries of this subpackage must agree with."""

from __future__ import annotations

from shelfcast.llm.quality import OTHER, RULES, STOP_WORDS, SYMBOLS, UPPER, Rule


def _inside(characters: str) -> str:
    return "".join(f"\\x{{{ord(c):x}}}" for c in characters)


def _occurrences(characters: str) -> str:
    return f"length(x) - length(regexp_replace(x, '[{_inside(characters)}]+', '', 'g'))"


def _test(rule: Rule) -> str:
    bounds = [f"{rule.measure} >= {rule.low}" if rule.low is not None else "", f"{rule.measure} <= {rule.high}" if rule.high is not None else ""]
    return " and ".join(b for b in bounds if b)


def quality(source: str, key: str = "doc_id") -> str:
    """Common table expressions that end in `judged`: measures and verdict per row of `source`."""
    stop = ", ".join(f"'{w}'" for w in sorted({w for line in STOP_WORDS for w in line.split()}))
    rules = " and ".join(_test(r) for r in RULES)
    return f"""
whole as (
  select {key}, coalesce(text, '') as x from {source}
), split as (
  select {key}, x,
    list_filter(regexp_split_to_array(x, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as ws,
    list_filter(string_split(x, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as ls
  from whole
), windows as (
  select {key}, i, ws[i] as a, ws[i + 1] as b, ws[i + 2] as c
  from (select {key}, ws, unnest(range(1, len(ws) - 1)) as i from split)
), repeated as (
  select {key}, i from (select {key}, i, count(*) over (partition by {key}, a, b, c) as n from windows) where n > 1
), covered as (
  select {key}, count(distinct i + o) as n from repeated, (values (0), (1), (2)) as v(o) group by {key}
), counted as (
  select s.{key},
    cast(len(ws) as bigint) as n_words,
    cast(coalesce(list_sum(list_transform(ws, lambda w: length(w))), 0) as bigint) as word_chars,
    cast({_occurrences(SYMBOLS)} as bigint) as n_symbols,
    cast(len(ls) - len(list_distinct(ls)) as bigint) as n_dup_lines,
    cast(coalesce(c.n, 0) as bigint) as n_repeat_words,
    cast(len(ls) as bigint) as n_lines,
    {_occurrences(UPPER)} as n_upper,
    {_occurrences(OTHER)} as n_other,
    len(list_filter(ws, lambda w: lower(w) in ({stop}))) as n_stop_words,
    len(list_filter(ls, lambda l: regexp_matches(ltrim(l), '^[-*•]'))) as n_bullet_lines,
    len(list_filter(ls, lambda l: regexp_matches(rtrim(l), '([.][.][.]|…)$'))) as n_ellipsis_lines
  from split s left join covered c using ({key})
), measured as (
  select *,
    word_chars / greatest(n_words, 1) as mean_word_length,
    n_symbols / greatest(n_words, 1) as symbols_per_word,
    n_upper / greatest(word_chars, 1) as upper_share,
    n_other / greatest(word_chars, 1) as other_share,
    n_stop_words / greatest(n_words, 1) as stop_word_share,
    n_dup_lines / greatest(n_lines, 1) as dup_line_share,
    n_repeat_words / greatest(n_words, 1) as repeat_share,
    n_bullet_lines / greatest(n_lines, 1) as bullet_line_share,
    n_ellipsis_lines / greatest(n_lines, 1) as ellipsis_line_share
  from counted
), judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and {rules} as kept
  from measured
)"""


def near_duplicates(source: str) -> str:
    """Common table expressions that end in `grouped` (doc_id, n_shingles, component_id)."""
    return f"""
worded as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as ws
  from {source}
), shingles as (
  select distinct doc_id, array_to_string(ws[i:i + 4], ' ') as s
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as i from worded where len(ws) > 0)
), sized as (
  select d.doc_id, count(s.s) as n from (select distinct doc_id from {source}) d left join shingles s using (doc_id) group by d.doc_id
), shared as (
  select a.doc_id as x, b.doc_id as y, count(*) as i from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all
), linked as (
  select x, y from shared join sized p on p.doc_id = x join sized q on q.doc_id = y where 100 * i >= 80 * (p.n + q.n - i)
), reached as (
  select x as doc_id, x as other from linked
  union
  select r.doc_id, l.y from reached r join linked l on l.x = r.other
), grouped as (
  select z.doc_id, cast(z.n as bigint) as n_shingles, coalesce(min(r.other), z.doc_id) as component_id
  from sized z left join reached r using (doc_id) group by z.doc_id, z.n
)"""
