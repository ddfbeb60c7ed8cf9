"""Building blocks of the SQL that each query is held against."""

from __future__ import annotations

from lectern.functions.text import SPACE


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sub(x: str, pattern: str, to: str) -> str:
    return f"regexp_replace({x}, {quoted(pattern)}, {quoted(to)}, 'g')"


def has(x: str, pattern: str) -> str:
    return f"regexp_matches({x}, {quoted(pattern)})"


def collapse(x: str) -> str:
    return sub(x, f"[{SPACE}]+", " ")


def strip(x: str) -> str:
    return sub(x, rf"^[{SPACE}]+|[{SPACE}]+\z", "")


def lstrip(x: str) -> str:
    return sub(x, f"^[{SPACE}]+", "")


def lines(x: str) -> str:
    return f"string_split({x}, chr(10))"


def words(x: str) -> str:
    return f"list_filter(string_split_regex({x}, {quoted(f'[{SPACE}]+')}), lambda w: w <> '')"


def text(x: str) -> str:
    return f"coalesce({x}, '')"


def kept_lines(x: str, body: str) -> str:
    """Lines of x, each made into `body` (of l), without empty ones."""
    return f"array_to_string(list_filter(list_transform({lines(x)}, lambda l: {body}), lambda l: l <> ''), chr(10))"


def clean_doc_g2(x: str) -> str:
    from lectern.functions.text import ALNUM

    return strip(collapse(sub(text(x), rf"[^{ALNUM}_{SPACE}.,!?;:\-()\[\]{{}}]", "")))


def clean_std_g2(x: str) -> str:
    literal = quoted(", \"'\").replace(")
    return sub(f"translate(replace({strip(collapse(text(x)))}, {literal}, ''''), '–—', '--')", r"[\x00-\x08\x{0b}-\x{1f}]", "")


def clean_code_g2(x: str) -> str:
    from lectern.functions.text import BLANK

    t = sub(sub(text(x), f"[{BLANK}]+\n", "\n"), rf"[{BLANK}]+\z", "")
    return sub(t, r"^\n+|\n+\z", "")


def clean_table_g2(x: str) -> str:
    return kept_lines(text(x), strip(sub(sub("l", rf"[{SPACE}]*\|[{SPACE}]*", "|"), r"^\|+|\|+\z", "")))


def clean_image_g2(x: str) -> str:
    return strip(sub(collapse(text(x)), rf"(?i)^(Figure|Image|Photo|Picture)[{SPACE}]*\p{{Nd}}*[:{SPACE}]*", ""))


def clean_figure_g2(x: str) -> str:
    return strip(sub(collapse(text(x)), rf"(?i)^(Figure|Fig)[{SPACE}]*\p{{Nd}}*[:{SPACE}]*", ""))


def clean_ocr_g1(x: str) -> str:
    return sub(sub(sub(text(x), r"\b0\b", "O"), r"\b1\b", "l"), r"\b", "I")


def clean_fmt_g1(x: str) -> str:
    t = sub(text(x), rf"[{SPACE}]+([.,;:!?])", r"\1")
    t = sub(sub(t, rf"\([{SPACE}]+", "("), rf"[{SPACE}]+\)", ")")
    return sub(sub(t, rf'"[{SPACE}]+', '"'), rf'[{SPACE}]+"', '"')


def clean_std_g1(x: str) -> str:
    return strip(clean_fmt_g1(clean_ocr_g1(collapse(sub(text(x), r"[^\x20-\x7E\n\t]", "")))))


def clean_code_g1(x: str) -> str:
    return kept_lines(text(x), f"case when {strip('l')} <> '' then repeat(' ', length(l) - length({lstrip('l')})) || {strip('l')} else '' end")


def clean_table_g1(x: str) -> str:
    return kept_lines(text(x), strip(collapse(sub("l", rf"[{SPACE}]*\|[{SPACE}]*", " | "))))


def clean_image_g1(x: str) -> str:
    return collapse(strip(text(x)))


def by_modality(m: str, values: dict[str, str], other: str) -> str:
    return "case " + " ".join(f"when {m} = '{k}' then {v}" for k, v in values.items()) + f" else {other} end"


def line_modality(l: str) -> str:  # noqa: E741
    from lectern.functions.detect import CODE_LINE, FIGURE_LINE, IMAGE_LINE

    x = strip(l)
    n = lambda c: f"(length({x}) - length(replace({x}, {c}, '')))"
    table = f"({n(quoted('|'))} >= 2 or {n('chr(9)')} >= 2 or {has(x, rf'^[^{SPACE}]+[{SPACE}]{{2,}}[^{SPACE}]+')})"
    return f"case when {x} = '' then 'text' when {table} then 'table' when {has(x, '|'.join(f'(?:{p})' for p in CODE_LINE))} then 'code' when {has(x, IMAGE_LINE)} then 'image' when {has(x, FIGURE_LINE)} then 'figure' else 'text' end"


def sentence_chunks(source: str, size: int = 1000, overlap: int = 200) -> str:
    """source: a query of (k, t). Gives k, start_index, end_index, content, chunk_index, length."""
    from lectern.operators.chunking import SENTENCE_ENDS

    marks = " ".join(f"when length(regexp_extract(w, {quoted('(?s)^(.*)' + m.replace('.', chr(92) + '.').replace('?', chr(92) + '?'))}, 1)) > 0 then a + length(regexp_extract(w, {quoted('(?s)^(.*)' + m.replace('.', chr(92) + '.').replace('?', chr(92) + '?'))}, 1)) + {len(m)}" for m in SENTENCE_ENDS)
    return _chunks(source, f"case when a + {size} >= n then a + {size} {marks} else a + {size} end", size, overlap)


def word_chunks(source: str, size: int = 500, overlap: int = 200) -> str:
    one = "length(regexp_extract(w, '(?s)^(.*) ', 1))"
    return _chunks(source, f"case when a + {size} >= n then a + {size} when {one} > 0 then a + {one} else a + {size} end", size, overlap)


def _chunks(source: str, end: str, size: int, overlap: int) -> str:
    return f"""
    with recursive src as ({source}),
    step as (
      select k, t, n, a, {end} as e from (select k, t, length(t) as n, 0 as a, substr(t, 1, {size}) as w from src where length(t) > 0)
      union all
      select k, t, n, a, {end} as e from (select k, t, n, a, substr(t, a + 1, {size}) as w from (select k, t, n, case when e - {overlap} > a then e - {overlap} else e end as a from step) where a < n)
    ),
    cut as (select k, a, e, {strip('substr(t, a + 1, e - a)')} as content from step)
    select k, cast(a as integer) as start_index, cast(e as integer) as end_index, content, cast(row_number() over (partition by k order by a) - 1 as integer) as chunk_index, cast(length(content) as integer) as length from cut where content <> ''"""


def segments(source: str) -> str:
    """source: a query of (k, t), one row a key. Gives k, segment_no, modality, content, start_line, end_line."""
    return f"""
    with src as ({source}),
    l as (select k, unnest(generate_series(0, len({lines('t')}) - 1)) as i, unnest({lines('t')}) as l from src),
    m as (select *, {line_modality('l')} as modality from l),
    c as (select *, case when i = 0 or modality <> lag(modality) over (partition by k order by i) then 1 else 0 end as fresh from m),
    g as (select *, sum(fresh) over (partition by k order by i rows unbounded preceding) as g from c),
    s as (select k, g, modality, min(i) as a, max(i) as b, string_agg(l, chr(10) order by i) as body from g group by k, g, modality),
    r as (select k, modality, case when a = 0 and modality = 'text' then chr(10) || body else body end as content, a, b from s)
    select k, cast(row_number() over (partition by k order by a) - 1 as integer) as segment_no, modality, content, cast(a as integer) as start_line, cast(b as integer) as end_line from r where {has('content', f'[^{SPACE}]')}"""
