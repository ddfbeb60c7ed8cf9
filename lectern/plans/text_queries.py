"""Queries of cleaning, enrichment, detection, chunking and segmentation."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import cleaning, detect, enrich
from lectern.functions.text import ALNUM, DIGIT, SPACE
from lectern.operators import chunking
from lectern.operators.content import code_records
from lectern.plans import sql as S
from lectern.plans.registry import query, table

CHUNKS = "document_chunks"


def _cleaner(name: str, modality: str | None) -> None:
    rows = f"select chunk_id, {getattr(S, name)('content')} as cleaned from document_chunks" + (f" where modality = '{modality}'" if modality else "")

    @query(name, rows)
    def run(spark, d, name=name, modality=modality):
        c = table(spark, d, CHUNKS)
        return (c.where(F.col("modality") == modality) if modality else c).select("chunk_id", getattr(cleaning, name)(F.col("content")).alias("cleaned"))


for _name, _modality in [("clean_std_g2", "text"), ("clean_code_g2", "code"), ("clean_table_g2", "table"), ("clean_image_g2", "image"), ("clean_figure_g2", "figure"), ("clean_std_g1", "text"), ("clean_fmt_g1", None), ("clean_code_g1", "code"), ("clean_table_g1", "table"), ("clean_image_g1", "image")]:
    _cleaner(_name, _modality)


_ASCII = r"[^\x20-\x7E\n\t]"


@query("clean_ocr_g1", f"select chunk_id, {S.clean_ocr_g1(S.sub('content', _ASCII, ''))} as cleaned from document_chunks where modality = 'code'")
def clean_ocr_g1(spark, d):
    """On printable ASCII, the only text that reaches this rule."""
    return table(spark, d, CHUNKS).where("modality = 'code'").select("chunk_id", cleaning.clean_ocr_g1(F.regexp_replace("content", _ASCII, "")).alias("cleaned"))


@query("clean_figure_g1", f"select chunk_id, {S.clean_image_g1('content')} as cleaned from document_chunks where modality = 'figure'")
def clean_figure_g1(spark, d):
    return table(spark, d, CHUNKS).where("modality = 'figure'").select("chunk_id", cleaning.clean_figure_g1(F.col("content")).alias("cleaned"))


@query("clean_doc_g2", f"select doc_id, cleaned, cast(length({S.text('text')}) as integer) as original_length, cast(length(cleaned) as integer) as cleaned_length from (select doc_id, text, {S.clean_doc_g2('text')} as cleaned from documents) t")
def clean_doc_g2(spark, d):
    out = table(spark, d, "documents").select("doc_id", F.length(F.coalesce("text", F.lit(""))).alias("original_length"), cleaning.clean_doc_g2(F.col("text")).alias("cleaned"))
    return out.withColumn("cleaned_length", F.length("cleaned"))


_G2 = {k: getattr(S, f"clean_{v}_g2")("content") for k, v in {"code": "code", "table": "table", "image": "image", "figure": "figure"}.items()}
_G1 = {k: getattr(S, f"clean_{v}_g1")("content") for k, v in {"text": "std", "code": "code", "table": "table", "image": "image", "figure": "image"}.items()}


@query(
    "clean_dispatch_g2",
    f"""select chunk_id, modality, content, original_length, cast(length(content) as integer) as cleaned_length, cleaning_strategy from
    (select chunk_id, modality, {S.by_modality('modality', _G2, S.clean_std_g2('content'))} as content, cast(length({S.text('content')}) as integer) as original_length, case when modality in ('code', 'table', 'image', 'figure') then modality else 'standard' end as cleaning_strategy from document_chunks) t""",
)
def clean_dispatch_g2(spark, d):
    return cleaning.clean_dispatch_g2(table(spark, d, CHUNKS)).select("chunk_id", "modality", "content", "original_length", "cleaned_length", "cleaning_strategy")


@query("clean_dispatch_g1", f"select chunk_id, modality, {S.by_modality('modality', _G1, 'content')} as content from document_chunks")
def clean_dispatch_g1(spark, d):
    return cleaning.clean_dispatch_g1(table(spark, d, CHUNKS)).select("chunk_id", "modality", "content")


# enrichment ---------------------------------------------------------------------------------------------------------

_T = S.text("content")
_N_WORDS = f"cast(len({S.words(_T)}) as integer)"
_SENTENCES = f"len(list_filter(string_split({_T}, '.'), lambda s: {S.has('s', f'[^{SPACE}]')}))"
_NUMBERS = S.has(_T, f"[{DIGIT}]")
_LINES = f"cast(len({S.lines(_T)}) as integer)"
_PIPED = f"list_filter({S.lines(_T)}, lambda l: contains(l, '|'))"
_CAPTION = f"(contains(lower({_T}), 'caption') or contains(lower({_T}), 'figure'))"
_COMMENTS = f"len(list_filter({S.lines(_T)}, lambda l: starts_with({S.strip('l')}, '#'))) > 0"
_CODE_FLAGS = f"{_COMMENTS} as has_comments, contains({_T}, 'def ') as has_functions, contains({_T}, 'class ') as has_classes"
_LOW = f"lower({_T})"

_ENRICH = {
    "enr_base_g2": (enrich.base_g2, None, f"cast(length({_T}) as integer) as content_length, {_N_WORDS} as word_count, true as enriched"),
    "enr_text_g2": (enrich.text_g2, "text", f"cast({_SENTENCES} as integer) as sentence_count, cast(len(list_filter(string_split({_T}, chr(10) || chr(10)), lambda s: {S.has('s', f'[^{SPACE}]')})) as integer) as paragraph_count, {_NUMBERS} as has_numbers, {S.has(_T, f'[^{ALNUM} ]')} as has_special_chars, round(length(array_to_string({S.words(_T)}, '')) / greatest({_N_WORDS}, 1), 6) as avg_word_length"),
    "enr_table_g2": (enrich.table_g2, "table", f"cast(len({_PIPED}) as integer) as row_count, cast(coalesce(list_max(list_transform({_PIPED}, lambda l: len(string_split(l, '|')))), 0) as integer) as column_count, len(list_filter({_PIPED}, lambda l: len(list_filter(string_split(l, '|'), lambda p: upper(p) = p and lower(p) <> p)) > 0)) > 0 as has_header, {_NUMBERS} as has_numeric_data"),
    "enr_image_g2": (enrich.image_g2, "image", f"'image' as content_type, {_CAPTION} as has_caption, cast(length({_T}) as integer) as caption_length"),
    "enr_figure_g2": (enrich.figure_g2, "figure", f"'figure' as content_type, {_CAPTION} as has_caption, cast(length({_T}) as integer) as caption_length, case when {S.has(_LOW, 'chart|graph')} then 'chart' when contains({_LOW}, 'diagram') then 'diagram' when {S.has(_LOW, 'photo|image')} then 'image' else 'unknown' end as figure_type"),
    "enr_code_g2": (enrich.code_g2, "code", f"{_LINES} as line_count, {_CODE_FLAGS}, case when contains({_LOW}, 'def ') and contains({_LOW}, 'import ') then 'python' when contains({_LOW}, 'function ') and contains({_LOW}, 'var ') then 'javascript' when contains({_LOW}, 'public class') or contains({_LOW}, 'private ') then 'java' when contains({_LOW}, '<?php') then 'php' when contains({_LOW}, 'def ') then 'python' else 'unknown' end as estimated_language"),
    "enr_hash_g1": (enrich.hash_g1, None, f"sha256({_T}) as content_hash"),
    "enr_length_g1": (enrich.length_g1, None, f"cast(length({_T}) as integer) as content_length, {_N_WORDS} as word_count, {_LINES} as line_count, round(case when {_N_WORDS} > 0 then length({_T}) / {_N_WORDS} else 0.0 end, 6) as average_word_length"),
    "enr_semantic_g1": (enrich.semantic_g1, None, f"{_NUMBERS} as has_numbers, {S.has(_T, f'[^{ALNUM}{SPACE}]')} as has_special_chars, ({' or '.join(f'contains({_T}, {S.quoted(s)})' for s in enrich.CODE_SIGNS)}) as is_likely_code, (contains({_T}, chr(10)) and (contains({_T}, '|') or contains({_T}, chr(9)))) as is_likely_table, len(list_filter({S.lines(_T)}, lambda l: {S.has(S.strip('l'), '^(?:[-*•]|[123][.])')})) >= len({S.lines(_T)}) * 0.5 as is_likely_list, cast(case when {_SENTENCES} > 0 then round_even(least(cast({_N_WORDS} as double) / {_SENTENCES} / 20.0, 1.0), 3) else 0.0 end as double) as complexity_score"),
    "enr_table_g1": (enrich.table_g1, "table", f"{_LINES} as table_rows, (contains({S.lines(_T)}[1], '|') or contains({S.lines(_T)}[1], chr(9))) as has_header, case when contains({_T}, '|') then 'pipe' when contains({_T}, chr(9)) then 'tab' else 'space' end as separator_type"),
    "enr_code_g1": (enrich.code_g1, "code", f"{_LINES} as code_lines, cast(floor(coalesce(list_max(list_transform(list_filter({S.lines(_T)}, lambda l: {S.has('l', f'[^{SPACE}]')}), lambda l: length(l) - length({S.lstrip('l')}))), 0) / 4) as integer) as indentation_level, {_CODE_FLAGS}"),
    "enr_image_g1": (enrich.image_g1, "image", f"cast(len(regexp_extract_all({_T}, {S.quoted(enrich.IMAGE_TYPES)}, 1)) as integer) as image_count, array_to_string(list_sort(list_distinct(regexp_extract_all({_T}, {S.quoted(enrich.IMAGE_TYPES)}, 1))), ',') as image_types, {_CAPTION} as has_caption"),
}


def _enricher(name, f, modality, sql) -> None:
    @query(name, f"select chunk_id, {sql} from document_chunks" + (f" where modality = '{modality}'" if modality else ""))
    def run(spark, d):
        c = table(spark, d, CHUNKS)
        fields = f(F.coalesce("content", F.lit("")))
        for k in ("avg_word_length", "average_word_length"):
            if k in fields:
                fields[k] = F.round(fields[k], 6)
        if "image_types" in fields:
            fields["image_types"] = F.array_join(fields["image_types"], ",")
        return (c.where(F.col("modality") == modality) if modality else c).select("chunk_id", *[v.alias(k) for k, v in fields.items()])


for _name, (_f, _modality, _sql) in _ENRICH.items():
    _enricher(_name, _f, _modality, _sql)

_COUNTS = "cast(length({0}) as integer) as content_length"


@query("enr_dispatch_g2", f"select chunk_id, cast(length({_T}) as integer) as content_length, {_N_WORDS} as word_count, case when modality = 'text' then cast({_SENTENCES} as integer) end as sentence_count, case when modality = 'table' then cast(len({_PIPED}) as integer) end as row_count, case when modality = 'image' or modality = 'figure' then {_CAPTION} end as has_caption, case when modality = 'code' then {_LINES} end as line_count from document_chunks")
def enr_dispatch_g2(spark, d):
    e = enrich.enrich_g2(table(spark, d, CHUNKS).select("chunk_id", "modality", "content"))
    return e.select("chunk_id", "content_length", "word_count", "text_metadata.sentence_count", "table_metadata.row_count", F.coalesce("image_metadata.has_caption", "figure_metadata.has_caption").alias("has_caption"), "code_metadata.line_count")


@query("enr_dispatch_g1", f"select chunk_id, sha256({_T}) as content_hash, {_N_WORDS} as word_count, case when modality = 'table' then {_LINES} end as table_rows, case when modality = 'code' then {_LINES} end as code_lines, case when modality = 'image' then {_CAPTION} end as has_caption from document_chunks")
def enr_dispatch_g1(spark, d):
    e = enrich.enrich_g1(table(spark, d, CHUNKS).select("chunk_id", "modality", "content"))
    return e.select("chunk_id", "content_hash", "word_count", "table_metadata.table_rows", "code_metadata.code_lines", "image_metadata.has_caption")


@query("enr_processing_g2", "select chunk_id, true as processed, true as content_extraction_enabled, 'modality_aware' as chunking_strategy from document_chunks")
def enr_processing_g2(spark, d):
    return table(spark, d, CHUNKS).select("chunk_id", F.lit(True).alias("processed"), F.lit(True).alias("content_extraction_enabled"), F.lit("modality_aware").alias("chunking_strategy"))


@query("str_figure_kind", f"select chunk_id, case when contains({_LOW}, 'figure') then 'Figure Reference' when contains({_LOW}, 'diagram') then 'Diagram' when contains({_LOW}, 'chart') then 'Chart' else 'Other' end as kind from document_chunks where modality = 'figure'")
def str_figure_kind(spark, d):
    return table(spark, d, CHUNKS).where("modality = 'figure'").select("chunk_id", detect.figure_kind(F.coalesce("content", F.lit(""))).alias("kind"))


# code -------------------------------------------------------------------------------------------------------------

# the table's texts, and each with fenced and inline code after it
_FENCED = "x\n```python\nprint(1)\n```\nthen `a` and `b c`\n```\n`in` a fence\n```"
_FENCED_SQL = S.quoted(_FENCED).replace("\n", "' || chr(10) || '")
_CODE_ROWS = f"select chunk_id as k, coalesce(content, '') || chr(10) || {_FENCED_SQL} as t from (select distinct chunk_id, content from document_chunks) x"
_RULE = "case " + " ".join(f"when {S.has('s', p)} then {k}" for k, p in enumerate(detect.CODE_LIKE)) + " end"


def _like(rows: str) -> str:
    return f"select k, i + 1 as line_number, s, {_RULE} as rule from (select k, i, {S.strip('l')} as s from (select k, unnest(generate_series(0, len({S.lines('t')}) - 1)) as i, unnest({S.lines('t')}) as l from ({rows}) a) b) c where s <> ''"


def code_sql(rows: str) -> str:
    """(k, chunk_index, type, content, lines, characters, code_type): the code records of rows (k, t)."""
    return f"""with a as ({rows}),
    b as (select k, 1 as o, i, t from (select k, unnest(generate_series(1, len(x))) as i, unnest(x) as t from (select k, regexp_extract_all(t, '```[\\s\\S]*?```') as x from a) y) z
    union all select k, 2, i, t from (select k, unnest(generate_series(1, len(x))) as i, unnest(x) as t from (select k, regexp_extract_all(t, '`([^`]+)`', 1) as x from a) y) z),
    l as (select k, 3 as o, 1 as i, string_agg(s, chr(10) order by line_number) as t, count(*) as n, sum(length(s)) as c from ({_like(rows)}) x where rule is not null group by k),
    u as (select k, o, i, t, len({S.lines('t')}) as n, length(t) as c from b union all select k, o, i, t, n, c from l)
    select k, cast(row_number() over (partition by k order by o, i) as integer) as chunk_index, case o when 1 then 'markdown_code_block' when 2 then 'inline_code' else 'code_like_lines' end as type, t as content, cast(n as integer) as lines, cast(c as integer) as characters, case o when 3 then 'pattern_matched' else 'structured' end as code_type from u"""


def _pages(spark, d):
    t = table(spark, d, CHUNKS).select(F.col("chunk_id").alias("document_id"), "content").distinct()
    return t.select("document_id", F.concat_ws("\n", F.coalesce("content", F.lit("")), F.lit(_FENCED)).alias("content"), F.lit(1).alias("page_number"))


@query("code_blocks", f"select k as chunk_id, b as content from (select k, unnest(regexp_extract_all(t, '```[\\s\\S]*?```')) as b from ({_CODE_ROWS}) a) x")
def code_blocks(spark, d):
    return code_records(_pages(spark, d)).where("type = 'markdown_code_block'").select(F.col("document_id").alias("chunk_id"), "content")


@query("code_inline", f"select k as chunk_id, b as content from (select k, unnest(regexp_extract_all(t, '`([^`]+)`', 1)) as b from ({_CODE_ROWS}) a) x")
def code_inline(spark, d):
    return code_records(_pages(spark, d)).where("type = 'inline_code'").select(F.col("document_id").alias("chunk_id"), "content")


@query("code_like_lines", f"select k as chunk_id, cast(line_number as integer) as line_number, s as content, cast(rule as integer) as rule from ({_like(_CODE_ROWS)}) x where rule is not null")
def code_like_lines(spark, d):
    return code_records(_pages(spark, d)).where("type = 'code_like_lines'").select(F.col("document_id").alias("chunk_id"), F.explode("line_details").alias("x")).select("chunk_id", "x.line_number", "x.content", "x.rule")


@query("code_extract", f"select k as chunk_id, chunk_index, type, content, lines, characters, code_type from ({code_sql(_CODE_ROWS)}) x")
def code_extract(spark, d):
    return code_records(_pages(spark, d)).select(F.col("document_id").alias("chunk_id"), "chunk_index", "type", "content", "lines", "characters", "code_type")


# chunking ---------------------------------------------------------------------------------------------------------

_DOCS = "select doc_id as k, coalesce(text, '') as t from documents"


def _docs(spark, d):
    return table(spark, d, "documents").select("doc_id", "text")


@query("chunk_sentence_g2", f"select k as doc_id, content, chunk_index, start_index, end_index, length from ({S.sentence_chunks(_DOCS)}) x")
def chunk_sentence_g2(spark, d):
    return chunking.chunk_sentence_g2(_docs(spark, d), "doc_id", "text")


@query("chunk_simple_g2", f"select k as doc_id, content, chunk_index, start_index, end_index, length from ({S.sentence_chunks(f'select doc_id as k, {S.clean_doc_g2('text')} as t from documents')}) x")
def chunk_simple_g2(spark, d):
    clean = table(spark, d, "documents").select("doc_id", cleaning.clean_doc_g2(F.col("text")).alias("text"))
    return chunking.chunk_sentence_g2(clean, "doc_id", "text")


@query("win_chunk_index", f"select k as doc_id, max(chunk_index) as last_index, cast(count(*) as bigint) as chunks from ({S.sentence_chunks(_DOCS, 300, 60)}) x group by k")
def win_chunk_index(spark, d):
    return chunking.chunk_sentence_g2(_docs(spark, d), "doc_id", "text", 300, 60).groupBy("doc_id").agg(F.max("chunk_index").alias("last_index"), F.count("*").alias("chunks"))


@query("flt_blank_chunk", f"select k as doc_id, min(length) as shortest from ({S.sentence_chunks(_DOCS, 80, 10)}) x group by k")
def flt_blank_chunk(spark, d):
    return chunking.chunk_sentence_g2(_docs(spark, d), "doc_id", "text", 80, 10).groupBy("doc_id").agg(F.min("length").alias("shortest"))


@query("win_latest_kind", f"select k as doc_id, start_index, end_index from ({S.sentence_chunks(_DOCS, 500, 100)}) x")
def win_latest_kind(spark, d):
    return chunking.chunk_sentence_g2(_docs(spark, d), "doc_id", "text", 500, 100).select("doc_id", "start_index", "end_index")


@query("chunk_word_g1", f"select k as doc_id, content, chunk_index, start_index, end_index, length from ({S.word_chunks(_DOCS)}) x")
def chunk_word_g1(spark, d):
    return chunking.chunk_word_g1(_docs(spark, d), ["doc_id"], "text")


@query("seg_line_modality_g1", f"select k as doc_id, cast(i as integer) as line_no, {S.line_modality('l')} as modality from (select k, unnest(generate_series(0, len({S.lines('t')}) - 1)) as i, unnest({S.lines('t')}) as l from ({_DOCS}) a) b")
def seg_line_modality_g1(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("line_no", "l"))
    return rows.select("doc_id", "line_no", detect.line_modality_g1(F.col("l")).alias("modality"))


_SEGMENTS = S.segments(_DOCS)


@query("seg_lines_g1", f"select k as doc_id, segment_no, modality, content, start_line, end_line from ({_SEGMENTS}) x")
def seg_lines_g1(spark, d):
    return chunking.seg_lines_g1(_docs(spark, d), "doc_id", "text")


@query("win_segment_g1", f"select modality, cast(count(*) as bigint) as segments, cast(sum(end_line - start_line + 1) as bigint) as lines from ({_SEGMENTS}) x group by modality")
def win_segment_g1(spark, d):
    return chunking.seg_lines_g1(_docs(spark, d), "doc_id", "text").groupBy("modality").agg(F.count("*").alias("segments"), F.sum((F.col("end_line") - F.col("start_line") + 1).cast("bigint")).alias("lines"))


_SEG_CHUNKS = f"""select k, segment_no, modality, 0 as chunk_index, content from ({_SEGMENTS}) x where modality in ('table', 'image', 'figure')
union all select k.k, k.segment_no, k.modality, chunk_index, content from ({S.word_chunks(f"select struct_pack(k := k, segment_no := segment_no, modality := modality) as k, content as t from ({_SEGMENTS}) y where modality in ('text', 'code')")}) z"""


@query("seg_chunk_g1", f"select k as doc_id, segment_no, modality, chunk_index, content from ({_SEG_CHUNKS}) w")
def seg_chunk_g1(spark, d):
    return chunking.seg_chunk_g1(chunking.seg_lines_g1(_docs(spark, d), "doc_id", "text"), "doc_id")


@query("chunk_ids_g1", f"select k as doc_id, 'chunk_' || chunk_index || '_' || modality as chunk_id, k || '_' || segment_no || '_' || chunk_index || '_' || modality as chunk_key from ({_SEG_CHUNKS}) w")
def chunk_ids_g1(spark, d):
    return chunking.chunk_document_g1(_docs(spark, d), "doc_id", "text").select("doc_id", "chunk_id", "chunk_key")


@query(
    "chunk_assign_meta_g1",
    """with m as (select document_id, min(file_path) as source_file, min(lower(document_type)) as document_type, min(coalesce(processing_status, 'pending')) as processing_status from processed_documents group by 1)
    select c.chunk_id, c.document_id, source_file, m.document_type, m.processing_status from document_chunks c left join m using (document_id)""",
)
def chunk_assign_meta_g1(spark, d):
    return chunking.chunk_assign_meta_g1(table(spark, d, CHUNKS).select("chunk_id", "document_id"), table(spark, d, "processed_documents"))
