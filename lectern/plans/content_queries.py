"""Queries of sources, records of images and tables, content chunks, joins and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import detect
from lectern.functions.text import SPACE
from lectern.operators import content, search
from lectern.operators.chunking import chunk_sentence_g2
from lectern.operators.embedding import Hashing, embed, embed_hashing
from lectern.operators.merge import dict_merge, first_value, full_outer_counts, list_merge, union_chunks, union_keys
from lectern.operators.statistics import file_ordinals, preview
from lectern.operators.store import store_metadata
from lectern.plans import sql as S
from lectern.plans.registry import query, table
from lectern.plans.text_queries import code_sql
from lectern.sources import config, files

IMG, TAB = "image_records", "table_records"
NOW = 1_700_000_000


def _listing(spark, d):
    return table(spark, d, "processed_documents").select("path").where("path is not null").distinct()


# sources ------------------------------------------------------------------------------------------------------------

_PATHS = "select category_name, cast(unnest(generate_series(0, len(doc_paths) - 1)) as integer) as position, unnest(doc_paths) as path from quiz_categories"
_THERE = "path in (select path from processed_documents where path is not null)"
_NAME = "regexp_extract(path, '([^/]*)\\z', 1)"
_STEM = f"(case when strpos(substr({_NAME}, 2), '.') > 0 then regexp_extract({_NAME}, '(?s)^(.+)[.][^.]*\\z', 1) else {_NAME} end)"


@query("src_docs_g2", f"select category_name, path, 'doc_' || {_STEM} || '_{NOW}' as document_id, lower(regexp_extract(path, '[.]([^./]*)\\z', 1)) as document_type, 'Document from ' || category_name || ' category' as content, 'pending' as processing_status from ({_PATHS}) p where {_THERE}")
def src_docs_g2(spark, d):
    return config.documents_from_categories(table(spark, d, "quiz_categories"), _listing(spark, d), NOW).drop("file_path")


@query("src_paths_g1", f"select category_name, position, path from ({_PATHS}) p where {_THERE}")
def src_paths_g1(spark, d):
    return config.existing_paths(config.category_paths(table(spark, d, "quiz_categories")), _listing(spark, d)).select("category_name", "position", "path")


@query("join_explode", _PATHS)
def join_explode(spark, d):
    return config.category_paths(table(spark, d, "quiz_categories")).select("category_name", "position", "path")


@query("src_pdf_ingest", f"select 'pdf_' || {_STEM} || '_' || cast(floor(epoch(ingested_at)) as bigint) as document_id, path, 'pdf' as document_type, 'ingested' as processing_status from processed_documents where lower(regexp_extract(path, '[.]([^./]*)\\z', 1)) = 'pdf'")
def src_pdf_ingest(spark, d):
    return files.pdf_documents(table(spark, d, "processed_documents").select("path", F.col("ingested_at").alias("modificationTime")))


@query("src_dispatch", "select coalesce(path, '') as path, case when s = 'pdf' then 'pdf' when s in ('txt', 'html', 'htm') then 'text' else 'none' end as reader from (select path, lower(regexp_extract(coalesce(path, ''), '[.]([^./]*)\\z', 1)) as s from processed_documents) t")
def src_dispatch(spark, d):
    p = table(spark, d, "processed_documents").select(F.coalesce("path", F.lit("")).alias("path"))
    taken, errors = files.dispatch(p)
    return taken.select("path", "reader").unionByName(errors.select("path", F.lit("none").alias("reader")))


@query("flt_path_exists", "select distinct document_id from processed_documents where path is not null and path <> ''")
def flt_path_exists(spark, d):
    p = table(spark, d, "processed_documents")
    return config.existing_paths(p, _listing(spark, d)).select("document_id").distinct()


@query("src_pdf_text_g1", "select document_id, string_agg(coalesce(content, '') || chr(10), '' order by coalesce(page_number, 0), coalesce(content, '')) as content from document_chunks where modality = 'text' group by 1")
def src_pdf_text_g1(spark, d):
    return files.page_text(table(spark, d, "document_chunks").where("modality = 'text'").select("document_id", "page_number", "content"))


@query("src_images_g2", f"select document_id, page_number, image_index, extracted_text, cast(len({S.lines('extracted_text')}) as integer) as text_lines, cast(length(extracted_text) as integer) as text_characters from image_records where width > 100 and height > 100 and ocr_success")
def src_images_g2(spark, d):
    i = table(spark, d, IMG).where(detect.ocr_eligible(F.col("width"), F.col("height")) & F.col("ocr_success"))
    return i.select("document_id", "page_number", "image_index", "extracted_text", F.when(F.col("extracted_text").isNotNull(), F.size(F.split("extracted_text", "\n", -1))).alias("text_lines"), F.length("extracted_text").alias("text_characters"))


@query("src_images_util", "select document_id, page_number, cast(image_index - 1 as integer) as image_index, width, height, coalesce(colorspace, 'unknown') as colorspace from image_records")
def src_images_util(spark, d):
    return table(spark, d, IMG).select("document_id", "page_number", (F.col("image_index") - 1).alias("image_index"), "width", "height", F.coalesce("colorspace", F.lit("unknown")).alias("colorspace"))


_CELL = f"coalesce({S.strip('c')}, '') <> ''"


@query("src_tables", f"select document_id, page_number, table_index, cast(coalesce(len(cell_data), 0) as integer) as rows, cast(coalesce(len(cell_data[1]), 0) as integer) as columns, cast(coalesce(list_sum(list_transform(cell_data, lambda r: coalesce(len(r), 0))), 0) as integer) as total_cells, cast(coalesce(list_sum(list_transform(cell_data, lambda r: len(list_filter(r, lambda c: {_CELL})))), 0) as integer) as non_empty_cells from table_records")
def src_tables(spark, d):
    return table(spark, d, TAB).select("document_id", "page_number", "table_index", *[v.alias(k) for k, v in content.table_stats(F.col("cell_data")).items()])


@query("src_pdf_content", "select document_id, page_number, cast(sum(i) as bigint) as images, cast(sum(t) as bigint) as tables from (select document_id, page_number, 1 as i, 0 as t from image_records union all select document_id, page_number, 0, 1 from table_records) x group by 1, 2")
def src_pdf_content(spark, d):
    i = table(spark, d, IMG).select("document_id", "page_number", F.lit(1).alias("i"), F.lit(0).alias("t"))
    t = table(spark, d, TAB).select("document_id", "page_number", F.lit(0).alias("i"), F.lit(1).alias("t"))
    return i.unionByName(t).groupBy("document_id", "page_number").agg(F.sum("i").alias("images"), F.sum("t").alias("tables"))


@query("src_config")
def src_config(spark, d):
    """The categories written as a configuration file and read back (rows only)."""
    import uuid

    from lectern.plans.workdir import folder

    path = f"{folder(spark)}/config-{uuid.uuid4().hex}"
    c = table(spark, d, "quiz_categories")
    one = c.agg(F.collect_list(F.struct(F.col("category_name").alias("name"), "num_questions", "description", "doc_paths")).alias("categories"))  # the configuration's categories: a dozen
    one.withColumns({"database_type": F.lit("files"), "model_name": F.lit("none"), "embedding_model": F.lit("hashing")}).coalesce(1).write.json(path)
    return config.categories(config.read_config(spark, path))


# figures, tables, content chunks --------------------------------------------------------------------------------------

_OCR = "coalesce(ocr_success, false)"
_IS_FIGURE = f"case when width < 50 or height < 50 then false when width > 2000 or height > 2000 then false when width / nullif(cast(height as double), 0) between 0.5 and 2.0 then true else {_OCR} end"
_RATIO = "(case when height = 0 then 0.0 else width / nullif(cast(height as double), 0) end)"
_FIGURE_TYPE = f"case when {_OCR} then 'text_diagram' when {_RATIO} > 1.5 then 'wide_diagram' when {_RATIO} < 0.7 then 'tall_diagram' else 'standard_figure' end"
_KEYS = ["document_id", "page_number", "image_index"]


@query("flt_ocr_eligible", "select document_id, page_number, image_index from image_records where width > 100 and height > 100")
def flt_ocr_eligible(spark, d):
    return table(spark, d, IMG).where(detect.ocr_eligible(F.col("width"), F.col("height"))).select(*_KEYS)


@query("prd_is_figure", f"select document_id, page_number, image_index, {_IS_FIGURE} as is_figure from image_records")
def prd_is_figure(spark, d):
    return table(spark, d, IMG).select(*_KEYS, detect.is_figure(F.col("width"), F.col("height"), F.col("ocr_success")).alias("is_figure"))


@query("prj_figure_type", f"select document_id, page_number, image_index, {_FIGURE_TYPE} as figure_type from image_records where {_IS_FIGURE}")
def prj_figure_type(spark, d):
    return content.figures(table(spark, d, IMG)).select(*_KEYS, "figure_type")


_ROW = "array_to_string(list_filter(r, lambda c: coalesce(c, '') <> ''), ' | ')"
_BODY = f"list_filter(list_transform(cell_data, lambda r: {_ROW}), lambda x: {S.has('x', f'[^{SPACE}]')})"
_TABLE_TEXT = f"case when coalesce(len(cell_data), 0) = 0 then '' else array_to_string(list_concat(['Table Content:', repeat('=', 50)], {_BODY}), chr(10)) end"


@query("table_to_text", f"select document_id, page_number, table_index, {_TABLE_TEXT} as text from table_records")
def table_to_text(spark, d):
    return table(spark, d, TAB).select("document_id", "page_number", "table_index", content.table_to_text(F.col("cell_data")).alias("text"))


@query("flt_table_row", f"select document_id, page_number, table_index, unnest({_BODY}) as row_text from table_records")
def flt_table_row(spark, d):
    rows = table(spark, d, TAB).select("document_id", "page_number", "table_index", F.explode("cell_data").alias("r"))
    return rows.select("document_id", "page_number", "table_index", content.table_row_text(F.col("r")).alias("row_text")).where(F.col("row_text").rlike(f"[^{SPACE}]"))


@query("prj_table_meta_nodata", "select document_id, page_number, table_index, n_rows, n_cols, total_cells, non_empty_cells from table_records")
def prj_table_meta_nodata(spark, d):
    return table(spark, d, TAB).drop("cell_data")


def _code(spark, d):
    c = table(spark, d, "document_chunks").where("modality = 'code' and content is not null").select("chunk_id", "document_id", "page_number", "content").distinct()
    code = content.code_records(c.select(F.struct("document_id", "chunk_id").alias("document_id"), F.coalesce("page_number", F.lit(0)).alias("page_number"), "content"))
    return code.select(F.col("document_id.document_id").alias("document_id"), "page_number", "chunk_index", "type", "content", "lines", "characters")


def _chunks(spark, d):
    return content.content_chunks(table(spark, d, IMG).distinct(), table(spark, d, TAB).distinct(), _code(spark, d))


_I = "(select distinct * from image_records)"
_CODE_CHUNKS = "select distinct {'d': document_id, 'c': chunk_id, 'p': coalesce(page_number, 0)} as k, content as t from document_chunks where modality = 'code' and content is not null"
_CODE = f"(select k.d as document_id, k.p as page_number, chunk_index as item_index, type as code_type, content, lines, characters from ({code_sql(_CODE_CHUNKS)}) x)"
_NONE = "null as code_type, 0 as lines, 0 as characters"
_PARTS = f"""select document_id, 'image' as type, coalesce(extracted_text, '') as content, coalesce(page_number, 0) as page_number, coalesce(image_index, 0) as item_index, 0 as kind_no, {_NONE} from {_I} a
union all select document_id, 'table', {_TABLE_TEXT}, coalesce(page_number, 0), coalesce(table_index, 0), 1, {_NONE} from (select distinct * from table_records) b
union all select document_id, 'code', content, page_number, item_index, 2, code_type, lines, characters from {_CODE} c
union all select document_id, 'figure', coalesce(extracted_text, ''), coalesce(page_number, 0), coalesce(image_index, 0), 3, {_NONE} from {_I} e where {_IS_FIGURE}"""
_RUNNING = f"select document_id, type, content, page_number, item_index, code_type, cast(lines as bigint) as lines, cast(characters as bigint) as characters, cast(row_number() over (partition by document_id order by kind_no, page_number, item_index, content) - 1 as integer) as chunk_index from ({_PARTS}) p"


def _content_query(name: str, kind: str, *also: str) -> None:
    columns = ["document_id", "content", "page_number", "item_index", "chunk_index", *also]

    @query(name, f"select {', '.join(columns)} from ({_RUNNING}) x where type = '{kind}'")
    def run(spark, d):
        return _chunks(spark, d).where(F.col("type") == kind).select(*columns)


for _kind in ("image", "table", "figure"):
    _content_query(f"prj_content_{_kind}", _kind)
_content_query("prj_content_code", "code", "code_type", "lines", "characters")

_CUT = S.sentence_chunks("select doc_id as k, coalesce(text, '') as t from documents")


@query("chunk_modality_g2", f"select document_id, type, cast(count(*) as bigint) as n, cast(sum(length(content)) as bigint) as chars from (select cast(k as varchar) as document_id, 'text' as type, content from ({_CUT}) t union all select document_id, type, content from ({_RUNNING}) x) y group by 1, 2")
def chunk_modality_g2(spark, d):
    """Texts cut at sentences, and one chunk for each image, table, code record and figure."""
    text = chunk_sentence_g2(table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("document_id"), F.col("text").alias("content"))).withColumn("type", F.lit("text"))
    both = union_chunks(text.select("document_id", "type", "content"), _chunks(spark, d))
    return both.groupBy("document_id", "type").agg(F.count("*").alias("n"), F.sum(F.length("content").cast("bigint")).alias("chars"))


@query("set_union_chunks", "select modality as type, cast(count(*) as bigint) as n from (select modality from document_chunks where modality = 'text' union all select modality from document_chunks where modality <> 'text') x group by 1")
def set_union_chunks(spark, d):
    c = table(spark, d, "document_chunks").select("chunk_id", "modality", "content")
    both = union_chunks(c.where("modality = 'text'"), c.where("modality <> 'text'").withColumn("extra", F.lit("x")))
    return both.groupBy(F.col("modality").alias("type")).agg(F.count("*").alias("n"))


@query(
    "join_enrich_lookup",
    f"""with c as (select * from ({_RUNNING}) x),
    i as (select document_id, image_index as chunk_index, arg_min(dims, o) as image_dimensions, arg_min(size, o) as image_size_bytes from (select document_id, image_index, coalesce(width, 0) || 'x' || coalesce(height, 0) as dims, coalesce(size_bytes, 0) as size, {{'p': coalesce(page_number, 0), 'o': {_OCR}, 'd': coalesce(width, 0) || 'x' || coalesce(height, 0), 's': coalesce(size_bytes, 0)}} as o from image_records) a group by 1, 2),
    t as (select document_id, table_index as chunk_index, arg_min(r, o) as table_rows, arg_min(k, o) as table_columns, arg_min(n, o) as table_cells from (select document_id, table_index, coalesce(n_rows, 0) as r, coalesce(n_cols, 0) as k, coalesce(total_cells, 0) as n, {{'p': coalesce(page_number, 0), 'r': coalesce(n_rows, 0), 'k': coalesce(n_cols, 0), 'n': coalesce(total_cells, 0)}} as o from table_records) a group by 1, 2),
    o as (select document_id, item_index as chunk_index, min({{'p': page_number, 't': code_type, 'l': lines, 'c': characters}}) as m from {_CODE} a group by 1, 2)
    select c.document_id, type, c.chunk_index, case when type = 'image' then image_dimensions end as image_dimensions, case when type = 'image' then image_size_bytes end as image_size_bytes, cast(case when type = 'table' then table_rows end as bigint) as table_rows, cast(case when type = 'table' then table_columns end as bigint) as table_columns, cast(case when type = 'table' then table_cells end as bigint) as table_cells,
    case when type = 'code' then o.m.t end as code_type, cast(case when type = 'code' then o.m.l end as bigint) as code_lines, cast(case when type = 'code' then o.m.c end as bigint) as code_characters
    from c left join i on i.document_id = c.document_id and i.chunk_index = c.chunk_index left join t on t.document_id = c.document_id and t.chunk_index = c.chunk_index left join o on o.document_id = c.document_id and o.chunk_index = c.chunk_index""",
)
def join_enrich_lookup(spark, d):
    out = content.join_enrich_lookup(_chunks(spark, d).select("document_id", "type", "chunk_index"), table(spark, d, IMG), table(spark, d, TAB), _code(spark, d))
    return out.select("document_id", "type", "chunk_index", "image_dimensions", "image_size_bytes", "table_rows", "table_columns", "table_cells", F.col("found_code_type").alias("code_type"), "code_lines", "code_characters")


_MEASURED = f"""select document_id, coalesce(page_number, 0) as page_number, coalesce(image_index, 0) as item_index, 'image' as type, coalesce(extracted_text, '') as content, 'Image with dimensions ' || coalesce(width, 0) || 'x' || coalesce(height, 0) as measures from {_I} a
union all select document_id, coalesce(page_number, 0), coalesce(table_index, 0), 'table', {_TABLE_TEXT}, 'Table with ' || coalesce(n_rows, 0) || ' rows and ' || coalesce(n_cols, 0) || ' columns' from (select distinct * from table_records) b
union all select document_id, page_number, item_index, 'code', content, '' from {_CODE} c
union all select document_id, coalesce(page_number, 0), coalesce(image_index, 0), 'figure', coalesce(extracted_text, ''), {_FIGURE_TYPE} || ' figure with dimensions ' || coalesce(width, 0) || 'x' || coalesce(height, 0) from {_I} e where {_IS_FIGURE}"""


@query("emb_text_select", f"select document_id, page_number, item_index, type, case when content <> '' then content else measures end as text from ({_MEASURED}) x")
def emb_text_select(spark, d):
    c = _chunks(spark, d)
    text = content.embedding_text(F.col("type"), F.col("content"), F.col("width"), F.col("height"), F.col("rows"), F.col("columns"), F.col("figure_type"))
    return c.select("document_id", "page_number", "item_index", "type", text.alias("text"))


@query("emb_type", "select chunk_id, case modality when 'image' then 'image_ocr' else modality end as embedding_type from document_chunks where modality in ('text', 'image', 'table', 'code', 'figure')")
def emb_type(spark, d):
    return content.known_types(table(spark, d, "document_chunks"), "modality").select("chunk_id", content.embedding_type(F.col("modality")).alias("embedding_type"))


@query("flt_known_type", "select chunk_id, cast(list_position(['text', 'image', 'table', 'code', 'figure'], modality) as integer) as type_order from document_chunks where modality in ('text', 'image', 'table', 'code', 'figure')")
def flt_known_type(spark, d):
    return content.known_types(table(spark, d, "document_chunks"), "modality").select("chunk_id", "type_order")


_WORDS = S.words('lower(' + S.text('content') + ')')


@query(
    "emb_generate",
    f"""with r as (select row_number() over () as r, chunk_id, content from document_chunks where modality in ('text', 'image', 'table', 'code', 'figure')),
    w as (select r, md5(w) as h from (select r, unnest({_WORDS}) as w from r) x),
    b as (select r, ('0x' || substr(h, 1, 8))::bigint % 64 as i, sum(case when substr(h, 9, 1) < '8' then 1 else -1 end) as n from w group by 1, 2)
    select chunk_id, list(coalesce(n, 0)::integer order by s.i) as counts from r cross join (select unnest(generate_series(0, 63)) as i) s left join b on b.r = r.r and b.i = s.i group by r.r, chunk_id""",
)
def emb_generate(spark, d):
    """The built-in embedder over all known types, its sums before they are scaled."""
    c = content.known_types(table(spark, d, "document_chunks"), "modality").select("chunk_id", "modality", "content")
    return embed(c, "content", Hashing(64, unit=False), 64, kind="modality").select("chunk_id", F.transform("embedding", lambda x: x.cast("int")).alias("counts"))


@query("emb_generate_all")
def emb_generate_all(spark, d):
    """The built-in embedder's vectors as they are stored, scaled to length 1; emb_generate has the sums."""
    c = table(spark, d, "document_chunks").select("chunk_id", "modality", "content")
    return embed_hashing(c, "content", kind="modality").select("chunk_id", "modality", "embedding")


# store ------------------------------------------------------------------------------------------------------------------

_STORED = "document_chunks where length(content) > 0"


@query("flt_store_nonempty", f"select chunk_id from {_STORED}")
def flt_store_nonempty(spark, d):
    return table(spark, d, "document_chunks").where(F.length("content") > 0).select("chunk_id")


@query("prj_store_meta", "select document_id, coalesce(chunk_index, 0) as chunk_index, coalesce(modality, 'unknown') as modality, cast(length(content) as integer) as length, coalesce(page_number, 0) as page_number, 'unknown' as embedding_model, 0 as embedding_dimension, case when metadata.source is null then 9 else 10 end as keys, metadata.source as source from " + _STORED)
def prj_store_meta(spark, d):
    c = table(spark, d, "document_chunks")
    extra = F.map_from_entries(F.filter(F.array(F.struct(F.lit("source").alias("k"), F.col("metadata.source").alias("v")), F.struct(F.lit("modality").alias("k"), F.lit("shadowed").alias("v"))), lambda e: e["v"].isNotNull()))
    s = store_metadata(c.withColumn("extra", extra).withColumn("type", F.col("modality")))
    return s.select("document_id", "chunk_index", "modality", "length", "page_number", "embedding_model", "embedding_dimension", F.size("metadata").alias("keys"), F.col("metadata")["source"].alias("source"))


@query("str_docid_store", "select document_id, translate(path, '/.', '__') as store_id from processed_documents where path is not null")
def str_docid_store(spark, d):
    return table(spark, d, "processed_documents").where("path is not null").select("document_id", files.store_id(F.col("path")).alias("store_id"))


@query("str_docid_parse", "select document_id, regexp_replace(regexp_replace(document_id, '^pdf_', ''), '_[^_]*\\z', '') || '.pdf' as file_name from processed_documents")
def str_docid_parse(spark, d):
    return table(spark, d, "processed_documents").select("document_id", files.document_id_parts(F.col("document_id")).alias("file_name"))


@query("str_doc_label", "select document_id, string_split(document_id, '_')[1] as label from processed_documents")
def str_doc_label(spark, d):
    return table(spark, d, "processed_documents").select("document_id", files.document_label(F.col("document_id")).alias("label"))


@query("lim_sample_preview", "select chunk_id, case when length(content) > 100 then substr(content, 1, 100) || '...' else content end as preview from document_chunks where content is not null")
def lim_sample_preview(spark, d):
    return table(spark, d, "document_chunks").where("content is not null").select("chunk_id", preview(F.col("content")).alias("preview"))


@query("win_file_ordinal", "select document_id, page_number, image_index, printf('image_%03d_page_%03d.json', row_number() over (partition by document_id order by coalesce(page_number, 0), coalesce(image_index, 0)), coalesce(page_number, 0)) as file_name from (select distinct document_id, page_number, image_index from image_records) x")
def win_file_ordinal(spark, d):
    return file_ordinals(table(spark, d, IMG).select("document_id", "page_number", "image_index").distinct(), "image", "json", "image_index").select("document_id", "page_number", "image_index", "file_name")


@query("win_item_index", "select document_id, page_number, table_index, cast(row_number() over (partition by document_id, page_number order by table_index) as integer) as item_index from (select distinct document_id, page_number, table_index from table_records) x")
def win_item_index(spark, d):
    from pyspark.sql import Window as W

    t = table(spark, d, TAB).select("document_id", "page_number", "table_index").distinct()
    return t.withColumn("item_index", F.row_number().over(W.partitionBy("document_id", "page_number").orderBy("table_index")))


# search -----------------------------------------------------------------------------------------------------------------

_L2 = "list_sum(list_transform(generate_series(1, len(a.embedding)), lambda i: (a.embedding[i]::double - b.embedding[i]::double) ** 2))"


def _knn(spark, d, metric, k):
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")
    near = search.knn(e.where("id % 100 = 0"), e, k, metric)
    return near.select("query_id", "id", F.round("distance", 6).alias("distance"), "rank")


_PAIRS = "embeddings a join embeddings b on a.vec_id % 100 = 0"


@query("join_knn", f"select query_id, id, round(dist, 6) as distance, cast(r as integer) as rank from (select query_id, id, dist, row_number() over (partition by query_id order by dist, id) as r from (select a.vec_id as query_id, b.vec_id as id, {_L2} as dist from {_PAIRS}) x) y where r <= 10")
def join_knn(spark, d):
    return _knn(spark, d, "l2", 10)


@query("topk_knn", f"select query_id, id, round(d, 6) as distance, cast(r as integer) as rank from (select query_id, id, d, row_number() over (partition by query_id order by d, id) as r from (select a.vec_id as query_id, b.vec_id as id, 1 - list_cosine_similarity(a.embedding::double[], b.embedding::double[]) as d from {_PAIRS} where a.vec_id <> b.vec_id) x) y where r <= 5")
def topk_knn(spark, d):
    """The five nearest by cosine, the query itself left out: six are looked for, so that it may be among them."""
    from pyspark.sql import Window as W

    near = _knn(spark, d, "cosine", 6).where("id <> query_id")
    return near.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy("rank"))).where("rank <= 5")


@query("vs_search_vector", f"select query_id, id, round(dist, 6) as distance from (select query_id, id, dist, row_number() over (partition by query_id order by dist, id) as r from (select a.vec_id as query_id, b.vec_id as id, {_L2} as dist from {_PAIRS} where b.label = 3) x) y where r <= 10")
def vs_search_vector(spark, d):
    """Every query vector against the rows that meet a filter."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")
    return search.knn(e.where("id % 100 = 0"), e.where("label = 3"), 10).select("query_id", "id", F.round("distance", 6).alias("distance"))


_STORED_L2 = "list_sum(list_transform(generate_series(1, 64), lambda i: (q.embedding[i]::double - c.embedding[i]::double) ** 2))"


@query("flt_meta_where", f"select query_id, document_id, chunk_index, page_number, distance from (select q.vec_id as query_id, c.document_id, coalesce(c.chunk_index, 0) as chunk_index, c.page_number, round({_STORED_L2}, 6) as distance, rank() over (partition by q.vec_id order by round({_STORED_L2}, 6)) as r from embeddings q join (select * from {_STORED}) c on q.vec_id = 0 where c.modality = 'code' and c.page_number = 1 and len(c.embedding) = 64 and len(list_filter(c.embedding, lambda x: x is null or isnan(x))) = 0) x where r <= 10")
def flt_meta_where(spark, d):
    """A search of a collection among the rows that meet conditions on their metadata; all that tie with the tenth."""
    import uuid

    from pyspark.sql import Window as W

    from lectern.operators.store import Collection
    from lectern.plans.workdir import folder

    c = table(spark, d, "document_chunks").where("size(embedding) = 64 and not exists(embedding, x -> x is null or isnan(x))").withColumn("type", F.col("modality"))
    store = Collection(spark, folder(spark), f"collection-{uuid.uuid4().hex}")
    store.store(c)
    vector = table(spark, d, "embeddings").where("vec_id = 0").select("embedding").first()[0]
    meets = (F.col("modality") == "code") & (F.col("page_number") == 1)
    near = store.search(vector, store.read().where(meets).count(), meets)
    m = F.col("metadata")
    rows = near.select(F.lit(0).cast("long").alias("query_id"), m["document_id"].alias("document_id"), m["chunk_index"].cast("int").alias("chunk_index"), m["page_number"].cast("int").alias("page_number"), F.round("distance", 6).alias("distance"))
    return rows.withColumn("r", F.rank().over(W.partitionBy("query_id").orderBy("distance"))).where("r <= 10").drop("r")


# reducers, sets -----------------------------------------------------------------------------------------------------------

@query("red_list_merge", "select doc_id, array_to_string(list_concat([coalesce(lang, '')], case when source is null then [] else [source] end), ',') as merged from documents")
def red_list_merge(spark, d):
    t = table(spark, d, "documents")
    return t.select("doc_id", F.array_join(list_merge(F.array(F.coalesce("lang", F.lit(""))), F.when(F.col("source").isNotNull(), F.array("source"))), ",").alias("merged"))


@query("red_dict_merge", "select doc_id, cast(doc_id as varchar) as a, coalesce(source, 'none') as b, 'right' as lang, 3 as n from documents")
def red_dict_merge(spark, d):
    t = table(spark, d, "documents")
    m = dict_merge(F.create_map(F.lit("a"), F.col("doc_id").cast("string"), F.lit("lang"), F.coalesce("lang", F.lit("none"))), F.create_map(F.lit("b"), F.coalesce("source", F.lit("none")), F.lit("lang"), F.lit("right")))
    return t.select("doc_id", m.alias("m")).select("doc_id", F.col("m")["a"].alias("a"), F.col("m")["b"].alias("b"), F.col("m")["lang"].alias("lang"), F.size("m").alias("n"))


@query("red_first_value", "select doc_id, lang as value from documents")
def red_first_value(spark, d):
    return table(spark, d, "documents").select("doc_id", first_value(F.col("lang"), F.col("source")).alias("value"))


_COUNT = "select document_id, cast(count(*) as bigint) as {0} from {1} group by 1"


@query("join_fullouter_counts", f"select coalesce(a.document_id, b.document_id) as document_id, coalesce(images, 0) as images, coalesce(tables, 0) as tables from ({_COUNT.format('images', IMG)}) a full join ({_COUNT.format('tables', TAB)}) b on a.document_id = b.document_id")
def join_fullouter_counts(spark, d):
    n = lambda t, c: table(spark, d, t).groupBy("document_id").agg(F.count("*").alias(c))
    return full_outer_counts(n(IMG, "images"), n(TAB, "tables"), "document_id", "images", "tables")


@query("set_union_keys", "select document_id from image_records union select document_id from table_records")
def set_union_keys(spark, d):
    return union_keys(table(spark, d, IMG), table(spark, d, TAB), "document_id")


@query("set_distinct", "select distinct modality from document_chunks")
def set_distinct(spark, d):
    return table(spark, d, "document_chunks").select("modality").distinct()


@query("join_zip_embedding", "select chunk_id, cast(len(embedding) as integer) as dimension from document_chunks where embedding is not null and len(embedding) > 0")
def join_zip_embedding(spark, d):
    """A vector stays in its text's row, so nothing has to be zipped by position."""
    return table(spark, d, "document_chunks").where(F.size("embedding") > 0).select("chunk_id", F.size("embedding").alias("dimension"))
