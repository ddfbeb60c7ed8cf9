"""Queries of counts, summaries, top-k and chart data."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import enrich
from lectern.functions.text import DIGIT, SPACE

from lectern.operators import statistics as T
from lectern.operators.store import store_metadata
from lectern.plans import pipeline
from lectern.plans import sql as S
from lectern.plans.content_queries import _CODE, _code
from lectern.plans.registry import query, table
from lectern.sinks import writers
from lectern.sources import config

IMG, TAB, CH = "image_records", "table_records", "document_chunks"
_KIND = "metadata.chunk_type"
_N = "cast(count(*) as bigint)"


@query("agg_by_type", f"select coalesce({_KIND}, 'unknown') as type, {_N} as n from document_chunks group by 1")
def agg_by_type(spark, d):
    return T.count_by(table(spark, d, CH), _KIND, "type")


@query("agg_by_modality", f"select coalesce(modality, 'unknown') as modality, {_N} as n from document_chunks group by 1")
def agg_by_modality(spark, d):
    return T.count_by(table(spark, d, CH), "modality", "modality")


_SUMMARY = f"{_N} as total_chunks, cast(coalesce(sum(case when modality = 'text' then length(coalesce(content, '')) end), 0) as bigint) as total_text_length, cast(count(*) filter (modality = 'image') as bigint) as total_images, cast(count(*) filter (modality = 'table') as bigint) as total_tables, cast(count(*) filter (modality = 'code') as bigint) as total_code_chunks, cast(count(*) filter (modality = 'figure') as bigint) as total_figures"


@query("agg_chunk_summary", f"select {_SUMMARY} from document_chunks")
def agg_chunk_summary(spark, d):
    return T.chunk_summary(table(spark, d, CH), kind="modality")


@query("flagship", f"select coalesce(lang, 'unknown') as lang, {_N} as total_chunks, cast(sum(length) as bigint) as total_text_length, cast(0 as bigint) as total_images, cast(0 as bigint) as total_tables, cast(0 as bigint) as total_code_chunks, cast(0 as bigint) as total_figures from ({S.sentence_chunks(f'select doc_id as k, {S.clean_doc_g2('text')} as t from documents')}) x join documents on doc_id = k group by 1")
def flagship(spark, d):
    from lectern.plans.all_queries import flagship as run

    return run(spark, d)


_KINDS = "select document_id, page_number, 'image' as kind from image_records union all select document_id, page_number, 'table' from table_records union all select document_id, page_number, modality from document_chunks where modality in ('code', 'figure')"


def _kinds(spark, d):
    one = lambda t, k: table(spark, d, t).select("document_id", "page_number", F.lit(k).alias("kind"))
    c = table(spark, d, CH).where("modality in ('code', 'figure')").select("document_id", "page_number", F.col("modality").alias("kind"))
    return one(IMG, "image").unionByName(one(TAB, "table")).unionByName(c)


@query("agg_extract_totals", f"select document_id, kind, {_N} as total, cast(count(distinct page_number) as bigint) as pages from ({_KINDS}) x group by 1, 2")
def agg_extract_totals(spark, d):
    return T.extraction_totals(_kinds(spark, d))


@query(
    "agg_extract_summary",
    f"""with p as (select document_id, max(metadata.page_count) as page_count from processed_documents group by 1),
    i as (select document_id, count(*) as images, count(distinct page_number) as image_pages, count(*) filter (ocr_success) as with_ocr_text from image_records group by 1),
    t as (select document_id, count(*) as tables, count(distinct page_number) as table_pages, sum(coalesce(total_cells, 0)) as total_cells from table_records group by 1)
    select document_id, coalesce(page_count, 0) as total_pages, cast(coalesce(images, 0) as bigint) as images, cast(coalesce(image_pages, 0) as bigint) as image_pages, cast(coalesce(with_ocr_text, 0) as bigint) as with_ocr_text, cast(coalesce(tables, 0) as bigint) as tables, cast(coalesce(table_pages, 0) as bigint) as table_pages, cast(coalesce(total_cells, 0) as bigint) as total_cells, round(coalesce(images, 0) / greatest(coalesce(page_count, 0), 1), 6) as image_rate, round(coalesce(tables, 0) / greatest(coalesce(page_count, 0), 1), 6) as table_rate
    from p left join i using (document_id) left join t using (document_id)""",
)
def agg_extract_summary(spark, d):
    pages = table(spark, d, "processed_documents").groupBy("document_id").agg(F.max("metadata.page_count").alias("page_count"))
    out = T.extraction_summary(table(spark, d, IMG), table(spark, d, TAB), pages)
    return out.withColumns({c: F.round(c, 6) for c in ("image_rate", "table_rate")})


@query("agg_embedding_stats", f"select {_N} as total, round(avg(len(embedding)), 6) as mean_length, cast(min(len(embedding)) as integer) as min_length, cast(max(len(embedding)) as integer) as max_length, round(stddev_pop(len(embedding)), 6) as std_length from document_chunks where embedding is not null")
def agg_embedding_stats(spark, d):
    return T.embedding_stats(table(spark, d, CH)).withColumns({c: F.round(c, 6) for c in ("mean_length", "std_length")})


@query("agg_embed_node_stats", f"select {_N} as chunks_processed, cast(count(embedding) as bigint) as chunks_embedded, cast(coalesce((select len(embedding) from document_chunks where embedding is not null order by chunk_id, len(embedding) limit 1), 0) as integer) as embedding_dimension from document_chunks")
def agg_embed_node_stats(spark, d):
    return T.embed_node_stats(table(spark, d, CH), ["chunk_id"])


@query("agg_collection_stats", f"select modality as chunk_type, coalesce({_KIND}, 'unknown') as declared, {_N} as n, cast(sum(length(content)) as bigint) as chars from document_chunks where length(content) > 0 group by 1, 2")
def agg_collection_stats(spark, d):
    rows = store_metadata(table(spark, d, CH).withColumn("extra", F.create_map(F.lit("declared"), F.coalesce(_KIND, F.lit("unknown")))))
    return rows.groupBy(F.col("modality").alias("chunk_type"), F.col("metadata")["declared"].alias("declared")).agg(F.count("*").alias("n"), F.sum("length").alias("chars"))


@query("agg_group_by_document", f"select coalesce(document_id, 'unknown') as document_id, {_N} as n, cast(sum(length(content)) as bigint) as chars from document_chunks group by 1")
def agg_group_by_document(spark, d):
    return table(spark, d, CH).groupBy(F.coalesce("document_id", F.lit("unknown")).alias("document_id")).agg(F.count("*").alias("n"), F.sum(F.length("content").cast("bigint")).alias("chars"))


@query("agg_process_summary", f"select cast(count(distinct document_id) as bigint) as documents_processed, {_N} as chunks_created, count(*) > 0 as success from document_chunks")
def agg_process_summary(spark, d):
    return table(spark, d, CH).agg(F.countDistinct("document_id").alias("documents_processed"), F.count("*").alias("chunks_created"), (F.count("*") > 0).alias("success"))


def _texts(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("document_id"), F.col("text").alias("content"))


_CLEAN = f"select doc_id as k, {S.clean_doc_g2('text')} as t from documents"


@query("agg_doc_summary", f"with c as (select k, count(*) as n from ({S.sentence_chunks(_CLEAN)}) x group by k), s as ({_CLEAN}) select cast(doc_id as varchar) as document_id, cast(length(coalesce(text, '')) as integer) as original_length, cast(length(t) as integer) as cleaned_length, cast(coalesce(n, 0) as bigint) as total_chunks, cast(coalesce(n, 0) as bigint) as text_chunks, cast(0 as bigint) as other_chunks from documents join s on s.k = doc_id left join c on c.k = doc_id")
def agg_doc_summary(spark, d):
    from lectern.schemas import Options

    docs = _texts(spark, d)
    return pipeline.document_summary(docs, pipeline.process(docs, Options(extract_content=False)))


@query("agg_final_summary", f"select cast((select count(distinct document_id) from processed_documents) as bigint) as total_documents, {_N} as total_chunks, cast(count(embedding) as bigint) as embedded_chunks, cast(count(*) filter (length(content) > 0 and embedding is not null) as bigint) as stored_chunks from document_chunks")
def agg_final_summary(spark, d):
    c = table(spark, d, CH)
    return pipeline.final_summary(table(spark, d, "processed_documents"), c, c)


@query("agg_modality_dist_g1", f"select modality, {_N} as chunks, cast(count(distinct document_id) as bigint) as documents from document_chunks group by 1")
def agg_modality_dist_g1(spark, d):
    return table(spark, d, CH).groupBy("modality").agg(F.count("*").alias("chunks"), F.countDistinct("document_id").alias("documents"))


@query("agg_image_stats", f"select document_id, {_N} as total_images, cast(count(distinct page_number) as bigint) as pages, cast(coalesce(sum(size_bytes), 0) as bigint) as total_bytes, round(avg(size_bytes), 6) as average_bytes, cast(count(*) filter (width > height) as bigint) as landscape, cast(count(*) filter (width <= height) as bigint) as portrait from image_records group by 1")
def agg_image_stats(spark, d):
    return T.image_stats(table(spark, d, IMG), ["document_id"]).withColumn("average_bytes", F.round("average_bytes", 6))


_IMAGES = f"select document_id, {_N} as n from image_records group by 1"


def _images(spark, d):
    return table(spark, d, IMG).groupBy("document_id").agg(F.count("*").alias("n"))


@query("agg_argmax_images", f"select document_id, n from ({_IMAGES}) x where n > 0 order by n desc, document_id limit 1")
def agg_argmax_images(spark, d):
    return T.argmax_document(_images(spark, d))


@query("topk_docs", f"select document_id, n, string_split(document_id, '_')[1] as label from ({_IMAGES}) x order by n desc, document_id limit 10")
def topk_docs(spark, d):
    return T.top_documents(_images(spark, d))


@query("sort_docs", "select document_id, cast(count(distinct page_number) as bigint) as pages from image_records group by 1 order by 1")
def sort_docs(spark, d):
    return table(spark, d, IMG).groupBy("document_id").agg(F.countDistinct("page_number").alias("pages")).orderBy("document_id")


@query("sort_pages", f"select document_id, page_number, {_N} as n from image_records group by 1, 2 order by 1, 2")
def sort_pages(spark, d):
    return table(spark, d, IMG).groupBy("document_id", "page_number").agg(F.count("*").alias("n")).orderBy("document_id", "page_number")


@query("lim_sample", "select chunk_id, modality from (select chunk_id, modality, row_number() over (partition by modality order by chunk_id) as r from (select distinct chunk_id, modality from document_chunks where modality in ('table', 'figure')) x) y where r <= 3")
def lim_sample(spark, d):
    c = table(spark, d, CH).select("chunk_id", "modality").distinct()
    return c.where("modality = 'table'").orderBy("chunk_id").limit(3).unionByName(c.where("modality = 'figure'").orderBy("chunk_id").limit(3))


@query("lim_one", "select chunk_id, chunk_index from document_chunks order by chunk_id limit 1")
def lim_one(spark, d):
    return table(spark, d, CH).orderBy("chunk_id").select("chunk_id", "chunk_index").limit(1)


_TEXT = S.text("content")
_WORDS = f"len({S.words(_TEXT)})"


def _histogram_sql(value: str, modality: str, bins: int) -> str:
    return f"""with v as (select cast({value} as double) as v from document_chunks where modality = '{modality}' and {value} is not null),
    e as (select case when a = b then a - 0.5 else a end as a, case when a = b then b + 0.5 else b end as b from (select min(v) as a, max(v) as b from v) x where a is not null),
    c as (select cast(least(floor((v - a) / ((b - a) / {bins})), {bins - 1}) as integer) as bin, count(*) as n from v, e group by 1),
    f as (select cast(unnest(generate_series(0, {bins - 1})) as integer) as bin, a, b from e)
    select f.bin, round(a + f.bin * ((b - a) / {bins}), 6) as low, round(a + (f.bin + 1) * ((b - a) / {bins}), 6) as high, cast(coalesce(n, 0) as bigint) as n from f left join c on c.bin = f.bin"""


def _histogram(spark, d, value, modality, bins):
    rows = table(spark, d, CH).where(F.col("modality") == modality).select(value(F.coalesce("content", F.lit(""))).alias("v"))
    return T.histogram(rows, "v", bins).withColumns({c: F.round(c, 6) for c in ("low", "high")})


_SENTENCES = f"len(list_filter(string_split({_TEXT}, '.'), lambda s: {S.has('s', f'[^{SPACE}]')}))"
_COMPLEXITY = f"cast(case when {_SENTENCES} > 0 then round_even(least(cast({_WORDS} as double) / {_SENTENCES} / 20.0, 1.0), 3) else 0.0 end as double)"


@query("agg_histogram", _histogram_sql(_WORDS, "table", 10))
def agg_histogram(spark, d):
    return _histogram(spark, d, enrich.n_words, "table", 10)


@query("agg_histogram_figures", _histogram_sql(_WORDS, "figure", 15))
def agg_histogram_figures(spark, d):
    return _histogram(spark, d, enrich.n_words, "figure", 15)


@query("agg_histogram_complexity", _histogram_sql(_COMPLEXITY, "figure", 15))
def agg_histogram_complexity(spark, d):
    return _histogram(spark, d, enrich.complexity, "figure", 15)


@query("agg_value_counts", f"select case when contains(lower({_TEXT}), 'figure') then 'Figure Reference' when contains(lower({_TEXT}), 'diagram') then 'Diagram' when contains(lower({_TEXT}), 'chart') then 'Chart' else 'Other' end as kind, {_N} as n from document_chunks where modality = 'figure' group by 1")
def agg_value_counts(spark, d):
    from lectern.functions.detect import figure_kind

    return T.value_counts(table(spark, d, CH).where("modality = 'figure'"), figure_kind(F.coalesce("content", F.lit(""))), "kind")


_HEADER = f"(contains({S.lines(_TEXT)}[1], '|') or contains({S.lines(_TEXT)}[1], chr(9)))"


@query("agg_header_split", f"select cast(count(*) filter ({_HEADER}) as bigint) as with_header, cast(count(*) filter (not {_HEADER}) as bigint) as without_header from document_chunks where modality = 'table'")
def agg_header_split(spark, d):
    header = enrich.table_g1(F.coalesce("content", F.lit("")))["has_header"]
    return table(spark, d, CH).where("modality = 'table'").agg(F.count_if(header).alias("with_header"), F.count_if(~header).alias("without_header"))


_DOCS_WITH = "cast(count(distinct case when modality = '{0}' then document_id end) as bigint)"


@query("agg_content_summary", f"select cast(count(*) filter (modality = 'table') as bigint) as total_tables, cast(count(*) filter (modality = 'figure') as bigint) as total_figures, cast(count(*) filter (modality = 'text') as bigint) as total_text, cast(count(*) filter (modality = 'code') as bigint) as total_code, {_DOCS_WITH.format('figure')} as documents_with_figures, {_DOCS_WITH.format('table')} as documents_with_tables, {_DOCS_WITH.format('figure')} + {_DOCS_WITH.format('table')} as total_documents from document_chunks")
def agg_content_summary(spark, d):
    return T.content_summary(table(spark, d, CH), "modality")


@query("agg_percent", f"select modality, n, round(n * 100.0 / sum(n) over (), 6) as share from (select modality, {_N} as n from document_chunks group by 1) x")
def agg_percent(spark, d):
    return T.percent(T.count_by(table(spark, d, CH), "modality", "modality")).withColumn("share", F.round("share", 6))


@query("agg_distinct_sets", "select array_to_string(list_sort(list(distinct modality)), ',') as modalities, array_to_string(list_sort(list(distinct metadata.chunk_type)), ',') as chunk_types from document_chunks")
def agg_distinct_sets(spark, d):
    # sets of kinds, which the data model bounds
    return table(spark, d, CH).agg(F.array_join(F.array_sort(F.collect_set("modality")), ",").alias("modalities"), F.array_join(F.array_sort(F.collect_set(_KIND)), ",").alias("chunk_types"))


def _errors(spark, d):
    """Errors of an ingestion: paths that don't exist, documents without a path, chunks without content."""
    missing = config.category_paths(table(spark, d, "quiz_categories")).join(table(spark, d, "processed_documents").select("path").distinct(), "path", "left_anti").select(F.lit("ingestion").alias("category"))
    pathless = table(spark, d, "processed_documents").where("path is null").select(F.lit("validation").alias("category"))
    empty = table(spark, d, CH).where("content is null").select(F.lit("surprise").alias("category"))
    return missing.unionByName(pathless).unionByName(empty)


_ERRORS = "select 'ingestion' as category from (select unnest(doc_paths) as path from quiz_categories) a where path not in (select path from processed_documents where path is not null) union all select 'validation' from processed_documents where path is null union all select 'other' from document_chunks where content is null"


@query("agg_error_counts", f"select c.category, cast(count(e.category) as bigint) as n from (select unnest({T.ERROR_CATEGORIES}) as category) c left join ({_ERRORS}) e on e.category = c.category group by 1")
def agg_error_counts(spark, d):
    return T.error_counts(_errors(spark, d))


@query("err_summary", f"select cast(count(*) as bigint) as total_errors, count(*) > 0 as has_errors from ({_ERRORS}) e")
def err_summary(spark, d):
    return T.error_summary(_errors(spark, d))


@query("prd_validate_config", "select 'configuration' as category, unnest(['model_name', 'embedding_model']) as setting")
def prd_validate_config(spark, d):
    from lectern.schemas import CONFIG

    made = table(spark, d, "quiz_categories").limit(1).select(F.lit("files").alias("database_type"), F.lit("").alias("model_name"))
    row = made.select(*[F.col(c) if c in made.columns else F.lit(None).cast("string").alias(c) for c in ("database_type", "model_name", "embedding_model")])
    return config.config_errors(row) if CONFIG else row


@query("sink_embeddings", "select modality as embedding_type, cast(count(*) as bigint) as count, cast(max(len(embedding)) as integer) as dimension, cast(sum(len(embedding)) as bigint) as numbers from document_chunks where embedding is not null group by 1")
def sink_embeddings(spark, d):
    """Vectors written by type and read back."""
    import uuid

    from lectern.plans.workdir import folder

    path = f"{folder(spark)}/embeddings-{uuid.uuid4().hex}"
    kinds = F.struct(F.col("modality").alias("embedding_type"))
    writers.write_embeddings(table(spark, d, CH).select("chunk_id", "embedding", kinds.alias("embedding_metadata")), path)
    back = spark.read.schema("chunk_id string, embedding array<float>, embedding_type string").parquet(path)
    numbers = back.groupBy("embedding_type").agg(F.sum(F.size("embedding").cast("bigint")).alias("numbers"))
    return writers.embedding_metadata(back).join(numbers, "embedding_type")


@query("sink_extracted", f"select document_id, 'table' as kind, cast(count(*) * 2 as bigint) as files from (select distinct * from table_records) t group by 1 union all select document_id, 'image', cast(count(*) as bigint) from (select distinct * from image_records) i group by 1 union all select document_id, 'code', cast(count(*) as bigint) from {_CODE} c group by 1")
def sink_extracted(spark, d):
    out = writers.extracted_files(table(spark, d, IMG).distinct(), table(spark, d, TAB).distinct(), _code(spark, d))
    return out.groupBy("document_id", F.regexp_extract("file_name", "^[a-z]+", 0).alias("kind")).agg(F.count("*").alias("files"))


_LINE = "printf('- Image %d: %dx%d, %d bytes', coalesce(image_index, 0), coalesce(width, 0), coalesce(height, 0), coalesce(size_bytes, 0))"


@query(
    "sink_img_report",
    f"""with p as (select document_id, coalesce(page_number, 0) as page, count(*) as n, coalesce(sum(size_bytes), 0) as bytes, string_agg({_LINE}, chr(10) order by coalesce(image_index, 0), {_LINE}) as body from image_records group by 1, 2),
    w as (select document_id, sum(n) as n, sum(bytes) as bytes, count(*) as pages, string_agg(printf('## Page %d (%d images)', page, n) || chr(10) || body, chr(10) || chr(10) order by page) as body from p group by 1)
    select document_id, printf('# Images%s- Total: %d%s- Pages with images: %d%s- Bytes: %d%s', chr(10) || chr(10), cast(n as bigint), chr(10), pages, chr(10), cast(bytes as bigint), chr(10) || chr(10)) || body as report from w""",
)
def sink_img_report(spark, d):
    return T.image_report(table(spark, d, IMG))


@query("sink_gallery")
def sink_gallery(spark, d):
    return writers.gallery(table(spark, d, IMG))


@query("sink_export", "select document_id, coalesce(chunk_index, 0) as chunk_index, cast(len(embedding) as integer) as dimension, cast(length(content) as integer) as length from document_chunks where length(content) > 0")
def sink_export(spark, d):
    """A collection's rows as its export writes them, read back."""
    store = _collection(spark, d)
    path = f"{store.path}-export"
    store.export(path)
    back = spark.read.schema("id string, document string, metadata map<string,string>, embedding array<string>").json(path)
    m = F.col("metadata")
    return back.select(m["document_id"].alias("document_id"), m["chunk_index"].cast("int").alias("chunk_index"), F.when(F.col("embedding").isNotNull(), F.size("embedding")).alias("dimension"), F.length("document").alias("length"))


@query("sink_charts", "select coalesce(a.document_id, b.document_id) as document_id, coalesce(i, 0) as images, coalesce(t, 0) as tables from (select document_id, cast(count(*) as bigint) as i from image_records group by 1) a full join (select document_id, cast(count(*) as bigint) as t from table_records group by 1) b on a.document_id = b.document_id")
def sink_charts(spark, d):
    """Data of the heat map: every document with its images and tables."""
    from lectern.operators.merge import full_outer_counts

    n = lambda t, c: table(spark, d, t).groupBy("document_id").agg(F.count("*").alias(c))
    return full_outer_counts(n(IMG, "images"), n(TAB, "tables"), "document_id", "images", "tables")


@query("node_status", "select 'process' as node, count(*) > 0 as success from document_chunks union all select 'embed', count(embedding) > 0 from document_chunks")
def node_status(spark, d):
    c = table(spark, d, CH)
    one = lambda name, n: c.agg((n > 0).alias("success")).select(F.lit(name).alias("node"), "success")
    return one("process", F.count("*")).unionByName(one("embed", F.count("embedding")))


@query("math_numbers", f"select chunk_id, round(length(content) / nullif({_WORDS}, 0), 6) as mean, cast(floor(length(content) / 4) as bigint) as quarters, {S.has(_TEXT, f'[{DIGIT}]')} as has_numbers from document_chunks where content is not null")
def math_numbers(spark, d):
    c = table(spark, d, CH).where("content is not null")
    return c.select("chunk_id", F.round(F.length("content") / F.nullif(enrich.n_words(F.col("content")), F.lit(0)), 6).alias("mean"), F.floor(F.length("content") / 4).alias("quarters"), F.col("content").rlike(f"[{DIGIT}]").alias("has_numbers"))


@query("json_props", "select event_id, json_extract_string(props, '$.' || k) as value, k from (select event_id, props, unnest(json_keys(props)) as k from events) x")
def json_props(spark, d):
    e = table(spark, d, "events").select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("k", "value"))
    return e.select("event_id", "value", "k")


@query("vs_store")
def vs_store(spark, d):
    """Documents through the whole pipeline into a new collection, its rows by kind (rows only)."""
    import uuid

    from lectern.operators.store import Collection
    from lectern.plans.workdir import folder

    store = Collection(spark, folder(spark), f"collection-{uuid.uuid4().hex}")
    pipeline.Pipeline(spark).run(_texts(spark, d), table(spark, d, IMG), table(spark, d, TAB), store)
    return T.count_by(store.read(), "chunk_type", "chunk_type")


def _collection(spark, d):
    """A new collection that holds all chunks with content."""
    import uuid

    from lectern.operators.store import Collection
    from lectern.plans.workdir import folder

    store = Collection(spark, folder(spark), f"collection-{uuid.uuid4().hex}")
    store.store(table(spark, d, CH).withColumn("type", F.col("modality")))
    return store


_KEPT = "document_chunks where length(content) > 0"


@query("vs_delete_doc", f"select document_id, {_N} as n from {_KEPT} and document_id <> (select min(document_id) from document_chunks) group by 1")
def vs_delete_doc(spark, d):
    store = _collection(spark, d)
    store.delete_document(table(spark, d, CH).agg(F.min("document_id")).first()[0])
    return T.count_by(store.read(), "document_id", "document_id")


@query("vs_stats", f"select modality as chunk_type, {_N} as n from {_KEPT} group by 1")
def vs_stats(spark, d):
    return T.count_by(_collection(spark, d).read(), "chunk_type", "chunk_type")


@query("vs_clear", f"select {_N} as n from document_chunks where false")
def vs_clear(spark, d):
    store = _collection(spark, d)
    store.clear()
    return store.read().agg(F.count("*").alias("n"))


@query("vs_export", f"select document_id, chunk_index, modality, cast(length(content) as integer) as length from (select document_id, coalesce(chunk_index, 0) as chunk_index, modality, content from {_KEPT}) x")
def vs_export(spark, d):
    store = _collection(spark, d)
    path = f"{store.path}-export"
    store.export(path)
    back = spark.read.schema("document string, metadata map<string,string>").json(path)
    m = F.col("metadata")
    return back.select(m["document_id"].alias("document_id"), m["chunk_index"].cast("int").alias("chunk_index"), m["modality"].alias("modality"), F.length("document").alias("length"))


@query("vs_search_text")
def vs_search_text(spark, d):
    """The chunks nearest to a text by the built-in embedder (rows only)."""
    from lectern.operators.embedding import embed_hashing
    from lectern.operators.search import search

    chunks = embed_hashing(table(spark, d, CH).where("length(content) > 0").select("chunk_id", F.col("modality").alias("type"), "content"), "content")
    from lectern.operators.embedding import Hashing

    rows = chunks.select(F.col("chunk_id").alias("id"), F.col("content").alias("document"), F.create_map(F.lit("type"), F.col("type")).alias("metadata"), "embedding")
    return search(rows, Hashing(64)(["every network near the condition"])[0].tolist(), 10).select("id", F.round("distance", 6).alias("distance"))


@query("agg_storage_stats")
def agg_storage_stats(spark, d):
    """Bytes and files of a collection's directory (rows only)."""
    stats = _collection(spark, d).storage_stats()
    return spark.createDataFrame([(stats["total_size_bytes"], stats["file_count"])], "total_size_bytes long, file_count long")
