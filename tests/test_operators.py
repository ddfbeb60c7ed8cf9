import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern import errors as E
from lectern.operators import content, merge, search
from lectern.operators import statistics as T
from lectern.operators.embedding import Hashing, choose_device, embed, embed_hashing
from lectern.operators.store import Collection, store_metadata
from lectern.plans.pipeline import Pipeline
from lectern.schemas import IMAGE_RECORD, TABLE_RECORD
from lectern.sinks import writers
from lectern.plans.tracing import Trace
from lectern.sources import analysis, config, files
from lectern.streaming import files as stream

IMAGES = [("d", 1, 1, 200, 100, "rgb", 10, "seen", True), ("d", 1, 2, 60, 60, None, 5, None, None), ("d", 2, 1, 10, 0, "rgb", None, "", False), ("e", None, None, None, None, None, None, None, None)]
TABLES = [("d", 1, 1, 2, 2, [["a", " "], ["", None]], 4, 1), ("d", 3, 1, None, None, None, None, None), ("f", 1, 1, 0, 0, [], 0, 0)]


@pytest.fixture(scope="module")
def images(spark):
    return spark.createDataFrame(IMAGES, IMAGE_RECORD)


@pytest.fixture(scope="module")
def tables(spark):
    return spark.createDataFrame(TABLES, TABLE_RECORD)


def test_tables(tables):
    got = [tuple(r) for r in tables.select(*[v.alias(k) for k, v in content.table_stats(F.col("cell_data")).items()]).collect()]
    assert got == [(2, 2, 4, 1), (0, 0, 0, 0), (0, 0, 0, 0)]
    assert [r[0] for r in tables.select(content.table_to_text(F.col("cell_data"))).collect()] == ["Table Content:\n" + "=" * 50 + "\na |  ", "", ""]


def test_code(spark):
    page = "text `one` and\n```py\nx = 1\n```\nfor x in y:\n  // note\nplain"
    rows = [("d", 1, page, "x"), ("d", 2, None, "x"), ("d", 3, "", "x"), ("e", 1, "nothing here", "x")]
    got = sorted(content.code_records(spark.createDataFrame(rows, "document_id string, page_number int, content string, lines string")).collect(), key=lambda r: r.chunk_index)
    assert [(r.chunk_index, r.type, r.content, r.lines, r.characters) for r in got][0] == (1, "markdown_code_block", "```py\nx = 1\n```", 3, 15)
    assert got[-1].type == "code_like_lines" and got[-1].content == "x = 1\nfor x in y:\n// note" and got[-1].line_details[1].rule == 1 and got[-1].lines == 3
    assert {r.document_id for r in got} == {"d"} and "one" in [r.content for r in got]


def test_content_chunks_and_lookup(spark, images, tables):
    code = content.code_records(spark.createDataFrame([("d", 1, "x = 1")], "document_id string, page_number int, content string"))
    chunks = content.content_chunks(images, tables, code)
    d = sorted((r for r in chunks.collect() if r.document_id == "d"), key=lambda r: r.chunk_index)
    assert [r.type for r in d] == ["image"] * 3 + ["table"] * 2 + ["code"] + ["figure"] * 2 and [r.chunk_index for r in d] == list(range(8))
    assert d[1].content == "" and d[1].ocr_success is False and d[4].rows == 0 and d[6].figure_type == "text_diagram"
    found = {(r.document_id, r.chunk_index): r for r in content.join_enrich_lookup(chunks.select("document_id", "type", "chunk_index"), images, tables, code).collect()}
    assert len(found) == chunks.count() and found["d", 1].image_dimensions == "200x100" and found["d", 6].image_dimensions is None and found["d", 0].image_dimensions is None
    text = chunks.select("type", content.embedding_text(F.col("type"), F.col("content"), F.col("width"), F.col("height"), F.col("rows"), F.col("columns"), F.col("figure_type")).alias("t")).collect()
    assert {"Image with dimensions 60x60", "Table with 0 rows and 0 columns", "standard_figure figure with dimensions 60x60"} <= {r.t for r in text}


def test_statistics(spark, images):
    df = spark.createDataFrame([(1.0,), (1.0,), (2.0,), (11.0,), (None,)], "v double")
    got = [(r.bin, r.n) for r in T.histogram(df, "v", 10).orderBy("bin").collect()]
    assert got == [(0, 2), (1, 1), *((k, 0) for k in range(2, 9)), (9, 1)]
    assert sum(r.n for r in T.histogram(spark.createDataFrame([(3.0,)] * 4, "v double"), "v", 3).collect()) == 4
    assert T.histogram(df.limit(0), "v", 3).count() == 0
    s = {r.document_id: r for r in T.image_stats(images, ["document_id"]).collect()}
    assert (s["d"].total_images, s["d"].pages, s["d"].total_bytes, s["d"].landscape, s["d"].portrait) == (3, 2, 15, 2, 1) and s["e"].total_bytes == 0
    n = spark.createDataFrame([("b_x", 3), ("a_y", 3), ("c_z", 0)], "document_id string, n long")
    assert T.argmax_document(n).first().document_id == "a_y" and [r.label for r in T.top_documents(n, k=2).collect()] == ["a", "b"]
    assert T.argmax_document(n.where("n = 0")).count() == 0
    assert {r.share for r in T.percent(n.where("n = 0")).collect()} == {0.0}
    e = spark.createDataFrame([("chunking",), ("odd",), (None,), ("other",)], "category string")
    assert dict(T.error_counts(e).collect()) == {**dict.fromkeys(T.ERROR_CATEGORIES, 0), "chunking": 1, "other": 3}
    assert tuple(T.error_summary(e.limit(0)).first()) == (0, False)
    assert T.embedding_stats(spark.createDataFrame([(None,)], "embedding array<float>")).count() == 0
    report = {r.document_id: r.report for r in T.image_report(images).collect()}
    assert report["d"].startswith("# Images\n\n- Total: 3\n- Pages with images: 2\n- Bytes: 15\n\n## Page 1 (2 images)\n- Image 1: 200x100, 10 bytes\n")


def test_merges(spark):
    df = spark.createDataFrame([({"a": "1", "b": "1"}, {"b": "2"}), (None, {"c": "3"}), ({"d": "4"}, None)], "a map<string,string>, b map<string,string>")
    assert [r[0] for r in df.select(merge.dict_merge(F.col("a"), F.col("b"))).collect()] == [{"a": "1", "b": "2"}, {"c": "3"}, {"d": "4"}]
    lists = spark.createDataFrame([([1], [2]), (None, [2]), ([1], None)], "a array<int>, b array<int>")
    assert [r[0] for r in lists.select(merge.list_merge(F.col("a"), F.col("b"))).collect()] == [[1, 2], [2], [1]]
    a, b = spark.createDataFrame([("x", 1)], "k string, l long"), spark.createDataFrame([("y", 2)], "k string, r long")
    assert {tuple(r) for r in merge.full_outer_counts(a, b, "k", "l", "r").collect()} == {("x", 1, 0), ("y", 0, 2)}


@pytest.mark.parametrize("slices", [False, True])
def test_knn(spark, monkeypatch, slices):
    if slices:
        monkeypatch.setattr(search, "MOST_QUERY_BYTES", 600)
    rng = np.random.default_rng(1)
    rows = [(k, rng.normal(size=8).tolist(), "x") for k in range(60)] + [(100, None, "x"), (101, [1.0], "x"), (102, [0.0] * 8, "x")]
    df = spark.createDataFrame(rows, "id long, embedding array<double>, distance string")
    x = np.array([r[1] for r in rows[:60]] + [[0.0] * 8])
    ids = [*range(60), 102]
    got = {}
    for r in search.knn(df.where("id < 9"), df, 4).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.id))
    for q in range(9):
        want = sorted(ids, key=lambda i: (((x[ids.index(i)] - x[q]) ** 2).sum(), i))[:4]
        assert [i for _, i in sorted(got[q])] == want
    assert 102 not in {r.id for r in search.knn(df.where("id < 3"), df, 100, "cosine").collect()}
    assert search.knn(df.limit(0), df).count() == 0


def test_embedding(spark):
    df = spark.createDataFrame([("text", "a b a"), ("image", None), ("odd", "x")], "type string, t string")
    got = {r.type: r for r in embed_hashing(df, "t", 16).collect()}
    assert set(got) == {"text", "image"} and np.isclose(np.linalg.norm(got["text"].embedding), 1) and not any(got["image"].embedding)
    assert got["image"].embedding_metadata.embedding_type == "image_ocr" and got["text"].embedding_metadata.dimension == 16
    assert embed(df, "t", Hashing(4, unit=False), 4, batch=1).where("type = 'text'").select(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + F.abs(x))).first()[0] == 3.0
    assert choose_device("tpu") == "tpu" and choose_device(None, "mps", ("cpu", "mps")) == "mps" and choose_device(available=("cpu", "cuda", "mps")) == "cuda" and choose_device() == "cpu"


def test_collection_and_pipeline(spark, tmp_path, images, tables):
    docs = spark.createDataFrame([("d", "One sentence. Another one. " * 60, "x"), ("e", None, "x"), (None, "gone", "x")], "document_id string, content string, modality string")
    store = Collection(spark, f"file://{tmp_path}", "c")
    seen = []
    pipe = Pipeline(spark).with_options(chunk_size=300, overlap=50).hook("chunks", lambda df: seen.append(1) or df)
    summary = pipe.run(docs, images, tables, store)
    assert seen == [1] and summary["success"] and summary["total_documents"] == 2
    rows = store.read()
    assert summary["stored"]["stored_chunks"] == rows.count() == rows.where("length(document) > 0").count() > 5 and summary["embedded_chunks"] == summary["total_chunks"]
    first = rows.where("modality = 'text'").first()
    assert first.metadata["document_id"] == "d" and first.embedding_dimension == 64 and first.embedding_model == "hashing"
    hit = store.search(list(first.embedding), 2, F.col("modality") == "text").collect()
    assert hit[0].distance == pytest.approx(0) and len(hit) == 2
    assert store.search_text(first.document, 1).first().distance == pytest.approx(0, abs=1e-6)
    n = rows.count()
    assert store.store(pipe.plan(docs)["embedded"])["stored_chunks"] > 0 and store.read().count() > n
    assert store.delete_document("d") > 0 and store.read().where("document_id = 'd'").count() == 0 and store.delete_document("d") == 0
    assert store.export(f"file://{tmp_path}/out")["exported_chunks"] == store.stats()["total_chunks"] == sum(store.stats()["chunk_type_distribution"].values())
    assert store.storage_stats()["total_size_bytes"] > 0
    assert store.clear()["success"] and store.read().count() == 0 and store.stats()["metadata_keys"] == [] and Collection(spark, f"file://{tmp_path}", "c").read().count() == 0
    failed = Pipeline(spark).run(docs.limit(0), collection=store)
    assert not failed["success"] and failed["total_chunks"] == 0


def test_settings_and_errors():
    with pytest.raises(E.ValidationError, match="model_name, embedding_model"):
        E.require({"database_type": "x", "model_name": ""}, ["model_name", "database_type", "embedding_model"])
    c = E.ErrorCounter()
    c.handle(ValueError("x"), "odd", reraise=False)
    f = E.counted(c, "chunking", reraise=False)(lambda: 1 / 0)
    assert f() is None and c.summary() == {"total_errors": 2, "error_breakdown": {**dict.fromkeys(T.ERROR_CATEGORIES, 0), "other": 1, "chunking": 1}, "has_errors": True}
    waits = []
    with pytest.raises(ZeroDivisionError):
        E.retried(lambda: 1 / 0, sleep=waits.append)
    assert waits == [1.0, 2.0, 4.0] and E.safely(lambda: 1 / 0, default=7) == 7
    c.reset()
    assert not c.summary()["has_errors"]


def test_sources(spark, tmp_path):
    path = tmp_path / "config.json"
    path.write_text(json.dumps({"database_type": "files", "model_name": "m", "unknown": 1, "categories": [{"name": "a", "num_questions": 2, "doc_paths": ["x/one.v2.pdf", "gone.pdf", "", None]}]}))
    c = config.read_config(spark, f"file://{path}")
    listing = spark.createDataFrame([("x/one.v2.pdf",), ("",), (None,)], "path string")
    docs = config.documents_from_categories(config.categories(c), listing, 5).collect()
    assert [(r.document_id, r.document_type, r.content) for r in docs] == [("doc_one.v2_5", "pdf", "Document from a category")]
    assert [r.setting for r in config.config_errors(c).collect()] == ["embedding_model"]
    path.write_text("{broken")
    with pytest.raises(E.ConfigurationError):
        config.read_config(spark, f"file://{path}")
    (tmp_path / "f").mkdir()
    (tmp_path / "f/a.txt").write_text("plain\ntext")
    (tmp_path / "f/b.html").write_text("<html><script>no()</script><p>para</p></html>")
    (tmp_path / "f/c.pdf").write_bytes(b"")
    got = {r.document_id: r.content.strip() for r in files.text_documents(spark, f"file://{tmp_path}/f").collect()}
    assert got == {"txt_a": "plain\ntext", "txt_b": "para"}
    wanted = spark.createDataFrame([(f"file:{tmp_path}/f/{n}",) for n in ("a.txt", "c.pdf", "gone.txt")], "path string")
    ok, bad = files.valid_files(wanted, files.listing(spark, f"file://{tmp_path}/f"))
    assert ok.count() == 1 and {r.path[-5:] for r in bad.collect()} == {"c.pdf", "e.txt"}
    (tmp_path / "f/c.pdf").write_bytes(b"not a PDF")
    assert files.pdf_pages(spark, f"file://{tmp_path}/f").first().error
    taken, errors = files.dispatch(spark.createDataFrame([("a.PDF",), ("b.docx",), (None,)], "path string"))
    assert taken.first().reader == "pdf" and errors.count() == 2
    pages = spark.createDataFrame([("d", 2, "b"), ("d", 1, "a"), ("d", 3, None)], "document_id string, page_number int, content string")
    assert files.page_text(pages).first().content == "a\nb\n\n"


def test_sinks(spark, tmp_path, images, tables):
    code = content.code_records(spark.createDataFrame([("d", 1, "x = 1")], "document_id string, page_number int, content string"))
    done = writers.write_files(writers.extracted_files(images.where("document_id = 'd'"), tables.where("document_id = 'd'"), code), str(tmp_path)).collect()
    assert all(r.error is None for r in done)
    names = sorted(p.name for p in (tmp_path / "d").iterdir())
    assert names == ["code_001_page_001.txt", "image_001_page_001.json", "image_002_page_001.json", "image_003_page_002.json", "table_001_page_001.csv", "table_001_page_001_meta.json", "table_002_page_003.csv", "table_002_page_003_meta.json"]
    assert (tmp_path / "d/table_001_page_001.csv").read_text() == "a, \n," and "cell_data" not in (tmp_path / "d/table_001_page_001_meta.json").read_text()
    assert "<h3>Page 1, image 1</h3>" in writers.gallery(images).where("document_id = 'd'").first().html
    assert writers.chart([("a<b", 2), ("c", 1)], "t").count("<rect") == 2
    assert writers.write_embeddings(embed_hashing(spark.createDataFrame([("text", "a")], "type string, t string"), "t", 8), f"file://{tmp_path}/e").first().dimension == 8


def test_image_files_and_analysis(spark, tmp_path, images):
    with_bytes = images.withColumn("data", F.when(F.col("image_index") == 1, F.lit(b"png"))).where("document_id = 'd'")
    got = writers.image_workflow(with_bytes, str(tmp_path), "data")
    assert got == {"success": True, "total_images": 3, "documents": 1, "total_bytes": 15, "files": 4, "failed": 0}
    assert sorted(p.name for p in (tmp_path / "d").iterdir()) == ["gallery.html", "images.md", "page_001_img_001.png", "page_002_img_001.png"]
    assert writers.image_workflow(images.limit(0), str(tmp_path))["total_images"] == 0
    path = tmp_path / "analysis.json"
    path.write_text(json.dumps({"total_tables": 2, "tables_by_document": {"a_1": 2}, "sample_table_chunks": [{"content_preview": "x", "metadata": {"word_count": 3, "has_header": True}}]}))
    a = analysis.read_analysis(spark, f"file://{path}")
    assert [tuple(r) for r in analysis.counts_by_document(a, "tables").collect()] == [("a_1", 2)] and analysis.counts_by_document(a, "figures").count() == 0
    assert analysis.samples(a, "table").first().word_count == 3


def test_trace(spark):
    t = Trace()
    with t.span("good", n=1):
        pass
    with pytest.raises(ZeroDivisionError), t.span("bad"):
        1 / 0
    assert [(r.name, r.success) for r in t.table(spark).collect()] == [("good", True), ("bad", False)]


def test_stream(spark, tmp_path):
    docs = spark.createDataFrame([("d1", "One. Two. " * 30), ("d2", "Three.")], "document_id string, content string")
    docs.write.parquet(f"{tmp_path}/in")
    source = stream.read_documents(spark, f"{tmp_path}/in", docs.schema)
    store = Collection(spark, f"file://{tmp_path}", "s")
    for _ in range(2):  # the second run finds nothing new
        q = stream.store_stream(source, Pipeline(spark), store, f"{tmp_path}/checkpoint")
        q.awaitTermination(120)
        assert not q.isActive
    assert {r.document_id for r in store.read().collect()} == {"d1", "d2"}
    q = stream.chunk_stream(source).writeStream.format("memory").queryName("chunks").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("chunks").count() == store.read().count()


def test_all_known_types_are_embedded(spark, tmp_path):
    from lectern.operators.embedding import Hashing
    from lectern.plans.all_queries import QUERIES

    rows = [(k, k, f"some {k} words") for k in ("text", "image", "table", "code", "figure", "other")] + [("none", "text", None)]
    spark.createDataFrame(rows, "chunk_id string, modality string, content string").write.parquet(f"{tmp_path}/document_chunks.parquet")
    got = {r.chunk_id: r.embedding for r in QUERIES["emb_generate_all"](spark, str(tmp_path)).collect()}
    assert set(got) == {"text", "image", "table", "code", "figure", "none"}
    assert all(got[k] == Hashing()([t or ""])[0].tolist() and len(got[k]) == 64 for k, _, t in rows if k in got)


def test_content_queries_with_code(spark, tmp_path):
    from lectern.plans.all_queries import QUERIES
    from tests.conftest import DATA

    for name in ("image_records", "table_records"):
        df = spark.read.parquet(f"{DATA}/{name}.parquet")
        if name == "image_records":
            from lectern.operators.content import figures

            df = figures(df.distinct()).drop("figure_type").limit(1).withColumn("document_id", F.lit("d"))
        (df if name == "image_records" else df.limit(0)).write.parquet(f"{tmp_path}/{name}.parquet")
    rows = [("c", "d", 1, "code", "`one` and `three`"), ("t", "d", 1, "text", "words")]
    spark.createDataFrame(rows, "chunk_id string, document_id string, page_number int, modality string, content string").write.parquet(f"{tmp_path}/document_chunks.parquet")
    spark.createDataFrame([(7, "words")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    run = lambda name: QUERIES[name](spark, str(tmp_path)).collect()
    assert [r.chunk_index for r in run("prj_content_figure")] == [3]  # after an image and two code chunks
    assert {r.type: (r.n, r.chars) for r in run("chunk_modality_g2") if r.type in ("code", "text")} == {"code": (2, 8), "text": (1, 5)}
    got = {r.chunk_index: r for r in run("join_enrich_lookup") if r.type == "code"}
    assert set(got) == {1, 2} and (got[2].code_type, got[2].code_lines, got[2].code_characters) == ("inline_code", 1, 5)


def test_named_parts_and_deletion_by_part(spark, tmp_path):
    store = Collection(spark, f"file://{tmp_path}", "named")
    rows = lambda *ids: spark.createDataFrame([(d, f"text of {d}", "text") for d in ids], "document_id string, content string, modality string")
    store._write(store_metadata(rows("lost")), "batch-0")  # an attempt that broke off before the part was pointed to
    assert store.read().count() == 0 and not store.has("batch-0")
    for _ in range(2):
        assert store.store(rows("a", "b"), "batch-0")["stored_chunks"] == 2
    store.store(rows("c"), "batch-1")
    assert sorted(r.document_id for r in store.read().collect()) == ["a", "b", "c"] and "part" not in store.read().columns
    kept = [p for p in store.parts() if p.endswith("batch-1")]
    assert store.delete_document("a") == 1 and store.delete_document("nobody") == 0
    assert sorted(r.document_id for r in store.read().collect()) == ["b", "c"] and kept[0] in store.parts() and len(store.parts()) == 2
    assert store.read()._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1
