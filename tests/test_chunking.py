import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.operators import chunking as K

TEXT = st.text(alphabet=st.sampled_from(list("ab .!?\n")), max_size=400)


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(5, 60), st.integers(0, 20))
def test_windows_cover_the_text_and_move_on(text, size, overlap):
    for spans in (K.sentence_spans, K.word_spans):
        got = list(spans(text, size, overlap))
        assert [a for a, _ in got] == sorted({a for a, _ in got})
        covered = 0
        for a, b in got:
            assert a <= covered and b > a
            covered = max(covered, b)
        assert covered >= len(text)


def test_boundaries():
    assert list(K.sentence_spans("a" * 10, 10, 3)) == [(0, 10), (7, 17)]
    assert list(K.sentence_spans("a" * 7, 10, 3)) == [(0, 10)] + ([(7, 17)] if 7 > 7 else [])
    # the kind of mark that comes first in the list wins over a later position
    assert list(K.sentence_spans("One. Two! Three four five", 12, 2))[0] == (0, 5)
    # a mark at the window's start doesn't count; a stall goes on at the boundary
    assert list(K.sentence_spans(". " + "a" * 30, 10, 2))[0] == (0, 10)
    assert list(K.sentence_spans("ab. " + "a" * 30, 10, 8))[:2] == [(0, 4), (4, 14)]
    assert list(K.word_spans("aaa bbb ccc", 8, 0)) == [(0, 7), (7, 15)]


def test_chunk_table(spark):
    rows = [("d1", "Hello there. " * 20, "x"), ("d2", None, "x"), ("d3", "", "x"), ("d4", " \n ", "x"), (None, "text", "x"), ("d1", "again", "x"), ("d5", "word " * 50_000, "x")]
    got = K.chunk_sentence_g2(spark.createDataFrame(rows, "document_id string, content string, length string"), size=100, overlap=20)
    assert got.columns == ["document_id", "content", "chunk_index", "start_index", "end_index", "length"]
    by = {}
    for r in got.collect():
        by.setdefault(r.document_id, []).append(r)
        assert r.length == len(r.content) and r.content == r.content.strip() != ""
    assert set(by) == {"d1", None, "d5"} and len(by["d5"]) > 2000
    with pytest.raises(ValueError, match="size"):
        K.chunk_sentence_g2(spark.createDataFrame(rows, "document_id string, content string, length string"), size=0)
    assert K.chunk_word_g1(spark.createDataFrame([], "document_id string, content string")).count() == 0


def segments(text):
    """A plain statement of the segmentation, with labels from the operator's own rules for the sample's lines."""
    label = {"": "text", "plain": "text", "a|b|c": "table", "x = 1": "code", "pic.png": "image", "Figure 1": "figure"}
    out, kind, body, start = [], "text", None, 0
    for n, line in enumerate(text.split("\n")):
        if label[line] != kind:
            if body is not None and body.strip():
                out.append((kind, body, start, n - 1))
            kind, body, start = label[line], line, n
        else:
            body = ("" if body is None else body) + "\n" + line
    if body is not None and body.strip():
        out.append((kind, body, start, len(text.split("\n")) - 1))
    return out


@pytest.mark.parametrize("text", ["plain", "plain\nplain\na|b|c\na|b|c\n\nx = 1\npic.png\nFigure 1\nplain", "a|b|c\nplain", "", "\n\n", "x = 1\n\nx = 1", "\nplain\nFigure 1"])
def test_segments(spark, text):
    df = spark.createDataFrame([("d", text, "x")], "document_id string, content string, modality string")
    got = sorted(K.seg_lines_g1(df).collect(), key=lambda r: r.segment_no)
    assert [(r.modality, r.content, r.start_line, r.end_line) for r in got] == segments(text)
    assert [r.segment_no for r in got] == list(range(len(got)))


def test_whole_flow(spark):
    df = spark.createDataFrame([("d", "plain words here\na|b|c\nx = 1", "p/f.pdf"), ("e", None, None)], "document_id string, content string, file_path string")
    got = K.chunk_document_g1(df).collect()
    assert {(r.chunk_id, r.chunk_key, r.content) for r in got} == {("chunk_0_text", "d_0_0_text", "plain words here"), ("chunk_0_table", "d_1_0_table", "a|b|c"), ("chunk_0_code", "d_2_0_code", "x = 1")}
    docs = spark.createDataFrame([("d", "p/f.pdf", "PDF", None), ("d", "p/f.pdf", "PDF", None)], "document_id string, file_path string, document_type string, processing_status string")
    meta = K.chunk_assign_meta_g1(spark.createDataFrame([("c", "d"), ("x", "none")], "chunk_id string, document_id string"), docs).orderBy("chunk_id").collect()
    assert tuple(meta[0]) == ("d", "c", "p/f.pdf", "pdf", "pending") and meta[1].source_file is None
    assert F.col("x") is not None
