"""Cleaners, detectors and measures against plain statements of their rules."""

import re

import pytest
from pyspark.sql import functions as F

from lectern.functions import cleaning as C
from lectern.functions import detect, enrich, text

TEXTS = [
    None, "", " ", "x", "  two  words ", "a\u00a0b\u2028c\u001cd\u0085", "tab\tand\nline\r\n", "I have 0 and 1 , ok ( yes ) \" q \"", "naïve “curly” – dash — e\u0301 x² ½ ٣", "| a | B |\n\n|  c|d |\n   ", "def f(x):\n\treturn x\n\n    # note\n", "Figure 12: A chart", "Imagery of things", "  image 3 : cat", "ctrl\x01\x1fchar\x7f", "。中文 text", "a.b..c. ", "- one\n* two\n3. three\nplain", "x" * 100_000, ", \"'\").replace(",
]


@pytest.fixture(scope="module")
def run(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string").cache()

    def values(column):
        return [r[1] for r in df.select("i", column.alias("v")).orderBy("i").collect()]

    return values


def s(t):
    return t or ""


def test_primitives(run):
    t = F.coalesce(F.col("t"), F.lit(""))
    assert run(text.collapse(t)) == [re.sub(r"\s+", " ", s(x)) for x in TEXTS]
    assert run(text.strip(t)) == [s(x).strip() for x in TEXTS]
    assert run(text.lstrip(t)) == [s(x).lstrip() for x in TEXTS]
    assert run(text.rstrip(t)) == [s(x).rstrip() for x in TEXTS]
    assert run(text.words(t)) == [s(x).split() for x in TEXTS]
    assert run(text.lines(t)) == [s(x).split("\n") for x in TEXTS]
    assert run(t.rlike(f"[{text.DIGIT}]")) == [any(c.isdigit() for c in s(x)) for x in TEXTS]
    assert run(t.rlike(f"[^{text.ALNUM} ]")) == [any(not c.isalnum() and c != " " for c in s(x)) for x in TEXTS]
    assert run(text.is_upper(t)) == [s(x).isupper() for x in TEXTS]


def test_second_generation_cleaners(run):
    t = F.col("t")
    doc = lambda x: re.sub(r"\s+", " ", re.sub(r"[^\w\s.,!?;:\-()\[\]{}]", "", " ".join(s(x).split()))).strip()
    assert run(C.clean_doc_g2(t)) == [doc(x) for x in TEXTS]
    std = lambda x: "".join(c for c in re.sub(r"\s+", " ", s(x)).strip().replace(", \"'\").replace(", "'").replace("–", "-").replace("—", "-") if ord(c) >= 32)
    assert run(C.clean_std_g2(t)) == [std(x) for x in TEXTS]
    code = lambda x: re.sub(r"^\n+|\n+\Z", "", "\n".join(line.rstrip() for line in s(x).split("\n")))
    assert run(C.clean_code_g2(t)) == [code(x) for x in TEXTS]
    row = lambda r: re.sub(r"^\|+|\|+\Z", "", re.sub(r"\s*\|\s*", "|", r)).strip()
    assert run(C.clean_table_g2(t)) == ["\n".join(r for r in map(row, s(x).split("\n")) if r) for x in TEXTS]
    image = lambda x, w: re.sub(rf"^({w})\s*\d*[:\s]*", "", re.sub(r"\s+", " ", s(x)), flags=re.IGNORECASE).strip()
    assert run(C.clean_image_g2(t)) == [image(x, "Figure|Image|Photo|Picture") for x in TEXTS]
    assert run(C.clean_figure_g2(t)) == [image(x, "Figure|Fig") for x in TEXTS]


def test_first_generation_cleaners(run, spark):
    t = F.col("t")
    code = lambda x: "\n".join(" " * (len(line) - len(line.lstrip())) + line.strip() for line in s(x).split("\n") if line.strip())
    assert run(C.clean_code_g1(t)) == [code(x) for x in TEXTS]
    assert run(C.clean_image_g1(t)) == [re.sub(r"\s+", " ", s(x).strip()) for x in TEXTS]
    one = lambda f, x: spark.range(1).select(f(F.lit(x))).first()[0]
    assert one(C.clean_ocr_g1, "hello 0") == "IhelloI IOI"
    assert one(C.clean_fmt_g1, 'a , b ( c ) " d " .') == 'a, b (c)"d".'
    assert one(C.clean_std_g1, "né\x07 ok\n x") == "InI IokI IxI"
    assert one(C.clean_table_g1, "a|b\t c \n\n | ") == "a | b c\n|"
    assert one(lambda c: C.clean_std_g2(c, curly_quotes=True), "“a” ‘b’") == "\"a\" 'b'"


def test_dispatch(spark):
    rows = [("text", " a  b "), ("code", "x  \n\n"), ("table", "| a |"), ("image", "Image 1: z"), ("figure", "Fig 2 y"), ("other", " q "), (None, None)]
    df = spark.createDataFrame([(m, c, [1.0]) for m, c in rows], "modality string, content string, embedding array<float>")
    got = {r.modality: (r.content, r.cleaning_strategy, r.original_length, r.cleaned_length) for r in C.clean_dispatch_g2(df).collect()}
    assert got == {"text": ("a b", "standard", 6, 3), "code": ("x", "code", 5, 1), "table": ("a", "table", 5, 1), "image": ("z", "image", 10, 1), "figure": ("y", "figure", 7, 1), "other": ("q", "standard", 3, 1), None: ("", "standard", 0, 0)}
    assert "embedding" not in C.clean_dispatch_g1(df).columns
    assert {r.modality: r.content for r in C.clean_dispatch_g1(df).collect()}["other"] == " q "


def test_lines(spark):
    cases = {"": "text", "  ": "text", "a|b|c": "table", "a\tb\tc": "table", "name   value": "table", "def f(x):": "code", "x = 1": "code", "Note: this": "code", "}": "code", "# c": "code", "see a.PNG now": "image", "img: x": "code", "an img: x": "image", "a.pngs": "text", "see Figure 3": "figure", "fig.2": "figure", "plain words": "text"}
    df = spark.createDataFrame([(k,) for k in cases], "l string")
    assert {r[0]: r[1] for r in df.select("l", detect.line_modality_g1(F.col("l"))).collect()} == cases


def test_figures(spark):
    rows = [(49, 100, True, False), (100, 0, False, False), (2001, 100, True, False), (100, 100, False, True), (100, 50, False, True), (101, 50, False, False), (400, 100, True, True), (60, 200, False, False), (None, 5, None, False)]
    df = spark.createDataFrame(rows, "w int, h int, o boolean, want boolean")
    assert all(r[0] == r[1] for r in df.select("want", detect.is_figure(F.col("w"), F.col("h"), F.col("o"))).collect())
    kinds = [(200, 100, False, "wide_diagram"), (60, 100, False, "tall_diagram"), (100, 100, False, "standard_figure"), (5, 100, True, "text_diagram"), (5, 0, None, "tall_diagram")]
    df = spark.createDataFrame(kinds, "w int, h int, o boolean, want string")
    assert all(r[0] == r[1] for r in df.select("want", detect.figure_type(F.col("w"), F.col("h"), F.col("o"))).collect())


def test_measures(run):
    t = F.coalesce(F.col("t"), F.lit(""))
    assert run(enrich.n_words(t)) == [len(s(x).split()) for x in TEXTS]
    assert run(enrich.n_sentences(t)) == [len([p for p in s(x).split(".") if p.strip()]) for x in TEXTS]
    items = lambda x: sum(line.strip().startswith(("-", "*", "•", "1.", "2.", "3.")) for line in s(x).split("\n")) >= len(s(x).split("\n")) * 0.5
    assert run(enrich.likely_list(t)) == [items(x) for x in TEXTS]
    indent = lambda x: max([len(line) - len(line.lstrip()) for line in s(x).split("\n") if line.strip()], default=0) // 4
    assert run(enrich.indentation(t)) == [indent(x) for x in TEXTS]

    def complexity(x):
        n = len([p for p in s(x).split(".") if p.strip()])
        return round(min(len(s(x).split()) / n / 20, 1), 3) if n else 0.0

    assert run(enrich.complexity(t)) == pytest.approx([complexity(x) for x in TEXTS])


def test_enrichment_blocks(spark):
    rows = [("text", "One. Two 2."), ("table", "A|b\nc|d|e"), ("code", "import x\ndef f():\n    # c"), ("image", "a.png b.PNG caption"), ("figure", "bar chart"), ("text", None)]
    df = spark.createDataFrame(rows, "modality string, content string")
    g2 = enrich.enrich_g2(df).collect()
    assert g2[0].text_metadata.sentence_count == 2 and g2[0].table_metadata is None
    assert (g2[1].table_metadata.row_count, g2[1].table_metadata.column_count, g2[1].table_metadata.has_header) == (2, 3, True)
    assert g2[2].code_metadata.estimated_language == "python" and g2[4].figure_metadata.figure_type == "chart" and g2[5].word_count == 0
    g1 = enrich.enrich_g1(df).collect()
    assert g1[3].image_metadata.image_count == 2 and g1[3].image_metadata.image_types == ["PNG", "png"] and g1[2].code_metadata.indentation_level == 1
    assert g1[5].average_word_length == 0.0 and g1[1].table_metadata.separator_type == "pipe"
