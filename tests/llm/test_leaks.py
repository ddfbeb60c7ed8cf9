from pyspark import Broadcast

from lectern.llm import leaks as module
from lectern.llm.leaks import leaks, without_leaks

W = [f"word{k}" for k in range(40)]
PASSAGE, QUESTION = " ".join(W[:20]), "What " + " ".join(W[20:34]) + "?"
ITEMS = "item_id long, passage string, question string, text string"


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, item_id string")


def test_leaks(spark):
    items = spark.createDataFrame([(1, PASSAGE, QUESTION, "t"), (2, PASSAGE, None, "t"), (3, None, "short", "t"), (1, PASSAGE, QUESTION, "t"), (None, PASSAGE, PASSAGE, "t")], ITEMS)
    d = docs(spark, [
        (1, "Before. " + ", ".join(W[3:15]).upper() + " after", "x"),
        (2, " ".join(W[3:14]), "x"),  # eleven words
        (3, " ".join(W[14:26]), "x"),  # across passage and question
        (4, "so: " + " ".join(W[20:34]) + " and " + " ".join(W[:20]), "x"),
        (5, None, "x"), (6, "", "x"), (None, PASSAGE, "x"), (1, "Before. " + ", ".join(W[3:15]).upper() + " after", "x"),
        (7, "filler " * 200_000 + " ".join(W[:12]), "x"),
    ])
    got = {tuple(r) for r in leaks(d, items).collect()}
    assert got == {(1, 1, 1, 13), (1, 2, 1, 13), (4, 1, 1, 15), (4, 1, 16, 36), (4, 2, 16, 36), (7, 1, 200_000, 200_012), (7, 2, 200_000, 200_012)}
    assert {tuple(r) for r in leaks(d, items, most_bytes=300).collect()} == got  # the items in slices


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    assert leaks(docs(spark, [(1, PASSAGE, "x")]), none).count() == 0
    assert leaks(docs(spark, []), spark.createDataFrame([(1, PASSAGE, QUESTION, "t")], ITEMS)).count() == 0


def test_removal(spark):
    items = spark.createDataFrame([(1, PASSAGE, QUESTION, "t")], ITEMS)
    d = docs(spark, [(1, "Keep this. " + " ".join(W[:12]) + "! And " + "much more " * 10, "x"), (2, PASSAGE, "x"), (3, None, "x"), (4, "clean", "x")])
    got = {r.doc_id: (r.clean_text, r.removed_words, r.dropped) for r in without_leaks(d, items).collect()}
    assert got[1] == ("Keep this. ! And " + "much more " * 10, 12, False)
    assert got[2] == (None, 20, True) and got[3] == (None, 0, False) and got[4] == ("clean", 0, False)


def test_removal_keeps_the_rest(spark):
    """Characters that grow in lower case (U+0130) stay as they are, before, beside and behind what is cut."""
    items = spark.createDataFrame([(1, PASSAGE, QUESTION, "t")], ITEMS)
    before, after = "The Title Of \u0130stanbul Stays. ", " AND \u0130\u0130 Here, With Several More Words That Are Kept As They Are In \u0130zmir"
    d = docs(spark, [(1, before + " ".join(W[:12]).upper() + after, "x"), (2, "\u0130 " + PASSAGE, "x")])
    for most in (module.MOST_EVAL_BYTES, 300):
        got = {r.doc_id: (r.clean_text, r.removed_words) for r in without_leaks(d, items, most_bytes=most).collect()}
        assert got[1] == (before + after, 12) and got[2] == (None, 20)


def test_one_slice_is_alive_at_a_time(spark, monkeypatch):
    items = spark.createDataFrame([(k, " ".join(W[k : k + 20]), None, "t") for k in range(12)], ITEMS)
    d = docs(spark, [(1, " ".join(W) + " and", "x"), (2, "nothing " * 20, "x"), (3, None, "x")])
    made, gone, alive = [], [], []
    init, destroy = module.Index.__init__, Broadcast.destroy
    monkeypatch.setattr(module.Index, "__init__", lambda self, *a: (made.append(1), alive.append(len(made) - len(gone)), init(self, *a))[-1])
    monkeypatch.setattr(Broadcast, "destroy", lambda self, *a: (gone.append(1), destroy(self, *a))[-1])
    got = leaks(d, items, most_bytes=500)
    assert len(made) >= 3 and set(alive) == {1} and len(gone) == len(made)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(1, k) for k in range(12)}
    assert {tuple(r) for r in without_leaks(d, items, most_bytes=500).collect()} == {tuple(r) for r in without_leaks(d, items).collect()}
