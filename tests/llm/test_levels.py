import random

import pytest

from lectern.llm.levels import reading_levels

DOCS = "doc_id long, text string, lang string, reading_level string"
LABELS = "doc_id long, rater string, reading_level int, text string"
EASY, HARD = "cat dog red ball run sun big map cup".split(), "heterogeneity parameterisation epistemological compartmentalisation interoperability stochasticity".split()


def made(n=150):
    rng = random.Random(2)
    docs, labels, level = [], [], {}
    for k in range(n):
        lv = k % 5 + 1
        sentence = lambda: " ".join(rng.choice(HARD if rng.random() < (lv - 1) / 4 else EASY) for _ in range(rng.randint(3, 5) * lv)).capitalize() + rng.choice(".?!")  # noqa: E731, B023
        docs.append((k, " ".join(sentence() for _ in range(14)), "en", "x"))
        level[k] = lv
        if k < 100:
            labels += [(k, "a", lv, "x"), (k, "a", lv, "x"), (k, "b", None, "x"), (k, "c", min(5, lv + (k % 7 == 0)), "x")]
    return docs, labels, level


def test_held_out_accuracy_and_cases(spark):
    docs, labels, level = made()
    docs += [(900, None, "en", "x"), (901, "", "en", "x"), (902, "too short", "en", "x"), (903, docs[0][1], "EN", "x"), (904, docs[0][1], None, "x"), (None, docs[0][1], "en", "x"), (0, docs[0][1], "en", "x"), (905, "1234 " * 50, "en", "x"), (906, docs[4][1] * 200, "en", "x")]
    labels += [(None, "a", 3, "x"), (1, "a", 9, "x"), (7777, "a", 3, "x")]
    got = reading_levels(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    by = {r.doc_id: r.reading_level for r in got}
    assert len([r for r in got if r.doc_id == 0]) == 2 and not {900, 901, 902, 903, 904, None} & set(by) and 905 in by
    held = [k for k in level if k >= 100]
    assert sum(by[k] == level[k] for k in held) >= 0.85 * len(held) and by[906] == 5


def test_no_labels(spark):
    docs, _, _ = made(5)
    with pytest.raises(ValueError, match="no labelled document"):
        reading_levels(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], LABELS))
