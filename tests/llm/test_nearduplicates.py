import random
import re

import pytest

from lectern.llm import nearduplicates as N
from lectern.llm.components import components

CHUNKS = "chunk_id string, document_id string, content string, set_key string, n string"
DOCS = "document_id string, file_path string, chunk_id string"


def made(seed=1):
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(4000)}" for _ in range(80)] for _ in range(12)]
    rows = []
    for k in range(90):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = f"w{rng.randrange(4000)}"
        rows.append((f"c{k:03}", f"d{k % 40}", " ".join(w), "x", "x"))
    rows += [rows[0], ("t1", "d1", "na " * 30, "x", "x"), ("t2", "d2", "na " * 30 + "ba", "x", "x"), ("t3", "d3", "na " * 40, "x", "x"), ("s1", "d4", "too short", "x", "x"), ("n1", "d5", None, "x", "x"), ("n2", None, rows[0][2], "x", "x"), (None, "d6", rows[0][2], "x", "x"), ("n3", "d7", "", "x", "x"), ("long", "d8", "filler text goes on " * 5000, "x", "x"), ("gone", "nodoc", rows[0][2], "x", "x")]
    docs = [(f"d{k}", f"f{k % 30}", "x") for k in range(40)] + [("d0", "f0", "x"), ("nofile", None, "x")]
    return rows, docs


def brute(rows, docs, t=0.6):
    path = {d: p for d, p, _ in docs if p}
    sets = {}
    for c, d, text, *_ in rows:
        w = re.findall("[a-z0-9]+", (text or "").lower())
        if c and d in path and len(w) >= 20:
            sets[c] = ({tuple(w[i : i + 3]) for i in range(len(w) - 2)}, path[d])
    ids = sorted(sets)
    return {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a][1] != sets[b][1] and len(sets[a][0] & sets[b][0]) >= t * len(sets[a][0] | sets[b][0]) - 1e-9}


@pytest.mark.parametrize("most", [N.MOST_CLASSES, 2])
def test_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(N.near_classes, "__defaults__", (*N.near_classes.__defaults__[:-1], most))
    rows, docs = made()
    got = [(r.chunk_id_a, r.chunk_id_b) for r in N.near_pairs(spark.createDataFrame(rows, CHUNKS), spark.createDataFrame(docs, DOCS)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, docs)


def test_prefix_filter_finds_every_pair(spark):
    rows, _ = made(7)
    some = [(k, r[2]) for k, r in enumerate(rows[:60])]
    found = {tuple(sorted(x)) for x in N.prefix_pairs(spark.createDataFrame(some, "set_key long, content string"), 3, 0.6).collect()}
    sets = {k: {tuple(t.split()[i : i + 3]) for i in range(len(t.split()) - 2)} for k, t in some}
    near = {(a, b) for a in sets for b in sets if a < b and sets[a] != sets[b] and len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b])}
    assert near <= found


def test_copies_emit_variants_once(spark, monkeypatch):
    """3,000 copies of one text and 300 other texts are 301 classes, with 40 variants each, and no class is hot."""
    rng = random.Random(3)
    text = lambda: " ".join(f"w{rng.randrange(9000)}" for _ in range(60))
    one = text()
    rows = [(f"c{k:04}", f"d{k}", one, "x", "x") for k in range(3000)] + [(f"o{k:03}", f"e{k}", text(), "x", "x") for k in range(300)]
    seen, real = [], N.variants_met

    def counted(classes, most):
        seen.append(classes.selectExpr("sum(size(variants))", "count(*)").first())
        pairs, hot = real(classes, most)
        seen.append(hot.count())
        return pairs, hot

    monkeypatch.setattr(N, "variants_met", counted)
    members, links = N.near_classes(spark.createDataFrame(rows, CHUNKS))
    assert tuple(seen[0]) == (12_040, 301) and seen[1] == 0
    assert members.count() == 3300 and links.count() == 0


def test_rows_of_a_head_that_differ(spark):
    """Where rows of one chunk_id hold different texts, each set meets its own partners."""
    rng = random.Random(5)
    a, b = ([f"w{rng.randrange(9000)}" for _ in range(60)] for _ in range(2))
    near = lambda w: " ".join(["other", *w[1:]])
    rows = [("a", "d1", " ".join(a), "x", "x"), ("a", "d1", " ".join(b), "x", "x"), ("b", "d2", near(a), "x", "x"), ("c", "d3", near(b), "x", "x")]
    docs = [(f"d{k}", f"f{k}", "x") for k in range(5)]
    got = {(r.chunk_id_a, r.chunk_id_b) for r in N.near_pairs(spark.createDataFrame(rows, CHUNKS), spark.createDataFrame(docs, DOCS)).collect()}
    assert got == {("a", "b"), ("a", "c")}


def test_groups_and_empty(spark):
    rows, docs = made()
    d = spark.createDataFrame(docs, DOCS)
    got = {r.chunk_id: r for r in N.near_groups(spark.createDataFrame(rows, CHUNKS), d).collect()}
    assert got["t1"].class_id == got["t3"].class_id == "t1" and got["t1"].copies == 2 and got["long"].links == 0
    assert got["gone"].class_id == got["c000"].class_id
    none = spark.createDataFrame([], CHUNKS)
    assert N.near_pairs(none, d).count() == 0 and N.near_groups(none, d).count() == 0


def test_components(spark):
    edges = [(k, k + 1) for k in range(30)] + [(100, 101), (102, 101), (7, 7), (None, 1), (100, 101)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{k: 0 for k in range(31)}, 100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
