import random
import re
from collections import defaultdict

from lectern.llm import boilerplate
from lectern.llm.boilerplate import boilerplate_lines, shingles, without_boilerplate

CHUNKS = "chunk_id string, document_id string, modality string, content string, source string, line_key string"
DOCS = "document_id string, metadata struct<category:string,source:string>, chunk_id string"
LEGAL = "No part of this material may be copied without permission of the publisher, page %d"


def made():
    rows = [(f"c{k}", f"d{k}", "text", f"Unique sentence number {'abcdefghijklmnop'[k % 16] * 9} of the text that nobody repeats here\n{LEGAL % k}\n", "x", "x") for k in range(14)]
    rows += [rows[0], ("i1", "d1", "image", LEGAL % 3, "x", "x"), ("n1", "d2", "text", None, "x", "x"), ("n2", "d3", "text", "", "x", "x"), (None, "d4", "text", LEGAL % 1, "x", "x"), ("n3", None, "text", LEGAL % 1, "x", "x"), ("n4", "orphan", "text", LEGAL % 1, "x", "x"), ("l1", "d5", "text", "\n".join(["plain words without end in a very long line " * 2000, LEGAL % 9]), "x", "x"), ("twice", "d6", "text", (LEGAL % 1 + "\n") * 3, "x", "x")]
    near = "Please share this page with the members of your own study group today and tell them about %s"
    rows += [(f"s{k}", f"d{k}", "text", near % w, "x", "x") for k, w in enumerate(["apples", "pears", "plums", "grapes", "figs", "dates", "limes"])]
    docs = [(f"d{k}", ("c", "one" if k < 8 else "two"), "x") for k in range(14)] + [("d0", ("c", "one"), "x"), ("nosource", ("c", None), "x"), ("nometa", None, "x")]
    return rows, docs


def brute(rows, docs, least=6):
    source = {d: m[1] for d, m, _ in docs if m and m[1]}
    seen, at = defaultdict(set), []
    for c, d, m, t, *_ in rows:
        if c and d in source and m == "text" and t is not None:
            for n, line in enumerate(t.split("\n"), 1):
                k = re.sub("[^a-z]", "", line.lower())
                if len(k) >= 30:
                    seen[source[d], k].add(d), at.append((c, n, source[d], k))
    return {(c, n) for c, n, s, k in at if len(seen[s, k]) >= least}


def test_found_and_near_lines(spark):
    rows, docs = made()
    c, d = spark.createDataFrame(rows, CHUNKS), spark.createDataFrame(docs, DOCS)
    got = boilerplate_lines(c, d).collect()
    assert {(r.chunk_id, r.line_no) for r in got if r.docs >= 6} == brute(rows, docs)
    assert {r.chunk_id for r in got if r.docs < 6} == {f"s{k}" for k in range(7)}  # alike but for a word
    assert all(r.cluster_docs == 7 for r in got if r.docs < 6)


def test_bands_alone_give_equal_lines(spark, monkeypatch):
    """Lines equal but for their masks meet in a band; without bands they would be classes of their own, so less would come out."""
    rows, docs = made()
    styles = ["Written for the school by Peter Smith in the Spring Of Last Year", "written for the school by peter smith in the spring of last year", "Written For The School By Peter smith 12, in the Spring of last year"]
    rows += [(f"m{k}", f"d{k}", "text", f"x\n{styles[k % 3]}", "x", "x") for k in range(7)]
    c, d = spark.createDataFrame(rows, CHUNKS), spark.createDataFrame(docs, DOCS)
    found = lambda: {(r.chunk_id, r.line_no) for r in boilerplate_lines(c, d, complete=False).collect() if r.docs >= 6}
    assert found() == brute(rows, docs) and ("m3", 2) in found()
    monkeypatch.setattr(boilerplate, "line_links", lambda units: units.selectExpr("unit as line_key", "unit as head_key").limit(0))
    assert found() < brute(rows, docs) and ("m3", 2) not in found()


def test_keys_of_lines():
    texts = ["One line, here\n\nAnother \u0130 line of 12 May 2020 by Adam", "one line HERE 7", ""]
    lines = boilerplate.Lines(texts)
    lines.tokens(texts)
    assert lines.text.tolist() == [0, 0, 0, 1, 2] and lines.number.tolist() == [1, 2, 3, 1, 1] and lines.letters.tolist() == [11, 0, 23, 11, 0]
    assert lines.letters_key[0] == lines.letters_key[3] != lines.letters_key[2]
    assert lines.size.tolist() == [len(boilerplate.masked(x)) for t in texts for x in t.split("\n")]


def test_removal_and_empty(spark):
    rows, docs = made()
    d = spark.createDataFrame(docs, DOCS)
    got = {r.chunk_id: (r.content, r.removed_lines) for r in without_boilerplate(spark.createDataFrame(rows, CHUNKS), d).collect()}
    assert got["c1"] == (rows[1][3].split("\n")[0] + "\n", 1) and got["c13"][1] == 1 and got["n1"] == (None, 0) and got["s3"] == ("", 1)
    assert "i1" not in got and got["twice"] == ("", 3)
    assert boilerplate_lines(spark.createDataFrame([], CHUNKS), d).count() == 0


def similar_templates():
    """Per template eight variants of one document each; templates alike but not near, and a chain whose ends aren't near."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    common, lines = [word() for _ in range(40)], []
    for _ in range(30):
        own = common[:26] + [word() for _ in range(34)]
        lines += [own[:-1] + [word()] for _ in range(8)]
    chain = [word() for _ in range(60)]
    for k in range(9):
        chain = chain[:6 * k] + [word()] + chain[6 * k + 1 :]
        lines.append(chain)
    return [" ".join(x) for x in lines]


def test_clusters_of_similar_templates(spark):
    lines = similar_templates()
    sets = [shingles(x) for x in lines]
    group = list(range(len(lines)))
    for a in range(len(lines)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = group[a], group[b]
                group = [y if g == x else g for g in group]
    want = {f"c{k}": group.count(group[k]) for k in range(len(lines)) if group.count(group[k]) >= 6}
    rows = [(f"c{k}", f"d{k}", "text", x, "x", "x") for k, x in enumerate(lines)]
    docs = [(f"d{k}", ("c", "one"), "x") for k in range(len(lines))]
    got = {r.chunk_id: r.cluster_docs for r in boilerplate_lines(spark.createDataFrame(rows, CHUNKS), spark.createDataFrame(docs, DOCS)).collect()}
    assert got == want and len(want) == len(lines) and set(want.values()) == {8, 9}
