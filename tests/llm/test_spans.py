import random

import numpy as np
import pytest

from lectern.llm import spans

SCHEMA = "chunk_id string, document_id string, content string, span_start string"


def brute(rows, least=200):
    rows = {(c, d, t) for c, d, t, *_ in rows if c is not None and d is not None and t is not None}
    seen = {}
    for c, d, t in rows:
        for i in range(len(t) - least + 1):
            seen.setdefault(t[i : i + least], set()).add(d)
    out = set()
    for c, d, t in rows:
        ends = None
        for i in range(len(t) - least + 1):
            if len(seen[t[i : i + least]]) > 1:
                if ends and i <= ends[1]:
                    ends = (ends[0], i + least)
                else:
                    if ends:
                        out.add((c, *ends))
                    ends = (i, i + least)
        if ends:
            out.add((c, *ends))
    return out


def texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg é中🙂") for _ in range(rng.randint(2, 8)))
    make = lambda n: " ".join(word() for _ in range(n))
    base = [make(120) for _ in range(4)]
    rows = []
    for k in range(24):
        b = rng.choice(base)
        a = rng.randrange(len(b) // 2)
        rows.append((f"c{k}", f"d{k // 2}", make(5) + b[a : a + rng.choice([150, 199, 200, 201, 350])] + make(5), "x"))
    rows += [rows[0], ("copy1", "e1", base[0], "x"), ("copy2", "e2", base[0], "x"), ("own1", "f", base[1][:300], "x"), ("aaa1", "g", "a" * 1000, "x"), ("aaa2", "h", "b" + "a" * 260, "x"), ("n1", "i", None, "x"), ("n2", None, base[0], "x"), (None, "j", base[0], "x"), ("n3", "k", "", "x")]
    return rows


@pytest.mark.parametrize("most", [spans.MOST_SEGMENTS, 1])
def test_against_brute_force(spark, most):
    rows = texts(3)
    got = [tuple(r) for r in spans.shared_spans(spark.createDataFrame(rows, SCHEMA), most_segments=most).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_long_text_is_cut_and_joined(spark, monkeypatch):
    monkeypatch.setattr(spans, "BLOCK", 500)
    number, anchor, content, first, last = (np.concatenate(x) for x in zip(*spans.segments(["".join(random.Random(1).choices("abcdef", k=3000)), "x"], 200)))
    covered = sorted((a, b) for n, a, b in zip(number, first, last) if n == 0)
    assert covered[0][0] == 0 and covered[-1][1] == 2800 and all(x[1] + 1 == y[0] for x, y in zip(covered, covered[1:]))


def test_colliding_hashes_are_checked(monkeypatch):
    a, b, c = ("".join(random.Random(k).choices("abcdef", k=220)) for k in range(3))
    monkeypatch.setattr(spans, "gram_hashes", lambda s, k: np.zeros(max(0, len(s) - k + 1), np.uint64))
    one, two = np.array([1, 2, 3]), np.array([1, 2, 3])
    assert list(spans.factor([a, b, c], one, two, 200)) == []
    assert {x[0] for x in spans.factor([a, b, a], one, two, 200)} == {0, 2}


def test_empty_and_shares(spark):
    assert spans.shared_spans(spark.createDataFrame([], SCHEMA)).count() == 0
    t = "".join(random.Random(9).choices("abcdefgh ", k=400))
    rows = [("c1", "d1", t, "x"), ("c2", "d2", t[:300], "x"), ("c3", "d3", None, "x")]
    got = {r.chunk_id: (r.n_chars, r.shared_chars, r.spans, r.shared_share) for r in spans.shared_shares(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {"c1": (400, 300, 1, 0.75), "c2": (300, 300, 1, 1.0), "c3": (0, 0, 0, 0.0)}
