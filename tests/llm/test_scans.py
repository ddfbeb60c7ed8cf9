import random
from difflib import SequenceMatcher
from math import log

from lectern.llm.scans import LEAST_SEEN, UNSEEN, Repair, affected_lines, folded, line_pairs, page_number, repaired, roman, viterbi

CHUNKS = "chunk_id string, document_id string, modality string, page_number int, chunk_index int, content string, word string, n string"
PROOF = "document_id string, page_number int, clean_text string"
WORDS = "each every machine opens the narrow corner while modern children describe another relevant structure inside common estimate village garden button signal letter table number window schedule".split()


def made(pages=4):
    rng = random.Random(4)
    rows = []
    for k in range(40):  # clean documents
        rows.append((f"k{k}", f"clean{k}", "text", 1, 0, ". ".join(" ".join(rng.choices(WORDS, k=12)) for _ in range(10)), "x", "x"))
    cases, truth = set(), {}
    for p in range(1, pages + 1):
        lines = ["Narrow Table Manual"]
        cases.add((f"s{p}", 1, "header"))
        clean = []
        for n in range(2, 9):
            w = rng.choices(WORDS, k=8)
            clean += w
            if n in (3, 5):
                w = [*w, "schedule"]
                clean.append("schedule")
                cases.add((f"s{p}", n, "hyphen"))
            lines.append(" ".join(w))
        for n in (3, 5):
            line, following = lines[n - 1], lines[n]
            lines[n - 1], lines[n] = line[: -len("dule")] + "-­"[p % 2], "dule " + following
        for n, good, bad in ((4, "each", "eacb"), (6, "table", "tab1e"), (7, "modern", "modem")):
            k = lines[n - 1]
            if good in k.split():
                lines[n - 1] = " ".join(bad if x == good else x for x in k.split(" "))
                cases.add((f"s{p}", n, "misread"))
        lines.append(f"Page {p + 10}")
        cases.add((f"s{p}", len(lines), "page_number"))
        truth[p] = " ".join(clean)
        rows.append((f"s{p}", "scan", "text", p, p, "\n".join(lines), "x", "x"))
    rows += [rows[-1], ("n1", "scan2", "text", None, 0, None, "x", "x"), ("n2", "scan2", "text", None, 1, "", "x", "x"), (None, "scan", "text", 1, 9, "x-\ny", "x", "x"), ("n3", None, "text", 1, 9, "x-\ny", "x", "x"), ("img", "scan", "image", 1, 9, "eacb word", "x", "x"), ("one", "scan3", "text", 1, 0, "a-\nb c-\nd e-\nf", "x", "x")]
    return rows, cases, truth


def test_lines_and_pages(spark):
    rows, cases, truth = made()
    c, p = spark.createDataFrame(rows, CHUNKS), spark.createDataFrame([], PROOF)
    got = {tuple(r) for r in affected_lines(c, p).collect()}
    assert {x for x in got if x[0][0] == "s"} == cases
    assert not any(x[0][0] == "k" for x in got)
    pages = {r.page_number: r.text for r in Repair(c, p).pages().collect() if r.document_id == "scan"}
    assert pages == truth


def test_empty(spark):
    none = spark.createDataFrame([], CHUNKS)
    assert affected_lines(none, spark.createDataFrame([("d", 1, "text")], PROOF)).count() == 0


def test_confusions_are_learned(spark):
    rows, _, truth = made()
    proof = [("scan", p, t) for p, t in truth.items()] + [(None, 1, "x"), ("scan", None, "x"), ("scan", 1, None)]
    r = Repair(spark.createDataFrame(rows, CHUNKS), spark.createDataFrame(proof, PROOF))
    assert r.channel.cost["b", "h"] > r.channel.cost["q", "g"]  # the one is in the pages, the other isn't


def test_parts():
    assert page_number("- 12 -") == 12 and page_number("Page 3") == 3 and page_number("[7]") == 7 and page_number("viii") == 8 and page_number("3 / 9") == 3 and page_number("Pagc 4") == 4
    assert page_number("In 1990") is None and page_number("iiii") is None and roman("xiv") == 14
    assert folded("SCHFMA manua1") == folded("schema manual")
    assert repaired("A first line.\n\nSec-\nond eacb.", [], None, False, [{"line_no": 4, "word": "eacb", "meant": "each"}]) == "A first line.\n\nSecond each."


def test_viterbi_uses_pairs():
    w = {"k": 1, "word": "modem", "before": "the", "after": "engine", "c": [{"meant": "modem", "score": 1.0}, {"meant": "modern", "score": 0.0}]}
    assert viterbi([w], {}) == ["modem"]
    assert viterbi([w], {("modern", "engine"): 50}) == ["modern"]
    # neighbours that are both open are decoded together: the pair outweighs what each would be alone
    v = {"k": 2, "word": "bat", "before": "modem", "after": None, "c": [{"meant": "bat", "score": 1.0}, {"meant": "hat", "score": 0.5}]}
    assert viterbi([w, v], {("modern", "hat"): 90}) == ["modern", "hat"]
    assert viterbi([w, v | {"k": 3}], {("modern", "hat"): 90}) == ["modem", "bat"]


def test_words_over_blank_chunks(spark):
    """However many blank chunks and chunks of heads only stand between the halves, a broken word is found, and a misread rest gets its line."""
    rows = [(f"k{k}", f"c{k}", "text", 1, 0, " ".join(WORDS), "x", "x") for k in range(9)]
    for n in (0, 7, 9, 30):
        rows.append((f"a{n}", f"scan{n}", "text", 1, 0, "Narrow Table Manual\nthe mod-\nern garden opens every nar-", "x", "x"))
        rows += [(f"b{n}-{k}", f"scan{n}", "text", k + 2, k + 1, ("", " \n\t", "Narrow Table Manual")[k % 3], "x", "x") for k in range(n)]
        rows += [(f"c{n}", f"scan{n}", "text", 90, 90, "Narrow Table Manual\nr0w corner", "x", "x"), (f"d{n}", f"scan{n}", "text", 91, 91, "Narrow Table Manual\nthe button", "x", "x")]
    got = {tuple(r) for r in affected_lines(spark.createDataFrame(rows, CHUNKS), spark.createDataFrame([], PROOF)).collect()}
    for n in (0, 7, 9, 30):
        assert {(f"a{n}", 2, "hyphen"), (f"a{n}", 3, "hyphen"), (f"c{n}", 2, "misread"), (f"a{n}", 1, "header"), (f"d{n}", 1, "header")} <= got
    assert not {x for x in got if x[0][0] == "b" and x[2] != "header"}


def test_pruning_changes_nothing(spark):
    """With all candidates kept, decoding gives what it gives with those that can't win left out."""
    rows, _, _ = made(6)
    r = Repair(spark.createDataFrame(rows, CHUNKS), spark.createDataFrame([], PROOF))
    counts, channel = dict(r.words.collect()), r.channel
    by_key = dict(r.pairs.collect())
    whole = set()
    for x in r.by_line.collect():
        w = []
        for k, word in enumerate(x.words):
            found = {word: 0.0} | {m: c for m, c in ((channel.meanings_twice(word) if len(word) >= 5 else {}) | channel.meanings(word)).items() if m != word and counts.get(m, 0) >= LEAST_SEEN}
            c = [{"meant": m, "score": cost + log(counts.get(m, 0) + UNSEEN)} for m, cost in found.items()]
            w.append({"k": k, "word": word, "before": x.words[k - 1] if k else None, "after": x.words[k + 1] if k + 1 < len(x.words) else None, "c": c})
        (both,), keys = line_pairs([w])
        seen = {p: by_key[n] for p, n in zip(both, keys.tolist()) if n in by_key}
        whole |= {(x.chunk_id, x.line_no, k, m) for k, (y, m) in enumerate(zip(w, viterbi(w, seen))) if m != y["word"]}
    assert whole and whole == {(x.chunk_id, x.line_no, x.k, x.meant) for x in r.corrections.collect()}


def test_pages_are_the_proofreaders(spark):
    """Repaired pages of the test tables against proofread_pages: nearly all words are the proofreader's."""
    d = "/root/testdata/sf0.01"
    proof = spark.read.parquet(f"{d}/proofread_pages.parquet")
    pages = {(r.document_id, r.page_number): r.text for r in Repair(spark.read.parquet(f"{d}/document_chunks.parquet"), proof).pages().collect()}
    right = total = exact = n = 0
    for r in proof.where("clean_text is not null").distinct().collect():
        a, b = pages.get((r.document_id, r.page_number), "").split(), r.clean_text.split()
        right += sum(m.size for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks())
        total += max(len(a), len(b))
        exact += a == b
        n += 1
    assert n >= 10 and exact >= 0.75 * n and right >= 0.97 * total
