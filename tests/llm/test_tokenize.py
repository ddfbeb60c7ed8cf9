import random

from lectern.llm.tokenize import Utf8, decode, encode, transducer, vocabulary_path

PIECES = ["a", "the", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "é", "ß", "中", "🙂", "'s", "12", "½", "<|endoftext|>", "​", " ", "ing", "́", "٣", "\r\n", "zz", "|"]


def test_against_the_library():
    from tokenizers import Tokenizer

    t, ref = transducer(vocabulary_path()), Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    ref.encode_special_tokens = True
    rng = random.Random(5)
    for _ in range(1500):
        s = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14)))
        ids = t.encode(s)
        assert ids == ref.encode(s, add_special_tokens=False).ids
        assert t.decode(ids) == s


def test_long_run_and_bounded_states():
    t = transducer(vocabulary_path())
    s = "ab" * 30_000
    assert t.decode(t.encode(s)) == s
    t.most_states, t.most_outputs = 50, 20
    try:
        s = "several quite different words, many more than are kept " * 3
        assert t.decode(t.encode(s)) == s
    finally:
        t.most_states, t.most_outputs = 2_000_000, 500_000


def test_utf8_machine_on_broken_bytes():
    for data in (b"\xe4\xb8", b"a\xffb", b"\xf0\x9f\x99\x82", b"\xc3", b"\xe4\xb8A", b"\xed\xa0\x80"):
        m = Utf8()
        assert m.feed(data) + m.end() == data.decode("utf-8", "replace")


def test_table_cases(spark):
    rows = [(1, "hello world", "x"), (2, None, "x"), (3, "", "x"), (None, " ", "x"), (1, "hello world", "y")]
    out = encode(spark.createDataFrame(rows, "doc_id long, text string, ids string"))
    assert out.columns == ["doc_id", "ids"]
    got = [tuple(r) for r in out.collect()]
    assert sorted(got, key=str) == sorted([(1, [31373, 995]), (2, []), (3, []), (None, [220]), (1, [31373, 995])], key=str)
    assert encode(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tokens_leave_before_the_piece_ends():
    """Of a pre-token of any length, tokens come out as they settle, and are those of the kept states."""
    t, rng = transducer(vocabulary_path()), random.Random(8)
    for letters in ("ab", "abcdefghijklmnopqrstuvwxyz", "a", " ", "=-"):
        piece = "".join(rng.choice(letters) for _ in range(6000)).encode()
        assert tuple(t.stream(piece, 64)) == t.run(piece)
    read = 0

    class Piece(bytes):
        def __getitem__(self, k):
            nonlocal read
            read = max(read, k.stop)
            return bytes.__getitem__(self, k)

    behind = [(read, at) for at, _ in enumerate(t.stream(Piece(b"several" * 5000)), 1)]
    assert max(r - 7 * at for r, at in behind if r < 35_000) < 4 * 1024 and behind[0][0] <= 2048


def test_round_trip_of_a_table(spark):
    rows = [(1, "hello w\u00f6rld \U0001f642"), (2, None), (3, ""), (None, " x"), (4, "a" * 20_000)]
    out = decode(encode(spark.createDataFrame(rows, "doc_id long, text string")))
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(k, t or "") for k, t in rows], key=str)
    assert decode(spark.createDataFrame([], "doc_id long, ids array<int>, text string")).count() == 0
