import pytest

encode = pytest.importorskip("statuta.llm.encode")
tokenizers = pytest.importorskip("tokenizers")

TEXTS = [
    "", None, " ", "The Minister must lodge the claim.", "<|endoftext|> is text", " " * 3000 + "x", "a" * 2500, "ab" * 500 + "aaa", "日本語のテキスト" * 30, "é" * 90, "🌾👩‍👩‍👧" * 20,
    "\x00\x01", "Ω-m ﬁ   x", "\r\n\r\n \t x", "=-" * 300, "don't we'll IT'S 12345 x²", "The Minister must lodge the claim.",
]
SCHEMA = "doc_id BIGINT, text STRING, ids STRING, n_tokens STRING"


def test_equals_the_library(spark):
    t = tokenizers.Tokenizer.from_file(encode.TOKENIZER)
    t.encode_special_tokens = True
    df = spark.createDataFrame([(i, x, "clash", "clash") for i, x in enumerate(TEXTS)], SCHEMA)
    got = {r.doc_id: r.ids for r in encode.token_ids(df).collect()}
    want = {i: t.encode(x or "", add_special_tokens=False).ids for i, x in enumerate(TEXTS)}
    assert got == want
    assert {r.doc_id: r.n_tokens for r in encode.token_counts(df).collect()} == {i: len(w) for i, w in want.items()}


def test_unfinished_words_go_on(monkeypatch):
    text = ["internationalisation of considerations " * 3, None]
    want = encode.Encoder(*encode.load_vocabulary(encode.TOKENIZER)).encode(text).to_pylist()
    monkeypatch.setattr(encode, "STEPS", 3)
    monkeypatch.setattr(encode, "_MERGE", encode._MERGE.replace("step < 48", "step < 3"))
    assert encode.Encoder(*encode.load_vocabulary(encode.TOKENIZER)).encode(text).to_pylist() == want


def test_words_learnt_in_parts_and_forgotten(monkeypatch):
    text = [f"the {'x' * n} register {n} of considerations" for n in range(30)]
    want = encode.Encoder(*encode.load_vocabulary(encode.TOKENIZER)).encode(text).to_pylist()
    monkeypatch.setattr(encode, "LETTERS", 10)
    monkeypatch.setattr(encode, "KEPT_WORDS", 5)
    enc = encode.Encoder(*encode.load_vocabulary(encode.TOKENIZER))
    assert [x for t in text for x in enc.encode([t]).to_pylist()] == want and enc.count(text).to_pylist() == [len(w) for w in want]


def test_empty_table_and_repeated_rows(spark):
    assert encode.token_ids(spark.createDataFrame([], SCHEMA)).count() == 0
    assert encode.token_ids(spark.createDataFrame([(1, "a", "", "")] * 3, SCHEMA)).count() == 3
