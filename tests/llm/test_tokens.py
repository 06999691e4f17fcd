import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from tallyforge.llm import tokens

S = "doc_id long, text string, ids string, k int"


def plain(texts):
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]


TEXTS = [
    "", None, " ", "Hello,  world! it's 12345 'll\n\n  x", "<|endoftext|>", "가나다 라마바 " * 40, "a" * 700, "word " * 300, " " * 500, "x\r\n" * 200, "don't " * 120 + "\U0001f642" * 40,
    "word " * 90 + "b" * 333 + " more words" * 40 + "c" * 200 + " end" * 60, "0" * 333 + " tail", "…" * 260, "mixed 日本語 text, with ünïcödé; " * 30,
]


@pytest.mark.parametrize(("chunk", "overlap"), [(64, 16), (100, 40), (4096, 512)])
def test_ids_are_those_of_the_whole_text(make, chunk, overlap):
    got = {r.doc_id: list(r.ids) for r in tokens.encode_corpus(make(S, *[(i, t, "x", 1) for i, t in enumerate(TEXTS)]), chunk=chunk, overlap=overlap).collect()}
    want = plain([t or "" for t in TEXTS])
    assert got == dict(enumerate(want))
    assert all(tokens.decode(got[i]) == (t or "").encode() for i, t in enumerate(TEXTS))


def test_repeated_rows_and_null_ids(make):
    rows = [(1, "long " * 50, "", 0)] * 3 + [(None, "long " * 50, "", 0), (None, "s", "", 0), (1, "other " * 60, "", 0)]
    got = [(r.doc_id, len(r.ids)) for r in tokens.encode_corpus(make(S, *rows), chunk=64, overlap=16).collect()]
    n, m = len(plain(["long " * 50])[0]), len(plain(["other " * 60])[0])
    assert sorted(got, key=str) == sorted([(1, n)] * 3 + [(1, m), (None, n), (None, 1)], key=str)


def test_empty_table_and_bad_overlap(make):
    assert tokens.encode_corpus(make(S)).count() == 0
    with pytest.raises(ValueError):
        tokens.encode_corpus(make(S), chunk=10, overlap=10)


def test_whole_test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    text = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    got = {r.doc_id: list(r.ids) for r in tokens.encode_corpus(docs, chunk=256, overlap=64).collect()}
    assert got == dict(zip(text, plain([t or "" for t in text.values()]), strict=True))


def test_time_grows_in_proportion(make):
    """A text sixteen times as long takes no more than about as many times as long; both are encoded by chunks."""
    import time

    def seconds(n):
        df = tokens.encode_corpus(make("doc_id long, text string", (1, "some words of a text, " * n)))
        began = time.time()
        size = len(df.first().ids)
        assert size > 5 * n
        return time.time() - began

    seconds(1_000)
    assert seconds(320_000) < 24 * max(1.0, seconds(20_000))
