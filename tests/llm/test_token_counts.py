import random

from hypothesis import given, settings
from hypothesis import strategies as st

from labelfold.llm import token_counts as tc

T = tc._tokenizer(tc.vocabulary_path())
W = tc.WordCounts(T)


def whole(text):
    return T.encode(text, add_special_tokens=False).ids


ODD = ["", " ", "a" * 5000 + " b" * 3000, "x" * 20_000, "  \n\n " * 2000 + "é" * 100, "<|endoftext|>" * 500,
       " <|endoftext|> foo " * 500, "日本語 テキスト" * 800, "don't I'll " * 900, "😀👍🏽 " * 500, "a\u00a0b\u2003c " * 400]


def test_splice_equals_the_whole():
    for text in ODD:
        for chunk, overlap in ((700, 30), (300, 8), (64, 4)):
            assert tc.encode_spliced(T, text, chunk, overlap).tolist() == whole(text), (text[:20], chunk)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab \n\t'sé1.,!<|endoftext|>  \u00a0日", max_size=400))
def test_any_text(text):
    assert W.count([text]) == [len(whole(text))]
    assert tc.encode_spliced(T, text, 40, 3).tolist() == whole(text)


def test_real_texts(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in tc.count_tokens(d, chunk=2000, overlap=40).collect()}
    for r in d.collect():
        n = len(whole(r.text))
        assert (got[r.doc_id].n_tokens, got[r.doc_id].over_limit) == (n, n > 512)
        assert got[r.doc_id].n_bytes == len(r.text.encode())


def test_odd_rows(odd_docs):
    rows = tc.count_tokens(odd_docs).collect()
    want = sorted((r.doc_id or 0, len((r.text or "").encode()), len(whole(r.text or ""))) for r in odd_docs.collect())
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in rows) == want
    assert tc.count_tokens(odd_docs.limit(0)).count() == 0


def test_a_full_table_of_words_is_refilled():
    small = tc.WordCounts(T)
    small.KEEP = 50
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdef", k=6)) for _ in range(80)) for _ in range(20)]
    for t in texts:
        assert small.count([t]) == [len(whole(t))]
        assert len(small.seen) <= 50


def test_other_vocabularies_are_encoded_whole(spark):
    """Lower-casing, word ends, sentencepiece: what the splice doesn't hold for goes to the library."""
    import sentencepiece
    from tokenizers import Tokenizer
    assert tc.has_stable_boundaries(tc.vocabulary_path())
    texts = ["", "Hello  World foo", "a" * 500, "don't  STOP <|endoftext|> now " * 40, "日本語 テキスト " * 30]
    d = spark.createDataFrame(list(enumerate(texts)) + [(9, None)], "doc_id long, text string")
    t = Tokenizer.from_file(tc.vocabulary_path("word_bpe_49k.json"))
    t.no_truncation()
    s = sentencepiece.SentencePieceProcessor(model_file=tc.vocabulary_path("piece_bpe_32k.model"))
    for name, library in (("word_bpe_49k.json", lambda x: len(t.encode(x, add_special_tokens=False).ids)),
                          ("piece_bpe_32k.model", lambda x: len(s.encode(x)))):
        path = tc.vocabulary_path(name)
        assert not tc.has_stable_boundaries(path)
        got = {r.doc_id: r.n_tokens for r in tc.count_tokens(d, vocabulary=path, chunk=100, overlap=8).collect()}
        assert got == {**{i: library(x) for i, x in enumerate(texts)}, 9: library("")}
