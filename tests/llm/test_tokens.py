import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortloom.llm.tokens import TOKENIZERS, decode_ids, decoded, encode_texts, token_counts, token_ids, vocabulary

tokenizers = pytest.importorskip("tokenizers")


@given(st.text(alphabet="ab \n\t'relstvmdL1.,!é漢  😀", max_size=160))
@settings(max_examples=300, deadline=None)
def test_tree_of_tiny_leaves_equals_one_pass(text):
    v = vocabulary()
    for leaf in (1, 5, 16):
        assert list(encode_texts([text], v, leaf)[0]) == v.encoding.encode_ordinary(text)


@given(st.text(max_size=200))
@settings(max_examples=150, deadline=None)
def test_decoding_is_an_exact_round_trip(text):
    v = vocabulary()
    assert decode_ids(encode_texts([text], v, 8)[0], v) == text


def test_same_ids_as_the_published_tokenizer(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet")
    t = tokenizers.Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    texts = {r.doc_id: r.text for r in df.collect()}
    got = {r.doc_id: list(r.ids) for r in token_ids(df).collect()}
    assert got == {k: t.encode(x or "", add_special_tokens=False).ids for k, x in texts.items()}


def test_empty_null_special_repeated_and_long(spark):
    long = ("A very long protocol text, 12.5 mg/m² — " * 4000) + "x" * 30_000 + " " * 5_000
    rows = [(1, None), (2, ""), (3, " "), (4, "<|endoftext|>"), (5, long), (5, long)]
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, ids int")
    got = [(r.doc_id, list(r.ids)) for r in token_ids(df).collect()]
    v = vocabulary()
    assert sorted((i, len(x)) for i, x in got) == sorted((i, len(v.encode(t or ""))) for i, t in rows)
    assert dict(got)[1] == dict(got)[2] == [] and 50256 not in dict(got)[4]
    assert dict(got)[5] == v.encoding.encode_ordinary(long)
    assert {r.doc_id: r.n_tokens for r in token_counts(df).collect()}[2] == 0
    back = {r.doc_id: r.text for r in decoded(token_ids(df)).collect()}
    assert back[5] == long and back[1] == ""
    assert token_ids(df.limit(0)).count() == 0


def test_other_vocabulary():
    v = vocabulary("byte_bpe_multi_50k")
    text = "Größe naïve 日本語 " * 500
    assert np.array_equal(encode_texts([text], v, 64)[0], v.encode(text))
