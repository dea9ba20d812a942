from hypothesis import given, settings
from hypothesis import strategies as st
from text_cases import SF001, docs, odd_rows
from tokenizers import Tokenizer, pre_tokenizers
from tokenizers.models import Unigram

from runwaylens.llm.q01_tokens import VOCABULARY
from runwaylens.llm.tokens import UnigramCounter, read_pieces, token_totals, with_token_counts

PIECES = read_pieces(VOCABULARY)


def library(pieces, byte_fallback):
    low = min(s for _, s in pieces)
    vocab = [("<unk>", low), *((f"<0x{b:02X}>", low) for b in range(256)), *pieces]
    t = Tokenizer(Unigram(vocab, unk_id=0, byte_fallback=byte_fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return t


def test_counts_equal_the_tokenizer_library(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").select("text").collect()]
    counter, t = UnigramCounter(PIECES), library(PIECES, True)
    assert [counter.count(x) for x in texts] == [len(e.ids) for e in t.encode_batch(texts)]


SMALL = [("▁", -2.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("aab", -3.0), ("▁a", -3.0), ("ba", -2.0), ("aa", -2.0)]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab cé\U0001f600", max_size=14), st.booleans())
def test_ties_and_unknown_signs_as_in_the_library(text, fallback):
    want = len(library(SMALL, fallback).encode(text).ids)
    assert UnigramCounter(SMALL, byte_fallback=fallback).count(text) == want


def test_cache_is_bounded_and_harmless():
    counter, plain = UnigramCounter(PIECES, most=3), UnigramCounter(PIECES)
    texts = [f"one two{i} three four" for i in range(20)]
    assert [counter.count(t) for t in texts] == [plain.count(t) for t in texts]
    assert len(counter.known) < 20


def test_odd_rows_and_clashing_columns(spark):
    df = docs(spark, odd_rows(), ["n_tokens", "__words"])
    out = with_token_counts(df, VOCABULARY)
    assert out.columns == [c for c in df.columns if c != "n_tokens"] + ["n_tokens"]
    got = {(r.doc_id, r.text): r.n_tokens for r in out.collect()}
    assert got[1, None] == got[2, ""] == 0 and got[None, "a text without an id"] > 0
    assert with_token_counts(df.limit(0), VOCABULARY).count() == 0
    assert token_totals(out, "lang").count() == 4
