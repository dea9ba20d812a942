import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from text_cases import SF001, docs, odd_rows
from tokenizers import Tokenizer

from runwaylens.llm.bpe import Encoder, MergeAutomaton, Vocabulary, byte_signs, compile_merges, decode, encode, read_vocabulary
from runwaylens.llm.q11_bpe import VOCABULARY, op11_bpe_automaton

PUBLIC = read_vocabulary(VOCABULARY)
LIBRARY = Tokenizer.from_file(VOCABULARY)
SHORT_PARTS = Encoder(PUBLIC, compile_merges(PUBLIC), part=8)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PUBLIC, SHORT_PARTS.automaton, most=50, part=200)


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text), "<u4").tolist()


def by_ranks(word, merges):
    """The definition: the first merge of the list that fits anywhere, leftmost, until none fits."""
    word = list(word)
    while True:
        for a, b, c in merges:
            at = next((i for i in range(len(word) - 1) if (word[i], word[i + 1]) == (a, b)), None)
            if at is not None:
                word[at : at + 2] = [c]
                break
        else:
            return word


@st.composite
def small_merges(draw):
    """Merges over three bytes, each of two labels made before, no label twice."""
    labels, merges = [b"a", b"b", b"c"], []
    for _ in range(draw(st.integers(1, 14))):
        a, b = draw(st.integers(0, len(labels) - 1)), draw(st.integers(0, len(labels) - 1))
        if labels[a] + labels[b] in labels:
            continue
        merges.append((a, b, len(labels)))
        labels.append(labels[a] + labels[b])
    return labels, merges


@settings(max_examples=150, deadline=None)
@given(small_merges(), st.lists(st.integers(0, 2), min_size=1, max_size=24))
def test_paths_equal_successive_merges(made, word):
    labels, merges = made
    automaton, used = MergeAutomaton([0, 1, 2], len(labels)), []
    try:
        for m in merges:
            automaton.merge(*m)
            used.append(m)
    except ValueError:
        pass
    bytes_to_id = [0] * 256
    for i, b in enumerate(b"abc"):
        bytes_to_id[b] = i
    e = Encoder(Vocabulary(labels, used, bytes_to_id, {}), automaton)
    want = by_ranks(word, used)
    assert e.encode_word(b"".join(labels[i] for i in word)) == want
    state = MergeAutomaton.START
    for label in want:
        state = automaton.step(state, label)
        assert state >= 0


def test_other_label_sequences_are_refused():
    """All sequences of up to four labels: accepted exactly where encoding their bytes gives them back."""
    labels, merges = [b"a", b"b", b"ab", b"aa", b"aab", b"bab"], [(0, 1, 2), (0, 0, 3), (3, 1, 4), (1, 2, 5)]
    automaton, used = MergeAutomaton([0, 1], 6), []
    for m in merges:
        try:
            automaton.merge(*m)
            used.append(m)
        except ValueError:
            assert m == (3, 1, 4)  # "a" before "ab" never is "aa" before "b"
    live = [0, 1, 2, 3, 5]
    seen = [[]]
    for _ in range(4):
        seen = [[*s, x] for s in seen for x in live]
        for s in seen:
            state = MergeAutomaton.START
            for x in s:
                state = automaton.step(state, x) if state >= 0 else -1
            letters = [0 if c == 97 else 1 for x in s for c in labels[x]]
            assert (state >= 0) == (by_ranks(letters, used) == s)


def test_equal_to_the_library_on_documents(spark, encoder):
    texts = [r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").select("text").collect() if r.text]
    want = [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    assert [ids(encoder, t) for t in texts] == want
    assert [encoder.decode(encoder.encode(t)) for t in texts] == LIBRARY.decode_batch(want, skip_special_tokens=False)
    assert len(encoder.words) <= 51


def test_every_code_point_is_split_as_in_the_library(encoder):
    points = [chr(cp) for cp in range(0x110000) if not 0xD800 <= cp < 0xE000]
    for i in range(0, len(points), 512):
        text = "".join(f"a{c}1{c}! {c}{c} x" for c in points[i : i + 512])
        want = [text[a:b] for _, (a, b) in LIBRARY.pre_tokenizer.pre_tokenize_str(text)]
        assert encoder.split(text) == want


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab Zé'stlvremd9²\n\t\x1c  你\U0001f600<|endoftext|>.,_", max_size=40), st.integers(0, 2))
def test_equal_to_the_library_on_odd_texts(text, specials):
    e = SHORT_PARTS
    text = "<|endoftext|>".join([text] * (specials + 1))
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert ids(e, text) == want
    assert e.decode(e.encode(text)) == LIBRARY.decode(want, skip_special_tokens=False) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 50_300), max_size=12))
def test_decoding_any_ids_as_the_library(numbers):
    assert SHORT_PARTS.decode(np.array(numbers, "<u4").tobytes()) == LIBRARY.decode(numbers, skip_special_tokens=False)


def test_long_words_and_long_texts(encoder):
    for text in ["a" * 30_000, "ab" * 9_000 + "!" * 9_000, " " * 5_000 + "x", ("one two's three 12 " * 4_000)]:
        assert ids(encoder, text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_bytes_and_signs():
    signs = byte_signs()
    assert sorted(signs.values()) == list(range(256)) and signs["Ġ"] == 32


def test_odd_rows_and_clashing_columns(spark):
    df = docs(spark, odd_rows(), ["decoded", "__w"]).selectExpr("*", "'x' AS ids")
    out = decode(encode(df, VOCABULARY), VOCABULARY)
    assert out.columns == [c for c in df.columns if c not in ("ids", "decoded")] + ["ids", "decoded"]
    rows = out.collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert r.ids == LIBRARY.encode(r.text or "", add_special_tokens=False).ids and r.decoded == (r.text or "")
    packed = {(r.doc_id, r.text): r.ids for r in encode(df, VOCABULARY, packed=True).collect()}
    assert all(np.frombuffer(packed[r.doc_id, r.text], "<i4").tolist() == r.ids for r in rows)
    assert encode(df.limit(0), VOCABULARY).count() == 0
    nothing = decode(spark.createDataFrame([(None,), ([72, None, 72],)], "ids array<int>"), VOCABULARY)
    assert [r.decoded for r in nothing.collect()] == [None, "ii"]


def test_query_gives_the_digests_of_the_library(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    out = op11_bpe_automaton(spark, SF001)
    assert dict(out.dtypes) == {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out.collect()}
    want = {}
    for i, t in texts.items():
        e = LIBRARY.encode(t, add_special_tokens=False).ids
        text = LIBRARY.decode(e, skip_special_tokens=False).encode()
        want[i] = (len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(), hashlib.sha256(text).hexdigest())
    assert got == want


def test_other_kinds_of_files_are_refused(tmp_path):
    spec = '{"model": {"type": "WordPiece"}, "pre_tokenizer": null, "added_tokens": [], "normalizer": null}'
    (tmp_path / "other.json").write_text(spec)
    with pytest.raises(ValueError, match="not a plain byte-level BPE"):
        read_vocabulary(str(tmp_path / "other.json"))
