import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from text_cases import SF01, docs, odd_rows

from runwaylens.llm import language
from runwaylens.llm.language import ORDER, Reader, identify, train, train_and_identify, words_of


def brute_model(texts):
    """Interpolated Kneser-Ney over the letters of words, from its definition."""
    top = Counter()
    for text in texts:
        for token in text.split():
            for w in words_of(token):
                padded = f" {w} "
                for end in range(2, len(padded) + 1):
                    top[padded[max(0, end - ORDER) : end]] += 1
    counts = {ORDER: {g: c for g, c in top.items() if len(g) == ORDER}}
    for n in range(ORDER - 1, 0, -1):
        own = Counter({g: c for g, c in top.items() if len(g) == n})
        for g in counts[n + 1]:
            own[g[1:]] += 1
        counts[n] = dict(own)
    rate = {}
    context = {}
    for n, own in counts.items():
        n1, n2 = sum(c == 1 for c in own.values()), sum(c == 2 for c in own.values())
        rate[n] = n1 / (n1 + 2 * n2) if n1 else 0.5
        context[n] = defaultdict(lambda: [0, 0])
        for g, c in own.items():
            context[n][g[:-1]][0] += c
            context[n][g[:-1]][1] += 1

    def p(h, w, signs):
        n = len(h) + 1
        total, kinds = context[n].get(h, (0, 0))
        if n == 1:
            lower = max(rate[1] * kinds / total, 1e-3) / signs
            return max(counts[1].get(w, 0) - rate[1], 0) / total + lower if w in counts[1] else lower
        below = p(h[1:], w, signs)
        if not total:
            return below
        return max(counts[n].get(h + w, 0) - rate[n], 0) / total + rate[n] * kinds / total * below

    return p


def test_probabilities_against_the_definition(spark):
    texts = ["the cat sat on the mat", "that cat and this hat", "a rat ran at the cat"]
    rows = [(i, texts[k % 3]) for k, i in enumerate(i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1)]
    model = train(docs(spark, rows))
    p = brute_model([t for _, t in rows])
    words = ["cat", "hat", "zebra", "this", "a"]
    got = model.log_probabilities(words)[:, 0]
    for w, value in zip(words, got):
        padded = f" {w} "
        want = sum(math.log(p(padded[max(0, i - ORDER + 1) : i], padded[i], 256)) for i in range(1, len(padded)))
        assert math.isclose(value, want, rel_tol=1e-4)


def test_held_out_documents(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = identify(df, train(df)).select("doc_id", "lang", "lang_pred", "lang_score", "lang_rejected").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98
    assert np.mean([r.lang_rejected for r in held]) < 0.05
    assert all(0 <= r.lang_score <= 1 for r in rows)


def test_strange_text_is_rejected_but_named(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    model = train(df)
    got = identify(docs(spark, [(1, "xqzk wvxj qqkz zzxv " * 20)]), model).first()
    assert got.lang_rejected and got.lang_pred in model.languages


def test_reader_forgets_without_harm(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    model = train(df)
    texts = [r.text for r in df.limit(30).collect()]
    assert np.allclose(Reader(model, most=10).read(texts)[0], Reader(model).read(texts)[0])


def test_odd_rows_empty_tables_and_clashing_columns(spark):
    df = docs(spark, odd_rows(), ["lang_pred", "entropy", "chars"])
    model = train(df)
    out = identify(df, model)
    assert sorted(out.columns) == sorted({*df.columns, "lang_score", "lang_rejected"})
    got = {(r.doc_id, r.text): r for r in out.collect()}
    assert got[1, None].lang_pred == got[2, ""].lang_pred == "und" and got[1, None].lang_score == 0
    assert got[None, "a text without an id"].lang_pred in model.languages
    assert train(df.limit(0)) is None and identify(df, None).first().lang_pred == "und"


def test_no_ngram_is_dropped_however_many_there_are(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(letters[(i // 26**k) % 26] for k in range(4)) + "q" for i in range(0, 26**4, 6)]
    ids = [i for i in range(700) if zlib.crc32(str(i).encode()) % 3 != 1][:400]
    rows = [(i, " ".join(words[k :: len(ids)])) for k, i in enumerate(ids)]
    model = train(docs(spark, rows))
    p = brute_model([t for _, t in rows])
    asked = [words[0], words[-1], words[len(words) // 2]]
    assert len(words) > 60_000 < model.part[ORDER].count()
    for w, value in zip(asked, model.log_probabilities(asked)[:, 0]):
        padded = f" {w} "
        want = sum(math.log(p(padded[max(0, i - ORDER + 1) : i], padded[i], 256)) for i in range(1, len(padded)))
        assert math.isclose(value, want, rel_tol=1e-4)


def test_a_row_repeated_in_a_third_of_the_table(spark):
    """Repeats lie in every partition and chunk, and each has the result of the single row."""
    some = [(r.doc_id, r.text, r.lang, "s") for r in spark.read.parquet(f"{SF01}/documents.parquet").limit(200).collect()]
    model = train(docs(spark, some))
    alone = {(r.doc_id, r.text): (r.lang_pred, round(r.lang_score, 9)) for r in identify(docs(spark, some), model).collect()}
    many = docs(spark, some + [some[3]] * 100).repartition(5)
    out = identify(many, model).collect()
    assert len(out) == 300 and all((r.lang_pred, round(r.lang_score, 9)) == alone[r.doc_id, r.text] for r in out)


def test_vector_counts_and_keys_equal_plain_ones(monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcé漢😀ß") for _ in range(rng.randint(1, 30))) for _ in range(500)]
    kinds, counts = np.array([rng.randrange(3) for _ in words]), np.array([rng.randint(1, 9) for _ in words])
    monkeypatch.setattr(language, "WORDS_AT_ONCE", 64)
    grams, table = language.gram_counts(words, kinds, counts, 3)
    want = Counter()
    for w, k, c in zip(words, kinds, counts):
        for g in language.grams_of(w):
            want[g, k] += c
    assert len(set(grams)) == len(grams) and {(g, k): n for g, row in zip(grams, table) for k, n in enumerate(row) if n} == want
    many = [chr(0x4E00 + i) + "x" for i in range(5000)]
    grams, table = language.gram_counts(many, np.zeros(5000, int), np.ones(5000, int), 1)
    assert len(grams) == 15_000 and table.sum() == 15_000


def test_limits_come_from_all_documents(spark):
    """A limit stands on every learnable document: median and spread of all own cross-entropies, not of some."""
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    full = train(df)
    rows = [r for r in df.collect() if r.text and r.lang and zlib.crc32(str(r.doc_id).encode()) % 3 != 1]
    values, chars = Reader(full).read([r.text for r in rows])
    for i, lang in enumerate(full.languages):
        own = np.array([v[i] for r, v, c in zip(rows, values, chars) if r.lang == lang and c])
        middle = np.median(own)
        want = middle + 8 * np.median(np.abs(own - middle)) + 0.5 if len(own) > 20 else np.inf
        assert want == full.accept[i] or abs(want - full.accept[i]) < 9 / language.STEPS
    told = spark.createDataFrame([("en", [i / 5000], 1.0) for i in range(5001)], "lang string, entropy array<double>, chars double")
    assert abs(language._accepted(told, ["en"])[0] - (0.5 + 8 * 0.25 + 0.5)) < 0.01


def test_one_listing_equals_two_steps(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang")
    shape = lambda out: {(r.doc_id, r.lang_pred, round(r.lang_score, 6), r.lang_rejected) for r in out.collect()}
    assert shape(train_and_identify(df, ["doc_id"])) == shape(identify(df, train(df)))
    assert train_and_identify(df.limit(0), ["doc_id"]).count() == 0


def test_texts_move_packed(spark):
    """All rows come out of the packs as they went in, each in its chunk, and the packs are much smaller than the texts."""
    df = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang")
    df = df.unionByName(docs(spark, odd_rows()).select("doc_id", "text", "lang"))
    df = df.withColumn("__chunk", F.pmod(F.xxhash64("text"), F.lit(3)))
    packs = language._packed(df).collect()
    rows = [(p["__chunk"], *r.values()) for p in packs for r in pa.ipc.open_stream(p.pack).read_all().to_pylist()]
    assert sorted(rows, key=str) == sorted([(r["__chunk"], r.doc_id, r.text, r.lang) for r in df.collect()], key=str)
    assert 2 * sum(len(p.pack) for p in packs) < sum(len((r.text or "").encode()) for r in df.collect())
