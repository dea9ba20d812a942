import zlib

import numpy as np
from text_cases import SF01, docs, odd_rows

from runwaylens.llm.toxicity import drop_toxic, pieces, score, spaced, train, triples


def kernel(s, t):
    """Normalised gappy kernel from its definition: all triples of both words, by span."""
    from runwaylens.llm.toxicity import DECAY, SPAN

    def features(w):
        w = "\x01" + w + "\x02"
        out = {}
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for k in range(j + 1, min(len(w), i + SPAN)):
                    out[w[i] + w[j] + w[k]] = out.get(w[i] + w[j] + w[k], 0) + DECAY ** (k - i + 1)
        return out

    a, b = features(s), features(t)
    return sum(v * b.get(x, 0) for x, v in a.items()) / np.sqrt(
        sum(v * v for v in a.values()) * sum(v * v for v in b.values())
    )


def test_features_give_the_kernel():
    words = ["idiot", "idxiot", "banana", "ääb", "window", "wi"]
    row, key, weight = triples(words)
    f = [dict(zip(key[row == i], weight[row == i])) for i in range(len(words))]
    for i, s in enumerate(words):
        for j, t in enumerate(words):
            assert abs(sum(v * f[j].get(k, 0) for k, v in f[i].items()) - kernel(s, t)) < 1e-9
    assert kernel("idiot", "idxiot") > 0.5 > kernel("idiot", "window")


def test_spaced_words_and_long_words():
    assert list(spaced("you i d i o t and a b done".split())) == ["idiot"]
    assert list(spaced("x. y, z".split())) == ["xyz"]
    word = "".join(chr(97 + i % 26) for i in range(100))
    assert all(any(word[i : i + 7] in p for p in pieces(word)) for i in range(94)) and pieces("ab") == []


def test_held_out_documents(spark):
    df, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    model = train(df, labels)
    scored = score(df, model).join(labels, "doc_id").select("doc_id", "toxicity", "toxic", "lang").collect()
    held = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % 3 == 1 and r.lang == "en"]
    bad = [r.toxicity for r in held if r.toxic]
    good = [r.toxicity for r in held if not r.toxic]
    auc = np.mean([(b > g) + 0.5 * (b == g) for b in bad for g in good])
    assert auc > 0.85
    assert np.mean([g < 0.7 for g in good]) > 0.97
    # Hidden spellings stay close to what they hide.
    plain = "the of and to in that was for it as " * 5
    hidden = docs(spark, [(1, plain), (2, plain + "i d i o t pathetic"), (3, plain + "idi-ot patxhetic"), (4, plain + "idiot pathetic")])
    got = {r.doc_id: r.toxicity for r in score(hidden, model).collect()}
    assert got[1] < 0.3 and min(got[2], got[3], got[4]) > 0.7
    kept = drop_toxic(df, labels)
    assert kept.columns == df.columns and 0 < kept.count() < df.count()


def test_labels_are_no_input_and_held_out_ones_teach_nothing(spark):
    df, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    turned = labels.selectExpr("doc_id", "quality", "IF(crc32(CAST(doc_id AS STRING)) % 3 = 1, 1 - toxic, toxic) AS toxic")
    assert np.allclose(train(df, labels).weights, train(df, turned).weights)


def test_odd_rows_without_labels(spark):
    df = docs(spark, odd_rows(), ["toxicity", "worst"])
    none = spark.createDataFrame([(2, None), (None, 1), (4, 1)], "doc_id bigint, toxic int")
    assert train(df, none) is None and train(df, none.limit(0)) is None
    assert {r.toxicity for r in score(df, None).collect()} == {0.0}
    model = train(spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet"))
    out = score(df, model)
    assert sorted(out.columns) == sorted(df.columns)
    rows = out.collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r.toxicity <= 1 for r in rows)
    assert score(df.limit(0), model).count() == 0
