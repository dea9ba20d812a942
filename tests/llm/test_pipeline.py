import re

import corpus_pipeline
from test_near_dup import brute
from test_sharding import held
from text_cases import SF001

from runwaylens.llm.decontaminate import words_of


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF001).cache()
        assert out.columns[: len(columns)] == columns
        kept[name] = out.collect()
        docs = out.select(*columns)
    first = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    insult = re.compile(r"\b(idiot|moron|scum|pathetic|worthless)\b")
    left = kept["toxicity"]
    # About ten labelled insults are all there is to learn from here; tests of the operator hold it to more.
    assert sum(bool(insult.search(r.text)) for r in left) < 0.5 * sum(bool(insult.search(r.text)) for r in first)
    assert len(left) > 0.8 * len(first)
    alone = kept["near_duplicates"]
    want = brute([(r.doc_id, r.text) for r in left], 80)
    assert sorted(r.doc_id for r in alone) == sorted(i for i, (_, c) in want.items() if c == i)
    items = [words_of(r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    grams = {tuple(w[i : i + min(10, len(w))]) for w in items for i in range(len(w) - min(10, len(w)) + 1) if w}
    clean = kept["benchmark_decontamination"]
    before = {r.doc_id: r.text for r in alone}
    for r in clean:
        w = words_of(r.text)
        assert not any(tuple(w[i : i + 10]) in grams for i in range(len(w)))
        if not any(tuple(x[i : i + 10]) in grams for x in [words_of(before[r.doc_id])] for i in range(len(x))):
            assert r.text == before[r.doc_id]
    mixed = kept["source_mixing"]
    assert {r.doc_id for r in mixed} <= {r.doc_id for r in clean}
    held(kept["sharding"], len(mixed), 40)


def test_run_writes_and_rereads_every_stage(spark):
    out = corpus_pipeline.run(spark, SF001)
    assert out.count() > 0 and {"doc_id", "text", "shard", "slot"} <= set(out.columns)
