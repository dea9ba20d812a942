import random
import time

from text_cases import docs, odd_rows

from runwaylens.llm.licenses import TEMPLATES, scan, words


def shingles(text):
    w = words(text or "")
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(text):
    have, out = shingles(text), []
    for name, t in sorted(TEMPLATES.items()):
        need = shingles(t)
        if need:
            share = len(need & have) / len(need)
        else:
            w, n = words(text or ""), words(t)
            share = float(any(w[i : i + len(n)] == n for i in range(len(w) - len(n) + 1)))
        if share >= 0.8:
            out.append((name, round(share, 9)))
    return out


def test_against_whole_containment(spark):
    rng = random.Random(4)
    texts = []
    for i in range(150):
        before = " ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(30)))
        notice = rng.choice(list(TEMPLATES.values())).split()
        for _ in range(rng.randrange(3)):
            notice[rng.randrange(len(notice))] = "changed"
        texts.append((i, f"{before} {' '.join(notice).upper() if i % 3 else ' '.join(notice)}, {before}"))
    got = {r.doc_id: [(x.name, round(x.containment, 9)) for x in r.licenses] for r in scan(docs(spark, texts)).collect()}
    assert got == {i: brute(t) for i, t in texts}
    assert sum(map(bool, got.values())) > 40


def test_odd_rows_own_templates_and_clashing_columns(spark):
    df = docs(spark, odd_rows(), ["licenses", "__words"])
    out = scan(df.drop("__words"), {"mine": "same words here again and again", "short": "again and"})
    got = {(r.doc_id, r.text): [x.name for x in r.licenses] for r in out.collect()}
    assert got[5, "same words here again and again"] == ["mine", "short"] and got[1, None] == got[2, ""] == []
    assert scan(df.limit(0)).count() == 0 and scan(df, {}).filter("size(licenses) > 0").count() == 0


def test_a_filter_after_the_scan(spark):
    """The plan stays small, and a filter on the result runs over thousands of rows in seconds."""
    names = list(TEMPLATES)
    texts = [(i, f"start {TEMPLATES[names[i % len(names)]]} end" if i % 4 == 0 else f"plain words {i} and no notice") for i in range(10_000)]
    df = docs(spark, texts, ["row", "__words", "__h", "__distinct"])
    found = scan(df).filter("size(licenses) > 0")
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 1_000_000
    start = time.monotonic()
    assert found.count() == 2_500
    assert time.monotonic() - start < 60
    assert found.columns == [*df.columns, "licenses"]
