import numpy as np
from text_cases import SF01, docs, odd_rows

from runwaylens.llm.mixing import mix, mix_plan, per_row, pivot, settle


def targets(sizes):
    """Water-filling by rounds: share by weight, cap at three times, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    out, open_, left = {}, list(names), float(sum(sizes.values()))
    while True:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > 3 * sizes[s]]
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        for s in full:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
            open_.remove(s)


def by_source(rows):
    out = {}
    for r in rows:
        s = out.setdefault(r.source, [0, 0, 0.0, 0])
        s[0] += r.size
        s[1] += r.taken
        s[2] = r.target
        s[3] = max(s[3], r.size)
    return out


def planned(df, **more):
    rows = per_row(mix_plan(df, **more))
    key = df.select("doc_id", "source").distinct()
    return rows.join(key, "doc_id").selectExpr("*", "copies * size AS taken").collect()


def test_targets_and_taken_words(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "source")
    rows = planned(df)
    assert len(rows) == df.count()
    sums = by_source(rows)
    want = targets({s: v[0] for s, v in sums.items()})
    for s, (_, taken, target, _) in sums.items():
        assert abs(target - want[s]) < 1e-6 * want[s]
        assert abs(taken - target) < 0.02 * target
    assert all(r.taken <= 3 * r.size for r in rows)
    again = planned(df.repartition(7))
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_capped_sources_give_their_excess_to_the_others(spark):
    rows = [(i, "w " * 10, "en", "abc"[min(i // 2, 2)]) for i in range(40)]
    sums = by_source(planned(docs(spark, rows)))
    want = targets({s: v[0] for s, v in sums.items()})
    assert {s: round(v[2], 6) for s, v in sums.items()} == {s: round(t, 6) for s, t in want.items()}
    assert all(abs(v[1] - v[2]) <= 10 for v in sums.values())


def test_every_document_keeps_its_expected_share(spark):
    rng = np.random.default_rng(5)
    p, size = rng.random(9), rng.integers(1, 9, 9).astype(float)
    outcome = [pivot(p, size, 1, g) for g in map(np.random.default_rng, range(6000))]
    assert np.abs(np.mean(outcome, 0) - p).max() < 0.03
    rounded = [settle(pivot(p, size, 4, g), size, g) for g in map(np.random.default_rng, range(300))]
    assert all(set(r) <= {0.0, 1.0} and abs(((r - p) * size).sum()) <= size.max() for r in rounded)
    one = pivot(p, size, 1, np.random.default_rng(1))
    assert abs((one * size).sum() - (p * size).sum()) < 1e-6 and ((one > 0) & (one < 1)).sum() <= 1


def test_the_whole_rounding_is_unbiased_for_the_longest_documents():
    size = np.array([20000.0, 9000, 8500, 8000, 6000, 5000, 4000, 3000, 900, 800, 700, 600, 90, 80, 70, 60] + [9.0] * 20)
    for share in (0.05, 0.1, 0.9):
        p = np.full(len(size), share)
        outcome = np.array([settle(p, size, g) for g in map(np.random.default_rng, range(1500))])
        assert set(outcome.ravel()) <= {0.0, 1.0}
        assert np.abs(outcome.mean(0) - share).max() < 0.03
        assert np.abs((outcome - p) @ size).max() <= size.max()


def test_many_leaves_form_a_tree(spark, monkeypatch):
    from runwaylens.llm import mixing

    monkeypatch.setattr(mixing, "LEAF", 20)
    monkeypatch.setattr(mixing, "FAN", 3)
    df = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "source")
    for taken, target, largest in ((v[1], v[2], v[3]) for v in by_source(planned(df)).values()):
        assert abs(taken - target) < max(0.03 * target, 0.5 * largest)


def test_repeated_and_odd_rows(spark):
    rows = odd_rows() + [(8, "many copies of one row", "en", "hot")] * 500
    df = docs(spark, rows, ["copies", "size"])
    plan = per_row(mix_plan(df)).collect()
    assert len(plan) == len(rows)
    assert all(0 <= r.copies <= 3 for r in plan)
    out = mix(df)
    assert out.columns == df.columns
    assert out.count() == sum(r.copies for r in plan)
    assert out.filter("text is null").count() == 1
    assert mix(df.limit(0)).count() == 0
