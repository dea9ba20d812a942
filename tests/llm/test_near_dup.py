import random
from collections import Counter

from text_cases import SF01, docs, odd_rows

from runwaylens.llm import near_dup
from runwaylens.llm.near_dup import components, drop_near_duplicates, group_near_duplicates, least_shared
from runwaylens.sources.scratch import Workspace


def shingles(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or frozenset([tuple(w)])


def brute(rows, percent):
    """Smallest id that links reach, over all pairs."""
    sets = {i: shingles(t) for i, t in rows}
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def grouped(df, percent=85):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in group_near_duplicates(df, percent).collect()}


def drifting(n, words, edits, seed):
    """Copies of copies: each changes a few words of some copy before it."""
    rng = random.Random(seed)
    out = [[f"w{rng.randrange(10**6)}" for _ in range(words)]]
    for _ in range(n - 1):
        text = list(rng.choice(out))
        for _ in range(edits):
            text[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        out.append(text)
    return [" ".join(t) for t in out]


def test_components_of_the_test_table_against_all_pairs(spark):
    df = spark.read.parquet(f"{SF01}/documents.parquet")
    assert grouped(df) == brute([(r.doc_id, r.text) for r in df.collect()], 85)


def test_large_drifting_groups_and_shared_passages_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 32)
    monkeypatch.setattr(near_dup, "SMALL_LIST", 10)
    rng = random.Random(9)
    passage = " ".join(f"p{i}" for i in range(30))
    texts = drifting(150, 120, 3, 1) + drifting(80, 40, 1, 2) + drifting(40, 300, 9, 3) + ["A b c"] * 5 + ["a B c d"] * 3
    texts += [f"{passage} {' '.join(f'q{rng.randrange(10**6)}' for _ in range(rng.randint(2, 40)))}" for _ in range(60)]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    want = brute(rows, 85)
    assert len({c for _, c in want.values()}) > 40
    assert grouped(docs(spark, rows)) == want


def test_far_copies_of_one_text_are_not_compared_in_blocks(spark, monkeypatch):
    """Copies that share a base, but too little of it for a link, and a few that are linked."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(200)]
    texts = []
    for i in range(600):
        text = list(base)
        for at in range(i % 20, 200, 20):
            text[at] = f"e{rng.randrange(10**9)}"
        texts.append(" ".join(text))
    texts += drifting(20, 100, 1, 12)
    rows, compared = list(enumerate(texts)), []
    wide = near_dup._wide_links

    def counted(members, *rest):
        compared.append(members.count())
        return wide(members, *rest)

    monkeypatch.setattr(near_dup, "_wide_links", counted)
    assert grouped(docs(spark, rows)) == brute(rows, 85)
    assert sum(compared) <= len(rows)


def test_lists_of_a_large_group_make_few_pairs_of_neighbours(spark, monkeypatch):
    """Far copies of one text share most of their lists; pairs are not made once for each list."""
    monkeypatch.setattr(near_dup, "SMALL_LIST", 10)
    rng = random.Random(13)
    base, texts = [f"w{i}" for i in range(300)], drifting(30, 100, 1, 14)
    for _ in range(400):
        text = list(base)
        for at in rng.sample(range(300), 20):
            text[at] = f"e{rng.randrange(10**9)}"
        texts.append(" ".join(text))
    rows, made = list(enumerate(texts)), []
    kind = type(docs(spark, rows))
    plain = kind.mapInArrow

    def counted(df, func, schema, *rest):
        out = plain(df, func, schema, *rest)
        if schema == "a binary, b binary":
            made.append(out.count())
        return out

    monkeypatch.setattr(kind, "mapInArrow", counted)
    assert grouped(docs(spark, rows), 80) == brute(rows, 80)
    assert 0 < sum(made) <= 4 * len(rows)


def test_one_pair_of_sketches_is_tested_as_the_joined_ones_are(spark):
    rng = random.Random(15)
    texts = [t for i in range(12) for t in drifting(6, rng.choice([9, 40, 68, 70, 72, 90, 200]), 2, i)]
    sets = [near_dup.shingle_set(t) for t in texts]
    names = [i.to_bytes(2, "big") for i in range(len(sets))]
    rows = [(c, len(s), s[: near_dup.K].tolist()) for c, s in zip(names, sets)]
    reps = spark.createDataFrame(rows, "cls binary, n bigint, sketch array<bigint>")
    pairs = reps.selectExpr("cls as a").join(reps.selectExpr("cls as b")).filter("a < b")
    want = {(bytes(r.a), bytes(r.b)) for r in near_dup._estimated(pairs, reps, 0.8, near_dup.K).collect()}
    least = least_shared(near_dup.K, 0.8)
    got = {
        (names[i], names[j])
        for j in range(len(sets))
        for i in range(j)
        if near_dup._near(rows[i][1], sets[i][: near_dup.K], rows[j][1], sets[j][: near_dup.K], 0.8, near_dup.K, least)
    }
    assert got == want and 0 < len(got) < len(sets) ** 2 / 4


def test_one_document_of_each_group_stays(spark):
    own = list(enumerate(drifting(30, 60, 1, 4), 100)) + [(150, "other words " * 9), (151, "other words " * 9)]
    df = docs(spark, own + odd_rows(), ["cls", "root", "id"])
    out = drop_near_duplicates(df)
    assert out.columns == df.columns
    kept = Counter(r.doc_id for r in out.collect())
    assert all(kept[i] == (c == i) for i, (_, c) in brute(own, 80).items())
    # Texts without words stay, and one of the three equal short ones.
    texts = [r.text for r in out.collect()]
    assert texts.count(None) == 1 and texts.count("") == 1 and texts.count("same words here again and again") == 1


def test_odd_rows_and_empty_tables(spark):
    df = docs(spark, odd_rows())
    rows = group_near_duplicates(df).collect()
    assert len(rows) == len(odd_rows())
    got = {r.doc_id: r for r in rows}
    assert got[1].n_shingles == got[2].n_shingles == 0 and got[2].component_id == 2
    assert got[6].component_id == 5 and got[None].component_id is None
    assert group_near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    names = [bytes([i // 250, i % 250]) for i in range(400)]
    order = list(range(400))
    random.Random(1).shuffle(order)
    links = spark.createDataFrame([(names[order[i]], names[order[i + 1]]) for i in range(399)], "a binary, b binary")
    with Workspace(spark, "path") as work:
        roots = components(links, work, "x").collect()
    assert len(roots) == 400 and {bytes(r.root) for r in roots} == {names[0]}


def test_bounds_of_the_sketch_tests():
    from math import comb

    for m in (32, 64):
        t = least_shared(m, 0.85)
        miss = sum(comb(m, i) * 0.85**i * 0.15 ** (m - i) for i in range(t))
        assert miss < 1e-9
