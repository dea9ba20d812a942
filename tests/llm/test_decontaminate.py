import random

from text_cases import docs, odd_rows

from runwaylens.llm.decontaminate import SuffixAutomaton, cut, decontaminate, merged, scan, words_of


def brute(words, items, window):
    hit, found, longest = set(), set(), 0
    for name, item in items:
        if item:
            n = min(window, len(item))
            grams = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)}
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in grams:
                    hit |= set(range(i, i + n))
                    found.add(name)
            for i in range(len(words)):
                for j in range(len(item)):
                    m = 0
                    while i + m < len(words) and j + m < len(item) and words[i + m] == item[j + m]:
                        m += 1
                    longest = max(longest, m)
    return hit, found, longest


def test_automaton_against_all_windows():
    rng = random.Random(1)
    for _ in range(300):
        word = lambda: b"abc"[rng.randrange(3) :][:1]
        items = [(str(k), [word() for _ in range(rng.randrange(0, 9))]) for k in range(rng.randrange(1, 6))]
        text = [word() for _ in range(rng.randrange(0, 25))]
        window = rng.randrange(2, 6)
        spans, found, longest = SuffixAutomaton(items, window).scan(text)
        assert spans == merged(spans)
        got = {i for a, b in spans for i in range(a, b)}
        assert (got, found, longest) == brute(text, items, window)


ITEM = "one two three four five six seven eight nine ten eleven"


def bench(spark, *rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_blocks_of_items_find_the_same(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefg") for _ in range(30)) for _ in range(40)]
    items = bench(spark, *[(i, " ".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 6)))) for i in range(20)])
    df = docs(spark, list(enumerate(texts)))
    one = scan(df, items, 4).select("doc_id", "hits").collect()
    many = scan(df, items, 4, block_words=10).select("doc_id", "hits").collect()
    assert sorted(one) == sorted(many)


def test_cut_and_coverage(spark):
    filler = " ".join(f"word{i}" for i in range(40))
    rows = [
        (1, f"Before. {ITEM.upper()}! After {filler}"),
        (2, f"short {ITEM}"),
        (3, f"clean, {filler}"),
        # Cutting the inner passage brings the outer one together.
        (4, f"{filler} one two three four five {ITEM} six seven eight nine ten eleven"),
    ]
    out = {r.doc_id: r for r in decontaminate(docs(spark, rows), bench(spark, (1, ITEM), (2, None), (None, "x"))).collect()}
    assert set(out) == {1, 3, 4}
    assert out[1].text == f"Before. \n! After {filler}" and out[1].n_chars == len(out[1].text)
    assert out[3].text == rows[2][1]
    assert b"one" not in words_of(out[4].text)
    assert cut("ä, Öne two!", [(1, 3)]) == "ä, \n!"


def test_odd_rows_empty_tables_and_clashing_columns(spark):
    df = docs(spark, odd_rows(), ["hits", "spans"])
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert sorted(map(repr, decontaminate(df, none).collect())) == sorted(map(repr, df.collect()))
    found = scan(df, bench(spark, (1, "again and"), (2, "")))
    assert found.filter("size(hits.spans) > 0").count() == 3
    assert scan(df.limit(0), none).count() == 0
    assert decontaminate(df, none).columns == df.columns
