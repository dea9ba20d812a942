import math
import re
from collections import Counter, defaultdict

import numpy as np
from text_cases import SF01, docs, odd_rows

from runwaylens.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    covered = {i + d for i, w in enumerate(windows) if count[w] > 1 for d in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def brute_distances(rows):
    """Concentration steps over lists of vectors, as the operator states them."""
    least = np.array(list(quality.VECTOR.values()))
    floor = np.diag(least**2)
    bin_of = lambda d: np.floor(np.log2(np.maximum(d, 1e-6)) * quality.BINS).astype(int)

    def far(x, m, c):
        y = np.linalg.solve(np.linalg.cholesky(c), (x - m).T)
        return (y**2).sum(0)

    def inner(bins, share):
        counts = Counter(bins.tolist())
        so_far, last = 0, None
        for b in sorted(counts):
            if so_far < len(bins) * share:
                last = b
            so_far += counts[b]
        return last

    out = {}
    for x in rows.values():
        v = np.array([r[1] for r in x])
        m = np.array([(inner(np.floor(v[:, k] * 256).astype(int), 0.5) + 0.5) / 256 for k in range(4)])
        c = floor
        for _ in range(quality.STEPS):
            b = bin_of(far(v, m, c))
            part = v[b <= inner(b, quality.HALF)]
            m, c = part.mean(0), np.cov(part.T, bias=True) + floor
        d = far(v, m, c)
        scale = max(1.0, 2.0 ** ((inner(bin_of(d), 0.5) + 1) / quality.BINS) / quality.MEDIAN)
        part = v[d / scale <= quality.USUAL]
        m, c = part.mean(0), np.cov(part.T, bias=True) + floor
        out |= {r[0]: dist for r, dist in zip(x, far(v, m, c))}
    return out


def test_statistics_and_distances_against_brute_force(spark):
    table = spark.read.parquet(f"{SF01}/documents.parquet")
    source = {r.doc_id: r for r in table.collect()}
    got = {r.doc_id: r for r in quality.judge(table).collect()}
    assert set(got) == set(source)
    groups = defaultdict(list)
    for i, r in source.items():
        want = base(r.text)
        g = got[i]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == want
        n, chars, symbols, lines, repeat = want
        failed = n < 50 or 100 * repeat > 50 * n
        assert g.base_failed == failed
        if not failed:
            angle = lambda a, n=n: math.asin(math.sqrt(min(1.0, a / n)))
            groups[r.lang, r.source].append((i, [math.log(chars / n), angle(symbols), math.log1p(lines), angle(repeat)]))
    large = {k: v for k, v in groups.items() if len(v) >= quality.LEAST}
    pooled = defaultdict(list)
    for k, v in groups.items():
        if k not in large:
            pooled[k[0]] += v
    large |= {k: v for k, v in pooled.items() if len(v) >= quality.LEAST}
    want = brute_distances(large)
    assert want
    for i, d in want.items():
        assert math.isclose(got[i].distance2, d, rel_tol=1e-6, abs_tol=1e-9)
        assert got[i].kept == (d <= quality.LIMIT)
    assert all(g.distance2 is None and (g.kept != g.base_failed) for i, g in got.items() if i not in want)


def test_a_planted_outlier_goes_and_clean_texts_stay(spark):
    words = "the small river runs past old mills and quiet fields where people walk in spring".split()
    clean = [(i, " ".join(words[(i * 7 + j * (1, 2, 4)[i % 3]) % len(words)] + str(j % 7) for j in range(80))) for i in range(120)]
    junk = [(999, " ".join(f"<|{j}|>" for j in range(400)))]
    got = {r.doc_id: r for r in quality.judge(docs(spark, clean + junk)).collect()}
    assert not got[999].kept and not got[999].base_failed
    assert all(got[i].kept for i, _ in clean)


def test_odd_rows_empty_tables_and_clashing_columns(spark):
    df = docs(spark, odd_rows(), ["n_words", "kind"])
    rows = quality.judge(df).collect()
    assert len(rows) == len(odd_rows())
    assert all(not r.kept for r in rows if r.doc_id in (1, 2, 3)) and {r.kind for r in rows} == {"x"}
    assert quality.judge(df.limit(0)).count() == 0
