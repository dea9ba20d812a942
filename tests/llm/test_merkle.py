import hashlib
import random

import pytest
from pyspark.sql import functions as F
from text_cases import COLUMNS, SF01, docs, odd_rows

from runwaylens.llm.merkle import field, fold, leaf_digest, manifest, proof_digest, ranked
from runwaylens.llm.q12_merkle import op12_merkle_manifest
from runwaylens.sources.scratch import Workspace


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def run_up(nodes):
    """(root, siblings of each leaf) of a run, level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            other = i ^ 1
            paths[leaf].append((bool(i & 1), nodes[other] if other < len(nodes) else None))
        nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        at = [i // 2 for i in at]
    return nodes[0], paths


def brute(rows):
    """(doc_id, lang, leaf, position, subroot, root, path) for rows (doc_id, lang, leaf)."""
    runs = {}
    for r in rows:
        runs.setdefault(r[1], []).append(r)
    names = sorted(runs, key=lambda x: (x is not None, (x or "").encode()))
    below = {}
    for name in names:
        runs[name].sort(key=lambda r: (-(1 << 63) if r[0] is None else r[0], r[2]))
        below[name] = run_up([r[2] for r in runs[name]])
    root, tops = run_up([below[n][0] for n in names])
    return sorted(
        ((*r, i, below[n][0], root, tuple(below[n][1][i] + tops[k])) for k, n in enumerate(names) for i, r in enumerate(runs[n])),
        key=repr,
    )


def rows_of(df):
    return sorted(
        ((r.doc_id, r.lang, r.leaf, r.position, r.subroot, r.root, tuple((p.left, p.digest) for p in r.proof)) for r in df.collect()), key=repr
    )


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, lang string, leaf string")


@pytest.mark.parametrize("seed", [1, 2])
def test_positions_roots_and_proofs_equal_brute_force(spark, seed):
    """Runs of 1, 2, 257 and over 65,536 / 32 leaves, sparse and dense, negative and extreme keys."""
    rng = random.Random(seed)
    rows = [(-(1 << 63), "x"), ((1 << 63) - 1, "x"), (5, "lone"), (None, None), (0, "\U0001f600"), (-1, "é")]
    rows += [(i, "dense") for i in rng.sample(range(-700, 2000), 2500)]
    rows += [(rng.randint(-(1 << 62), 1 << 62), "sparse") for _ in range(1500)]
    rows = [(i, lang, h(str(i), str(lang))) for i, lang in rows]
    rng.shuffle(rows)
    assert rows_of(manifest(frame(spark, rows))) == brute(rows)


def test_exact_powers_of_the_block_size(spark):
    for n in (255, 256, 257, 512):
        rows = [(i, "a", h(str(i))) for i in range(n)]
        assert rows_of(manifest(frame(spark, rows))) == brute(rows)


def test_repeated_keys_and_hot_rows(spark):
    """A third of all rows share a key, another third have none: ties go by leaf, equal rows have places of their own."""
    rng = random.Random(4)
    rows = [(7, "a", h("hot", str(i % 150))) for i in range(400)] + [(None, "a", h("null", str(i))) for i in range(400)]
    rows += [(i, "a", h(str(i))) for i in range(400)] + [(3, "a", h("same"))] * 300
    rng.shuffle(rows)
    assert rows_of(manifest(frame(spark, rows).repartition(7))) == brute(rows)


def test_ranks_need_no_window_over_a_group(spark):
    rows = spark.range(70_000).selectExpr("'g' AS g", "id * 64 AS k1", "0L AS k2", "id AS k3")
    with Workspace(spark, "test") as work:
        placed, totals = ranked(rows, ["g"], ["k1", "k2", "k3"], work)
        assert placed.filter("pos <> k3").isEmpty() and totals.first().total == 70_000
        counts = spark.read.parquet(f"{work.root}/counts1_0")
        assert counts.groupBy("g", "parent").count().agg(F.max("count")).first()[0] <= 1024


def test_changed_rows_do_not_verify(spark):
    rows = [(i, "ab"[i % 2], h(str(i))) for i in range(600)]
    out = manifest(frame(spark, rows))
    out = out.withColumn("given", F.when(F.col("doc_id") % 5 == 0, F.sha2("leaf", 256)).otherwise(F.col("leaf")))
    for r in out.select("doc_id", (fold(F.col("given"), F.col("proof")) == F.col("root")).alias("ok")).collect():
        assert r.ok == (r.doc_id % 5 != 0)


def test_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{SF01}/documents.parquet").collect()
    import zlib

    def digest(r, more=0):
        parts = [r.doc_id, r.source, r.lang, None if r.n_chars is None else r.n_chars + more, r.text]
        return h(*("-" if p is None else f"{len(str(p).encode())}:{p}" for p in parts))

    changed = {r.doc_id: digest(r, 1) if zlib.crc32(str(r.doc_id).encode()) % 7 == 0 else digest(r) for r in table}
    want = []
    for i, _lang, leaf, _position, subroot, root, path in brute([(r.doc_id, r.lang, digest(r)) for r in table]):
        node = changed[i]
        for left, d in path:
            node = h(d, node) if left else h(node, d or "")
        want.append((i, leaf, subroot, root, h(*(d for _, d in path if d)), node, node == root))
    out = op12_merkle_manifest(spark, SF01)
    got = sorted(tuple(r) for r in out.collect())
    assert got == sorted(want) and {r[-1] for r in got} == {True, False}


def test_fields_tell_null_and_empty_apart(spark):
    df = spark.createDataFrame([(None, 12), ("", None), ("é", -3)], "s string, n int")
    assert [tuple(r) for r in df.select(field(F.col("s")), field(F.col("n"))).collect()] == [("-", "2:12"), ("0:", "-"), ("2:é", "2:-3")]


def test_odd_rows_clashing_columns_and_empty_tables(spark):
    names = ["g", "pos", "row", "k1", "digest", "block", "entries", "path", "position", "root", "a.b"]
    df = docs(spark, odd_rows(), names).withColumn("m", F.create_map(F.lit("k"), F.col("doc_id")))
    df = df.withColumn("leaf", leaf_digest(*[F.col(c) for c in ["doc_id", "text", "lang"]]))
    out = manifest(df)
    assert out.columns == [c for c in df.columns if c not in ("position", "root")] + ["position", "subroot", "root", "proof"]
    assert rows_of(out) == brute([(r.doc_id, r.lang, r.leaf) for r in df.collect()])
    assert {r.g for r in out.collect()} == {"x"} and all(r.m == {"k": r.doc_id} for r in out.collect())
    empty = manifest(df.limit(0))
    assert empty.columns == out.columns and empty.count() == 0
    one = manifest(frame(spark, [(1, None, None)])).select("*", proof_digest(F.col("proof")).alias("p")).first()
    assert (one.root, one.position, one.proof, one.p) == ("", 0, [], h())
    assert COLUMNS
