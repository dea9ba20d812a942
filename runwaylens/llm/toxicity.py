"""Toxicity by a support vector machine over a gappy subsequence string kernel with Nystroem landmarks.

The kernel compares two words by the letter triples they share in order, with gaps: a triple that spans s letters
weighs DECAY ** s, spans go up to SPAN letters, so a word with inserted, dropped or spaced letters stays close to
the word it hides. The feature map of this kernel is explicit (one coordinate for each triple), so a machine trained
on the kernel values to a few hundred landmark words collapses into one weight for each triple.

Labels belong to documents. They are handed down to distinct sentences (a sentence that also occurs in a clean
document is clean), and words are judged by the sentences they stand in. The score of a document is a calibrated
function of its two worst words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from heapq import nlargest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runwaylens.llm.common import learnable, small_batches
from runwaylens.sources.scratch import Workspace

SPAN = 6
DECAY = 0.7
# Longest piece of a word that is compared at once; longer words are read in overlapping pieces.
PIECE = 14
LANDMARKS = 400
COST = 10.0
# Rounds in which the good words that look worst, of all that were counted, join the fit.
MINING = 3
# Bounds of the fit: labelled documents, and words on either side.
FIT_DOCS = 10_000
FIT_WORDS = 12_000
LOW = -2.0
# Texts whose new words are judged together.
CHUNK = 200
MANY = 5000
# Texts that a worker holds as strings at once.
TEXTS = 1000
_STEPS = [(a, b) for a in range(1, SPAN - 1) for b in range(1, SPAN - a)]
_SENTENCE = re.compile(r"[.!?\n]+")
_START, _END = 1, 2


def letters(word: str) -> str:
    return word if word.isalpha() else "".join(c for c in word if c.isalpha())


def spaced(tokens: list[str]) -> Iterator[str]:
    """Words written one letter at a time: runs of three or more tokens that hold one letter each."""
    run: list[str] = []
    last = -2
    for i in [i for i, t in enumerate(tokens) if len(t) <= 2]:
        one = letters(tokens[i])
        if len(one) != 1:
            continue
        if i != last + 1:
            if len(run) > 2:
                yield "".join(run)
            run = []
        run.append(one)
        last = i
    if len(run) > 2:
        yield "".join(run)


def pieces(word: str) -> list[str]:
    """The whole word, in overlapping pieces if it is long; nothing for words of fewer than three letters."""
    if len(word) <= PIECE:
        return [word] if len(word) > 2 else []
    return [word[i : i + PIECE] for i in range(0, len(word) - PIECE // 2, PIECE // 2)]


def triples(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised features of at most MANY short words, as (word number, triple, weight), by word."""
    width = max(map(len, words)) + 2
    codes = np.zeros((len(words), width), np.int64)
    for i, w in enumerate(words):
        codes[i, 1 : len(w) + 1] = np.frombuffer(w.encode("utf-32-le", "surrogatepass"), np.uint32)
        codes[i, 0], codes[i, len(w) + 1] = _START, _END
    rows, keys, weights = [], [], []
    for a, b in _STEPS:
        if a + b < width:
            x, y, z = codes[:, : width - a - b], codes[:, a : width - b], codes[:, a + b :]
            r, c = np.nonzero(z)
            rows.append(r)
            keys.append((x[r, c] << 42) | (y[r, c] << 21) | z[r, c])
            weights.append(np.full(len(r), DECAY ** (a + b + 1)))
    row, key, weight = map(np.concatenate, (rows, keys, weights))
    # One number to sort by: the word, and 50 bits of the mixed triple (that two of a word agree in these is as good
    # as impossible; they would then only fail to be added up).
    mixed = (key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(14)
    order = np.argsort((row.astype(np.uint64) << np.uint64(50)) | mixed)
    row, key, weight = row[order], key[order], weight[order]
    first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (key[1:] != key[:-1])])
    weight = np.add.reduceat(weight, first)
    row, key = row[first], key[first]
    norm = np.sqrt(np.bincount(row, weight**2, len(words)))
    return row, key, weight / norm[row]


@dataclass
class Model:
    """Weight of each triple, and the calibration of a document's two worst words."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    calibration: np.ndarray

    def judge(self, words: list[str]) -> np.ndarray:
        """Decision value of each short word."""
        if len(words) > MANY:
            return np.concatenate([self.judge(words[i : i + MANY]) for i in range(0, len(words), MANY)])
        if not words:
            return np.empty(0)
        row, key, weight = triples(words)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.bincount(row[hit], weight[hit] * self.weights[at[hit]], len(words)) + self.bias

    def probability(self, worst: np.ndarray) -> np.ndarray:
        z = worst @ self.calibration[:-1] + self.calibration[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class Judge:
    """Worst two words of texts, with the values of words met before kept in bounded memory."""

    def __init__(self, model: Model, most: int = 250_000) -> None:
        self.model, self.most, self.known = model, most, {}

    def worst(self, texts: Sequence[str | None]) -> np.ndarray:
        out = np.full((len(texts), 2), LOW)
        for start in range(0, len(texts), CHUNK):
            docs = []
            for text in texts[start : start + CHUNK]:
                tokens = [] if text is None else text.lower().split()
                docs.append({t if t.isalpha() else letters(t) for t in set(tokens)}.union(spaced(tokens)))
            if len(self.known) > self.most:
                self.known.clear()
            self._learn([w for w in set().union(*docs) if w not in self.known])
            for i, words in enumerate(docs, start):
                values = nlargest(2, map(self.known.__getitem__, words))
                out[i, : len(values)] = values
        return out

    def _learn(self, new: list[str]) -> None:
        for start in range(0, len(new), 5000):
            part = new[start : start + 5000]
            cut = [pieces(w) for w in part]
            flat = [p for ps in cut for p in ps]
            values = self.model.judge(flat)
            at = 0
            for w, ps in zip(part, cut):
                self.known[w] = max(LOW, float(values[at : at + len(ps)].max())) if ps else LOW
                at += len(ps)


def svm(z: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 20) -> np.ndarray:
    """Primal L2 machine with squared hinge loss, by Newton steps; the last coordinate of z is the constant."""
    v = np.zeros(z.shape[1])
    ridge = np.eye(z.shape[1])
    ridge[-1, -1] = 1e-3
    active = np.ones(len(y), bool)
    for _ in range(rounds):
        a, w = z[active], weight[active]
        new = np.linalg.solve(ridge + (a * w[:, None]).T @ a, (a * w[:, None]).T @ y[active])
        now = y * (z @ new) < 1
        v, stop = new, np.array_equal(now, active)
        active = now
        if stop or not active.any():
            break
    return v


def logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30, ridge: float = 0.05) -> np.ndarray:
    x = np.c_[x, np.ones(len(x))]
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        h = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(b))
        b = b + np.linalg.solve(h, x.T @ (y - p) - ridge * b)
    return b


def fit_words(
    bad: list[str], evidence: np.ndarray, hard: list[str], good: list[str], cost: float = COST
) -> tuple[np.ndarray, np.ndarray, float]:
    """Nystroem machine on short words: keys, weights and bias of the collapsed form.

    ``evidence`` weighs the bad words; ``hard`` are good words that earlier rounds took for bad ones. Landmarks are
    the first of the bad, the hardest and evenly spaced other good words.
    """
    hardest = hard[: LANDMARKS // 4]
    rest = LANDMARKS // 2 - len(hardest)
    evenly = good[:: max(1, len(good) // rest)][:rest]
    landmarks = list(dict.fromkeys(bad[: LANDMARKS // 2] + hardest + evenly))
    row, key, weight = triples(landmarks)
    keys, place = np.unique(key, return_inverse=True)
    dense = np.zeros((len(keys), len(landmarks)), np.float32)
    dense[place, row] = weight
    words = bad + list(dict.fromkeys(hard + good))

    def kernel(part: list[str]) -> np.ndarray:
        r, k, w = triples(part)
        at = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
        hit = keys[at] == k
        out = np.zeros((len(part), len(landmarks)))
        r, at, w = r[hit], at[hit], w[hit].astype(np.float32)
        if len(r):
            first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
            out[r[first]] = np.add.reduceat(dense[at] * w[:, None], first)
        return out

    values, vectors = np.linalg.eigh((dense.T @ dense).astype(float))
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-4))) @ vectors.T
    z = np.vstack([kernel(words[i : i + 500]) for i in range(0, len(words), 500)]) @ root
    y = np.r_[np.ones(len(bad)), -np.ones(len(words) - len(bad))]
    v = svm(np.c_[z, np.ones(len(z))], y, cost * np.r_[evidence, np.ones(len(words) - len(bad))])
    return keys, dense @ (root @ v[:-1]), float(v[-1])


def train(docs: DataFrame, labels: DataFrame, max_docs: int = FIT_DOCS, max_words: int = FIT_WORDS) -> Model | None:
    """Fit on at most ``max_docs`` labelled documents that may be learned from, chosen by the hash of their ids.

    NULL labels, ids and texts teach nothing; of several labels of one id the largest counts. None where there is
    no document of both kinds or no word that tells them apart.
    """
    spark = docs.sparkSession
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & learnable(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_docs)
    )
    with Workspace(spark, "toxicity") as work:
        # At most max_docs rows of two numbers: a proven bound for the broadcast.
        chosen = F.broadcast(work.save(known, "known"))
        sample = work.save(docs.select("doc_id", "text").filter("text is not null").join(chosen, "doc_id"), "sample")

        def sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = {
                    (s.strip(), t)
                    for text, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                    for s in _SENTENCE.split(text.lower())
                }
                yield pa.RecordBatch.from_pydict(
                    {"s": pa.array([r[0] for r in rows], pa.string()), "t": pa.array([r[1] for r in rows], pa.int32())}
                )

        said = sample.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(sentences, "s string, t int")
        said = said.groupBy("s").agg(F.min("t").alias("t"))

        def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                counts: tuple[Counter, Counter] = (Counter(), Counter())
                for s, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    tokens = s.split()
                    own = {letters(w) for w in tokens}.union(spaced(tokens))
                    counts[t > 0].update({p for w in own for p in pieces(w)})
                every = list(counts[0].keys() | counts[1].keys())
                yield pa.RecordBatch.from_pydict(
                    {
                        "w": pa.array(every, pa.string()),
                        "bad": pa.array([counts[1][w] for w in every], pa.int64()),
                        "good": pa.array([counts[0][w] for w in every], pa.int64()),
                    }
                )

        counted = said.mapInArrow(words, "w string, bad bigint, good bigint")
        counted = work.save(counted.groupBy("w").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), "counted")
        n = said.groupBy().agg(F.sum((F.col("t") > 0).cast("long")), F.count("*")).first()
        n_bad, n_good = n[0] or 0, (n[1] or 0) - (n[0] or 0)
        if not n_bad or not n_good:
            return None
        odds = (F.col("bad") + 0.1) / n_bad / ((F.col("good") + 0.1) / n_good)
        some = counted.withColumn("odds", odds)
        bad = some.filter("bad >= 3 and odds > 8").orderBy(F.desc("bad"), "w").limit(max_words // 3).collect()
        good = some.filter("odds < 3 and good > 0").select("w", "good")
        usual = good.orderBy(F.desc("good"), "w").limit(max_words // 6)
        rare = good.orderBy(F.xxhash64("w"), "w").limit(max_words // 3)
        good_words = list(dict.fromkeys(r.w for part in (usual, rare) for r in part.select("w").collect()))
        if not bad or not good_words:
            return None
        bad_words = [r.w for r in bad]
        evidence = np.minimum([float(r.bad) for r in bad], 60) / 6
        hard: list[str] = []
        for _ in range(MINING):
            model = Model(*fit_words(bad_words, evidence, hard, good_words), np.zeros(3))
            top = _judged(good.select("w"), model).orderBy(F.desc("value"), "w").limit(max_words // 6)
            hard = list(dict.fromkeys([r.w for r in top.collect()] + hard))
        model = Model(*fit_words(bad_words, evidence, hard, good_words), np.zeros(3))
        told = [
            (r.worst, r.toxic)
            for r in _worst(sample.select("text", F.col("toxic").cast("double").alias("toxic")), model).collect()
        ]
        x = np.array([t[0] for t in told]).reshape(-1, 2)
        model.calibration = logistic(x, (np.array([t[1] for t in told]) > 0).astype(float))
    return model


def _judged(words: DataFrame, model: Model) -> DataFrame:
    """(w, value) of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = model.judge(batch.column(0).to_pylist()) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)], names=["w", "value"])

    return words.mapInArrow(run, "w string, value double")


def _worst(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` but ``text``, with the decision values of the two worst words in ``worst``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(model)
        for batch in small_batches(batches, TEXTS):
            at = batch.schema.get_field_index("text")
            values = judge.worst(batch.column(at).to_pylist())
            rest = [i for i in range(batch.num_columns) if i != at]
            pairs = pa.ListArray.from_arrays(
                pa.array(np.arange(0, 2 * len(values) + 1, 2, dtype=np.int32)), pa.array(values.ravel())
            )
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in rest), pairs], names=[*(batch.schema.names[i] for i in rest), "worst"]
            )

    fields = [f for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType([*fields, T.StructField("worst", T.ArrayType(T.DoubleType()))])
    return docs.mapInArrow(run, schema)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """Every row and column of ``docs`` with ``toxicity`` (0 to 1) of its whole ``text``.

    Texts that are NULL, empty or without a word of three letters get the score of the mildest text. Without a model
    every score is 0. A column ``toxicity`` that is there already is replaced.
    """
    plain = docs.drop("toxicity")
    if model is None:
        return plain.withColumn("toxicity", F.lit(0.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(model)
        for batch in small_batches(batches, TEXTS):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            values = pa.array(model.probability(judge.worst(texts)))
            yield pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, "toxicity"])

    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField("toxicity", T.DoubleType())]))


def drop_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.7) -> DataFrame:
    """``docs`` without the documents that score ``limit`` or more; columns stay as they are."""
    return score(docs, train(docs, labels)).filter(F.col("toxicity") < limit).select(*docs.columns)
