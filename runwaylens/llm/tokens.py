"""Token counts of a unigram tokenizer, without making the tokens.

A text is cut where the tokenizer cuts it (before every word mark), and each distinct piece of text is counted once:
an Aho-Corasick machine lists all vocabulary entries in it, and a dynamic programme over its positions carries the
best score and the number of tokens of the best path.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
# What an unknown sign costs below the worst entry.
UNKNOWN_PENALTY = 10.0


def read_pieces(model_file: str) -> list[tuple[str, float]]:
    """(piece, score) of a vocabulary file, without control and byte entries.

    Files of unigram vocabularies hold scores; others rank their entries, and rank r then scores -ln(r + 1), the
    law of word frequencies, rounded to 1/1024. Sums of such scores are exact in double precision, so ties are too.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    plain = [
        (model.id_to_piece(i), model.get_score(i))
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    ranked = all(s == round(s) for _, s in plain)
    if not ranked:
        return plain
    order = sorted(range(len(plain)), key=lambda i: -plain[i][1])
    scores = {i: -round(math.log(r + 1) * 1024) / 1024 for r, i in enumerate(order, 1)}
    return [(p, scores[i]) for i, (p, _) in enumerate(plain)]


class UnigramCounter:
    """Counts the tokens of texts.

    Ties are those of the public tokenizer library: paths are extended from left to right, from every start by ever
    longer entries, and a path that is only as good as one found before does not replace it. A sign that no entry of
    one sign covers is unknown; unknown signs in a row are one token, or as many as their UTF-8 bytes with
    ``byte_fallback``. White space other than the blank is no separator: it is counted as the vocabulary has it.
    """

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool = True, most: int = 250_000) -> None:
        self.machine = ahocorasick.Automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        for p, s in pieces:
            self.machine.add_word(p, (len(p), s))
        self.machine.make_automaton()
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.byte_fallback, self.most = byte_fallback, most
        self.known: dict[str, int] = {}

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        text = text.replace(" ", MARK)
        parts = text.split(MARK)
        # The first word gets a mark in front unless it has one.
        if text.startswith(MARK):
            parts = parts[1:]
        known = self.known
        if len(known) > self.most:
            known.clear()
        try:
            return sum(map(known.__getitem__, parts))
        except KeyError:
            for p in set(parts):
                if p not in known:
                    known[p] = self._path(MARK + p)
            return sum(map(known.__getitem__, parts))

    def _path(self, s: str) -> int:
        n = len(s)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, (length, value) in self.machine.iter(s):
            ends[end - length + 1].append((end + 1, value))
        best = [0.0] + [-math.inf] * n
        # Tokens of the best path, and whether its last token is unknown.
        tokens, unknown = [0] * (n + 1), [False] * (n + 1)
        single = self.single
        for at in range(n):
            here, count = best[at], tokens[at]
            for end, value in sorted(ends[at]):
                if here + value > best[end]:
                    best[end], tokens[end], unknown[end] = here + value, count + 1, False
            if s[at] not in single and here + self.unknown > best[at + 1]:
                best[at + 1] = here + self.unknown
                if self.byte_fallback:
                    tokens[at + 1] = count + len(s[at].encode("utf-8", "surrogatepass"))
                else:
                    tokens[at + 1] = count + (not unknown[at])
                unknown[at + 1] = True
        return tokens[n]


_COUNTERS: dict[tuple, UnigramCounter] = {}


def with_token_counts(docs: DataFrame, model_file: str, byte_fallback: bool = True) -> DataFrame:
    """Every row and column of ``docs`` with ``n_tokens``: the tokens of its whole ``text``, without special tokens.

    NULL and empty texts have 0 tokens. A column ``n_tokens`` that is there already is replaced. The vocabulary file
    is read once on the driver and its entries travel with the job, so executors need no copy of it.
    """
    plain = docs.drop("n_tokens")
    pieces = plain.sparkSession.sparkContext.broadcast(read_pieces(model_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (model_file, byte_fallback)
        if key not in _COUNTERS:
            _COUNTERS[key] = UnigramCounter(pieces.value, byte_fallback)
        counter = _COUNTERS[key]
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            counts = pa.array(np.fromiter(map(counter.count, texts), np.int64, len(texts)))
            yield pa.RecordBatch.from_arrays([*batch.columns, counts], names=[*batch.schema.names, "n_tokens"])

    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField("n_tokens", T.LongType())]))


def token_totals(counted: DataFrame, *by: str) -> DataFrame:
    """Documents and tokens of each group."""
    return counted.groupBy(*by).agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
