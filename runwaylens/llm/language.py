"""Language identification with one interpolated Kneser-Ney character model per language.

Counts and limits come from all documents that may be learned from: words are counted for each language in the task
that reads them, and character n-grams are counted from the distinct words. All n-grams are kept, in one table for each order: an n-gram with each
language's discounted probability, and a context with each language's back-off weight. Documents are scored in
chunks of bounded size, parts of the partitions that they are read in; the distinct n-grams of a chunk meet their
probabilities in joins, so that neither the driver nor a worker holds the model. A word is scored once in a chunk, a text is the sum of its words, and the language with
the lowest cross-entropy per character wins.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from runwaylens.llm.common import learnable, small_batches
from runwaylens.sources.scratch import Workspace

ORDER = 5
# Steps of a unit of cross-entropy that limits of rejection tell apart.
STEPS = 1024
# Different words of a task whose n-grams are not counted yet, n-grams not given out yet, and words counted together.
MOST_WORDS = 200_000
MOST_GRAMS = 1_000_000
WORDS_AT_ONCE = 20_000
# Bits of a character in the key of an n-gram.
SIGN_BITS = 12
MOST_SIGNS = (1 << SIGN_BITS) - 1
# Bytes of text that are scored with one table of n-grams.
CHUNK_BYTES = 32 << 20
# Rows that are packed together on their way to the chunk's n-grams.
PACKED = 1024
# Longer words are read in pieces of this length.
PIECE = 30
# Texts whose new tokens are scored together.
CHUNK = 200
_EDGE = " "
_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(token: str) -> list[str]:
    """Runs of letters in a token, lower-cased, in pieces of bounded length."""
    token = token.lower()
    runs = [token] if token.isalpha() else _LETTERS.findall(token)
    return [w for r in runs for w in pieces(r)]


def pieces(run: str) -> list[str]:
    """A run of letters in pieces of bounded length."""
    return [run] if len(run) <= PIECE else [run[i : i + PIECE] for i in range(0, len(run), PIECE)]


def grams_of(word: str) -> list[str]:
    """For each character of a word, its end included: the longest n-gram that ends there."""
    padded = f"{_EDGE}{word}{_EDGE}"
    return [padded[max(0, end - ORDER) : end] for end in range(2, len(padded) + 1)]


@dataclass
class Limits:
    """What a decision needs besides cross-entropies; small, so it can go to the workers."""

    languages: list[str]
    accept: np.ndarray
    sharpness: float = 4.0

    def decide(self, entropies: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its score between 0 and 1, and whether its cross-entropy is too high for it."""
        best = entropies.argmin(1)
        gap = (entropies - entropies.min(1, keepdims=True)) * self.sharpness * np.sqrt(np.maximum(chars, 1))[:, None]
        score = 1 / np.exp(-np.minimum(gap, 700)).sum(1)
        return best, score, entropies.min(1) > self.accept[best]


@dataclass
class Prices:
    """Log probabilities of the last character of n-grams: a row of ``logs`` for each, a column per language."""

    languages: list[str]
    keys: Keys
    place: np.ndarray | dict[str, int]
    logs: np.ndarray

    @classmethod
    def of(cls, languages: list[str], table: pa.Table) -> Prices:
        grams = table.column("gram").to_pylist()
        flat = [x.values.to_numpy(zero_copy_only=False)[x.offsets[0].as_py() : x.offsets[-1].as_py()] for x in table.column("p").chunks]
        logs = np.concatenate(flat).astype(float) if flat else np.empty(0)
        logs, keys = logs.reshape(len(grams), len(languages)), Keys("".join(grams))
        if not keys.fits:
            return cls(languages, keys, {g: i for i, g in enumerate(grams)}, logs)
        numbers = keys.of_grams(grams)
        order = np.argsort(numbers)
        return cls(languages, keys, numbers[order], logs[order])

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        if isinstance(self.place, dict):
            at = np.array([self.place[g] for w in words for g in grams_of(w)], np.int64)
        else:
            at = np.searchsorted(self.place, self.keys.of_words(words))
        size = np.array([len(w) + 1 for w in words])
        return np.add.reduceat(self.logs[at], np.cumsum(size) - size, axis=0)


@dataclass
class Model(Limits):
    """part[n]: (gram, part), back[n]: (gram, back): all n-grams of order n, all contexts of order n; lists by language."""

    spark: SparkSession | None = None
    part: dict[int, DataFrame] = field(default_factory=dict)
    back: dict[int, DataFrame] = field(default_factory=dict)
    floor: list[float] = field(default_factory=list)

    def limits(self) -> Limits:
        return Limits(self.languages, self.accept, self.sharpness)

    def log_probabilities(self, words: list[str]) -> np.ndarray:
        """Sum of the log probabilities of the characters of each word, its end included; a column per language."""
        grams = sorted({g for w in words for g in grams_of(w)})
        with Workspace(self.spark, "words") as work:
            wanted = self.spark.createDataFrame(pa.table({"gram": pa.array(grams, pa.string())}))
            prices = Prices.of(self.languages, _priced(wanted, self, work).toArrow())
        return prices.log_probabilities(words)


class Reader:
    """Cross-entropies of texts, with the values of tokens met before kept in bounded memory."""

    def __init__(self, model: Model | Prices, most: int = 400_000) -> None:
        self.model, self.most = model, most
        self._empty()

    def _empty(self) -> None:
        self.rows: dict[str, int] = {}
        self.values = np.zeros((1024, len(self.model.languages) + 1))

    def read(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character in each language, and the number of characters (0: no letter)."""
        sums = np.zeros((len(texts), self.values.shape[1]))
        for start in range(0, len(texts), CHUNK):
            docs = [[] if t is None else _LETTERS.findall(t.lower()) for t in texts[start : start + CHUNK]]
            if len(self.rows) > self.most:
                self._empty()
            self._learn(list(set().union(*docs).difference(self.rows.keys())))
            for i, tokens in enumerate(docs, start):
                rows = np.fromiter(map(self.rows.__getitem__, tokens), np.int64, len(tokens))
                sums[i] = np.ones(len(rows)) @ self.values.take(rows, 0)
        chars = sums[:, -1]
        return -sums[:, :-1] / np.maximum(chars, 1)[:, None], chars

    def _learn(self, tokens: list[str]) -> None:
        at = len(self.rows)
        if at + len(tokens) > len(self.values):
            grown = np.zeros((2 * (at + len(tokens)), self.values.shape[1]))
            grown[:at] = self.values[:at]
            self.values = grown
        for start in range(0, len(tokens), 4000):
            part = tokens[start : start + 4000]
            cut = [pieces(t) for t in part]
            flat = [w for ws in cut for w in ws]
            owner = np.repeat(np.arange(len(part)), [len(ws) for ws in cut])
            sums = np.zeros((len(part), self.values.shape[1]))
            if flat:
                np.add.at(sums[:, :-1], owner, self.model.log_probabilities(flat))
                np.add.at(sums[:, -1], owner, np.array([len(w) + 1.0 for w in flat]))
            self.rows.update(zip(part, range(at, at + len(part))))
            self.values[at : at + len(part)] = sums
            at += len(part)


class Keys:
    """Exact 60-bit numbers of n-grams over at most ``MOST_SIGNS`` different characters."""

    def __init__(self, signs: str) -> None:
        self.signs = np.unique(_codes(signs))
        self.fits = len(self.signs) <= MOST_SIGNS
        self.number = np.zeros(0x110000, np.int64)
        self.number[self.signs] = np.arange(1, len(self.signs) + 1)

    def _ending(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each character: the key of the longest n-gram of its text that ends there, and its place; lengths."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        number = self.number[_codes("".join(texts))]
        keys = number.copy()
        for back in range(1, ORDER):
            keys[back:] += np.where(place[back:] >= back, number[:-back], 0) << (SIGN_BITS * back)
        return keys, place, lengths

    def of_words(self, words: list[str]) -> np.ndarray:
        """What ``grams_of`` lists, word by word."""
        keys, place, _ = self._ending([f"{_EDGE}{w}{_EDGE}" for w in words])
        return keys[place > 0]

    def of_grams(self, grams: list[str]) -> np.ndarray:
        keys, _, lengths = self._ending(grams)
        return keys[np.cumsum(lengths) - 1]

    def grams(self, keys: np.ndarray) -> list[str]:
        codes = np.zeros((len(keys), ORDER), np.uint32)
        length = np.ones(len(keys), np.int64)
        for back in range(1, ORDER):
            length[keys >> (SIGN_BITS * back) > 0] = back + 1
        for n in range(1, ORDER + 1):
            own = length == n
            for at in range(n):
                number = (keys[own] >> (SIGN_BITS * (n - 1 - at))) & MOST_SIGNS
                codes[own, at] = self.signs[number - 1]
        return codes.view(f"<U{ORDER}").ravel().tolist()


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_counts(words: list[str], kinds: np.ndarray, counts: np.ndarray, n_kinds: int) -> tuple[list[str], np.ndarray]:
    """The distinct n-grams of words, and how often each occurs in words of each kind, of which each counts ``counts`` times."""
    keys = Keys(_EDGE + "".join(words))
    if not keys.fits:
        found: dict[str, np.ndarray] = {}
        for word, kind, c in zip(words, kinds, counts):
            for gram in grams_of(word):
                found.setdefault(gram, np.zeros(n_kinds, np.int64))[kind] += c
        return list(found), np.array(list(found.values()), np.int64).reshape(len(found), n_kinds)
    parts, tables = [np.empty(0, np.int64)], [np.empty((0, n_kinds), np.int64)]
    for start in range(0, len(words), WORDS_AT_ONCE):
        part = slice(start, start + WORDS_AT_ONCE)
        distinct, where = np.unique(keys.of_words(words[part]), return_inverse=True)
        times = np.fromiter(map(len, words[part]), np.int64) + 1
        cell = where * n_kinds + np.repeat(kinds[part], times)
        total = np.bincount(cell, np.repeat(counts[part], times), len(distinct) * n_kinds)
        parts.append(distinct)
        tables.append(total.astype(np.int64).reshape(len(distinct), n_kinds))
    distinct, where = np.unique(np.concatenate(parts), return_inverse=True)
    out = np.zeros((len(distinct), n_kinds), np.int64)
    np.add.at(out, where, np.concatenate(tables))
    return keys.grams(distinct), out


def _dealt(docs: DataFrame) -> DataFrame:
    """Rows with ``__chunk``: an input partition, or a part of it by the hash of the text."""
    sizes = docs.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.octet_length("text")).alias("bytes"))
    parts = max(1, -(-(sizes.agg(F.max("bytes")).first()[0] or 0) // CHUNK_BYTES))
    part = F.pmod(F.xxhash64("text"), F.lit(parts)) if parts > 1 else F.lit(0)
    return docs.select("*", (F.spark_partition_id().cast("long") * parts + part).alias("__chunk"))


def _listed(dealt: DataFrame, teaches: Column) -> DataFrame:
    """(chunk, gram, told): the n-grams of each chunk, with their counts in texts of each language that ``teaches`` names.

    Texts without such a language are listed without counts. An n-gram of a chunk with very many words may have
    several rows, whose counts add up.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[int, dict[str | None, Counter]] = {}
        grams: dict[int, dict[str, Counter]] = {}

        def cut() -> None:
            """N-grams of the words met so far."""
            for chunk, own in words.items():
                kinds = {lang: i for i, lang in enumerate(own)}
                flat = [w for tokens in own.values() for t in tokens for w in pieces(t)]
                times = [c for tokens in own.values() for t, c in tokens.items() for _ in pieces(t)]
                kind = [kinds[lang] for lang, tokens in own.items() for t in tokens for _ in pieces(t)]
                found, table = gram_counts(flat, np.array(kind, np.int64), np.array(times, np.int64), len(kinds))
                sums = grams.setdefault(chunk, {})
                for lang, i in kinds.items():
                    at = np.flatnonzero(table[:, i])
                    sums.setdefault(lang, Counter()).update(dict(zip([found[k] for k in at], table[at, i].tolist())))
            words.clear()

        def out() -> Iterator[pa.RecordBatch]:
            for chunk, sums in grams.items():
                names = [lang for lang in sums if lang is not None]
                listed = list(set().union(*sums.values()))
                table = np.array([[sums[lang][g] for g in listed] for lang in names], np.int64).reshape(len(names), len(listed)).T
                gram_at, lang_at = np.nonzero(table)
                offsets = np.searchsorted(gram_at, np.arange(len(listed) + 1)).astype(np.int32)
                langs = pa.array(names, pa.string()).take(pa.array(lang_at))
                entries = pa.StructArray.from_arrays([langs, pa.array(table[gram_at, lang_at])], names=["lang", "c"])
                told = pa.ListArray.from_arrays(pa.array(offsets), entries)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * len(listed), pa.int64()), pa.array(listed, pa.string()), told], names=["__chunk", "gram", "told"]
                )
            grams.clear()

        met = 0
        for batch in batches:
            for chunk, lang, text in zip(*(batch.column(i) for i in range(3))):
                own = words.setdefault(chunk.as_py(), {}).setdefault(lang.as_py(), Counter())
                before = len(own)
                own.update(_LETTERS.findall((text.as_py() or "").lower()))
                met += len(own) - before
                if met > MOST_WORDS:
                    cut()
                    met = 0
                    if sum(len(c) for sums in grams.values() for c in sums.values()) > MOST_GRAMS:
                        yield from out()
        cut()
        yield from out()

    schema = "__chunk bigint, gram string, told array<struct<lang: string, c: bigint>>"
    return dealt.select("__chunk", teaches.alias("lang"), "text").mapInArrow(run, schema)


def train(docs: DataFrame, fixed_order: bool = False) -> Model | None:
    """Models of every language that some learnable document with a letter names; None without any.

    All learnable documents are counted, and the model keeps every n-gram; its tables lie in the shared folder. All of
    them are scored for the limits of rejection too. Documents without language, text or id teach nothing. ``docs`` is
    written to the shared folder first, unless ``fixed_order`` says that every scan gives the same partitions.
    """
    usable = docs.filter(_teaches("doc_id", "lang").isNotNull()).select("lang", "text")
    with Workspace(docs.sparkSession, "language") as work:
        dealt = _dealt(usable if fixed_order else work.save(usable, "texts"))
        listed = work.save(_listed(dealt, F.col("lang")), "listed")
        model = _counted(listed, work)
        if model is not None:
            model.accept = _accepted(_told(dealt, listed, model, work).select("lang", "entropy", "chars"), model.languages)
    return model


def _teaches(doc_id: str, lang: str) -> Column:
    """The language that a document teaches, or NULL."""
    return F.when(F.col("text").isNotNull() & learnable(F.col(doc_id)), F.col(lang))


def _counted(listed: DataFrame, work: Workspace) -> Model | None:
    """The model of all counts, without limits of rejection yet."""
    spark = listed.sparkSession
    grams = listed.select("gram", F.explode("told").alias("o")).groupBy("o.lang", "gram").agg(F.sum("o.c").alias("c"))
    level = work.save(grams, "grams")
    # From the highest order down: n-grams that end in the same shorter one each count once there.
    orders: dict[int, DataFrame] = {}
    rates: dict[int, dict[str, float]] = {}
    # Grams at a word's start are shorter than ORDER and keep their counts at their own order.
    for n in range(ORDER, 0, -1):
        here = level.filter(F.length("gram") == n)
        if n < ORDER:
            longer = orders[n + 1].groupBy("lang", F.expr(f"substr(gram, 2, {n})").alias("gram")).agg(
                F.count("*").cast("long").alias("c")
            )
            here = here.unionByName(longer).groupBy("lang", "gram").agg(F.sum("c").alias("c"))
        orders[n] = work.save(here, f"order{n}")
        ones = orders[n].groupBy("lang").agg(
            F.sum((F.col("c") == 1).cast("long")).alias("n1"), F.sum((F.col("c") == 2).cast("long")).alias("n2")
        )
        rates[n] = {r.lang: _discount(r.n1, r.n2) for r in ones.collect()}
    work.drop("grams")
    languages = sorted(rates[1])
    if not languages:
        return None
    model = Model(languages, np.full(len(languages), np.inf), spark=spark)
    for n, above in orders.items():
        rate = F.lit(0.5)
        for lang, value in rates[n].items():
            rate = F.when(F.col("lang") == lang, value).otherwise(rate)
        cut = F.expr(f"substr(gram, 1, {n - 1})").alias("context")
        context = above.groupBy("lang", cut).agg(F.sum("c").alias("total"), F.count("*").alias("kinds"))
        context = work.save(context, f"context{n}")
        share = rate * F.col("kinds") / F.col("total")
        if n == 1:
            signs = max(256, above.select("gram").distinct().count())
            first = {r.lang: r.share for r in context.select("lang", share.alias("share")).collect()}
            model.floor = [max(first[lang], 1e-3) / signs for lang in languages]
        placed = above.select("*", cut).join(context, ["lang", "context"])
        own = F.greatest(F.col("c") - rate, F.lit(0.0)) / F.col("total")
        parts = _by_language(placed.select("lang", "gram", own.alias("value")), languages, "part")
        backs = _by_language(context.select("lang", F.col("context").alias("gram"), share.alias("value")), languages, "back", 1.0)
        model.part[n], model.back[n] = work.save(parts, f"part{n}"), work.save(backs, f"back{n}")
        work.keep(f"part{n}")
        work.keep(f"back{n}")
        work.drop(f"order{n}", f"context{n}")
    return model


def _accepted(told: DataFrame, languages: list[str]) -> np.ndarray:
    """For each language the highest cross-entropy that is not rejected, from all its documents in ``told``.

    Cross-entropies are counted in steps of 1 / STEPS, so that a few rows of counts reach the driver, however many
    documents there are; medians are exact to that step.
    """
    names = F.array(*[F.lit(lang) for lang in languages])
    own = F.try_element_at("entropy", F.array_position(names, F.col("lang")).cast("int"))
    steps = told.filter("chars > 0").select("lang", F.round(own * STEPS).cast("long").alias("step"))
    counts = steps.filter("step is not null").groupBy("lang", "step").agg(F.count("*").alias("c")).toPandas()
    accept = np.full(len(languages), np.inf)
    for i, lang in enumerate(languages):
        mine = counts[counts.lang == lang]
        values, c = mine.step.to_numpy() / STEPS, mine.c.to_numpy()
        if c.sum() > 20:
            middle = _median(values, c)
            accept[i] = middle + 8 * _median(np.abs(values - middle), c) + 0.5
    return accept


def _median(values: np.ndarray, counts: np.ndarray) -> float:
    order = np.argsort(values)
    upto, total = np.cumsum(counts[order]), counts.sum()
    low, high = np.searchsorted(upto, [(total - 1) // 2, total // 2], side="right")
    return float(values[order][low] + values[order][high]) / 2


def _discount(n1: int, n2: int) -> float:
    return n1 / (n1 + 2 * n2) if n1 else 0.5


def _by_language(values: DataFrame, languages: list[str], name: str, missing: float = 0.0) -> DataFrame:
    """(gram, name): a list with the value of each language, from (lang, gram, value)."""
    told = values.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "value"))).alias("told"))
    names = F.array(*[F.lit(lang) for lang in languages])
    return told.select("gram", F.transform(names, lambda lang: F.coalesce(F.element_at("told", lang), F.lit(missing))).alias(name))


def _priced(wanted: DataFrame, model: Model, work: Workspace) -> DataFrame:
    """(gram, p) with the log probability, in each language, of the last character of every n-gram in ``wanted``."""
    ends = F.transform(F.sequence(F.lit(1), F.length("gram")), lambda n: F.col("gram").substr(F.length("gram") - n + 1, n))
    ends = work.save(wanted.distinct().select(F.explode(ends).alias("gram")).distinct(), "ends")
    each = lambda value: F.array(*[F.lit(value)] * len(model.languages))
    floor = F.array(*[F.lit(x) for x in model.floor])
    below: list[DataFrame] = []
    for n in range(1, ORDER + 1):
        here = ends.filter(F.length("gram") == n).join(model.part[n], "gram", "left")
        part = F.coalesce("part", each(0.0))
        if n == 1:
            rest: Column = floor
        else:
            here = here.withColumns({"__context": F.expr(f"substr(gram, 1, {n - 1})"), "__end": F.expr("substr(gram, 2)")})
            here = here.join(model.back[n].withColumnRenamed("gram", "__context"), "__context", "left")
            here = here.join(below[-1].select(F.col("gram").alias("__end"), F.col("p").alias("lower")), "__end")
            rest = F.zip_with(F.coalesce("back", each(1.0)), "lower", lambda b, p: b * p)
        below.append(work.save(here.select("gram", F.zip_with(part, rest, lambda a, b: a + b).alias("p")), f"p{n}"))
    out = below[1]
    for more in below[2:]:
        out = out.unionByName(more)
    # In single precision, as every chunk gets its own copies; the sums are of double precision.
    return out.select("gram", F.transform("p", lambda x: F.log(x).cast("float")).alias("p"))


def _packed(dealt: DataFrame) -> DataFrame:
    """(chunk, pack): the other columns of ``dealt``, some rows of one chunk at a time, as compressed Arrow streams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in small_batches(batches, PACKED):
            at = batch.schema.get_field_index("__chunk")
            chunks = batch.column(at)
            kept = pa.Table.from_batches([batch]).remove_column(at)
            for chunk in chunks.unique():
                own = kept.filter(pc.equal(chunks, chunk))
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, own.schema, options=options) as stream:
                    stream.write_table(own)
                packs = pa.array([sink.getvalue().to_pybytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([chunk.as_py()], pa.int64()), packs], names=["__chunk", "pack"])

    return dealt.mapInArrow(run, "__chunk bigint, pack binary")


def _told(dealt: DataFrame, listed: DataFrame, model: Model, work: Workspace, columns: list[str] | None = None) -> DataFrame:
    """The ``columns`` (default: all) of every row, ``entropy`` (one value per language) and ``chars`` of its whole text.

    The n-grams that a chunk needs are listed where the texts are read, so only one pass moves texts, and these are
    packed. Equal rows of several partitions are in several chunks. ``dealt`` must give the same rows in the same partitions each time.
    """
    columns = [c for c in dealt.columns if c != "__chunk"] if columns is None else columns
    languages = model.languages

    def summed(packs: pa.Table, prices: pa.Table) -> pa.Table:
        reader = Reader(Prices.of(languages, prices))
        parts = []
        for pack in packs.column("pack"):
            texts = pa.ipc.open_stream(pack.as_buffer()).read_all()
            values, chars = reader.read(texts.column("text").to_pylist())
            rows = pa.array(list(values), pa.list_(pa.float64()))
            parts.append(texts.select(columns).append_column("entropy", rows).append_column("chars", pa.array(chars)))
        return pa.concat_tables(parts)  # every chunk has texts

    priced = listed.join(_priced(listed.select("gram"), model, work), "gram").select("__chunk", "gram", "p")
    more = [T.StructField("entropy", T.ArrayType(T.DoubleType())), T.StructField("chars", T.DoubleType())]
    schema = T.StructType([*[dealt.schema[c] for c in columns], *more])
    needed = dealt.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*columns, "text", "__chunk"])])
    return _packed(needed).groupBy("__chunk").cogroup(priced.groupBy("__chunk")).applyInArrow(summed, schema)


def entropies(docs: DataFrame, model: Model, fixed_order: bool = False) -> DataFrame:
    """Every row and column of ``docs`` with ``entropy`` (one value per language) and ``chars`` of its whole text.

    ``docs`` is written to the shared folder first, unless ``fixed_order`` says that it yields the same partitions on
    every scan (files read directly).
    """
    work = Workspace(docs.sparkSession, "entropies")
    plain = docs.drop("entropy", "chars")
    dealt = _dealt(plain if fixed_order else work.save(plain, "texts"))
    listed = work.save(_listed(dealt, F.lit(None).cast("string")), "listed")
    told = _told(dealt, listed, model, work)
    work.drop("ends", "p1")
    return told


def train_and_identify(docs: DataFrame, columns: list[str], fixed_order: bool = False) -> DataFrame:
    """``identify`` with a model of the documents themselves: each text is listed once and scored once.

    ``docs`` has ``doc_id``, ``text`` and ``lang``; of its columns the result has ``columns``.
    """
    own = {c: f"__own{i}" for i, c in enumerate(columns)}
    plain = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()], "text", _teaches("doc_id", "lang").alias("lang"))
    names = {n: c for c, n in own.items()}
    with Workspace(docs.sparkSession, "language") as work:
        dealt = _dealt(plain if fixed_order else work.save(plain, "texts"))
        listed = work.save(_listed(dealt, F.col("lang")), "listed")
        model = _counted(listed, work)
        if model is None:
            return identify(docs.select(*[F.col(f"`{c}`") for c in columns]), None)
        told = work.save(_told(dealt, listed, model, work, [*names, "lang"]), "told")
        work.keep("told")
        model.accept = _accepted(told, model.languages)
    for n in model.part:
        work.drop(f"part{n}", f"back{n}")
    return _decided(told.drop("lang"), model.limits()).withColumnsRenamed(names)


def identify(docs: DataFrame, model: Model | None, fixed_order: bool = False) -> DataFrame:
    """Every row and column of ``docs`` with ``lang_pred``, ``lang_score`` (0 to 1) and ``lang_rejected``.

    NULL texts and texts without a letter are ``und`` with score 0, and so is every text without a model. A text
    whose cross-entropy is above what documents of its language have is marked as rejected, but keeps the best
    language. Columns of these names that are there already are replaced.
    """
    plain = docs.drop("lang_pred", "lang_score", "lang_rejected")
    if model is None:
        return plain.withColumns(
            {"lang_pred": F.lit("und"), "lang_score": F.lit(0.0), "lang_rejected": F.lit(True)}
        )

    # Columns of the input may have any name but these two.
    told = entropies(plain.withColumnsRenamed({"entropy": "__entropy", "chars": "__chars"}), model, fixed_order)
    return _decided(told, model.limits()).withColumnsRenamed({"__entropy": "entropy", "__chars": "chars"})


def _decided(told: DataFrame, limits: Limits) -> DataFrame:
    """Rows with the language, its score and the rejection in place of ``entropy`` and ``chars``, the last columns."""
    kept = told.drop("entropy", "chars")
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, values, chars = batch.columns
            chars = chars.to_numpy()
            flat = np.array(values.to_pylist(), float).reshape(len(chars), len(limits.languages))
            best, score, rejected = limits.decide(flat, chars)
            more = {
                "lang_pred": pa.array([limits.languages[b] if c else "und" for b, c in zip(best, chars)], pa.string()),
                "lang_score": pa.array(np.where(chars > 0, score, 0.0)),
                "lang_rejected": pa.array(rejected | (chars == 0)),
            }
            yield pa.RecordBatch.from_arrays([*columns, *more.values()], names=[*names, *more])

    more = [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("lang_score", T.DoubleType()),
        T.StructField("lang_rejected", T.BooleanType()),
    ]
    return told.mapInArrow(run, T.StructType([*kept.schema.fields, *more]))
