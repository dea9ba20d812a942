"""Benchmark decontamination with a generalised suffix automaton over the words of all test items.

The automaton reads the words of a document one after the other and knows, at every word, the longest
suffix of the words so far that occurs in some item. A match of at least ``window`` words means that
windows of an item occur there; an item of fewer words counts when it is matched as a whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runwaylens.llm.common import small_batches

# ASCII letters are lower-cased; every other ASCII sign than a letter or digit parts words.
_MAP = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
# Words of test items that one automaton may hold; more items are scanned in several blocks.
BLOCK_WORDS = 200_000
WINDOW = 10


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and all other signs beyond ASCII, with A-Z lower-cased."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(_MAP).split()


class SuffixAutomaton:
    """Generalised suffix automaton of word sequences, with the items that hold each window.

    States are numbers; ``step[s]`` maps a word id to the next state, ``link[s]`` is the state of the longest
    suffix that occurs in more places, ``length[s]`` the longest word sequence of the state.
    """

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = [(item, [self.ids.setdefault(w, len(self.ids)) for w in ws]) for item, ws in items if ws]
        for _, seq in sequences:
            last = 0
            for w in seq:
                last = self._extend(last, w)
        # Items by state: for windows, at the state that holds the last `window` words; for short items, at
        # the state of the whole item.
        self.windows: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        for item, seq in sequences:
            state = 0
            for i, w in enumerate(seq, 1):
                state = self.step[state][w]
                if i >= window:
                    self.windows.setdefault(self._at(state, window), set()).add(item)
            if len(seq) < window:
                self.short.setdefault(state, {}).setdefault(len(seq), set()).add(item)
        # Every short item that is a suffix of a state's words, seen along its suffix links.
        self.short_below: list[tuple[tuple[int, frozenset[str]], ...]] = [()] * len(self.link)
        if self.short:
            for s in sorted(range(len(self.link)), key=self.length.__getitem__):
                own = tuple((n, frozenset(names)) for n, names in self.short.get(s, {}).items())
                above = self.short_below[self.link[s]] if self.link[s] >= 0 else ()
                self.short_below[s] = own + above

    def _extend(self, last: int, w: int) -> int:
        step, link, length = self.step, self.link, self.length
        if w in step[last]:
            q = step[last][w]
            return q if length[q] == length[last] + 1 else self._clone(last, w, q)
        new = len(link)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and w not in step[p]:
            step[p][w] = new
            p = link[p]
        if p >= 0:
            q = step[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, w, q)
        return new

    def _clone(self, p: int, w: int, q: int) -> int:
        copy = len(self.link)
        self.step.append(dict(self.step[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = copy
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = copy
            p = self.link[p]
        return copy

    def _at(self, state: int, n: int) -> int:
        """The state that holds the last ``n`` words of a state that holds at least as many."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str], int]:
        """Hit spans [from, to) of word positions, the items found, and the longest match in words."""
        step, link, length, window, below = self.step, self.link, self.length, self.window, self.short_below
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        state = matched = longest = 0
        get = self.ids.get
        for i, word in enumerate(words):
            w = get(word)
            if w is None:
                state = matched = 0
                continue
            while state and w not in step[state]:
                state = link[state]
                matched = length[state]
            nxt = step[state].get(w)
            if nxt is None:
                state = matched = 0
                continue
            state, matched = nxt, matched + 1
            if matched > longest:
                longest = matched
            if matched >= window:
                found |= self.windows[self._at(state, window)]
                _cover(spans, i + 1 - matched, i + 1)
            if below[state]:
                for n, names in below[state]:
                    if n <= matched:
                        found |= names
                        _cover(spans, i + 1 - n, i + 1)
        return spans, found, longest


def _cover(spans: list[tuple[int, int]], start: int, end: int) -> None:
    """Add a span that ends last; joins those that it touches or overlaps."""
    while spans and spans[-1][1] >= start:
        start = min(start, spans.pop()[0])
    spans.append((start, end))


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and out[-1][1] >= start:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the spans; a line break stands in each gap."""
    raw = text.encode("utf-8", "surrogatepass")
    plain = raw.translate(_MAP)
    bounds, at = [], 0
    for word in plain.split():
        at = plain.index(word, at)
        bounds.append((at, at + len(word)))
        at += len(word)
    parts, at = [], 0
    for start, end in spans:
        parts.append(raw[at : bounds[start][0]])
        at = bounds[end - 1][1]
    parts.append(raw[at:])
    return b"\n".join(parts).decode("utf-8", "surrogatepass")


_LOADED: dict[str, SuffixAutomaton] = {}


def _automaton(block) -> SuffixAutomaton:
    """One automaton for each block and worker process; only the newest few stay in memory."""
    key, items, window = block.value
    if key not in _LOADED:
        if len(_LOADED) >= 4:
            _LOADED.clear()
        _LOADED[key] = SuffixAutomaton(((i, words_of(t)) for i, t in items), window)
    return _LOADED[key]


def item_blocks(benchmark: DataFrame, window: int, block_words: int) -> Iterator:
    """Broadcasts of test items, each of about ``block_words`` words, read one block at a time."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").filter(
        F.col("item_id").isNotNull() & F.col("text").isNotNull()
    )
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (block_words * 5)))
    for k in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        rows = [tuple(r) for r in part.collect()]
        yield spark.sparkContext.broadcast((uuid.uuid4().hex, rows, window))


def scan(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, name: str = "hits"
) -> DataFrame:
    """Every row and column of ``docs``, with what the automaton finds in its whole text, in the struct ``hits`` (or ``name``):
    n_words, spans (word positions [from, to) inside any window of an item), items (ids, sorted as text) and
    longest (words of the longest match with any item).

    An item with fewer words than ``window``, but not none, is one window. NULL or empty text: no words, no hits.
    Items without id or text are left out; items that repeat an id share it. Other columns pass through untouched,
    whatever their names; ``hits`` itself is replaced. The items are read in blocks of bounded size, each block
    passing over all rows, so neither driver nor worker ever holds more than one block's automaton at once per pass.
    """
    plain = docs.drop(name)
    hit_type = "struct<n_words:bigint,spans:array<struct<a:bigint,b:bigint>>,items:array<string>,longest:bigint>"
    out = plain.select("*", F.lit(None).cast(hit_type).alias(name))
    for block in item_blocks(benchmark, window, block_words):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(block)
            for batch in small_batches(batches):
                hits = []
                at, last = batch.schema.get_field_index("text"), batch.num_columns - 1
                for text, old in zip(batch.column(at).to_pylist(), batch.column(last).to_pylist()):
                    words = words_of(text)
                    spans, found, longest = automaton.scan(words)
                    if old:
                        spans = merged([*spans, *((s["a"], s["b"]) for s in old["spans"])])
                        found |= set(old["items"])
                        longest = max(longest, old["longest"])
                    hits.append(
                        {
                            "n_words": len(words),
                            "spans": [{"a": a, "b": b} for a, b in spans],
                            "items": sorted(found),
                            "longest": longest,
                        }
                    )
                columns = [*batch.columns[:-1], pa.array(hits, batch.schema.field(last).type)]
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

        out = out.mapInArrow(run, out.schema)
    return out


def n_hit(name: str = "hits") -> Column:
    return F.aggregate(f"{name}.spans", F.lit(0).cast("long"), lambda n, s: n + s.b - s.a)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    max_coverage: float = 0.5,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` without test items: hit spans are cut from the text, and a document of whose words more than
    ``max_coverage`` are hit goes as a whole. Columns stay as they are (``n_chars``, if there, is counted anew).

    What a cut brings together may make a new window; such texts are cut again until none is left. Documents without
    a hit keep their text byte for byte. NULL and empty texts stay.
    """
    columns = docs.columns
    spans_type = "array<struct<a:bigint,b:bigint>>"
    found = scan(docs, benchmark, window, block_words, "__hits")
    kept = found.filter(n_hit("__hits") <= F.col("__hits.n_words") * max_coverage)
    blocks = list(item_blocks(benchmark, window, block_words))
    slim = kept.select(*columns, F.col("__hits.spans").cast(spans_type).alias("__spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            for i, spans in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                spans = [(s["a"], s["b"]) for s in spans]
                while spans:
                    texts[i] = cut(texts[i], spans)
                    words = words_of(texts[i])
                    spans = merged(s for block in blocks for s in _automaton(block).scan(words)[0])
            arrays = batch.columns[:-1]
            arrays[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names[:-1])

    out = slim.mapInArrow(run, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in columns else out
