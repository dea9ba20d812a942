"""Byte pair encoding by a tokenization automaton, and decoding by its arc labels.

The automaton reads token sequences and accepts exactly those that the merges produce. It starts as one state with an
arc for every byte. Each merge (a, b) -> c, in order, is one gadget: the state that a leads to is copied for a alone,
the copy loses its arc b, and wherever a can be read, a new arc c leads where b led. Since every arc of one label
leads to the same state, a state is stored by what its gadget changed: the state it copies, when, and the arcs lost.

Every prefix of an encoded word is encoded, so a word has one path through the automaton, and each position one
state. Words are walked by table look-ups, the longest label first; positions without a way on are visited once.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Letters and numbers that Unicode 16 added, as (first, last); others are known to Python itself.
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]
# White space as the pre-split pattern means it, without the four separators U+001C to U+001F.
SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Longer texts are pre-split in parts of about this many characters.
PART_CHARS = 1 << 20
# Words kept by a Python worker in each of two generations, and automaton steps.
KEPT_WORDS = 300_000
KEPT_STEPS = 500_000


@dataclass(frozen=True)
class Vocabulary:
    """Labels by id, merges as (left id, right id, merged id) in order, ids of single bytes, special strings."""

    labels: list[bytes]
    merges: list[tuple[int, int, int]]
    bytes_to_id: list[int]
    special: dict[str, int]


def byte_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in vocabulary files of byte-level models."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def read_vocabulary(file: str) -> Vocabulary:
    """A byte-level BPE of a tokenizer file; kinds of files that encode in another way are refused."""
    with open(file, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    changes = ["dropout", "ignore_merges", "fuse_unk", "byte_fallback", "continuing_subword_prefix", "end_of_word_suffix"]
    odd = [c for c in changes if model.get(c)] + [c for c in ["normalizer"] if spec.get(c)]
    if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or odd:
        raise ValueError(f"{file} is not a plain byte-level BPE {odd}")
    if not pre.get("use_regex", True) or any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in spec["added_tokens"]):
        raise ValueError(f"{file} splits texts in another way")
    signs, ids = byte_signs(), model["vocab"]

    def label(text: str) -> bytes:
        return bytes(signs[c] for c in text) if all(c in signs for c in text) else text.encode()

    special = {a["content"]: a["id"] for a in spec["added_tokens"]}
    labels = [b""] * (max([*ids.values(), *special.values()]) + 1)
    for text, i in [*ids.items(), *special.items()]:
        labels[i] = label(text)
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merges = [(ids[a], ids[b], ids[a + b]) for a, b in pairs]
    by_byte = [0] * 256
    for sign, b in signs.items():
        by_byte[b] = ids[sign]
    return Vocabulary(labels, merges, by_byte, special)


class MergeAutomaton:
    """A deterministic automaton over labels, built merge by merge.

    State s copied state ``origin[s]`` just before merge ``born[s]``; ``lost[s, label]`` is the merge that took an arc.
    A merged label has an arc wherever its left half had one when it was made, unless it was lost since.
    """

    START = 0

    def __init__(self, alphabet: list[int], n_labels: int) -> None:
        self.goes = [-1] * n_labels
        self.left, self.made = [-1] * n_labels, [0] * n_labels
        for a in alphabet:
            self.goes[a] = self.START
        self.origin, self.born, self.readers = [-1], [0], [len(alphabet) + 1]
        self.lost: dict[tuple[int, int], int] = {}
        self.merges = 0

    def merge(self, a: int, b: int, c: int) -> None:
        """The gadget of one merge. Halves must have been made before, and c only once."""
        if self.goes[c] >= 0 or self.goes[a] < 0 or self.goes[b] < 0:
            raise ValueError(f"merge {self.merges} does not follow from those before it")
        self.merges += 1
        after_a, after_b = self.goes[a], self.goes[b]
        if not self._has(after_a, b, self.merges):
            raise ValueError(f"merge {self.merges - 1} can never take place")
        # A state that only a leads to needs no copy, unless its own arc a (as b) goes on to lead there.
        if self.readers[after_a] > 1 or a == b:
            self.readers[after_a] -= 1
            self.origin.append(after_a)
            self.born.append(self.merges)
            self.readers.append(1)
            self.goes[a] = len(self.origin) - 1
        self.lost[self.goes[a], b] = self.merges
        self.goes[c], self.left[c], self.made[c] = after_b, a, self.merges
        self.readers[after_b] += 1

    def _has(self, state: int, label: int, until: int) -> bool:
        lost, origin, born = self.lost, self.origin, self.born
        while label >= 0:
            s, t = state, until
            while s >= 0:
                at = lost.get((s, label))
                if at is not None and at <= t:
                    return False
                t = min(t, born[s] - 1)
                s = origin[s]
            until = self.made[label]
            label = self.left[label]
        return True

    def step(self, state: int, label: int) -> int:
        """The state after reading a label, or -1."""
        goes = self.goes[label]
        return goes if goes >= 0 and self._has(state, label, self.merges) else -1


def compile_merges(vocabulary: Vocabulary) -> MergeAutomaton:
    automaton = MergeAutomaton(vocabulary.bytes_to_id, len(vocabulary.labels))
    for a, b, c in vocabulary.merges:
        automaton.merge(a, b, c)
    return automaton


class PreSplit:
    """The pre-split of byte-level models.

    Python's word classes do for texts without signs that they class in another way (numbers that are no digits, four
    separators, signs newer than Python's tables); texts with such signs go through classes spelled out.
    """

    def __init__(self) -> None:
        every = [chr(cp) for cp in range(sys.maxunicode + 1)]
        letters = _ranges(map(str.isalpha, every), NEW_LETTERS)
        numbers = _ranges((c.isnumeric() and not c.isalpha() for c in every), NEW_NUMBERS)
        odd = (c.isnumeric() and not c.isalpha() and not c.isdecimal() or "\x1c" <= c <= "\x1f" for c in every)
        s, short = SPACES, "'(?:s|t|re|ve|m|ll|d)"
        self.odd = re.compile(f"[{_ranges(odd, NEW_LETTERS + NEW_NUMBERS)}]")
        self.not_plain = re.compile("[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u02ff\u2010-\u205e]")
        self.usual = re.compile(rf"{short}| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
        self.exact = re.compile(
            f"{short}| ?[{letters}]+| ?[{numbers}]+| ?[^{s}{letters}{numbers}]+|[{s}]+(?![^{s}])|[{s}]+"
        )

    def __call__(self, text: str) -> list[str]:
        if self.not_plain.search(text) and self.odd.search(text):
            return self.exact.findall(text)
        return self.usual.findall(text)


@functools.cache
def pre_split() -> PreSplit:
    return PreSplit()


def _ranges(inside, added: list[tuple[int, int]]) -> str:
    """Code points of a truth value for each, and further ranges, as the inside of a character class."""
    flags = np.fromiter(inside, bool, sys.maxunicode + 1)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]))).reshape(-1, 2)
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in [*((a, b - 1) for a, b in edges.tolist()), *added])


class Words(dict):
    """Packed ids of words. The older half goes when too many are kept; words in use move over to the newer half."""

    def __init__(self, make, most: int) -> None:
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        found = self.older.get(word)
        if found is None:
            found = self.make(word)
        self[word] = found
        return found


class Encoder:
    """Texts to packed ids (unsigned 32-bit integers, little-endian) and back."""

    def __init__(self, vocabulary: Vocabulary, automaton: MergeAutomaton, most: int = KEPT_WORDS, part: int = PART_CHARS) -> None:
        self.automaton, self.labels, self.part = automaton, vocabulary.labels, part
        self.special = vocabulary.special
        names = sorted(self.special, key=lambda s: (-len(s), s))
        self.at_special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.split = pre_split()
        # Between a letter and a blank before a letter the pre-split always cuts.
        self.safe_cut = re.compile("[a-z](?= [a-z])")
        self.tree: dict = {}
        for i in [*vocabulary.bytes_to_id, *(c for _, _, c in vocabulary.merges)]:
            node = self.tree
            for b in self.labels[i]:
                node = node.setdefault(b, {})
            node[-1] = i
        self.longest = max(map(len, self.labels))
        self.lengths = [len(x) for x in self.labels]
        self.words = Words(lambda w: np.array(self.encode_word(w.encode()), "<u4").tobytes(), most)
        self.steps: dict[tuple[int, int], int] = {}

    def _labels_at(self, word: bytes, at: int) -> list[int]:
        """Labels that the word goes on with, shortest first."""
        found, node = [], self.tree
        for b in word[at : at + self.longest]:
            node = node.get(b)
            if node is None:
                break
            i = node.get(-1)
            if i is not None:
                found.append(i)
        return found

    def encode_word(self, word: bytes) -> list[int]:
        """The path of a pre-split word through the automaton."""
        lengths, steps, step = self.lengths, self.steps, self.automaton.step
        if len(steps) > KEPT_STEPS:
            steps.clear()
        at, state, open_labels = 0, MergeAutomaton.START, self._labels_at(word, 0)
        path, before, closed = [], [], set()
        while at < len(word):
            while open_labels:
                label = open_labels.pop()
                end = at + lengths[label]
                if end in closed:
                    continue
                after = steps.get((state, label))
                if after is None:
                    after = steps[state, label] = step(state, label)
                if after >= 0:
                    before.append((at, state, open_labels))
                    path.append(label)
                    at, state, open_labels = end, after, self._labels_at(word, end)
                    break
            else:
                closed.add(at)
                at, state, open_labels = before.pop()
                path.pop()
        return path

    def _parts(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > self.part:
            cut = self.safe_cut.search(text, at + self.part)
            if cut is None:
                break
            yield text[at : cut.start() + 1]
            at = cut.start() + 1
        yield text[at:] if at else text

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text; none for NULL. Special strings are cut out first, as the tokenizer library does."""
        if not text:
            return b""
        word, out = self.words.__getitem__, []
        for i, piece in enumerate(self.at_special.split(text) if self.at_special else [text]):
            if i % 2:
                out.append(np.array([self.special[piece]], "<u4").tobytes())
            else:
                out.extend(b"".join(map(word, self.split(p))) for p in self._parts(piece))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Arc labels one after the other; ids outside the vocabulary are left out, as the library does."""
        labels = self.labels
        numbers = np.frombuffer(ids, "<u4")
        if len(numbers) and int(numbers.max()) >= len(labels):
            numbers = numbers[numbers < len(labels)]
        return b"".join(map(labels.__getitem__, numbers.tolist())).decode("utf-8", "replace")


_ENCODERS: dict[str, Encoder] = {}


def _shared(df: DataFrame, file: str):
    """The vocabulary and its automaton, compiled on the driver and sent once; a few MB, whatever the table."""
    vocabulary = read_vocabulary(file)
    automaton = compile_merges(vocabulary)
    key = hashlib.sha256(repr((vocabulary.labels, vocabulary.merges, vocabulary.special)).encode()).hexdigest()
    sent = df.sparkSession.sparkContext.broadcast((vocabulary, automaton))

    def encoder() -> Encoder:
        if key not in _ENCODERS:
            _ENCODERS[key] = Encoder(*sent.value)
        return _ENCODERS[key]

    return encoder


def _mapped(df: DataFrame, source: str, target: str, kind: pa.DataType, spark_kind: T.DataType, file: str, make) -> DataFrame:
    encoder = _shared(df, file)
    plain = df.drop(target) if target != source else df
    at = plain.columns.index(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make(encoder())
        for batch in batches:
            made = pa.array([one(x.as_py()) for x in batch.column(at)], kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, target])

    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField(target, spark_kind)]))


def encode(docs: DataFrame, file: str, packed: bool = False) -> DataFrame:
    """Every row and column of ``docs`` with ``ids``: the tokens of its whole ``text``, without added special tokens.

    ``ids`` is an array of integers, or with ``packed`` a binary of unsigned 32-bit little-endian integers. Equal to
    the tokenizer library with the same file. NULL and empty texts have no ids. Texts of any length are encoded part
    by part at places where the pre-split cuts anyway. Repeated rows stay. A column ``ids`` is replaced. An empty
    table gives an empty result.
    """
    if packed:
        return _mapped(docs, "text", "ids", pa.binary(), T.BinaryType(), file, lambda e: e.encode)
    kind = pa.list_(pa.int32())
    spark_kind = T.ArrayType(T.IntegerType())
    return _mapped(docs, "text", "ids", kind, spark_kind, file, lambda e: lambda t: np.frombuffer(e.encode(t), "<i4"))


def decode(rows: DataFrame, file: str, column: str = "decoded") -> DataFrame:
    """Every row and column with the text of its ``ids`` (an array or packed).

    Bytes that are no UTF-8 give U+FFFD. NULL ids give NULL. A column of the target's name is replaced.
    """
    is_packed = isinstance(rows.schema["ids"].dataType, T.BinaryType)

    def make(e: Encoder):
        def one(ids):
            if ids is None:
                return None
            return e.decode(ids if is_packed else np.array([i for i in ids if i is not None], "<u4").tobytes())

        return one

    return _mapped(rows, "ids", column, pa.string(), T.StringType(), file, make)
