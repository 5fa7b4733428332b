"""BPE encoding and decoding with a tokenization automaton.

The merges are compiled, one by one in order of rank, into a deterministic automaton over tokens whose paths spell
exactly the token sequences that BPE makes. It starts with one arc per byte. The gadget for a merge of ``a`` and ``b``
adds, wherever an ``a`` arc can be followed by a ``b`` arc, an arc for ``ab`` that leads where the ``b`` arc leads,
and splits the state behind the ``a`` arcs so that the copy has no ``b`` arc any more. All arcs of one label lead to
one state, so states are named by labels. Copies are kept as references: the state of a new token has the arcs of its
right part, and its own arc leaves the states that its left part leaves, both as they were at that merge. An arc is
thus looked up by going back through the merges, once; afterwards it stands in a table.

A word is encoded from left to right. For each prefix exactly one token can be the last one: the one that ends there
and whose arc leaves the state in which the rest of the prefix ends.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from collections.abc import Iterator

import pandas as pd
import pyspark.sql.functions as F
import regex
from pyspark.sql import Column, SparkSession

from .common import small_batches

# Words, and arcs, that a worker remembers; beyond that it forgets them all and starts again.
REMEMBERED = 250_000
START = -1


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def labels_of(read: dict) -> list[str]:
    """The label of each id in a tokenizer file."""
    known = read["model"]["vocab"] | {t["content"]: t["id"] for t in read["added_tokens"]}
    labels = [""] * (max(known.values()) + 1)
    for label, number in known.items():
        labels[number] = label
    return labels


def decode_ids(labels: list[str], packed: bytes) -> str:
    """The labels along a path, with spaces between."""
    ids = array("I")
    ids.frombytes(packed)
    return " ".join(map(labels.__getitem__, ids))


class MergeAutomaton:
    """States and arcs by token. A token that two merges make is refused."""

    def __init__(self, tokens: int, merges: list[tuple[int, int, int]], final: set[int]) -> None:
        self.left, self.right = array("i", [-1]) * tokens, array("i", [-1]) * tokens
        self.born = array("i", [-1]) * tokens
        self.cut: dict[int, int] = {}
        self.final = final
        self.table: dict[int, dict[int, bool]] = {}
        self.stored = 0
        for rank, (a, b, ab) in enumerate(merges):
            self._gadget(rank, a, b, ab)

    def _gadget(self, rank: int, a: int, b: int, ab: int) -> None:
        if self.born[ab] >= 0 or a << 32 | b in self.cut:
            raise ValueError(f"token {ab} is made by more than one merge")
        self.left[ab], self.right[ab], self.born[ab] = a, b, rank
        self.cut[a << 32 | b] = rank

    def _has_arc(self, state: int, label: int, time: int) -> bool:
        """Whether the arc leaves the state before the merge number ``time``."""
        while True:
            if state in self.final or self.cut.get(state << 32 | label, time) < time:
                return False
            born = self.born[label]
            if born >= 0 and self.left[label] == self.right[label] == state:
                return False  # in a run of equal tokens the leftmost two are merged first
            if born < 0 and self.born[state] < 0:
                return True
            if born >= self.born[state]:
                label, time = self.left[label], born
            else:
                state, time = self.right[state], self.born[state]

    def row(self, state: int) -> dict[int, bool]:
        """The part of the table of one state that is known by now."""
        known = self.table.get(state)
        if known is None:
            known = self.table[state] = {}
        return known

    def follows(self, state: int, label: int) -> bool:
        if self.stored > REMEMBERED:
            self.table.clear()
            self.stored = 0
        self.stored += 1
        found = self.row(state)[label] = state == START or self._has_arc(state, label, len(self.born))
        return found


class Tokenizer(dict):
    """Encodes pre-split words; as a mapping it holds the packed ids of the words seen."""

    def __init__(self, spec: str) -> None:
        super().__init__()
        read = json.loads(spec)
        model, suffix = read["model"], read["model"]["end_of_word_suffix"]
        # Spellings of tokens as a tree: next nodes by byte, and the token within and at the end of a word by node.
        self.nexts: list[dict[int, int]] = [{}]
        self.inner, self.last = [-1], [-1]
        letters = byte_letters()
        for token, number in model["vocab"].items():
            ends = token.endswith(suffix)
            node = 0
            for letter in token.removesuffix(suffix) if ends else token:
                node = self._next(node, letters[letter])
            (self.last if ends else self.inner)[node] = number
        vocab = model["vocab"]
        merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in model["merges"]]
        self.automaton = MergeAutomaton(max(vocab.values()) + 1, merges, {t for t in self.last if t >= 0})
        self.special = {t["content"]: t["id"] for t in read["added_tokens"]}
        steps = read["pre_tokenizer"]["pretokenizers"]
        self.word = regex.compile(steps[0]["pattern"]["Regex"])
        self.marker = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)")

    def _next(self, node: int, byte: int) -> int:
        known = self.nexts[node].get(byte)
        if known is None:
            known = self.nexts[node][byte] = len(self.nexts)
            self.nexts.append({})
            self.inner.append(-1)
            self.last.append(-1)
        return known

    def word_ids(self, word: str) -> list[int]:
        """Tokens of one word, by the automaton."""
        spelled = word.encode()
        size = len(spelled)
        nexts, inner, last, row, follows = self.nexts, self.inner, self.last, self.automaton.row, self.automaton.follows
        final = size - 1
        tokens, back = [START] * (size + 1), [-1] * (size + 1)
        for begin in range(size):
            state, node, at = tokens[begin], 0, begin
            arcs = row(state).get
            while True:
                node = nexts[node].get(spelled[at])
                if node is None:
                    break  # no token begins like that
                if at == final:
                    token = last[node]
                    if token >= 0 and back[size] < 0:
                        arc = arcs(token)
                        if follows(state, token) if arc is None else arc:
                            tokens[size], back[size] = token, begin
                    break
                at += 1
                if back[at] < 0:
                    token = inner[node]
                    if token >= 0:
                        arc = arcs(token)
                        if follows(state, token) if arc is None else arc:
                            tokens[at], back[at] = token, begin
        found, end = [], size
        while end > 0:
            found.append(tokens[end])
            end = back[end]
        return found[::-1]

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        ids = self[word] = array("I", self.word_ids(word)).tobytes()
        return ids

    def encode_plain(self, text: str) -> bytes:
        normal = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return b"".join(map(self.__getitem__, self.word.findall(normal)))

    def encode(self, text: str) -> bytes:
        """Packed ids: little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        parts, done = [], 0
        if "<" in text or not all(s.startswith("<") for s in self.special):
            for found in self.marker.finditer(text):
                parts.append(self.encode_plain(text[done : found.start()]))
                parts.append(array("I", [self.special[found[0]]]).tobytes())
                done = found.end()
        parts.append(self.encode_plain(text[done:]))
        return b"".join(parts)


def _compiled(shared: dict) -> Tokenizer:
    """The tokenizer of a broadcast file. It stays with the worker process's copy, for all tasks that run there."""
    if shared["tokenizer"] is None:
        shared["tokenizer"] = Tokenizer(shared["spec"])
    return shared["tokenizer"]


class Codec:
    """Column functions of one tokenizer file (byte-level BPE with word ends, as a ``tokenizers`` JSON file).

    The file is read on the driver and broadcast; its size is that of the vocabulary.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = file.read()
        small_batches(spark)
        self._shared = spark.sparkContext.broadcast({"spec": spec, "tokenizer": None})
        self._labels = spark.sparkContext.broadcast(labels_of(json.loads(spec)))

    def encode(self, text: Column) -> Column:
        """Token ids as packed little-endian unsigned 32-bit integers; empty for an empty text or NULL.

        The strings of special tokens in a text become these tokens. No token is added, none cut off.
        """
        shared = self._shared

        @F.pandas_udf("binary")
        def packed_ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            tokenizer = _compiled(shared.value)
            for texts in batches:
                yield pd.Series([tokenizer.encode(t) if t else b"" for t in texts], dtype=object)

        return packed_ids(text)

    def decode(self, packed: Column) -> Column:
        """The labels of the ids with spaces between; empty for no ids or NULL."""
        labels = self._labels

        @F.pandas_udf("string")
        def label_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for packs in batches:
                yield pd.Series([decode_ids(labels.value, p) if p else "" for p in packs], dtype=object)

        return label_text(packed)

    def encode_and_decode(self, text: Column) -> Column:
        """``ids`` as ``encode`` makes them and ``decoded`` as ``decode`` makes them of these, as one struct.

        Both run in one Python worker. Calling the two in turn takes two workers for every task, each with its own
        memory.
        """
        shared, labels = self._shared, self._labels

        @F.pandas_udf("ids binary, decoded string")
        def coded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            tokenizer = _compiled(shared.value)
            for texts in batches:
                ids = [tokenizer.encode(t) if t else b"" for t in texts]
                decoded = [decode_ids(labels.value, p) if p else "" for p in ids]
                yield pd.DataFrame({"ids": ids, "decoded": decoded}, dtype=object)

        return coded(text)


def n_tokens(packed: Column) -> Column:
    return (F.octet_length(packed) / 4).cast("bigint")
