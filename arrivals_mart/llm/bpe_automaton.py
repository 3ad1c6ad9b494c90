"""Byte-pair encoding by a tokenization automaton, and decoding by its arc labels.

The automaton reads tokens. It starts as one state with an arc for every base symbol and
accepts every sequence of symbols. Each merge (u, v) -> w in turn changes it by a
gadget: the state q that arcs labelled u lead to is copied without its v arc, the
arcs labelled u are redirected to the copy, and every state with an arc u gets an arc
w to where v led from q. A path is then a correct tokenization under the merges so far,
and every string has exactly one such path.

All arcs of one label lead to one state, and that state is a chain of copies, each without
one more arc. So a gadget is one entry ``(u, v) -> rank``, and whether state q has an
arc t follows from the entries along the right parts of the label into q and the left
parts of t; answers are kept in a transition table. Encoding walks a pre-split word along
arcs that spell it, longer ones first. As only one path leads to any position, a position
from which the end cannot be reached is left for good, so a word takes few steps more than tokens.

Null texts count as empty and give no ids. Added tokens (such as an end-of-text mark) are cut
out first. Rows that repeat are encoded each. Extra columns pass through unchanged.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals_mart.llm._common import struct_of

#: Fixed value: how the byte-level pre-tokenizer splits text.
PRE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries that a task's tables of transitions and words may hold before they are emptied.
TABLE_ENTRIES = 400_000
#: Longer words are not kept in the table of words.
LONG_WORD = 64


def byte_alphabet() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte, and that byte.

    Printable Latin-1 characters stand for themselves; the other bytes take the
    code points from 256 on, in order.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class Automaton:
    """``labels[t]`` are a token's bytes; ``parts[t]`` the pair that it was merged from, or None."""

    labels: list[bytes]
    parts: list[tuple[int, int] | None]
    gadget: dict[int, int]
    born: list[int]
    trie: dict[int, int] = field(default_factory=dict)
    ends: list[int] = field(default_factory=list)
    added: dict[str, int] = field(default_factory=dict)

    START = -1

    def arc(self, after: int, t: int) -> bool:
        """Has the state that arcs ``after`` lead to an arc ``t``?

        The state's chain of copies lacks the tokens that gadgets took from ``after``
        since it arose, from its right part before that, and so on. The arc ``t`` was
        added to every state that had an arc for its left part at the time.
        """
        if after < 0:
            return True
        gadget, parts, born = self.gadget, self.parts, self.born
        y, before = after, 1 << 60
        while True:
            x, upto = t, 1 << 60
            while True:
                k = gadget.get(y << 20 | x)
                if k is not None and k < before and k <= upto:
                    return False
                if (p := parts[x]) is None:
                    break
                upto, x = born[x], p[0]
            if (p := parts[y]) is None:
                return True
            before, y = born[y], p[1]


def compile_automaton(vocab: dict[str, int], merges: list[tuple[str, str]], added: dict[str, int] | None = None,
                      alphabet: dict[str, int] | None = None) -> Automaton:
    """Apply the merge gadgets in turn. ``alphabet`` maps characters of the vocabulary to bytes."""
    alphabet = alphabet or byte_alphabet()
    size = max([*vocab.values(), *(added or {}).values()], default=-1) + 1
    labels, parts, born = [b""] * size, [None] * size, [-1] * size
    for text, t in vocab.items():
        labels[t] = bytes(b for c in text for b in ([alphabet[c]] if c in alphabet else c.encode()))
    gadget: dict[int, int] = {}
    reached = {t for t in vocab.values() if len(labels[t]) == 1}
    automaton = Automaton(labels, parts, gadget, born, added=dict(added or {}))
    for rank, (a, b) in enumerate(merges):
        u, v, w = vocab[a], vocab[b], vocab[a + b]
        if u in reached and v in reached and automaton.arc(u, v):
            gadget[u << 20 | v] = rank
            if w not in reached:
                parts[w], born[w] = (u, v), rank
                reached.add(w)
    nodes, ends = automaton.trie, [-1]
    for t in sorted(reached):
        at = 0
        for byte in labels[t]:
            nxt = nodes.get(at << 8 | byte)
            if nxt is None:
                nxt = nodes[at << 8 | byte] = len(ends)
                ends.append(-1)
            at = nxt
        ends[at] = t
    automaton.ends = ends
    for text, t in automaton.added.items():
        labels[t] = text.encode()
    return automaton


def load_automaton(path: str) -> Automaton:
    """Compile the vocabulary, merges and added tokens of a tokenizer file."""
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    model = d["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    added = {t["content"]: t["id"] for t in d.get("added_tokens") or []}
    return compile_automaton({k: v for k, v in model["vocab"].items() if k not in added}, merges, added)


class WordTable(dict):
    """word -> its ids as bytes, filled by the encoder as words come by."""

    def __init__(self, encoder: "Encoder"):
        super().__init__()
        self._encoder = encoder

    def __missing__(self, word: str) -> bytes:
        ids = array("i", self._encoder.tokens(word.encode())).tobytes()
        if len(word) <= LONG_WORD:
            if len(self) >= self._encoder.entries:
                self.clear()
            self[word] = ids
        return ids


class Encoder:
    """Table-driven encoding with one compiled automaton; the tables fill as words come by."""

    def __init__(self, automaton: Automaton, entries: int = TABLE_ENTRIES):
        self.a, self.entries = automaton, entries
        self.arcs: dict[int, bool] = {}
        self.words = WordTable(self)
        self.split = regex.compile(PRE_SPLIT).findall
        special = sorted(automaton.added, key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self._labels = np.array(automaton.labels, dtype=object)

    def tokens(self, word: bytes) -> list[int]:
        """The labels on the one path that spells ``word``.

        Longer arcs are tried first. Only one path leads to a position, so a
        position from which the end was not reached is never tried again.
        """
        a, arcs, n = self.a, self.arcs, len(word)
        trie, ends, arc = a.trie.get, a.ends, a.arc
        path, before, dead = [], [], set()
        at, last, todo = 0, -1, None
        while at < n:
            if todo is None:
                todo, node, j = [], 0, at
                while j < n:
                    node = trie(node << 8 | word[j])
                    if node is None:
                        break
                    j += 1
                    if ends[node] >= 0:
                        todo.append((j, ends[node]))
            while todo:
                j, t = todo.pop()
                if j in dead:
                    continue
                if last >= 0:
                    key = last << 20 | t
                    ok = arcs.get(key)
                    if ok is None:
                        if len(arcs) >= self.entries:
                            arcs.clear()
                        ok = arcs[key] = arc(last, t)
                    if not ok:
                        continue
                before.append((at, last, todo))
                path.append(t)
                at, last, todo = j, t, None
                break
            else:
                dead.add(at)
                path.pop()
                at, last, todo = before.pop()
        return path

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, self.split(text)))

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        if self.specials is None or not self.specials.search(text):
            return np.frombuffer(self._plain(text), np.int32)
        out = []
        for k, piece in enumerate(self.specials.split(text)):
            out.append(np.array([self.a.added[piece]], np.int32).tobytes() if k % 2 else self._plain(piece))
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """Emit the labels of the arcs; bytes that are no UTF-8 become replacement characters."""
        return b"".join(self._labels[ids].tolist()).decode("utf-8", "replace")


_ENCODERS: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder per worker process and broadcast automaton, kept between tasks."""
    key = shared.value[0]
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(shared.value[1])
    return _ENCODERS[key]


def encode_decode(df: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """All columns of ``df`` in the struct ``row``, with ``ids`` (array<int>) and ``decoded`` (string).

    The automaton, of the vocabulary's size, is compiled once and broadcast.
    """
    spark = df.sparkSession
    automaton = load_automaton(tokenizer_path)
    shared = spark.sparkContext.broadcast((f"{tokenizer_path}:{len(automaton.labels)}", automaton))
    row, row_type = struct_of(df, text_col)
    schema = T.StructType([
        T.StructField("row", row_type),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.StringType()),
    ])

    def pieces(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
        """Row ranges of about 4 MB of text."""
        lengths = np.diff(np.frombuffer(batch.column("text").cast(pa.large_binary()).buffers()[1], np.int64,
                                        batch.num_rows + 1, 8 * batch.column("text").offset))
        start, total = 0, 0
        for i, n in enumerate(lengths):
            total += int(n)
            if total > 4 << 20:
                yield start, i + 1
                start, total = i + 1, 0
        if start < batch.num_rows:
            yield start, batch.num_rows

    def run(batches):
        encoder = _encoder(shared)
        for whole in batches:
            for lo, hi in pieces(whole):
                batch = whole.slice(lo, hi - lo)
                ids = [encoder.encode(t or "") for t in batch.column("text").to_pylist()]
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) for x in ids], out=offsets[1:])
                flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                     pa.array([encoder.decode(x) for x in ids], pa.string())],
                    names=["row", "ids", "decoded"],
                )

    return df.select(row.alias("row"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, schema)


def ids_text(ids: Column) -> Column:
    """Decimal ids joined by commas."""
    return F.array_join(ids.cast("array<string>"), ",")
