"""Token counts by transducers compiled from a byte-level BPE vocabulary.

Two deterministic transducers work one after the other:

- The *splitter* reads character classes and marks where pre-split words begin. It has twelve states; marks
  that depend on the next character are emitted with it, so there is no look-ahead.
- The *counter* reads the bytes of a word. Its transitions carry the number of tokens they emit, which is
  negative where a byte merges tokens counted before; summed over the bytes this is the word's number of tokens.

**Counter.** The last token of every prefix is unique: of the tokens that the prefix ends with, the one that can
follow the last token of what is before it, as no merge crosses between the two. A state therefore holds, for
every position from which a longer token may still come, the node of the trie of tokens, the last token before the
position, and how many tokens fewer the prefix up to there has. Equal states are one. What compilation writes out
is the closure of the vocabulary itself: the states and transitions of every token (as many as the
trie has nodes). Texts lead to others, about one more for four bytes of random letters, so a closure over all
strings is out of reach; these are derived by the same rule when first met and kept in the table, which goes
back to the compiled part when it holds ``EXTRA_STATES`` more. A table of words saves running words again.

**Chunks.** Texts are laid end to end, with an end mark after each, and cut into chunks of equal length that advance
in lockstep as rows of a numpy array. First every chunk is run from all twelve states, which gives its state map.
A parallel prefix scan composes the maps in log2(chunks) steps, so every chunk's entry state is known, however
long a text is; a second run from there emits the marks. Prefix sums of the words' counts give each text's total.

Null texts count as empty: 0 bytes, 0 tokens. Added tokens (such as an end-of-text mark) count 1 each and are cut out
first. Texts of any length are counted whole; long ones are cut before blanks that follow other
characters, where both transducers begin anew anyway. Repeated rows count each; extra columns pass through unchanged,
whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals_mart.llm._common import struct_of
from arrivals_mart.llm.bpe_automaton import byte_alphabet

#: Characters that are split together, and characters of a long text between two of its cuts.
BLOCK_CHARS, PIECE_CHARS = 1 << 21, 1 << 20
CHUNKS = 2048
#: States beyond the compiled ones, and words, that a task keeps.
EXTRA_STATES, TABLE_WORDS, LONG_WORD = 200_000, 400_000, 64
LIMIT = 1024

# ---------------------------------------------------------------- splitter
#: Character classes. The letters of the contractions 's 't 'm 'd 're 've 'll.
CLASSES = ("end", "letter", "number", "other", "apostrophe", "blank", "space", "short", "e", "rv", "l")
END, LETTER, NUMBER, OTHER, APOSTROPHE, BLANK, SPACE, SHORT, E, RV, L = range(len(CLASSES))
_LETTERS = (LETTER, SHORT, E, RV, L)
_CONTRACTED = {"s": SHORT, "t": SHORT, "m": SHORT, "d": SHORT, "e": E, "r": RV, "v": RV, "l": L}

#: States: what the open word is, as far as the next character cares.
STATES = ("start", "letters", "numbers", "others", "a blank", "a space", "blanks", "spaces",
          "an apostrophe", "'r or 'v", "'l", "a contraction")
_START, _LET, _NUM, _OTH, _BLANK1, _SPACE1, _BLANKS, _SPACES, _AP, _APRV, _APL, _DONE = range(len(STATES))
#: Bits of an output: a word begins at this character, a word begins at the one before.
HERE, BEFORE = 1, 2


def _transition(state: int, cls: int) -> tuple[int, int]:
    """(next state, output) of the splitter."""
    if cls == END:
        return _START, BEFORE if state in (_APRV, _APL) else 0
    # a pending contraction is decided now: completed, or its apostrophe was a word of its own
    if state == _APRV and cls == E or state == _APL and cls == L:
        return _DONE, 0
    if state in (_APRV, _APL):
        then, out = _transition(_LET, cls)
        return then, out | BEFORE
    if cls in (BLANK, SPACE):
        if state in (_BLANK1, _SPACE1, _BLANKS, _SPACES):
            return (_BLANKS if cls == BLANK else _SPACES), 0
        return (_BLANK1 if cls == BLANK else _SPACE1), HERE
    # the last of several white spaces leaves the others; a blank goes with what follows
    out = BEFORE if state in (_BLANKS, _SPACES) else 0
    joins = state in (_BLANK1, _BLANKS)
    if cls in _LETTERS:
        if state == _AP and cls in (SHORT, RV, L):
            return {SHORT: _DONE, RV: _APRV, L: _APL}[cls], 0
        return _LET, out | (0 if joins or state == _LET else HERE)
    if cls == NUMBER:
        return _NUM, out | (0 if joins or state == _NUM else HERE)
    if joins or state in (_OTH, _AP):
        return _OTH, out
    return (_AP if cls == APOSTROPHE else _OTH), out | HERE


_WIDTH = len(CLASSES)
_ALL = [_transition(s, c) for s in range(len(STATES)) for c in range(_WIDTH)]
#: Next state times the number of classes, by state times that number plus class; and the outputs.
_NEXT = np.array([s * _WIDTH for s, _ in _ALL], np.uint8)
_OUT = np.array([o for _, o in _ALL], np.uint8)


def character_classes() -> np.ndarray:
    """Class of every code point."""
    out = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    every = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000]
    point = np.array([ord(c) for c in every])
    text = "".join(every)
    for pattern, cls in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        for m in regex.finditer(pattern, text):
            out[point[m.start():m.end()]] = cls
    out[ord(" ")], out[ord("'")] = BLANK, APOSTROPHE
    for c, cls in _CONTRACTED.items():
        out[ord(c)] = cls
    return out


def chunk_maps(chunks: np.ndarray) -> np.ndarray:
    """State map of each chunk (a row of classes): exit state by entry state."""
    at = np.broadcast_to(np.arange(len(STATES), dtype=np.uint8) * _WIDTH, (len(chunks), len(STATES))).copy()
    for classes in np.ascontiguousarray(chunks.T):
        at = _NEXT[at + classes[:, None]]
    return at // _WIDTH


def prefix_scan(maps: np.ndarray) -> np.ndarray:
    """``out[i]`` is maps 0 to i, one after the other: composition is associative, so it is done by doubling."""
    out, step = maps.astype(np.intp), 1
    while step < len(out):
        later = np.take_along_axis(out[step:], out[:-step], 1)
        out = np.concatenate([out[:step], later])
        step *= 2
    return out


def word_starts(classes: np.ndarray, chunks: int = CHUNKS) -> np.ndarray:
    """True where a word begins. ``classes`` are whole texts, each followed by ``END``."""
    n = len(classes)
    length = max(1, -(-n // chunks))
    rows = np.full(-(-n // length) * length, END, np.uint8)
    rows[:n] = classes
    rows = rows.reshape(-1, length)
    scanned = prefix_scan(chunk_maps(rows))
    at = np.full(len(rows), _START * _WIDTH, np.uint8)
    at[1:] = scanned[:-1, _START] * _WIDTH
    out = np.empty((length, len(rows)), np.uint8)
    for i, column in enumerate(np.ascontiguousarray(rows.T)):
        key = at + column
        out[i], at = _OUT[key], _NEXT[key]
    out = out.T.reshape(-1)[:n]
    marks = (out & HERE) > 0
    marks[:-1] |= (out[1:] & BEFORE) > 0
    return marks


# ---------------------------------------------------------------- counter
@dataclass
class Counter:
    """The counting transducer. ``table`` maps state << 8 | byte to next state << 9 | (emitted tokens + 256)."""

    trie: dict[int, int]
    ends: list[int]
    inner: list[bool]
    rank: dict[int, int]
    #: Tokens on the right and the left edge of each token, with the rank of the merge that ends them.
    right: list[list[tuple[int, int]]]
    left: list[list[tuple[int, int]]]
    added: dict[str, int]
    classes: np.ndarray
    table: dict[int, int] = field(default_factory=dict)
    #: (trie node, last token before, tokens relative to now) per position; the last is the present position.
    states: list[tuple] = field(default_factory=list)
    number: dict[tuple, int] = field(default_factory=dict)
    compiled: tuple[int, int] = (0, 0)

    NONE = -1

    def apart(self, a: int, b: int) -> bool:
        """May token ``b`` follow token ``a``: does no merge cross between them?

        A crossing merge takes a token on the right edge of ``a`` and one on the left edge of ``b``
        that are both still there at its turn. Of equal merges the left one is done first.
        """
        rank = self.rank.get
        for x, x_ends in self.right[a]:
            for y, y_ends in self.left[b]:
                k = rank(x << 20 | y)
                if k is not None and k < x_ends and k <= y_ends:
                    return False
        return True

    def _state(self, positions: tuple) -> int:
        at = self.number.get(positions)
        if at is None:
            at = self.number[positions] = len(self.states)
            self.states.append(positions)
        return at

    def step(self, state: int, byte: int) -> int:
        """Derive the transition of ``state`` on ``byte`` and enter it in the table."""
        emitted, last, moved = None, None, []
        for node, before, behind in self.states[state]:
            child = self.trie.get(node << 8 | byte)
            if child is None:
                continue
            token = self.ends[child]
            if emitted is None and token >= 0 and (before == self.NONE or self.apart(before, token)):
                emitted, last = behind + 1, token
            moved.append((child, before, behind))
        positions = tuple((n, t, c - emitted) for n, t, c in moved if self.inner[n])
        out = self.table[state << 8 | byte] = self._state((*positions, (0, last, 0))) << 9 | emitted + 256
        return out

    def count(self, word: bytes, extra_states: int = EXTRA_STATES) -> int:
        """Tokens of one pre-split word."""
        table, state, total = self.table.get, 0, 0
        for byte in word:
            found = table(state << 8 | byte)
            if found is None:
                if len(self.states) > self.compiled[0] + extra_states:
                    state = self.forget(state)
                    table = self.table.get
                found = self.step(state, byte)
            state, total = found >> 9, total + (found & 511) - 256
        return total

    def forget(self, state: int) -> int:
        """Go back to the compiled part; return the number that ``state`` has there, or a new one."""
        here, (n_states, n_arcs) = self.states[state], self.compiled
        for positions in self.states[n_states:]:
            del self.number[positions]
        del self.states[n_states:]
        # dictionaries keep the order of entry
        for key in list(self.table)[n_arcs:]:
            del self.table[key]
        return self._state(here)


def compile_counter(vocab: dict[str, int], merges: list[tuple[str, str]], added: dict[str, int] | None = None) -> Counter:
    """Write out the counter's transitions on all tokens of the vocabulary."""
    alphabet, added = byte_alphabet(), dict(added or {})
    size = max(vocab.values(), default=-1) + 1
    labels = {t: bytes(alphabet[c] for c in text) for text, t in vocab.items()}
    always = 1 << 60
    right, left = [[(t, always)] for t in range(size)], [[(t, always)] for t in range(size)]
    counter = Counter({}, [-1], [False], {}, right, left, added, character_classes())
    reached = {t for t, label in labels.items() if len(label) == 1}
    for k, (a, b) in enumerate(merges):
        u, v, w = vocab[a], vocab[b], vocab[a + b]
        # a merge whose parts never meet, or whose result is not what its text becomes, does nothing
        if u in reached and v in reached and counter.apart(u, v):
            counter.rank[u << 20 | v] = k
            if w not in reached:
                reached.add(w)
                right[w] = [(w, always), (v, k), *right[v][1:]]
                left[w] = [(w, always), (u, k), *left[u][1:]]
    for t in sorted(reached):
        node = 0
        for byte in labels[t]:
            child = counter.trie.get(node << 8 | byte)
            if child is None:
                child = counter.trie[node << 8 | byte] = len(counter.ends)
                counter.ends.append(-1)
                counter.inner.append(False)
                counter.inner[node] = True
            node = child
        counter.ends[node] = t
    counter._state(((0, Counter.NONE, 0),))
    for t in sorted(reached):
        counter.count(labels[t], 1 << 60)
    counter.compiled = len(counter.states), len(counter.table)
    return counter


def load_counter(path: str) -> Counter:
    """Compile the vocabulary, merges and added tokens of a tokenizer file."""
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    model = d["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    added = {t["content"]: t["id"] for t in d.get("added_tokens") or []}
    return compile_counter({k: v for k, v in model["vocab"].items() if k not in added}, merges, added)


class _Words(dict):
    """word -> tokens, filled as words come by."""

    def __init__(self, counter: Counter):
        super().__init__()
        self.counter = counter

    def __missing__(self, word: str) -> int:
        n = self.counter.count(word.encode())
        if len(word) <= LONG_WORD:
            if len(self) >= TABLE_WORDS:
                self.clear()
            self[word] = n
        return n


class TextCounter:
    """Counts tokens of whole texts with one compiled counter."""

    def __init__(self, counter: Counter, chunks: int = CHUNKS):
        self.counter, self.chunks, self.words = counter, chunks, _Words(counter)
        longest = sorted(counter.added, key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, longest))) if longest else None
        self.cut = regex.compile(r"(?<=\S) ")

    def _pieces(self, text: str) -> Iterator[str]:
        """Plain pieces of a text that can be counted apart; long ones end before a blank after another character."""
        at = 0
        while len(text) - at > PIECE_CHARS:
            m = self.cut.search(text, at + PIECE_CHARS)
            if m is None:
                break
            yield text[at:m.start()]
            at = m.start()
        yield text[at:] if at else text

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        total, pieces, owner, held = np.zeros(len(texts), np.int64), [], [], 0
        for i, text in enumerate(texts):
            plain = [text]
            if self.added is not None and self.added.search(text):
                plain = self.added.split(text)
                total[i] += len(plain) - 1
            for part in plain:
                for piece in self._pieces(part):
                    if not piece:
                        continue
                    pieces.append(piece)
                    owner.append(i)
                    held += len(piece)
                    if held >= BLOCK_CHARS:
                        np.add.at(total, owner, self._block(pieces))
                        pieces, owner, held = [], [], 0
        if pieces:
            np.add.at(total, owner, self._block(pieces))
        return total

    def _block(self, pieces: list[str]) -> np.ndarray:
        """Tokens of each piece: words by the splitter, tokens by the counter, totals by prefix sums."""
        text = "\n".join(pieces) + "\n"
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(p) + 1 for p in pieces]) - 1
        classes = self.counter.classes[points]
        classes[ends] = END
        starts = np.flatnonzero(word_starts(classes, self.chunks))
        edges = np.sort(np.concatenate([starts, ends]))
        stops = edges[np.searchsorted(edges, starts, "right")]
        found = [self.words[text[a:b]] for a, b in zip(starts.tolist(), stops.tolist())]
        sums = np.concatenate([[0], np.cumsum(found, dtype=np.int64)])
        before = np.searchsorted(starts, np.concatenate([[0], ends]))
        return np.diff(sums[before])


_COUNTERS: dict[str, TextCounter] = {}


def _text_counter(shared) -> TextCounter:
    """One per worker process and tokenizer, kept between tasks."""
    name, counter = shared.value
    if name not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[name] = TextCounter(counter)
    return _COUNTERS[name]


def token_counts(df: DataFrame, tokenizer_path: str, text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """All columns of ``df`` but the text in the struct ``row``, with n_bytes (UTF-8), n_tokens and over_limit.

    The compiled counter, of the vocabulary's size, is broadcast.
    """
    counter = load_counter(tokenizer_path)
    shared = df.sparkSession.sparkContext.broadcast((f"{tokenizer_path}:{len(counter.rank)}", counter))
    row, row_type = struct_of(df, text_col)
    schema = T.StructType([
        T.StructField("row", row_type), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType()),
    ])

    def run(batches):
        counter = _text_counter(shared)
        for b in batches:
            texts = b.column("text")
            n_bytes = texts.cast(pa.large_binary()).fill_null(b"")
            sizes = np.diff(np.frombuffer(n_bytes.buffers()[1], np.int64, len(n_bytes) + 1, 8 * n_bytes.offset))
            out = np.zeros(b.num_rows, np.int64)
            # a few million characters of Python strings at a time
            cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // BLOCK_CHARS)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                out[lo:hi] = counter.counts([t or "" for t in texts.slice(lo, hi - lo).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(sizes), pa.array(out), pa.array(out > limit)],
                names=["row", "n_bytes", "n_tokens", "over_limit"],
            )

    return df.select(row.alias("row"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, schema)
