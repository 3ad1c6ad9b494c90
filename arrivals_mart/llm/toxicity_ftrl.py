"""Toxicity by logistic regression over hashed word n-grams and skip-grams, trained by FTRL-proximal.

A document's features are the distinct hashed single words, stems (a word's first letters),
word pairs and pairs that skip one word. Words are compared in lower case without the
punctuation around them.
Training visits a bounded sample of labelled documents with a learning rate of its own per
coordinate; L1 leaves most weights at exactly zero. The weights that are not zero, at most
a bounded number, are what the tasks get.

Scoring looks every word of a text up and sums the weights of the distinct features present.
Null texts count as empty; they score the bias alone. Without labelled rows of both kinds
every score is 0.5. Repeated rows score alike. Texts of any length are scored whole; training takes documents up to a
bound on their number and bytes. Extra columns are not read, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals_mart.llm._common import LOWER
from arrivals_mart.llm.quality_crf import bounded_rows, labelled_sample, pieces

#: Number of hash buckets, as a power of two; it bounds the weights.
BITS = 21
#: Bound on labelled documents per label that the model is fitted on.
SAMPLE_PER_LABEL = 6000
#: Bound on the bytes of their buckets, which the driver gathers.
SAMPLE_BYTES = 96 << 20
EPOCHS = 8
ALPHA, BETA, L1, L2 = 2.0, 1.0, 5.0, 0.0
#: Words that a task's table may hold before it is emptied.
TABLE_ENTRIES = 500_000
STEM_LETTERS = 5
#: Odd multipliers that keep the kinds of feature apart.
_ONE, _PAIR, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_STEM, _HALF = np.uint64(0x27D4EB2F165667C5), np.uint64(32)
_PUNCTUATION = b".,;:!?\"'()[]{}<>*#$%&|~_-+=/\\"


class WordHashes(dict):
    """word -> hashes of its normalised form (high half) and its stem (low half), filled as words come by."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= TABLE_ENTRIES:
            self.clear()
        bare = word.strip(_PUNCTUATION).translate(LOWER)
        stem = bare.decode("utf-8", "ignore")[:STEM_LETTERS].encode()
        h = xxhash.xxh32_intdigest(bare) << 32 | xxhash.xxh32_intdigest(stem)
        if len(word) <= 64:
            self[word] = h
        return h


def feature_hashes(h: np.ndarray, bits: int = BITS) -> list[np.ndarray]:
    """Buckets of every word, stem, pair and skip pair of a sequence of word hashes.

    Entry i of each array begins at word i; the last pairs have no entry.
    """
    shift = np.uint64(64 - bits)
    word = h >> _HALF
    with np.errstate(over="ignore"):
        stem = (h & np.uint64(0xFFFFFFFF)) * _STEM
        pair = ((word[:-1] * _PAIR) ^ (word[1:] * _ONE + _PAIR)) * _ONE
        skip = ((word[:-2] * _SKIP) ^ (word[2:] * _ONE + _SKIP)) * _ONE
        return [x >> shift for x in (word * _ONE, stem, pair, skip)]


@dataclass
class Model:
    """Weights that are not zero, by bucket, and the bias."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float

    def table(self) -> np.ndarray:
        out = np.zeros(1 << BITS, np.float32)
        out[self.buckets] = self.weights
        return out


def fit(documents: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Model:
    """FTRL-proximal over documents given as arrays of distinct buckets."""
    if not len(documents) or labels.min() == labels.max():
        return Model(np.zeros(0, np.int64), np.zeros(0, np.float32), 0.0)
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    order = np.random.default_rng(seed)

    def weights(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    for _ in range(epochs):
        for k in order.permutation(len(documents)):
            i = np.append(documents[k].astype(np.int64), size)
            w = weights(i)
            w[-1] = -z[size] / ((BETA + np.sqrt(n[size])) / ALPHA + L2)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[k]
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - sigma * w
            n[i] += g * g
    w = weights(np.arange(size))
    at = np.flatnonzero(w)
    bias = -z[size] / ((BETA + np.sqrt(n[size])) / ALPHA + L2)
    return Model(at, w[at].astype(np.float32), float(bias))


def _word_hashes(text: bytes | None, words: WordHashes) -> np.ndarray:
    split = text.split() if text else []
    return np.fromiter((words[w] for w in split), np.uint64, len(split))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
          text_col: str = "text", per_label: int = SAMPLE_PER_LABEL, most_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on a sample bounded in documents and in bytes of buckets; the tasks send distinct buckets, not texts."""
    sample = labelled_sample(labels, label_col, id_col, per_label)

    def run(batches):
        words = WordHashes()
        for b in batches:
            rows = [
                np.unique(np.concatenate(feature_hashes(_word_hashes(t, words)))).astype("<u4").tobytes()
                for t in b.column("text").cast(pa.binary()).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("y"), pa.array(rows, pa.binary())], names=["id", "y", "x"]
            )

    ident, text = F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")
    rows = (
        docs.select(ident, text).join(F.broadcast(sample), F.col("id") == F.col("sample_id")).select("id", "y", "text")
        .mapInArrow(run, "id bigint, y int, x binary")
    )
    rows = bounded_rows(rows, most_bytes)
    return fit([np.frombuffer(r["x"], "<u4") for r in rows], np.array([r["y"] for r in rows], float))


def margins(texts: list[bytes], table: np.ndarray, bias: float, words: WordHashes) -> np.ndarray:
    """Bias plus the weights of each text's distinct features."""
    split = [t.split() for t in texts]
    n_words = np.fromiter(map(len, split), np.int64, len(split))
    get = words.__getitem__
    h = np.fromiter((x for s in split for x in map(get, s)), np.uint64, int(n_words.sum()))
    of = np.repeat(np.arange(len(texts)), n_words)
    hits = []
    for gap, buckets in zip((0, 0, 1, 2), feature_hashes(h)):
        at = np.flatnonzero(table[buckets])
        if gap:
            at = at[of[at] == of[at + gap]]
        hits.append(of[at] << BITS | buckets[at].astype(np.int64))
    distinct = np.unique(np.concatenate(hits))
    return bias + np.bincount(distinct >> BITS, table[distinct & ((1 << BITS) - 1)], minlength=len(texts))


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every document. The broadcast weights are bounded by the number of buckets."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        table, words = shared.value.table(), WordHashes()
        for b in batches:
            texts = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
            out = [margins(texts[lo:hi], table, shared.value.bias, words) for lo, hi in pieces(texts)]
            margin = np.concatenate(out) if out else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(1 / (1 + np.exp(-np.clip(margin, -35, 35))))], names=["id", "score"]
            )

    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, "id bigint, score double"
    )
