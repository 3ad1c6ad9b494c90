"""Document quality by a linear-chain conditional random field over lines.

Each line is good or bad. A line's score is linear in its own features and in those of
the line before and after it; neighbouring labels share transition weights. Training takes
the lines of a labelled document to have the document's label and maximises the
conditional likelihood of the label chains. Scoring runs forward-backward over the whole
document; its quality is the mean marginal of "good", weighted by line length.

Features are rates of kinds of characters and of words that repeat the word before them. The
model is a few dozen numbers. Null texts count as empty; an empty text is one line of
length 0 and gets that line's marginal. Every line weighs its bytes plus one. Without
labelled rows the model is all zeros and every score 0.5. Repeated rows score alike. Texts of any length are scored
whole, a line at a time; training cuts chains of more than ``TRAINING_CHAIN`` lines (the labels of the lines at a cut are then
learned without each other) and takes documents up to a bound on their bytes. Extra columns stay in a struct or
are not read, so their names cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals_mart.llm._common import held_out, struct_of, written

#: Bound on labelled documents per label that the model is fitted on.
SAMPLE_PER_LABEL = 1500
#: Bound on the bytes of their features, which the driver gathers.
SAMPLE_BYTES = 96 << 20
#: Training cuts longer chains of lines here; scoring never cuts.
TRAINING_CHAIN = 96
ROUNDS = 200
PIECE_BYTES = 8 << 20

# Capitals, digits, symbols, bars, shouts, stops, bytes beyond ASCII, all visible bytes.
_KINDS = [
    range(65, 91), range(48, 58), b"#$%&*@^~`<>{}[]\\+=_/", b"|", b"!?", b".,;:", range(128, 256), range(33, 256),
]
_TABLES = [np.isin(np.arange(256), list(kind)).astype(np.uint8) for kind in _KINDS]
_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)], bool)
N_FEATURES = 10


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features per line, bytes per line, lines per text) of all lines of all texts."""
    buffer = b"\n".join(texts) + b"\n"
    data = np.frombuffer(buffer, np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    length = ends - starts
    counts = [np.add.reduceat(table[data], starts, dtype=np.int32) for table in _TABLES]
    space = _SPACE[data]
    word_at = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    words = buffer.split()
    line_of = np.searchsorted(ends, word_at)
    hashes = np.fromiter(map(hash, words), np.int64, len(words))
    n_words = np.bincount(line_of, minlength=len(ends))
    again = np.zeros(len(words), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
    again[2:] |= (hashes[2:] == hashes[:-2]) & (line_of[2:] == line_of[:-2])
    repeats = np.bincount(line_of[again], minlength=len(ends))
    visible, w = np.maximum(counts[7], 1), np.maximum(n_words, 1)
    features = np.stack([
        counts[0] / visible, counts[1] / visible, counts[2] / visible,
        np.minimum(counts[3] / w, 1), np.minimum(counts[4] / w, 1), np.minimum(counts[5] / w, 1),
        counts[6] / visible, repeats / w,
        np.minimum(np.log1p(length) / 8, 2), np.minimum(counts[7] / w / 10, 3),
    ], 1)
    lines = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
    return features, length, lines


def with_neighbours(features: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """A line's features beside those of the lines before and after it in its document, and a constant."""
    n = len(features)
    before, after = np.zeros_like(features), np.zeros_like(features)
    before[1:], after[:-1] = features[:-1], features[1:]
    ends = np.cumsum(lines)
    before[np.concatenate([[0], ends[:-1]]).astype(np.int64)] = 0
    after[ends - 1] = 0
    return np.concatenate([features, before, after, np.ones((n, 1))], 1)


@dataclass
class Model:
    """``weights`` of "good" on the features; ``trans[a, b]`` of label b after a."""

    weights: np.ndarray
    trans: np.ndarray

    @classmethod
    def zeros(cls) -> "Model":
        return cls(np.zeros(3 * N_FEATURES + 1), np.zeros((2, 2)))


def forward_backward(score: np.ndarray, lines: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(marginal of "good" per line, expected transition counts) of chains laid end to end.

    Chains advance together, longest first, so the work is vectorised over chains.
    """
    order = np.argsort(-lines, kind="stable")
    begin = np.concatenate([[0], np.cumsum(lines)[:-1]]).astype(np.int64)[order]
    size = lines[order]
    longest = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(1, longest + 1), side="right")
    half = np.clip(score, -60, 60) / 2
    emit = np.exp(np.stack([-half, half], 1))
    step = np.exp(trans)
    alpha = np.empty((len(score), 2))
    now = None
    for t in range(longest):
        at = begin[:active[t]] + t
        now = emit[at] if t == 0 else (now[:active[t]] @ step) * emit[at]
        now = now / now.sum(1, keepdims=True)
        alpha[at] = now
    beta = np.ones((len(score), 2))
    pairs = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        at = begin[:active[t + 1]] + t
        ahead = emit[at + 1] * beta[at + 1]
        back = ahead @ step.T
        joint = alpha[at][:, :, None] * step * ahead[:, None, :]
        pairs += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
        beta[at] = back / back.sum(1, keepdims=True)
    both = alpha * beta
    return both[:, 1] / both.sum(1), pairs


def fit(features: np.ndarray, lines: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS, l2: float = 1e-4) -> Model:
    """Maximise the conditional likelihood by adaptive gradient steps. ``labels`` are per chain."""
    model = Model.zeros()
    if not len(lines):
        return model
    cut = [np.diff([*range(0, n, TRAINING_CHAIN), n]) for n in lines]
    chain_label = np.repeat(labels, [len(c) for c in cut])
    chains = np.concatenate(cut)
    x, y = with_neighbours(features, lines), np.repeat(labels, lines).astype(float)
    both = max((labels == 0).sum(), 1), max((labels == 1).sum(), 1)
    seen = np.zeros((2, 2))
    for v in (0, 1):
        seen[v, v] = (chains[chain_label == v] - 1).sum()
    scale = 1 / len(y)
    theta = np.concatenate([model.weights, model.trans.ravel()])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    theta[len(model.weights) - 1] = np.log(both[1] / both[0]) / 4
    for k in range(1, rounds + 1):
        w, trans = theta[:-4], theta[-4:].reshape(2, 2)
        p, pairs = forward_backward(x @ w, chains, trans)
        grad = np.concatenate([x.T @ (p - y) * scale, ((pairs - seen) * scale).ravel()]) + l2 * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta - 0.2 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
        theta[-4:] = np.clip(theta[-4:], -3, 3)
    return Model(theta[:-4], theta[-4:].reshape(2, 2))


def pieces(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about PIECE_BYTES together."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total > PIECE_BYTES:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def document_scores(texts: list[bytes], model: Model) -> np.ndarray:
    """Length-weighted mean marginal of "good" per text."""
    features, length, lines = line_features(texts)
    good, _ = forward_backward(with_neighbours(features, lines) @ model.weights, lines, model.trans)
    weight = length + 1.0
    starts = np.concatenate([[0], np.cumsum(lines)[:-1]]).astype(np.int64)
    return np.clip(np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts), 0, 1)


def labelled_sample(labels: DataFrame, label_col: str, id_col: str, per_label: int) -> DataFrame:
    """At most ``per_label`` ids of each label 0 and 1, in hash order, none of them held out."""
    own = labels.select(F.col(f"`{id_col}`").alias("sample_id"), F.col(f"`{label_col}`").cast("int").alias("y"))
    own = own.filter("sample_id IS NOT NULL AND y IN (0, 1)").filter(~held_out("sample_id"))
    own = own.groupBy("sample_id").agg(F.max("y").alias("y"))
    some = [own.filter(F.col("y") == v).orderBy(F.xxhash64("sample_id"), "sample_id").limit(per_label) for v in (0, 1)]
    return some[0].unionByName(some[1])


def bounded_rows(rows: DataFrame, most_bytes: int) -> list:
    """Rows (id, x, ...) in the order of their ids' hashes, as long as all ``x`` together stay within ``most_bytes``.

    Documents that would take up more than a 64th of it come last. Only lengths pass one task, those of a bounded sample.
    """
    rows = written(rows, "training-rows")
    sizes = rows.groupBy("id").agg(F.sum(F.length("x")).alias("size"))  # at most one per sampled id
    order = Window.orderBy(F.col("size") > most_bytes // 64, F.xxhash64("id"), "id").rowsBetween(Window.unboundedPreceding, 0)
    within = sizes.withColumn("upto", F.sum("size").over(order)).filter(F.col("upto") <= most_bytes).select("id")
    found = rows.join(F.broadcast(within), "id").collect()
    return sorted(found, key=lambda r: (r["id"], bytes(r["x"])))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", per_label: int = SAMPLE_PER_LABEL, most_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on a sample bounded in documents and in bytes of features; the tasks send line features, not texts."""
    sample = labelled_sample(labels, label_col, id_col, per_label)

    def run(batches):
        for b in batches:
            for i, text in enumerate(b.column("text").cast(pa.binary()).to_pylist()):
                x, _, _ = line_features([text or b""])
                yield pa.RecordBatch.from_pydict({
                    "id": b.column("id").slice(i, 1), "y": b.column("y").slice(i, 1), "n": pa.array([len(x)]),
                    "x": pa.array([x.astype("<f4").tobytes()], pa.binary()),
                })

    ident, text = F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")
    rows = (
        docs.select(ident, text).join(F.broadcast(sample), F.col("id") == F.col("sample_id")).select("id", "y", "text")
        .mapInArrow(run, "id bigint, y int, n bigint, x binary")
    )
    rows = bounded_rows(rows, most_bytes)
    if not rows:
        return Model.zeros()
    features = np.concatenate([np.frombuffer(r["x"], "<f4").reshape(-1, N_FEATURES) for r in rows]).astype(float)
    return fit(features, np.array([r["n"] for r in rows]), np.array([r["y"] for r in rows]))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``row`` (all columns but the text), ``text`` and ``score`` of every document."""
    row, row_type = struct_of(docs, text_col)
    schema = T.StructType([
        T.StructField("row", row_type), T.StructField("text", T.StringType()), T.StructField("score", T.DoubleType())
    ])

    def run(batches):
        for b in batches:
            texts = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
            out = [document_scores(texts[lo:hi], model) for lo, hi in pieces(texts)]
            scores = pa.array(np.concatenate(out) if out else np.zeros(0))
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("text"), scores], names=["row", "text", "score"])

    return docs.select(row.alias("row"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, schema)


def scores_only(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every document; texts do not come back from the tasks."""

    def run(batches):
        for b in batches:
            texts = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
            out = [document_scores(texts[lo:hi], model) for lo, hi in pieces(texts)]
            scores = pa.array(np.concatenate(out) if out else np.zeros(0))
            yield pa.RecordBatch.from_arrays([b.column("id"), scores], names=["id", "score"])

    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(
        run, "id bigint, score double"
    )


def keep_good(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Whole rows of ``docs`` whose score is at least ``threshold``."""
    kept = score(docs, model, text_col).filter(F.col("score") >= threshold)
    return kept.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
