"""Importance resampling towards a target distribution, ranked by parallel sorting by regular sampling.

1. Texts become hashed word n-grams. Counts per bucket of the corpus and of the target texts are summed in
   arrays by the tasks and then over the tasks; their log ratios are one array of ``buckets`` gains.
2. A document's weight is the floored mean gain of its features; its score adds seeded Gumbel noise, so that
   the highest scores are a draw without replacement in proportion to the weights.
3. The scored rows, without texts, are written as locally sorted runs, highest score first. Every run gives
   regularly spaced rows; of all those, sorted, regularly spaced ones become the splitters.
4. The splitters cut every run into segments. Counts per segment and their running sums give the rank at
   which each segment begins, so segments beyond the draw are known and stay where they are.
5. The other segments are exchanged: one segment's pieces meet in one task, are merged there, and a row's rank
   is its segment's beginning plus its place. Splitters are whole (score, id) pairs, so tied scores
   split like others; no segment is above about twice the mean (only rows of equal score and id stay together).

Null texts have no words. A text without features has weight 0. A null id is hashed like the empty text and stands after
all other ids of its score. Rows that repeat count each; equal rows get neighbouring ranks. Texts of any length are
taken whole; they are cut into words in pieces of bounded size. Extra columns are ignored, whatever their names.
Empty tables give an empty result; without target texts every gain falls back on the smoothing.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrivals_mart.llm._common import LOWER, written
from arrivals_mart.operators.lookups import sized_broadcast

BUCKETS = 10_000
MAX_WORDS = 1
SEED = 2024
PERCENT = 10
MIN_WORDS = 20
#: Regular samples of a run at most, and of all runs together: what the driver sorts.
RUN_SAMPLES, ALL_SAMPLES = 256, 200_000
#: Bytes of one text that are cut into words at a time.
PIECE_BYTES = 1 << 20

#: Lower-cases A-Z and blanks every ASCII character that is no digit or letter.
_TO_WORDS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in LOWER)


def words_of(text: str | None) -> Iterator[list[bytes]]:
    """Words of a text in lists of bounded size; a list begins with a whole word."""
    data = (text or "").encode().translate(_TO_WORDS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE_BYTES) if at + PIECE_BYTES < len(data) else -1
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


class Features(dict):
    """word -> bucket, filled as words come by; n-grams beyond single words are hashed each."""

    def __init__(self, max_words: int, buckets: int, entries: int = 1 << 19):
        super().__init__()
        self.max_words, self.buckets, self.entries = max_words, buckets, entries

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.entries:
            self.clear()
        b = self[word] = zlib.crc32(word) % self.buckets
        return b

    def of(self, text: str | None) -> Iterator[tuple[int, np.ndarray]]:
        """(number of words, buckets of the features) per piece of the text; runs cross pieces."""
        carry: list[bytes] = []
        for words in words_of(text):
            found = [np.fromiter(map(self.__getitem__, words), np.int64, len(words))]
            both = carry + words
            for k in range(2, self.max_words + 1):
                first = max(0, len(carry) - k + 1)
                found.append(np.array([
                    zlib.crc32(b" ".join(both[i:i + k])) % self.buckets for i in range(first, len(both) - k + 1)
                ], np.int64))
            carry = both[len(both) - self.max_words + 1:] if self.max_words > 1 else []
            yield len(words), np.concatenate(found)


def bucket_counts(df: DataFrame, text_col: str, max_words: int, buckets: int) -> np.ndarray:
    """Occurrences per bucket over all rows. One row per bucket comes back to the driver."""

    def run(batches):
        features, total = Features(max_words, buckets), np.zeros(buckets, np.int64)
        for b in batches:
            for text in b.column(0).to_pylist():
                for _, found in features.of(text):
                    total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, object)
    for r in df.select(F.col(f"`{text_col}`").cast("string")).mapInArrow(run, "bucket bigint, n bigint").groupBy(
            "bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandfold log ratio of each bucket, one added to every bucket of both sides."""
    s_all, t_all, n = float(source.sum()), float(target.sum()), float(len(source))
    return np.array([
        math.floor(1000 * math.log((float(t) + 1) * (s_all + n) / ((float(s) + 1) * (t_all + n))))
        for s, t in zip(source, target)
    ], np.int64)


def noise(seed: int, doc_id: int | None) -> int:
    """Floored thousandfold Gumbel noise from the first 32 bits of a SHA-256."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(df: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", max_words: int = MAX_WORDS,
           seed: int = SEED) -> DataFrame:
    """(id, n_words, n_features, weight, score) of every row; the gains are an array of fixed length."""
    shared = df.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        features, gain_of = Features(max_words, len(shared.value)), shared.value
        for b in batches:
            ids, rows = b.column(0).to_pylist(), []
            for doc_id, text in zip(ids, b.column(1).to_pylist()):
                n_words = n = total = 0
                for words, found in features.of(text):
                    n_words, n, total = n_words + words, n + len(found), total + int(gain_of[found].sum())
                weight = total // n if n else 0
                rows.append((n_words, n, weight, weight + noise(seed, doc_id)))
            columns = zip(*rows) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.int64()) for c in columns]],
                                             names=["id", "n_words", "n_features", "weight", "score"])

    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, "id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")


def _order() -> list[Column]:
    """Highest score first, ties to the smaller id; the other columns only place rows that repeat an id."""
    return [F.desc("score"), F.asc_nulls_last("id"), F.asc("n_features"), F.asc("weight")]


def _sort_key(score, doc_id) -> tuple[int, int]:
    """Ascends in the order of ranks."""
    return -score, (1 << 63) if doc_id is None else doc_id


def sorted_runs(rows: DataFrame) -> DataFrame:
    """``rows`` as locally sorted runs in a written table: ``run``, and ``place`` in it from 0."""
    runs = rows.sortWithinPartitions(*_order()).withColumns({
        "run": F.spark_partition_id(), "place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
    })
    return written(runs, "resample-runs")


def regular_splitters(runs: DataFrame, segments: int, run_samples: int = RUN_SAMPLES,
                      all_samples: int = ALL_SAMPLES) -> list[tuple[int, int]]:
    """At most ``segments - 1`` splitters from regularly spaced rows of every run.

    The driver sorts at most ``all_samples`` pairs (one per run, if there are more runs than that).
    """
    sizes = runs.groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    n_runs = sizes.count()
    per_run = max(1, min(run_samples, all_samples // max(1, n_runs)))
    step = F.ceil(F.col("n") / per_run)
    # one row per run: broadcast only if that is a bounded number
    sample = runs.join(sized_broadcast(sizes), "run").filter(F.col("place") % step == F.floor(step / 2))
    found = sorted(_sort_key(r["score"], r["id"]) for r in sample.select("score", "id").collect())
    at = np.linspace(0, len(found), segments + 1)[1:-1].astype(int) if found else []
    return sorted({found[i] for i in at})


def _segment_of(splitters: list[tuple[int, int]]):
    """Segment number of each row: how many splitters are at or before it."""
    scores = np.array([s for s, _ in splitters], np.int64)
    ids = np.array([min(i, (1 << 63) - 1) for _, i in splitters], np.int64)

    def run(batches):
        for b in batches:
            score = -np.asarray(b.column("score"))
            doc = np.asarray(b.column("id").fill_null((1 << 63) - 1))
            # equal scores are a range of splitters, decided by the id
            low, high = np.searchsorted(scores, score, "left"), np.searchsorted(scores, score, "right")
            segment = high.copy()
            tied = np.flatnonzero(high > low)
            for i in tied.tolist():
                segment[i] = low[i] + np.searchsorted(ids[low[i]:high[i]], doc[i], "right")
            yield b.append_column("segment", pa.array(segment.astype(np.int64)))

    return run


def ranked(rows: DataFrame, draw: int, segments: int | None = None) -> DataFrame:
    """``rows`` with ``rank`` (1, 2, ... by descending score, ties to the smaller id; null beyond ``draw``).

    ``rows`` has id, n_words, n_features, weight and score.
    """
    spark: SparkSession = rows.sparkSession
    runs = sorted_runs(rows)
    segments = segments or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    splitters = regular_splitters(runs, segments)
    cut = runs.drop("run", "place").mapInArrow(
        _segment_of(splitters), "id bigint, n_words bigint, n_features bigint, weight bigint, score bigint, segment bigint")
    cut = written(cut, "resample-segments")
    sizes = cut.groupBy("segment").agg(F.count(F.lit(1)).alias("n")).collect()  # one row per segment
    begins, seen = {}, 0
    for r in sorted(sizes):
        begins[r["segment"]] = seen
        seen += r["n"]
    wanted = [s for s, b in begins.items() if b < draw]
    last = max(wanted, default=-1)
    begin = spark.createDataFrame([(s, begins[s]) for s in wanted], "segment bigint, begin bigint")
    place = F.row_number().over(Window.partitionBy("segment").orderBy(*_order()))
    # the only exchange of rows: segments that the draw reaches. ``begin`` has one row per segment.
    drawn = cut.filter(F.col("segment") <= last).withColumn("place", place).join(F.broadcast(begin), "segment")
    rank = F.col("begin") + F.col("place")
    drawn = drawn.withColumn("rank", F.when(rank <= draw, rank)).drop("begin", "place")
    rest = cut.filter(F.col("segment") > last).withColumn("rank", F.lit(None).cast("bigint"))
    return drawn.unionByName(rest).drop("segment")


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
             max_words: int = MAX_WORDS, buckets: int = BUCKETS, seed: int = SEED, percent: int = PERCENT,
             min_words: int = MIN_WORDS, segments: int | None = None) -> DataFrame:
    """id, n_words, n_features, weight, score, rank of every row of ``df``.

    Of the N rows with at least ``min_words`` words the floor(percent * N / 100) highest scores are drawn.
    """
    gain = gains(bucket_counts(df, text_col, max_words, buckets), bucket_counts(target, target_text_col, max_words, buckets))
    rows = written(scored(df, gain, id_col, text_col, max_words, seed), "resample-scores")
    long_enough = rows.filter(F.col("n_words") >= min_words)
    out = ranked(long_enough, percent * long_enough.count() // 100, segments)
    short = rows.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("bigint"))
    return out.unionByName(short)


def drawn_documents(df: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``df`` whose id was drawn, all their columns (rows that repeat a drawn id all count as drawn)."""
    ranks = resample(df, target, id_col, **options).filter("rank IS NOT NULL").select(F.col("id").alias("_drawn")).distinct()
    return df.join(ranks, F.col(f"`{id_col}`").eqNullSafe(F.col("_drawn")), "left_semi")
