import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from arrivals_mart.llm import queries as Q
from arrivals_mart.llm import target_resample as R

from .data import DOCS, LONG, clashing, corpus, docs, empty

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text, max_words):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i:i + k]) for k in range(1, max_words + 1) for i in range(len(words) - k + 1)]


def brute(rows, target, max_words=1, buckets=10_000, seed=2024, percent=10, min_words=20):
    """(id, n_features, weight, score, rank) by plain counting; ``rows`` are (id, text)."""
    def crc(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = [0] * buckets, [0] * buckets
    for _, text in rows:
        for f in features(text, max_words)[1]:
            s[crc(f)] += 1
    for text in target:
        for f in features(text, max_words)[1]:
            t[crc(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    out, able = [], []
    for doc_id, text in rows:
        words, found = features(text, max_words)
        weight = sum(gain[crc(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None])
        if len(words) >= min_words:
            able.append(out[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for i, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = i + 1
    return sorted(map(tuple, out), key=repr)


def result(df):
    return sorted((tuple(r) for r in df.select("id", "n_features", "weight", "score", "rank").collect()), key=repr)


def target_of(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id bigint, text string")


@pytest.mark.parametrize("seed,max_words,percent,segments", [(1, 1, 10, None), (2, 3, 50, 5), (3, 2, 100, 40), (4, 1, 0, 3)])
def test_equals_plain_counting(spark, seed, max_words, percent, segments, monkeypatch):
    monkeypatch.setattr(R, "PIECE_BYTES", 50)
    rows = corpus(seed, 200, 60)
    target = [r[1] for r in corpus(seed + 100, 30, 40)]
    got = R.resample(docs(spark, rows).repartition(7), target_of(spark, target), max_words=max_words, buckets=97,
                     percent=percent, segments=segments)
    assert result(got) == brute([(r[0], r[1]) for r in rows], target, max_words, 97, 2024, percent)


def test_the_query_over_all_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = Q.op13_resample(spark, sf)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, target)


def ranks_of(spark, rows, draw, segments, partitions):
    frame = spark.createDataFrame(rows, "id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")
    return {r.id: r["rank"] for r in R.ranked(frame.repartition(partitions), draw, segments).collect()}


@pytest.mark.parametrize("scores", ["equal", "few", "all"])
def test_ranks_are_exact_with_ties(spark, scores):
    rng = random.Random(3)
    pick = {"equal": lambda: 7, "few": lambda: rng.choice([1, 2, 2, 2]), "all": lambda: rng.randint(-10**6, 10**6)}[scores]
    rows = [(i, 20, 20, 0, pick()) for i in range(-500, 1500)]
    rng.shuffle(rows)
    order = sorted(rows, key=lambda r: (-r[4], r[0]))
    want = {r[0]: i + 1 if i < 700 else None for i, r in enumerate(order)}
    assert ranks_of(spark, rows, 700, 16, 6) == want


def test_tied_scores_split_into_even_segments(spark):
    frame = spark.createDataFrame([(i, 20, 20, 0, 7) for i in range(4000)],
                                  "id bigint, n_words bigint, n_features bigint, weight bigint, score bigint")
    runs = R.sorted_runs(frame.repartition(6))
    splitters = R.regular_splitters(runs, 16)
    cut = runs.drop("run", "place").mapInArrow(
        R._segment_of(splitters), "id bigint, n_words bigint, n_features bigint, weight bigint, score bigint, segment bigint")
    sizes = [r["count"] for r in cut.groupBy("segment").count().collect()]
    assert len(sizes) == 16 and max(sizes) <= 2 * 4000 / 16


def test_awkward_rows_clashing_columns_and_empty_tables(spark):
    target = target_of(spark, ["Hello world", None, ""])
    got = R.resample(clashing(docs(spark)), target, percent=60)
    assert result(got) == brute([(r[0], r[1]) for r in DOCS], ["Hello world"], percent=60)
    assert R.resample(empty(spark), target).count() == 0
    none = target.limit(0)
    assert result(R.resample(docs(spark), none)) == brute([(r[0], r[1]) for r in DOCS], [])


def test_drawn_documents_keep_their_columns(spark):
    df = clashing(docs(spark))
    target = target_of(spark, [LONG])
    out = R.drawn_documents(df, target, percent=50)
    assert out.columns == df.columns
    want = {r[0] for r in brute([(r[0], r[1]) for r in DOCS], [LONG], percent=50) if r[4]}
    assert {r.doc_id for r in out.select("doc_id").collect()} == want
    assert R.drawn_documents(df, target, percent=0).select(F.count("*")).first()[0] == 0
