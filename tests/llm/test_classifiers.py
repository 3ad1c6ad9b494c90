import itertools
import random
import zlib

import numpy as np
import pytest

from arrivals_mart.llm import quality_crf as Q
from arrivals_mart.llm import toxicity_ftrl as X
from arrivals_mart.llm._common import held_out

from .data import LONG, clashing, docs, empty


def brute_marginals(score, trans):
    """Probability of "good" per line by summing over all label sequences."""
    total, good = 0.0, np.zeros(len(score))
    for labels in itertools.product((0, 1), repeat=len(score)):
        w = sum(s / 2 if y else -s / 2 for s, y in zip(score, labels)) + sum(trans[a, b] for a, b in zip(labels, labels[1:]))
        total += np.exp(w)
        good += np.exp(w) * np.array(labels)
    return good / total


def test_forward_backward_matches_the_sum_over_all_sequences():
    rng = np.random.default_rng(0)
    lines = np.array([3, 1, 6, 2, 6])
    score, trans = rng.normal(0, 2, lines.sum()), rng.normal(0, 1, (2, 2))
    got, pairs = Q.forward_backward(score, lines, trans)
    at = 0
    for n in lines:
        assert np.allclose(got[at:at + n], brute_marginals(score[at:at + n], trans))
        at += n
    assert pairs.sum() == pytest.approx((lines - 1).sum())


def test_gradient_of_the_likelihood():
    rng = np.random.default_rng(1)
    lines, y = np.array([4, 3]), np.array([0, 0, 0, 0, 1, 1, 1])
    x, w, trans = rng.normal(0, 1, (7, 3)), rng.normal(0, 1, 3), rng.normal(0, 1, (2, 2))

    def likelihood(w, trans):
        out, at = 0.0, 0
        for n in lines:
            s = x[at:at + n] @ w
            weights = {
                labels: sum(v / 2 if k else -v / 2 for v, k in zip(s, labels)) + sum(trans[a, b] for a, b in zip(labels, labels[1:]))
                for labels in itertools.product((0, 1), repeat=int(n))
            }
            out += weights[tuple(y[at:at + n])] - np.log(sum(map(np.exp, weights.values())))
            at += n
        return out

    p, pairs = Q.forward_backward(x @ w, lines, trans)
    seen = np.diag([3.0, 2.0])
    step = 1e-6
    for i in range(3):
        d = np.eye(3)[i] * step
        assert (likelihood(w + d, trans) - likelihood(w - d, trans)) / (2 * step) == pytest.approx((x.T @ (y - p))[i], abs=1e-4)
    for a, b in itertools.product((0, 1), repeat=2):
        d = np.zeros((2, 2))
        d[a, b] = step
        assert (likelihood(w, trans + d) - likelihood(w, trans - d)) / (2 * step) == pytest.approx((seen - pairs)[a, b], abs=1e-4)


def test_line_features_count_what_they_say():
    f, length, lines = Q.line_features([b"AB cd cd\n12 | 3!", b"", b"one"])
    assert lines.tolist() == [2, 1, 1] and length.tolist() == [8, 7, 0, 3]
    assert f[0, 0] == pytest.approx(2 / 6) and f[0, 7] == pytest.approx(1 / 3)
    assert f[1, 1] == pytest.approx(3 / 5) and f[1, 3] == pytest.approx(1 / 3) and f[1, 4] == pytest.approx(1 / 3)
    x = Q.with_neighbours(f, lines)
    n = Q.N_FEATURES
    assert (x[0, n:2 * n] == 0).all() and (x[0, 2 * n:3 * n] == f[1]).all() and (x[1, n:2 * n] == f[0]).all()
    assert (x[1, 2 * n:3 * n] == 0).all()  # the next line is another document's


def labelled(seed, n=240):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        good, toxic = rng.random() < 0.6, rng.random() < 0.4
        text = [[rng.choice(words) for _ in range(rng.randint(3, 15))] for _ in range(rng.randint(1, 8))]
        if toxic:
            for _ in range(2):
                rng.choice(text).append(rng.choice(["vile", "rotten", "Foul!"]))
        rows.append((i, "\n".join(" ".join(w if good else w + "###" for w in line) + "." for line in text), "en", "a", None))
        labels.append((i, int(good), int(toxic)))
    return rows, labels


LABELS = "doc_id bigint, quality int, toxic int"


def accuracy(scored, labels, at, threshold):
    truth = {r[0]: r[at] for r in labels}
    out = [(r.score >= threshold) == bool(truth[r.id]) for r in scored if zlib.crc32(str(r.id).encode()) % 3 == 1]
    return sum(out) / len(out)


def test_held_out_rows_are_the_crc_rows(spark):
    got = {r.doc_id: r.h for r in docs(spark).select("doc_id", held_out("doc_id").alias("h")).collect() if r.doc_id is not None}
    assert got == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in got}


def test_quality_of_held_out_documents(spark):
    rows, labels = labelled(1)
    df, table = docs(spark, rows), spark.createDataFrame(labels, LABELS)
    model = Q.train(df, table)
    scored = Q.scores_only(df, model).collect()
    assert accuracy(scored, labels, 1, 0.5) > 0.95
    assert all(0 <= r.score <= 1 for r in scored)
    good = {r.id for r in scored if r.score >= 0.5}
    kept = Q.keep_good(clashing(df), model)
    assert {r.doc_id for r in kept.collect()} == good and kept.columns == clashing(df).columns
    # held-out labels have no say
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in labels]
    again = Q.train(df, spark.createDataFrame(flipped, LABELS))
    assert (again.weights == model.weights).all()


def test_toxicity_of_held_out_documents(spark):
    rows, labels = labelled(2)
    df, table = docs(spark, rows), spark.createDataFrame(labels, LABELS)
    model = X.train(df, table)
    assert 0 < len(model.buckets) < 400
    scored = X.scores(df, model).collect()
    assert accuracy(scored, labels, 2, 0.7) > 0.95
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    again = X.train(df, spark.createDataFrame(flipped, LABELS))
    assert (again.weights == model.weights).all()


def test_score_is_the_sum_over_distinct_features():
    rng = np.random.default_rng(3)
    table = (rng.random(1 << X.BITS) - 0.5).astype(np.float32)
    words = X.WordHashes()
    texts = [b"a b c a b c", b"", b"one", b"two two", b"c a b"]
    got = X.margins(texts, table, 0.25, words)
    for text, g in zip(texts, got):
        distinct = np.unique(np.concatenate(X.feature_hashes(X._word_hashes(text, words))))
        assert g == pytest.approx(0.25 + table[distinct].sum(), abs=1e-5)
    assert words[b"Foul!"] == words[b"foul"]


def test_awkward_rows_and_empty_tables(spark):
    rows, labels = labelled(3, 60)
    table = spark.createDataFrame([*labels, (None, 1, 1), (2, None, None), (3, 0, 1), (3, 0, 1), (99999, 1, 0)], LABELS)
    for module in (Q, X):
        model = module.train(docs(spark, rows), table)
        score = module.scores_only if module is Q else module.scores
        got = score(clashing(docs(spark)), model).collect()
        assert len(got) == docs(spark).count() and all(0 <= r.score <= 1 for r in got)
        by_id = {r.id: r.score for r in got}
        assert by_id[4] == by_id[5]  # null counts as empty
        assert score(empty(spark), model).count() == 0
        nothing = module.train(docs(spark, rows), spark.createDataFrame([], LABELS))
        assert {r.score for r in score(docs(spark), nothing).collect()} == {0.5}
    assert Q.document_scores([LONG.encode()], Q.Model.zeros()).tolist() == [0.5]


def test_document_score_is_the_length_weighted_mean_of_brute_force_marginals():
    rng = np.random.default_rng(3)
    model = Q.Model(rng.normal(0, 0.7, 3 * Q.N_FEATURES + 1), rng.normal(0, 0.8, (2, 2)))
    texts = [b"One line only.", b"", b"first LINE!\n\nthird | 33 ### a a a\nlast", "é è\nWORD word word".encode(), b"\n\n"]
    for text, got in zip(texts, Q.document_scores(texts, model)):
        features = [Q.line_features([line])[0][0] for line in text.split(b"\n")]
        zero = np.zeros(Q.N_FEATURES)
        score = [
            np.concatenate([features[i - 1] if i else zero, f, features[i + 1] if i + 1 < len(features) else zero])
            for i, f in enumerate(features)
        ]
        order = np.concatenate([np.arange(Q.N_FEATURES, 2 * Q.N_FEATURES), np.arange(Q.N_FEATURES), np.arange(2 * Q.N_FEATURES, 3 * Q.N_FEATURES)])
        line_scores = np.array([x[order] @ model.weights[:-1] + model.weights[-1] for x in score])
        weight = np.array([len(line) + 1 for line in text.split(b"\n")])
        want = (brute_marginals(line_scores, model.trans) * weight).sum() / weight.sum()
        assert got == pytest.approx(want, abs=1e-12)


def test_ftrl_recurrence_equals_one_coordinate_at_a_time(monkeypatch):
    monkeypatch.setattr(X, "BITS", 5)
    monkeypatch.setattr(X, "L1", 0.6)
    rng = np.random.default_rng(4)
    documents = [np.unique(rng.integers(0, 32, int(rng.integers(1, 9)))).astype("<u4") for _ in range(40)]
    labels = rng.integers(0, 2, 40).astype(float)
    z, n = [0.0] * 33, [0.0] * 33

    def weight(i):
        scale = (X.BETA + n[i] ** 0.5) / X.ALPHA + X.L2
        if i == 32:  # the bias has no L1
            return -z[i] / scale
        return 0.0 if abs(z[i]) <= X.L1 else -(z[i] - np.sign(z[i]) * X.L1) / scale

    order = np.random.default_rng(7)
    for _ in range(X.EPOCHS):
        for k in order.permutation(40):
            active = [*documents[k].tolist(), 32]
            w = {i: weight(i) for i in active}
            g = 1 / (1 + np.exp(-sum(w.values()))) - labels[k]
            for i in active:
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / X.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
    model = X.fit(documents, labels)
    want = {i: weight(i) for i in range(32) if weight(i) != 0}
    fitted = [v for v in vars(model).values()]
    assert dict(zip(fitted[0].tolist(), fitted[1].tolist())) == pytest.approx(want, rel=1e-5)
    assert 0 < len(want) < 32 and fitted[2] == pytest.approx(weight(32))


def test_training_rows_stay_within_their_bytes(spark):
    rows = [(i, 0, bytes(100)) for i in range(50)] + [(90, 1, bytes(5000))] + [(91, 1, bytes(50))] * 40 + [(None, 1, b"x")]
    df = spark.createDataFrame(rows, "id bigint, y int, x binary")
    got = Q.bounded_rows(df, 3000)
    assert sum(len(r.x) for r in got) <= 3000 and len(got) >= 9
    assert {r.id for r in got} <= set(range(50)) | {91} and [r.id for r in got] == sorted(r.id for r in got)
    assert {tuple(r) for r in Q.bounded_rows(df.repartition(5), 3000)} == {tuple(r) for r in got}
    assert len(Q.bounded_rows(df, 10**6)) == 91 and Q.bounded_rows(df.limit(0), 10) == []
