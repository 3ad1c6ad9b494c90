import hashlib
import random

import numpy as np
import pytest

from arrivals_mart.llm import anchor_dedup as A

from .data import LONG, clashing, docs, empty


def brute(rows, window=A.WINDOW):
    words = [(r[1] or "").encode().split() for r in rows]
    first = {}
    for (i, *_), w in zip(rows, words):
        if i is not None:
            for k in range(len(w) - window + 1):
                key = tuple(w[k:k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for (i, *_), w in zip(rows, words):
        gone = set()
        if i is not None:
            for k in range(len(w) - window + 1):
                if first[tuple(w[k:k + window])] < i:
                    gone.update(range(k, k + window))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), kept.decode()))
    return sorted(out, key=repr)


def repeats(seed, n=60, pool=200):
    """Documents pieced together from shared passages of 20 to 150 words."""
    rng = random.Random(seed)
    passages = [[f"w{rng.randrange(pool)}" for _ in range(rng.randint(20, 150))] for _ in range(12)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            words += rng.choice([p, p[a:], p[:a], [f"u{rng.randrange(10**6)}" for _ in range(rng.randint(1, 60))]])
        rows.append((rng.randrange(n), " \n".join(words), "en", "a", None))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_removed_words_match_brute_force(spark, seed):
    rows = repeats(seed)
    got = sorted((tuple(r) for r in A.drop_repeats(docs(spark, rows).repartition(4)).collect()), key=repr)
    assert got == brute(rows)
    assert sum(r[2] for r in got) > 500


def test_passages_of_few_distinct_words(spark):
    rows = [(i, "a b " * (20 + 7 * i), "en", "a", 1) for i in range(8)] + [(20, "a " * 300, "en", "a", 1), (21, "a " * 49, "en", "a", 1)]
    got = sorted((tuple(r) for r in A.drop_repeats(docs(spark, rows)).collect()), key=repr)
    assert got == brute(rows)


def test_many_routes_and_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(A, "ENTRIES", 50)
    monkeypatch.setattr(A, "PIECE_BYTES", 500)
    rows = repeats(5, 40)
    got = sorted((tuple(r) for r in A.drop_repeats(docs(spark, rows).repartition(3)).collect()), key=repr)
    assert got == brute(rows)


def test_several_routes_a_task(spark, monkeypatch):
    monkeypatch.setattr(A, "ENTRIES", 50)
    monkeypatch.setattr(A, "PIECE_BYTES", 500)
    monkeypatch.setattr(A, "MAX_TASKS", 3)
    rows = repeats(6, 40)
    got = sorted((tuple(r) for r in A.drop_repeats(docs(spark, rows).repartition(3)).collect()), key=repr)
    assert got == brute(rows)


def _part(ids, keys, pos, windows):
    n = len(ids)
    e = {"id": np.array(ids, np.int64), "crc": np.zeros(n, np.int64), "pos": np.array(pos, np.uint32)}
    keys = np.array(keys, np.uint64)
    return {**e, "one": keys, "two": keys} if windows else {**e, "hash": keys}


@pytest.mark.parametrize("windows", [True, False])
def test_rounds_find_what_one_round_finds(monkeypatch, windows):
    monkeypatch.setattr(A, "ENTRIES", 40)
    settle = A._repeats if windows else A._hits
    rng = np.random.default_rng(4)
    for _ in range(50):
        parts = [_part(*rng.integers(0, [[30], [12], [40]], (3, 15)), windows) for _ in range(20)]
        whole = A._joined(parts)
        expected = A._chosen(whole, settle(whole)[0])
        held, found = A.Entries(settle), []
        for p in parts:
            if held.add(p):
                found.append(held.round())
        found.append(held.round())
        got = A._joined(found)
        key = "one" if windows else "hash"
        assert sorted(zip(*(got[c].tolist() for c in ("id", "pos", key)))) == sorted(
            zip(*(expected[c].tolist() for c in ("id", "pos", key))))


@pytest.mark.parametrize("windows", [True, False])
def test_a_hot_passage_is_held_a_few_times(monkeypatch, windows):
    monkeypatch.setattr(A, "ENTRIES", 1000)
    held = A.Entries(A._repeats if windows else A._hits)
    order = np.random.default_rng(5).permutation(200_000)
    most = 0
    for at in range(0, len(order), 100):
        ids = order[at:at + 100]
        if held.add(_part(ids, np.full(100, 7), ids % 97, windows)):
            held.round()
            assert held.n < 500
        most = max(most, held.n)
    assert most <= 1000


def test_packed_columns_come_back():
    rng = np.random.default_rng(6)
    for kinds in (A.GRAMS, A.WINDOWS, A.FINDINGS):
        for n in (0, 1, 1000):
            e = {c: rng.integers(0, 2 if t == "?" else 1 << 31, n).astype(t) for c, t in kinds.items()}
            back = A._unpack(A._pack(e, kinds), kinds)
            assert all((back[c] == e[c]).all() and back[c].dtype == e[c].dtype for c in kinds)


def test_awkward_rows_and_empty_table(spark):
    rows = [tuple(r) for r in docs(spark).collect()]
    got = sorted((tuple(r) for r in A.drop_repeats(clashing(docs(spark))).collect()), key=repr)
    assert got == brute(rows)
    by_id = {r[0]: r for r in got}
    assert by_id[10][1] == len(LONG.split()) + 1 and by_id[10][2:] == (20_000, "end")
    digests = {r.id: r.kept for r in A.drop_repeats(docs(spark), texts=False).collect()}
    assert digests[12] == hashlib.sha256(by_id[12][3].encode()).hexdigest()
    assert A.drop_repeats(empty(spark)).count() == 0


def test_every_shared_window_has_a_common_anchor():
    rng = np.random.default_rng(0)
    for _ in range(200):
        shared = rng.integers(0, 1 << 62, A.WINDOW).astype(np.uint64)
        docs_ = [np.concatenate([rng.integers(0, 1 << 62, rng.integers(0, 40)).astype(np.uint64), shared,
                                 rng.integers(0, 1 << 62, rng.integers(0, 40)).astype(np.uint64)]) for _ in range(2)]
        found = []
        for h in docs_:
            pos, n = np.arange(len(h)), np.full(len(h), len(h))
            where, grams = A.anchors(h, pos, n)
            found.append((where, grams))
        blocks = {g for p, g in zip(*found[0]) if p % A.BLOCK == 0}
        assert blocks & set(found[1][1].tolist())


def test_rolling_hash_is_the_same_wherever_words_stand():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 62, 300).astype(np.uint64)
    for base in A._BASES:
        x = A.rolling(np.concatenate([h, h[:77], h]), 50, base)
        assert (x[:251] == x[377:377 + 251]).all() and len(np.unique(x[:251])) == 251
