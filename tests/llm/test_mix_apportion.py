import re

import numpy as np
import pytest

from arrivals_mart.llm import mix_apportion as M

from .data import clashing, docs, empty


def test_targets_share_by_weight_and_stop_at_three_times_the_size():
    assert M.targets([100, 100, 100], [5, 2, 1]) == [187.5, 75.0, 37.5]
    got = M.targets([10, 1000, 1000], [5, 2, 1])
    assert got[0] == 30 and got[1] == pytest.approx(1980 * 2 / 3) and got[2] == pytest.approx(660)
    assert M.targets([], []) == [] and M.targets([0, 0], [5, 2]) == [0, 0]


def test_seats_go_to_the_highest_quotients():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n = int(rng.integers(1, 8))
        weights, caps = rng.integers(0, 50, n).astype(float), rng.integers(0, 30, n)
        seats = int(rng.integers(0, 60))
        want = np.zeros(n, int)
        for _ in range(seats):
            open_ = [i for i in range(n) if want[i] < caps[i] and weights[i] > 0]
            if not open_:
                break
            want[max(open_, key=lambda i: (weights[i] / (2 * want[i] + 1), -i))] += 1
        assert M.sainte_lague(weights, caps, seats).tolist() == want.tolist()


def rows_of(n, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, " ".join(["w"] * int(rng.integers(0, 400))), "en", ["a", "b", "c", None][int(rng.integers(0, 4)) % (1 + i % 4)], None)
            for i in range(n)]


def check(rows, got):
    size = {}
    for r in rows:
        size[r[3]] = size.get(r[3], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    goal = dict(zip(names, M.targets([size[s] for s in names], [M.WEIGHTS[i % 3] for i in range(len(names))])))
    taken = dict.fromkeys(names, 0)
    source = {}
    for r in rows:
        source.setdefault(r[0], r[3])
    for r in got:
        s = source[r.id]
        assert r.source_size == size[s] and r.target == pytest.approx(goal[s])
        assert 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    for s in names:
        assert abs(taken[s] - goal[s]) <= max(2, 0.02 * goal[s]), (s, taken[s], goal[s])
    assert abs(sum(taken.values()) - sum(size.values())) <= max(M.BLOCK_WORDS, 0.002 * sum(size.values()))


def test_taken_words_come_near_the_targets(spark):
    rows = rows_of(400)
    check(rows, M.mix(docs(spark, rows)).collect())


def test_many_shards_and_reruns_agree(spark, monkeypatch):
    monkeypatch.setattr(M, "SHARD_WORDS", 500)
    rows = rows_of(400, 1)
    df = docs(spark, rows)
    sized = df.select(M._sized(df, "doc_id", "text", "source"))
    sources, shards = M.quotas(spark, sized, shard_words=2000)
    assert shards.count() > 20
    one = sorted(tuple(r) for r in M.mixed(sized, sources, shards).select("id", "taken").collect())
    check(rows, M.mixed(sized, sources, shards).collect())
    two = sorted(tuple(r) for r in M.mixed(sized.repartition(7), *M.quotas(spark, sized.repartition(5), shard_words=2000)).select("id", "taken").collect())
    assert one == two
    total = sum(t for _, t in one)
    assert abs(total - sum(r.size for r in sized.collect())) < 0.02 * total


def test_the_mix_repeats_whole_documents(spark):
    rows = rows_of(300, 2)
    df = clashing(docs(spark, rows))
    taken = {r.id: (r.size, r.taken) for r in M.mix(df).collect()}
    out = M.mix_documents(df)
    assert out.columns == df.columns
    copies = {}
    for r in out.collect():
        assert r.text == rows[r.doc_id][1]
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
    for i, (size, t) in taken.items():
        assert abs(copies.get(i, 0) - (t / size if size else 0)) <= 0.5 + 1e-9, (i, size, t, copies.get(i))


def test_awkward_rows_and_empty_table(spark):
    got = M.mix(docs(spark)).collect()
    assert len(got) == docs(spark).count()
    assert all(r.taken == 0 for r in got if r.size == 0)
    assert {r.size for r in got if r.id in (4, 5, 14)} == {0}
    assert M.mix(empty(spark)).count() == 0 and M.mix_documents(empty(spark)).count() == 0
    blank = docs(spark, [(1, "", "en", "a", 0), (2, None, "en", None, 0)])
    assert [(r.taken, r.target) for r in M.mix(blank).collect()] == [(0, 0.0)] * 2


def hosts(n, least, most, seed=0):
    """One to three documents for each of ``n`` sources."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        for _ in range(int(rng.integers(1, 4))):
            rows.append((len(rows), " ".join(["w"] * int(rng.integers(least, most + 1))), "en", f"host{i:04d}" if i else None, None))
    return rows


def test_many_small_sources_come_near_their_targets(spark):
    rows = hosts(1000, 5, 500)
    check(rows, M.mix(docs(spark, rows)).collect())


def test_sources_of_ten_words(spark):
    rows = [(i, "a b c d e f g h i j", "en", f"s{i:03d}", None) for i in range(1000)]
    got = M.mix(docs(spark, rows)).collect()
    check(rows, got)
    assert sum(r.taken for r in got) == 10_000


def test_small_and_huge_sources_together(spark):
    rows = hosts(40, 1, 6, 3) + [(10_000 + i, " ".join(["w"] * 700), "en", "huge", None) for i in range(300)]
    check(rows, M.mix(docs(spark, rows)).collect())


@pytest.mark.parametrize("least,most", [(0, 9), (300, 4000)])
def test_a_table_of_sources_gives_what_the_driver_gives(spark, monkeypatch, least, most):
    rows = hosts(120, least, most, least)
    few = sorted(map(tuple, M.mix(docs(spark, rows)).collect()))
    monkeypatch.setattr(M, "MAX_SOURCES", 7)
    many = sorted(map(tuple, M.mix(docs(spark, rows)).collect()))
    assert [r[:3] + r[4:] for r in many] == [r[:3] + r[4:] for r in few]
    assert [r[3] for r in many] == pytest.approx([r[3] for r in few])
    check(rows, M.mix(docs(spark, rows)).collect())


def test_a_table_of_sources_without_words(spark, monkeypatch):
    monkeypatch.setattr(M, "MAX_SOURCES", 1)
    blank = docs(spark, [(1, "", "en", "a", 0), (2, None, "en", None, 0), (3, " ", "en", "b", 0)])
    assert [(r.taken, r.target) for r in M.mix(blank).collect()] == [(0, 0.0)] * 3
    assert M.mix_documents(blank).count() == 0


def test_copies_of_documents_with_many_sources(spark, monkeypatch):
    rows = hosts(50, 20, 90, 5)
    few = sorted(r.doc_id for r in M.mix_documents(docs(spark, rows)).collect())
    monkeypatch.setattr(M, "MAX_SOURCES", 3)
    assert sorted(r.doc_id for r in M.mix_documents(docs(spark, rows)).collect()) == few
