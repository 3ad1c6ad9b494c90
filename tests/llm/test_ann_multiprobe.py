import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from arrivals_mart.llm import ann_multiprobe as A

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SCHEMA)


def brute(rows, queries, k):
    out = {}
    for q, v in rows:
        if q in queries:
            scored = {(i, float(np.dot(np.float32(v).astype(float), np.float32(w).astype(float)))) for i, w in rows if i != q}
            out[q] = sorted(scored, key=lambda s: (-s[1], s[0]))[:k]
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got.get(q, [])}) for q in want)
    return hits / sum(map(len, want.values()))


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
    return out


def test_recall_order_and_scores(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(0, 1, (8, 24))
    rows = [(i, centres[i % 8] + rng.normal(0, 0.5, 24)) for i in range(1500)]
    got = answers(A.nearest(table(spark, rows), F.col("id") % 20 == 0))
    want = brute(rows, set(range(0, 1500, 20)), 20)
    assert recall(got, want) >= 0.9
    vectors = {i: np.float32(v).astype(float) for i, v in rows}
    for q, found in got.items():
        assert len(found) == 20 and q not in dict(found)
        assert found == sorted(found, key=lambda s: (-s[1], s[0]))
        assert np.allclose([s for _, s in found], [vectors[q] @ vectors[i] for i, _ in found], rtol=0, atol=1e-12)


def test_probes_come_in_order_of_their_cost_and_none_twice():
    hashes = A.Hashes(6, 1000, 1.0)
    v = np.random.default_rng(1).normal(0, 1, (1, 6))
    slots, inside = hashes.query_slots(v)
    import itertools

    far = {}
    for moves in itertools.product(range(-2, 3), repeat=hashes.k):
        cost = sum((m - x) ** 2 if m > 0 else (x - m - 1) ** 2 if m < 0 else 0 for m, x in zip(moves, inside[0, 0]))
        far[int(hashes._keys((slots[0, 0] + np.array(moves))[None])[0])] = cost
    keys = list(itertools.islice(hashes.probes(slots[0, 0], inside[0, 0]), 60))
    assert len(set(keys)) == 60
    assert keys[0] == int(hashes._keys(slots[0, 0][None])[0])
    costs = [far[k] for k in keys if k in far]
    assert len(costs) > 40 and costs == sorted(costs)


def test_equal_vectors_ties_and_unusable_rows(spark):
    one, two = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(i, one) for i in range(0, 60)] + [(100 + i, two) for i in range(5)]
    rows += [(200, None), (220, [0.0, 0.0, 0.0]), (240, [1.0, None, 0.0]), (260, [float("nan"), 1.0, 0.0]),
             (280, [float("inf"), 1.0, 0.0]), (300, [1.0, 2.0]), (320, [])]
    rows += [(100, two), (0, one)]  # repeated rows
    got = answers(A.nearest(table(spark, rows), F.col("id") % 20 == 0))
    assert sorted(got) == [0, 20, 40, 100]
    assert got[0] == [(i, 1.0) for i in range(1, 21)]
    assert got[20] == [(i, 1.0) for i in [*range(0, 20)]]
    assert got[100][:4] == [(100 + i, 1.0) for i in range(1, 5)]
    assert len({i for i, _ in got[100]}) == len(got[100])


def test_norms_count(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 1, 8) * rng.choice([0.1, 1, 30])) for i in range(300)]
    got = answers(A.nearest(table(spark, rows), F.col("id") % 20 == 0))
    assert recall(got, brute(rows, set(range(0, 300, 20)), 20)) >= 0.9


def test_few_rows_give_all_candidates(spark):
    rows = [(i, v) for i, v in enumerate([[1.0, 2.0], [2.0, 1.0], [-1.0, 0.5]])]
    got = answers(A.nearest(table(spark, rows), F.col("id") % 20 == 0))
    assert got == brute(rows, {0}, 20)
    assert A.nearest(table(spark, []), F.col("id") % 20 == 0).count() == 0
    assert A.nearest(table(spark, [(0, [1.0])]), F.col("id") % 20 == 0).count() == 0


def test_heavy_buckets_are_salted(spark, monkeypatch):
    monkeypatch.setattr(A, "SHARE", 40)
    rng = np.random.default_rng(3)
    rows = [(i, np.array([1.0, 0.0, 0.0, 0.0]) + rng.normal(0, 0.02, 4)) for i in range(400)]
    got = answers(A.nearest(table(spark, rows), F.col("id") % 20 == 0))
    assert recall(got, brute(rows, set(range(0, 400, 20)), 20)) >= 0.9


def test_too_few_probes_mean_fewer_directions_not_less_recall(spark, monkeypatch):
    monkeypatch.setattr(A, "MAX_PROBES", 12)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 1, 16)) for i in range(600)]
    got = answers(A.nearest(table(spark, rows), F.col("id") % 20 == 0))
    assert recall(got, brute(rows, set(range(0, 600, 20)), 20)) >= 0.9


def test_last_resort_is_an_exact_scan_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(A, "MAX_PROBES", 1)
    monkeypatch.setattr(A, "SHARE", 100)
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(-9, 10, 16)) for i in range(600)]
    got = answers(A.nearest(table(spark, rows), F.col("id") % 20 == 0))
    assert got == brute(rows, set(range(0, 600, 20)), 20)


def test_calibration_tells_when_probes_do_not_suffice(monkeypatch):
    v = np.random.default_rng(6).normal(0, 1, (40, 16))
    true = [{"q": 0, "v": x} for x in v[1:]]
    hashes = A.Hashes(16, 40, float(np.linalg.norm(v, axis=1).max()))
    assert A.calibrate(v[:1], true, hashes) <= A.MAX_PROBES
    monkeypatch.setattr(A, "MAX_PROBES", 1)
    assert A.calibrate(v[:1], true, hashes) is None
    assert A.calibrate(v[:1], true, A.Hashes(16, 40, hashes.largest, directions=0)) == 1


def near_copies(rng):
    return np.float32(rng.normal(0, 1, 24)) * (1 + np.float32(rng.normal(0, 1e-7, (400, 24))))


@pytest.mark.parametrize("make", [
    lambda rng: np.column_stack([np.ones(400), rng.integers(0, 2, (400, 23))]),  # equal products with the query
    near_copies,
    lambda rng: rng.normal(0, 1, (400, 24)) * rng.choice([1e-42, 1e-20, 1, 1e25], (400, 1)),
], ids=["ties", "near copies", "norms"])
def test_more_rows_than_single_precision_tells_apart(make):
    rng = np.random.default_rng(7)
    vectors = np.unique(np.float32(make(rng)), axis=0)
    ids = rng.permutation(len(vectors)) + 1
    query = np.float32([1] + [0] * 23) if vectors[0, 0] == vectors[-1, 0] == 1 else vectors[3]
    own = int(ids[3])
    entries = pa.RecordBatch.from_pydict({
        "keys": pa.array([[7]] * len(ids), pa.list_(pa.int64())), "v": pa.array(vectors.tolist(), pa.list_(pa.float32())),
        "ids": pa.array([[i] for i in ids.tolist()], pa.list_(pa.int64())),
    })
    asked = pa.RecordBatch.from_pydict({
        "id": pa.array([own]), "keys": pa.array([[7]], pa.list_(pa.int64())), "v": pa.array([query.tolist()], pa.list_(pa.float32())),
    })
    found = [(r["vec_id"], r["score"]) for b in A._Part([entries], 24).answers(asked, 24, 20) for r in b.to_pylist()]
    exact = (vectors.astype(float) * query.astype(float)).sum(1).tolist()
    want = sorted((x for x in zip(ids.tolist(), exact) if x[0] != own), key=lambda s: (-s[1], s[0]))[:20]
    assert found == want


def test_each_length_is_searched(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(0, 1, 5 if i % 3 else 4)) for i in range(90)]
    got = answers(A.nearest(table(spark, rows), F.col("id") % 20 == 0))
    want = {}
    for dim in (4, 5):
        want |= brute([r for r in rows if len(r[1]) == dim], {0, 20, 40, 60, 80}, 20)
    assert sorted(got) == [0, 20, 40, 60, 80] and recall(got, want) >= 0.9
    assert all(len(rows[q][1]) == len(rows[i][1]) for q in got for i, _ in got[q])


def test_extra_columns_with_clashing_names(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(0, 1, 8)) for i in range(200)]
    plain = table(spark, rows)
    clashing = plain.withColumns({c: F.lit(f"own {c}") for c in ("id", "v", "ids", "part", "kind", "keys", "score", "rank", "t", "key", "query_id")})
    is_query = F.col("id") % 20 == 0
    assert answers(A.nearest(clashing, is_query)) == answers(A.nearest(plain, is_query))


def laid_out(vectors, share):
    """(hashes, layout, part of every vector in every table) as the operator deals them, in numpy alone."""
    n = len(vectors)
    hashes = A.Hashes(vectors.shape[1], n, float(np.linalg.norm(vectors, axis=1).max()))
    slots = hashes.entry_slots(vectors)
    directions = A.cell_directions(hashes, -(-n // share))
    keys, cells = hashes._keys(slots), A.cell_of(slots[:, :, :directions])
    counts = [(t, int(c), int(m)) for t in range(hashes.tables) for c, m in zip(*np.unique(cells[:, t], return_counts=True))]
    layout = A.Layout(hashes.tables, directions, counts, share)
    large = share // A._LARGE
    heavy = {(t, int(key)): -(-int(m) // large) for t in range(hashes.tables)
             for key, m in zip(*np.unique(keys[:, t], return_counts=True)) if m > large}
    salts = [A.salts_of(heavy, np.full(n, t), keys[:, t], np.arange(n)) for t in range(hashes.tables)]
    parts = np.column_stack([layout.part(np.int64(t), cells[:, t], keys[:, t], salts[t]) for t in range(hashes.tables)])
    return hashes, layout, heavy, keys, parts


def test_parts_hold_a_bounded_share_and_every_probed_bucket_is_met():
    rng = np.random.default_rng(9)
    vectors = rng.normal(0, 1, (20_000, 12))
    hashes, layout, heavy, keys, parts = laid_out(vectors, 500)
    assert parts.min() >= 0 and parts.max() < layout.parts <= 3 * hashes.tables * 20_000 // 500
    assert np.bincount(parts.ravel()).max() <= 3 * 500
    queries = rng.normal(0, 1, (30, 12))
    slots, inside = hashes.query_slots(queries)
    rows, where, lists = A.routes(hashes, layout, heavy, 40, queries)
    assert len(set(zip(rows.tolist(), where.tolist()))) == len(rows)
    for i in range(len(queries)):
        met = {(p, key) for r, p, ks in zip(rows.tolist(), where.tolist(), lists) if r == i for key in ks.tolist()}
        for t in range(hashes.tables):
            probed = np.array([k for k, _ in zip(hashes.probes(slots[i, t], inside[i, t]), range(40))])
            held = np.flatnonzero(np.isin(keys[:, t], probed))
            assert {(p, k) for p, k in zip(parts[held, t].tolist(), keys[held, t].tolist())} <= met


def test_a_probed_cell_is_the_cell_of_its_slots():
    hashes = A.Hashes(8, 100_000, 1.0)
    v = np.random.default_rng(10).normal(0, 1, (3, 8))
    slots, inside = hashes.query_slots(v)
    for i in range(3):
        found = [x for x, _ in zip(hashes.probed_cells(slots[i, 0], inside[i, 0], 2), range(200))]
        assert found[0][1] == A.cell_of(slots[i, 0][None, :2])[0]
        moved = {int(hashes._keys((slots[i, 0] + m)[None])[0]): int(A.cell_of((slots[i, 0] + m)[None, :2])[0])
                 for m in np.array(np.meshgrid(*[[-1, 0, 1]] * hashes.k)).reshape(hashes.k, -1).T}
        assert sum(key in moved for key, _ in found) > 30
        assert all(moved[key] == cell for key, cell in found if key in moved)


def test_copies_of_a_query_grow_slower_than_the_parts():
    """Clustered vectors: ten times the entries make ten times the parts, and few more copies of a query."""
    copies, parts = {}, {}
    for n in (100_000, 1_000_000):
        rng = np.random.default_rng(11)
        centres = rng.normal(0, 1, (n // 100, 32)).astype(np.float32)
        vectors = centres[np.arange(n) % len(centres)] + rng.normal(0, 0.15, (n, 32)).astype(np.float32)
        vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
        hashes, layout, heavy, _, _ = laid_out(vectors, 8192)
        q = vectors[:24].astype(np.float64)
        near = np.argsort(-(q.astype(np.float32) @ vectors.T), axis=1)[:, 1:21]
        true = [{"q": i, "v": vectors[j]} for i in range(24) for j in near[i]]
        probes = A.calibrate(q, true, hashes)
        rows, _, _ = A.routes(hashes, layout, heavy, probes, vectors[24:124].astype(np.float64))
        copies[n], parts[n] = len(rows) / 100, layout.parts
        assert probes > 1
    assert parts[1_000_000] > 7 * parts[100_000]
    assert copies[1_000_000] < 3 * copies[100_000] and copies[1_000_000] < parts[1_000_000] / 4
