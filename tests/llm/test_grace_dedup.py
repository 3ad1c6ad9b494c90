import hashlib
import string

import pytest

from arrivals_mart.llm import grace_dedup as G

from .data import clashing, corpus, docs, empty

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault((r[1] or "").translate(LOWER), []).append(r[0])
    out = []
    for r in rows:
        norm = (r[1] or "").translate(LOWER)
        ids = [i for i in groups[norm] if i is not None]
        out.append((r[0], hashlib.sha256(norm.encode()).hexdigest(), max(ids) if ids else None, len(groups[norm])))
    return out


def key(r):
    return repr(r)


@pytest.mark.parametrize("limit", [G.TABLE_BYTES, 600])
def test_decisions_match_brute_force(spark, limit):
    for rows in (docs(spark).collect(), corpus(3)):
        rows = [tuple(r) for r in rows]
        got = G.exact_duplicates(docs(spark, rows), table_bytes=limit).collect()
        assert sorted([(r.id, r.text_sha256, r.keep_id, r.group_size) for r in got], key=key) == sorted(brute(rows), key=key)
        kept = [r for r in got if r.kept]
        assert len(kept) == len({r.text_sha256 for r in got})  # one of each group, also among repeated rows
        assert all(r.id == r.keep_id for r in kept)


def test_survivors_keep_their_columns_and_their_own_spelling(spark):
    df = clashing(docs(spark))
    out = G.drop_exact_duplicates(df)
    assert out.columns == df.columns and out.dtypes == df.dtypes
    rows = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    assert rows[3].text == "hello wOrld" and 1 not in rows and 2 not in rows
    assert rows[7].text == "hÉllo" and rows[8].text == "héllo" and 6 not in rows  # only A-Z is lowered
    assert rows[5].text == "" and 4 not in rows  # null equals empty
    assert rows[3]["kept"] == "own kept"
    assert out.count() == len({b[1] for b in brute([tuple(r) for r in docs(spark).collect()])})


def test_empty_table(spark):
    assert G.exact_duplicates(empty(spark)).count() == 0
    assert G.drop_exact_duplicates(empty(spark)).count() == 0


def test_buckets_beyond_the_limit_are_spilled_and_none_is_lost():
    rows = [G.Record(G.xxhash.xxh64_intdigest(t), i, i, 1, t, b"") for i, t in enumerate(b"%d " % (k % 300) * 40 for k in range(900))]
    groups = list(G.grace(rows, 10_000, True, False))
    assert len(groups) > 4 and all(g.table.bytes <= 11_000 for g in groups)
    sizes = sorted(s for g in groups for s in g.sizes)
    assert sizes == [3] * 300
    assert sorted(k for g in groups for k, _ in g.keys) == list(range(900))
    assert {g.best[e].id - k for g in groups for k, e in g.keys} == {0, 300, 600}


def test_a_hash_shared_by_different_texts_does_not_merge_them():
    rows = [G.Record(7, i, i, 1, t, b"") for i, t in enumerate([b"a", b"b", b"a"])]
    (g,) = G.grace(rows, 1 << 20, True, False)
    assert sorted(zip(g.table.contents, g.sizes)) == [(b"a", 2), (b"b", 1)]
    # also when they are too large for one table: no bits are left that could part them
    large = [G.Record(7, i, i, 1, bytes([97 + i % 3]) * 500, b"") for i in range(9)]
    groups = list(G.grace(large, 400, True, False))
    assert sorted(s for g in groups for s in g.sizes) == [3, 3, 3]


def test_a_group_that_fills_the_table_leaves_each_batch_once(spark):
    rows = [(i, "copy", "en", "a", 4) for i in range(5000)] + [(9000 + i, f"text {i}", "en", "a", 4) for i in range(50)]
    got = G.exact_duplicates(docs(spark, rows)).filter("keep_id = 4999").collect()
    assert len(got) == 5000 and {r.group_size for r in got} == {5000} and [r.id for r in got if r.kept] == [4999]


@pytest.mark.parametrize("remembered", [G.HOT_BYTES, 3_000, 0])
def test_copies_leave_a_task_once(spark, monkeypatch, remembered):
    monkeypatch.setattr(G, "HOT_BYTES", remembered)
    rows = []
    for i in range(600):
        text = ["Hot text " * 50, "hot text " * 50, f"own {i}", None, "Ab", "aB", f"two {i // 2}"][i % 7]
        rows.append(((i * 37) % 601 if i % 11 else None, text, "en", f"s{i}", 1))
    rows += rows[:3]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "25")
    try:
        df = docs(spark, rows).repartition(2)
        got = G.exact_duplicates(df, table_bytes=2_000).collect()
        assert sorted([(r.id, r.text_sha256, r.keep_id, r.group_size) for r in got], key=key) == sorted(brute(rows), key=key)
        kept = [r for r in got if r.kept]
        assert len(kept) == len({r.text_sha256 for r in got}) and all(r.id == r.keep_id for r in kept)
        staged = G._staged(df, "doc_id", "text", rows=False)
        hot = staged.filter("is_leader").groupBy("text_sha256").count().agg({"count": "max"}).first()[0]
        assert hot <= 2 if remembered == G.HOT_BYTES else hot > 2
        survivors = {r.doc_id: r for r in G.drop_exact_duplicates(df, table_bytes=2_000).collect() if r.doc_id is not None}
        given = {(r[0], r[1], r[3]) for r in rows}
        assert all((r.doc_id, r.text, r.source) in given for r in survivors.values())
        assert set(survivors) == {r.id for r in kept if r.id is not None}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
