import random
import re

import xxhash

from arrivals_mart.llm import simhash_bktree as S

from .data import clashing, corpus, docs, empty


def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, radius=2):
    fps = [brute_fingerprint(r[1]) for r in rows]
    distinct = sorted(set(fps))
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for r, f in zip(rows, fps):
        ids = [x for x in (least.get(find(f)), r[0]) if x is not None]
        least[find(f)] = min(ids) if ids else None
    return sorted(((r[0], f, least[find(f)]) for r, f in zip(rows, fps)), key=repr)


def test_fingerprints_and_components_match_brute_force(spark):
    for rows in ([tuple(r) for r in docs(spark).collect()], corpus(1, 150, 60)):
        got = S.near_duplicates(docs(spark, rows)).collect()
        assert sorted(((r.id, r.fp % (1 << 64), r.component_id) for r in got), key=repr) == brute(rows)


def test_tree_finds_exactly_what_is_within_the_radius():
    rng = random.Random(2)
    values = [rng.getrandbits(64) for _ in range(200)]
    values += [v ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 4))) for v in values]
    tree = S.BKTree()
    for v in values:
        tree.insert(v)
    for q in values[::7] + [rng.getrandbits(64)]:
        for radius in (0, 1, 2, 5):
            want = sorted(i for i, v in enumerate(tree.values) if (v ^ q).bit_count() <= radius)
            assert sorted(set(tree.within(q, radius))) == want


def links_of(values, radius=2):
    return {frozenset((a, b)) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= radius}


def parts_of(values, links):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in map(tuple, links):
        root[find(a)] = find(b)
    out = {}
    for v in values:
        out.setdefault(find(v), set()).add(v)
    return sorted(map(sorted, out.values()))


def signed(v):
    return v - (1 << 64) if v >> 63 else v


def test_large_shards_are_dealt_again_without_losing_links(spark):
    rng = random.Random(4)
    # families that agree in many bits, so that the first blocks put them into few shards
    values = sorted({f << 40 | rng.getrandbits(7) << rng.choice([0, 9, 20]) for f in range(12) for _ in range(60)} | {0, (1 << 64) - 1, (1 << 64) - 2})
    df = spark.createDataFrame([(signed(v),) for v in values], "fp bigint")
    want = parts_of(values, links_of(values))
    for size in (4, 100, 10_000):
        got = {frozenset((r.a % (1 << 64), r.b % (1 << 64))) for r in S.near_links(df, shard_size=size).collect()}
        assert parts_of(values, got) == want
        assert len(got) < 20 * len(values)


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, i) for i in range(100, 130)] + [(-5, 300), (300, -7)]
    got = {r.node: r.root for r in S.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in [*range(101, 130), 200]}, -5: -7, 300: -7}


def test_one_document_of_each_component_stays(spark):
    rows = [(5, "a b c d e f g", "en", "x", 1), (3, "A b c d e f g", "en", "x", 1), (3, "a B c d e f g", "en", "x", 1),
            (None, "a b c d e f g", "en", "x", 1), (8, "quite another text here", "en", "x", 1), (9, None, "en", "x", 1),
            (10, "", "en", "x", 1), (None, "alone and without id", "en", "x", 1), (None, "also alone, no id", "en", "x", 1)]
    df = clashing(docs(spark, rows))
    out = S.drop_near_duplicates(df)
    assert out.columns == df.columns
    got = sorted((str(r.doc_id), r.text) for r in out.collect())
    assert len(got) == 5 and [g[0] for g in got] == ["3", "8", "9", "None", "None"]


def test_empty_table(spark):
    assert S.near_duplicates(empty(spark)).count() == 0
    assert S.drop_near_duplicates(empty(spark)).count() == 0
