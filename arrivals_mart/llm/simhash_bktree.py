"""Near duplicates by SimHash fingerprints in BK-trees.

1. A document's fingerprint takes the majority bit of its shingles' hashes.
2. Distinct fingerprints are dealt to shards so that any two within the radius meet: of
   ``radius + 1`` blocks of bits, two such fingerprints agree in one at least. A shard that
   is too large is dealt again by blocks of its other bits, up to three times; then the
   bits that are still free bound its size.
3. Each shard builds one BK-tree: children are keyed by their Hamming distance to the parent, and
   a search follows only edges within the radius of its own distance. The shard's own
   fingerprints search it as they are inserted, and what is found is joined to
   one star per connected part, so a group of m near copies leaves with m - 1 links.
4. Links of all shards are contracted to components by alternating star steps.

Shard trees go to the tasks that own their shard, not to all: together they hold every
fingerprint, which grows with the corpus, and a table that grows is never broadcast.

Null and empty texts and texts without words have fingerprint 0 and link to each other.
Repeated rows share a fingerprint. A null id never becomes a component's id unless all its
ids are null. Texts of any length are read whole. Equal fingerprints
are linked at distance 0, so all of them have one component. Extra columns are not read, or pass through
``drop_near_duplicates`` as they are, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals_mart.llm._common import LOWER, written

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
#: A shard with more distinct fingerprints is dealt again by further bits.
SHARD_SIZE = 2048
LEVELS = 3
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """Bit i is set if over half the shingles' XXH64 hashes have it set."""
    words = text.translate(LOWER).split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    hash64 = xxhash.xxh64_intdigest
    if len(words) <= words_per_shingle:
        return hash64(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begin = [0, *ends[:-words_per_shingle].tolist()]
    end = (ends[words_per_shingle - 1:] - 1).tolist()
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(begin), _CHUNK):
        hashes = np.array([hash64(joined[a:b], SEED) for a, b in zip(begin[at:at + _CHUNK], end[at:at + _CHUNK])], "<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(2 * set_bits > len(begin), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """id, row_hash (of the text as it stands) and fp (the fingerprint as a signed integer)."""

    def run(batches):
        for b in batches:
            fps = [fingerprint(t, words_per_shingle) for t in b.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("row_hash"), pa.array(np.array(fps, np.uint64).view(np.int64))],
                names=["id", "row_hash", "fp"],
            )

    text = F.col(f"`{text_col}`")
    return df.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), F.xxhash64(text).alias("row_hash"), text.alias("text")
    ).mapInArrow(run, "id bigint, row_hash bigint, fp bigint")


class BKTree:
    """Fingerprints under edges keyed by Hamming distance."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self._children: list[dict[int, int]] = []

    def insert(self, value: int) -> None:
        new = len(self.values)
        self.values.append(value)
        self._children.append({})
        at = 0
        while at != new:
            at = self._children[at].setdefault((self.values[at] ^ value).bit_count(), new)

    def within(self, value: int, radius: int) -> list[int]:
        """Positions of all values at most ``radius`` bits away."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                found.append(at)
            children = self._children[at]
            if len(children) <= 2 * radius + 1:
                todo += [c for k, c in children.items() if d - radius <= k <= d + radius]
            else:
                todo += [children[k] for k in range(d - radius, d + radius + 1) if k in children]
        return found


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """(value, smallest value of its connected part) for every other value of a part."""
    tree, root = BKTree(), list(range(len(values)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    order = sorted(range(len(values)), key=values.__getitem__)
    for i, o in enumerate(order):
        for j in tree.within(values[o], radius):
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
        tree.insert(values[o])
    return [(values[o], values[order[find(i)]]) for i, o in enumerate(order) if find(i) != i]


def _masks(radius: int, levels: int) -> list[list[tuple[int, int]]]:
    """Per level, (path, bits that a shard of the path agrees in). Path p's parts are p * blocks + i."""
    blocks = radius + 1

    def cut(bits: list[int]) -> list[list[int]]:
        edges = [round(k * len(bits) / blocks) for k in range(blocks + 1)]
        return [bits[a:b] for a, b in zip(edges, edges[1:])]

    level, out = [(0, [], list(range(64)))], []
    for _ in range(levels):
        level = [
            (path * blocks + i, fixed + part, [b for b in free if b not in part])
            for path, fixed, free in level for i, part in enumerate(cut(free))
        ]
        out.append([(path, sum(1 << b for b in fixed)) for path, fixed, _ in level])
    return out


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _dealt(df: DataFrame, masks: list[tuple[int, int]], blocks: int, level: int) -> DataFrame:
    """Deal each fingerprint to the shards of its path's parts: columns fp, level, path, agreed."""
    parts = F.array(*[
        F.struct(F.lit(path).alias("path"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("agreed"))
        for path, mask in masks
    ])
    if level:
        parts = F.slice(parts, F.col("path") * blocks + 1, blocks)
    return df.select("fp", F.explode(parts).alias("s")).select("fp", F.lit(level).alias("level"), "s.path", "s.agreed")


def near_links(distinct: DataFrame, radius: int = RADIUS, shard_size: int = SHARD_SIZE) -> DataFrame:
    """Links (a, b) between distinct fingerprints that connect exactly what lies within the radius."""
    key = ["level", "path", "agreed"]
    masks, todo, ready = _masks(radius, LEVELS), distinct, None
    for level in range(LEVELS):
        dealt = _dealt(todo, masks[level], radius + 1, level)
        sizes = dealt.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        sized = written(dealt.join(sizes, key), "simhash-shards")
        last = level == LEVELS - 1
        small = (sized if last else sized.filter(F.col("n") <= shard_size)).select("fp", *key)
        ready = small if ready is None else ready.unionByName(small)
        todo = sized.filter(F.col("n") > shard_size).select("fp", "path")
        if last or todo.isEmpty():
            break

    def run(batches):
        for values in _groups(batches):
            found = shard_links(values, radius)
            if found:
                a, b = np.array(found, np.uint64).view(np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return ready.repartition(*key).sortWithinPartitions(*key, "fp").mapInArrow(run, "a bigint, b bigint").distinct()


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[int]]:
    """The fingerprints, unsigned, of each run of equal keys in sorted batches."""
    held: list[int] = []
    before = None
    for b in batches:
        keys = np.stack([np.asarray(b.column(c)).astype(np.int64) for c in ("level", "path", "agreed")], 1)
        fps = np.asarray(b.column("fp")).view(np.uint64).tolist()
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(fps)]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            now = tuple(keys[lo])
            if now != before and held:
                yield held
                held = []
            held += fps[lo:hi]
            before = now
    if held:
        yield held


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node, root: each linked node under the smallest of its component, by alternating star steps.

    The large step links a node's larger neighbours to its smallest neighbour, the
    small step its smaller ones; each leaves components as they are. Rounds end when nothing changes.
    """
    links = written(links.select("a", "b"), "star")
    state = None
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.filter("a <> b").distinct(), "star")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        links = written(small.distinct(), "star")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
    raise RuntimeError("components did not settle")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    words_per_shingle: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per input row: id, row_hash, fp (signed), root (its component's smallest fingerprint) and
    component_id (smallest id reachable)."""
    docs = written(fingerprints(df, id_col, text_col, words_per_shingle), "simhash-fp")
    distinct = docs.groupBy("fp").agg(F.min("id").alias("least_id"))
    distinct = written(distinct, "simhash-distinct")
    roots = components(near_links(distinct.select("fp"), radius))
    joined = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    of_root = joined.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = written(joined.join(of_root, "root").select("fp", "root", "component_id"), "simhash-classes")
    return docs.join(classes, "fp").select("id", "row_hash", "fp", "root", "component_id")


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         words_per_shingle: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """Rows of ``df`` of which none is near another: of each component the smallest id stays (rows that
    tie on it: the smaller hash of the text; fully equal rows stay together)."""
    near = near_duplicates(df, id_col, text_col, words_per_shingle, radius)
    by_class = F.struct(F.col("id").isNull().alias("n"), F.col("id"), F.col("row_hash"))
    keep = near.groupBy("root").agg(F.min(by_class).alias("k")).select(F.col("k.id").alias("_keep_id"), F.col("k.row_hash").alias("_keep_hash"))
    whole = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("whole"),
        F.col(f"`{id_col}`").cast("bigint").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("row_hash"),
    )
    same = F.col("row_hash").eqNullSafe(F.col("_keep_hash")) & F.col("id").eqNullSafe(F.col("_keep_id"))
    return whole.join(keep, same, "left_semi").select("whole.*")
