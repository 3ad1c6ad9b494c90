"""Nearest neighbours by multiprobe p-stable hashing, largest inner product first.

1. Vectors that are equal become one entry with their smallest ids (as many as a result can need).
2. Each entry, scaled by the largest norm and completed to a unit vector, is hashed in
   several tables. A table's hash is ``width``-wide slots along a few random directions, so near
   vectors fall into equal or adjacent slots. More entries get more directions.
3. A query visits a table's buckets in estimated success order: its own first, then slots moved
   by one or more, by ascending sum of squared distances to the slots' borders.
4. The number of probes is calibrated: a bounded sample of queries is compared with brute force,
   and the probes go as far as a recall of ``TARGET_RECALL`` of the sample needs. If more than
   ``MAX_PROBES`` were needed, all is hashed anew with one direction less, which makes larger
   buckets. Without directions one bucket holds everything: an exact scan, block by block.
5. Buckets are dealt to parts by cells, the slots of a table's first few directions: cells that follow one
   another share a part up to ``SHARE`` entries, and a cell beyond it is spread over several by its buckets. A
   query is sent, once each, to the parts that hold its probes, so that probes close to one another meet
   in few parts. A part holds its entries and streams the queries. It reranks the entries of the visited buckets by exact inner product
   of the original vectors in double precision and passes on its nearest ``k`` per query. Left out
   are only entries whose single-precision product is too low for its rounding error to matter.
6. The candidates of all tables and tasks merge per query: nearest first, ties to the smaller id.

A bucket beyond an eighth of ``SHARE`` is salted over the parts of its cell. Vectors that are null, zero,
or that hold null or non-finite components take no part. Vectors of different lengths are not
compared: each length has its own tables, and its queries find entries of that length. Rows that
repeat an id and vector count once. Extra columns are not read, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrivals_mart.llm._common import written

TABLES = 4
WIDTH = 1.0
#: Entries per bucket that the number of directions aims at, and how much a direction divides.
BUCKET_ENTRIES, SPLIT = 64, 5.0
TARGET_RECALL = 0.96
#: Bounds of the calibration: sample queries, and probes per table.
SAMPLE_QUERIES, MAX_PROBES = 48, 8192
#: Entries that one task holds.
SHARE = 32_768
SEED = 8
_MOVES = 6
#: Slots of a direction that make cells of their own; those further out belong to the outermost.
_CELL_SLOTS = 5
#: Buckets of more than this part of a share are salted.
_LARGE = 8
#: Scores that a part holds at a time for the queries it is asked by.
_SCORES = 1 << 22
#: Components that are multiplied in double precision at a time.
_EXACT = 1 << 20


class Hashes:
    """Directions and offsets of all tables for vectors of ``dim`` components with norms up to ``largest``.

    Without ``directions`` their number follows from the entries; with 0 one table has one bucket for all.
    """

    def __init__(self, dim: int, entries: int, largest: float, tables: int = TABLES, width: float = WIDTH,
                 directions: int | None = None):
        rng = np.random.default_rng(SEED)
        self.k = int(min(max(4, round(np.log(max(entries, 1) / BUCKET_ENTRIES) / np.log(SPLIT))), dim + 1))
        if directions is not None:
            self.k, tables = directions, tables if directions else 1
        self.tables, self.width, self.largest = tables, width, largest
        bases = [np.linalg.qr(rng.standard_normal((dim + 1, self.k)))[0] * np.sqrt(dim + 1) for _ in range(tables)]
        self.directions = np.concatenate(bases, 1)
        self.offsets = rng.random(tables * self.k) * width
        self.mix = rng.integers(1, 1 << 62, self.k, dtype=np.int64) * 2 + 1

    def _project(self, unit: np.ndarray) -> np.ndarray:
        return (unit @ self.directions + self.offsets).reshape(len(unit), self.tables, self.k) / self.width

    def _keys(self, slots: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (slots.astype(np.int64) * self.mix).sum(-1)

    def entry_slots(self, vectors: np.ndarray) -> np.ndarray:
        """Slots of each vector in each table; scaled vectors are completed to norm 1."""
        v = vectors / self.largest
        rest = np.sqrt(np.maximum(0, 1 - (v * v).sum(1)))
        return np.floor(self._project(np.column_stack([v, rest]))).astype(np.int64)

    def entry_keys(self, vectors: np.ndarray) -> np.ndarray:
        """Bucket key of each vector in each table."""
        return self._keys(self.entry_slots(vectors))

    def query_slots(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slot and position inside the slot (0 to 1) per query, table and direction."""
        v = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        p = self._project(np.column_stack([v, np.zeros(len(v))]))
        slots = np.floor(p)
        return slots.astype(np.int64), p - slots

    def probes(self, slots: np.ndarray, inside: np.ndarray) -> Iterator[int]:
        """Bucket keys of one query in one table, most promising first."""
        return (key for key, _ in self.probed_cells(slots, inside, 0))

    def probed_cells(self, slots: np.ndarray, inside: np.ndarray, directions: int) -> Iterator[tuple[int, int]]:
        """(bucket key, cell by the first ``directions``) of one query in one table, most promising first."""
        moves = np.concatenate([[0], np.repeat(np.arange(1, _MOVES + 1), 2) * np.tile([1, -1], _MOVES)])
        far = np.where(moves > 0, moves - inside[:, None], np.where(moves < 0, inside[:, None] - moves - 1, 0.0)) ** 2
        order = far.argsort(1, kind="stable")
        cost = np.take_along_axis(far, order, 1).tolist()
        mix = self.mix.tolist()
        step = [[int(m) * mix[j] for m in moves[order[j]]] for j in range(self.k)]
        base = sum(int(s) * m for s, m in zip(slots, mix))
        parts = [(cell_of((slots[j] + moves[order[j]])[:, None]) * _CELL_SLOTS ** (directions - 1 - j)).tolist()
                 for j in range(directions)]
        heap = [(0.0, 0, (0,) * self.k, base)]
        width, last = len(moves) - 1, self.k - 1
        wrap, half = (1 << 64) - 1, 1 << 63
        while heap:
            c, j, at, key = heapq.heappop(heap)
            yield ((key + half) & wrap) - half, sum(p[a] for p, a in zip(parts, at))
            for i in range(j, last + 1):
                a = at[i]
                if a < width:
                    heapq.heappush(heap, (
                        c + cost[i][a + 1] - cost[i][a], i, at[:i] + (a + 1,) + at[i + 1:],
                        key + step[i][a + 1] - step[i][a],
                    ))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), dim)


def entries_of(df: DataFrame, id_col: str, vector_col: str, keep: int) -> DataFrame:
    """Distinct usable vectors of all lengths with their ``keep`` smallest ids.

    Equal vectors merge in two steps, the first salted by id, so that a vector that fills a
    third of the table is gathered by many tasks and never more than ``keep`` ids at a time after it.
    """
    v = F.col(f"`{vector_col}`").cast("array<float>")
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), v.alias("v")).filter("id IS NOT NULL AND v IS NOT NULL")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(finite & F.exists("v", lambda x: x != 0))
    first = rows.groupBy("v", F.pmod(F.xxhash64("id"), F.lit(4096)).alias("salt")).agg(F.collect_set("id").alias("ids"))
    first = first.select("v", F.slice(F.array_sort("ids"), 1, keep).alias("ids"))
    return first.groupBy("v").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, keep).alias("ids"))


def sampled(entries: DataFrame, dim: int, k: int) -> tuple[np.ndarray, list]:
    """A bounded sample of queries, and rows (q, id, s, v) of their true nearest entries."""
    sample = entries.orderBy(F.xxhash64(F.col("ids")[0]), F.col("ids")[0]).limit(SAMPLE_QUERIES).collect()
    q = np.array([r["v"] for r in sample], np.float64)
    own = np.array([r["ids"][0] for r in sample], np.int64)

    def run(batches):
        for b in batches:
            v, ids = _matrix(b.column("v"), dim), np.asarray(b.column("id"))
            s = q @ v.T.astype(np.float64)
            s[own[:, None] == ids[None, :]] = -np.inf
            n = min(k, len(ids))
            top = np.argpartition(-s, n - 1, axis=1)[:, :n]
            at = np.repeat(np.arange(len(q)), n)
            yield pa.RecordBatch.from_pydict({
                "q": pa.array(at), "id": pa.array(ids[top.ravel()]), "s": pa.array(s[at, top.ravel()]),
                "v": b.column("v").take(pa.array(top.ravel())),
            })

    near = entries.select(F.col("ids")[0].alias("id"), "v").mapInArrow(run, "q bigint, id bigint, s double, v array<float>")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "id"))
    return q, near.filter("s > double('-infinity')").withColumn("r", rank).filter(F.col("r") <= k).collect()


def calibrate(q: np.ndarray, true: list, hashes: Hashes, target: float = TARGET_RECALL) -> int | None:
    """Probes per table that queries ``q`` need to find ``target`` of their nearest entries; None if over MAX_PROBES."""
    if not true:
        return 1
    keys = hashes.entry_keys(np.array([r["v"] for r in true], np.float64))
    slots, inside = hashes.query_slots(q)
    wanted: dict[tuple[int, int], dict[int, list[int]]] = {}
    for n, r in enumerate(true):
        for t in range(hashes.tables):
            wanted.setdefault((r["q"], t), {}).setdefault(int(keys[n, t]), []).append(n)
    reached = np.full(len(true), np.inf)
    for (i, t), todo in wanted.items():
        for rank_, key in enumerate(hashes.probes(slots[i, t], inside[i, t])):
            if rank_ >= MAX_PROBES or not todo:
                break
            for n in todo.pop(key, ()):
                reached[n] = min(reached[n], rank_ + 1)
    reached.sort()
    needed = reached[min(len(reached) - 1, int(np.ceil(target * len(reached))) - 1)]
    return int(needed) if np.isfinite(needed) else None


def fitted(entries: DataFrame, dim: int, n: int, largest: float, k: int) -> tuple[Hashes, int]:
    """Hashes and probes per table that reach the target on the sample, with as many directions as can."""
    q, true = sampled(entries, dim, k)
    hashes = Hashes(dim, n, largest)
    while (probes := calibrate(q, true, hashes)) is None:
        hashes = Hashes(dim, n, largest, directions=hashes.k - 1)
    return hashes, probes


def cell_of(slots: np.ndarray) -> np.ndarray:
    """Number of the cell of each row of slots, the first direction first."""
    half = _CELL_SLOTS // 2
    place = _CELL_SLOTS ** np.arange(slots.shape[-1] - 1, -1, -1)
    return ((np.clip(slots, -half, half) + half) * place).sum(-1)


def cell_directions(hashes: Hashes, parts: int) -> int:
    """Directions that make at least as many cells as parts, at most ``_CELL_SLOTS`` times as many."""
    j = 0
    while _CELL_SLOTS ** j < parts and j < hashes.k:
        j += 1
    return j


class Layout:
    """Which parts hold a table's cells: ``first`` part and how ``many`` of each cell, 0 of an empty one.

    Cells that follow one another share a part up to ``share`` entries; a larger cell has parts of its own.
    """

    def __init__(self, tables: int, directions: int, counts: list[tuple[int, int, int]], share: int):
        self.directions = directions
        self.first = np.zeros((tables, _CELL_SLOTS ** directions), np.int64)
        self.many = np.zeros_like(self.first)
        self.parts, last, filled = 0, None, 0
        for t, cell, n in sorted(counts):
            if t != last or filled + n > share:
                last, filled = t, n
                self.many[t, cell] = -(-n // share)
                self.first[t, cell] = self.parts
                self.parts += int(self.many[t, cell])
            else:
                self.first[t, cell], self.many[t, cell] = self.parts - 1, 1
                filled += n

    def part(self, t, cell: np.ndarray, keys: np.ndarray, salt: np.ndarray) -> np.ndarray:
        """The part of each bucket, -1 in an empty cell; the salts of a bucket go to the parts of its cell that follow."""
        with np.errstate(over="ignore"):
            h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
            h *= np.uint64(0xD6E8FEB86659FD93)
        many = self.many[t, cell]
        at = self.first[t, cell] + ((h >> np.uint64(33)).astype(np.int64) + salt) % np.maximum(many, 1)
        return np.where(many > 0, at, -1)


def salts_of(heavy: dict[tuple[int, int], int], tables: np.ndarray, keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which salt of its bucket each entry takes, by its id."""
    many = np.array([heavy.get(x, 1) for x in zip(tables.tolist(), keys.tolist())], np.int64)
    with np.errstate(over="ignore"):
        mixed = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(33)).astype(np.int64) % many


def routes(hashes: Hashes, layout: Layout, heavy: dict, probes: int, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """(row, part, bucket keys) of every part that holds a probed bucket of a query, each pair once."""
    slots, inside = hashes.query_slots(vectors)
    rows, where, lists = [], [], []
    for i in range(len(vectors)):
        for t in range(hashes.tables):
            found = islice(hashes.probed_cells(slots[i, t], inside[i, t], layout.directions), probes)
            keys, cells = (np.array(x, np.int64) for x in zip(*found))
            salt = np.zeros(len(keys), np.int64)
            if heavy:
                times = np.array([heavy.get((t, key), 1) for key in keys.tolist()])
                keys, cells = keys.repeat(times), cells.repeat(times)
                salt = np.arange(len(keys)) - (np.cumsum(times) - times).repeat(times)
            at = layout.part(t, cells, keys, salt)
            keys, at = keys[at >= 0], at[at >= 0]
            order = np.lexsort((keys, at))
            keys, at = keys[order], at[order]
            new = np.append(True, (at[1:] != at[:-1]) | (keys[1:] != keys[:-1]))[:len(at)]
            keys, at = keys[new], at[new]
            begin = np.flatnonzero(np.append(True, at[1:] != at[:-1])[:len(at)])
            rows += [i] * len(begin)
            where += at[begin].tolist()
            lists += np.split(keys, begin[1:]) if len(begin) else []
    return np.array(rows, np.int64), np.array(where, np.int64), lists


def _search(batches: Iterator[pa.RecordBatch], dim: int, k: int) -> Iterator[pa.RecordBatch]:
    """Entries of a part come first and are held; then its queries stream by."""
    part, held, index = None, [], None
    for b in batches:
        parts, kinds = np.asarray(b.column("part")), np.asarray(b.column("kind"))
        change = (parts[1:] != parts[:-1]) | (kinds[1:] != kinds[:-1])
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(parts)]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            if parts[lo] != part:
                part, held, index = parts[lo], [], None
            piece = b.slice(lo, hi - lo)
            if kinds[lo] == 0:
                held.append(piece)
                continue
            if index is None and held:
                index = _Part(held, dim)
                held = []
            if index is not None:
                yield from index.answers(piece, dim, k)


class _Part:
    """The entries of one part, ordered by bucket."""

    def __init__(self, batches: list[pa.RecordBatch], dim: int):
        keys = np.concatenate([np.asarray(b.column("keys").flatten()) for b in batches])
        order = keys.argsort(kind="stable")
        self.vectors = np.concatenate([_matrix(b.column("v"), dim) for b in batches])[order]
        ids = pa.concat_arrays([b.column("ids") for b in batches]).take(pa.array(order))
        self.id_at = np.concatenate([[0], np.cumsum(np.asarray(ids.value_lengths()))])
        self.ids = np.asarray(ids.flatten())
        # the only id of an entry; entries of several ids always have one besides the query's own
        self.only = np.where(np.diff(self.id_at) == 1, self.ids[self.id_at[:-1]], -1)
        self.several = np.diff(self.id_at) > 1
        # over twice what rounding makes of a single-precision product with a vector of norm 1
        norms = np.sqrt(np.einsum("ij,ij->i", self.vectors, self.vectors, dtype=np.float64))
        self.slack = dim * float(np.finfo(np.float32).eps) * norms
        self.found, self.first, self.count = np.unique(keys[order], return_index=True, return_counts=True)

    def answers(self, queries: pa.RecordBatch, dim: int, k: int) -> Iterator[pa.RecordBatch]:
        q = _matrix(queries.column("v"), dim)
        names = np.asarray(queries.column("id"))
        keys = np.asarray(queries.column("keys").flatten())
        ends = np.concatenate([[0], np.cumsum(np.asarray(queries.column("keys").value_lengths()))])
        bucket = np.minimum(np.searchsorted(self.found, keys), len(self.found) - 1)
        known = self.found[bucket] == keys
        size = np.where(known, self.count[bucket], 0)
        wanted = np.concatenate([[0], np.cumsum(size)])[ends]
        step = max(1, _SCORES // len(self.vectors))
        out_q, out_id, out_s = [], [], []
        for lo in range(0, len(q), step):
            hi = min(lo + step, len(q))
            # one product with all entries costs less than gathering a good part of them for each query
            dense = (wanted[hi] - wanted[lo]) * 8 > (hi - lo) * len(self.vectors)
            with np.errstate(over="ignore", invalid="ignore"):
                products = q[lo:hi] @ self.vectors.T if dense else None
            for i in range(lo, hi):
                if wanted[i] == wanted[i + 1]:
                    continue
                n, at = size[ends[i]:ends[i + 1]], self.first[bucket[ends[i]:ends[i + 1]]]
                rows = np.repeat(at - (np.cumsum(n) - n), n) + np.arange(n.sum())
                ids, scores = self._nearest(rows, q[i], int(names[i]), k, products[i - lo] if dense else None)
                out_q.append(np.full(len(ids), names[i]))
                out_id.append(ids)
                out_s.append(scores)
        if out_q:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x), kind) for x, kind in ((out_q, pa.int64()), (out_id, pa.int64()), (out_s, pa.float64()))],
                names=["query_id", "vec_id", "score"],
            )

    def _nearest(self, rows: np.ndarray, vec: np.ndarray, own: int, k: int,
                 products: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of the ``k`` nearest of the entries ``rows``, ties to the smaller id."""
        rows, wide = rows[(self.only[rows] != own) | self.several[rows]], vec.astype(np.float64)
        if len(rows) > k:
            with np.errstate(over="ignore", invalid="ignore"):
                scores = (self.vectors[rows] @ vec if products is None else products[rows]).astype(np.float64)
            if np.isfinite(scores).all():
                slack = self.slack[rows] * np.linalg.norm(wide) + len(vec) * float(np.finfo(np.float32).tiny)
                # whatever the rounding, k entries reach ``least``
                least = np.partition(scores - slack, len(rows) - k)[len(rows) - k]
                rows = rows[scores + slack >= least]
        step = max(1, _EXACT // len(vec))
        exact = np.concatenate([np.zeros(0)] + [
            (self.vectors[rows[lo:lo + step]].astype(np.float64) * wide).sum(1) for lo in range(0, len(rows), step)
        ])
        if len(rows) > k:
            best = exact >= np.partition(exact, len(rows) - k)[len(rows) - k]
            rows, exact = rows[best], exact[best]
        n = self.id_at[rows + 1] - self.id_at[rows]
        ids = self.ids[np.repeat(self.id_at[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        scores = np.repeat(exact, n)
        ids, scores = ids[ids != own], scores[ids != own]
        order = np.lexsort((ids, -scores))[:k]
        return ids[order], scores[order]


def nearest(df: DataFrame, is_query, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` nearest that the tables find, for the rows where the
    column expression ``is_query`` holds (it may use ``id``), against all rows."""
    spark = df.sparkSession
    entries = written(entries_of(df, id_col, vector_col, k + 1), "ann-entries")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    sizes = entries.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("largest"))
    found = [
        _found(entries.filter(F.size("v") == r["dim"]), _queries(df, id_col, vector_col, r["dim"], is_query),
               r["dim"], r["n"], r["largest"], k)
        for r in sorted(sizes.collect())
    ]
    if not found:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    best = reduce(DataFrame.unionByName, found).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _found(entries: DataFrame, queries: DataFrame, dim: int, n: int, largest: float, k: int) -> DataFrame:
    """query_id, vec_id and score of the nearest of each table and task, for vectors of one length."""
    hashes, probes = fitted(entries, dim, n, largest, k)
    directions = cell_directions(hashes, -(-n // SHARE))

    def keyed(batches):
        for b in batches:
            slots = hashes.entry_slots(_matrix(b.column("v"), dim).astype(np.float64))
            keys, cells = hashes._keys(slots), cell_of(slots[:, :, :directions])
            for t in range(hashes.tables):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(b.num_rows, t)), pa.array(keys[:, t]), pa.array(cells[:, t]), b.column("ids"), b.column("v")],
                    names=["t", "key", "cell", "ids", "v"],
                )

    index = entries.mapInArrow(keyed, "t bigint, key bigint, cell bigint, ids array<bigint>, v array<float>")
    buckets = written(index.groupBy("t", "key", "cell").count(), "ann-buckets")
    # buckets of a good part of a share are salted, so that the parts of a cell are even; at most tables * n / large are that large
    large = max(1, SHARE // _LARGE)
    heavy = {(r["t"], r["key"]): -(-r["count"] // large) for r in buckets.filter(F.col("count") > large).collect()}
    # at most tables * _CELL_SLOTS * n / SHARE cells
    cells = buckets.groupBy("t", "cell").agg(F.sum("count").alias("n")).collect()
    layout = Layout(hashes.tables, directions, [(r["t"], r["cell"], r["n"]) for r in cells], SHARE)

    def dealt(batches):
        for b in batches:
            t, keys, cell = (np.asarray(b.column(c)) for c in ("t", "key", "cell"))
            salt = np.zeros(len(keys), np.int64)
            if heavy:
                ids = b.column("ids")
                salt = salts_of(heavy, t, keys, np.asarray(ids.flatten())[np.asarray(ids.offsets)[:-1] - np.asarray(ids.offsets)[0]])
            one = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32)), pa.array(keys))
            yield pa.RecordBatch.from_arrays(
                [pa.array(layout.part(t, cell, keys, salt)), pa.array(np.zeros(len(keys), np.int32)),
                 b.column("ids").cast(pa.list_(pa.int64())), one, b.column("v")],
                names=["part", "kind", "ids", "keys", "v"],
            )

    def asked(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                piece = b.slice(lo, 500)
                rows, where, lists = routes(hashes, layout, heavy, probes, _matrix(piece.column("v"), dim).astype(np.float64))
                if len(rows):
                    ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(where), piece.column("id").take(pa.array(rows)),
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists))),
                         piece.column("v").take(pa.array(rows))],
                        names=["part", "id", "keys", "v"],
                    )

    held = index.mapInArrow(dealt, "part bigint, kind int, ids array<bigint>, keys array<bigint>, v array<float>")
    held = held.withColumn("id", F.lit(None).cast("bigint"))
    probing = queries.mapInArrow(asked, "part bigint, id bigint, keys array<bigint>, v array<float>")
    probing = probing.withColumns({"kind": F.lit(1), "ids": F.lit(None).cast("array<bigint>")})
    both = held.unionByName(probing).repartition(max(1, layout.parts), "part").sortWithinPartitions("part", "kind")
    return both.mapInArrow(lambda bs: _search(bs, dim, k), "query_id bigint, vec_id bigint, score double")


def _queries(df: DataFrame, id_col: str, vector_col: str, dim: int, is_query) -> DataFrame:
    """Usable rows that ask, as (id, v), each pair once."""
    v = F.col(f"`{vector_col}`").cast("array<float>")
    rows = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), v.alias("v")).filter(is_query)
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("v").isNotNull() & (F.size("v") == dim) & finite & F.exists("v", lambda x: x != 0))
    return rows.dropDuplicates(["id", "v"])
